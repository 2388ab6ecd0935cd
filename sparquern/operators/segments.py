"""Training segments with loss masks, meta-datasets and corpus rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conversations import CHATML
from ..functions.text import col


def segment(label: bool | Column, text: Column) -> Column:
    return F.struct((F.lit(label) if isinstance(label, bool) else label).alias("label"), text.alias("text"))


def correction_segments(context, question, flawed, corrected, flawed_full) -> Column:
    """Dialogue of four turns with the flawed answer masked. Null unless the flawed answer stands in its full
    text just once, so that this has two other parts."""
    full, bad = col(flawed_full), col(flawed)
    parts = F.split(full, F.concat(F.lit(r"\Q"), bad, F.lit(r"\E")), -1)
    return F.when((bad != "") & (F.size(parts) == 2), F.array(segment(True, F.concat(col(context), col(question), F.get(parts, F.lit(0)))), segment(False, bad), segment(True, F.concat(F.get(parts, F.lit(1)), col(corrected)))))


def group_segments(items: DataFrame, group: str, order: str, question: str, answer: str, preset: dict = CHATML) -> DataFrame:
    """One row for each item of a group of fixed size: (group, focus, segments). All turns of the group, learned only for the focus."""
    grouped = items.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(order, question, answer))).alias("_items"))
    user, reply = preset["user"], preset["assistant"]

    def of(focus):
        return F.flatten(F.transform("_items", lambda x, i: F.array(segment(i == focus, F.concat(F.lit(user[0]), x[question], F.lit(user[1]))), segment(i == focus, F.concat(F.lit(reply[0]), x[answer], F.lit(reply[1]))))))

    return grouped.select(group, "_items", F.explode(F.sequence(F.lit(0), F.size("_items") - 1)).alias("focus")).select(group, "focus", of(F.col("focus")).alias("segments"))


def meta_rows(details: DataFrame, key: str, calls: str = "details") -> DataFrame:
    """Call details to training rows: completions as a masked prompt and a learned reply; chats with the reply as last turn.

    details: ARRAY<STRUCT<input_text, input_messages, response, completion_mode>>.
    """
    rows = details.select(key, F.posexplode(calls).alias("call", "d"))
    done = F.when(F.col("d.completion_mode"), F.array(segment(False, F.col("d.input_text")), segment(True, F.col("d.response"))))
    chat = F.when(~F.col("d.completion_mode"), F.concat(F.col("d.input_messages"), F.array(F.struct(F.lit("assistant").alias("role"), F.col("d.response").alias("content")))))
    return rows.select(key, "call", done.alias("segments"), chat.alias("messages"))


def corpus_rows(df: DataFrame, key: str, text: str, facts: str, variations: str, banner: str | None = None) -> DataFrame:
    """2 + V rows an item: its text, its facts and each variation, behind a banner with the key if one is given."""
    all_ = F.concat(F.array(F.col(text), F.col(facts)), F.coalesce(F.col(variations), F.array().cast("array<string>")))
    rows = df.select(key, F.posexplode(all_).alias("part", "text"))
    return rows if banner is None else rows.withColumn("text", F.concat(F.lit(f"[[[{banner} "), F.col(key).cast("string"), F.lit("]]]\n"), F.col("text")))


def rag_records(df: DataFrame, question: str, text: str, metadata: str, related: str) -> DataFrame:
    """Rows with all required fields filled."""
    filled = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    return df.filter(filled(question) & filled(text) & filled(metadata)).select(F.col(question).alias("question"), F.col(text).alias("source_text"), F.col(metadata).alias("source_metadata"), F.coalesce(F.col(related), F.array().cast(df.schema[related].dataType)).alias("related_chunks"))


def canonical_first(df: DataFrame, name: str, order: str, fields: list[str]) -> DataFrame:
    """Each row takes the fields of the first row of its name, where that has them; the first by ``order``.

    The first of a name is found with partial aggregation and joined, so a name may hold any part of the rows.
    """
    first = df.groupBy(name).agg(F.min_by(F.struct(*fields), order).alias("_first"))
    out = df.join(first, name)
    return out.withColumns({f: F.coalesce(F.col(f"_first.{f}"), F.col(f)) for f in fields}).drop("_first")


def formatted(sections: list[tuple[str, Column]], heading: str = "plain_heading", content: str = "plain_paragraph") -> Column:
    """Sections of (heading, text or array column) in a named style, blank lines between."""
    parts = [F.concat(HEADINGS[heading](F.lit(h)), F.lit("\n"), CONTENTS[content](c), F.lit("\n")) for h, c in sections]
    return F.regexp_replace(F.array_join(F.array(*parts), "\n"), r"^\s+|\s+$", "")


HEADINGS = {
    "bold_heading": lambda h: F.concat(F.lit("**"), h, F.lit("**")), "underline_heading": lambda h: F.concat(F.lit("__"), h, F.lit("__")),
    "hash_heading": lambda h: F.concat(F.lit("# "), h), "allcaps_heading": F.upper, "plain_heading": lambda h: h,
}
CONTENTS = {
    "dash_list": lambda a: F.array_join(F.transform(a, lambda x: F.concat(F.lit("- "), x)), "\n"), "asterisk_list": lambda a: F.array_join(F.transform(a, lambda x: F.concat(F.lit("* "), x)), "\n"),
    "numbered_list": lambda a: F.array_join(F.transform(a, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n"),
    "indent_paragraph": lambda t: F.concat(F.lit("    "), t), "blockquote_paragraph": lambda t: F.concat(F.lit("> "), t), "plain_paragraph": lambda t: t,
}
