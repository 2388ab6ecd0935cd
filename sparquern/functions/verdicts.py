"""Verdicts of model replies as Column expressions. Null stands for a reply that must be tried again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, strip, tag_first

# Phrases that decide verdicts.
REJECTING = ("irrelevant", "mostly", "partial", "introduces information not present in the text")
INACCURATE = ("inaccurate", "mostly", "partial", "irrelevant")
META_ANSWER = ("the provided", "the reworded", "mention", "no information", "follow the instructions in a separate")
TEXT_REFERENCES = ("according to the text", "as stated in", "explicitly stated", "as defined in", "given text", "provided information", "the text states")


def has_any(text: Column, phrases) -> Column:
    found = F.lit(False)
    for p in phrases:
        found = found | F.contains(text, F.lit(p))
    return found


def after(text, heading: str, ignore_case: bool = True) -> Column:
    """What follows the first heading, trimmed; null without it."""
    pattern = f"(?s{'i' if ignore_case else ''}){heading}(.+)"
    return F.when(col(text).rlike(pattern), strip(F.regexp_extract(col(text), pattern, 1)))


def suitable(text) -> Column:
    t = F.lower(col(text))
    return F.when(has_any(t, ("unsuitable", "table of contents")), False).when(F.contains(t, F.lit("suitable")), True)


def question_valid(text) -> Column:
    t = F.lower(after(text, "Final Judgment:"))
    return F.when(has_any(t, REJECTING), False).when(F.contains(t, F.lit("relevant")), True)


def answer_relevant(text) -> Column:
    """Anything unclear is a no."""
    t = after(text, "Explanation of Judgment:")
    yes = F.contains(t, F.lit("relevant")) | F.contains(t, F.lit("Relevant"))
    return F.coalesce(~has_any(F.lower(t), REJECTING) & yes, F.lit(False))


def answer_accurate(text) -> Column:
    """No determination is a no; one without a verdict is null."""
    t = F.lower(after(text, "Overall Accuracy Determination:", ignore_case=False))
    return F.when(t.isNull() | has_any(t, INACCURATE), False).when(F.contains(t, F.lit("accurate")), True)


def context_repair(text) -> Column:
    """(verdict, question, answer): keep, reword (with the new pair) or drop; null verdict to try again."""
    judged = strip(F.regexp_extract(col(text), r"(?i)Final judgment:(.+)", 1))
    question = strip(F.regexp_extract(col(text), r"(?is)Reworded Question:(.*?)(?:\n\s*)?Reworded Answer:", 1))
    answer = strip(F.regexp_extract(col(text), r"(?is)Reworded Answer:(.*)$", 1))
    word = F.when(F.contains(judged, F.lit("PASS")), "keep").when(F.contains(judged, F.lit("REWORD")), F.when(has_any(F.lower(answer), META_ANSWER), "drop").otherwise("reword")).when(F.contains(judged, F.lit("FAIL")), "drop")
    own = word == "reword"
    return F.struct(word.alias("verdict"), F.when(own, question).alias("question"), F.when(own, answer).alias("answer"))


def free_of_text_references(text) -> Column:
    return ~has_any(col(text), TEXT_REFERENCES)


def truthy(c) -> Column:
    """Present and not false, empty or zero."""
    return F.coalesce(col(c).cast("string").isin("", "false", "0", "0.0") == False, F.lit(False))  # noqa: E712


def tags_whole(text) -> Column:
    """Whether thoughts that begin also end."""
    t = col(text)
    return ~F.contains(t, F.lit("think")) | F.contains(t, F.lit("</think>"))


def correction_parts(text) -> Column:
    """The four parts of a correction reply; all null unless each tag is there."""
    parts = {t: tag_first(text, t) for t in ("question", "flawed_answer", "critique", "corrected_answer")}
    whole = F.lit(True)
    for p in parts.values():
        whole = whole & p.isNotNull()
    return F.when(whole, F.struct(*[p.alias(t) for t, p in parts.items()]))


def story_ok(ratings: Column, allowed=("good", "incredible")) -> Column:
    """Whether there are ratings and all are allowed."""
    return (F.size(F.map_values(ratings)) > 0) & F.forall(F.map_values(ratings), lambda r: r.isin(*allowed))
