"""Chunking of texts and packing of rows into groups."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col, strip, token_count
from .keys import ordinals

PARAGRAPH, SENTENCE, LEAST_CHARS = r"\n\s*\n", r"(?<=[.!?])\s+", 50


def pieces(text, most: int, paragraph: str = PARAGRAPH, sentence: str = SENTENCE) -> Column:
    """Paragraphs that fit ``most`` tokens, and the sentences of those that do not; trimmed, without empty ones."""
    whole = F.filter(F.transform(F.split(col(text), paragraph), strip), lambda p: p != "")
    return F.filter(F.flatten(F.transform(whole, lambda p: F.when(token_count(p) <= most, F.array(p)).otherwise(F.transform(F.split(p, sentence), strip)))), lambda p: p != "")


def chunk_starts(items: Column, most: int) -> Column:
    """Where chunks begin: a piece joins the current chunk while the sum of tokens fits, else it starts the next one.
    Only counts are folded, and the list of starts grows by one a chunk."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.array().cast("array<int>").alias("starts"))

    def step(s, p):
        fits = (F.size(s["starts"]) > 0) & (s["n"] + p["n"] <= most)
        return F.struct((F.when(fits, s["n"]).otherwise(0) + p["n"]).alias("n"), F.when(fits, s["starts"]).otherwise(F.concat(s["starts"], F.array(p["i"]))).alias("starts"))

    return F.aggregate(F.transform(items, lambda p, i: F.struct(token_count(p).alias("n"), i.alias("i"))), start, step, lambda s: s["starts"])


def chunked(df: DataFrame, most: int, paragraph: str = PARAGRAPH, sentence: str = SENTENCE, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row a chunk of at least ``least_chars`` characters: df's other columns, chunk_idx, text, n_tokens."""
    rest = [c for c in df.columns if c != "text"]
    rows = df.select(*rest, pieces("text", most, paragraph, sentence).alias("_pieces"))
    rows = rows.withColumn("_starts", chunk_starts(F.col("_pieces"), most))
    end = lambda j: F.coalesce(F.get("_starts", j + 1), F.size("_pieces"))
    chunks = F.filter(F.transform("_starts", lambda at, j: F.array_join(F.slice("_pieces", at + 1, end(j) - at), " ")), lambda c: F.length(c) >= least_chars)
    return rows.select(*rest, F.posexplode(chunks).alias("chunk_idx", "text")).withColumn("n_tokens", token_count("text"))


def character_chunks(text: str, size: int) -> Iterator[str]:
    """Paragraphs joined without a separator up to ``size`` characters; longer ones cut at the first sentence
    end or line end from ``size`` on, at 1.5 times the size at most."""
    current = ""
    for p in (p.strip() for p in text.split("\n\n")):
        if not p:
            continue
        if len(p) <= size:
            if len(current) + len(p) > size and current:
                yield current
                current = ""
            current += p
            continue
        if current:
            yield current
            current = ""
        while len(p) > size:
            end = next((i + 1 for i in range(size, min(len(p), size + size // 2)) if p[i] in ".!?\n"), min(len(p), size + size // 2))
            yield p[:end].strip()
            p = p[end:].strip()
        current = p
    if current:
        yield current


def chunked_by_characters(df: DataFrame, size: int, key: str = "doc_id") -> DataFrame:
    """(key, chunk_idx, text) by character_chunks; Arrow batches, as its cuts depend on each other."""
    kind = dict(df.dtypes)[key]

    def run(batches):
        for batch in batches:
            keys, idx, texts = [], [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for i, c in enumerate(character_chunks(t or "", size)):
                    keys.append(k), idx.append(i), texts.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(0).type), pa.array(idx, pa.int32()), pa.array(texts, pa.string())], names=[key, "chunk_idx", "text"])

    return df.select(key, "text").mapInArrow(run, f"{key} {kind}, chunk_idx int, text string")


def fixed_groups(df: DataFrame, size: int, *order: Column | str) -> DataFrame:
    """df with group_id: ``size`` consecutive rows each, in the given order."""
    return ordinals(df, *order, name="_at").withColumn("group_id", F.floor(F.col("_at") / size).cast("long")).drop("_at")


def singles_packed(df: DataFrame, parent: str, size: int, *order: Column | str) -> DataFrame:
    """Parents with one row are packed ``size`` to a group; larger ones are groups of their own.

    Adds pack_id, s<n> or m<parent>. Parents are counted with partial aggregation, so that a large one is no burden.
    """
    counts = df.groupBy(parent).agg(F.count(F.lit(1)).alias("_n"))
    rows = df.join(counts, parent)
    alone = fixed_groups(rows.filter("_n = 1"), size, *order).withColumn("pack_id", F.concat(F.lit("s"), F.col("group_id").cast("string"))).drop("group_id")
    return alone.unionByName(rows.filter("_n > 1").withColumn("pack_id", F.concat(F.lit("m"), F.col(parent).cast("string")))).drop("_n")


def budget_prefix(df: DataFrame, key: Column, size: str, target: int, by: list[str] | None = None, tie: str = "doc_id") -> DataFrame:
    """Rows in the order of ``key`` (a hex digest) while the sum before them is below ``target``, for each group of ``by``.

    Sums by the digest's first three digits (4096 classes) say which class crosses the target; only that
    class is put in order row by row.
    """
    by = by or []
    rows = df.withColumn("_key", key).withColumn("_class", F.substring("_key", 1, 3))
    sums = rows.groupBy(*by, "_class").agg(F.sum(size).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy(*by).orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    upto = sums.withColumn("_before", before).filter(F.col("_before") < target).withColumn("_crosses", F.col("_before") + F.col("_sum") > target).drop("_sum")
    some = rows.join(upto, [*by, "_class"])
    order = Window.partitionBy(*by, "_class").orderBy("_key", tie).rowsBetween(Window.unboundedPreceding, -1)
    edge = some.filter("_crosses").withColumn("_sum", F.col("_before") + F.coalesce(F.sum(size).over(order), F.lit(0))).filter(F.col("_sum") < target)
    return some.filter("not _crosses").select(*df.columns).unionByName(edge.select(*df.columns))


def packed_by_weight(df: DataFrame, key: str, weight: str, least: int, most: int, seed: str) -> DataFrame:
    """Whole rows are packed in hash order until a pack reaches its target weight, drawn by hash from least .. most.

    Packs form within 256 hash classes independently, so no task holds all rows: (key, pack_id).
    """
    order = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    rows = df.select(key, weight, order.alias("_h")).withColumn("_class", F.substring("_h", 1, 2))
    schema = f"{key} {dict(df.dtypes)[key]}, pack_id string"

    def pack(group, pdf):
        import hashlib

        pdf = pdf.sort_values(["_h", key])
        packs, n, total = [], 0, 0
        target = None
        for w in pdf[weight]:
            if target is None:
                draw = int(hashlib.sha256(f"{seed}{group[0]}{n}".encode()).hexdigest()[:8], 16)
                target = least + draw % (most - least + 1)
            packs.append(f"{group[0]}-{n}")
            total += w
            if total >= target:
                n, total, target = n + 1, 0, None
        return pdf.assign(pack_id=packs)[[key, "pack_id"]]

    return rows.groupBy("_class").applyInPandas(pack, schema)
