"""Repeatable sampling, splits and mixing, all by content hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import hash_index, hash_ratio
from .keys import ordinals

SEED = 1048596


def seeded(text: str, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.col(text)).cast("binary"))


def hash_subset(df: DataFrame, k: int, text: str = "text", tie: str = "doc_id", seed: int = SEED) -> DataFrame:
    """The k rows of least seeded hash. Each task keeps k rows at most."""
    return df.withColumn("_h", seeded(text, seed)).orderBy("_h", tie).limit(k).drop("_h")


def hash_split(df: DataFrame, sizes: dict[str, int], text: str = "text", tie: str = "doc_id") -> DataFrame:
    """Consecutive slices of the hash order with their names in ``split``; rows beyond them are left out.

    Rows are numbered by range partitions, so slices of any size are sorted in parallel."""
    ranked = ordinals(df.withColumn("_h", F.md5(F.col(text).cast("binary"))), "_h", tie, name="_r").filter(F.col("_r") < sum(sizes.values()))
    name, at = F.lit(None).cast("string"), 0
    for split, n in sizes.items():
        name = F.when((F.col("_r") >= at) & (F.col("_r") < at + n), split).otherwise(name)
        at += n
    return ranked.withColumn("split", name).drop("_h", "_r")


def bernoulli(df: DataFrame, key: str, p: float, name: str = "chosen") -> DataFrame:
    return df.withColumn(name, F.coalesce(hash_ratio(F.col(key).cast("string")) < p, F.lit(False)))


def percent_mix(df: DataFrame, weights: dict[str, float], total: int, source: str = "source", text: str = "text", tie: str = "doc_id") -> DataFrame:
    """int(total * share) rows of each source in hash order. The rank filter keeps few rows before the shuffle."""
    whole = sum(weights.values())
    quota = F.create_map(*[F.lit(x) for s, w in weights.items() for x in (s, int(total * w / whole))])
    rows = df.filter(F.col(source).isin(*weights)).withColumn("_h", F.md5(F.col(text).cast("binary")))
    most = max([int(total * w / whole) for w in weights.values()], default=0)
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(source).orderBy("_h", tie))).filter(F.col("_r") <= most)
    return ranked.filter(F.col("_r") <= F.element_at(quota, F.col(source))).drop("_h", "_r")


def round_robin(items: DataFrame, key: str, rounds: int, seed: int = SEED) -> DataFrame:
    """Each item once a round, the rounds in order, each in its own hash order: round, place, key."""
    rows = items.select(key, F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round"))
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), "round", F.col(key).cast("string")))
    placed = ordinals(rows.withColumn("_h", order), "round", "_h", key, name="_at")
    each = placed.filter("round = 0").count()
    return placed.select(key, "round", (F.col("_at") - F.col("round") * F.lit(each)).cast("int").alias("place"))


def negatives(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """n other rows for each row: (key, other), chosen by hash without comparing all with all.

    Rows stand in the order of their hash on a ring; the others are the n that follow a row there.
    """
    ring = ordinals(df.select(key).withColumn("_h", F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))), "_h", key, name="_at")
    total = ring.count()
    wanted = ring.select(F.col(key).alias("_own"), F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"), "_at").withColumn("_at", F.pmod(F.col("_at") + F.col("step"), F.lit(max(total, 1))))
    return wanted.join(ring.select("_at", F.col(key).alias("other")), "_at").filter(F.col("_own") != F.col("other")).select(F.col("_own").alias(key), "step", "other")


def negative_contexts(chunks: DataFrame, key: str, text: str, most: int, failed: float, seed: int = SEED) -> DataFrame:
    """(key, failed, contexts): for a share ``failed`` of the rows by hash 1 .. ``most`` other rows' texts, else the row's own
    and up to ``most`` - 1 others, in an order by hash. Others come from the ring of negatives()."""
    own = F.col(key).cast("string")
    drawn = chunks.select(key, (hash_ratio(own) < failed).alias("failed"), (hash_index(F.concat(own, F.lit("n")), most) + 1).alias("_n"))
    pairs = negatives(chunks, key, most, seed).join(drawn, key).filter(F.col("step") <= F.col("_n") - F.when(F.col("failed"), 0).otherwise(1))
    chosen = pairs.select(key, "other").unionByName(drawn.filter("not failed").select(key, F.col(key).alias("other")))
    texts = chosen.join(chunks.select(F.col(key).alias("other"), F.col(text).alias("_text")), "other")
    order = F.md5(F.concat(own, F.lit("|"), F.col("other").cast("string")).cast("binary"))
    listed = texts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "_text"))).alias("_c"))  # at most ``most``
    return drawn.join(listed, key, "left").select(key, "failed", F.coalesce(F.transform("_c", lambda c: c["_text"]), F.array().cast("array<string>")).alias("contexts"))


def json_order(df: DataFrame, prompt: str, tie: str, k: int | None = None) -> DataFrame:
    """Rows in the order of the sha256 of the prompt's JSON, numbered in ``place``: a repeatable shuffle; the first k only, if given."""
    hashed = df.withColumn("_h", F.sha2(F.to_json(prompt), 256))
    if k is not None:
        hashed = hashed.orderBy("_h", tie).limit(k)
    return ordinals(hashed, "_h", tie, name="place").drop("_h")


def other_group(df: DataFrame, group: str, order: str, text: str, seed: int = SEED) -> DataFrame:
    """For each group another group and its first text: the one that follows it on a ring of hashes; none for a single group."""
    first = df.groupBy(group).agg(F.min_by(text, order).alias("text"))
    ring = ordinals(first.withColumn("_h", F.md5(F.concat(F.lit(str(seed)), F.col(group).cast("string")).cast("binary"))), "_h", group, name="_at")
    total = ring.count()
    after = ring.select(F.pmod(F.col("_at") - 1, F.lit(max(total, 1))).alias("_at"), F.col(group).alias("other"), F.col("text").alias("other_text"))
    return ring.select(group, "_at").join(after, "_at").filter(F.col(group) != F.col("other")).drop("_at")


def trait_sets(spark, matrix: list[list[str]], k: int | None = None, seed: int = SEED) -> DataFrame:
    """(combination, traits): one trait of each row of the matrix in every combination, by their product's digits; or k of
    them chosen by hash. Blank traits leave no line."""
    total = reduce(lambda a, b: a * b, map(len, matrix), 1)
    rows, lines, step = spark.range(total).select(F.col("id").alias("combination")), [], total
    for own in matrix:
        step //= len(own)
        at = F.pmod(F.floor(F.col("combination") / step), F.lit(len(own))).cast("int")
        lines.append(F.get(F.array(*[F.lit(t) for t in own]), at))
    text = F.replace(F.regexp_replace(F.concat_ws("\n", *lines), r"^\s+|\s+$", ""), F.lit("\n\n"), F.lit("\n"))
    out = rows.select("combination", text.alias("traits"))
    if k is None:
        return out
    return out.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col("combination").cast("string"))), "combination").limit(k)
