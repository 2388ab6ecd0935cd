"""Reproducible shuffle into shards by a Feistel permutation with cycle walking over row numbers.

Built of DataFrame functions alone. Each row gets a global number in the order of (doc_id, text
checksum, size); the permutation turns it into a position p, and ``shard = p mod n``, ``slot = p div n``.
Shard sizes therefore differ by one row at most, slots have no gaps, and anybody who knows the number
of rows and the key can compute where the row of a given number went.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored, text_or_empty

ROUNDS = 6
WALKS = 64
PRIME = (1 << 31) - 1


def round_keys(key: int, rounds: int = ROUNDS) -> tuple[list[int], list[int]]:
    """Two numbers below PRIME for each of the two halves of each round, from the key by a linear generator."""
    found, state = [], key
    for _ in range(4 * rounds):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        found.append((state >> 33) % PRIME)
    return found[: 2 * rounds], found[2 * rounds :]


def scrambled(x: Column, i: Column, keys: tuple[list[int], list[int]]) -> Column:
    """The round function: squares modulo a prime, in whole numbers that any SQL engine has."""
    add, times = (F.element_at(F.lit(k), i).cast("long") for k in keys)
    first = F.pmod(x + add, F.lit(PRIME))
    second = F.pmod(F.pmod(first * first, F.lit(PRIME)) + x * times, F.lit(PRIME))
    return F.pmod(second * second, F.lit(PRIME))


def feistel(x: Column, n: int, key: int, rounds: int = ROUNDS) -> Column:
    """One pass of a mixed-radix Feistel network: a bijection of 0 .. a*b - 1 with a*b just over n."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))
    keys = round_keys(key, rounds)

    def step(s: Column, i: Column) -> Column:
        left = F.pmod(s["l"] + scrambled(s["r"], i, keys), F.lit(a))
        right = F.pmod(s["r"] + scrambled(left, i + rounds, keys), F.lit(b))
        return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    start = F.struct(F.pmod(x, F.lit(a)).cast("long").alias("l"), F.floor(x / F.lit(a)).cast("long").alias("r"))
    if n > 2**52:  # the division above would lose digits
        raise ValueError("more than 2**52 rows")
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step, lambda s: s["r"] * F.lit(a) + s["l"])


def permuted(x: Column, n: int, key: int) -> Column:
    """A permutation of 0 .. n - 1: the network is applied again while it leads outside.

    Fewer than sqrt(n) + 1 positions lie outside, so up to 4096 rows 64 walks always do, and beyond
    that the chance that one row needs more is below 64**-64; such a row would raise, not go astray.
    """
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), feistel(x, n, key), lambda acc, _: F.when(acc >= n, feistel(acc, n, key)).otherwise(acc))
    return F.when(walk < n, walk).otherwise(F.raise_error(F.lit("cycle walking did not end")).cast("long"))


def numbered(df: DataFrame, order: list[str], number: str = "row_number") -> tuple[DataFrame, int]:
    """Rows with their global number from 0 in the given order, and how many there are.

    A range partitioning sorts in parallel; only one count for each partition meets on the driver.
    Rows equal in ``order`` are numbered in any order.
    """
    sorted_ = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    placed = stored(sorted_.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    counts = {r["part"]: r["rows"] for r in placed.groupBy(F.shiftright("_place", 33).alias("part")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    before, total = {}, 0
    for part in sorted(counts):
        before[part] = total
        total += counts[part]
    starts = F.element_at(F.lit(_dense(before)), F.shiftright("_place", 33).cast("int") + 1)
    return placed.withColumn(number, starts + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))).drop("_place"), total


def _dense(before: dict[int, int]) -> list[int]:
    """Starts by partition number; numbers of empty partitions get 0, which no row reads."""
    return [before.get(i, 0) for i in range(max(before, default=0) + 1)]


def shard_documents(df: DataFrame, shards: int = 40, key: int = 0x5EED) -> DataFrame:
    """Shard and slot of each row of (doc_id, text).

    Null doc_ids are numbered first; a null text counts as empty; repeated rows get a place each; an
    empty table gives no rows; further columns are ignored. Law ``rows``: sizes differ by one at most.
    """
    slim = df.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"), F.crc32(text_or_empty().cast("binary")).cast("long").alias("text_crc32"))
    rows, n = numbered(slim, ["doc_id", "text_crc32", "size"])
    place = rows.withColumn("position", permuted(F.col("row_number"), n, key))
    return place.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("position") / F.lit(shards)).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )
