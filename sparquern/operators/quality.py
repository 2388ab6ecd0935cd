"""Votes, label metrics, deduplication by prefix, costs and rewards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import base_name, col, lines, strip


def majority(votes: DataFrame, key: str, vote: str = "vote", threshold: float = 0.5) -> DataFrame:
    """(key, n_votes, n_true, passed): the share of yes reaches the threshold; no votes (all null) fail."""
    share = F.avg(F.col(vote).cast("int"))
    return votes.groupBy(key).agg(F.count(vote).alias("n_votes"), F.coalesce(F.sum(F.col(vote).cast("long")), F.lit(0)).alias("n_true"), F.coalesce(share >= threshold, F.lit(False)).alias("passed"))


def winning_details(votes: DataFrame, passed: DataFrame, key: str, vote: str = "vote") -> DataFrame:
    """The votes of the side that won."""
    return votes.join(passed.select(key, "passed"), key).filter(F.col(vote) == F.col("passed")).drop("passed")


def missing_votes(votes: DataFrame, needed: int, key: str, vote: str = "vote") -> DataFrame:
    """How many votes a row still needs, so that a rerun asks for these only."""
    return votes.groupBy(key).agg((F.lit(needed) - F.count(vote)).alias("missing")).filter("missing > 0")


def accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Over rows that have both: n, accuracy (null without any)."""
    both = df.filter(F.col(label).isNotNull() & F.col(predicted).isNotNull())
    return both.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy"))


def binary_metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    tp = F.sum(F.when((F.col(label) == 1) & (F.col(predicted) == 1), 1).otherwise(0))
    fp = F.sum(F.when((F.col(label) == 0) & (F.col(predicted) == 1), 1).otherwise(0))
    fn = F.sum(F.when((F.col(label) == 1) & (F.col(predicted) == 0), 1).otherwise(0))
    n = F.count(F.lit(1))
    both = df.filter(F.col(label).isNotNull() & F.col(predicted).isNotNull()).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), n.alias("n"))
    ratio = lambda a, b: F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))
    c = F.col
    return both.select("n", ratio(c("tp"), c("tp") + c("fp")).alias("precision"), ratio(c("tp"), c("tp") + c("fn")).alias("recall"), ratio(2 * c("tp"), 2 * c("tp") + c("fp") + c("fn")).alias("f1"), ratio(c("n") - c("fp") - c("fn"), c("n")).alias("accuracy"))


def first_by(df: DataFrame, keys: list[Column], *order: str) -> DataFrame:
    """The first row of each key, by partial aggregation (a key may hold any part of the rows)."""
    names = [f"_k{i}" for i in range(len(keys))]
    top = df.select(*[k.alias(n) for k, n in zip(keys, names, strict=True)], F.struct(*order).alias("_o"), F.struct(*df.columns).alias("_row"))
    return top.groupBy(*names).agg(F.min_by("_row", "_o").alias("_row")).select("_row.*")


def prefix_distinct(df: DataFrame, text: str, n: int, *order: str) -> DataFrame:
    """Of rows whose text begins with the same n characters the first stays."""
    return first_by(df, [F.substring(text, 1, n)], *order)


def costs(calls: DataFrame, kind: str, amount: str, prices: dict[str, float], source_tokens: float) -> DataFrame:
    """Tokens, cost, share of the total and cost a million source tokens by kind of call; prices a million tokens."""
    price = F.create_map(*[F.lit(x) for k, v in prices.items() for x in (k, float(v))])
    sums = calls.groupBy(kind).agg(F.sum(amount).cast("double").alias("tokens")).withColumn("cost", F.col("tokens") / F.lit(1e6) * F.coalesce(F.element_at(price, F.col(kind)), F.lit(0.0)))
    total = F.sum("cost").over(Window.partitionBy())
    share = F.when(total > 0, 100.0 * F.col("cost") / total).otherwise(F.lit(0.0))
    a_million = F.lit(0.0) if source_tokens <= 0 else F.col("cost") / F.lit(source_tokens / 1e6)
    grown = F.lit(0.0) if source_tokens <= 0 else F.col("tokens") / F.lit(float(source_tokens))
    return sums.select(kind, "tokens", "cost", share.alias("share"), a_million.alias("cost_per_million"), grown.alias("amplification"))


REWARDS: dict[str, object] = {}
COMBINATIONS: dict[str, object] = {"sum": lambda rs: reduce(lambda a, b: a + b, rs), "mean": lambda rs: reduce(lambda a, b: a + b, rs) / F.lit(float(len(rs)))}
SCALINGS: dict[str, object] = {"identity": lambda r: r}


def reward(name: str):
    """Register a function of (response, answer) columns that gives a number, under a name."""

    def register(f):
        REWARDS[name] = f
        return f

    return register


@reward("correctness")
def correctness(response, answer) -> Column:
    return F.when(strip(response) == strip(answer), F.lit(2.0)).otherwise(F.lit(0.0))


@reward("integer")
def integer(response, answer) -> Column:
    return F.when(strip(response).rlike(r"^\d+$"), F.lit(0.5)).otherwise(F.lit(0.0))


def rewarded(df: DataFrame, names: list[str], response: str, answer: str, combine: str = "sum", scale: str = "identity") -> DataFrame:
    parts = [SCALINGS[scale](REWARDS[n](F.col(response), F.col(answer))) for n in names]
    return df.withColumn("reward", COMBINATIONS[combine](parts))


def main_speaker(df: DataFrame, key: str, text: str, user: str = "{user}") -> DataFrame:
    """(key, speaker): the base name before ':' that speaks most, with at least half as many lines (rounded up)
    as the user; the first in the text wins ties; null where none does."""
    rows = df.select(key, F.posexplode(lines(text)).alias("at", "line"))
    is_user = F.startswith(strip("line"), F.lit(user + ":"))
    raw = strip(F.substring_index("line", ":", 1))
    name = F.when(~is_user & F.contains("line", F.lit(":")) & (raw != "") & (raw != user), base_name(raw))
    said = rows.select(key, "at", is_user.alias("user"), name.alias("name"))
    users = said.groupBy(key).agg(F.sum(F.col("user").cast("int")).alias("users"))
    counts = said.filter("name is not null").groupBy(key, "name").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    good = counts.join(users, key).filter(F.col("n") >= F.ceil(F.col("users") / 2))
    best = good.groupBy(key).agg(F.max_by("name", F.struct("n", -F.col("first"))).alias("speaker"))
    return users.select(key).join(best, key, "left")


def vector(c) -> Column:
    return F.transform(col(c), lambda x: x.cast("double"))
