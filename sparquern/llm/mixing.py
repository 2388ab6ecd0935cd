"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpointed, stored, unused

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096


def word_count(col: str = "text") -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` in the text; null: 0."""
    return F.coalesce(F.regexp_count(F.col(col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size) to target and copies a row, by filling up in proportion to the weights.

    A source stops at ``most`` times its size; what it leaves goes to the others by weight until none is
    above. In the end each source that is not full gets the same level times its weight, so one pass
    over the sources in the order of size / weight finds the level. One row a source.
    """
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("_rank", F.lit(len(weights))) + 1).cast("int"))).withColumn("_full", F.col("source_size") * F.lit(float(most)))
    by_level = Window.orderBy(F.col("_full") / F.col("weight"), "_rank")
    total = Window.partitionBy()
    parts = weighed.withColumns({
        "_all": F.sum("source_size").over(total) * F.lit(float(share)),
        "_full_before": F.coalesce(F.sum("_full").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "_weight_from": F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)),
    }).withColumn("_level", (F.col("_all") - F.col("_full_before")) / F.col("_weight_from"))
    # the first source that its share does not fill sets the level
    open_ = F.min(F.when(F.col("_level") * F.col("weight") < F.col("_full"), F.struct((F.col("_full") / F.col("weight")).alias("at"), "_rank", "_level"))).over(total)
    level = parts.withColumn("_open", open_)
    target = F.when(F.col("_open").isNull(), F.col("_full")).otherwise(F.least("_full", F.col("_open._level") * F.col("weight")))
    return level.select("source", "source_size", target.cast("double").alias("target"))


def size_class(size: Column) -> Column:
    """How often a size can be halved down to one, halved: 0 for 1 to 3 words, 1 for 4 to 15, 2 for 16 to 63, and so on."""
    return F.floor((F.length(F.bin(size)) - 1) / 2).cast("int")


def inclusion(plan: DataFrame, classes: DataFrame) -> DataFrame:
    """plan with ``factor``, by which a source's favour 2 ** size_class becomes the odds of inclusion.

    The probabilities p = odds / (1 + odds) times sizes must sum to the rest of the target; that sum rises with the
    factor, which sixty halvings of its logarithm's range find. One row and at most 32 classes a source.
    """
    joined = plan.join(classes, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of")

    def words(factor: Column) -> Column:
        one = lambda c: c["words"] * factor * F.pow(F.lit(2.0), c["size_class"]) / (1 + factor * F.pow(F.lit(2.0), c["size_class"]))
        return F.aggregate(F.coalesce("_classes", F.array()), F.lit(0.0), lambda acc, c: acc + one(c))

    def halved(bounds: Column, _) -> Column:
        middle = (bounds["lo"] + bounds["hi"]) / 2
        below = words(F.exp(middle)) < F.col("rest")
        return F.struct(F.when(below, middle).otherwise(bounds["lo"]).alias("lo"), F.when(below, bounds["hi"]).otherwise(middle).alias("hi"))

    bounds = F.aggregate(F.sequence(F.lit(1), F.lit(60)), F.struct(F.lit(-60.0).alias("lo"), F.lit(60.0).alias("hi")), halved)
    return joined.withColumn("factor", F.exp((bounds["lo"] + bounds["hi"]) / 2)).drop("_classes")


def mix_documents(df: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0, seed: int = 11, keep: tuple[str, ...] = ()) -> DataFrame:
    """How often the mix takes each row: doc_id, source, size, source_size, target, inclusion, copies, taken.

    Each row first gets the certain whole copies of its source's ratio target / size. The rest is a
    Pareto order sample of fixed size with unequal probabilities: within a source a row's odds of
    inclusion are in proportion to 2 ** size_class, about the root of its size, so that longer documents, whose
    contexts are worth more, are the likelier ones; the factor is such that the expected words are the rest of
    the target. Rows are ranked by (U / (1 - U)) / odds, U a number from 0 to 1 by a hash of doc_id and
    seed, and the lowest are taken until their words reach the rest, the row that crosses it only if that is nearer.

    A source may hold any part of the rows: words are summed by class of rank (4096 classes a source,
    combined before the shuffle), and only the one class in which the rest of the target ends is put in
    order row by row.

    Null source: a source of its own, the last. Null text: size 0, taken 0. Rows of one doc_id rank by size and
    text; rows equal in everything are ranked next to each other, each for itself. An empty table gives no
    rows. Other columns are ignored but for those named in ``keep``, which go along.
    """
    text = F.col("text").cast("string")
    slim = df.select(F.col("doc_id"), F.col("source"), word_count().alias("size"), draw("doc_id", seed).alias("_u"), F.xxhash64(text).alias("_text"), *keep)
    slim = stored(slim, "mix")
    by_class = slim.groupBy("source", size_class(F.col("size")).alias("size_class")).agg(F.sum("size").alias("words"))
    classes = checkpointed(by_class.groupBy("source").agg(F.sum("words").alias("source_size"), F.collect_list(F.struct("size_class", "words")).alias("_classes")))  # 32 a source
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = (
        source_targets(classes.select("source", "source_size"), weights, share, most)
        .withColumn("whole", F.floor(ratio).cast("long"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    plan = checkpointed(inclusion(plan, classes.select(F.col("source").alias("_of"), "_classes")).withColumnRenamed("source", "_source"))
    keyed = slim.join(F.broadcast(plan) if _few(plan) else plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    favour = F.pow(F.lit(2.0), size_class(F.col("size")))
    rank = F.col("_u") / (1 - F.col("_u")) / favour  # a power of two changes no digit
    odds = F.col("factor") * favour
    place = rank / F.col("factor") / (1 + rank / F.col("factor"))
    keyed = keyed.withColumns({"_rank": rank, "inclusion": F.when(F.col("size") == 0, 0.0).when(F.col("rest") > 0, odds / (1 + odds)).otherwise(0.0), "_class": F.least(F.floor(place * BUCKETS), F.lit(BUCKETS - 1)).cast("int")})
    summed = keyed.groupBy("source", "_class").agg(F.sum("size").alias("_words"), F.first("rest").alias("_rest"))
    upto = summed.withColumn("_before", F.coalesce(F.sum("_words").over(Window.partitionBy("source").orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    last = checkpointed(upto.filter((F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("_words") >= F.col("_rest"))).select("source", F.col("_class").alias("_last"), "_before").dropDuplicates(["source"]))
    last = last.withColumnRenamed("source", "_source")
    marked = keyed.join(F.broadcast(last) if _few(last) else last, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    # rows without a word never cross, so they need no order
    crossing = F.coalesce((F.col("rest") > 0) & (F.col("size") > 0) & (F.col("_class") == F.col("_last")), F.lit(False))
    order = Window.partitionBy("source").orderBy("_rank", "doc_id", "size", "_text")
    after = F.col("_before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    nearer = (F.col("_after") - F.col("rest")) <= (F.col("rest") - (F.col("_after") - F.col("size")))
    chosen = marked.filter(crossing).withColumn("_after", after).withColumn("extra", nearer & (F.col("_after") - F.col("size") < F.col("rest")))
    # no class crosses where rounding leaves the target a hair above all words: then all are taken
    outside = marked.filter(~crossing).withColumn("extra", (F.col("rest") > 0) & ((F.col("_class") < F.col("_last")) | F.col("_last").isNull()))
    columns = ["doc_id", "source", "size", "source_size", "target", "inclusion", (F.col("whole") + F.coalesce(F.col("extra"), F.lit(False)).cast("long")).alias("copies"), *keep]
    both = chosen.select(*columns).unionByName(outside.select(*columns))
    return both.withColumn("copies", F.when(F.col("size") > 0, F.col("copies")).otherwise(F.lit(0))).withColumn("taken", F.col("size") * F.col("copies"))


def draw(doc_id: str, seed: int) -> Column:
    """A number between 0 and 1 by the first 52 bits of the md5 of 'seed:doc_id' (null: no digits)."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def _few(df: DataFrame, rows: int = 100_000) -> bool:
    """Whether a checkpointed table of a row a source has so few rows that it may be broadcast."""
    return df.limit(rows + 1).count() <= rows


def mixed_rows(df: DataFrame, **parameters) -> DataFrame:
    """df's rows, with all their columns, each as often as the mix takes it.

    Rows of size 0 (no word) add nothing to a mix and go. Of rows that share doc_id, text and source one
    stands for all, as often as they are taken together.
    """
    names = {unused(df, "_a"): F.xxhash64("doc_id", "text", "source"), unused(df, "_b"): F.xxhash64("text", "source", "doc_id", F.lit(1))}
    times, rows = unused(df, "_n"), df.withColumns(names)
    slim = rows.select("doc_id", "text", "source", *names)
    taken = mix_documents(slim, **parameters, keep=tuple(names)).filter("copies > 0").groupBy(*names).agg(F.sum("copies").cast("int").alias(times))
    joined = rows.dropDuplicates(list(names)).join(stored(taken, "taken"), list(names))
    return joined.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*df.columns)
