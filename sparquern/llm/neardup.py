"""Near-duplicate documents by bottom-k sketches from one hash function.

A document is the set of its five-word shingles (fewer words: the whole sequence). Its sketch is the k
smallest hashes of the set. Inverted lists of the retained values give, for documents that share some,
how many they share; with the k smallest of the union that bounds the similarity from above, and pairs
that may reach the threshold are confirmed by exact Jaccard similarity of the full sets.

How large groups are kept linear:

* texts of equal sets are one class from the start; only its smallest doc_id goes on;
* each class is first compared with the one hub (smallest id of a list) that it shares most with, which
  joins groups of near copies in as many comparisons as they have members;
* then lists of at most ``hot`` entries give their pairs across what isn't joined yet;
* longer lists (a passage that many documents hold, or near copies of one text) are left out there. Where
  fewer values of a sketch are in such lists than a pair at the threshold must share (21 of 48, or half of a
  whole small set), the others find every partner. For classes with more there, all members outside the
  largest component of a list's hub are compared with all members, in blocks of full sets, so nothing is capped.

With k = 48 a pair at the threshold passes every sketch filter but with a chance below 1e-6 (five
standard deviations), and no such pair is skipped for the size of a list.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import WordHashes, arrow_map, checkpointed, free_shuffles, list_array, mixed, stored, unused, words_of
from .sharding import numbered

K, HOT, REACH, BLOCK, FILTER_BITS = 48, 32, 16, 256, 1 << 24
BLOCK_SHINGLES, COLUMNS = 1 << 18, 1 << 12
FACTORS = mixed(np.arange(101, 101 + 64, dtype=np.int64)) | np.uint64(1)


def shingle_set(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a sequence of word hashes."""
    h = hashes.view(np.uint64)
    n = len(h)
    if not n:
        return hashes
    if n < width:
        total = (h * FACTORS[:n]).sum(dtype=np.uint64) + np.uint64(n)
        return mixed(np.array([total], np.uint64)).view(np.int64)
    total = h[: n - width + 1] * FACTORS[0]
    for i in range(1, width):
        total = total + h[i : n - width + 1 + i] * FACTORS[i]
    return np.unique(mixed(total).view(np.int64))


def sketched(df: DataFrame, width: int, k: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest of the set (null if empty), the k least hashes."""

    def make():
        words = WordHashes()

        def work(batch):
            sets = [shingle_set(words.hashes(words_of(t)), width) for t in batch.column(1).to_pylist()]
            yield {
                "doc_id": batch.column(0), "text_hash": batch.column(2), "n_shingles": [len(s) for s in sets], "digest": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "sketch": list_array([s[:k] for s in sets], pa.int64()),
            }

        return work

    return arrow_map(df.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), make, "doc_id long, text_hash long, n_shingles long, digest binary, sketch array<long>")


def sets_of(df: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(id, set) of the rows whose doc_id is wanted, and of some more.

    A bit table of fixed size (FILTER_BITS) is broadcast to leave out rows before their sets are built;
    past some ten million wanted ids it lets more and more rows pass, which the join that follows drops.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    hashed = wanted.select(bit(F.col("id")).alias("b"))
    rows = hashed.groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("m")).toArrow()
    table = np.zeros(FILTER_BITS >> 6, np.int64)
    table[rows.column("w").to_numpy()] = rows.column("m").to_numpy()
    shared = df.sparkSession.sparkContext.broadcast(np.packbits(np.unpackbits(table.view(np.uint8), bitorder="little")))

    def make():
        words, bits = WordHashes(), shared.value

        def work(batch):
            b = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((bits[b >> 3] >> (7 - (b & 7))) & 1 == 1))
            yield {"id": batch.column(0), "set": list_array([shingle_set(words.hashes(words_of(t)), width) for t in batch.column(1).to_pylist()], pa.int64())}

        return work

    return arrow_map(df.withColumn("bit", bit(F.col("doc_id"))), make, "id long, set array<long>")


def confirmed(df: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    pairs = stored(pairs.select("a", "b"), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    sets = stored(sets_of(df, wanted, width), "sets")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return stored(both.filter(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared)).select("a", "b"), "links")


def components(links: DataFrame) -> DataFrame:
    """(id, component): the least id reachable, for ids with links, by alternating large and small stars."""
    edges = checkpointed(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    known = None
    while True:
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == known or not seen[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        known = seen
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())


def _alike_in_size(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def least_shared(k_union: Column | np.ndarray, percent: int):
    """Shared values below which the union's sketch rules the threshold out, by five standard deviations."""
    p = percent / 100
    root = F.sqrt if isinstance(k_union, Column) else np.sqrt
    return p * k_union - 5 * root(k_union * (p * (1 - p)))


def near_duplicates(df: DataFrame, percent: int = 75, width: int = 5, k: int = K, hot: int = HOT) -> DataFrame:
    """A row for each row of (doc_id, text): doc_id, n_shingles, component_id, kept.

    Links: 100 * intersection >= percent * union. Null or blank text: no shingles, its own component,
    kept. Null doc_id: takes no part in links; component_id null, kept. Repeated rows are copies of each
    other, and of repeated doc_ids each row is judged by its own text. No rows, no result; other columns are ignored.
    """
    out = _labelled(df, percent, width, k, hot)
    component = F.col("component")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _labelled(df: DataFrame, percent: int, width: int, k: int, hot: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest (null: no shingles), component (null: no doc_id) of each row."""
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(sketched(docs, width, k), "sketches")
    usable = rows.filter("digest is not null and doc_id is not null")
    several = usable.groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a <> b")
    if several.isEmpty():
        return _with_components(rows, docs, percent, width, k, hot)
    # a doc_id that stands for different texts is no name for a set: rows go by their number in the order of doc_id
    placed, _ = numbered(docs, ["doc_id"], "number")
    named = placed.filter("doc_id is not null")
    renamed = named.select(F.col("number").alias("doc_id"), "text")
    found = _with_components(stored(sketched(renamed, width, k), "sketches"), renamed, percent, width, k, hot)
    own = named.select(F.col("number"), F.col("doc_id").alias("own_id"))
    found = found.withColumnRenamed("doc_id", "number").join(own, "number").withColumnRenamed("own_id", "doc_id")
    least = own.select(F.col("number").alias("component"), F.col("own_id").alias("least"))
    found = found.join(least, "component").select("doc_id", "text_hash", "n_shingles", "digest", F.col("least").alias("component"))
    return found.unionByName(rows.filter("doc_id is null").select("doc_id", "text_hash", "n_shingles", "digest", F.lit(None).cast("long").alias("component")))


def _with_components(rows: DataFrame, docs: DataFrame, percent: int, width: int, k: int, hot: int) -> DataFrame:
    """The sketched rows with the components of their sets; a doc_id has one set at most."""
    spark = docs.sparkSession
    classes = stored(rows.filter("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "classes")
    lists = classes.select("id", "n", F.explode("sketch").alias("value"))
    sizes = lists.groupBy("value").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("id", "n")).alias("hub")).filter("m > 1")
    entries = stored(
        lists.join(sizes, "value").groupBy("id", "n").agg(F.collect_list(F.struct("value", "m", "hub")).alias("entries"))
        .withColumn("hot", F.size(F.filter("entries", lambda e: e["m"] > hot))), "entries",
    )
    free_shuffles(spark)
    # stars: each class and the hub it shares most with
    voted = entries.select("id", "n", F.explode("entries.hub").alias("hub")).filter((F.col("hub.id") != F.col("id")) & _alike_in_size(F.col("n"), F.col("hub.n"), percent)).groupBy("id", "n", F.col("hub.id").alias("hub")).agg(F.count(F.lit(1)).alias("c"))
    best = voted.filter(F.col("c") * 4 >= F.least(F.lit(k), "n")).groupBy("id").agg(F.max(F.struct("c", (-F.col("hub")).alias("hub"))).alias("best"))
    stars = confirmed(docs, best.select(F.col("id").alias("a"), (-F.col("best.hub")).alias("b")), width, percent)
    joined = checkpointed(components(stars))
    free_shuffles(spark)
    placed = stored(entries.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id")), "placed")
    more = confirmed(docs, _pairs_of_lists(placed, percent, k, hot), width, percent)
    blocks = stored(_links_of_hot_lists(docs, placed, percent, width, k, hot), "block-links")
    final = checkpointed(components(stars.unionByName(more).unionByName(blocks)))
    free_shuffles(spark)
    labels = classes.select("digest", "id").join(final, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    # rows without a set match nothing, and are spread over all tasks
    spread = F.coalesce("digest", F.monotonically_increasing_id().cast("string").cast("binary"))
    out = rows.drop("sketch").withColumn("_key", spread).join(labels.withColumnRenamed("digest", "_key"), "_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "text_hash", "n_shingles", "digest", component.alias("component"))


def _pairs_of_lists(placed: DataFrame, percent: int, k: int, hot: int) -> DataFrame:
    """Pairs across components that lists of at most ``hot`` entries bring together often enough."""
    cold = placed.select("id", "n", "hot", "component", F.explode(F.filter("entries", lambda e: e["m"] <= hot)).alias("e")).select("id", "n", "hot", "component", F.col("e.value").alias("value"))
    a, b = (cold.select("value", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "n", "hot", "component")]) for s in "ab")
    met = a.join(b, "value").filter((F.col("id_a") < F.col("id_b")) & (F.col("component_a") != F.col("component_b")) & _alike_in_size(F.col("n_a"), F.col("n_b"), percent))
    counted = met.groupBy("id_a", "id_b", "n_a", "n_b", "hot_a", "hot_b").agg(F.count(F.lit(1)).alias("c"))
    enough = F.col("c") + F.least("hot_a", "hot_b") >= least_shared(F.least(F.lit(float(k)), F.greatest("n_a", "n_b")), percent)
    return counted.filter(enough).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))


def _links_of_hot_lists(docs: DataFrame, placed: DataFrame, percent: int, width: int, k: int, hot: int) -> DataFrame:
    """Links across components among classes most of whose sketch lies in long lists, block by block.

    Two such classes that reach the threshold share one of their REACH smallest retained values of long
    lists, so they share that list's hub too, and the hubs stand for the lists: copies of one text have
    few hubs, however many values they share. For each hub the members outside its largest component are held
    against all members, in blocks of about BLOCK classes of like size. A task confirms its pairs on the
    full sets and hands on a link only where it joins what the block has not joined yet.
    """
    # fewer retained values than this in long lists leave a pair at the threshold enough others
    own = F.least(F.lit(k), "n")
    mostly = placed.filter(F.col("hot") >= F.least(F.floor(own / 2) + 1, F.lit(max(1, int(least_shared(float(k), percent))))))
    values = F.slice(F.array_sort(F.filter("entries", lambda e: e["m"] > hot)), 1, REACH)
    hubs = mostly.select("id", "n", "component", F.explode(F.array_distinct(F.transform(values, lambda e: e["hub"]["id"]))).alias("hub"))
    parts = hubs.groupBy("hub", "component").agg(F.count(F.lit(1)).alias("c"))
    groups = parts.groupBy("hub").agg(F.sum("c").alias("m"), F.count(F.lit(1)).alias("parts"), F.max_by("component", F.struct("c", "component")).alias("main")).filter("parts > 1")
    members = stored(hubs.join(groups.select("hub", "m", "main"), "hub"), "members")
    sets = sets_of(docs, members.select("id"), width)
    ratio = 100 / percent
    rows = members.join(sets.dropDuplicates(["id"]), "id").withColumn("band", F.floor(F.log("n") / F.lit(float(np.log(ratio)))).cast("int"))
    # as many chunks of a hub's band as hold BLOCK classes and BLOCK_SHINGLES shingles each
    sized = rows.groupBy("hub", "band").agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(float(BLOCK))), F.ceil(F.sum("n") / F.lit(float(BLOCK_SHINGLES)))).alias("chunks"))
    rows = stored(rows.join(sized, ["hub", "band"]).withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks")), "blocks")
    item = F.collect_list(F.struct("id", "component", "set"))
    blocks = rows.groupBy("hub", "band", "chunk").agg(item.alias("block"))
    apart = rows.filter("component <> main").groupBy("hub", "band", "chunk").agg(item.alias("apart")).drop("chunk")
    # each block apart goes to each chunk of its band and those beside, so that a hub's blocks meet in many tasks
    beside = apart.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    sent = beside.join(rows.select("hub", "band", "chunks").distinct(), ["hub", "band"]).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks")
    met = sent.join(blocks, ["hub", "band", "chunk"])

    def make():
        def work(batch):
            for x, y in zip(batch.column(0), batch.column(1), strict=True):
                yield _block_links(*_block(x.values), *_block(y.values), percent)

        return work

    return arrow_map(met.select("apart", "block"), make, "a long, b long", rows=4)


def _block(members: pa.StructArray) -> tuple[list[int], list[int], list[np.ndarray]]:
    """Ids, components and sets of a block, the sets as views of Arrow's memory."""
    ids, parts, sets = members.flatten()
    return ids.to_pylist(), parts.to_pylist(), [s.values.to_numpy() for s in sets]


def _block_links(x: list[int], x_parts: list[int], x_sets: list[np.ndarray], y: list[int], y_parts: list[int], y_sets: list[np.ndarray], percent: int) -> dict[str, list]:
    """Links between two blocks, fewer than there are members: those that join components not joined yet."""
    sets = x_sets + y_sets
    n = np.array([len(s) for s in sets], np.int64)
    values, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1  # values of one set alone meet nothing
    row = np.repeat(np.arange(len(sets)), n)
    keep = times[at] > 1
    row, column = row[keep], column[at[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(x), len(y)), np.int64)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        some = slice(*np.searchsorted(column, (first, first + COLUMNS)))
        bag = np.zeros((len(sets), COLUMNS), np.float32)
        bag[row[some], column[some] - first] = 1
        shared += (bag[: len(x)] @ bag[len(x) :].T).astype(np.int64)
    union = n[: len(x), None] + n[None, len(x) :] - shared
    parent = {c: c for c in x_parts + y_parts}

    def top(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    out = {"a": [], "b": []}
    for p, q in zip(*np.nonzero(100 * shared >= percent * union), strict=True):
        c, d = top(x_parts[p]), top(y_parts[q])
        if c != d:
            parent[max(c, d)] = min(c, d)
            out["a"].append(x[p]), out["b"].append(y[q])
    return out


def drop_near_duplicates(df: DataFrame, percent: int = 75, width: int = 5, k: int = K, hot: int = HOT) -> DataFrame:
    """The rows of df, with all their columns, of which one of each component stays: that of the smallest
    doc_id, and of several texts under that doc_id the one of the least hash. Rows of one doc_id whose texts
    are no near copies are different documents and all stay, as do rows of null doc_id or without a word."""
    found = _labelled(df, percent, width, k, hot).filter("doc_id is not null and digest is not null")
    # the smallest doc_id's own row, and not another row of that doc_id
    first = found.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    apart = [unused(df, "_id"), unused(df, "_hash")]
    first = first.select(F.col("first.doc_id").alias(apart[0]), F.col("first.text_hash").alias(apart[1]))
    named = df.withColumns({apart[0]: F.col("doc_id").cast("long"), apart[1]: F.xxhash64(F.col("text").cast("string"))})
    worded = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)) & F.col(apart[0]).isNotNull()
    return named.filter(worded).join(first, apart, "left_semi").dropDuplicates(apart).unionByName(named.filter(~worded)).select(*df.columns)
