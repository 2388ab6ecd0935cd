"""Vector and term retrieval, rank fusion, passage location and context building."""

from __future__ import annotations

import math
import re
import string
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col
from ..session import stored

QUERY_BLOCK = 1024


def nearest(rows: DataFrame, queries: DataFrame, k: int, id_: str = "vec_id", vector: str = "embedding", block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, id) of the k rows of least squared distance for each query; ties to the smaller id.

    Queries (id, vector) go in blocks of about ``block``, each broadcast and held against all rows in one
    pass; every task hands on k rows a query. Rows and queries without id or vector take no part.
    """
    rows = rows.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter("id is not null and v is not null")
    asked = queries.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter("id is not null and v is not null")
    blocks = max(1, -(-asked.count() // block))
    found = None
    for i in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).toArrow()
        one = _nearest_in_block(rows, part, k)
        found = one if found is None else found.unionByName(one)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id"), "distance")


def _nearest_in_block(rows: DataFrame, part: pa.Table, k: int) -> DataFrame:
    ids = part.column("id").to_numpy()
    vectors = np.array(part.column("v").to_pylist(), np.float64)
    shared = rows.sparkSession.sparkContext.broadcast((ids, vectors))

    def run(batches):
        ids, vectors = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0))] * len(ids)
        for batch in batches:
            if not batch.num_rows or not len(ids):
                continue
            own, x = batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist(), np.float64)
            for q in range(len(ids)):
                d = ((x - vectors[q]) ** 2).sum(axis=1)
                near = np.argpartition(d, min(k, len(d) - 1))[: k + 1] if len(d) > k else np.arange(len(d))
                near = np.flatnonzero(d <= d[near].max()) if len(d) > k else near
                i, s = np.concatenate([best[q][0], own[near]]), np.concatenate([best[q][1], d[near]])
                order = np.lexsort((i, s))[:k]
                best[q] = i[order], s[order]
        q = np.repeat(ids, [len(b[0]) for b in best]) if len(ids) else ids
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(np.concatenate([b[0] for b in best]) if best else [], pa.int64()), pa.array(np.concatenate([b[1] for b in best]) if best else [], pa.float64())], names=["query_id", "id", "distance"])

    return rows.mapInArrow(run, "query_id long, id long, distance double")


def near_by_planes(rows: DataFrame, k: int, tables: int = 8, bits: int | None = None, window: int = 64, seed: int = 7) -> DataFrame:
    """(query_id, rank, id, distance): about the k nearest others of each row of (id, embedding), by squared distance.

    In each of ``tables`` tables rows stand in the order of the signs of their products with random planes (``bits`` of them, by
    default twice the logarithm of the number of rows) and then of one more product; a row is compared with the ``window``
    that follow it there, in runs that range partitions hold, so the work is rows * tables * window whatever the
    number of rows of one sign pattern. An approximation: what no table brings near is not found.
    """
    usable = rows.select(F.col("id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding")).filter("id is not null and size(embedding) > 0")
    usable = stored(usable, "vectors")
    first = usable.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    dims, bits = first[1] or 1, min(62, bits or max(4, 2 * int(math.log2(max(first[0], 2)))))
    rng = np.random.default_rng(seed)
    planes = rows.sparkSession.sparkContext.broadcast(rng.normal(size=(tables, bits + 1, dims)))
    found = None
    for t in range(tables):

        def keyed(batches, t=t):
            for batch in batches:
                x = np.array([np.resize(np.array(v, np.float64), planes.value.shape[2]) for v in batch.column(1).to_pylist()]).reshape(batch.num_rows, -1)
                products = x @ planes.value[t].T
                signs = (products[:, :-1] > 0) @ (np.int64(1) << np.arange(products.shape[1] - 1))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(signs.astype(np.int64)), pa.array(products[:, -1])], names=["id", "embedding", "signs", "along"])

        def pairs(batches, k=k, window=window):
            tail: list = []
            for batch in batches:
                own = tail + list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
                x = [np.array(v) for _, v in own]
                out = []
                for j in range(len(tail), len(own)):
                    near = range(max(0, j - window), j)
                    out += [(own[j][0], own[i][0], float(((x[j] - x[i]) ** 2).sum())) for i in near if len(x[i]) == len(x[j])]
                tail = own[-window:]
                best = sorted(out + [(b, a, d) for a, b, d in out], key=lambda e: (e[0], e[2], e[1]))
                kept, last, n = [], None, 0
                for e in best:
                    n = n + 1 if e[0] == last else 1
                    last = e[0]
                    if n <= k and e[0] != e[1]:
                        kept.append(e)
                yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in kept], pa.int64()), pa.array([e[1] for e in kept], pa.int64()), pa.array([e[2] for e in kept], pa.float64())], names=["query_id", "id", "distance"])

        ordered = usable.mapInArrow(keyed, "id long, embedding array<double>, signs long, along double").repartitionByRange("signs", "along", "id").sortWithinPartitions("signs", "along", "id")
        one = ordered.mapInArrow(pairs, "query_id long, id long, distance double")
        found = one if found is None else found.unionByName(one)
    best = found.groupBy("query_id", "id").agg(F.min("distance").alias("distance"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "distance")


def terms(text) -> Column:
    return F.regexp_extract_all(F.lower(col(text)), F.lit(r"([a-z0-9_]+)"), F.lit(1))


def bm25(docs: DataFrame, queries: DataFrame, k: int, k1: float = 1.5, b: float = 0.75, doc_id: str = "doc_id", query_id: str = "item_id", block: int = 4096) -> DataFrame:
    """(query_id, rank, id, score): Okapi BM25 with the idf ln(1 + (N - df + 0.5) / (df + 0.5)), which is never
    negative; scores rounded to six places, ties to the smaller id.

    Queries go in blocks of about ``block``, of which the terms are broadcast. One pass over the documents
    counts the terms that are asked for, a second one scores each document where it lies and hands on k of a task
    for each query; no posting is shuffled, so a common word is no hot key.
    """
    asked = queries.select(F.col(query_id).cast("long").alias("query_id"), F.array_distinct(terms("text")).alias("terms")).filter("query_id is not null and size(terms) > 0")
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    blocks = max(1, -(-asked.count() // block))
    out = None
    for i in range(blocks):
        part = [(r["query_id"], r["terms"]) for r in asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i).collect()]
        one = _bm25_block(rows, part, k, k1, b)
        out = one if out is None else out.unionByName(one)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


TERM = re.compile(r"[a-z0-9_]+", re.ASCII)


def _bm25_block(rows: DataFrame, queries: list[tuple[int, list[str]]], k: int, k1: float, b: float) -> DataFrame:
    spark = rows.sparkSession
    wanted = spark.sparkContext.broadcast({t for _, ts in queries for t in ts})

    def count(batches):
        found, n, length = Counter(), 0, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = TERM.findall((text or "").lower())
                n, length = n + 1, length + len(own)
                found.update(wanted.value.intersection(own))
        yield pa.RecordBatch.from_arrays([pa.array([None, None, *found], pa.string()), pa.array([True, False, *[False] * len(found)]), pa.array([n, length, *found.values()], pa.int64())], names=["term", "docs", "n"])

    sums = {(r["term"], r["docs"]): r["n"] for r in rows.select("text").mapInArrow(count, "term string, docs boolean, n long").groupBy("term", "docs").agg(F.sum("n").alias("n")).collect()}
    n, length = sums.pop((None, True), 0), sums.pop((None, False), 0)
    mean = length / n if n else 1.0
    by_term: dict[str, tuple[float, list[int]]] = {t: (math.log(1 + (n - df + 0.5) / (df + 0.5)), []) for (t, _), df in sums.items()}
    for at, (_, ts) in enumerate(queries):
        for t in ts:
            if t in by_term:
                by_term[t][1].append(at)
    index = spark.sparkContext.broadcast(({t: (idf, np.array(at)) for t, (idf, at) in by_term.items()}, np.array([q for q, _ in queries], np.int64)))

    def score(batches):
        terms_, ids = index.value
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * len(ids)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                scores = np.zeros((part.num_rows, len(ids)))
                for row, text in enumerate(part.column(1).to_pylist()):
                    own = TERM.findall((text or "").lower())
                    norm = k1 * (1 - b + b * len(own) / (mean or 1.0))
                    for t, tf in Counter(filter(terms_.__contains__, own)).items():
                        idf, at = terms_[t]
                        scores[row, at] += idf * tf * (k1 + 1) / (tf + norm)
                scores = np.round(scores, 6)
                docs_ = part.column(0).to_numpy(zero_copy_only=False)
                for q in range(len(ids)):
                    near = np.flatnonzero(scores[:, q] > (best[q][1][-1] if len(best[q][1]) >= k else 0))
                    near = np.union1d(near, np.flatnonzero(scores[:, q] == best[q][1][-1])) if len(best[q][1]) >= k else near
                    if len(near):
                        i, s = np.concatenate([best[q][0], docs_[near]]), np.concatenate([best[q][1], scores[near, q]])
                        order = np.lexsort((i, -s))[:k]
                        best[q] = i[order], s[order]
        if len(ids):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, [len(x[0]) for x in best]), pa.int64()), pa.array(np.concatenate([x[0] for x in best]), pa.int64()), pa.array(np.concatenate([x[1] for x in best]), pa.float64())], names=["query_id", "id", "score"])

    return rows.filter("id is not null").mapInArrow(score, "query_id long, id long, score double")


def fused(rankings: list[DataFrame], k: int, constant: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of (query_id, rank from 1, id): sum of 1 / (constant + rank), rounded to nine places."""
    all_ = rankings[0].select("query_id", "rank", "id")
    for r in rankings[1:]:
        all_ = all_.unionByName(r.select("query_id", "rank", "id"))
    scores = all_.groupBy("query_id", "id").agg(F.round(F.sum(F.lit(1.0) / (F.lit(constant) + F.col("rank"))), 9).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return scores.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def distinct_by_rank(ranked: DataFrame, key: str) -> DataFrame:
    """The best-ranked row of each (query_id, key), ranks closed up."""
    best = ranked.groupBy("query_id", key).agg(F.min("rank").alias("rank"), F.min_by("id", "rank").alias("id"))
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("rank")))


def normalised(text) -> Column:
    """Only a-z, A-Z lower-cased, and 0-9 of the text."""
    return F.regexp_replace(F.translate(col(text), string.ascii_uppercase, string.ascii_lowercase), "[^a-z0-9]", "")


#: What normalised() makes of each ASCII code; 0 for those that go.
PLAIN = np.array([c | 32 if chr(c) in string.ascii_uppercase else c if chr(c) in string.ascii_lowercase + string.digits else 0 for c in range(129)], np.uint8)


def located(docs: DataFrame, passages: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", block: int = 20_000) -> DataFrame:
    """(item_id, doc_id, start, end) of each passage's first place in each document, white space and
    punctuation aside; offsets into the text, end exclusive.

    Passages go in blocks into one automaton each, so a document is read once a block whatever their number.
    Empty passages are nowhere.
    """
    asked = passages.select(F.col(item_id).cast("long").alias("item"), normalised("text").alias("norm")).filter("norm <> ''")
    blocks = max(1, -(-asked.count() // block))
    out = None
    for i in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i).collect()
        one = _located(docs.select(F.col(doc_id).cast("long"), "text"), [(r["item"], r["norm"]) for r in part])
        out = one if out is None else out.unionByName(one)
    return out


def _located(docs: DataFrame, patterns: list[tuple[int, str]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(patterns)

    def run(batches):
        import ahocorasick

        automaton = ahocorasick.Automaton()
        same: dict[str, list[int]] = {}
        for item, norm in shared.value:
            same.setdefault(norm, []).append(item)
        for norm, items in same.items():
            automaton.add_word(norm, (len(norm), items))
        automaton.make_automaton()
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not same or not text:
                    continue
                plain = PLAIN[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 128)]
                kept = np.flatnonzero(plain)
                flat = plain[kept].tobytes().decode("ascii")
                seen = set()
                for end, (n, items) in automaton.iter(flat):
                    for item in items:
                        if item not in seen:
                            seen.add(item)
                            rows.append((item, doc, int(kept[end - n + 1]), int(kept[end]) + 1))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())], names=["item_id", "doc_id", "start", "end"])

    return docs.mapInArrow(run, "item_id long, doc_id long, start int, end int")


def sharing_characters(docs: DataFrame, items: DataFrame, n: int, doc_id: str = "doc_id", item_id: str = "item_id", block_chars: int = 1 << 21) -> DataFrame:
    """(item_id, doc_id) of all pairs that share some n characters.

    The items' runs of n characters go in blocks of about ``block_chars`` of them, each broadcast once; every document is
    held against a block where it lies. Items without n characters share nothing.
    """
    asked = items.select(F.col(item_id).cast("long").alias("item"), F.col("text").cast("string").alias("text")).filter(F.length("text") >= n)
    total = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    out = None
    for i in range(blocks):
        grams: dict[str, list[int]] = {}
        for r in asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i).collect():
            for g in {r["text"][j : j + n] for j in range(len(r["text"]) - n + 1)}:
                grams.setdefault(g, []).append(r["item"])
        one = _sharing(docs.select(F.col(doc_id).cast("long"), F.col("text").cast("string")), grams, n)
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def _sharing(docs: DataFrame, grams: dict[str, list[int]], n: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(grams)

    def run(batches):
        known = shared.value.keys()
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = known & {text[j : j + n] for j in range(len(text) - n + 1)} if text else ()
                rows += [(item, doc) for item in {i for g in own for i in shared.value[g]}]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], names=["item_id", "doc_id"])

    return docs.mapInArrow(run, "item_id long, doc_id long")


def context_text(chunks: Column, sources: Column) -> Column:
    """Retrieved chunks one below the other, then their sources, each once, in order."""
    return F.concat(F.array_join(chunks, "\n\n"), F.lit("\n\nSources: "), F.array_join(F.array_distinct(sources), ", "))


def shrunk(chunks: Column, budget: int, rounds: int = 20) -> Column:
    """The longest chunk is halved (its first half of words stays) until all fit the budget or the rounds end; blank ones go."""
    words = lambda t: F.filter(F.split(t, r"\s+"), lambda w: w != "")
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, t: s + F.size(words(t)))

    def halve(a, _):
        sizes = F.transform(a, lambda t: F.size(words(t)))
        longest = F.array_position(sizes, F.array_max(sizes)) - 1
        cut = F.transform(a, lambda t, i: F.when(i == longest, F.array_join(F.slice(words(t), F.lit(1), F.floor(F.size(words(t)) / 2).cast("int")), " ")).otherwise(t))
        return F.when(total(a) > budget, cut).otherwise(a)

    return F.filter(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), chunks, halve), lambda t: F.trim(t) != "")
