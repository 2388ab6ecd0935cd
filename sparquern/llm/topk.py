"""Exact top-k search by inner product over vector-approximation files.

Vectors are stored once, with one byte a dimension beside them that names the vector's cell on a regular grid. For
a query, the cells of a vector bound its score from both sides. The bytes of all vectors are scanned first (the
vectors themselves stay unread, in their own column): what may still be among the best is a vector whose
upper bound reaches the k-th highest lower bound. Exact vectors are then read in the order of their bounds, the likeliest first,
and the others only where their upper bound reaches the k-th score found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import arrow_map, checkpointed, stored

SCALE, CELLS, QUERY_BYTES, FIRST_READ = 1024.0, 256, 1 << 25, 4
EXACT = float(1 << 53)


def grid(df: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Least and greatest component of floor(1024 x) by length of vector and dimension."""

    def make():
        def work(batch):
            vectors = batch.column(0)
            sizes = np.diff(vectors.offsets.to_numpy())
            for n in np.unique(sizes):
                with np.errstate(over="ignore"):
                    x = np.floor(SCALE * vectors.filter(pa.array(sizes == n)).flatten().to_numpy().astype(np.float64)).reshape(-1, n)
                yield {"size": [n] * n, "dim": range(n), "lo": x.min(axis=0), "hi": x.max(axis=0)}

        return work

    found = arrow_map(df.select("embedding"), make, "size int, dim int, lo double, hi double", rows=4096).groupBy("size", "dim").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in {r["size"] for r in found}:
        own = sorted((r["dim"], r["lo"], r["hi"]) for r in found if r["size"] == size)
        out[size] = np.array([r[1] for r in own]), np.array([r[2] for r in own])
    return out


class Approximation:
    """Cells of a regular grid, and bounds on inner products from them."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, cells: int = CELLS) -> None:
        self.lo, self.cells = lo, cells
        self.width = np.maximum(np.ceil((hi - lo + 1) / cells), 1)

    def codes(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.lo) // self.width, 0, self.cells - 1).astype(np.uint8)

    def lower(self, codes: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Lower bounds of the scores, vectors by queries. All numbers are whole and below 2**53."""
        return (self.lo + codes * self.width) @ queries.T + (self.width - 1) @ np.minimum(queries, 0).T

    def gap(self, queries: np.ndarray) -> np.ndarray:
        """What the upper bound of a score is above the lower one, by query."""
        return np.abs(queries) @ (self.width - 1)


def _scan(df: DataFrame, queries: dict[int, tuple[np.ndarray, np.ndarray]], cells: dict[int, Approximation], k: int) -> DataFrame:
    """query_id, row, lower, upper of the vectors that may be among the k best, as far as a task can tell; (row, vec_id, size, codes) is read."""
    shared = df.sparkSession.sparkContext.broadcast((queries, cells))

    def make():
        queries, cells = shared.value
        # by length of vector: the k-th highest lower bound of each query so far, and what may reach it
        kth = {n: np.full(len(q[0]), -np.inf) for n, q in queries.items()}
        best = {n: np.full((k, len(q[0])), -np.inf) for n, q in queries.items()}
        held: dict[int, list] = {n: [] for n in queries}

        def trimmed(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            at, rows, low = (np.concatenate(x) for x in zip(*held[n], strict=True))
            some = low + gaps[n][at] >= kth[n][at]
            return at[some], rows[some], low[some]

        gaps = {n: cells[n].gap(q[1]) for n, q in queries.items()}

        def work(batch):
            ids, rows, sizes = (batch.column(i).to_numpy() for i in (1, 0, 2))
            for n in np.unique(sizes):
                if n not in queries:
                    continue
                own = np.flatnonzero(sizes == n)
                codes = np.frombuffer(b"".join(batch.column(3).take(pa.array(own)).to_pylist()), np.uint8).reshape(len(own), n)
                q_ids, q = queries[n]
                for first in range(0, len(q), 512):
                    part = slice(first, first + 512)
                    low = cells[n].lower(codes, q[part])
                    low[ids[own][:, None] == q_ids[None, part]] = -np.inf
                    top = np.concatenate([best[n][:, part], np.partition(low, len(low) - k, axis=0)[-k:] if len(low) > k else low])
                    best[n][:, part] = np.partition(top, len(top) - k, axis=0)[-k:]
                    kth[n][part] = best[n][:, part].min(axis=0)
                    row, at = np.nonzero((low + gaps[n][part] >= kth[n][part]) & (low > -np.inf))
                    held[n].append((at + first, rows[own][row], low[row, at]))
                if sum(len(h[0]) for h in held[n]) > 4 * k * len(q) + (1 << 20):
                    held[n] = [trimmed(n)]
            return ()

        def finish():
            for n, (q_ids, _) in queries.items():
                if held[n]:
                    at, rows, low = trimmed(n)
                    yield {"query_id": q_ids[at], "row": rows, "lower": low, "upper": low + gaps[n][at]}

        work.finish = finish
        return work

    return arrow_map(df.select("row", "vec_id", "size", "codes"), make, "query_id long, row long, lower double, upper double", rows=1024)


def _exact(vectors: DataFrame, wanted: DataFrame, queries: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """query_id, vec_id, score of the (query_id, row) that are wanted; only their vectors go on to be multiplied."""
    shared = vectors.sparkSession.sparkContext.broadcast({int(i): x for ids, q in queries.values() for i, x in zip(ids, q, strict=True)})
    read = wanted.groupBy("row").agg(F.collect_list("query_id").alias("queries"))  # at most the queries of one block
    rows = vectors.select("row", "vec_id", "embedding").join(read, "row")

    def make():
        def work(batch):
            for vec, values, ids in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x = np.floor(SCALE * np.array(values, np.float64))
                scores = np.array([shared.value[i] for i in ids]) @ x
                yield {"query_id": ids, "vec_id": [vec] * len(ids), "score": scores.astype(np.int64)}

        return work

    return arrow_map(rows.select("row", "vec_id", "embedding", "queries"), make, "query_id long, vec_id long, score long")


def _ranked(df: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _searched(vectors: DataFrame, queries: dict[int, tuple[np.ndarray, np.ndarray]], cells: dict[int, Approximation], k: int) -> DataFrame:
    """The k best of each query of a block: one scan of the cells, then two reads of exact vectors."""
    found = stored(_scan(vectors, queries, cells, k), "candidates")
    by_lower = Window.partitionBy("query_id").orderBy(F.desc("lower"), "row")
    ranked = found.withColumn("_n", F.row_number().over(by_lower))
    # rows come twice to a query's first read only if they are the likeliest; the k-th score of that read decides on the others
    first = stored(_exact(vectors, ranked.filter(F.col("_n") <= FIRST_READ * k).select("query_id", "row"), queries), "first-read")
    kth = _ranked(first, k).groupBy("query_id").agg(F.min("score").alias("_kth"), F.max("rank").alias("_found"))
    open_ = ranked.filter(F.col("_n") > FIRST_READ * k).join(kth, "query_id").filter((F.col("_found") < k) | (F.col("upper") >= F.col("_kth"))).select("query_id", "row")
    return _ranked(first.unionByName(_exact(vectors, open_, queries)), k).select("query_id", "vec_id", "score")


def _whole(v: float) -> int:
    """floor(1024 v), also where that is beyond doubles."""
    return int(v) * 1024 if abs(v) >= 2.0**52 else int(np.floor(SCALE * v))


def _plain(vectors: DataFrame, asked: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """For components so large that doubles would round: whole numbers of any size, scores kept within a long."""
    shared = vectors.sparkSession.sparkContext.broadcast([(i, [_whole(x) for x in v]) for i, v in asked])

    def make():
        best: dict[int, list[tuple[int, int]]] = {i: [] for i, _ in shared.value}

        def work(batch):
            for i, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = [_whole(v) for v in values]
                for q, y in shared.value:
                    if q != i and len(x) == len(y):
                        score = max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(x, y, strict=True))))
                        best[q] = sorted([*best[q], (-score, i)])[:k]
            return ()

        def finish():
            for q, own in best.items():
                yield {"query_id": [q] * len(own), "vec_id": [i for _, i in own], "score": [-s for s, _ in own]}

        work.finish = finish
        return work

    return arrow_map(vectors.select("vec_id", "embedding"), make, "query_id long, vec_id long, score long")


def approximated(rows: DataFrame, cells: dict[int, Approximation]) -> DataFrame:
    """The stored vectors: row, vec_id, size, codes (null where doubles would round), embedding."""
    shared = rows.sparkSession.sparkContext.broadcast(cells)

    def make():
        def work(batch):
            vectors = batch.column(2)
            sizes = np.diff(vectors.offsets.to_numpy())
            codes: list[bytes | None] = [None] * len(sizes)
            for n in np.unique(sizes):
                if cell := shared.value.get(int(n)):
                    own = np.flatnonzero(sizes == n)
                    x = vectors.take(pa.array(own)).flatten().to_numpy().astype(np.float64).reshape(-1, n)
                    data = cell.codes(np.floor(SCALE * x)).tobytes()
                    for i, at in enumerate(own.tolist()):
                        codes[at] = data[i * n : (i + 1) * n]
            yield {"row": batch.column(0), "vec_id": batch.column(1), "size": sizes, "codes": codes, "embedding": vectors}

        return work

    kind = dict(rows.dtypes)["embedding"]
    return stored(arrow_map(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding"), make, f"row long, vec_id long, size int, codes binary, embedding {kind}"), "vectors")


def top_k(df: DataFrame, k: int = 10, every: int = 100, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The k best rows for each row of (vec_id, embedding) whose vec_id is divisible by ``every``.

    query_id, rank, vec_id, score: the inner product of floor(1024 x) vectors, ties to the smaller
    vec_id. A query's own vec_id is no candidate; fewer candidates than k give all. Rows with a null
    vec_id, and vectors that are null, empty or hold null or non-finite components take no part, and
    vectors of different lengths aren't compared. Repeated rows are candidates each; of a repeated query
    id the least vector asks. Scores beyond a long stop at its ends. Queries go in blocks of at most
    ``query_bytes`` of vectors, each of which is broadcast and held against all cells in one scan.
    """
    kind = "array<float>" if dict(df.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.filter("vec_id is not null and embedding is not null and size(embedding) > 0").filter(~bad)
    asked = checkpointed(rows.filter(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    grids = grid(rows)
    # lengths whose products and sums are exact in doubles, wherever a query lies
    exact = {n: Approximation(*g) for n, g in grids.items() if n * (max(np.abs(g[0]).max(), np.abs(g[1]).max()) + (g[1] - g[0]).max() / CELLS + 1) ** 2 < EXACT}
    vectors = approximated(rows, exact)
    total = asked.agg(F.sum(F.size("embedding"))).first()[0] or 0
    blocks = max(1, -(-8 * total // query_bytes))
    out = None
    for i in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == i).toArrow()
        found = _one_block(vectors, part, exact, k)
        if blocks > 1:
            found = checkpointed(found)
        out = found if out is None else out.unionByName(found)
    return _ranked(out, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _one_block(vectors: DataFrame, part: pa.Table, exact: dict[int, Approximation], k: int) -> DataFrame:
    by_size: dict[int, list[tuple[int, list[float]]]] = {}
    for i, v in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
        by_size.setdefault(len(v), []).append((i, v))
    queries = {n: (np.array([i for i, _ in own], np.int64), np.floor(SCALE * np.array([v for _, v in own], np.float64))) for n, own in by_size.items() if n in exact}
    out = _searched(vectors.filter("codes is not null"), queries, {n: exact[n] for n in queries}, k)
    large = [q for n, own in by_size.items() if n not in exact for q in own]
    return out.unionByName(_plain(vectors.filter("codes is null"), large, k)) if large else out
