"""Document fingerprints by consistent weighted sampling.

A text is a bag of words with their counts as weights. For each of the samples every word draws, from
its hash alone, r and c of a gamma distribution (shape 2) and b of a uniform one; with weight w the word
competes with a = c / exp(r (t - b) + r), t = floor(ln w / r + b), and the smallest a gives (word, t).
Two texts agree in a sample with the probability sum(min(weights)) / sum(max(weights)), the generalised
Jaccard similarity, so the share of equal samples estimates it.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import WordHashes, arrow_map, mixed, words_of

SAMPLES = 128


class Sampler:
    """Fingerprints of many texts at a time, each distinct word's draws made once for all of them."""

    def __init__(self, samples: int = SAMPLES, bound: int = 200_000) -> None:
        self.samples, self.words = samples, WordHashes(bound)
        self.keys = mixed(np.arange(1, samples + 1, dtype=np.int64))

    def draws(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """r, b and ln c - r + r b (the rank of a word of weight one) for each term and sample."""
        r, b, rank = (np.empty((len(terms), self.samples), np.float32) for _ in range(3))
        unit, low = np.float32(2.0**-24), np.uint64(0xFFFFFF)
        for i in range(0, len(terms), 2048):
            one = mixed(terms[i : i + 2048].view(np.uint64)[:, None] ^ self.keys)
            two = mixed(one + np.uint64(0x9E3779B97F4A7C15))
            u = [(((x >> np.uint64(s)) & low).astype(np.float32) + np.float32(0.5)) * unit for x, s in ((one, 0), (one, 24), (two, 0), (two, 24))]
            part = slice(i, i + 2048)
            r[part] = -np.log(u[0] * u[1])
            # sixteen high bits of each draw are left for b
            b[part] = (((one >> np.uint64(48)) << np.uint64(8)) ^ (two >> np.uint64(48))).astype(np.float32) * unit
            rank[part] = np.log(-np.log(u[2] * u[3])) - r[part] + r[part] * b[part]
        return r, b, rank

    def fingerprints(self, bags: list[list[bytes]]) -> np.ndarray:
        """One row of 16-bit samples for each bag of words; all zero for an empty one."""
        parts = [np.unique(self.words.hashes(bag), return_counts=True) for bag in bags]
        terms, at = np.unique(np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int64)]), return_inverse=True)
        r, b, rank = self.draws(terms)
        out = np.zeros((len(bags), self.samples), np.uint16)
        begin, columns = 0, np.arange(self.samples)
        for i, (own, counts) in enumerate(parts):
            rows = at[begin : begin + len(own)]
            begin += len(own)
            if not len(own):
                continue
            a, t = rank[rows], np.zeros(1)
            often = np.flatnonzero(counts > 1)
            steps = np.zeros((len(own), 1), np.float32)
            if len(often):
                w, rr = np.log(counts[often].astype(np.float32))[:, None], r[rows[often]]
                t = np.floor(w / rr + b[rows[often]])
                a[often] -= rr * t
                steps = np.zeros((len(own), self.samples), np.float32)
                steps[often] = t
            best = a.argmin(axis=0)
            step = steps[best, columns if steps.shape[1] > 1 else 0].astype(np.int64).astype(np.uint64)
            out[i] = (mixed(own[best].view(np.uint64) + step * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.uint16)
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def descending_runs(df: DataFrame, parts: int) -> DataFrame:
    """(doc_id, text, _run, _ghost) sorted by descending doc_id within runs that cover the ids from above.

    Each run ends with a copy (_ghost 1) of the row that follows it, so that a task sees every row's
    successor; the last run ends with the first row of all. Bounds come from approximate quantiles, and
    only one row key for each run meets on the driver.
    """
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bounds = sorted(int(x) for x in rows.stat.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.25 / parts)) if parts > 1 else []
    missing, total = rows.agg(F.count(F.when(F.col("doc_id").isNull(), 1)), F.count(F.lit(1))).first()
    # a doc_id that is a bound several times holds as many runs, by the hash of the text; so do missing ones by their share
    unit = 1 - (F.shiftright("_tie", 11).cast("double") / F.lit(float(1 << 53)) + 0.5)
    within = lambda n: F.least(F.floor(unit * n).cast("int"), n - 1)
    upto, several = _below(bounds, False) if bounds else F.lit(0), F.lit(0)
    if len(set(bounds)) < len(bounds):
        times = upto - _below(bounds, True)
        several = F.when(times > 1, within(times)).otherwise(0)
    nulls = F.lit(len(bounds) + 1) + within(F.lit(1 + parts * missing // max(1, total)))
    rows = rows.withColumn("_tie", F.xxhash64("text")).withColumn("_run", F.when(F.col("doc_id").isNull(), nulls).otherwise(F.lit(len(bounds)) - upto + several))
    firsts = sorted((r["_run"], r["top"]) for r in rows.groupBy("_run").agg(F.max(F.struct("doc_id", "_tie")).alias("top")).collect())
    runs = [r for r, _ in firsts]
    heads = [(runs[i - 1], top["doc_id"], top["_tie"]) for i, (_, top) in enumerate(firsts)]
    spark = df.sparkSession
    marks = F.broadcast(spark.createDataFrame(heads, "_to int, _id long, _t long"))  # a row a run
    ghosts = rows.join(marks, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_t"))).select("doc_id", "text", "_tie", F.col("_to").alias("_run"), F.lit(1).alias("_ghost")).dropDuplicates(["_run"])
    both = rows.withColumn("_ghost", F.lit(0)).unionByName(ghosts)
    return both.repartitionByRange("_run").sortWithinPartitions("_run", "_ghost", F.col("doc_id").desc_nulls_last(), F.col("_tie").desc()).select("doc_id", "text", "_run", "_ghost")


def _below(bounds: list[int], strict: bool):
    """How many of the sorted bounds are at most doc_id (strict: below it), looked up by every step-th bound and then among one step of them."""
    under = lambda x: x < F.col("doc_id") if strict else x <= F.col("doc_id")
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.size(F.filter(F.lit(bounds[::step]), under))
    start = F.greatest(coarse - 1, F.lit(0)) * step
    return start + F.size(F.filter(F.slice(F.lit(bounds), start + 1, F.lit(step)), under))


def fingerprint_documents(df: DataFrame, samples: int = SAMPLES, parts: int | None = None) -> DataFrame:
    """Fingerprints of each text of (doc_id, text) and of its edited text, and their likeness.

    The edited text has its last floor(n / 2) code points replaced by as many of the first of the next
    document in descending doc_id (all, if it has fewer); the last is followed by the first. Rows of one
    doc_id follow each other by the hash of their text, null doc_ids come last. Null text: empty, with
    the fingerprint of no words. A single row follows itself. An empty table gives no rows.
    """
    parts = parts or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def make():
        sampler = Sampler(samples)
        names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        held: list[tuple] = []  # rows (doc_id, text, run, ghost) whose successor hasn't come

        def pairs(last: bool):
            """Columns of the held rows that have a successor."""
            done = held[:] if last else held[:-1]
            out = {n: [] for n in names}
            edited = []
            for (_, text, run, ghost), (_, after, run_after, _) in zip(held, held[1:], strict=False):
                half = len(text) // 2
                edited.append(None if ghost or run_after != run else text[: len(text) - half] + after[:half])
            edited += [None] * (len(held) - len(edited))
            bags = [words_of(x[1]) for x in held] + [words_of(x) for x in edited]
            prints = sampler.fingerprints(bags)
            n = len(held)
            for i in range(len(done)):
                if edited[i] is not None:
                    own, then = prints[i], prints[n + i]
                    for name, value in zip(names, (held[i][0], len(held[i][1]), hashlib.sha256(edited[i].encode("utf-8", "surrogatepass")).hexdigest(), own.astype(">u2").tobytes().hex(), then.astype(">u2").tobytes().hex(), likeness(own, then), likeness(own, prints[i + 1])), strict=True):
                        out[name].append(value)
            del held[: len(done)]
            return out

        def work(batch):
            held.extend(zip(batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()], batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True))
            if len(held) > 1:
                yield pairs(False)

        work.finish = lambda: [pairs(True)] if held else []
        return work

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return arrow_map(descending_runs(df, parts), make, schema, rows=512)
