"""Language-model scoring by deleted interpolation.

A model of word n-grams, of order 3 unless told otherwise: P(w | h) is the sum of a f_k(w | h) for each order k
and of a / (V + 1), with maximum-likelihood estimates f_k = count(h, w) / count(h) and weights by the frequency
bucket of the longest context that was seen. The weights come from expectation-maximisation on held-out
counts: the f_k are estimated from all but one part of the training documents (the deleted part), and the
part's own n-grams train the weights.

All n-grams of all training documents count, however rare. Their table is never whole in one place:

* documents lie in blocks of about ``BLOCK`` tokens, stored once as word numbers with the block's own words;
* each block sends its distinct n-grams, sorted and with their counts, to ranges of the key space, so a
  frequent n-gram is one entry a block and no range is larger than others;
* each range adds up its counts and answers each block in the order of its question, by counts alone;
* a block and its answers make the scores of its documents.

What travels is so the distinct n-grams of each block, as differences of sorted keys, and not a row a token.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import WordHashes, arrow_map, free_shuffles, hash_words, mixed, stored, words_of

END = b" end "  # no word holds a blank
START = np.int64(0x51A27)  # stands for the missing context of a document's first token
TINY = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 1 << 18  # tokens of a block; one text is never parted
RANGE = 1 << 20  # tokens for each range of the key space
WIDTH = 40  # buckets of a level: powers of two of the context's count
KEPT, DELETED, OUT = 0, 1, 2
MOST = 4  # the largest order


def remainder(modulus: int = 7) -> Column:
    """crc32 of doc_id as text (null: empty) modulo ``modulus``."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus)).cast("int")


def planes(x: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers as their lowest bytes, then their second ones and so on, as many as the greatest needs, compressed."""
    x = np.ascontiguousarray(x).astype("<u8", copy=False)
    width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    return bytes([width]) + pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes(), "zstd", asbytes=True)


def from_planes(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if width := data[0]:
        out[:, :width] = np.frombuffer(pa.decompress(data[1:], width * n, "zstd", asbytes=True), np.uint8).reshape(width, n).T
    return out.view("<u8").ravel()


def rising(x: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit numbers by their differences."""
    return planes(np.diff(x, prepend=x.dtype.type(0)))


def from_rising(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(from_planes(data, n), dtype=np.uint64)


def joined_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of the n-grams that add a word to those before."""
    with np.errstate(over="ignore"):
        return mixed(mixed(before).view(np.int64) ^ (word.view(np.uint64) * TINY).view(np.int64)).view(np.int64)


def gram_keys(flat: np.ndarray, first: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order the key of the n-gram that ends at each token. ``flat``: word hashes of texts that end
    with END each; ``first``: where texts begin. Before a text stands an END, and before that nothing."""
    keys = [flat]
    for k in range(2, order + 1):
        before = np.roll(keys[-1], 1)
        if k > 2:
            before[first] = START
        keys.append(joined_keys(before, flat))
    return keys


BLOCKS = "block long, part int, doc_ids array<long>, sizes array<long>, n_tokens long, n_words long, words binary, tokens binary"


def blocks_of(df: DataFrame, tokens_a_block: int = BLOCK) -> DataFrame:
    """The rows of (doc_id, part, text) in blocks, each of one part."""

    def make():
        from pyspark import TaskContext

        known = WordHashes(450_000)
        end = hash_words([END])
        task = TaskContext.get().partitionId() << 33
        state = {"block": 0}
        held: dict[int, list[tuple[int | None, np.ndarray]]] = {KEPT: [], DELETED: [], OUT: []}
        size = dict.fromkeys(held, 0)

        def closed(part: int) -> dict[str, list]:
            words, tokens = np.unique(np.concatenate([x for _, x in held[part]]).view(np.uint64), return_inverse=True)
            out = {
                "block": [task + state["block"]], "part": [part], "doc_ids": [[d for d, _ in held[part]]], "sizes": [[len(x) for _, x in held[part]]],
                "n_tokens": [len(tokens)], "n_words": [len(words)], "words": [rising(words)], "tokens": [planes(tokens)],
            }
            state["block"] += 1
            held[part], size[part] = [], 0
            return out

        def work(batch):
            for doc, part, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                held[part].append((doc, np.concatenate([known.hashes(words_of(text)), end])))
                size[part] += len(held[part][-1][1])
                if size[part] >= tokens_a_block:
                    yield closed(part)

        work.finish = lambda: [closed(part) for part in held if held[part]]
        return work

    return arrow_map(df, make, BLOCKS)


@dataclass
class Block:
    """A block's texts as word numbers and as the hashes of their words, and where texts begin."""

    words: np.ndarray
    tokens: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Block:
        return cls(from_rising(row["words"], row["n_words"]).view(np.int64), from_planes(row["tokens"], row["n_tokens"]).view(np.int64), np.array(row["sizes"], np.int64))

    @property
    def first(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def keys(self, order: int) -> list[np.ndarray]:
        return gram_keys(self.words[self.tokens], self.first, order)


ASKED = "kind int, range long, block long, part int, n long, keys binary, times binary"
ANSWERS = "block long, kind int, range long, n long, kept binary, total binary, n_kept long, n_total long, sum_kept long, sum_total long"


def asked(blocks: DataFrame, kinds: range, ranges: int) -> DataFrame:
    """The distinct n-grams of each block of the orders ``kinds`` with their counts, by order and range of the key space."""

    def make():
        def work(batch):
            for row in batch.to_pylist():
                block = Block.of(row)
                grams = block.keys(kinds[-1])
                for k in kinds:
                    keys, times = np.unique(grams[k - 1].view(np.uint64), return_counts=True)
                    at = ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
                    found, starts = np.unique(at, return_index=True)
                    ends = [*starts[1:], len(keys)]
                    yield {
                        "kind": [k] * len(found), "range": found, "block": [row["block"]] * len(found), "part": [row["part"]] * len(found), "n": np.diff([*starts, len(keys)]),
                        "keys": [rising(keys[a:b]) for a, b in zip(starts, ends, strict=True)], "times": [planes(times[a:b]) for a, b in zip(starts, ends, strict=True)],
                    }

        return work

    return arrow_map(blocks.select("block", "part", "sizes", "n_tokens", "n_words", "words", "tokens"), make, ASKED, rows=1)


def answers(questions: DataFrame) -> DataFrame:
    """The counts of the n-grams of each range, for each block in its own order: ``kept`` over the kept part (for
    blocks of the deleted part), ``total`` over all training documents. Sums and numbers of n-grams come once a range."""

    def counted(key, table):
        columns = {c: table.column(c).to_pylist() for c in table.column_names}
        sizes = columns["n"]
        keys = np.concatenate([from_rising(d, n) for d, n in zip(columns["keys"], sizes, strict=True)])
        times = np.concatenate([from_planes(d, n) for d, n in zip(columns["times"], sizes, strict=True)]).astype(np.float64)
        part = np.repeat(np.array(columns["part"]), sizes)
        found, at = np.unique(keys, return_inverse=True)
        kept, total = (np.bincount(at, times * which, len(found)).astype(np.int64) for which in (part == KEPT, part != OUT))
        ends = np.cumsum(sizes)
        slices = [at[e - n : e] for e, n in zip(ends, sizes, strict=True)]
        once = lambda x: [int(x)] + [0] * (len(sizes) - 1)
        out = {
            "block": columns["block"], "kind": columns["kind"], "range": columns["range"], "n": sizes,
            "kept": [planes(kept[s]) if p == DELETED else None for s, p in zip(slices, columns["part"], strict=True)], "total": [planes(total[s]) for s in slices],
            "n_kept": once((kept > 0).sum()), "n_total": once((total > 0).sum()), "sum_kept": once(kept.sum()), "sum_total": once(total.sum()),
        }
        return pa.table({f.name: pa.array(out[f.name], f.type) for f in ANSWER_TYPES}, schema=ANSWER_TYPES)

    # a stated number of partitions stays as it is: small ones, of which a task holds one range at a time
    parts = int(questions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return questions.repartition(parts, "kind", "range").groupBy("kind", "range").applyInArrow(counted, ANSWERS)


def _arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


ANSWER_TYPES = _arrow_schema(ANSWERS)


def counts_of(block: Block, rows: list[dict], which: str, order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each order and token of a block the count of the n-gram that ends there, and that of its context."""
    counts = []
    for k, keys in enumerate(block.keys(order)):
        own = sorted((r["range"], r["n"], r[which]) for r in rows if r["kind"] == k + 1)
        table = np.concatenate([from_planes(data, n) for _, n, data in own]).astype(np.int64)
        counts.append(table[block.tokens] if not k else table[np.unique(keys.view(np.uint64), return_inverse=True)[1]])
    contexts = [np.zeros(len(block.tokens), np.int64)]
    for k in range(1, order):
        contexts.append(np.roll(counts[k - 1], 1))
        if k > 1:  # before a text's first token there is but the END, which stands there once a text
            contexts[k][block.first] = contexts[1][block.first]
    return np.array(counts), np.array(contexts)


def buckets(contexts: np.ndarray) -> np.ndarray:
    """Level and frequency of the longest context that was seen, as one number; 0 if none was."""
    out = np.zeros(contexts.shape[1], np.int64)
    for k in range(1, len(contexts)):
        seen = contexts[k] > 0
        out[seen] = k * WIDTH + np.minimum(np.frexp(contexts[k][seen].astype(np.float64))[1] - 1, WIDTH - 1)
    return out


def likelihoods(counts: np.ndarray, contexts: np.ndarray, total: int) -> np.ndarray:
    """Maximum-likelihood estimates by order and token: of the words, then of those after each context."""
    return counts / np.maximum(1, np.concatenate([np.full((1, counts.shape[1]), total), contexts[1:]]))


def starting_weights(order: int) -> np.ndarray:
    """A row a bucket: the weight of the uniform part, then of each order. Orders without a seen context weigh nothing."""
    out = np.zeros((order * WIDTH, order + 1))
    for k in range(order):
        out[k * WIDTH : (k + 1) * WIDTH, 0] = 0.1
        out[k * WIDTH : (k + 1) * WIDTH, 1 : k + 2] = 0.9 / (k + 1)
    return out


def learn_weights(bucket: np.ndarray, f: np.ndarray, n: np.ndarray, floor: float, order: int, rounds: int = 40) -> np.ndarray:
    """EM over cells: their bucket, estimates (a row an order) and number of tokens; ``floor`` is the uniform part 1 / (V + 1)."""
    start = weights = starting_weights(order)
    if not len(n):
        return weights
    parts = np.concatenate([np.full((1, len(n)), floor), f]).T
    for _ in range(rounds):
        mix = weights[bucket] * parts
        given = mix / mix.sum(axis=1, keepdims=True) * n[:, None]
        # one count of the starting weights keeps buckets without held-out tokens, and every weight in use above zero
        sums = start + np.stack([np.bincount(bucket, given[:, i], len(start)) for i in range(order + 1)], axis=1)
        weights = sums / sums.sum(axis=1, keepdims=True)
    return weights


def binned(f: np.ndarray) -> np.ndarray:
    """Quarters of powers of two, from 1 on, so that EM works on a bounded table: 0 for 0."""
    return np.where(f > 0, np.floor(-np.log2(np.maximum(f, 2.0**-62)) * 4) + 1, 0).astype(np.int64)


def bin_value(b: np.ndarray) -> np.ndarray:
    return np.where(b > 0, 2.0 ** (-(b - 0.5) / 4), 0.0)


def _cells(blocks: DataFrame, found: DataFrame, order: int, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The deleted part's tokens by bucket and bins of the estimates from the kept part: bucket, estimates, number. Bounded by the bins."""

    def cells(key, left, right):
        (row,) = left.to_pylist()
        counts, contexts = counts_of(Block.of(row), right.to_pylist(), "kept", order)
        code = buckets(contexts)
        for b in binned(likelihoods(counts, contexts, total)):
            code = code << 12 | b
        codes, n = np.unique(code, return_counts=True)
        return pa.table({"code": codes, "n": n.astype(np.int64)})

    asked_of = found.filter("kept is not null").select("block", "kind", "range", "n", "kept")
    table = blocks.filter(F.col("part") == DELETED).groupBy("block").cogroup(asked_of.groupBy("block")).applyInArrow(cells, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    # in a fixed order, for the same sums at every run
    code, n = table.column("code").to_numpy(), table.column("n").to_numpy()
    by_code = np.argsort(code)
    code, n = code[by_code], n[by_code]
    f = np.array([bin_value(code >> 12 * (order - 1 - k) & 4095) for k in range(order)]).reshape(order, -1)
    return code >> 12 * order, f, n


@dataclass
class Model:
    """Tokens and distinct tokens of the training documents, and the weights by bucket."""

    total: int
    vocabulary: int
    weights: np.ndarray


def fit(df: DataFrame, order: int = 3, modulus: int = 7, out: int = 2, deleted: int = 6, tokens_a_block: int = BLOCK):
    """The stored blocks of all rows of (doc_id, text), the stored counts of their n-grams over the training documents, and the model."""
    if not 1 <= order <= MOST:
        raise ValueError(f"the order is one of 1 to {MOST}")
    spark = df.sparkSession
    rest = remainder(modulus)
    part = F.when(rest == out, OUT).when(rest == deleted, DELETED).otherwise(KEPT)
    blocks = stored(blocks_of(df.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), F.col("text").cast("string").alias("text")), tokens_a_block), "blocks")
    tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    ranges = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // RANGE))
    found = None
    for kinds in [range(1, min(order, 2) + 1), *[range(k, k + 1) for k in range(3, order + 1)]]:  # one after the other, for less disk at a time
        some = stored(answers(asked(blocks, kinds, ranges)), "gram-counts")
        found = some if found is None else found.unionByName(some)
        free_shuffles(spark)
    sums = found.filter("kind = 1").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("sum_kept", "n_kept", "sum_total", "n_total")]).first()
    bucket, f, n = _cells(blocks, found, order, sums[0])
    free_shuffles(spark)
    return blocks, found, Model(sums[2], sums[3], learn_weights(bucket, f, n, 1.0 / (sums[1] + 1), order))


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(df: DataFrame, order: int = 3, modulus: int = 7, out: int = 2, tokens_a_block: int = BLOCK) -> DataFrame:
    """Scores of each row of (doc_id, text): held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows whose crc32 of doc_id as text isn't ``out`` modulo ``modulus``. Null
    text counts as empty: the end token alone. Null doc_ids and repeated rows are scored one by one. If
    there is nothing to learn from, all tokens are unknown. No rows, no result; other columns are ignored.
    """
    blocks, found, model = fit(df, order, modulus, out, tokens_a_block=tokens_a_block)
    n, v, weights = model.total, model.vocabulary, model.weights

    def scores(key, left, right):
        (row,) = left.to_pylist()
        block = Block.of(row)
        counts, contexts = counts_of(block, right.to_pylist(), "total", order)
        lam = weights[buckets(contexts)].T
        p = lam[0] / (v + 1) + (lam[1:] * likelihoods(counts, contexts, n)).sum(axis=0)
        first = block.first
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": np.full(len(first), row["part"] == OUT), "n_tokens": block.sizes,
            "n_known": np.add.reduceat(counts[0] > 0, first, dtype=np.int64), "train_tokens": np.full(len(first), n, np.int64),
            "base_score": np.add.reduceat(np.log10((counts[0] + 1) / (n + v + 1)), first), "score": np.add.reduceat(np.log10(p), first),
        }, schema=_arrow_schema(SCORES))

    asked_of = found.select("block", "kind", "range", "n", "total")
    return blocks.groupBy("block").cogroup(asked_of.groupBy("block")).applyInArrow(scores, SCORES)
