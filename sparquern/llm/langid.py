"""Language identification by interpolated Kneser-Ney character models.

One model a language over the letters of words, each word between blanks, lower-cased. All languages
share sorted arrays of n-gram hashes, with a column of probabilities for each; a word is looked up once
per task and its log-probabilities are kept. The language with the least cross-entropy a character
wins; texts that fit no language better than a calibrated bound are rejected.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import WordIndex, arrow_map, mixed, stored

LETTERS = regex.compile(r"\p{L}+")
DIGIT = re.compile(r"\d")
UNKNOWN = "und"
DISCOUNT = 0.75
FACTORS = mixed(np.arange(1, 17, dtype=np.int64)) | np.uint64(1)


def held_out(modulus: int = 4, remainder: int = 2) -> Column:
    """Whether crc32 of doc_id as text leaves the remainder; a null doc_id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == remainder


def letter_runs(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def language_runs(text: str) -> list[str]:
    """Runs of letters in words without digits: keys, digests and numbers speak no language."""
    return [r for w in text.split() if not DIGIT.search(w) for r in letter_runs(w)]


def _positions(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words as ' word ', the place of each within its word, and where each word starts."""
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    codes = np.frombuffer((" " + "  ".join(words) + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) if words else np.zeros(0, np.uint64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if words else np.zeros(0, np.int64)
    place = np.arange(len(codes)) - np.repeat(starts, sizes)
    return codes, place, starts


def _hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """For each place the hash of the ``order`` code points that end there (rubbish in the first order - 1)."""
    h = np.full(len(codes), order, np.uint64)
    for back in range(order):
        h[back:] += codes[: max(0, len(codes) - back)] * FACTORS[back]
    return mixed(h)


@dataclass
class CharModels:
    """keys[k], ngram[k]: sorted hashes of (k+1)-grams and their discounted probabilities a language;
    contexts[k], backoff[k]: hashes of k-long contexts and the weight they leave to the shorter one."""

    languages: list[str]
    order: int
    base: np.ndarray
    keys: list[np.ndarray]
    ngram: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    bound: float = np.inf

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ln probability of each word's characters with the blank that ends it, by language; their number."""
        codes, place, starts = _positions(words)
        p = np.repeat(self.base[None, :] * self.backoff[0], len(codes), axis=0)
        shorter = np.zeros(0, np.uint64)
        for k in range(self.order):
            h = _hashes(codes, k + 1)
            inside = np.flatnonzero(place >= max(k, 1))
            if k:  # a context that was never seen has no n-grams either
                at, hit = _find(self.contexts[k], shorter[inside - 1])
                inside, at = inside[hit], at[hit]
                p[inside] *= self.backoff[k][at]
            at, hit = _find(self.keys[k], h[inside])
            p[inside[hit]] += self.ngram[k][at[hit]]
            shorter = h
        logs = np.log(np.maximum(p, 1e-30))
        logs[place == 0] = 0
        return np.add.reduceat(logs, starts, axis=0), np.add.reduceat((place > 0).astype(np.int64), starts)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def train(counts: dict[str, Counter], order: int = 4) -> CharModels:
    """counts: by language, how often each run of letters occurs."""
    languages = sorted(counts)
    alphabet = len({c for words in counts.values() for w in words for c in w}) + 2
    n = len(languages)
    raw: list[dict] = [{} for _ in range(order)]  # hashes, their contexts' and their suffixes' hashes, counts
    for li, lang in enumerate(languages):
        words = list(counts[lang])
        weights = np.fromiter(counts[lang].values(), np.float64, len(words))
        codes, place, starts = _positions(words)
        weight = np.repeat(weights, np.fromiter((len(w) + 2 for w in words), np.int64, len(words)))
        own = []
        for k in range(order):
            inside = np.flatnonzero(place >= max(k, 1))
            h = _hashes(codes, k + 1)
            keys, first, inv = np.unique(h[inside], return_index=True, return_inverse=True)
            where = inside[first]
            own.append({"keys": keys, "count": np.bincount(inv, weight[inside], len(keys)), "context": _hashes(codes, k)[where - 1] if k else np.zeros(len(keys), np.uint64), "suffix": _hashes(codes, k)[where] if k else np.zeros(len(keys), np.uint64), "start": place[where] == k})
        for k in range(order):
            # lower orders count the distinct characters before; grams at a word's start have none, and keep their counts
            if k < order - 1 and len(own[k + 1]["keys"]):
                at, hit = _find(own[k]["keys"], own[k + 1]["suffix"])
                before = np.bincount(at[hit], minlength=len(own[k]["keys"])).astype(np.float64)
                own[k]["kn"] = np.where(before > 0, before, own[k]["count"])
            else:
                own[k]["kn"] = own[k]["count"]
        for k in range(order):
            o = own[k]
            groups, inv = np.unique(o["context"], return_inverse=True)
            total = np.bincount(inv, o["kn"], len(groups))
            kinds = np.bincount(inv, minlength=len(groups))
            prob = np.maximum(o["kn"] - DISCOUNT, 0) / total[inv]
            left = np.minimum(1.0, DISCOUNT * kinds / total)
            for name, keys, values in (("g", o["keys"], prob), ("c", groups, left)):
                raw[k].setdefault(name, []).append((li, keys, values))
    tables = {"g": [], "c": []}
    for name, default in (("g", 0.0), ("c", 1.0)):
        for k in range(order):
            found = raw[k].get(name, [])
            keys = np.unique(np.concatenate([f[1] for f in found])) if found else np.zeros(0, np.uint64)
            table = np.full((max(1, len(keys)), n), default, np.float32)
            for li, own_keys, values in found:
                table[np.searchsorted(keys, own_keys), li] = values
            tables[name].append((keys, table))
    return CharModels(languages, order, np.full(n, 1.0 / alphabet, np.float32), [t[0] for t in tables["g"]], [t[1] for t in tables["g"]], [t[0] for t in tables["c"]], [t[1] for t in tables["c"]])


class Scorer:
    """Cross-entropies of texts; each distinct word is scored once, until ``bound`` of them are held."""

    def __init__(self, models: CharModels, bound: int = 200_000) -> None:
        self.models, self.bound, self.index = models, bound, WordIndex()
        self.scores = np.zeros((0, len(models.languages)))
        self.sizes = np.zeros(0, np.int64)

    def entropies(self, texts: list[str]) -> list[tuple[np.ndarray, int]]:
        """For each text the cross-entropy a character by language, and its number of characters."""
        if len(self.index.words) > self.bound:
            self.index.forget()
            self.scores, self.sizes = self.scores[:0], self.sizes[:0]
        rows = [self.index.numbers(t.split()) for t in texts]
        if fresh := self.index.words[len(self.sizes) :]:
            runs = [language_runs(w) for w in fresh]
            flat = [r for rs in runs for r in rs]
            scores, sizes = np.zeros((len(fresh), self.scores.shape[1])), np.zeros(len(fresh), np.int64)
            if flat:
                owner = np.repeat(np.arange(len(fresh)), [len(rs) for rs in runs])
                s, n = self.models.word_scores(flat)
                np.add.at(scores, owner, s)
                np.add.at(sizes, owner, n)
            self.scores, self.sizes = np.concatenate([self.scores, scores]), np.concatenate([self.sizes, sizes])
        out = []
        for own, text in zip(rows, texts, strict=True):
            n, total = int(self.sizes[own].sum()), self.scores[own].sum(axis=0)
            if not n and (runs := letter_runs(text)):  # letters only beside digits
                scores, sizes = self.models.word_scores(runs)
                n, total = int(sizes.sum()), scores.sum(axis=0)
            out.append((-total / max(n, 1), n))
        return out


def calibrate(models: CharModels, best: list[float], quantile: float = 0.999) -> float:
    """Cross-entropy beyond which a text is rejected: midway between what all but 1 - quantile of the
    texts kept for calibration reach (``best``: of each in its own best language) and that of characters drawn at random."""
    if not best:
        return float("inf")
    usual, random = float(np.quantile(best, quantile)), float(-np.log(models.base[0]))
    return usual + 0.5 * max(0.0, random - usual)


def sampled(labelled: DataFrame, rows_a_language: int, rows: int) -> DataFrame:
    """(lang, text, aside) of the rows of least draw of each language, as many of each: ``rows_a_language``, or fewer where
    ``rows`` would not do for all languages, but one at least. Every tenth of a language is set aside. Equal rows count once."""
    spark = labelled.sparkSession
    drawn = labelled.withColumn("draw", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11))
    draws = stored(drawn.select("lang", "draw").distinct(), "draws")
    known = draws.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "lang").limit(rows)
    quota = max(1, min(rows_a_language, rows // max(1, known.count())))
    # twice the quota and some more, so that the quota is among them; only their draws go to the driver
    near = draws.join(F.broadcast(known), "lang").filter(F.col("draw") < F.lit(float(1 << 53) * (2 * quota + 30)) / F.col("_n"))
    found: dict[str, list[int]] = defaultdict(list)
    for r in near.select("lang", "draw").toLocalIterator():
        found[r["lang"]].append(r["draw"])
    taken = [(lang, d, i % 10 == 9) for lang, own in sorted(found.items()) for i, d in enumerate(sorted(own)[:quota])]
    chosen = spark.createDataFrame(taken, "lang string, draw long, aside boolean")
    return stored(drawn.join(F.broadcast(chosen), ["lang", "draw"]).dropDuplicates(["lang", "draw"]).select("lang", "text", "aside"), "sample")


def _runs(sample: DataFrame) -> dict[str, Counter]:
    """By language, how often each run of letters occurs in the texts."""

    def make():
        def work(batch):
            counts: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[lang].update(language_runs(text))
            for lang, c in counts.items():
                yield {"lang": [lang] * len(c), "run": list(c), "n": list(c.values())}

        return work

    counts: dict[str, Counter] = defaultdict(Counter)
    for r in arrow_map(sample, make, "lang string, run string, n long").groupBy("lang", "run").agg(F.sum("n").alias("n")).orderBy("lang", "run").toLocalIterator():
        counts[r["lang"]][r["run"]] = r["n"]
    return dict(counts)


def _best_entropies(sample: DataFrame, models: CharModels, least: int = 40) -> list[float]:
    """Of the texts of at least ``least`` characters the cross-entropy in the best language."""
    shared = sample.sparkSession.sparkContext.broadcast(models)

    def make():
        scorer = Scorer(shared.value)

        def work(batch):
            yield {"h": [float(h.min()) for h, n in scorer.entropies(batch.column(1).to_pylist()) if n >= least]}

        return work

    return [r["h"] for r in arrow_map(sample, make, "h double").collect()]


def fit(df: DataFrame, rows_a_language: int = 1200, rows: int = 20_000, order: int = 4) -> CharModels | None:
    """Models from a bounded sample of the labelled rows of (doc_id, text, lang) that aren't held out.

    The sample: whole texts, by a hash of the row, ``rows_a_language`` of each language, and with many
    languages as many of each as make ``rows`` in all. A tenth of it sets the bound of rejection. None without labelled rows.
    """
    labelled = df.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    sample = sampled(labelled, rows_a_language, rows)
    counts = _runs(sample.filter("not aside"))
    if not counts:
        return None
    models = train(counts, order)
    models.bound = calibrate(models, _best_entropies(sample.filter("aside"), models))
    return models


def predict(texts: list[str | None], scorer: Scorer | None, least: int = 40) -> tuple[list[str], list[float], list[bool], list[float | None]]:
    """Language, confidence, whether rejected, and cross-entropy of each text."""
    langs, scores, rejected, entropy = [], [], [], []
    for h, n in scorer.entropies([t or "" for t in texts]) if scorer else [(np.zeros(1), 0)] * len(texts):
        if not n:
            langs.append(UNKNOWN), scores.append(0.0), rejected.append(True), entropy.append(None)
            continue
        best = int(h.argmin())
        langs.append(scorer.models.languages[best])
        scores.append(float(1 / np.exp(-(h - h[best]) * min(n, 60)).sum()))
        rejected.append(bool(n >= least and h[best] > scorer.models.bound))
        entropy.append(float(h[best]))
    return langs, scores, rejected, entropy


def _identify(df: DataFrame, models: CharModels | None, extra: str, pick) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(models)  # bounded by the sample
    at = df.columns.index("text")

    def make():
        scorer = Scorer(shared.value) if shared.value else None

        def work(batch):
            yield from pick(batch, predict(batch.column(at).to_pylist(), scorer))

        return work

    return arrow_map(df, make, extra)


def identify_languages(df: DataFrame, **parameters) -> DataFrame:
    """Language of each row of (doc_id, text, lang): learned as fit() says, predicted from the text alone.

    Null text or text without a letter: ``und``, score 0, rejected. Without any labelled row all are
    ``und``. score is the share of the winner among the languages' likelihoods a character, over 60
    characters at most. Null doc_ids and repeated rows are predicted like others; no rows, no result.
    """
    models = fit(df, **parameters)
    slim = df.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))

    def pick(batch, found):
        langs, scores, rejected, entropy = found
        yield {"doc_id": batch.column(0), "held_out": batch.column(1), "lang_pred": langs, "score": scores, "rejected": rejected, "cross_entropy": entropy}

    return _identify(slim, models, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean, cross_entropy double", pick)


def drop_unidentified(df: DataFrame, **parameters) -> DataFrame:
    """The rows of df, with all their columns, whose text is not rejected. Where nothing could be learned, all rows with a text stay."""
    models, names = fit(df, **parameters), df.columns
    if models is None:
        return df.filter(F.col("text").isNotNull())

    def pick(batch, found):
        import pyarrow as pa

        kept = batch.filter(pa.array([not r for r in found[2]]))
        yield {c: kept.column(i) for i, c in enumerate(names)}

    return _identify(df, models, df.schema, pick)
