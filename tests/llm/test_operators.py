"""Each operator against a plain version in Python, and on nulls, empty texts, repeated rows, empty tables and extra columns."""

from __future__ import annotations

import hashlib
import io
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from sparquern.llm import fingerprints, langid, mixing, neardup, ngrams, packing, secretscan, sharding, tokenfiles, topk
from sparquern.llm.queries import ORACLES, QUERIES
from sparquern.llm.tokens import SpacedPieces, WordPieces, vocabulary_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component string, rank int, row_number long"
WORDS = [f"{a}{b}{c}" for a in ("ba", "ko", "ri", "ten") for b in ("la", "mu", "se") for c in ("n", "sh", "to", "")]


def sample_rows(n: int = 60, seed: int = 3):
    """Texts with exact and near copies, nulls, empty and blank texts, a very long one, repeated rows and null ids."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.choice([1, 3, 5, 40, 200]))]
        rows.append([i, " ".join(words), rng.choice(["aa", "bb", None]), rng.choice(["s1", "s2", None]), None, "x", 1, 7])
    rows[5][1] = rows[4][1]
    rows[7][1] = rows[4][1].upper()
    long = " ".join(rng.choice(WORDS) for _ in range(20_000))
    rows[8][1], rows[9][1], rows[10][1], rows[11][1] = None, "", " \t\n ", long
    base = [rng.choice(WORDS) + str(j) for j in range(120)]
    for k in range(12, 22):  # near copies, each with a word of its own
        own = list(base)
        own[k] = f"own{k}"
        rows[k][1] = "  ".join(own)
    rows[30][1] = "É ß ñ 123 'tis   a\ttab\n\nlines "
    rows += [list(rows[4]), list(rows[4]), [None, rows[4][1], "aa", "s1", 1, "x", 1, 7], [None, None, None, None, None, None, None, None]]
    return [tuple(r) for r in rows]


@pytest.fixture(scope="module")
def rows():
    return sample_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def key(x):
    return (x is not None, x if x is not None else 0)


def words(text):
    return (text or "").encode().lower().split()


# 1 packing


def test_packing_covers_each_id_once_without_padding(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    out = packing.pack_documents(docs).collect()
    expected = Counter()
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        expected[(r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    assert {r["doc_id"] for r in out} == {r[0] for r in rows}
    by_id = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in rows if r[0] is not None}
    pieces = defaultdict(list)
    for r in out:
        assert 1 <= r["length"] <= 1024
        if r["doc_id"] is not None:
            ids = by_id[r["doc_id"]]
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
            pieces[r["doc_id"]].append((r["start"], r["length"]))
    copies = Counter(r[0] for r in rows)
    for doc, own in pieces.items():
        assert sum(n for _, n in own) == copies[doc] * len(by_id[doc])
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding <= 0.02 * sum(r["length"] for r in out)


def test_bins_are_harmonic():
    bins = packing.HarmonicBins(1024, 0)
    put = lambda doc, n: bins.put((doc, 0, b"\0" * 4 * n, n))
    rows = [r[:3] + r[5:7] for i, n in enumerate([2500, 300, 300, 300, 90]) for r in put(i, n)]
    # two whole sequences, then three of class 3 (the rest of 2500, 452, is of class 2) and a filler cut to fit
    assert rows == [(0, 0, 1024, 0, 0), (0, 1024, 1024, 1, 0)]
    assert [len(v) for v in bins.open.values()] == [1] and list(bins.open) == [2]
    assert packing.length(bins.filler or (0, 0, b"", 0)) == 0 and sum(map(packing.length, bins.waiting)) == 990
    rows = put(5, 50)
    assert [(r[0], r[1], r[2], r[6]) for r in rows] == [(1, 0, 300, 0), (2, 0, 300, 300), (3, 0, 300, 600), (4, 0, 90, 900), (5, 0, 34, 990)]
    left = bins.finish()
    assert sum(r[2] for r in left) == 452 + 16 and Counter(r[5] for r in left)
    sizes = Counter()
    for r in left:
        sizes[r[5]] += r[2]
    assert sorted(sizes.values(), reverse=True) == [256, 128, 64, 16, 4]


@pytest.mark.parametrize("seed", range(5))
def test_most_documents_stay_whole(seed):
    rng = random.Random(seed)
    bins, rows, sizes = packing.HarmonicBins(1024, 0), [], {}
    for i in range(3000):
        sizes[i] = rng.choice([1, 7, 60, 200, 500, 513, 1023, 1024, 3000, rng.randint(1, 2000)])
        rows += bins.put((i, 0, np.arange(sizes[i], dtype="<u4").tobytes(), sizes[i]))
    rows += bins.finish()
    pieces, filled = Counter(r[0] for r in rows), Counter()
    for doc, start, n, crc, tokens, seq, offset, _ in rows:
        assert tokens == sizes[doc] and offset == filled[seq] and crc == zlib.crc32(np.arange(start, start + n, dtype="<u4").tobytes())
        filled[seq] += n
    assert sum(filled.values()) == sum(sizes.values())
    short = [n for n in filled.values() if n < 1024]
    assert all(n & (n - 1) == 0 for n in short) and len(short) <= 10
    whole = sum(pieces[i] == -(-n // 1024) for i, n in sizes.items())
    assert whole > 0.6 * len(sizes)


def test_packing_nothing(nothing):
    assert packing.pack_documents(nothing).count() == 0


@pytest.mark.parametrize(("kind", "name"), [(SpacedPieces, "byte_bpe_50k.json"), (WordPieces, "word_bpe_49k.json")])
def test_pieces_equal_whole_encodings(kind, name):
    """As the library encodes with add_special_tokens=False and nothing else set, added tokens within texts too."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary_path(name))
    rng = random.Random(1)
    alphabet = [*" \n\t\r  aAbBéÉßİıŉſ×÷ñ,.'’  \x1c\x85\x0b\x00中é123'sS'llĀɏ́😀ǅªº", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>"]
    pieces = kind(vocabulary_path(name), bound=50)
    for _ in range(2500):
        text = "".join(rng.choices(alphabet, [1] * (len(alphabet) - 5) + [0.3] * 5, k=rng.randint(0, 30)))
        assert pieces.ids(text) == np.asarray(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


# 2 fingerprints


def test_fingerprints_edit_by_the_next_document(docs, rows):
    out = fingerprints.fingerprint_documents(docs, parts=3).collect()
    assert len(out) == len(rows)
    ordered = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0])
    prints, first = {}, {}
    for r in out:
        first.setdefault(r["doc_id"], r)
    distinct = list(dict.fromkeys((r[0], r[1]) for r in ordered))
    for (doc, text), (_, after) in zip(distinct, distinct[1:], strict=False):
        if doc == 4:  # repeated rows follow each other
            continue
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert first[doc]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert first[doc]["n_chars"] == len(text)
    for r in out:
        text = "" if r["doc_id"] is None else next(x[1] or "" for x in rows if x[0] == r["doc_id"])
        if r["doc_id"] is not None:
            assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_hot_doc_ids_and_missing_ones_are_split(spark, parts):
    """All rows of equal and of null doc_id follow each other by hash; runs split them, and results stay the same."""
    rows = [(None if i % 3 == 0 else 50 if i % 3 == 1 else i, f"w{i} v{i % 7} common", 1) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _run int").repartition(5)
    runs = fingerprints.descending_runs(df, parts).filter("_ghost = 0").groupBy("_run").count().collect()
    assert parts < 9 or max(r["count"] for r in runs) < 200
    out = fingerprints.fingerprint_documents(df, parts=parts).collect()
    assert len(out) == 600
    tie = {r["text"]: r["t"] for r in df.selectExpr("text", "xxhash64(text) as t").collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -tie[r[1]]))
    edited = [a[1][: len(a[1]) - len(a[1]) // 2] + b[1][: len(a[1]) // 2] for a, b in zip(ordered, ordered[1:] + ordered[:1], strict=True)]
    assert Counter(r["edited_sha256"] for r in out) == Counter(hashlib.sha256(t.encode()).hexdigest() for t in edited)
    sampler = fingerprints.Sampler()
    want = [sampler.fingerprints([words(t)])[0].astype(">u2").tobytes().hex() for t in edited]
    assert Counter(r["edited_fingerprint"] for r in out) == Counter(want)


def plain_fingerprint(text, samples):
    """Each word's gamma draws one by one in double precision, and the sample of least rank."""
    from sparquern.llm.shared import hash_words, mixed

    out = []
    counts = Counter(words(text))
    for s in range(samples):
        key_ = mixed(np.array([s + 1], np.int64))
        best = None
        for w, n in counts.items():
            term = hash_words([w]).view(np.uint64)
            one = int(mixed(term ^ key_)[0])
            two = int(mixed(np.array([(one + 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
            u = [((x >> at & 0xFFFFFF) + 0.5) / 2**24 for x, at in ((one, 0), (one, 24), (two, 0), (two, 24))]
            r, c, b = -math.log(u[0] * u[1]), -math.log(u[2] * u[3]), ((one >> 48 << 8) ^ (two >> 48)) / 2**24
            t = math.floor(math.log(n) / r + b)
            rank = math.log(c) - r * (t - b) - r
            if best is None or rank < best[0]:
                best = rank, int(mixed(np.array([(int(term[0]) + t * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0]) >> 48
        out.append(best[1] if best else 0)
    return out


def test_fingerprints_equal_plain_ones():
    """But for samples whose two least ranks lie closer than single precision tells apart."""
    rng = random.Random(31)
    sampler = fingerprints.Sampler(64)
    texts = [" ".join(rng.choices(WORDS, k=n)) for n in (0, 1, 5, 60, 300)]
    got = sampler.fingerprints([words(t) for t in texts])
    for t, g in zip(texts, got, strict=True):
        assert sum(int(a) != b for a, b in zip(g, plain_fingerprint(t, 64), strict=True)) <= 1


def test_collision_rate_is_generalised_jaccard():
    rng = random.Random(2)
    sampler = fingerprints.Sampler(2048)
    for _ in range(6):
        a = Counter(rng.choices(WORDS, k=60))
        b = Counter({w: n + rng.choice([0, 0, 1, 3]) for w, n in a.items() if rng.random() < 0.8})
        truth = sum(min(a[w], b[w]) for w in WORDS) / sum(max(a[w], b[w]) for w in WORDS)
        p = sampler.fingerprints([[w.encode() for w in a.elements()], [w.encode() for w in b.elements()]])
        assert abs(fingerprints.likeness(p[0], p[1]) - truth) < 5 * math.sqrt(0.25 / 2048)


def test_fingerprints_of_nothing_and_of_one(spark, nothing):
    assert fingerprints.fingerprint_documents(nothing, parts=3).count() == 0
    one = fingerprints.fingerprint_documents(spark.createDataFrame([(1, "ab cd")], "doc_id long, text string")).collect()
    assert [(r["near_next"], r["n_chars"], r["edited_sha256"]) for r in one] == [(1.0, 5, hashlib.sha256(b"ab ab").hexdigest())]


# 3 near duplicates


def plain_components(rows, percent=75, width=5):
    sets = {}
    for i, r in enumerate(rows):
        w = words(r[1])
        sets[i] = {tuple(w[j : j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    usable = [i for i in range(len(rows)) if sets[i] and rows[i][0] is not None]
    for a in usable:
        for b in usable:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[top(b)] = top(a)
    least = {}
    for i in usable:
        least[top(i)] = min(least.get(top(i), rows[i][0]), rows[i][0])
    return [(r[0], len(sets[i]), None if r[0] is None else least[top(i)] if i in usable else r[0]) for i, r in enumerate(rows)]


def test_near_duplicates_equal_all_pairs(docs, rows):
    out = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs).collect()]
    assert sorted(out, key=lambda x: (key(x[0]), x[1])) == sorted(plain_components(rows), key=lambda x: (key(x[0]), x[1]))


@pytest.mark.parametrize("hot", [4, 32])
def test_long_lists_lose_no_link(spark, hot):
    """A passage in most documents, a chain of copies that drift apart, and copies of two kinds; lists over ``hot`` go in blocks."""
    rng = random.Random(5)
    passage = [f"p{j}" for j in range(60)]
    rows = [(i, " ".join([f"u{i}x{j}" for j in range(rng.choice([8, 15, 40, 150]))] + passage)) for i in range(50)]
    base = [f"b{j}" for j in range(200)]
    for i in range(50, 80):  # each differs from the last in few places, the ends in many
        base[(7 * i) % 200] = f"c{i}"
        base[(11 * i) % 200] = f"d{i}"
        rows.append((i, " ".join(base)))
    other = [f"b{j}" if j < 120 else f"z{j}" for j in range(200)]
    rows += [(i, " ".join(other[:-1] + [f"e{i}"])) for i in range(80, 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df, hot=hot).collect())
    assert out == sorted(plain_components(rows))


def test_near_duplicates_of_nothing(nothing):
    assert neardup.near_duplicates(nothing).count() == 0


def test_dropping_near_duplicates_keeps_columns_and_one_of_each(docs, rows):
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    expected = {c for d, _, c in plain_components(rows) if d is not None}
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(expected) and got.count(None) == 2


@pytest.mark.parametrize("parts", [1, 2, 3, 5])
def test_one_doc_id_for_different_texts(spark, parts):
    """Each row is judged by its own text, however the rows lie; nothing unique is dropped."""
    a, b, c = (" ".join(f"{x}{j}" for j in range(40)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (7, b + " more"), (3, c), (3, c + " more"), (3, a + " more"), (9, None), (9, ""), (9, " "), (None, a), (None, a)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, _id string, number int").repartition(parts)
    out = sorted((key(r["doc_id"]), r["n_shingles"], key(r["component_id"])) for r in neardup.near_duplicates(df).collect())
    assert out == sorted((key(d), n, key(c)) for d, n, c in plain_components(rows))
    kept = Counter((r["doc_id"], r["text"]) for r in neardup.drop_near_duplicates(df).collect())
    assert kept.pop((5, b)) == 1 and kept.pop((1, a)) == 1 and kept.pop((None, a)) == 2
    assert [kept.pop((9, t)) for t in (None, "", " ")] == [1, 1, 1]
    assert len(kept) == 1 and set(kept) <= {(3, c), (3, c + " more")}


def test_blocks_of_many_shingles_take_little_memory():
    """512 sets of 20,000 values in pairs: columns are taken some at a time."""
    import tracemalloc

    rng = np.random.default_rng(3)
    sets = [np.sort(rng.integers(-(2**62), 2**62, 20_000)) for _ in range(256)]
    tracemalloc.start()
    out = neardup._block_links(list(range(256)), list(range(256)), sets, list(range(256, 512)), list(range(256, 512)), sets, 75)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(zip(out["a"], out["b"], strict=True)) == [(i, i + 256) for i in range(256)] and peak < 1 << 30


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    found = dict(map(tuple, neardup.components(links).collect()))
    assert {i: found[i] for i in range(31)} == dict.fromkeys(range(31), 0) and found[101] == found[100] == 100


# 4 top k


def plain_top_k(rows, k=10, every=100):
    usable = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v and None not in v and all(math.isfinite(x) for x in v)]
    out = []
    for q, x in {i: min(v for j, v in usable if j == i) for i, _ in usable if i % every == 0}.items():
        scored = sorted(((-min(sum(a * b for a, b in zip(x, v, strict=True)), 2**63 - 1), i) for i, v in usable if i != q and len(v) == len(x)))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def test_top_k_is_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(350)]
    rows[3] = (3, None)
    rows[4] = (4, [1.0, None, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0])
    rows[5] = (5, [float("nan")] * 8)
    rows[6] = (6, [float("inf")] * 8)
    rows[7] = (7, [])
    rows[8] = (8, [1.0, 2.0, 3.0])
    rows[200] = (200, [0.0] * 8)  # all scores tie
    rows += [(None, [9.0] * 8), (11, list(rows[11][1])), (300, [5.0, 1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, query_id string, score int").repartition(4)
    narrow = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows if not (i == 300 and len(v) == 3)]
    out = sorted(map(tuple, topk.top_k(df.filter("not (vec_id = 300 and size(embedding) = 3)")).collect()))
    assert out == plain_top_k(narrow)
    assert sorted(map(tuple, topk.top_k(df.filter("not (vec_id = 300 and size(embedding) = 3)"), query_bytes=64).collect())) == out


def test_top_k_with_huge_components_and_without_rows(spark):
    rows = [(i, [float(10**9 * (i % 7) + 0.5), 1.0, -2.0]) for i in range(0, 300, 10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, k=3).collect())) == plain_top_k(rows, 3)
    assert topk.top_k(df.limit(0)).count() == 0


def test_top_k_beyond_doubles(spark):
    """Components whose 1024-fold is no double any more; scores stop at the ends of a long."""
    rows = [(100, [1e306, 1.0]), (200, [-1e306, 2.0]), (300, [1.7e308, 0.0]), (1, [0.0, 5.0]), (2, [1e-9, -5.0]), (3, [0.5, 0.25])]
    out = sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=2).collect()))
    wide = {i: [math.floor(1024 * Fraction(x)) for x in v] for i, v in rows}
    expected = []
    for q in (100, 200, 300):
        scored = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(wide[q], v, strict=True)))), i) for i, v in wide.items() if i != q)[:2]
        expected += [(q, n + 1, i, -x) for n, (x, i) in enumerate(scored)]
    assert out == sorted(expected)


def test_bounds_hold_scores():
    rng = np.random.default_rng(0)
    x, q = np.floor(1000 * rng.normal(size=(200, 6))), np.floor(1000 * rng.normal(size=(9, 6)))
    a = topk.Approximation(x.min(axis=0), x.max(axis=0), 8)
    lower = a.lower(a.codes(x), q)
    assert (lower <= x @ q.T).all() and (x @ q.T <= lower + a.gap(q)).all()


def test_few_exact_vectors_are_read(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(rng.normal(size=(4000, 16)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    grids = topk.grid(df)
    cells = {16: topk.Approximation(*grids[16])}
    vectors = topk.approximated(df, cells)
    queries = {16: (np.array([0, 100]), np.floor(1024 * np.array([rows[0][1], rows[100][1]], np.float32).astype(np.float64)))}
    found = topk._scan(vectors, queries, cells, 10)
    assert 20 <= found.count() < 0.05 * 2 * len(rows)
    assert "embedding" not in found._jdf.queryExecution().executedPlan().toString().split("ReadSchema:")[1]


# 5 secrets

HEX40, UUID, RANDOM = "0123456789abcdef0123456789abcdef01234567", "123e4567-e89b-12d3-a456-426614174000", "xK9fQ2vLz8RtW4mNp7YsB3hJc6DgEa1U"
SECRETS = [
    ("a password=hunter2hunter2 b", "assign:2:25"), ("password = short token: \"abcdefgh12\"", "assign:17:35"), ("API_KEY='Zz9/Zz9+Zz9=' x", "assign:0:21"), ("é AKIAABCDEFGHIJKL.", "access:2:18"), ("AKIASHORT", ""),
    (f"sum {HEX40}", "hex:4:44"), (f"id {UUID} ok", ""), (f"key {RANDOM}!", "random:4:36"), ("internationalization_of_everything and antidisestablishmentarianism", ""), (None, ""), ("", ""),
    ("token=secret=abcdefgh", "assign:0:21"), ("paſſword=abcdefghij", ""),
]


def test_secrets(spark):
    df = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(SECRETS)], "doc_id long, text string, spans string")
    out = {r["doc_id"]: r for r in secretscan.scan_secrets(df).collect()}
    for i, (_, spans) in enumerate(SECRETS):
        assert out[i]["spans"] == spans, SECRETS[i]
        base = ",".join(s for s in spans.split(",") if s and not s.startswith("random"))
        assert out[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert out[i]["n_assign"] == spans.count("assign") and out[i]["n_access"] == spans.count("access") and out[i]["n_hex"] == spans.count("hex")


def test_secrets_of_nothing_of_repeated_rows_and_of_long_texts(spark, nothing):
    import time

    assert secretscan.scan_secrets(nothing).count() == 0 and secretscan.redact_secrets(nothing).count() == 0
    long = "word " * 400_000 + f"password=hunter2hunter2 {RANDOM} " + "a" * 200_000 + "1 " + "aB" * 100_000 + "9"
    df = spark.createDataFrame([(1, long), (2, SECRETS[0][0]), (2, SECRETS[0][0]), (None, SECRETS[0][0])], "doc_id long, text string")
    began = time.monotonic()
    out = Counter((r["doc_id"], r["n_assign"], r["spans"][:50]) for r in secretscan.scan_secrets(df).collect())
    assert time.monotonic() - began < 60
    assert out[2, 1, "assign:2:25"] == 2 and out[None, 1, "assign:2:25"] == 1
    assert next(k for k in out if k[0] == 1)[2].startswith("assign:2000000:2000023,random:2000024:2000056")


def test_base_spans_equal_the_stated_patterns():
    rng = random.Random(6)
    pattern = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for _ in range(3000):
        text = "".join(rng.choice(["token", "api_key", "AKIA", "a" * 9, "=", ":", " ", '"', "0123456789abcdef", "QQQQ", "!", "é"]) for _ in range(12))
        plain = [(0, m.start(), m.end()) for m in pattern.finditer(text) if len(m[2]) >= 8] + [(1, m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        plain += [(2, m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
        assert secretscan.base_spans(text) == plain


def test_redaction(docs, spark):
    df = spark.createDataFrame([(i, t, len(t or "")) for i, (t, _) in enumerate(SECRETS)], "doc_id long, text string, n_chars long")
    out = {r["doc_id"]: r for r in secretscan.redact_secrets(df).collect()}
    assert out[0]["text"] == "a [SECRET] b" and out[0]["n_chars"] == 12 and out[9]["text"] is None and out[8]["text"] == SECRETS[8][0]
    assert all(r["spans"] == "" for r in secretscan.scan_secrets(secretscan.redact_secrets(df)).collect())
    same = secretscan.redact_secrets(docs)
    assert same.columns == docs.columns and same.exceptAll(docs).count() == 0


def test_secrets_beside_base_matches(spark):
    key = "wJa1rXUt9nFEMIK7MDENGbPxRf2CYzEX4MPLEKEY"
    texts = [f"AKIAABCDEFGHIJKL/{key} x", f"{HEX40[:32]}-{RANDOM} y", f"{RANDOM}_{HEX40[:32]}", f"{HEX40[:32]}-{UUID} z", "internationalization_of_token=hunter2hunter2"]
    wanted = ["access:0:16,random:17:57", "hex:0:32,random:33:65", "random:0:32,hex:33:65", "hex:0:32", "assign:24:44"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["spans"] for r in secretscan.scan_secrets(df).collect()}
    assert [out[i] for i in range(len(texts))] == wanted
    shown = {r["doc_id"]: r["text"] for r in secretscan.redact_secrets(df).collect()}
    assert not any(key in shown[i] or RANDOM in shown[i] for i in shown)


def test_exclusions_take_linear_time():
    """A backtracking pattern would need some 2 ** 26 steps for each."""
    import time

    began = time.process_time()
    for text in ("a" * 26 + "1", "ab-" * 26 + "1", "gH" * 13 + "g" * 13 + "1", "A-" * 26 + "1", "a" * 5000 + "1"):
        assert not secretscan.KNOWN.fullmatch(text)
    assert time.process_time() - began < 0.5
    rng = random.Random(14)
    before = re.compile(secretscan.KNOWN.pattern.replace("?+", "?").replace("*+", "*").replace("}+", "}").replace("++", "+"))
    for _ in range(20_000):
        text = "".join(rng.choices("aabBC-_1f", k=rng.randint(1, 12)))
        assert bool(secretscan.KNOWN.fullmatch(text)) == bool(before.fullmatch(text)), text


# 6 language-model scores


def test_scores(docs, rows):
    out = ngrams.score_documents(docs).collect()
    assert len(out) == len(rows)
    rest = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7
    counts = Counter(w for r in rows if rest(r[0]) != 2 for w in [*words(r[1]), b" "])
    n, v = sum(counts.values()), len(counts)
    expected = sorted((key(r[0]), rest(r[0]) == 2, len(words(r[1])) + 1, sum(w in counts for w in [*words(r[1]), b" "]), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*words(r[1]), b" "]), 6)) for r in rows)
    got = sorted((key(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out)
    assert got == expected
    long = next(r for r in out if r["n_tokens"] > 1000)
    assert long["score"] > long["base_score"]
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in out)


def plain_scores(rows, model, order=3):
    """Log probabilities from plain counts of all n-grams, with the weights of the model."""
    rest = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7
    counts = [Counter() for _ in range(order)]

    def grams(text):
        tokens = [None, " ", *words(text), " "]
        for i in range(2, len(tokens)):
            yield [tuple(tokens[max(0, i - k) : i + 1]) for k in range(order)]

    for r in rows:
        if rest(r[0]) != 2:
            for own in grams(r[1]):
                for k, g in enumerate(own):
                    counts[k][g] += 1
    contexts = [Counter() for _ in range(order)]
    for k in range(order):
        for g, c in counts[k].items():
            contexts[k][g[:-1]] += c
    v = len(counts[0])

    def p(own):
        level = max([0, *[k for k in range(1, order) if contexts[k][own[k][:-1]]]])
        lam = model.weights[level * ngrams.WIDTH + contexts[level][own[level][:-1]].bit_length() - 1 if level else 0]
        return lam[0] / (v + 1) + sum(lam[k + 1] * counts[k][own[k]] / max(1, contexts[k][own[k][:-1]]) for k in range(order))

    return p, [sum(math.log10(p(own)) for own in grams(r[1])) for r in rows]


@pytest.mark.parametrize(("order", "block"), [(3, 1 << 19), (3, 700), (2, 300), (1, 5000), (4, 1000)])
def test_scores_equal_a_plain_model(spark, order, block):
    """Any order, and blocks of any size, give the scores of plain counts over all n-grams."""
    rng = random.Random(12)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 40, 90])))) for i in range(200)] + [(None, "w1 w2"), (3, None), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = ngrams.fit(df, order, tokens_a_block=block)[2]
    assert np.allclose(model.weights.sum(axis=1), 1)
    _, expected = plain_scores(rows, model, order)
    got = sorted((key(r["doc_id"]), round(r["score"], 9)) for r in ngrams.score_documents(df, order, tokens_a_block=block).collect())
    want = sorted((key(r[0]), round(x, 9)) for r, x in zip(rows, expected, strict=True))
    assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want], rtol=1e-9, atol=1e-8)


def test_model_is_a_distribution(spark):
    """Over all known words and the unknown one the probabilities after each context sum to one."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(WORDS[:12], k=30))) for i in range(80)]
    p, _ = plain_scores(rows, ngrams.fit(spark.createDataFrame(rows, "doc_id long, text string"))[2])
    vocabulary = [w.encode() for w in WORDS[:12]]
    for before in ([None, " "], [" ", vocabulary[0]], [vocabulary[1], vocabulary[2]], [b"new", vocabulary[3]], [b"new", b"newer"]):
        total = sum(p([(w,), (before[1], w), (*before, w)]) for w in [*vocabulary, " ", b"never seen"])
        assert abs(total - 1) < 1e-9


def test_weights_come_from_the_deleted_part(spark):
    """EM over the plain cells of the deleted part gives the weights."""
    rng = random.Random(15)
    rows = [(i, " ".join(rng.choices(WORDS[:20], k=50))) for i in range(120)]
    model = ngrams.fit(spark.createDataFrame(rows, "doc_id long, text string"), 2)[2]
    rest = lambda d: zlib.crc32(str(d).encode()) % 7
    one, two, context = Counter(), Counter(), Counter()
    steps = lambda t: list(zip([" ", *words(t)], [*words(t), " "], strict=True))
    for i, t in rows:
        if rest(i) not in (2, 6):
            for h, w in steps(t):
                one[w] += 1
                two[h, w] += 1
                context[h] += 1
    n = sum(one.values())
    cells = [(ngrams.WIDTH + context[h].bit_length() - 1 if context[h] else 0, one[w] / n, two[h, w] / max(1, context[h])) for i, t in rows if rest(i) == 6 for h, w in steps(t)]
    rough = lambda f: ngrams.bin_value(ngrams.binned(np.array(f)))
    wanted = ngrams.learn_weights(np.array([c[0] for c in cells]), np.stack([rough([c[1] for c in cells]), rough([c[2] for c in cells])]), np.ones(len(cells)), 1 / (len(one) + 1), 2)
    assert np.allclose(model.weights, wanted, atol=1e-9)


def test_planes_round_trip():
    for x in ([], [0], [0, 0], [1, 255, 256], [2**64 - 1, 0, 7]):
        assert ngrams.from_planes(ngrams.planes(np.array(x, np.uint64)), len(x)).tolist() == x
        assert ngrams.from_rising(ngrams.rising(np.array(sorted(x), np.uint64)), len(x)).tolist() == sorted(x)


def test_em_raises_likelihood():
    bucket, f, n = np.array([45, 45, 80]), np.array([[0.1, 0.2, 0.01], [0.5, 0.0, 0.0], [0.2, 0.1, 0.0]]), np.array([10, 5, 3])
    weights = ngrams.learn_weights(bucket, f, n, 0.001, 3)
    score = lambda w: float((n * np.log(w[bucket, 0] * 0.001 + (w[bucket, 1:].T * f).sum(axis=0))).sum())
    assert score(weights) > score(ngrams.starting_weights(3)) and np.allclose(weights.sum(axis=1), 1)


def test_scores_of_nothing_and_without_training(spark, nothing):
    assert ngrams.score_documents(nothing).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (r,) = ngrams.score_documents(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (True, 3, 0, 0, 0.0)


# 7 shards


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 40, 41, 1000])
def test_feistel_is_a_permutation(spark, n):
    from pyspark.sql import functions as F

    out = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 5)).collect()]
    assert sorted(out) == list(range(n))
    assert n < 40 or out != sorted(out)


def plain_feistel(x, n, key, rounds=6):
    p, state, found = 2**31 - 1, key, []
    for _ in range(4 * rounds):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        found.append((state >> 33) % p)
    add, times = found[: 2 * rounds], found[2 * rounds :]
    f = lambda v, i: ((pow(v + add[i], 2, p) + v * times[i]) % p) ** 2 % p
    a = math.isqrt(max(n - 1, 0)) + 1
    b = -(-n // a)
    while True:
        left, right = x % a, x // a
        for i in range(rounds):
            left = (left + f(right, i)) % a
            right = (right + f(left, i + rounds)) % b
        x = right * a + left
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 5, 1000, 3_000_017, 2**40 + 7])
def test_feistel_equals_a_plain_one(spark, n):
    from pyspark.sql import functions as F

    rng = random.Random(n)
    numbers = [rng.randrange(n) for _ in range(50)] + [0, n - 1]
    out = spark.createDataFrame([(x,) for x in numbers], "x long").select("x", sharding.permuted(F.col("x"), n, 99).alias("p")).collect()
    assert all(r["p"] == plain_feistel(r["x"], n, 99) for r in out)


def test_shards(docs, rows, nothing):
    out = sharding.shard_documents(docs).collect()
    sizes = Counter(r["shard"] for r in out)
    assert len(out) == len(rows) and max(sizes.values()) - min(sizes[s] for s in range(40)) <= 1
    for s in range(40):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sizes[s]))
    assert sorted((key(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == sorted((key(r[0]), len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    again = sharding.shard_documents(docs.repartition(3)).select("doc_id", "size", "shard", "slot")
    assert Counter(map(tuple, again.collect())) == Counter((r["doc_id"], r["size"], r["shard"], r["slot"]) for r in out)
    assert sharding.shard_documents(nothing).count() == 0


# 8 languages


def test_languages(spark, nothing):
    rng = random.Random(9)
    kinds = {"aa": ["tion", "ing", "the", "and"], "bb": ["schei", "keit", "ung", "zu"], "cc": ["ção", "ñoa", "élle"]}
    make = lambda k, n: " ".join("".join(rng.choices(kinds[k], k=rng.randint(1, 3))) for _ in range(n))
    rows = [(i, make(k, 30), k if i % 9 else None, "s") for i, k in enumerate(rng.choices(list(kinds), k=300))]
    truth = {i: (lambda t: next(k for k in kinds if any(s in t for s in kinds[k][:2])))(t) for i, t, _, _ in rows}
    rows += [(1000, None, "aa", "s"), (1001, "", "aa", "s"), (1002, "12 34 !!", "bb", "s"), (1003, "a1", "aa", "s"), (1005, "½ ² Ⅷ ①", "aa", "s"), (1004, " ".join("qxzjwvkq"[j % 8] * 5 + "xqzj" for j in range(40)), None, "s"), (None, make("aa", 20), None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r["doc_id"]: r for r in langid.identify_languages(df).collect()}
    assert len(out) == len(rows)
    assert sum(out[i]["lang_pred"] == truth[i] for i in truth) >= 0.98 * len(truth)
    for i in truth:
        assert out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and not out[i]["rejected"] and 0 <= out[i]["score"] <= 1
    assert [out[i]["lang_pred"] for i in (1000, 1001, 1002, 1005)] == ["und"] * 4 and out[1003]["lang_pred"] != "und"
    assert out[1004]["rejected"] and out[1000]["rejected"]
    assert {r["doc_id"] for r in langid.drop_unidentified(df).collect()} == {i for i in out if not out[i]["rejected"]}
    assert langid.identify_languages(nothing).count() == 0
    assert {r["lang_pred"] for r in langid.identify_languages(df.withColumn("lang", df["lang"].substr(9, 9)).filter("lang = 'x'")).collect()} <= {"und"}


def test_rare_languages_and_long_texts_are_learned(spark):
    """A language of few rows among many large ones, and one that has only a very long text."""
    rng = random.Random(10)
    letters = "bcdfghjklmnpqrstvwxz"
    make = lambda k, n: " ".join("".join(rng.choice((letters[k], letters[(k + 7) % 20])) + rng.choice("aeiou"[k % 5 :]) for _ in range(3)) for _ in range(n))
    rows = [(1000 * k + i, make(k, 10), f"l{k:02}") for k in range(18) for i in range(60)]
    rows += [(50_000 + i, make(18, 10), "rare") for i in range(8)] + [(60_000 + i, make(19, 30_000), "long") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = langid.fit(df, rows_a_language=50, rows=100)
    assert {"rare", "long"} <= set(models.languages) and len(models.languages) == 20
    out = {r["doc_id"]: r["lang_pred"] for r in langid.identify_languages(df, rows_a_language=50, rows=100).collect()}
    assert all(out[i] == lang for i, _, lang in rows if lang in ("rare", "long"))


def test_character_model_is_a_distribution():
    counts = {"aa": Counter({"abab": 3, "abba": 2, "b": 1}), "bb": Counter({"baa": 4})}
    m = langid.train(counts, order=3)
    ends = {}
    for prefix in ("", "a", "ab", "abb"):
        base = m.word_scores([prefix + "a"])[0] if prefix else None
        del base
        total = np.zeros(2)
        for c in "ab":
            # score of prefix + c less what its last blank adds
            p = m.word_scores([prefix + c])[0][0] - _end(m, prefix + c)
            q = m.word_scores([prefix])[0][0] - _end(m, prefix) if prefix else 0
            total += np.exp(p - q)
        end = _end(m, prefix) if prefix else np.full(2, -np.inf)
        ends[prefix] = total + np.exp(end)
    for prefix, total in ends.items():
        # what is left belongs to characters never seen, at the base's rate
        assert (total <= 1 + 1e-6).all() and (total > 0.5).all(), (prefix, total)


def _end(m, word):
    """ln probability of the blank after a word."""
    longer = m.word_scores([word])[0][0]
    codes, place, _ = langid._positions([word])
    p = np.repeat(m.base[None, :] * m.backoff[0], len(codes), axis=0)
    shorter = None
    for k in range(m.order):
        h = langid._hashes(codes, k + 1)
        inside = np.flatnonzero(place >= max(k, 1))
        if k:
            at, hit = langid._find(m.contexts[k], shorter[inside - 1])
            inside, at = inside[hit], at[hit]
            p[inside] *= m.backoff[k][at]
        at, hit = langid._find(m.keys[k], h[inside])
        p[inside[hit]] += m.ngram[k][at[hit]]
        shorter = h
    assert np.allclose(np.log(p[1:]).sum(axis=0), longer, atol=1e-4)
    return np.log(p[-1])


# 9 mixture


def plain_targets(sizes: dict, weights=(5.0, 2.0, 1.0), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, left, target = set(), share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in full]
        rest = left - sum(most * sizes[s] for s in full)
        target = {s: most * sizes[s] if s in full else rest * weight[s] / sum(weight[o] for o in open_) for s in order}
        over = {s for s in open_ if target[s] >= most * sizes[s]}
        if not over:
            return target
        full |= over


def test_mixture(docs, rows, nothing):
    out = mixing.mix_documents(docs).collect()
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    target, taken, longest = plain_targets(sizes), defaultdict(int), defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], target[r["source"]], rel_tol=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6
    again = mixing.mix_documents(docs.repartition(2)).collect()
    assert Counter((r["doc_id"], r["taken"]) for r in out) == Counter((r["doc_id"], r["taken"]) for r in again)
    assert mixing.mix_documents(nothing).count() == 0


def test_mixture_is_a_pareto_sample(spark):
    """Against plain ranks; inclusion odds differ by size, and probabilities times sizes are the rest of the target."""
    rng = random.Random(21)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 3, 10, 40, 200, 900])), rng.choice("abcd")) for i in range(900)]
    out = {r["doc_id"]: r for r in mixing.mix_documents(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)).collect()}
    sizes = {i: len(words(t)) for i, t, _ in rows}
    for source in "abcd":
        own = [i for i, _, s in rows if s == source and sizes[i]]
        target, total = out[own[0]]["target"], sum(sizes[i] for i in own)
        whole, rest = target // total, target - target // total * total
        u = {i: (int(hashlib.md5(f"11:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52 for i in own}
        favour = {i: 2.0 ** ((sizes[i].bit_length() - 1) // 2) for i in own}
        upto, taken = 0, {}
        for i in sorted(own, key=lambda i: (u[i] / (1 - u[i]) / favour[i], i)):
            extra = upto < rest and upto + sizes[i] - rest <= rest - upto
            taken[i] = int(sizes[i] * (whole + extra))
            upto += sizes[i]
        assert {i: out[i]["taken"] for i in own} == taken
        if rest:
            assert math.isclose(sum(out[i]["inclusion"] * sizes[i] for i in own), rest, rel_tol=1e-6)
            odds = {i: out[i]["inclusion"] / (1 - out[i]["inclusion"]) / favour[i] for i in own}
            assert max(odds.values()) < 1.000001 * min(odds.values()) and len({round(out[i]["inclusion"], 9) for i in own}) > 3


def test_repeated_rows_in_a_mixture(spark):
    rows = [(5, "a b c", "s", 1)] * 6 + [(None, "a b", None, 2)] * 3 + [(7, None, "s", 3), (8, "d e", "s", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target int")
    out = mixing.mix_documents(df).collect()
    assert len(out) == len(rows) and Counter(r["taken"] for r in mixing.mix_documents(df.repartition(4)).collect()) == Counter(r["taken"] for r in out)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in out)


def test_mixed_rows(docs):
    mix = mixing.mix_documents(docs).collect()
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    assert sum(len(words(r["text"])) for r in out.collect()) == sum(r["taken"] for r in mix)
    named = docs.withColumnsRenamed({"component": "_a", "rank": "_n", "row_number": "_B"})
    again = mixing.mixed_rows(named)
    assert again.columns == named.columns and {(r["_a"], r["_n"], r["_B"]) for r in again.collect()} <= {("x", 1, 7), (None, None, None)}


def test_targets_by_many_sources(spark):
    rng = random.Random(1)
    sizes = {f"s{i}": rng.choice([0, 3, 50, 4000]) for i in range(25)} | {None: 77}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df, (5.0, 2.0, 1.0), 1.5, 2.0).collect()}
    want = plain_targets(sizes)
    assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9) for s in sizes)


# 10 token files


def test_token_files(docs, rows, nothing, tmp_path, spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    tokenfiles.write_token_files(docs, f"file://{tmp_path}/t", ids_a_file=500)
    out = sorted(tokenfiles.read_token_files(spark, f"file://{tmp_path}/t").collect(), key=lambda r: r["start"])
    at = 0
    assert [key(r["doc_id"]) for r in out] == sorted(key(r[0]) for r in rows)
    ids_of = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in rows if r[0] is not None}
    for r in out:
        assert r["start"] == at
        at += r["n_tokens"]
        if r["doc_id"] is not None:
            assert (r["n_tokens"], r["ids_crc32"]) == (len(ids_of[r["doc_id"]]), zlib.crc32(np.array(ids_of[r["doc_id"]], "<u4").tobytes()))
    assert tokenfiles.round_trip(nothing).count() == 0
    files = sorted(f.name for f in tmp_path.glob("t/*.pfr"))
    assert len(files) > 4 and not list(tmp_path.glob("t/.part*")) and (tmp_path / "t" / files[0]).read_bytes()[:4] == b"PFR1"
    for doc in (0, 4, 11, 30, 59, 99):  # by the index
        found = tokenfiles.document_ids(spark, f"file://{tmp_path}/t", doc)
        assert [x.tolist() for x in found] == [ids_of[doc]] * sum(r[0] == doc for r in rows) if doc < 60 else not found


def test_one_block_is_read_by_the_index():
    ids = np.arange(10_000, dtype="<u4")
    data = tokenfiles.encode_file([(i, ids[100 * i : 100 * (i + 1)].tobytes()) for i in range(100)], block=1000)
    read = []

    class Counting(io.BytesIO):
        def read(self, n=-1):
            read.append(n)
            return super().read(n)

    file = tokenfiles.TokenFile(Counting(data))
    read.clear()
    assert file.ids(47).tolist() == list(range(4700, 4800)) and len(read) == 1 and read[0] < len(data) / 5


def test_one_doc_id_is_split_over_parts(spark, tmp_path):
    df = spark.createDataFrame([(None if i % 2 else 7, f"text {i}") for i in range(400)], "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tokenfiles.write_token_files(df, f"file://{tmp_path}/t")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tokenfiles.manifest(spark, f"file://{tmp_path}/t").select("part").distinct().count() > 2
    out = sorted(tokenfiles.read_token_files(spark, f"file://{tmp_path}/t").collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in out] == [None] * 200 + [7] * 200 and out[-1]["start"] + out[-1]["n_tokens"] == sum(r["n_tokens"] for r in out)


@pytest.mark.parametrize("top", [1, 2, 300, 50_000, 2**32 - 1])
def test_blocks_round_trip(top):
    rng = np.random.default_rng(top)
    for n in (1, 5, 1023, 1024, 5000):
        ids = rng.integers(0, top, n, dtype=np.uint32)
        ids[rng.random(n) < 0.03] = 2**32 - 1
        file = tokenfiles.TokenFile(io.BytesIO(tokenfiles.encode_file([(3, ids[: n // 2].tobytes()), (None, ids[n // 2 :].tobytes()), (9, b"")])))
        assert (np.concatenate([file.ids(i) for i in range(3)]) == ids).all() and file.table["n"].tolist() == [n // 2, n - n // 2, 0] and file.table["has"].tolist() == [1, 0, 1]


# the registered queries


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    """Over the whole smallest tables, as the driver compares them."""
    import duckdb

    folder = "/root/testdata/sf0.001"
    if not os.path.exists(folder):
        pytest.skip("no test data")
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    found, df = con.sql(ORACLES[name]), QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    assert columns == sorted(found.columns)
    shown = lambda rows, names: sorted(tuple(repr(round(r[i], 9)) if isinstance(r[i], float) else str(r[i]) for i in map(names.index, columns)) for r in rows)
    assert shown(map(tuple, df.collect()), df.columns) == shown(found.fetchall(), found.columns)
