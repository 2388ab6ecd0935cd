"""Scalar text functions as Column expressions; all run in the JVM but for random noise and doubled runs."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"\s+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def token_count(text: Column | str) -> Column:
    """Whitespace-separated words; the offline stand-in for a tokenizer. Null counts 0."""
    return F.coalesce(F.regexp_count(col(text), F.lit(r"\S+")), F.lit(0)).cast("long")


def strip(text: Column | str) -> Column:
    """Trim any white space, where SQL trim takes blanks only."""
    return F.regexp_replace(col(text), r"^\s+|\s+$", "")


def words(text: Column | str) -> Column:
    return F.filter(F.split(col(text), BLANK), lambda w: w != "")


def capitalised(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substr(word, F.lit(2))))


# case variations


def snake_case(text):
    return F.replace(F.lower(col(text)), F.lit(" "), F.lit("_"))


def kebab_case(text):
    return F.replace(F.lower(col(text)), F.lit(" "), F.lit("-"))


def pascal_case(text):
    return F.array_join(F.transform(words(text), capitalised), "")


def camel_case(text):
    """First word lower, the others capitalised, joined; null for a text without words."""
    w = words(text)
    rest = F.array_join(F.transform(F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), capitalised), "")
    return F.when(F.size(w) > 0, F.concat(F.lower(F.get(w, F.lit(0))), rest))


def sentence_case(text):
    """Each part between '. ' gets a capital and is otherwise lower."""
    return F.array_join(F.transform(F.split(col(text), r"\. "), capitalised), ". ")


def alternating_case(text):
    chars = F.filter(F.split(col(text), ""), lambda c: c != "")
    return F.array_join(F.transform(chars, lambda c, i: F.when(i % 2 == 0, F.lower(c)).otherwise(F.upper(c))), "")


def inverted_case(text):
    chars = F.filter(F.split(col(text), ""), lambda c: c != "")
    return F.array_join(F.transform(chars, lambda c: F.when(c == F.upper(c), F.lower(c)).otherwise(F.upper(c))), "")


def random_case(text, key):
    """Each letter upper or lower by a draw from the row's key and the letter's place, so that reruns agree."""
    chars = F.filter(F.split(col(text), ""), lambda c: c != "")
    heads = lambda i: F.pmod(F.xxhash64(col(key).cast("string"), i), F.lit(2)) == 0
    return F.array_join(F.transform(chars, lambda c, i: F.when(heads(i), F.upper(c)).otherwise(F.lower(c))), "")


def title_case(text):
    """Each run of letters capitalised (initcap looks at blanks alone)."""
    return F.array_join(F.transform(F.regexp_extract_all(col(text), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1)), capitalised), "")


def _noise(text, key):
    from ..operators.parsers import typing_noise

    return typing_noise(col(text), col(key))


#: Case variations by name: functions of the text and, for those that draw, of the row's key. More may be registered here;
#: ``case_variations`` takes functions beside names, and ignores unknown names.
CASES = {
    "allcaps": lambda t, _: F.upper(col(t)), "lowercase": lambda t, _: F.lower(col(t)), "alternating": lambda t, _: alternating_case(t), "title": lambda t, _: title_case(t),
    "sentence": lambda t, _: sentence_case(t), "snake": lambda t, _: snake_case(t), "kebab": lambda t, _: kebab_case(t), "camel": lambda t, _: camel_case(t), "pascal": lambda t, _: pascal_case(t),
    "invert": lambda t, _: inverted_case(t), "random": random_case, "keyboard": _noise,
}


def case_variations(text: Column | str, names: list, key: Column | str = "doc_id") -> Column:
    """Array of (name, text) for the known names and for functions of (text, key), which go by their own name."""
    chosen = [(n, CASES[n]) if isinstance(n, str) else (n.__name__, n) for n in names if callable(n) or n in CASES]
    return F.array(*[F.struct(F.lit(n).alias("variation"), f(text, key).alias("text")) for n, f in chosen])


# cuts and tags


def head_tail(text, length: int):
    """The first fifth of ``length`` and the last ``length`` less twice that; shorter texts stay whole."""
    t, head = col(text), length // 5
    return F.when(F.length(t) <= length, t).otherwise(F.concat(F.substring(t, 1, head), F.right(t, F.lit(length - 2 * head))))


def strip_think(text):
    return F.regexp_replace(col(text), r"(?s)<think>.*?</think>", "")


def tag_last(text, tag: str):
    """Text between the last opening and the first closing tag after it, thoughts removed, trimmed."""
    return strip(F.substring_index(F.substring_index(strip_think(text), f"<{tag}>", -1), f"</{tag}>", 1))


def tag_first(text, tag: str):
    """Text of the first such element, trimmed; null where there is none."""
    pattern = f"(?s)<{tag}>(.*?)</{tag}>"
    return F.when(col(text).rlike(pattern), strip(F.regexp_extract(col(text), pattern, 1)))


def after_first(text, marker: str):
    """What follows the first marker, trimmed; the text itself if it has none."""
    t = col(text)
    at = F.instr(t, F.lit(marker))
    return F.when(at > 0, strip(F.substr(t, at + len(marker)))).otherwise(t)


def thought_and_answer(text, marker: str):
    """(thought, answer) around the first marker; both null without it."""
    t = col(text)
    at = F.instr(t, F.lit(marker))
    return F.struct(F.when(at > 0, strip(F.substr(t, F.lit(1), at - 1))).alias("thought"), F.when(at > 0, strip(F.substr(t, at + len(marker)))).alias("answer"))


def last_match(text, pattern: str, group: int = 1):
    found = F.regexp_extract_all(col(text), F.lit(pattern), F.lit(group))
    return F.get(found, F.size(found) - 1)


def last_label(text):
    return last_match(text, r"Final label: (.+)")


def hash_answer(text):
    """What stands between the first and second '####', trimmed; null without one."""
    parts = F.split(col(text), "####")
    return F.when(F.size(parts) > 1, strip(F.get(parts, F.lit(1))))


def numeric_rating(text, most: float = 4.1):
    """(rating, ok) of the last <rating>; ok is false where it is no number from 0 to ``most``, null without one."""
    raw = strip(last_match(text, r"<rating>(.*?)</rating>"))
    value = raw.try_cast("double")
    return F.struct(F.when(value.between(0, most), value).alias("rating"), F.when(raw.isNotNull(), F.coalesce(value.between(0, most), F.lit(False))).alias("ok"))


def label_index(label, classes: list[str]):
    """Class index from its name, a number, a number first, or 'n. name'; null if none fits."""
    t = strip(label)
    names = F.array(*[F.lit(c.strip()) for c in classes])
    valid = lambda n: F.when((n >= 0) & (n < len(classes)), n)
    by_name = F.array_position(names, t) - 1
    whole = valid(t.try_cast("int"))
    first = valid(F.get(F.split(t, " "), F.lit(0)).try_cast("int"))
    numbered = valid(F.get(F.split(t, r"\."), F.lit(0)).try_cast("int"))
    name = F.lower(F.regexp_replace(strip(F.get(F.split(t, r"\."), F.lit(1))), r"\.+$", ""))
    listed = F.when(F.lower(F.get(names, numbered)) == name, numbered)
    return F.coalesce(F.when(by_name >= 0, by_name), whole, first, listed).cast("int")


def class_list(classes: list[str]) -> str:
    return "".join(f"{i}. {c}\n" for i, c in enumerate(classes))


def qa_pairs(text):
    """Array of (question, answer) from **QUESTION:** / **ANSWER:** blocks, numbered or not, trimmed."""
    t = F.regexp_replace(col(text), r"\*\*QUESTION \d:\*\*", "**QUESTION:**")
    blocks = F.slice(F.split(t, r"\*\*QUESTION:\*\*"), 2, 1_000_000)
    whole = F.filter(blocks, lambda b: F.contains(b, F.lit("**ANSWER:**")))
    return F.transform(whole, lambda b: F.struct(strip(F.get(F.split(b, r"\*\*ANSWER:\*\*", 2), F.lit(0))).alias("question"), strip(F.get(F.split(b, r"\*\*ANSWER:\*\*", 2), F.lit(1))).alias("answer")))


def atomic_facts(text):
    """Text of <atomic_facts>, else the last contiguous numbered list, else ''. Thoughts are removed first."""
    t = strip_think(text)
    lines = F.transform(F.split(t, "\n"), strip)
    numbered = lambda x: x.rlike(r"^\d+\.\s")
    start = F.struct(F.array().cast("array<string>").alias("items"), F.lit(False).alias("ended"))

    def back(s, x):
        on = numbered(x) & ~s["ended"]
        return F.struct(F.when(on, F.concat(F.array(x), s["items"])).otherwise(s["items"]).alias("items"), (s["ended"] | (~numbered(x) & (F.size(s["items"]) > 0))).alias("ended"))

    listed = F.aggregate(F.reverse(lines), start, back, lambda s: F.array_join(s["items"], "\n"))
    tagged = F.split(F.get(F.split(t, "<atomic_facts>"), F.lit(1)), "</atomic_facts>")
    return F.when(F.contains(t, F.lit("<atomic_facts>")) & F.contains(t, F.lit("</atomic_facts>")), F.get(tagged, F.lit(0))).otherwise(listed)


def without_inner_newlines(text):
    """Lines that do not end a sentence are joined to the next by a blank."""
    return F.regexp_replace(col(text), r"(?<![.!?\n])\n(?!\n)", " ")


def replaced_all(text, pairs: list[tuple[str, str]]):
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, col(text))


def context_filled(text, context):
    """{context}, {context_uppercase} and {context_lowercase} put in."""
    c = col(context)
    return F.replace(F.replace(F.replace(col(text), F.lit("{context_uppercase}"), F.upper(c)), F.lit("{context_lowercase}"), F.lower(c)), F.lit("{context}"), c)


def rendered(template: str, **values: Column):
    """Known {keys} filled, all else left as it is."""
    return reduce(lambda t, kv: F.replace(t, F.lit("{" + kv[0] + "}"), F.coalesce(kv[1].cast("string"), F.lit(""))), values.items(), F.lit(template))


def json_escaped(text):
    """The text as it stands within a JSON string."""
    j = F.to_json(F.struct(col(text).alias("x")))
    return F.substr(j, F.lit(7), F.length(j) - 8)


def quotes_escaped(text):
    """A backslash before each double quote that has none."""
    return F.regexp_replace(col(text), r'(?<!\\)"', r'\\"')


def readable_size(n):
    """Bytes in units of 1024, with two places."""
    v = col(n).cast("double")
    unit = lambda k, name: F.concat(F.format_string("%.2f", F.bround(v / float(1024**k), 2)), F.lit(f" {name}"))
    return F.when(v < 1024, unit(0, "B")).when(v < 1024**2, unit(1, "KB")).when(v < 1024**3, unit(2, "MB")).when(v < 1024**4, unit(3, "GB")).otherwise(unit(4, "TB"))


def boolean(text):
    """true for true, t, yes, y, 1; false for false, f, no, n, 0; else null."""
    t = F.lower(strip(text))
    return F.when(t.isin("true", "t", "yes", "y", "1"), True).when(t.isin("false", "f", "no", "n", "0"), False)


# Titles before names, of which one is taken off.
TITLES = (
    "Queen", "King", "Princess", "Prince", "General", "Lord",
    "Lady", "Captain", "Commander", "Warden", "professor", "Elder", "Magistrate", "Chancellor",
    "Archivist", "Overseer", "Scholar", "Vizier", "Dr.", "Master", "Regent",
    "Councillor", "Heir", "Imperator", "Empress", "Principal", "The", "Oracle", "Lorekeeper",
)


def base_name(name, titles: tuple[str, ...] = TITLES):
    """A name without one leading title (in either case), a bracket at its end, an epithet and a Roman number in capitals."""
    first = "|".join(t.replace(".", r"\.") for t in sorted(titles, key=len, reverse=True))
    t = strip(F.regexp_replace(strip(name), rf"^(?i:{first})\s+", ""))
    t = strip(F.regexp_replace(t, r"\s+\([^)]*\)$", ""))
    t = strip(F.regexp_replace(t, r"(?is)(?:,|\s+the\s+).*$", ""))
    return strip(F.regexp_replace(t, r"\s+[IVXLCDM]+$", ""))


def hash_ratio(text):
    """A number in [0, 1) from the first 32 bits of the sha256: a repeatable uniform draw."""
    return F.conv(F.substring(F.sha2(col(text), 256), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def hash_index(text, n: int):
    """A repeatable choice of 0 .. n - 1."""
    return (F.conv(F.substring(F.sha2(col(text), 256), 1, 8), 16, 10).cast("long") % n).cast("int")


def lines(text):
    return F.split(col(text), "\n")


def ends_sentence(text):
    return F.coalesce(strip(text).rlike(r"""[.!?]["')\]]*$"""), F.lit(False))


def doubled(text: str, least: int) -> bool:
    """Whether some run of at least ``least`` characters within a line follows itself at once.

    A run of length p stands doubled just where, for two places p apart that are multiples of p, the common part
    after them and the common part before them are p together; there are n / p such places for each p. One of the two
    parts has half of ``least`` at least, which rules out nearly all places; for the others common parts are found by halving
    with hashes of prefixes, for all places at a time.
    """
    half = (least + 1) // 2
    for line in text.split("\n"):
        codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        n = len(codes)
        if n < 2 * least:
            continue
        grams = np.zeros(n - half + 1, np.uint64)
        for j in range(half):
            grams = grams * FACTOR + codes[j : n - half + 1 + j] + np.uint64(1)
        powers = np.cumprod(np.concatenate([[1], np.full(n, FACTOR, np.uint64)]), dtype=np.uint64)
        # h[j] - h[i] = sum of code * factor ** place over i .. j - 1, so equal parts differ by a power of the factor
        h = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * powers[:n], dtype=np.uint64)])
        for first in range(least, n // 2 + 1, max(1, 1 << 12)):
            sizes = np.arange(first, min(first + (1 << 12), n // 2 + 1))
            times = np.maximum((n - 1) // sizes, 0)
            p = np.repeat(sizes, times)
            a = (np.arange(len(p)) - np.repeat(np.cumsum(times) - times, times)) * p
            after, before = np.minimum(a + p, n - half), np.maximum(a - half, 0)
            some = ((a + p <= n - half) & (grams[np.minimum(a, n - half)] == grams[after])) | ((a >= half) & (grams[before] == grams[np.minimum(before + p, n - half)]))
            a, p = a[some], p[some]
            after, before = _common(h, powers, a, a + p, n, 1), _common(h, powers, a, a + p, n, -1)
            for i in np.flatnonzero(after + before >= p):
                # the hashes are modulo 2**64, so what they find is looked at
                start = int(a[i] - before[i])
                if any(line[x : x + p[i]] == line[x + p[i] : x + 2 * p[i]] for x in range(start, start + int(after[i] + before[i] - p[i]) + 1)):
                    return True
    return False


FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _common(h: np.ndarray, powers: np.ndarray, a: np.ndarray, b: np.ndarray, n: int, way: int) -> np.ndarray:
    """Length of the equal parts that begin at a and b (way 1) or end before them (way -1)."""
    low, high = np.zeros(len(a), np.int64), np.minimum(b - a, n - b if way > 0 else a)
    while (low < high).any():
        middle = (low + high + 1) // 2
        x, y = (a, b) if way > 0 else (a - middle, b - middle)
        same = (h[x + middle] - h[x]) * powers[b - a] == h[y + middle] - h[y]
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def repeats(text, least: int):
    """doubled() of a column, in Arrow batches; null for null."""

    @F.pandas_udf("boolean")
    def check(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else doubled(t, least))

    return check(text)


def shares_ngram(a, b, n: int):
    """Whether any n characters of a stand in b."""
    x = col(a)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - n + 1, F.lit(1))), lambda i: F.substr(x, i, F.lit(n)))
    return (F.length(x) >= n) & F.exists(grams, lambda g: F.contains(col(b), g))


def xml_score_sum(text, tags: list[str], autofail: list[str] = (), least: float | None = None, most: float | None = None):
    """Sum of the numbers in the tags; 0 where an autofail tag is 0; out-of-range and broken numbers count nothing."""
    def one(tag):
        v = tag_last(text, tag).try_cast("double")
        inside = v.isNotNull() & (v >= least if least is not None else F.lit(True)) & (v <= most if most is not None else F.lit(True))
        return F.when(inside, v).otherwise(F.lit(0.0))

    total = reduce(lambda a, b: a + b, [one(t) for t in tags])
    failed = reduce(lambda a, b: a | b, [F.coalesce(tag_last(text, t).try_cast("double") == 0, F.lit(False)) for t in autofail], F.lit(False))
    return F.when(failed, F.lit(0.0)).otherwise(total)


def one_marker_only(text, end: str, start: str):
    """Whether a reply has the end marker just once and no start marker; empty replies do not."""
    t = F.coalesce(col(text), F.lit(""))
    n = (F.length(t) - F.length(F.replace(t, F.lit(end), F.lit("")))) / len(end)
    return (t != "") & (n == 1) & ~F.contains(t, F.lit(start))
