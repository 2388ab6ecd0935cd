"""Tolerant parsers of structured replies and validators that look at whole texts; Arrow-batched."""

from __future__ import annotations

import re
from collections import defaultdict, deque
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MARKS = re.compile(r"[#\-*•\"'\[\](){}<>_]")
ITEM = re.compile(r"^\s*[-*•]+\s*")


def sections(text: str, headings: dict[str, dict[str, str]]) -> dict[str, str | list[str] | None]:
    """Content below each heading. A line that holds a heading, marks and case aside, starts its section.

    Types: paragraph (its plain lines joined), list (its items), rating (what follows the prefix in the
    last line that has it, marks removed). Headings that are not found are None.
    """
    wanted = {h.lower(): spec for h, spec in headings.items()}
    found: dict[str, list[str]] = {}
    current = None
    for line in text.split("\n"):
        bare = MARKS.sub("", line).strip().lower()
        heading = next((h for h in wanted if h in bare), None)
        if heading is not None:
            current = heading
            found[current] = []
        elif current is not None and line.strip():
            found[current].append(line)
    return {h: _content(found[h], spec) if h in found else None for h, spec in wanted.items()}


def _content(lines: list[str], spec: dict[str, str]) -> str | list[str] | None:
    kind = spec.get("name")
    if kind == "list":
        return [ITEM.sub("", x).strip() for x in lines if ITEM.match(x)]
    if kind == "rating":
        prefix = spec.get("prefix", "")
        rated = [x for x in lines if prefix in x]
        return MARKS.sub("", rated[-1].split(prefix, 1)[1]).strip() if rated else None
    return " ".join(x.strip() for x in lines if not ITEM.match(x)).strip()


def sections_column(text: Column | str, headings: dict[str, dict[str, str]]) -> Column:
    """MAP heading -> lines: one for paragraphs and ratings, the items for lists; missing headings are left out."""

    @F.pandas_udf("map<string,array<string>>")
    def parse(texts: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return None
            return {h: v if isinstance(v, list) else [v] for h, v in sections(t, headings).items() if v is not None}

        return texts.map(one)

    return parse(text)


RATINGS = ("awful", "poor", "good", "incredible")  # fixed values


def ratings(text: str, names: list[str]) -> dict[str, str]:
    """Ratings after 'Rating:' below each name; an unknown one is an error."""
    out = sections(text, {n: {"name": "rating", "prefix": "Rating:"} for n in names})
    for n, v in out.items():
        if v is None or v.lower().rstrip(".") not in RATINGS:
            raise ValueError(f"no rating for {n}")
    return {n: v.lower().rstrip(".") for n, v in out.items()}


def ratings_column(text: Column | str, names: list[str]) -> Column:
    """ratings() of a column; null where one is missing or unknown."""

    @F.pandas_udf("map<string,string>")
    def parse(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return ratings(t or "", names)
            except ValueError:
                return None

        return texts.map(one)

    return parse(text)


def chat_messages(text: str, character: str) -> list[dict[str, str]]:
    """Messages of the character, {user} and {narrator}: each begins with its owner and a colon and goes on until the next."""
    owners = (character, "{user}", "{narrator}")
    out: list[dict[str, str]] = []
    for line in text.split("\n"):
        owner = next((o for o in owners if line.startswith(o + ":")), None)
        if owner:
            out.append({"owner": owner, "content": line[len(owner) + 1 :]})
        elif out:
            out[-1]["content"] += "\n" + line
    return [{"owner": m["owner"], "content": m["content"].strip()} for m in out]


def chat_column(text: Column | str, character: Column | str) -> Column:
    """chat_messages() of a column."""

    @F.pandas_udf("array<struct<owner:string,content:string>>")
    def parse(texts: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else chat_messages(t, n or "") for t, n in zip(texts, names, strict=True)], dtype=object)

    return parse(text, character)


def tidy_story(messages: list[dict[str, str]], longest: int, count=lambda t: len(t.split())) -> list[dict[str, str]]:
    """Cut after the first message that repeats an earlier one of its owner, before the first that is too long, and at a closing note."""
    seen: set[tuple[str, str]] = set()
    kept: list[dict[str, str]] = []
    for m in messages:
        if count(m["content"]) > longest:
            break
        kept.append(dict(m))
        if m["owner"] != "{user}" and (m["owner"], m["content"]) in seen:
            break
        seen.add((m["owner"], m["content"]))
    if kept:
        kept[-1]["content"] = re.split(r"\n\s*\**Note\b", kept[-1]["content"], maxsplit=1)[0].rstrip()
    return kept


def story_text(messages: list[dict[str, str]]) -> str:
    return "\n\n".join(f"{m['owner']}: {m['content']}" for m in messages)


CARD = ("Name", "Personality", "Appearance", "Backstory", "Likes", "Dislikes", "Goals", "Voice", "Scene")


def scene_card(text: str) -> dict[str, str | list[str] | None]:
    """A character card by its headings; Personality is a list. The text ends at an end marker if it has one."""
    body = re.split(r"(?i)\*{0,2}end of card\*{0,2}", text, maxsplit=1)[0]
    out: dict[str, list[str]] = {}
    current = None
    for line in body.split("\n"):
        m = re.match(r"^[#*\s]*([A-Za-z ]+?)[*\s]*:[*\s]*(.*)$", line)
        name = next((h for h in CARD if m and m[1].strip().lower() == h.lower()), None)
        if name:
            current = name
            out[current] = [m[2]] if m[2].strip() else []
        elif current and line.strip():
            out[current].append(line)
    card: dict[str, str | list[str] | None] = {h: "\n".join(out[h]).strip() if h in out else None for h in CARD}
    if "Personality" in out:
        card["Personality"] = [ITEM.sub("", x).strip() for x in out["Personality"] if x.strip()]
    return card


def card_column(text: Column | str) -> Column:
    """scene_card() of a column: MAP heading -> lines, without the headings that are missing."""

    @F.pandas_udf("map<string,array<string>>")
    def parse(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else {h: v if isinstance(v, list) else [v] for h, v in scene_card(t).items() if v is not None})

    return parse(text)


def card_text(card: dict[str, str | list[str] | None]) -> str:
    shown = lambda v: "\n" + "\n".join(f"- {x}" for x in v) if isinstance(v, list) else f" {v}"
    return "\n".join(f"{h}:{shown(card[h])}" for h in CARD if card.get(h))


def dialogue(text: str) -> list[tuple[str, str]]:
    """(question, answer) pairs of a chat with **User:** and **AI Assistant:** turns."""
    turns = re.findall(r"\*\*(User|AI Assistant):\*\*\s*(.*?)(?=\*\*(?:User|AI Assistant):\*\*|\Z)", text, re.DOTALL)
    return [(a[1].strip(), b[1].strip()) for a, b in zip(turns, turns[1:], strict=False) if a[0] == "User" and b[0] == "AI Assistant"]


def shared_run(a: str, b: str, n: int) -> str | None:
    """The first n characters in a row of a that stand in b; a whole if it is shorter and stands there; else null."""
    if len(a) < n:
        return a if a in b else None
    return next((a[i : i + n] for i in range(len(a) - n + 1) if a[i : i + n] in b), None)


Turns = list[tuple[str, str]]  # speaker, text


def answers_kept(turns: Turns, pairs: list[tuple[str, str]], n: int) -> bool:
    """Whether each answer has n characters of its own pair's, from the second turn on, or from the fourth after a greeting."""
    own = lambda first: [(pairs[(i - first) // 2][1], turns[i][1]) for i in range(first, len(turns), 2) if (i - first) // 2 < len(pairs)]
    return any(all(shared_run(a, t, n) is not None for a, t in own(first)) for first in (1, 3))


def long_enough(turns: Turns, pairs: list[tuple[str, str]]) -> bool:
    return len(turns) >= 2 * len(pairs)


def questions_kept(turns: Turns, pairs: list[tuple[str, str]], n: int) -> bool | None:
    """Whether each question has n characters of its own pair's, from the first turn on, or from the third after a
    greeting; None where it is the first question that has none."""
    own = lambda first: [(pairs[(i - first) // 2][0], turns[i][1]) for i in range(first, len(turns), 2) if (i - first) // 2 < len(pairs)]
    if any(all(shared_run(q, t, n) is not None for q, t in own(first)) for first in (0, 2)):
        return True
    return None if len(turns) >= 2 and pairs and shared_run(pairs[0][0], turns[0][1], n) is None else False


def no_foreign_quotes(turns: Turns, pairs: list[tuple[str, str]], n: int) -> bool:
    """Whether no answer (each second turn from the third on) has n characters of another pair's answer that its own lacks."""
    for i in range(2, len(turns), 2):
        if i // 2 - 1 >= len(pairs):
            break
        own = pairs[i // 2 - 1][1]
        for _, other in pairs:
            if other != own and (run := shared_run(other, turns[i][1], n)) is not None and run not in own:
                return False
    return True


def faithful_dialogue(text: str, pairs: list[tuple[str, str]], n: int = 15, quote: int = 100) -> bool:
    """Whether a chat keeps to its questions and answers: long enough, own answers and questions, no long foreign quotes.
    A chat that lacks only its first question passes."""
    turns = [x for q, a in dialogue(text) for x in (("User", q), ("AI Assistant", a))]
    return long_enough(turns, pairs) and answers_kept(turns, pairs, n) and questions_kept(turns, pairs, n) is not False and no_foreign_quotes(turns, pairs, quote)


def similarity(a: Column | str, b: Column | str) -> Column:
    """Ratcliff-Obershelp ratio; the built-in edit distance is another measure."""

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, s or "", t or "").ratio() for s, t in zip(x, y, strict=True)])

    return ratio(a, b)


def clustered_repeats(text: str, length: int, most: int, reach: int) -> bool:
    """Whether some substring of ``length`` characters or more occurs more than ``most`` times with starts within ``reach``.

    A longer repeated substring has a repeated one of just ``length`` at its start, so this length is enough.
    """
    places: dict[str, deque[int]] = defaultdict(deque)
    for i in range(len(text) - length + 1):
        own = places[text[i : i + length]]
        while own and i - own[0] > reach:
            own.popleft()
        own.append(i)
        if len(own) > most:
            return True
    return False


def clustered_repeats_column(text: Column | str, length: int, most: int, reach: int) -> Column:
    @F.pandas_udf("boolean")
    def check(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: clustered_repeats(t or "", length, most, reach))

    return check(text)


# Keys beside each other on a keyboard.
NEIGHBOURS = {"a": "qs", "b": "vn", "c": "xv", "d": "sf", "e": "wr", "f": "dg", "g": "fh", "h": "gj", "i": "uo", "j": "hk", "k": "jl", "l": "k", "m": "n", "n": "bm", "o": "ip", "p": "o", "q": "w", "r": "et", "s": "ad", "t": "ry", "u": "yi", "v": "cb", "w": "qe", "x": "zc", "y": "tu", "z": "x"}


def typing_noise(text: Column | str, key: Column | str, rate: float = 0.02, lost_blanks: float = 0.05) -> Column:
    """Neighbouring keys and lost blanks, drawn from the row's key, so that reruns agree."""

    @F.pandas_udf("string")
    def noisy(texts: pd.Series, keys: pd.Series) -> pd.Series:
        import random

        def one(t, k):
            if t is None:
                return None
            rng = random.Random(f"noise{k}")
            typed = [rng.choice(NEIGHBOURS[c]) if c in NEIGHBOURS and rng.random() < rate else c for c in t]
            return "".join(c for c in typed if c != " " or rng.random() >= lost_blanks)

        return pd.Series([one(t, k) for t, k in zip(texts, keys, strict=True)])

    return noisy(text, F.col(key).cast("string") if isinstance(key, str) else key.cast("string"))
