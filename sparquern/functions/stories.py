"""Emotion lines, character names, numbered steps and openings of stories, as Column expressions."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col, hash_index, strip, token_count

# Words that open a conversation, and other ways to say "Yes, please."
STARTERS = ("Ah", "Oh", "I", "Welcome", "Hey", "It's", "Hello")
YES_PLEASE = (
    "Yes, please.", "Sure!", "Sure", "sure", "yeah", "sounds good", "I'd like that", "Go ahead", "Please do", "Yes, go on", "That would be great",
    "Absolutely", "Of course", "Yes, definitely", "Please continue", "Yes, I'd like that",
)


def emotion_line(text):
    """The first line, in capitals before its colon if it has one."""
    line = strip(F.substring_index(col(text), "\n", 1))
    at = F.instr(line, F.lit(":"))
    return F.when(at > 0, F.concat(F.upper(F.substr(line, F.lit(1), at - 1)), F.substr(line, at))).otherwise(line)


def capitals_before_colon(text):
    """Whether no lower-case letter stands before the first colon, or in a text without one."""
    return ~F.coalesce(F.substring_index(col(text), ":", 1).rlike(r"\p{Ll}"), F.lit(False))


def listed(items):
    return F.concat(F.lit("["), F.array_join(col(items), ", "), F.lit("]"))


def capitals_block(text):
    """From the first line that begins with capitals and a colon to the next blank line; null without one."""
    pattern = r"(?ms)^([A-Z\s]+:\s.*?)(?=\n\n|\z)"
    return F.when(col(text).rlike(pattern), strip(F.regexp_extract(col(text), pattern, 1)))


def emotion_ok(text, most: int = 600, length: int = 16, times: int = 3, reach: int = 400):
    """Not blank, not too long, and no part that is repeated too often nearby."""
    from ..operators.parsers import clustered_repeats_column

    t = F.coalesce(col(text), F.lit(""))
    return (strip(t) != "") & (token_count(t) <= most) & ~clustered_repeats_column(t, length, times, reach)


def contains_any(text, words: list[str]):
    t = F.coalesce(col(text), F.lit(""))
    found = F.lit(False)
    for w in words:
        found = found | F.contains(t, F.lit(w))
    return found


def has_keys(ratings, names: list[str]):
    """Whether the map has a value for every name."""
    ok = col(ratings).isNotNull()
    for n in names:
        ok = ok & F.element_at(col(ratings), F.lit(n)).isNotNull()
    return F.coalesce(ok, F.lit(False))


def card_name(text):
    """What follows 'Name:' at the start of a line up to white space, else what follows 'Name:' anywhere up to a backslash; null without either."""
    by_line, anywhere = r"(?m)^Name:\s*([^\s]*)", r"Name: *([^\\]*)"
    return F.when(col(text).rlike(by_line), F.regexp_extract(col(text), by_line, 1)).when(col(text).rlike(anywhere), F.regexp_extract(col(text), anywhere, 1))


def first_words(name, text):
    """The first word of each quotation that follows the name and a colon. ``name`` is a column."""
    spoken = F.regexp_extract_all(col(text), F.lit(r'([^\n]*?): "([\p{L}\p{N}_]+)'), F.lit(2))
    owners = F.regexp_extract_all(col(text), F.lit(r'([^\n]*?): "([\p{L}\p{N}_]+)'), F.lit(1))
    return F.filter(F.transform(spoken, lambda w, i: F.when(F.endswith(F.get(owners, i), col(name)), w)), lambda w: w.isNotNull())


def conversation_starter(card, key):
    """An opening word that the card's character doesn't begin with, chosen by the key; null if all are taken."""
    used = F.coalesce(first_words(card_name(card), card), F.array().cast("array<string>"))
    free = F.filter(F.array(*[F.lit(w) for w in STARTERS]), lambda w: ~F.array_contains(used, w))
    draw = F.conv(F.substring(F.sha2(col(key).cast("string"), 256), 1, 8), 16, 10).cast("long")
    return F.get(free, F.pmod(draw, F.greatest(F.size(free), F.lit(1))).cast("int"))


def steps_extracted(text, steps: tuple[int, ...] = (2, 4, 5)):
    """The contents of these steps ('Step n.'), a line each."""
    named = "|".join(rf"Step {n}\." for n in steps)
    return F.array_join(F.transform(F.regexp_extract_all(col(text), F.lit(rf"(?s)(?:{named})\s*(.*?)\s*(?=Step \d\.|$)"), F.lit(1)), strip), "\n")


def steps_stripped(text):
    """Lines without the 'Step n.' before them."""
    one = lambda x: F.when(F.startswith(strip(x), F.lit("Step")) & F.contains(x, F.lit(".")), F.regexp_replace(F.substr(x, F.instr(x, F.lit(".")) + 1), r"^\s+", "")).otherwise(x)
    return F.array_join(F.transform(F.split(col(text), "\n"), one), "\n")


def agreed(question, key):
    """Another way to say "Yes, please.", chosen by the key; other questions stay."""
    words = F.array(*[F.lit(w) for w in YES_PLEASE])
    return F.when(col(question) == YES_PLEASE[0], F.get(words, hash_index(col(key).cast("string"), len(YES_PLEASE)))).otherwise(col(question))


def string_list(text):
    """The strings of a list literal; null for anything else."""

    def parsed(t):
        try:
            found = ast.literal_eval(t)
        except (ValueError, SyntaxError, MemoryError, RecursionError, TypeError):
            return None
        return found if isinstance(found, list) and all(isinstance(x, str) for x in found) else None

    @F.pandas_udf("array<string>")
    def parse(texts: pd.Series) -> pd.Series:
        return texts.map(parsed)

    return parse(text)


def story_conversation(card: Column, story: Column, name: Column) -> Column:
    """A system turn with the card, then the story's messages: human for {user}, gpt for all others."""
    from ..operators.parsers import chat_column
    from .conversations import turn

    told = F.transform(chat_column(story, name), lambda m: turn(F.when(m["owner"] == "{user}", "human").otherwise("gpt"), m["content"]))
    return F.concat(F.array(turn(F.lit("system"), card)), told)


def flattened(df: DataFrame, struct: str) -> DataFrame:
    """The struct's fields as columns <struct>_<field>, in its place."""
    names = df.schema[struct].dataType.names
    return df.select(*[x for c in df.columns for x in ([F.col(f"{c}.{n}").alias(f"{c}_{n}") for n in names] if c == struct else [F.col(c)])])


def prompts_replaced(df: DataFrame, prompt: str, others: dict[str, str], key: str, p: float = 0.5) -> DataFrame:
    """Prompts that ``others`` has an entry for take that where the key's draw is below p; the table is a map in the plan."""
    from .text import hash_ratio

    if not others:
        return df
    table = F.create_map(*[F.lit(x) for kv in others.items() for x in kv])
    return df.withColumn(prompt, F.when(hash_ratio(F.col(key).cast("string")) < p, F.coalesce(F.try_element_at(table, F.col(prompt)), F.col(prompt))).otherwise(F.col(prompt)))
