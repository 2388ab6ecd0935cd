"""Conversation arrays: ARRAY<STRUCT<from, value>> and ARRAY<STRUCT<role, content>> as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import after_first, col, hash_ratio, strip

# Role names of the two forms, and the presets of rendered text.
TO_SHAREGPT = {"user": "human", "assistant": "gpt", "system": "system"}
TO_OPENAI = {"human": "user", "gpt": "assistant", "system": "system"}
CHATML = {"system": ("<|im_start|>system\n", "<|im_end|>\n"), "user": ("<|im_start|>user\n", "<|im_end|>\n"), "assistant": ("<|im_start|>assistant\n", "<|im_end|>\n")}
LABELLED = {"system": ("Instruction: ", " **Finished.**\n"), "user": ("Human: ", " **Finished.**\n"), "assistant": ("AI: ", " **Finished.**\n")}


def turn(sender: Column, value: Column) -> Column:
    return F.struct(sender.alias("from"), value.alias("value"))


def mapped(role: Column, names: dict[str, str], other: str) -> Column:
    out = F.lit(other)
    for a, b in names.items():
        out = F.when(role == a, b).otherwise(out)
    return out


def gathered(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(conv_id, turn, role, text) rows to one row a conversation with its turns in order."""
    rows = turns.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("_t"))
    return rows.select(key, F.transform("_t", lambda t: turn(mapped(t["role"], TO_SHAREGPT, "unknown"), t["text"])).alias("conversations"))


def to_openai(conv) -> Column:
    return F.transform(col(conv), lambda m: F.struct(mapped(m["from"], TO_OPENAI, "unknown").alias("role"), m["value"].alias("content")))


def to_sharegpt(messages) -> Column:
    return F.transform(col(messages), lambda m: turn(mapped(m["role"], TO_SHAREGPT, "unknown"), m["content"]))


def rendered_plain(conv) -> Column:
    """Lines of ROLE: and value, trimmed."""
    return strip(F.array_join(F.transform(col(conv), lambda m: F.concat(F.lit("\n"), F.upper(m["from"]), F.lit(":\n"), m["value"])), ""))


def hash_without_first(conv) -> Column:
    c = col(conv)
    return F.md5(rendered_plain(F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))).cast("binary"))


def has_system(conv) -> Column:
    return F.coalesce(F.get(col(conv), F.lit(0))["from"] == "system", F.lit(False))


def without_system(conv) -> Column:
    c = col(conv)
    return F.when(has_system(c), F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))).otherwise(c)


def pairs(conv) -> Column:
    """Array of (pair_idx, human, gpt, system, human_idx, gpt_idx): steps of two turns after the system
    turn, human then gpt. ``system`` is null where there is none."""
    c, rest = col(conv), without_system(conv)
    start = F.when(has_system(c), 1).otherwise(0)
    system = F.when(has_system(c), F.get(c, F.lit(0))["value"])
    steps = F.filter(F.sequence(F.lit(0), F.greatest(F.size(rest) - 2, F.lit(0)), F.lit(2)), lambda i: i < F.size(rest) - 1)
    whole = F.filter(steps, lambda i: (F.get(rest, i)["from"] == "human") & (F.get(rest, i + 1)["from"] == "gpt"))
    return F.transform(whole, lambda i: F.struct((i / 2).cast("int").alias("pair_idx"), F.get(rest, i)["value"].alias("human"), F.get(rest, i + 1)["value"].alias("gpt"), system.alias("system"), (i + start).alias("human_idx"), (i + start + 1).alias("gpt_idx")))


def pair_text(human: Column, gpt: Column) -> Column:
    return F.concat(F.lit("HUMAN:\\n"), human, F.lit("\\n\\nGPT:\\n"), gpt)


def history(conv, pair_idx: Column) -> Column:
    """Turns before the pair, without the system turn; all of them where the pair lies beyond the end."""
    rest = without_system(conv)
    return F.slice(rest, F.lit(1), F.least(2 * pair_idx, F.size(rest)).cast("int"))


def history_text(messages: Column, most: int = 30_000) -> Column:
    """Rendered history, its last ``most`` words behind a mark where it has more."""
    text = F.array_join(F.transform(messages, lambda m: F.concat(F.lit(" \n"), F.upper(m["from"]), F.lit(":\n"), m["value"])), "")
    n = F.regexp_count(text, F.lit(r"\S+"))
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    cut = F.array_join(F.slice(words, F.greatest(F.size(words) - most + 1, F.lit(1)), F.lit(most)), " ")
    return strip(F.when(n > most, F.concat(F.lit("...truncated..."), cut)).otherwise(text))


def suffix_within(conv, budget: int) -> Column:
    """The system turn and the newest other turns whose words fit the budget: the oldest are dropped first."""
    c, rest = col(conv), without_system(conv)
    words = lambda m: F.coalesce(F.regexp_count(m["value"], F.lit(r"\S+")), F.lit(0)).cast("long")
    own = F.when(has_system(c), words(F.get(c, F.lit(0)))).otherwise(F.lit(0)).cast("long")
    start = F.struct(own.alias("n"), F.lit(0).alias("kept"), F.lit(False).alias("full"))
    step = lambda s, m: F.struct((s["n"] + F.when(s["full"] | (s["n"] + words(m) > budget), 0).otherwise(words(m))).alias("n"), (s["kept"] + F.when(s["full"] | (s["n"] + words(m) > budget), 0).otherwise(1)).alias("kept"), (s["full"] | (s["n"] + words(m) > budget)).alias("full"))
    kept = F.aggregate(F.reverse(rest), start, step, lambda s: s["kept"])
    tail = F.slice(rest, F.greatest(F.size(rest) - kept + 1, F.lit(1)), kept)
    return F.when(has_system(c), F.concat(F.slice(c, 1, 1), tail)).otherwise(tail)


def chat_role(sender: Column) -> Column:
    s = F.lower(sender)
    return F.when(s == "system", "system").when(s.isin("human", "user"), "user").otherwise("assistant")


def rendered_preset(conv, preset: dict[str, tuple[str, str]]) -> Column:
    """Completion text by a preset of (before, after) texts for each role, trimmed."""

    def one(m):
        role = chat_role(m["from"])
        out = F.lit("")
        for name, (before, end) in preset.items():
            out = F.when(role == name, F.concat(F.lit(before), m["value"], F.lit(end))).otherwise(out)
        return out

    return strip(F.array_join(F.transform(col(conv), one), ""))


def system_added(conv, instruction: str, glue: str = "\n") -> Column:
    """The instruction before an existing system text, or as a new first turn; nothing for an empty one."""
    c = col(conv)
    if not instruction:
        return c
    old = F.get(c, F.lit(0))["value"]
    put = F.array(turn(F.lit("system"), F.when(has_system(c), F.concat(F.lit(instruction + glue), old)).otherwise(F.lit(instruction))))
    return F.concat(put, without_system(c))


def system_dropped(conv, key: Column, p: float) -> Column:
    """The system turn removed where the key's hash draw is below p."""
    return F.when(hash_ratio(key) < p, without_system(conv)).otherwise(col(conv))


def thoughts_stripped(conv, key: Column, p: float, marker: str, note: str) -> Column:
    """Below p of the key's draw: gpt turns lose what comes before the marker and the note joins the system turn."""
    cut = F.transform(col(conv), lambda m: turn(m["from"], F.when(m["from"] == "gpt", after_first(m["value"], marker)).otherwise(m["value"])))
    return F.when(hash_ratio(key) < p, system_added(cut, note)).otherwise(col(conv))


def reassembled(system: Column, turns: Column) -> Column:
    """System first where there is one (null: no such turn), then human and gpt of each pair."""
    flat = F.flatten(F.transform(turns, lambda p: F.array(turn(F.lit("human"), p["human"]), turn(F.lit("gpt"), p["gpt"]))))
    return F.when(system.isNotNull(), F.concat(F.array(turn(F.lit("system"), system)), flat)).otherwise(flat)


def loss_segments(messages, preset: dict[str, tuple[str, str]] = CHATML) -> Column:
    """(label, text) for each turn of a ShareGPT array: the system turn, the last turn and the one before it are learned."""
    c = col(messages)

    def one(m, i):
        text = F.lit("")
        for name, (before, end) in preset.items():
            text = F.when(chat_role(m["from"]) == name, F.concat(F.lit(before), m["value"], F.lit(end))).otherwise(text)
        learned = ((i == 0) & (m["from"] == "system")) | (i >= F.size(c) - 2)
        return F.struct(learned.alias("label"), text.alias("text"))

    return F.filter(F.transform(c, one), lambda s: s["text"] != "")


def truncation_turn(conv, key: Column, p: float) -> Column:
    """Index of the gpt turn that becomes the answer: the first where the draw is below p, else one chosen by hash. Null without gpt turns."""
    c = col(conv)
    at = F.filter(F.sequence(F.lit(0), F.greatest(F.size(c) - 1, F.lit(0))), lambda i: F.get(c, i)["from"] == "gpt")
    draw = F.conv(F.substring(F.sha2(key, 256), 9, 8), 16, 10).cast("long")
    return F.get(at, F.when(hash_ratio(key) < p, F.lit(0)).otherwise((draw % F.greatest(F.size(at), F.lit(1))).cast("int")))


def fewshot(conv, key: Column, k: int) -> Column:
    """At most three turns stay; else the system turn, k pairs chosen by hash in their order, and the last human turn."""
    c, rest = col(conv), without_system(conv)
    shots = pairs(c)
    rank = lambda p: F.md5(F.concat(key, F.lit("|"), p["pair_idx"].cast("string")))
    chosen = F.transform(F.slice(F.array_sort(F.transform(shots, lambda p: F.struct(rank(p).alias("r"), p["pair_idx"].alias("i")))), 1, k), lambda s: s["i"])
    kept = F.filter(shots, lambda p: F.array_contains(chosen, p["pair_idx"]))
    flat = F.flatten(F.transform(kept, lambda p: F.array(turn(F.lit("human"), p["human"]), turn(F.lit("gpt"), p["gpt"]))))
    humans = F.filter(rest, lambda m: m["from"] == "human")
    last = F.slice(humans, F.greatest(F.size(humans), F.lit(1)), F.lit(1))
    system = F.when(has_system(c), F.slice(c, 1, 1)).otherwise(F.slice(c, 1, 0))
    return F.when(F.size(c) <= 3, c).otherwise(F.concat(system, flat, last))
