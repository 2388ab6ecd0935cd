"""Pipeline steps: mapping a generation engine over rows with validation and retry.

The engine is injected. It turns a prompt into a reply; RuleEngine does so by fixed rules, so that
pipelines run and are tested offline and give the same rows each time. A step calls the engine inside
mapInPandas and its result is written to the shared folder, so nothing that reads it calls the engine again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from concurrent.futures import wait
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any, Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from . import keys, quality


Messages = list[dict[str, str]]


class Engine(Protocol):
    """Completion of a prompt; engines that chat have ``chat(messages)`` too."""

    def complete(self, prompt: str) -> str: ...


@dataclass
class HttpEngine:
    """An engine behind the usual completion and chat endpoints of an HTTP service, with its sampling parameters."""

    url: str
    model: str
    key: str = ""
    parameters: dict[str, Any] = field(default_factory=dict)
    stop: tuple[str, ...] = ()
    timeout: float = 60.0

    def _post(self, path: str, body: dict[str, Any]) -> dict[str, Any]:
        import json
        from urllib.request import Request, urlopen

        data = {"model": self.model, **self.parameters, **body} | ({"stop": list(self.stop)} if self.stop else {})
        request = Request(f"{self.url.rstrip('/')}/{path}", json.dumps(data).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        with urlopen(request, timeout=self.timeout) as answer:
            return json.load(answer)["choices"][0]

    def complete(self, prompt: str) -> str:
        return self._post("completions", {"prompt": prompt})["text"]

    def chat(self, messages: Messages) -> str:
        return self._post("chat/completions", {"messages": messages})["message"]["content"]


@dataclass
class RuleEngine:
    """Replies by the first rule whose pattern is found in the prompt; ``\\1`` and the like refer to its groups."""

    rules: list[tuple[str, str]]
    other: str = ""

    def complete(self, prompt: str) -> str:
        for pattern, reply in self.rules:
            if m := re.search(pattern, prompt, re.DOTALL):
                return m.expand(reply)
        return self.other

    def chat(self, messages: Messages) -> str:
        """The rules look at the last message."""
        return self.complete(messages[-1]["content"])


def load_prompt(name: str, folders: list[str]) -> str | Messages:
    """The prompt of this name from the first folder that has it, so that a folder of own prompts goes before the
    default one: .yaml a list of messages (role, content), .txt a text."""
    for folder in folders:
        for ending in (".yaml", ".txt"):
            path = Path(folder) / f"{name}{ending}"
            if path.is_file():
                text = path.read_text("utf-8")
                if ending == ".txt":
                    return text
                import yaml

                return [{"role": str(m["role"]), "content": str(m["content"])} for m in yaml.safe_load(text)]
    raise FileNotFoundError(f"no prompt {name} in {', '.join(folders)}")


class _Kept(dict):
    """Keys that nobody gave stay as they are."""

    def __missing__(self, key: str) -> str:
        return "{" + key + "}"


def render(template: str, values: dict[str, Any]) -> str:
    """Known {keys} filled; unknown keys and stray braces stay."""
    return re.sub(r"\{(\w+)\}", lambda m: str(_Kept(values)[m[1]]), template)


@dataclass
class Step:
    """One step. ``template`` is a text, or a list of messages for an engine that chats. ``parse`` turns a reply into the
    result (an exception asks for another try); ``valid`` says (ok, message) of a result and its row. The message of a
    failed try is known to the template as error_message. ``pattern``: group 1 is taken from replies before parsing.

    ``concurrent`` rows of a task are with the engine at a time; a row that takes more than ``timeout`` seconds has no
    result. ``prompt``, ``ask``, ``read`` and ``check`` may be overridden.
    """

    name: str
    template: str | Messages
    result: str
    engine: Engine
    parse: Callable[[str], Any] = str
    kind: str = "string"
    valid: Callable[[Any, dict], tuple[bool, str]] | None = None
    retries: int = 3
    inner: int = 2
    pattern: str | None = None
    extra: dict[str, str] = field(default_factory=dict)
    concurrent: int = 1
    timeout: float | None = None

    def prompt(self, values: dict[str, Any]) -> str | Messages:
        if isinstance(self.template, str):
            return render(self.template, values)
        return [{"role": m["role"], "content": render(m["content"], values)} for m in self.template]

    def ask(self, prompt: str | Messages) -> str:
        return self.engine.complete(prompt) if isinstance(prompt, str) else self.engine.chat(prompt)

    def read(self, reply: str) -> Any:
        return self.parse(re.search(self.pattern, reply, re.DOTALL)[1] if self.pattern else reply)

    def check(self, value: Any, row: dict[str, Any]) -> tuple[bool, str]:
        return self.valid(value, row) if self.valid else (True, "")

    def call(self, row: dict[str, Any]) -> tuple[bool, Any, list[tuple[str | Messages, str]]]:
        """Whether it worked, the result, and all (prompt, reply) pairs."""
        calls: list[tuple[str | Messages, str]] = []
        error = ""
        for _ in range(self.retries):
            for _ in range(self.inner):
                prompt = self.prompt({**self.extra, **row, "error_message": error})
                reply = self.ask(prompt)
                calls.append((prompt, reply))
                try:
                    value = self.read(reply)
                    break
                except Exception as e:  # a reply that can't be parsed
                    error = str(e) or type(e).__name__
            else:
                continue
            ok, message = self.check(value, row)
            if ok:
                return True, value, calls
            error = message
        return False, None, calls

    def calls(self, rows: list[dict[str, Any]]) -> Iterator[tuple[bool, Any, list[tuple[str | Messages, str]]]]:
        """call() for each row, in order, some at a time."""
        yield from in_flight(self.call, rows, self.concurrent, self.timeout, (False, None, []))

    def over(self, df: DataFrame, key: str = "row_key", saved: DataFrame | None = None, details: bool = False, progress=None) -> DataFrame:
        """df's rows that have a result, with it. Rows in ``saved`` (a former run of this step) are taken from there
        and not asked about again. With ``details`` the calls come along. ``progress`` is an accumulator of rows done."""
        todo = keys.not_done(df, saved, key) if saved is not None else df
        kind = T.StructType([*todo.schema.fields, T.StructField(self.result, T._parse_datatype_string(self.kind)), T.StructField("_ok", T.BooleanType())])
        calls = "array<struct<input_text:string,input_messages:array<struct<role:string,content:string>>,response:string,completion_mode:boolean>>"
        if details:
            kind = kind.add(f"{self.name}_details", T._parse_datatype_string(calls))
        step, names = self, todo.columns

        def logged(prompt, reply):
            text = isinstance(prompt, str)
            return {"input_text": prompt if text else None, "input_messages": None if text else prompt, "response": reply, "completion_mode": text}

        def run(frames):
            for pdf in frames:
                done = []
                for d in step.calls([dict(zip(names, r, strict=True)) for r in pdf[names].itertuples(index=False, name=None)]):
                    done.append(d)
                    if progress is not None:
                        progress.add(1)
                pdf[step.result] = [d[1] for d in done]
                pdf["_ok"] = [d[0] for d in done]
                if details:
                    pdf[f"{step.name}_details"] = [[logged(p, r) for p, r in d[2]] for d in done]
                yield pdf

        out = stored(todo.mapInPandas(run, kind), self.name).filter("_ok").drop("_ok")
        return out if saved is None else out.unionByName(saved, allowMissingColumns=True)


def in_flight(f: Callable[[Any], Any], items: list, concurrent: int, timeout: float | None, late: Any) -> Iterator[Any]:
    """f of each item in order, with ``concurrent`` calls under way at most; ``late`` for one that runs longer than ``timeout`` seconds.

    A late call's thread can't be stopped; it keeps its place until it ends, and nobody waits for it at the end."""
    import time
    from concurrent.futures import ThreadPoolExecutor

    if concurrent <= 1 and timeout is None:
        yield from map(f, items)
        return
    began: dict[int, float] = {}

    def timed(n, item):
        began[n] = time.monotonic()
        return f(item)

    pool = ThreadPoolExecutor(max(1, concurrent))
    futures: list = []
    try:
        for n, item in enumerate(items):
            while len(futures) < len(items) and len(futures) < n + 2 * max(1, concurrent):
                futures.append(pool.submit(timed, len(futures), items[len(futures)]))
            while not futures[n].done() and (timeout is None or n not in began or time.monotonic() - began[n] < timeout):
                # a call that waits for a place behind late ones has a place in a new pool
                if timeout is not None and n not in began and all(i in began and time.monotonic() - began[i] >= timeout for i in range(n) if not futures[i].done()) and any(not x.done() for x in futures[:n]):
                    pool.shutdown(wait=False, cancel_futures=True)
                    pool = ThreadPoolExecutor(max(1, concurrent))
                    futures[n:] = [x if i in began else pool.submit(timed, i, items[i]) for i, x in enumerate(futures[n:], n)]
                wait([futures[n]], 0.01 if timeout is not None else None)
            yield futures[n].result() if futures[n].done() else late
            futures[n] = futures[n] if not futures[n].done() else _Done
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


class _Done:
    """Stands for a call whose result was handed on."""

    done = staticmethod(lambda: True)


def one_to_many(step: Step, df: DataFrame, key: str = "row_key") -> DataFrame:
    """A step whose result is a list, and a row for each item; rows with an empty list vanish."""
    rows = step.over(df, key)
    return keys.children(rows.withColumnRenamed(step.result, "_items"), key, F.col("_items"), step.result).drop("_items")


def voted(step: Step, df: DataFrame, needed: int, threshold: float = 0.5, key: str = "row_key", saved: DataFrame | None = None, combine: Callable[..., DataFrame] = quality.majority) -> DataFrame:
    """``needed`` votes a row, their combination (the majority, or another function of votes, key and threshold that gives
    n_votes and passed), and the rows that pass. ``saved`` votes (key, vote_idx, vote) are counted and
    only missing ones are asked for. Rows of which any vote failed do not pass."""
    asked = df.withColumn("vote_idx", F.explode(F.sequence(F.lit(0), F.lit(needed - 1))))
    if saved is not None:
        asked = asked.join(saved.select(key, "vote_idx"), [key, "vote_idx"], "left_anti")
    votes = step.over(asked.withColumn("_vote_key", F.concat_ws("#", F.col(key).cast("string"), "vote_idx")), "_vote_key").select(key, "vote_idx", F.col(step.result).alias("vote"))
    if saved is not None:
        votes = votes.unionByName(saved.select(key, "vote_idx", "vote"))
    verdict = combine(votes, key, threshold=threshold).filter(F.col("n_votes") >= needed)
    return df.join(verdict.filter("passed").select(key), key, "left_semi")


def varied(step: Step, df: DataFrame, count: int, templates: list[str], key: str = "row_key") -> DataFrame:
    """Up to ``count`` results a row, each from a template chosen by hash: ``variations`` in order. A failed try ends the
    row's later ones; rows keep what they have."""
    rows = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("variation_idx"))
    chosen = F.element_at(F.array(*[F.lit(t) for t in templates]), (F.pmod(F.xxhash64(F.col(key), "variation_idx"), F.lit(len(templates))) + 1).cast("int"))
    one = Step(**{**step.__dict__, "template": "{_prompt}"})

    class Chosen:
        def complete(self, prompt: str) -> str:
            return step.engine.complete(prompt)

    rendered = rows.withColumn("_prompt", chosen)
    for c in df.columns:
        rendered = rendered.withColumn("_prompt", F.replace("_prompt", F.lit("{" + c + "}"), F.coalesce(F.col(c).cast("string"), F.lit(""))))
    one.engine = Chosen()
    done = one.over(rendered.withColumn("_vk", F.concat_ws("#", F.col(key).cast("string"), "variation_idx")), "_vk")
    got = done.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("variation_idx", step.result))).alias("_v"))
    unbroken = F.filter("_v", lambda v, i: v["variation_idx"] == i)
    return df.join(got, key, "left").withColumn("variations", F.coalesce(F.transform(unbroken, lambda v: v[step.result]), F.array().cast("array<string>"))).drop("_v")


def depth_first(steps: list[Step], df: DataFrame, key: str = "row_key") -> DataFrame:
    """All steps for each row in turn, in one pass; rows that fail a step are dropped."""
    kind = T.StructType([*df.schema.fields, *[T.StructField(s.result, T._parse_datatype_string(s.kind)) for s in steps], T.StructField("_ok", T.BooleanType())])
    names = df.columns

    def run(frames):
        for pdf in frames:
            rows = []
            for r in pdf[names].itertuples(index=False, name=None):
                row, ok = dict(zip(names, r, strict=True)), True
                for s in steps:
                    value = None
                    if ok:
                        ok, value, _ = s.call(row)
                    row[s.result] = value
                rows.append(row | {"_ok": ok})
            yield pdf.__class__(rows, columns=[f.name for f in kind])

    return stored(df.mapInPandas(run, kind), "depth_first").filter("_ok").drop("_ok")


def call_log(rows: DataFrame, name: str) -> DataFrame:
    """Calls of a step as rows: input and output words of each, for cost accounting."""
    from ..functions.text import token_count

    calls = rows.select(F.explode(f"{name}_details").alias("d"))
    return calls.select(F.lit(name).alias("step"), token_count("d.input_text").alias("input_tokens"), token_count("d.response").alias("output_tokens"))


def cached_reply(engine: Engine, prompts: DataFrame, cache: DataFrame | None = None, prompt: str = "prompt") -> DataFrame:
    """(cache_key, prompt, reply) for the distinct prompts; those in ``cache`` by the md5 of the prompt are not asked again."""
    wanted = prompts.select(F.col(prompt).alias("prompt")).distinct().withColumn("cache_key", F.md5(F.col("prompt").cast("binary")))
    todo = wanted if cache is None else wanted.join(cache.select("cache_key"), "cache_key", "left_anti")
    asked = Step("reply", "{prompt}", "reply", engine).over(todo, "cache_key").select("cache_key", "prompt", "reply")
    return asked if cache is None else asked.unionByName(cache.select("cache_key", "prompt", "reply"))
