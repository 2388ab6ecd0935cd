"""Steps, resumption, votes, parsers, readers, sinks, streams and whole pipelines with the rule engine."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from sparquern.functions import stories as S
from sparquern.functions import text as T
from sparquern.operators import chunking, keys, parsers, quality, retrieval, sampling
from sparquern.operators.steps import HttpEngine, RuleEngine, Step, cached_reply, call_log, depth_first, load_prompt, one_to_many, render, varied, voted
from sparquern.plans import pipelines as P
from sparquern.session import ROOT
from sparquern.sources import readers, sinks
from sparquern.streaming import ingest

TEXTS = ["The first text says that rivers run to the sea. It is short but long enough.", "A second text. It tells of mountains, of snow and of the long way down to the plain.", "Third: nothing but a list of names and places, one after another, none of them real."]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(f"k{i}", t, f"f{i}.txt") for i, t in enumerate(TEXTS)], "row_key string, text string, metadata string")


def test_render_leaves_unknown_keys():
    assert render("{a} {b} } {", {"a": 1}) == "1 {b} } {"


def test_retry_feeds_the_error_back():
    engine = RuleEngine([("too short", "long enough reply"), ("", "x")])
    step = Step("s", "{text} {error_message}", "r", engine, valid=lambda v, _: (len(v) > 3, "too short"))
    ok, value, calls = step.call({"text": "t"})
    assert ok and value == "long enough reply" and len(calls) == 2
    never = Step("s", "{text}", "r", RuleEngine([], "x"), parse=int)
    ok, _, calls = never.call({"text": "t"})
    assert not ok and len(calls) == 6


def test_step_drops_failures_and_resumes(rows):
    step = Step("n", "{text}", "n", RuleEngine([("second", "no number"), ("", "7")]), int, "int")
    out = step.over(rows)
    assert {r["row_key"]: r["n"] for r in out.collect()} == {"k0": 7, "k2": 7}
    other = Step("n", "{text}", "n", RuleEngine([], "8"), int, "int")
    again = other.over(rows, saved=out)
    assert {r["row_key"]: r["n"] for r in again.collect()} == {"k0": 7, "k1": 8, "k2": 7}
    logged = call_log(Step("n", "{text}", "n", RuleEngine([], "8 9")).over(rows, details=True), "n")
    assert [r["output_tokens"] for r in logged.collect()] == [2, 2, 2]


def test_one_to_many(rows):
    step = Step("items", "{text}", "item", RuleEngine([("Third", ""), ("", "a,b")]), lambda r: [x for x in r.split(",") if x], "array<string>")
    out = one_to_many(step, rows).collect()
    assert sorted((r["parent_key"], r["child_idx"], r["item"]) for r in out) == [("k0", 0, "a"), ("k0", 1, "b"), ("k1", 0, "a"), ("k1", 1, "b")]
    assert all(r["row_key"].startswith(f"{r['parent_key']}-{r['child_idx']}-") and r["text"] for r in out)


class Sleeping:
    """An engine that takes its time, and knows how many calls were with it at once."""

    now = most = 0

    def complete(self, prompt):
        import threading
        import time

        lock = Sleeping.__dict__.get("lock") or threading.Lock()
        Sleeping.lock = lock
        with lock:
            Sleeping.now += 1
            Sleeping.most = max(Sleeping.most, Sleeping.now)
        time.sleep(1.5 if "late" in prompt else 0.05)
        with lock:
            Sleeping.now -= 1
        return prompt


def test_calls_in_flight_and_late_ones():
    import time

    step = Step("s", "{t}", "r", Sleeping(), concurrent=8)
    began = time.monotonic()
    assert [v for _, v, _ in step.calls([{"t": str(i)} for i in range(64)])] == [str(i) for i in range(64)]
    assert 4 <= Sleeping.most <= 8 and time.monotonic() - began < 64 * 0.05 / 2
    step = Step("s", "{t}", "r", Sleeping(), concurrent=2, timeout=0.4)
    done = [v for _, v, _ in step.calls([{"t": t} for t in ("a", "late", "late", "late", "b", "c")])]
    assert done == ["a", None, None, None, "b", "c"]
    assert list(step.calls([])) == []


def test_steps_run_concurrently_in_spark(rows, spark):
    done = spark.sparkContext.accumulator(0)
    step = Step("s", [{"role": "system", "content": "be brief"}, {"role": "user", "content": "{text}"}], "r", RuleEngine([("second", "2")], "1"), concurrent=4)
    out = step.over(rows, details=True, progress=done).collect()
    assert {r["row_key"]: r["r"] for r in out} == {"k0": "1", "k1": "2", "k2": "1"} and done.value == 3
    first = out[0]["s_details"][0]
    assert not first["completion_mode"] and [m["role"] for m in first["input_messages"]] == ["system", "user"]


def test_http_engine_and_prompt_files(tmp_path):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            assert body["model"] == "m" and body["stop"] == ["\n\n"] and body["top_p"] == 0.9
            answer = {"message": {"content": body["messages"][-1]["content"] + "!"}} if self.path.endswith("chat/completions") else {"text": body["prompt"] + "."}
            data = json.dumps({"choices": [answer]}).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    engine = HttpEngine(f"http://127.0.0.1:{server.server_port}/v1", "m", parameters={"top_p": 0.9}, stop=("\n\n",))
    (tmp_path / "own").mkdir()
    (tmp_path / "default").mkdir()
    (tmp_path / "default" / "a.txt").write_text("default {x}")
    (tmp_path / "own" / "a.yaml").write_text("- role: user\n  content: own {x}\n")
    folders = [str(tmp_path / "own"), str(tmp_path / "default")]
    assert Step("s", load_prompt("a", folders), "r", engine).call({"x": 1})[1] == "own 1!"
    assert Step("s", load_prompt("a", folders[1:]), "r", engine).call({"x": 1})[1] == "default 1."
    with pytest.raises(FileNotFoundError):
        load_prompt("b", folders)
    server.shutdown()


def test_votes(rows, spark):
    yes = Step("v", "{vote_idx} {text}", "v", RuleEngine([("^[01] .*first", "true"), ("mountains", "true"), ("", "false")]), lambda r: r == "true", "boolean")
    assert {r["row_key"] for r in voted(yes, rows, 4).collect()} == {"k0", "k1"}  # a tie passes
    saved = spark.createDataFrame([("k2", i, True) for i in range(4)], "row_key string, vote_idx int, vote boolean")
    assert {r["row_key"] for r in voted(yes, rows, 4, saved=saved).collect()} == {"k0", "k1", "k2"}


def test_variations_and_depth_first(rows):
    made = varied(Step("v", "", "variation", RuleEngine([("^A", "a"), ("^B", "b")])), rows, 3, ["A {text}", "B {text}"]).collect()
    assert all(len(r["variations"]) == 3 and set(r["variations"]) <= {"a", "b"} for r in made)
    steps = [Step("a", "{text}", "a", RuleEngine([("Third", "bad"), ("", "1")]), int, "int"), Step("b", "{a}", "b", RuleEngine([("1", "then")]))]
    assert [(r["row_key"], r["b"]) for r in depth_first(steps, rows).orderBy("row_key").collect()] == [("k0", "then"), ("k1", "then")]


def test_reply_cache(rows):
    prompts = rows.select(F.col("text").alias("prompt"))
    first = cached_reply(RuleEngine([], "one"), prompts.limit(2))
    both = cached_reply(RuleEngine([], "two"), prompts, first)
    assert sorted(r["reply"] for r in both.collect()) == ["one", "one", "two"]


def test_merges(spark):
    a, b = spark.createDataFrame([(1, "n", None), (2, "n", "x")], "k int, a string, b string"), spark.createDataFrame([(2, None, "old"), (3, "s", "y")], "k int, a string, b string")
    assert sorted(map(tuple, keys.merged(a, b, "k").collect())) == [(1, "n", None), (2, None, "old"), (3, "s", "y")]
    assert sorted(map(tuple, keys.upserted(a, b, "k").collect())) == [(1, "n", None), (2, "n", "old"), (3, "s", "y")]


def test_chunks_keep_the_order_and_the_limit(spark):
    text = "One two three. Four five six seven.\n\n" + " ".join(f"w{i}" for i in range(30)) + ". End here now.\n\nLast part."
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    out = chunking.chunked(df, 12, least_chars=0).orderBy("chunk_idx").collect()
    assert " ".join(r["text"] for r in out).split() == text.split()
    assert [r["n_tokens"] for r in out if r["n_tokens"] > 12] == [30]


def test_character_chunks():
    text = "A short one.\n\n" + "x" * 30 + ". " + "y" * 40
    out = list(chunking.character_chunks(text, 20))
    assert "".join(out).replace(" ", "") == text.replace("\n", "").replace(" ", "") and max(map(len, out)) <= 30


def test_budget_prefix_equals_a_running_sum(spark):
    rows = [(i, f"{(i * 7919) % 4096:03x}{i:05d}", (i * 13) % 50) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, h string, n int")
    total, want = 0, set()
    for i, _, n in sorted(rows, key=lambda r: (r[1], r[0])):
        if total < 3000:
            want.add(i)
        total += n
    assert {r["doc_id"] for r in chunking.budget_prefix(df, F.col("h"), "n", 3000).collect()} == want


def test_sampling_is_independent_of_partitions(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    assert {r["doc_id"] for r in sampling.hash_subset(df, 20).collect()} == {r["doc_id"] for r in sampling.hash_subset(df.repartition(7), 20).collect()}


CASES = [
    ("## Summary\nFirst line\nsecond line\n**Points:**\n- one\n* two\nrest\n", {"summary": {"name": "paragraph"}, "points": {"name": "list"}}, {"summary": "First line second line", "points": ["one", "two"]}),
    ("Coherence\nRating: poor\nRating: **good**\n", {"coherence": {"name": "rating", "prefix": "Rating:"}, "quality": {"name": "rating", "prefix": "Rating:"}}, {"coherence": "good", "quality": None}),
]


@pytest.mark.parametrize(("text", "headings", "want"), CASES)
def test_sections(text, headings, want, spark):
    assert parsers.sections(text, headings) == want
    got = spark.createDataFrame([(text,), (None,)], "t string").select(parsers.sections_column("t", headings).alias("m")).collect()
    assert got[0]["m"] == {h: v if isinstance(v, list) else [v] for h, v in want.items() if v is not None} and got[1]["m"] is None


def test_story_parsers():
    chat = parsers.chat_messages("Mirela: hello\nmore\n{user}: hi\nMirela: hello\nmore\nMirela: again", "Mirela")
    assert [m["owner"] for m in chat] == ["Mirela", "{user}", "Mirela", "Mirela"] and chat[0]["content"] == "hello\nmore"
    assert len(parsers.tidy_story(chat, 50)) == 3
    assert parsers.ratings("Coherence\nRating: Good.", ["Coherence"]) == {"coherence": "good"}
    with pytest.raises(ValueError):
        parsers.ratings("Coherence\nRating: fine", ["Coherence"])
    card = parsers.scene_card("**Name:** Mirela\nPersonality:\n- calm\n- dry\nScene: a cave\nEND OF CARD\nName: no")
    assert card["Name"] == "Mirela" and card["Personality"] == ["calm", "dry"] and card["Likes"] is None and parsers.scene_card(parsers.card_text(card)) == card
    talk = "**User:** What is it?\n**AI Assistant:** It is a thing of note.\n"
    assert parsers.dialogue(talk) == [("What is it?", "It is a thing of note.")] and parsers.faithful_dialogue(talk, [("What is it?", "It is a thing of note.")])
    assert parsers.clustered_repeats("abcabcabc xyz", 3, 2, 20) and not parsers.clustered_repeats("abc" + "".join(map(chr, range(200, 240))) + "abc", 3, 1, 20)


def test_noise_and_similarity(spark):
    df = spark.createDataFrame([(1, "some words to type in here " * 5), (2, None)], "k int, t string")
    noisy = parsers.typing_noise("t", "k", 0.2)
    a, b = (df.select(noisy.alias("x")).collect() for _ in range(2))
    assert a == b and a[0]["x"] != TEXTS[0] and a[1]["x"] is None
    assert df.select(parsers.similarity("t", "t").alias("s")).first()["s"] == 1.0


def test_text_functions(spark):
    df = spark.createDataFrame([("they're an x-ray",)], "t string")
    one = lambda c: df.select(c.alias("x")).first()["x"]
    assert one(T.title_case("t")) == "They'Re An X-Ray"
    assert one(T.base_name(F.lit("Queen Odrun III"))) == "Odrun" and one(T.readable_size(F.lit(2048))) == "2.00 KB"
    assert one(T.json_escaped(F.lit('a"b\n'))) == 'a\\"b\\n' and one(T.quotes_escaped(F.lit('a"b'))) == 'a\\"b'
    assert one(T.boolean(F.lit(" Yes "))) is True and one(T.boolean(F.lit("maybe"))) is None
    assert one(T.numeric_rating(F.lit("<rating>9</rating>"))) == (None, False)
    assert one(T.without_inner_newlines(F.lit("a\nb.\nc"))) == "a b.\nc"


def test_readable_size_of_all_documents(spark, tmp_path):
    from sparquern.queries.texts import readable_size

    sizes = [(0, 10), (1, 1024), (2, 1024**2 - 1), (3, 1024**2), (4, 5 * 1024**2 // 2), (5, 3 * 1024**3)]
    rows = [(i, "x", "en", "s", n) for i, n in sizes]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    found = dict(map(tuple, readable_size(spark, str(tmp_path)).collect()))
    assert found == {0: "10.00 B", 1: "1.00 KB", 2: "1024.00 KB", 3: "1.00 MB", 4: "2.50 MB", 5: "3.00 GB"}


def test_doubled_runs_equal_the_pattern():
    import random
    import re

    rng = random.Random(2)
    for least in (1, 2, 3, 8):
        pattern = re.compile(r"(.{%d,}?)\1" % least)
        for _ in range(600):
            text = "".join(rng.choices("ab\né" if least < 8 else "abcdé\n", k=rng.randint(0, 40)))
            if rng.random() < 0.5:
                own = "".join(rng.choices("abcdefé ", k=rng.randint(1, 14)))
                text = text[:9] + own * 2 + text[9:]
            assert T.doubled(text, least) == bool(pattern.search(text)), (text, least)
    long = "".join(rng.choices("abcdefgh ", k=120_000))
    assert not T.doubled(long, 12) and T.doubled(long + long, 12)


def test_located_maps_offsets_of_any_letters(spark):
    docs = spark.createDataFrame([(1, "İabc"), (2, "İİ x A-b.C ß"), (3, None), (4, "")], "doc_id long, text string")
    out = retrieval.located(docs, spark.createDataFrame([(9, "abc"), (8, "  "), (7, None)], "item_id long, text string")).collect()
    assert sorted(map(tuple, out)) == [(9, 1, 1, 4), (9, 2, 5, 10)]


def test_bm25_equals_plain_scores(spark):
    import math
    import random
    from collections import Counter

    rng = random.Random(4)
    texts = [" ".join(rng.choices(["red", "Blue", "green", "x1", "y_2", "the"], [1, 2, 3, 1, 1, 20], k=rng.randint(0, 30))) for _ in range(80)]
    queries = ["the red", "blue blue GREEN", "nothing", "", "x1 y_2 the"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "red"), (90, None)], "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(list(enumerate(queries)), "item_id long, text string")
    out = sorted(map(tuple, retrieval.bm25(docs, asked, 5, block=2).collect()))
    tokens = [t.lower().split() for t in [*texts, "red", ""]]
    n, mean = len(tokens), sum(map(len, tokens)) / len(tokens)
    df, want = Counter(w for t in tokens for w in set(t)), []
    for q, text in enumerate(queries):
        scores = []
        for i, t in [*enumerate(tokens[:80]), (90, [])]:
            tf = Counter(t)
            s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(t) / mean)) for w in set(text.lower().split()) if tf[w])
            scores.append((-round(s, 6), i))
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(x for x in scores if x[0])[:5])]
    assert [o[:3] for o in out] == [w[:3] for w in sorted(want)] and all(abs(a[3] - b[3]) < 2e-6 for a, b in zip(out, sorted(want), strict=True))


def test_sharing_characters(spark):
    docs = spark.createDataFrame([(1, "abcdefgh"), (2, "xxcdefxx"), (3, None), (4, "abc")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "zzcdefzz"), (8, "abcd"), (9, "abc"), (6, None)], "item_id long, text string")
    for chars in (4, 1000):
        assert sorted(map(tuple, retrieval.sharing_characters(docs, items, 4, block_chars=chars).collect())) == [(7, 1), (7, 2), (8, 1)]


def test_cases_of_any_letters(spark):
    texts = ["straße über ñandú", "", "Éa b", "a  b\tc"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cap = lambda w: w[:1].upper() + w[1:].lower()
    names = ["pascal", "alternating", "invert", "random", lambda t, _: F.reverse(t)]
    names[4].__name__ = "backwards"
    out = {r["doc_id"]: {v["variation"]: v["text"] for v in r["v"]} for r in df.select("doc_id", T.case_variations("text", names).alias("v")).collect()}
    for i, t in enumerate(texts):
        assert out[i]["pascal"] == "".join(map(cap, t.split())) and out[i]["backwards"] == t[::-1]
        assert out[i]["alternating"] == "".join(c.lower() if j % 2 == 0 else c.upper() for j, c in enumerate(t))
        assert out[i]["invert"] == "".join(c.lower() if c == c.upper() else c.upper() for c in t)
        assert out[i]["random"].lower().replace("ss", "ß") == t.lower()


def test_conversation_checks():
    pairs = [("What is the colour of the river?", "It is green as grass in the early spring."), ("And of the sea?", "The sea is grey, they say, and seldom blue.")]
    turns = [x for q, a in pairs for x in (("User", "Well, " + q), ("AI Assistant", a + " Yes."))]
    greeting = [("User", "Hello there, friend of mine"), ("AI Assistant", "Good day to you, whoever you are")]
    assert parsers.long_enough(turns, pairs) and not parsers.long_enough(turns[:3], pairs)
    assert parsers.answers_kept(turns, pairs, 15) and parsers.answers_kept(greeting + turns, pairs, 15)
    assert not parsers.answers_kept([turns[0], turns[1], turns[2], ("AI Assistant", "nothing of the kind was said")], pairs, 15)
    assert parsers.questions_kept(turns, pairs, 15) is True and parsers.questions_kept(greeting + turns, pairs, 15) is True
    assert parsers.questions_kept([("User", "Something else altogether"), *turns[1:2], ("User", "and so on"), turns[3]], pairs, 15) is None
    assert parsers.questions_kept([turns[0], turns[1], ("User", "no such thing"), turns[3]], pairs, 15) is False
    assert parsers.no_foreign_quotes(turns, pairs, 15)
    assert not parsers.no_foreign_quotes([*turns[:2], ("AI Assistant", pairs[1][1]), turns[3]], pairs, 15)
    text = "".join(f"**{who if who == 'User' else 'AI Assistant'}:** {said}\n" for who, said in turns)
    assert parsers.faithful_dialogue(text, pairs) and not parsers.faithful_dialogue(text.replace("grass", "moss").replace("early", "late").replace("green", "red"), pairs)


def test_story_columns(spark):
    df = spark.createDataFrame([("**Name:** Mirela\nPersonality:\n- calm\nScene: a cave", "style\nRating: **good**\nplot\nRating: poor."), (None, "style\nRating: odd")], "card string, rated string")
    out = df.select(parsers.card_column("card").alias("c"), parsers.ratings_column("rated", ["style", "plot"]).alias("r")).collect()
    assert out[0]["c"]["Name"] == ["Mirela"] and out[0]["c"]["Personality"] == ["calm"] and out[0]["r"] == {"style": "good", "plot": "poor"}
    assert out[1]["c"] is None and out[1]["r"] is None
    texts = ["JOY: bright", " ", "x " * 601, "again and again, " * 9, None]
    ok = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(S.emotion_ok("t")).collect()]
    assert ok == [True, False, False, False, False]
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(S.card_name(F.lit("no name"))) is None and one(S.conversation_starter(F.lit("nothing"), F.lit("k"))) in S.STARTERS
    assert one(S.string_list(F.lit("[1]"))) is None and one(S.string_list(F.lit("['a']"))) == ["a"]


def test_files_caches_and_saved_datasets(spark, tmp_path, rows):
    uri = f"file://{tmp_path}"
    files = rows.select(F.concat(F.lit("a/b/"), "metadata").alias("path"), "text")
    assert sinks.write_text_files(files, f"{uri}/files") == 3
    assert (tmp_path / "files/a/b/f1.txt").read_text() == TEXTS[1] and len(list(tmp_path.glob("files/a/b/*"))) == 3
    with pytest.raises(Exception, match="leads out"):
        sinks.write_text_files(files.withColumn("path", F.lit("../x")), f"{uri}/files")
    readers.cached(rows, uri, "rows", {"most": 5})
    readers.cached(rows, uri, "rows", {"most": 5})
    readers.cached(rows.withColumn("text", F.upper("text")), uri, "rows", {"most": 5})
    assert len(list(tmp_path.glob("rows-*"))) == 2 and readers.cached(rows, uri, "rows", {"most": 5}).count() == 3
    readers.vector_index(rows, f"{uri}/index")
    changed = rows.withColumn("text", F.when(F.col("row_key") == "k1", "other").otherwise(F.col("text")))
    assert "other" in [r["text"] for r in readers.vector_index(changed, f"{uri}/index").collect()]
    rows.write.parquet(f"{uri}/hub/train")
    assert readers.saved_dataset(spark, f"{uri}/hub", f"{uri}/local", order="row_key", most=2).count() == 2
    assert readers.saved_dataset(spark, f"{uri}/hub", f"{uri}/local").count() == 2
    rows.write.parquet(f"{uri}/hub/test")
    with pytest.raises(ValueError, match="test, train"):
        readers.saved_dataset(spark, f"{uri}/hub", f"{uri}/other")
    path = sinks.rewritten(spark, f"{uri}/local", lambda df: df.withColumn("text", F.lit("x")), f"{uri}/versions")
    assert sinks.preview(spark.read.parquet(path), 5)[0]["text"] == "x" and sinks.cleaned(spark, f"{uri}/versions") and not sinks.cleaned(spark, f"{uri}/versions")
    (tmp_path / "7/meta_datagen/chat_lists").mkdir(parents=True)
    (tmp_path / "7/meta_datagen/chat_lists/a.jsonl").write_text('{"messages": [{"role": "user", "content": "hi"}]}\n{broken\n')
    (tmp_path / "7/meta_datagen/chat_lists/b.json").write_text('[{"conversations": [{"from": "human", "value": "ho"}]}]')
    found = sorted((r["run"], r["messages"][0]["role"], r["messages"][0]["content"]) for r in readers.read_chat_lists(spark, uri).collect())
    assert found == [(7, "user", "hi"), (7, "user", "ho")]
    (tmp_path / "t.txt").write_text("one two three")
    counts = {r["file"]: (r["n_rows"], r["n_tokens"]) for r in readers.tokens_over(spark, [f"{uri}/t.txt", f"{uri}/*.txt"]).collect()}
    assert counts == {"t.txt": (1, 3)}
    with pytest.raises(FileNotFoundError):
        readers.tokens_over(spark, [f"{uri}/none*"])


def test_neighbours_by_planes(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 12))
    vectors = np.concatenate([c + 0.05 * rng.normal(size=(15, 12)) for c in centres])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, embedding array<float>").repartition(3)
    found = {(r["query_id"], r["id"]) for r in retrieval.near_by_planes(df, 3).collect()}
    d = ((vectors[:, None] - vectors[None]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    exact = {(i, int(j)) for i in range(len(vectors)) for j in np.argsort(d[i])[:3]}
    assert len(found & exact) >= 0.9 * len(exact)
    assert retrieval.near_by_planes(df.limit(0), 3).count() == 0


def test_stories_and_contexts(spark):
    docs = spark.createDataFrame([("f", "\n\n".join(TEXTS))], "metadata string, text string")
    settings = P.Settings(most_tokens=20, neighbours=2, failures=0.5)
    told = P.stories(docs, s=settings).collect()
    assert told and all(r["tier"] == "good" and r["conversations"][0]["from"] == "system" and r["name"] for r in told)
    rag = P.rag_data(docs, s=settings).collect()
    assert rag and any(sum(t in x["text"] for t in TEXTS) for r in rag for x in r["segments"])
    step = Step("s", [{"role": "system", "content": "be brief"}, {"role": "user", "content": "{text}"}], "r", RuleEngine([], "ok"))
    made = step.over(P.chunks(docs, settings), details=True)
    rows = P.meta_dataset([made], ["s"], prompts={"be brief": "say little"}, shots=1).collect()
    assert {r["messages"][0]["content"] for r in rows} <= {"be brief", "say little"} and all(r["messages"][-1] == ("assistant", "ok") for r in rows)


def test_united_rows_keep_all_keys(spark):
    a, b = spark.createDataFrame([(0, "x"), (1, "y")], "n int, t string"), spark.createDataFrame([(0, "z"), (1, "x")], "n int, t string")
    assert sorted(map(tuple, keys.united([a, b], "t").collect())) == [(0, "x"), (0, "z"), (1, "y")]


def test_scratch_folder_of_clusters():
    from types import SimpleNamespace

    from sparquern.session import scratch_dir

    session = lambda conf, told, master: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: conf), sparkContext=SimpleNamespace(getCheckpointDir=lambda: told, master=master))
    assert scratch_dir(session("hdfs://a/", None, "yarn")) == "hdfs://a" and scratch_dir(session(None, "hdfs://b", "yarn")) == "hdfs://b"
    with pytest.raises(ValueError, match="checkpoint"):
        scratch_dir(session(None, None, "yarn"))
    assert scratch_dir(session(None, None, "local[2]")).startswith("file:///")


def test_metrics_of_nothing(spark):
    empty = spark.createDataFrame([], "a int, b int")
    assert tuple(quality.accuracy(empty, "a", "b").first()) == (0, None)


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/a.txt").write_bytes(b"caf\xe9 text")
    (tmp_path / "in/sub/b.md").write_text("second")
    (tmp_path / "in/c.jsonl").write_text('{"text": "one"}\nbroken\n{"other": 1}\n')
    (tmp_path / "in/d.json").write_text(json.dumps([{"text": "two"}]))
    conv = {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}
    (tmp_path / "conv").mkdir()
    (tmp_path / "conv/e.jsonl").write_text(json.dumps(conv) + "\n")
    folder = f"file://{tmp_path}/in"
    assert sorted(r["text"] for r in readers.read_text(spark, folder).collect()) == ["caf� text", "second"]
    assert sorted(r["text"] for r in readers.read_completions(spark, folder).collect()) == ["one", "two"]
    assert readers.read_all_text(spark, folder).count() == 4 and readers.read_all_text(spark, folder, jsonl_as_text=True).count() == 5
    assert [(r["human"], r["gpt"], r["source_file"]) for r in readers.read_pairs(spark, f"file://{tmp_path}/conv").collect()] == [("q", "a", "e.jsonl")]
    with pytest.raises(ValueError):
        readers.load_dataset(spark, "x.csv")
    df = spark.createDataFrame([("f1", "x"), ("f2", "y")], "source_file string, text string")
    sinks.write_by_source(df, f"{tmp_path}/by")
    assert spark.read.json(f"{tmp_path}/by/all").count() == 2
    assert sinks.write_text_files(df, f"{tmp_path}/texts", "source_file") == 2
    path = sinks.upsert(spark.createDataFrame([(1, "a")], "k int, v string"), None, "k", f"{tmp_path}/state")
    assert spark.read.parquet(path).count() == 1
    assert readers.checkpoint_or_none(spark, f"{tmp_path}/none") is None
    assert "datasets" in sinks.training_config([sinks.completion_dataset("x")], "out")


def test_streams(spark, tmp_path):
    docs = spark.createDataFrame([(i, "\n\n".join(TEXTS)) for i in range(6)], "doc_id long, text string")
    docs.repartition(3).write.parquet(f"{tmp_path}/in")
    streamed = ingest.stream(spark, f"{tmp_path}/in", "doc_id long, text string", 1)
    ingest.chunk_stream(streamed, 20, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(120)
    want = sorted(map(tuple, chunking.chunked(docs, 20).collect()))
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").select("doc_id", "chunk_idx", "text", "n_tokens").collect())) == want
    ingest.step_stream(ingest.stream(spark, f"{tmp_path}/in", "doc_id long, text string", 1), lambda b: chunking.chunked(b, 20), f"{tmp_path}/out2", f"{tmp_path}/cp2").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out2").count() == len(want)


def test_pipelines(spark):
    docs = spark.createDataFrame([(f"f{i}.txt", t) for i, t in enumerate(TEXTS)], "metadata string, text string")
    s = P.Settings(variations=2)
    qa = P.single_source_qa(docs, s=s)
    assert qa["qa"].count() == 3 and qa["groups"].count() == 1
    assert P.representation_variation(docs, s=s).count() == 3 * (2 + 2 + (1 + 2))
    assert P.corrections(docs).count() == 3
    assert P.stories(docs).count() == 3
    assert P.rag_data(docs, s=s).count() == 3
    pages = spark.createDataFrame([("a", 1, "two"), ("a", 0, "one "), ("b", 0, "x")], "file string, index int, text string")
    assert sorted(map(tuple, P.cleaned_files(pages).collect())) == [("a", "one two"), ("b", "x")]
    turns = [("human", "q1"), ("gpt", "a1"), ("human", "q2"), ("gpt", "a2")]
    conv = spark.createDataFrame([(1, [{"from": f, "value": v} for f, v in turns])], "conv_id long, conversations array<struct<`from`:string,value:string>>")
    assert [len(r["conversations"]) for r in P.rephrased(conv).collect()] == [4]
    grpo = P.grpo_examples(conv, "Be brief.", 0.5, 100).collect()
    assert grpo[0]["answer"] in ("a1", "a2") and grpo[0]["prompt"][0]["role"] == "system"


def test_classifier(spark):
    docs = spark.createDataFrame([(f"{'good fine nice' if i % 2 else 'bad poor awful'} text number {i}",) for i in range(80)], "text string")
    engine = RuleEngine([("good", "Final label: pos"), ("bad", "Final label: neg")])
    _, accuracy, rows = P.classifier(docs, engine, ["neg", "pos"], 50, 20)
    assert accuracy > 0.9 and rows.count() == 70


def test_questions_by_text_hold_no_list_of_a_paragraph(spark):
    rows = [("p", i, f"q{i}", None if i % 5 == 2 else "ä" * i) for i in range(23)] + [("p", None, "late", "x"), ("none", 1, "q", None), (None, 3, "n", "y"), ("", 1, "", "")]
    df = spark.createDataFrame(rows, "paragraph string, n int, question string, answer string").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        made = keys.questions_by_text(df, "paragraph", "question", "answer", "n")
        found = {r["paragraph"]: r["question_answer_pairs"] for r in made.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    wanted = {}
    for p, _, q, a in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0)):
        wanted.setdefault(p, []).extend([] if a is None else [f"**QUESTION:**\n{q}\n\n**ANSWER:**\n{a}\n"])
    assert found == {p: "\n\n".join(blocks) if blocks else None for p, blocks in wanted.items()} and made.columns == ["paragraph", "question_answer_pairs"]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Window" not in plan
    assert keys.questions_by_text(df.limit(0), "paragraph", "question", "answer", "n").count() == 0


LONG_ROW = """
from pyspark.sql import functions as F
from sparquern.operators import keys
from sparquern.session import local_session

spark = local_session(1, 2, "600m")
df = spark.range(4500).select(F.lit("p").alias("paragraph"), F.col("id").alias("n"), F.lit("q").alias("question"), F.repeat(F.lit("x"), 1 << 16).alias("answer"))
made = keys.questions_by_text(df, "paragraph", "question", "answer", "n")
print(made.agg(F.count("*"), F.sum(F.octet_length("question_answer_pairs"))).first())
"""


def test_a_long_text_takes_its_length_of_the_heap_not_twice_as_much(tmp_path):
    env = os.environ | {"PYTHONPATH": str(ROOT), "TMPDIR": str(tmp_path), "SPARK_LOCAL_DIRS": str(tmp_path)}
    env.pop("PYSPARK_SUBMIT_ARGS", None)
    done = subprocess.run([sys.executable, "-c", LONG_ROW], env=env, capture_output=True, text=True, timeout=300)
    a_block = len("**QUESTION:**\nq\n\n**ANSWER:**\n\n\n\n") + (1 << 16)
    assert f"=1, sum(octet_length(question_answer_pairs))={4500 * a_block - 2})" in done.stdout, done.stderr[-3000:]


@pytest.mark.parametrize("long", [1, 40, 500])
def test_halves_before_long_texts_are_dropped(spark, monkeypatch, long):
    monkeypatch.setattr(keys, "LONG_TEXT", long)
    rows = [(p, i, f"\n\n**QUESTION:**{i}", a) for p in ("a", None, "", "ä" * 20) for i, a in enumerate(["\n\n", "x" * 30, "", None, "ö" * len(p or "")])] + [("z", 1, None, "a")]
    df = spark.createDataFrame(rows, "paragraph string, n int, question string, answer string")
    made = keys.questions_by_text(df, "paragraph", "question", "answer", "n")
    wanted = {}
    for p, _, q, a in rows:
        wanted.setdefault(p, []).extend([] if a is None or q is None else [f"**QUESTION:**\n{q}\n\n**ANSWER:**\n{a}\n"])
    assert sorted(map(repr, map(tuple, made.collect()))) == sorted(repr((p, "\n\n".join(b) if b else None)) for p, b in wanted.items())
    # a generated filter would make each row again, in a buffer of twice its length
    lines = made._jdf.queryExecution().executedPlan().toString().split("\n")
    assert any("Filter exists(" in x and "*(" not in x.split("Filter")[0] for x in lines)


def test_tokens_over_tables_in_parts(spark, tmp_path):
    uri = f"file://{tmp_path}"
    rows = spark.createDataFrame([(i, None if i == 3 else "one two three"[: 3 + 4 * (i % 2)]) for i in range(6)], "n int, text string")
    rows.repartition(3).write.parquet(f"{uri}/docs.parquet")
    rows.write.partitionBy("n").parquet(f"{uri}/other table.parquet")
    rows.filter("false").write.parquet(f"{uri}/empty.parquet")
    (tmp_path / "a b+c%.txt").write_text("x y")
    made = readers.tokens_over(spark, [f"{uri}/docs.parquet", f"{uri}/*.parquet", f"{uri}/docs.parquet/*.parquet", f"{uri}/*.txt"])
    assert sorted(map(tuple, made.collect())) == [("a b+c%.txt", 1, 2), ("docs.parquet", 6, 7), ("empty.parquet", 0, None), ("other table.parquet", 6, 7)]
    parts = readers.tokens_over(spark, [f"{uri}/docs.parquet/*.parquet"]).collect()
    assert len(parts) == len(list((tmp_path / "docs.parquet").glob("*.parquet"))) and sum(r["n_rows"] for r in parts) == 6
