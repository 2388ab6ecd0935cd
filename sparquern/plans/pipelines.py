"""Pipelines as compositions of steps and operators. Engines are injected; each step's rows are stored once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import conversations as C
from ..functions import stories as S
from ..functions import text as T
from ..functions import verdicts as V
from ..operators import chunking, keys, quality, retrieval, sampling, segments
from ..operators.steps import Engine, RuleEngine, Step, depth_first, varied, voted
from ..session import stored

#: A rule engine that answers all prompts of these pipelines from the prompt's own text.
RULES = RuleEngine(
    [
        (r"^SUITABLE\?.*", "Judgment: suitable"),
        (r"^QUESTIONS\n(.{1,60}).*", r"**QUESTION:**\nWhat says: \1?\n**ANSWER:**\n\1\n"),
        (r"^VALID\?.*", "Final Judgment: relevant"),
        (r"^RELEVANT\?.*", "Explanation of Judgment: relevant"),
        (r"^ACCURATE\?.*", "Overall Accuracy Determination: accurate"),
        (r"^REPAIR\?.*", "Final judgment: PASS"),
        (r"^FACTS\n(.{1,60}).*", r"<atomic_facts>1. \1</atomic_facts>"),
        (r"^VARY\n(.{1,80}).*", r"<rewrite>\1</rewrite>"),
        (r"^CORRECT\n(.{1,40}).*", r"<question>What?</question><flawed_answer>no \1</flawed_answer><critique>wrong</critique><corrected_answer>\1</corrected_answer>"),
        (r"^THINK\n(.{1,60}).*", r"<think>about it</think>\1"),
        (r"^LABEL\n.*", "Final label: other"),
        (r"^(?:EMOTION|FEATURES|STORY)\n(.{1,40}).*", r"\1"),
        (r"^CARD\n(\w+).*", r"Name: \1\nPersonality:\n- calm"),
        (r"^RATE\n.*", "good"),
    ]
)


@dataclass
class Settings:
    most_tokens: int = 100
    paragraph: str = chunking.PARAGRAPH
    subset: int | None = None
    votes: int = 3
    group: int = 3
    variations: int = 2
    neighbours: int = 3
    failures: float = 0.1


def chunks(docs: DataFrame, s: Settings) -> DataFrame:
    """(row_key, text, metadata) of the chunks of (metadata, text); row_key is the content's hash and its place."""
    rows = chunking.chunked(docs.select("metadata", "text"), s.most_tokens, s.paragraph)
    keyed = rows.withColumn("row_key", F.sha2(F.concat_ws("|", F.col("metadata").cast("string"), F.col("chunk_idx").cast("string"), "text"), 256)).select("row_key", "text", "metadata")
    return keyed if s.subset is None else sampling.hash_subset(keyed, s.subset, tie="row_key")


def verdict_step(engine: Engine, name: str, head: str, parse, fields: str = "{text}") -> Step:
    """A step whose result is a boolean; a reply without a verdict is asked for again."""

    def strictly(reply: str) -> bool:
        v = parse(reply)
        if v is None:
            raise ValueError("no verdict")
        return v

    return Step(name, f"{head}\n{fields}", name, engine, strictly, "boolean")


def suitable(rows: DataFrame, engine: Engine) -> DataFrame:
    def parse(r: str) -> bool | None:
        low = r.lower()
        return False if "unsuitable" in low or "table of contents" in low else True if "suitable" in low else None

    return verdict_step(engine, "suitable", "SUITABLE?", parse).over(rows).filter("suitable").drop("suitable")


def _judged(marker: str, yes: str, no: tuple[str, ...]):
    def parse(r: str) -> bool | None:
        low = r.lower().partition(marker)[2]
        return False if any(n in low for n in no) else True if yes in low else None

    return parse


def questions(rows: DataFrame, engine: Engine) -> DataFrame:
    """A row for each question and answer of a chunk."""
    replies = Step("qa", "QUESTIONS\n{text}", "reply", engine).over(rows)
    return keys.children(replies.select("*", T.qa_pairs("reply").alias("_qa")).drop("reply"), "row_key", F.col("_qa"), "qa").select("row_key", "parent_key", "child_idx", "text", "metadata", "qa.question", "qa.answer")


def single_source_qa(docs: DataFrame, engine: Engine = RULES, s: Settings = Settings()) -> dict[str, DataFrame]:
    """Questions on single chunks, checked by votes and packed: ``qa`` rows and ``groups`` of them. Rejected rows stay rejected."""
    good = suitable(chunks(docs, s), engine)
    qa = questions(good, engine)
    both = "{question}\n{answer}\n{text}"
    for name, head, parse in (
        ("valid", "VALID?", _judged("final judgment:", "relevant", V.REJECTING)), ("relevant", "RELEVANT?", _judged("explanation of judgment:", "relevant", V.REJECTING)),
        ("accurate", "ACCURATE?", _judged("overall accuracy determination:", "accurate", V.INACCURATE)),
    ):
        qa = voted(verdict_step(engine, name, head, parse, both), qa, s.votes)
    repaired = Step("repair", "REPAIR?\n" + both, "reply", engine).over(qa).withColumn("r", V.context_repair("reply"))
    qa = repaired.filter("r.verdict in ('keep', 'reword')").withColumns({"question": F.coalesce("r.question", "question"), "answer": F.coalesce("r.answer", "answer")}).drop("reply", "r")
    qa = stored(qa, "qa")
    packed = chunking.singles_packed(qa.withColumnRenamed("parent_key", "parent"), "parent", s.group, F.md5(F.col("question").cast("binary")), "row_key")
    groups = packed.groupBy("pack_id").agg(F.array_sort(F.collect_list(F.struct("parent", "child_idx", "question", "answer"))).alias("qa"))
    turns = F.flatten(F.transform("qa", lambda p: F.array(C.turn(F.lit("human"), p["question"]), C.turn(F.lit("gpt"), p["answer"]))))
    return {"qa": qa, "groups": groups.select("pack_id", turns.alias("conversations"))}


def multi_source_qa(docs: DataFrame, vectors: DataFrame, engine: Engine = RULES, s: Settings = Settings(), tables: int = 8, bits: int | None = None) -> DataFrame:
    """Questions on a chunk together with its neighbours' texts. ``vectors``: (row_key, id, embedding) of the chunks.

    Neighbours come from an index of random hyperplanes (retrieval.near_by_planes), so no chunk meets all others."""
    good = suitable(chunks(docs, s), engine).join(vectors.select("row_key", "id"), "row_key")
    near = retrieval.near_by_planes(vectors.select("id", "embedding"), s.neighbours, tables, bits)
    texts = near.join(good.select("id", F.substring("text", 1, 6000).alias("t")), "id").groupBy("query_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "t"))), lambda x: x["t"]), "\n\n").alias("more"))
    joined = good.join(texts, good["id"] == texts["query_id"], "left").select("row_key", F.concat_ws("\n\n", "text", "more").alias("text"), "metadata")
    return questions(joined, engine)


def representation_variation(docs: DataFrame, engine: Engine = RULES, s: Settings = Settings(), cases: tuple[str, ...] = ("lowercase",)) -> DataFrame:
    """Corpus rows: each chunk, its facts, its variations, and each case of the text and the variations: 2 + V + F (1 + V) rows."""
    rows = Step("facts", "FACTS\n{text}", "reply", engine).over(suitable(chunks(docs, s), engine)).withColumn("facts", T.atomic_facts("reply")).drop("reply")
    made = varied(Step("vary", "", "variation", engine), rows, s.variations, ["VARY\n{text}"])
    plain = F.transform("variations", lambda v: F.coalesce(T.tag_first(v, "rewrite"), v))
    cased = F.flatten(F.transform(F.concat(F.array("text"), plain), lambda t: F.transform(T.case_variations(t, list(cases)), lambda c: c["text"])))
    return segments.corpus_rows(made.withColumn("_all", F.concat(plain, cased)), "row_key", "text", "facts", "_all")


def stories(docs: DataFrame, engine: Engine = RULES, s: Settings = Settings()) -> DataFrame:
    """Stories with a character's card, ratings and tier; all steps of a chunk run one after the other. Stories of one name
    share the card of the first of them."""
    steps = [
        Step("emotion", "EMOTION\n{text}", "emotion", engine, valid=lambda v, _: (bool(v.strip()), "empty")), Step("features", "FEATURES\n{emotion} {text}", "features", engine),
        Step("card", "CARD\n{features} {text}", "card", engine), Step("story", "STORY\n{card} {text}", "story", engine), Step("rate", "RATE\n{story}", "rating", engine),
    ]
    rows = depth_first(steps, chunks(docs, s))
    rows = rows.withColumns({"emotion": S.emotion_line("emotion"), "name": F.coalesce(T.base_name(S.card_name("card")), F.lit(""))}).withColumn("ratings", F.create_map(F.lit("quality"), F.lower("rating")))
    named = segments.canonical_first(rows, "name", "row_key", ["card"])
    tier = F.when(V.story_ok(F.col("ratings"), ("incredible",)), "incredible").when(V.story_ok(F.col("ratings")), "good").otherwise("other")
    return named.withColumns({"tier": tier, "conversations": S.story_conversation(F.col("card"), F.col("story"), F.col("name"))})


def rag_data(docs: DataFrame, engine: Engine = RULES, s: Settings = Settings()) -> DataFrame:
    """Groups of questions, each with the texts that retrieval might have found: its own among others, or for a share of
    failures others alone; as segments of which the focus is learned."""
    good = suitable(chunks(docs, s), engine)
    qa = questions(good, engine)
    found = sampling.negative_contexts(good, "row_key", "text", s.neighbours, s.failures).withColumnRenamed("row_key", "parent_key")
    asked = qa.join(found, "parent_key").withColumn("question", F.concat(F.array_join("contexts", "\n\n"), F.lit("\n\n"), F.col("question")))
    numbered = keys.ordinals(asked, "row_key", name="n").withColumn("group", F.floor(F.col("n") / s.group))
    return segments.group_segments(numbered, "group", "n", "question", "answer")


def corrections(docs: DataFrame, engine: Engine = RULES, s: Settings = Settings()) -> DataFrame:
    """Segments of a flawed answer, masked, and its correction."""
    rows = Step("correct", "CORRECT\n{text}", "reply", engine).over(suitable(chunks(docs, s), engine)).withColumn("c", V.correction_parts("reply")).filter("c is not null")
    full = F.concat(F.lit("A: "), F.col("c.flawed_answer"), F.lit("\nCritique: "), F.col("c.critique"))
    return rows.withColumn("_full", full).select("row_key", segments.correction_segments("text", F.col("c.question"), F.col("c.flawed_answer"), F.col("c.corrected_answer"), F.col("_full")).alias("segments")).filter("segments is not null")


def cleaned_files(pages: DataFrame, engine: Engine | None = None) -> DataFrame:
    """(file, text): pages (file, index, text), cleaned by the engine if there is one, joined in order."""
    keyed = pages.withColumn("row_key", F.concat_ws("#", "file", F.col("index").cast("string")))
    done = keyed if engine is None else Step("clean", "CLEAN\n{text}", "clean", engine, valid=lambda r, _: ("think" not in r or "</think>" in r, "open thought")).over(keyed).withColumn("text", T.strip_think("clean"))
    return keys.recombined(done, "file", "index", "text").select("file", F.array_join("sorted.text", "").alias("text"))


def rephrased(conversations: DataFrame, engine: Engine = RULES, most: int = 4500, key: str = "conv_id") -> DataFrame:
    """Conversations whose gpt turns got thoughts, from the history before each pair."""
    pairs = conversations.select(key, "conversations", F.explode(C.pairs("conversations")).alias("p"))
    rows = pairs.select(F.concat_ws("#", F.col(key).cast("string"), F.col("p.pair_idx").cast("string")).alias("row_key"), F.col(key), F.col("p.pair_idx").alias("pair_idx"), F.col("p.human").alias("human"), F.col("p.gpt").alias("gpt"), F.col("p.system").alias("system"), C.history_text(C.history("conversations", F.col("p.pair_idx"))).alias("history"))
    rows = rows.filter(T.token_count("gpt") <= most)
    done = Step("think", "THINK\n{gpt}\n{history}", "thought", engine).over(rows)
    back = done.groupBy(key).agg(F.first("system").alias("system"), F.array_sort(F.collect_list(F.struct("pair_idx", "human", F.col("thought").alias("gpt")))).alias("pairs"))
    return back.select(key, C.reassembled(F.col("system"), F.col("pairs")).alias("conversations"))


def classifier(docs: DataFrame, engine: Engine, classes: list[str], train: int, test: int, enough: float = 0.9):
    """(model, accuracy, labelled rows): labels by the engine for a hash-chosen slice, a linear model on hashed words,
    and its accuracy on the next slice; the caller takes a larger slice while it is not ``enough``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, Tokenizer

    rows = sampling.hash_split(docs.select(F.sha2("text", 256).alias("row_key"), F.col("text").alias("whole"), T.head_tail("text", 4000).alias("text")).dropDuplicates(["row_key"]), {"train": train, "test": test}, tie="row_key")
    named = Step("label", "LABEL\n{text}", "reply", engine).over(rows).withColumn("label", T.label_index(T.last_label("reply"), classes)).filter("label is not null")
    model = Pipeline(stages=[Tokenizer(inputCol="whole", outputCol="words"), HashingTF(inputCol="words", outputCol="features", numFeatures=1 << 14), LogisticRegression(labelCol="label", maxIter=20)]).fit(named.filter("split = 'train'"))
    scored = model.transform(named.filter("split = 'test'")).select("label", F.col("prediction").cast("int").alias("classifier_label"))
    found = quality.accuracy(scored, "label", "classifier_label").first()["accuracy"]
    return model, found, named


def grpo_examples(conversations: DataFrame, instruction: str, p: float, budget: int, key: str = "conv_id") -> DataFrame:
    """(key, prompt, answer): an instruction added, the answer one gpt turn chosen by hash, the prompt what precedes it within the budget."""
    rows = conversations.withColumn("c", C.system_added("conversations", instruction, "\n\n")).withColumn("at", C.truncation_turn("c", F.col(key).cast("string"), p)).filter("at is not null")
    prompt = F.slice("c", F.lit(1), F.col("at"))
    out = rows.withColumn("prompt", C.suffix_within(prompt, budget)).withColumn("answer", F.get("c", F.col("at"))["value"])
    return out.filter(F.size("prompt") > 0).select(key, C.to_openai("prompt").alias("prompt"), "answer")


def rag_answers(questions_: DataFrame, docs: DataFrame, vectors: DataFrame, asked_vectors: DataFrame, engine: Engine, k: int = 3, budget: int = 400) -> DataFrame:
    """Replies to questions from the passages that vector and term search find together."""
    near = retrieval.nearest(vectors, asked_vectors, 2 * k)
    ranked = retrieval.fused([near, retrieval.bm25(docs, questions_, 3 * k)], k)
    found = ranked.join(docs.select(F.col("doc_id").alias("id"), "text", F.col("source")), "id").groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "text", "source"))).alias("p"))
    context = retrieval.context_text(retrieval.shrunk(F.transform("p", lambda x: x["text"]), budget), F.transform("p", lambda x: x["source"]))
    rows = questions_.join(found, questions_["item_id"] == found["query_id"]).select(F.col("item_id").cast("string").alias("row_key"), F.col("text").alias("question"), context.alias("context"))
    return Step("answer", "{question}\n{context}", "reply", engine).over(rows)


def complete_dataset(docs: DataFrame, engine: Engine = RULES, s: Settings = Settings(), budget: int = 100_000, instruction: str = "Answer from what you know.") -> dict[str, DataFrame]:
    """The flagship composition: corpus variations, questions, masked corrections and retrieval data, with an instruction, in
    completion text, cut to a token budget."""
    qa = single_source_qa(docs, engine, s)
    talks = qa["groups"].withColumn("conversations", C.system_added("conversations", instruction))
    texts = talks.select(F.col("pack_id").alias("row_key"), C.rendered_preset("conversations", C.LABELLED).alias("text"))
    corpus = representation_variation(docs, engine, s).select(F.concat_ws("#", "row_key", F.col("part").cast("string")).alias("row_key"), "text")
    all_ = stored(corpus.unionByName(texts).withColumn("n_tokens", T.token_count("text")), "complete")
    chosen = chunking.budget_prefix(all_, F.md5(F.col("text").cast("binary")), "n_tokens", budget, tie="row_key")
    return {"pretrain": chosen, "qa": qa["qa"], "chats": talks, "corrections": corrections(docs, engine, s), "rag": rag_data(docs, engine, s)}


def meta_dataset(steps: list[DataFrame], names: list[str], key: str = "row_key", prompts: dict[str, str] | None = None, shots: int | None = None) -> DataFrame:
    """Training rows from the call details that steps left behind. ``prompts``: other wordings of system prompts, which half of
    the chats take; ``shots``: so many example pairs of a chat stay."""
    out = None
    for rows, name in zip(steps, names, strict=True):
        one = segments.meta_rows(rows.select(F.col(key).alias("row_key"), F.col(f"{name}_details").alias("details")), "row_key").withColumn("step", F.lit(name))
        out = one if out is None else out.unionByName(one)
    if prompts:
        first = F.get("messages", F.lit(0))
        said = S.prompts_replaced(out.withColumns({"_k": F.concat_ws("#", "row_key", "step", "call"), "_p": F.when(first["role"] == "system", first["content"])}), "_p", prompts, "_k")
        changed = F.transform("messages", lambda m, i: F.struct(m["role"].alias("role"), F.when((i == 0) & F.col("_p").isNotNull(), F.col("_p")).otherwise(m["content"]).alias("content")))
        out = said.withColumn("messages", changed).drop("_k", "_p")
    if shots is not None:
        # the last turn is the reply, which stays whatever examples go
        n = F.size("messages")
        kept = C.to_openai(C.fewshot(C.to_sharegpt(F.slice("messages", F.lit(1), F.greatest(n - 1, F.lit(0)))), F.concat_ws("#", "row_key", "call"), shots))
        out = out.withColumn("messages", F.when(n > 0, F.concat(kept, F.slice("messages", n, F.lit(1)))))
    return out


def template_pipeline(docs: DataFrame, engine: Engine = RULES, s: Settings = Settings(), template: str = "FACTS\n{text}") -> DataFrame:
    """The smallest pipeline: chunks and one step, to start others from."""
    return Step("reply", template, "reply", engine).over(chunks(docs, s))


PIPELINES = {f.__name__: f for f in (single_source_qa, multi_source_qa, representation_variation, stories, rag_data, corrections, cleaned_files, rephrased, classifier, grpo_examples, rag_answers, complete_dataset, meta_dataset, template_pipeline)}
