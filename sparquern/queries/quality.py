"""Votes, verdicts, metrics, deduplication, costs and stories; replies are put together from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import query
from ..functions import verdicts as V
from ..operators import quality as Q
from ..session import table


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text")


def _votes(spark, sf_dir) -> DataFrame:
    """Five votes a labelled document: vote i is a yes where (doc_id + i) mod 3 is above its quality."""
    votes = table(spark, sf_dir, "labels").select("doc_id", "quality", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("i"))
    return votes.select("doc_id", "i", ((F.col("doc_id") + F.col("i")) % 3 > F.col("quality")).alias("vote"))


VOTES = "WITH v AS (SELECT doc_id, i, (doc_id + i) % 3 > quality AS vote FROM labels, (SELECT unnest([0, 1, 2, 3, 4]) AS i)) "


@query(VOTES + "SELECT doc_id, count(*) AS n_votes, sum(vote::INTEGER)::BIGINT AS n_true, avg(vote::INTEGER) >= 0.5 AS passed FROM v GROUP BY doc_id")
def majority_vote(spark, sf_dir):
    return Q.majority(_votes(spark, sf_dir), "doc_id")


@query(VOTES + "SELECT doc_id, i, vote FROM (SELECT *, avg(vote::INTEGER) OVER (PARTITION BY doc_id) >= 0.5 AS passed FROM v) WHERE vote = passed")
def vote_tally_details(spark, sf_dir):
    votes = _votes(spark, sf_dir)
    return Q.winning_details(votes, Q.majority(votes, "doc_id"), "doc_id")


@query(VOTES + "SELECT doc_id, (7 - count(*))::BIGINT AS missing FROM v GROUP BY doc_id")
def votes_missing(spark, sf_dir):
    return Q.missing_votes(_votes(spark, sf_dir), 7, "doc_id")


def _reply(*cases: str) -> Column:
    n = F.col("doc_id") % len(cases)
    out = F.lit(cases[-1])
    for i, c in enumerate(cases[:-1]):
        out = F.when(n == i, c).otherwise(out)
    return F.concat(F.lit("Thoughts on "), F.col("source"), F.lit(".\n"), out)


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN true WHEN 3 THEN NULL ELSE false END AS verdict FROM documents")
def verdict_suitability(spark, sf_dir):
    reply = _reply("Judgment: Suitable", "Judgment: UNSUITABLE", "a table of contents, suitable", "no word")
    return _docs(spark, sf_dir).select("doc_id", V.suitable(reply).alias("verdict"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN true WHEN 3 THEN NULL ELSE false END AS verdict FROM documents")
def verdict_question(spark, sf_dir):
    reply = _reply("final judgment: Relevant.", "Final Judgment: irrelevant", "Final Judgment:\nmostly relevant", "Final Judgment: unclear")
    return _docs(spark, sf_dir).select("doc_id", V.question_valid(reply).alias("verdict"))


@query("SELECT doc_id, doc_id % 4 = 0 AS verdict FROM documents")
def verdict_relevancy(spark, sf_dir):
    reply = _reply("Explanation of Judgment: Relevant.", "Explanation of Judgment: RELEVANT", "Explanation of judgment: partially relevant", "none")
    return _docs(spark, sf_dir).select("doc_id", V.answer_relevant(reply).alias("verdict"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN true WHEN 3 THEN NULL ELSE false END AS verdict FROM documents")
def verdict_accuracy(spark, sf_dir):
    reply = _reply("Overall Accuracy Determination: Accurate", "Overall Accuracy Determination: mostly accurate", "nothing", "Overall Accuracy Determination: unknown")
    return _docs(spark, sf_dir).select("doc_id", V.answer_accurate(reply).alias("verdict"))


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'keep' WHEN 1 THEN 'reword' WHEN 4 THEN NULL ELSE 'drop' END AS verdict,
  CASE WHEN doc_id % 5 = 1 THEN 'Who?' END AS question, CASE WHEN doc_id % 5 = 1 THEN 'Nobody.' END AS answer FROM documents""")
def context_repair(spark, sf_dir):
    reply = _reply("Final judgment: PASS", "Final judgment: REWORD\nReworded Question: Who?\nReworded Answer: Nobody.", "Final judgment: REWORD\nReworded Question: Who?\nReworded Answer: The provided text.", "Final judgment: FAIL", "none")
    return _docs(spark, sf_dir).select("doc_id", V.context_repair(reply).alias("r")).select("doc_id", "r.verdict", "r.question", "r.answer")


@query("SELECT doc_id FROM documents WHERE doc_id % 2 = 0")
def phrase_blacklist(spark, sf_dir):
    return _docs(spark, sf_dir).filter(V.free_of_text_references(_reply("It is red.", "According to the text? No: according to the text, it is."))).select("doc_id")


@query("SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '\\S+')) <= 450")
def max_tokens(spark, sf_dir):
    from ..functions.text import token_count

    return _docs(spark, sf_dir).filter(token_count("text") <= 450).select("doc_id")


@query("SELECT doc_id FROM labels WHERE quality <> 0")
def truthy_filter(spark, sf_dir):
    return table(spark, sf_dir, "labels").filter(V.truthy("quality")).select("doc_id")


@query("SELECT count(*) AS n, avg((quality = toxic)::INTEGER::DOUBLE) AS accuracy FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def label_accuracy(spark, sf_dir):
    return Q.accuracy(table(spark, sf_dir, "labels"), "quality", "toxic")


@query("""WITH c AS (SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS tp, count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS fp,
  count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS fn, count(*) AS n FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL)
SELECT n, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0::DOUBLE END AS precision, CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0::DOUBLE END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN (2 * tp)::DOUBLE / (2 * tp + fp + fn) ELSE 0.0::DOUBLE END AS f1, CASE WHEN n > 0 THEN (n - fp - fn)::DOUBLE / n ELSE 0.0::DOUBLE END AS accuracy FROM c""")
def label_prf(spark, sf_dir):
    return Q.binary_metrics(table(spark, sf_dir, "labels"), "quality", "toxic")


@query("SELECT min(doc_id) AS doc_id FROM documents GROUP BY substr(text, 1, 15)")
def prefix_dedup(spark, sf_dir):
    return Q.prefix_distinct(_docs(spark, sf_dir).select("doc_id", "text"), "text", 15, "doc_id").select("doc_id")


@query("SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def exact_dedup_first(spark, sf_dir):
    keyed = _docs(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("h"))
    return Q.first_by(keyed, [F.col("h")], "doc_id").select("doc_id")


@query("SELECT lang, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources FROM documents GROUP BY lang")
def sources_distinct(spark, sf_dir):
    return _docs(spark, sf_dir).groupBy("lang").agg(F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("sources"))


@query("""WITH c AS (SELECT event_type, sum(value)::DOUBLE AS tokens FROM events GROUP BY event_type),
p AS (SELECT event_type, tokens, tokens / 1e6 * CASE event_type WHEN 'click' THEN 0.15::DOUBLE WHEN 'view' THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END AS cost FROM c)
SELECT event_type, round(tokens, 4) AS tokens, round(cost, 9) AS cost, round(CASE WHEN sum(cost) OVER () > 0 THEN 100 * cost / sum(cost) OVER () ELSE 0 END, 6) AS share,
  round(cost / 0.5, 9) AS cost_per_million, round(tokens / 500000, 9) AS amplification FROM p""")
def cost_accounting(spark, sf_dir):
    """Events as calls, their values as tokens."""
    out = Q.costs(table(spark, sf_dir, "events"), "event_type", "value", {"click": 0.15, "view": 0.2}, 500_000)
    places = {"tokens": 4, "cost": 9, "share": 6, "cost_per_million": 9, "amplification": 9}
    return out.select("event_type", *[F.round(c, n).alias(c) for c, n in places.items()])


@query("""SELECT doc_id, quality >= 0 AND toxic = 0 AS ok, quality = 1 AND toxic = 0 AS best FROM labels""")
def story_tiers(spark, sf_dir):
    """Ratings from labels: quality 1 is incredible, 0 good; toxic ones are awful."""
    quality = F.when(F.col("quality") == 1, "incredible").otherwise("good")
    tone = F.when(F.col("toxic") == 1, F.lit("awful")).otherwise(quality)
    ratings = F.create_map(F.lit("quality"), quality, F.lit("tone"), tone)
    return table(spark, sf_dir, "labels").select("doc_id", V.story_ok(ratings).alias("ok"), V.story_ok(ratings, ("incredible",)).alias("best"))


@query("""SELECT conv_id, CASE WHEN count(*) FILTER (WHERE role = 'assistant') >= ceil(count(*) FILTER (WHERE role = 'user') / 2.0) AND count(*) FILTER (WHERE role = 'assistant') > 0 THEN 'Mirela' END AS speaker
FROM conversations GROUP BY conv_id""")
def speaker_inference(spark, sf_dir):
    line = F.when(F.col("role") == "user", F.lit("{user}: hello")).when(F.col("role") == "assistant", F.lit("Captain Mirela (calm): well")).otherwise(F.lit("no speaker"))
    texts = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x["line"]), "\n").alias("text"))
    return Q.main_speaker(texts, "conv_id", "text")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN doc_id % 2 = 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS reward FROM documents")
def reward_combine(spark, sf_dir):
    reply = F.when(F.col("doc_id") % 2 == 0, F.lit("17")).otherwise(F.lit("x17"))
    answer = F.when(F.col("doc_id") % 3 == 0, reply).otherwise(F.lit("none"))
    return Q.rewarded(_docs(spark, sf_dir).select("doc_id", reply.alias("reply"), answer.alias("answer")), ["correctness", "integer"], "reply", "answer").select("doc_id", "reward")


@query("""SELECT doc_id, 3 AS n_segments, source || 'q' || 'The ' AS first_text FROM documents WHERE doc_id % 2 = 0""")
def correction_segments(spark, sf_dir):
    from ..operators import segments as S

    full = F.when(F.col("doc_id") % 2 == 0, F.lit("The wrong+ answer")).otherwise(F.lit("wrong+ and wrong+"))
    rows = _docs(spark, sf_dir).select("doc_id", S.correction_segments("source", F.lit("q"), F.lit("wrong+"), F.lit(" right"), full).alias("s")).filter("s is not null")
    return rows.select("doc_id", F.size("s").alias("n_segments"), F.get("s", F.lit(0))["text"].alias("first_text"))
