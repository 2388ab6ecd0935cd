"""Whole pipelines over the tables, with the rule engine, whose replies SQL can follow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import query
from ..functions import conversations as C
from ..operators import sampling
from ..plans import pipelines as P
from ..session import table
from .conversations import TURNS_SQL
from .documents import CHUNKS_SQL, MOST
from .texts import STRIP

SETTINGS = P.Settings(most_tokens=MOST, paragraph="\n")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("metadata"), "text")


@query(CHUNKS_SQL + f"SELECT doc_id::VARCHAR AS metadata, {STRIP.format("'What says: ' || left(text, 60) || '?'")} AS question, {STRIP.format('left(text, 60)')} AS answer FROM chunks")
def plan_single_source_qa(spark, sf_dir):
    return P.single_source_qa(_docs(spark, sf_dir), s=SETTINGS)["qa"].select("metadata", "question", "answer")


@query(CHUNKS_SQL + f"""SELECT sha256(doc_id::VARCHAR || '|' || chunk_idx || '|' || text) AS row_key, text || 'What?A: ' AS prompt, {STRIP.format("'no ' || left(text, 40)")} AS flawed,
  chr(10) || 'Critique: wrong' || {STRIP.format('left(text, 40)')} AS corrected FROM chunks""")
def plan_corrections(spark, sf_dir):
    at = lambda i: F.get("segments", F.lit(i))["text"]
    return P.corrections(_docs(spark, sf_dir), s=SETTINGS).select("row_key", at(0).alias("prompt"), at(1).alias("flawed"), at(2).alias("corrected"))


@query(CHUNKS_SQL + f""", made AS (SELECT sha256(doc_id::VARCHAR || '|' || chunk_idx || '|' || text) AS row_key, text, {STRIP.format('left(text, 80)')} AS v FROM chunks)
SELECT row_key, unnest(range(7))::INTEGER AS part, unnest([text, '1. ' || left(text, 60), v, v, lower(text), lower(v), lower(v)]) AS text FROM made""")
def plan_representation_variation(spark, sf_dir):
    return P.representation_variation(_docs(spark, sf_dir), s=SETTINGS)


@query(TURNS_SQL + """SELECT conv_id, coalesce(max(CASE WHEN s.i = 0 AND sys = 1 THEN 'system: ' || s.text || chr(10) END), '') || max(x) AS text FROM s JOIN (
  SELECT conv_id, string_agg('human: ' || human || chr(10) || 'gpt: <think>about it</think>' || left(gpt, 60), chr(10) ORDER BY pair_idx) AS x FROM p GROUP BY conv_id) USING (conv_id) GROUP BY conv_id""")
def plan_rephrased(spark, sf_dir):
    talks = P.rephrased(C.gathered(table(spark, sf_dir, "conversations")))
    return talks.select("conv_id", F.array_join(F.transform("conversations", lambda m: F.concat(m["from"], F.lit(": "), m["value"])), "\n").alias("text"))


@query(CHUNKS_SQL + "SELECT doc_id::VARCHAR AS metadata, '<atomic_facts>1. ' || left(text, 60) || '</atomic_facts>' AS reply FROM chunks")
def plan_template(spark, sf_dir):
    return P.template_pipeline(_docs(spark, sf_dir), s=SETTINGS).select("metadata", "reply")


@query(CHUNKS_SQL + r"""SELECT doc_id::VARCHAR AS metadata, regexp_extract(left(text, 40) || ' ' || left(text, 40) || ' ' || text, '^.') <> '' AS told FROM chunks""")
def plan_stories(spark, sf_dir):
    """One story a chunk, whose tier is good."""
    return P.stories(_docs(spark, sf_dir), s=SETTINGS).select("metadata", (F.col("tier") == "good").alias("told"))


@query("""WITH ring AS (
  SELECT doc_id, text, row_number() OVER (ORDER BY md5('1048596' || doc_id), doc_id) - 1 AS at, count(*) OVER () AS n, ('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0 < 0.3 AS failed,
    ('0x' || substr(sha256(doc_id || 'n'), 1, 8))::BIGINT % 3 + 1 AS k FROM documents),
chosen AS (SELECT a.doc_id, a.failed, b.doc_id AS other, b.text FROM ring a JOIN ring b ON (b.at - a.at + a.n) % a.n BETWEEN CASE WHEN a.failed THEN 1 ELSE 0 END AND CASE WHEN a.failed THEN a.k ELSE a.k - 1 END)
SELECT doc_id, failed, count(*)::INTEGER AS n, string_agg(text, chr(10) ORDER BY md5(doc_id || '|' || other)) AS contexts FROM chosen GROUP BY doc_id, failed""")
def negative_contexts(spark, sf_dir):
    found = sampling.negative_contexts(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", 3, 0.3)
    return found.select("doc_id", "failed", F.size("contexts").alias("n"), F.array_join("contexts", "\n").alias("contexts"))


@query()
def near_by_planes(spark, sf_dir):
    """Approximate neighbours of every vector, without comparing all with all."""
    from ..operators import retrieval

    return retrieval.near_by_planes(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding"), 3)
