"""Nearest vectors, term search, fusion, passages and contexts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import query
from ..operators import retrieval as R
from ..session import table

#: Queries of the vector searches: every row whose id is divisible by 50.
NEAREST_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id AS id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i]))) AS distance
  FROM v q, v c WHERE q.vec_id % 50 = 0),
knn AS (SELECT query_id, rank::INTEGER AS rank, id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM d) WHERE rank <= 20)
"""
TERMS = "regexp_extract_all(lower(text), '([a-z0-9_]+)')"
BM25_SQL = f"""
asked AS (SELECT DISTINCT item_id AS query_id, unnest({TERMS}) AS term FROM benchmark),
sized AS (SELECT doc_id AS id, {TERMS} AS t, len({TERMS}) AS len FROM documents),
stats AS (SELECT count(*)::DOUBLE AS n, avg(len) AS mean FROM sized),
posted AS (SELECT id, len, term, count(*) AS tf FROM (SELECT id, len, unnest(t) AS term FROM sized) WHERE term IN (SELECT term FROM asked) GROUP BY id, len, term),
freq AS (SELECT term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM posted, stats GROUP BY term, n),
scores AS (
  SELECT query_id, id, round(sum(idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / mean))), 6) AS score
  FROM asked JOIN posted USING (term) JOIN freq USING (term), stats GROUP BY query_id, id),
bm AS (SELECT query_id, rank::INTEGER AS rank, id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scores WHERE score > 0) WHERE rank <= 30)
"""


def _nearest(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return R.nearest(rows, rows.filter(F.col("vec_id") % 50 == 0), k)


def _bm25(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text")
    return R.bm25(docs, items, k)


@query(NEAREST_SQL + "SELECT query_id, rank, id FROM knn WHERE rank <= 3 AND id <> query_id")
def knn_top3_excluding_self(spark, sf_dir):
    """Three nearest, of which the query itself is dropped, so two mostly remain."""
    return _nearest(spark, sf_dir, 3).filter("id <> query_id").select("query_id", F.col("rank").cast("int").alias("rank"), "id")


@query("WITH " + BM25_SQL.strip() + " SELECT query_id, rank, id, score FROM bm WHERE rank <= 10")
def bm25_topk(spark, sf_dir):
    return _bm25(spark, sf_dir, 10)


FUSED = "SELECT query_id, rank::INTEGER AS rank, id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM (SELECT query_id, id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM ({0}) GROUP BY query_id, id)) WHERE rank <= {1}"


@query(NEAREST_SQL + FUSED.format("SELECT query_id, rank, id FROM knn WHERE rank <= 20 UNION ALL SELECT query_id, 21 - rank, id FROM knn WHERE rank <= 20", 10))
def rrf_fusion(spark, sf_dir):
    """A ranking of twenty fused with its reverse."""
    near = _nearest(spark, sf_dir, 20)
    return R.fused([near, near.withColumn("rank", 21 - F.col("rank"))], 10)


@query(NEAREST_SQL + "," + BM25_SQL.strip() + " " + FUSED.format("SELECT query_id, rank, id FROM knn WHERE rank <= 20 UNION ALL SELECT query_id, rank, id FROM bm WHERE rank <= 30", 10))
def hybrid_retrieval(spark, sf_dir):
    """Vector ranking of 2k and term ranking of 3k candidates, fused to k = 10."""
    return R.fused([_nearest(spark, sf_dir, 20), _bm25(spark, sf_dir, 30)], 10)


@query("""WITH d AS (SELECT doc_id, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS n FROM documents), b AS (SELECT item_id, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS n FROM benchmark)
SELECT item_id, doc_id FROM b JOIN d ON contains(d.n, b.n) WHERE b.n <> ''""")
def passage_locate(spark, sf_dir):
    return R.located(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("item_id", "doc_id")


@query("""WITH b AS (SELECT item_id, regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]', '', 'g') AS norm FROM benchmark),
d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?s).') AS chars FROM documents),
k AS (SELECT doc_id, chars, list_filter(range(1, len(chars) + 1), lambda i: regexp_full_match(chars[i], '[a-z0-9]')) AS kept FROM d),
f AS (SELECT doc_id, kept, array_to_string(list_transform(kept, lambda i: chars[i]), '') AS flat FROM k),
hits AS (SELECT item_id, doc_id, kept, strpos(flat, norm) AS pos, length(norm) AS n FROM f, b WHERE norm <> '' AND contains(flat, norm))
SELECT item_id, doc_id, (kept[pos] - 1)::INTEGER AS start, kept[pos + n - 1]::INTEGER AS "end" FROM hits""")
def passage_offsets(spark, sf_dir):
    return R.located(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("""SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) || chr(10) || chr(10) || 'Sources: ' ||
  (SELECT string_agg(role, ', ' ORDER BY first) FROM (SELECT role, min(turn) AS first FROM conversations x WHERE x.conv_id = c.conv_id GROUP BY role)) AS context FROM conversations c GROUP BY conv_id""")
def cited_context(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text", "role"))).alias("t"))
    return turns.select("conv_id", R.context_text(F.col("t.text"), F.col("t.role")).alias("context"))


@query()
def shrunk_context(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return turns.select("conv_id", R.shrunk(F.col("t.text"), 100).alias("chunks"))


@query("SELECT doc_id AS question_id, text AS source_text, source AS source_metadata FROM documents WHERE text <> '' AND source <> ''")
def rag_records(spark, sf_dir):
    from ..operators import segments

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("q"), "text", "source", F.array("lang").alias("related"))
    return segments.rag_records(docs, "q", "text", "source", "related").select(F.col("question").cast("long").alias("question_id"), "source_text", "source_metadata")
