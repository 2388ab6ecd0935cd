"""Chunking, keys, packing, sampling, budgets and checkpoints over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import query
from ..functions.text import hash_ratio, lines, token_count
from ..operators import chunking, keys, sampling
from ..session import table

MOST = 100

#: Greedy chunks of lines (sentences of long ones) as a recursive walk over the pieces.
CHUNKS_SQL = r"""
WITH RECURSIVE paras AS (
  SELECT doc_id, lang, i, regexp_replace(p, '^\s+|\s+$', '', 'g') AS p FROM (
    SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS p, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
parts AS (
  SELECT doc_id, lang, i, 0 AS j, p FROM paras WHERE p <> '' AND len(regexp_extract_all(p, '\S+')) <= 100
  UNION ALL
  SELECT doc_id, lang, i, generate_subscripts(s, 1), unnest(s) FROM (
    SELECT doc_id, lang, i, string_split(regexp_replace(p, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS s FROM paras WHERE len(regexp_extract_all(p, '\S+')) > 100)),
pieces AS (
  SELECT doc_id, lang, p, len(regexp_extract_all(p, '\S+')) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS k
  FROM (SELECT doc_id, lang, i, j, regexp_replace(p, '^\s+|\s+$', '', 'g') AS p FROM parts) WHERE p <> ''),
walk AS (
  SELECT doc_id, k, 0 AS chunk, n AS run FROM pieces WHERE k = 1
  UNION ALL
  SELECT p.doc_id, p.k, CASE WHEN w.run + p.n <= 100 THEN w.chunk ELSE w.chunk + 1 END, CASE WHEN w.run + p.n <= 100 THEN w.run + p.n ELSE p.n END
  FROM walk w JOIN pieces p ON p.doc_id = w.doc_id AND p.k = w.k + 1),
joined AS (
  SELECT p.doc_id, p.lang, w.chunk, string_agg(p.p, ' ' ORDER BY p.k) AS text FROM walk w JOIN pieces p ON p.doc_id = w.doc_id AND p.k = w.k GROUP BY p.doc_id, p.lang, w.chunk),
chunks AS (
  SELECT doc_id, lang, (row_number() OVER (PARTITION BY doc_id ORDER BY chunk) - 1)::INTEGER AS chunk_idx, text, len(regexp_extract_all(text, '\S+'))::BIGINT AS n_tokens
  FROM joined WHERE length(text) >= 50)
"""


def _docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*columns)


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunked(_docs(spark, sf_dir, "doc_id", "lang", "text"), MOST, paragraph="\n")


@query(CHUNKS_SQL + "SELECT doc_id, chunk_idx, text, n_tokens FROM chunks")
def chunk_pack_words(spark, sf_dir):
    return _chunks(spark, sf_dir).select("doc_id", "chunk_idx", "text", "n_tokens")


@query(CHUNKS_SQL + "SELECT lang, count(*) AS n_chunks, sum(n_tokens)::BIGINT AS n_tokens FROM chunks GROUP BY lang")
def chunk_count_by_lang(spark, sf_dir):
    return _chunks(spark, sf_dir).groupBy("lang").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("n_tokens").alias("n_tokens"))


@query(
    CHUNKS_SQL
    + """SELECT lang, count(*) AS n_chunks, sum(n_tokens)::BIGINT AS n_tokens
FROM (SELECT * FROM chunks ORDER BY md5('1048596' || text), doc_id, chunk_idx LIMIT 500) GROUP BY lang"""
)
def flagship_chunks_by_lang(spark, sf_dir):
    """Chunks, a seeded sample of 500, and the sample's size by language."""
    ranked = _chunks(spark, sf_dir).withColumn("_h", sampling.seeded("text"))
    return ranked.orderBy("_h", "doc_id", "chunk_idx").limit(500).groupBy("lang").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum("n_tokens").alias("n_tokens"))


@query("SELECT doc_id, md5('1048596' || text) AS h FROM documents ORDER BY h, doc_id LIMIT 100")
def hash_subset(spark, sf_dir):
    return sampling.hash_subset(_docs(spark, sf_dir, "doc_id", "text"), 100).select("doc_id", sampling.seeded("text").alias("h"))


@query("""SELECT doc_id, CASE WHEN r < 300 THEN 'train' ELSE 'test' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY md5(text), doc_id) - 1 AS r FROM documents) WHERE r < 400""")
def hash_shuffle_split(spark, sf_dir):
    return sampling.hash_split(_docs(spark, sf_dir, "doc_id", "text"), {"train": 300, "test": 100}).select("doc_id", "split")


@query("SELECT doc_id, ('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.3 AS chosen FROM documents")
def hash_ratio_bernoulli(spark, sf_dir):
    return sampling.bernoulli(_docs(spark, sf_dir, "doc_id"), "doc_id", 0.3)


@query("""SELECT doc_id, source FROM (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(text), doc_id) AS r FROM documents WHERE source IN ('src0', 'src1', 'src2'))
WHERE r <= CASE source WHEN 'src0' THEN 40 WHEN 'src1' THEN 24 ELSE 16 END""")
def percent_mix_sources(spark, sf_dir):
    return sampling.percent_mix(_docs(spark, sf_dir, "doc_id", "source", "text"), {"src0": 50, "src1": 30, "src2": 20}, 80).select("doc_id", "source")


@query("SELECT source, count(*) AS n_docs, sum(len(regexp_extract_all(text, '\\S+')))::BIGINT AS n_tokens FROM documents GROUP BY source")
def token_totals(spark, sf_dir):
    return _docs(spark, sf_dir, "source", "text").groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(token_count("text")).alias("n_tokens"))


@query("""SELECT doc_id, n_tokens FROM (
  SELECT doc_id, n_tokens, coalesce(sum(n_tokens) OVER (ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT doc_id, len(regexp_extract_all(text, '\\S+'))::BIGINT AS n_tokens, md5(text) AS h FROM documents)) WHERE before < 50000""")
def token_budget_prefix(spark, sf_dir):
    docs = _docs(spark, sf_dir, "doc_id", "text").select("doc_id", token_count("text").alias("n_tokens"), F.md5(F.col("text").cast("binary")).alias("h"))
    return chunking.budget_prefix(docs, F.col("h"), "n_tokens", 50_000).select("doc_id", "n_tokens")


@query("SELECT doc_id, (row_number() OVER (ORDER BY text, doc_id) - 1)::BIGINT AS row_key FROM documents")
def row_keying(spark, sf_dir):
    return keys.ordinals(_docs(spark, sf_dir, "doc_id", "text"), "text", "doc_id", name="row_key").select("doc_id", "row_key")


@query("""SELECT doc_id AS parent_key, (i - 1)::INTEGER AS child_idx, doc_id::VARCHAR || '-' || (i - 1)::VARCHAR || '-' || sha256(line) AS row_key
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)""")
def one_to_many_children(spark, sf_dir):
    return keys.children(_docs(spark, sf_dir, "doc_id", "text"), "doc_id", lines("text"), "line").select("parent_key", "child_idx", "row_key")


@query("""SELECT doc_id, md5(string_agg(line, '|' ORDER BY i)) AS h, count(*) AS n
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) GROUP BY doc_id""")
def many_to_one_recombine(spark, sf_dir):
    kids = keys.children(_docs(spark, sf_dir, "doc_id", "text"), "doc_id", lines("text"), "line")
    back = keys.recombined(kids, "parent_key", "child_idx", "line")
    return back.select(F.col("parent_key").alias("doc_id"), F.md5(F.array_join("sorted.line", "|").cast("binary")).alias("h"), F.size("sorted").cast("long").alias("n"))


@query("""WITH c AS (SELECT doc_id, md5(text) AS parent, count(*) OVER (PARTITION BY md5(text)) AS n FROM documents)
SELECT doc_id, 's' || ((row_number() OVER (ORDER BY parent, doc_id) - 1) // 3)::BIGINT AS pack_id FROM c WHERE n = 1
UNION ALL SELECT doc_id, 'm' || parent FROM c WHERE n > 1""")
def single_multi_pack(spark, sf_dir):
    docs = _docs(spark, sf_dir, "doc_id", "text").select("doc_id", F.md5(F.col("text").cast("binary")).alias("parent"))
    return chunking.singles_packed(docs, "parent", 3, "parent", "doc_id").select("doc_id", "pack_id")


@query("""SELECT group_id, count(*) AS n, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS members
FROM (SELECT doc_id, ((row_number() OVER (ORDER BY md5(text), doc_id) - 1) // 7)::BIGINT AS group_id FROM documents) GROUP BY group_id""")
def fixed_group_pack(spark, sf_dir):
    docs = _docs(spark, sf_dir, "doc_id", "text").select("doc_id", F.md5(F.col("text").cast("binary")).alias("h"))
    groups = chunking.fixed_groups(docs, 7, "h", "doc_id").groupBy("group_id").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("doc_id")).alias("m"))
    return groups.select("group_id", "n", F.array_join(F.col("m").cast("array<string>"), ",").alias("members"))


@query("""SELECT d.doc_id, coalesce(l.n_chars, d.n_chars) AS n_chars, coalesce(l.origin, 'new') AS origin
FROM documents d LEFT JOIN (SELECT doc_id, -1::BIGINT AS n_chars, 'saved' AS origin FROM labels) l ON l.doc_id = d.doc_id""")
def checkpoint_merge(spark, sf_dir):
    """Saved rows (labelled documents, marked) take the place of the rows of this run."""
    rows = _docs(spark, sf_dir, "doc_id", "n_chars").withColumn("origin", F.lit("new"))
    saved = table(spark, sf_dir, "labels").select("doc_id", F.lit(-1).cast("long").alias("n_chars"), F.lit("saved").alias("origin"))
    return keys.merged(rows, saved, "doc_id")


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def skip_done_anti(spark, sf_dir):
    return keys.not_done(_docs(spark, sf_dir, "doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id FROM documents WHERE NOT contains(text, chr(10))")
def resume_children_anti(spark, sf_dir):
    """Documents whose lines after the first have not been expanded: those that have none."""
    docs = _docs(spark, sf_dir, "doc_id", "text")
    kids = keys.children(docs, "doc_id", F.slice(lines("text"), F.lit(2), F.size(lines("text"))), "line")
    return keys.not_expanded(docs.select("doc_id"), kids, "doc_id")


@query("""SELECT doc_id, part::INTEGER AS part, md5(text) AS h FROM (
  SELECT doc_id, 0 AS part, text FROM documents UNION ALL SELECT doc_id, 1, lower(text) FROM documents
  UNION ALL SELECT doc_id, 2, replace(lower(text), ' ', '_') FROM documents)""")
def corpus_rows(spark, sf_dir):
    """A text, its facts (here the text in lower case) and one variation as rows of a training corpus."""
    from ..functions.text import snake_case
    from ..operators import segments

    docs = _docs(spark, sf_dir, "doc_id", "text").select("doc_id", "text", F.lower("text").alias("facts"), F.array(snake_case("text")).alias("variations"))
    return segments.corpus_rows(docs, "doc_id", "text", "facts", "variations").select("doc_id", "part", F.md5(F.col("text").cast("binary")).alias("h"))


@query("""SELECT a.doc_id, f.lang, f.n_chars FROM documents a JOIN (
  SELECT source, arg_min(lang, doc_id) AS lang, arg_min(n_chars, doc_id) AS n_chars FROM documents GROUP BY source) f ON f.source = a.source""")
def canonical_first_by_name(spark, sf_dir):
    from ..operators import segments

    return segments.canonical_first(_docs(spark, sf_dir, "doc_id", "source", "lang", "n_chars"), "source", "doc_id", ["lang", "n_chars"]).select("doc_id", "lang", "n_chars")


@query()
def chunk_by_characters(spark, sf_dir):
    return chunking.chunked_by_characters(_docs(spark, sf_dir, "doc_id", "text"), 600).select("doc_id", "chunk_idx", F.length("text").alias("n_chars"))


@query()
def weighted_random_pack(spark, sf_dir):
    docs = _docs(spark, sf_dir, "doc_id", "text").select("doc_id", token_count("text").alias("n_tokens"))
    return chunking.packed_by_weight(docs, "doc_id", "n_tokens", 2000, 6000, "pack")


@query("""SELECT doc_id, round AS round, (row_number() OVER (PARTITION BY round ORDER BY md5('1048596|' || round::VARCHAR || '|' || doc_id::VARCHAR), doc_id) - 1)::INTEGER AS place
FROM labels, (SELECT unnest([0, 1])::INTEGER AS round)""")
def round_robin_sample(spark, sf_dir):
    return sampling.round_robin(table(spark, sf_dir, "labels"), "doc_id", 2).select("doc_id", "round", "place")


@query("""WITH ring AS (SELECT doc_id, row_number() OVER (ORDER BY md5('1048596' || doc_id::VARCHAR), doc_id) - 1 AS at, count(*) OVER () AS n FROM documents)
SELECT a.doc_id, s.step::INTEGER AS step, b.doc_id AS other FROM ring a, (SELECT unnest([1, 2, 3]) AS step) s, ring b
WHERE b.at = (a.at + s.step) % a.n AND a.doc_id <> b.doc_id""")
def negative_sampling(spark, sf_dir):
    return sampling.negatives(_docs(spark, sf_dir, "doc_id"), "doc_id", 3)


@query("""SELECT part.doc_id, hex8 / 4294967296.0::DOUBLE AS ratio FROM (
  SELECT doc_id, ('0x' || substr(sha256(text), 1, 8))::BIGINT AS hex8 FROM documents) part""")
def content_hash_ratio(spark, sf_dir):
    return _docs(spark, sf_dir, "doc_id", "text").select("doc_id", hash_ratio("text").alias("ratio"))
