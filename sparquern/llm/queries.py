"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import fingerprints, langid, mixing, neardup, ngrams, packing, secretscan, sharding, tokenfiles, topk


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir))


def op2_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_documents(spark, sf_dir))


def op3_bottomk_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_documents(spark, sf_dir))


def op4_vafile_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan_secrets(_documents(spark, sf_dir))


def op6_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score_documents(_documents(spark, sf_dir))


def op7_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_documents(spark, sf_dir))


def op8_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(_documents(spark, sf_dir))


def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op10_pfor_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_harmonic_packing, op2_weighted_fingerprints, op3_bottomk_near_duplicates, op4_vafile_top_k, op5_secret_scan,
        op6_deleted_interpolation, op7_feistel_shards, op8_kneser_ney_language, op9_pareto_mix, op10_pfor_token_files,
    )
}

_ADD, _TIMES = sharding.round_keys(0x5EED)
#: The round function of op7 for a number x and the place i of its keys, as SQL.
_SCRAMBLED = "(((({x} + add[{i}]) % 2147483647) * (({x} + add[{i}]) % 2147483647) % 2147483647 + {x} * times[{i}]) % 2147483647)"
_SQUARED = f"({_SCRAMBLED} * {_SCRAMBLED} % 2147483647)"

#: DuckDB SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op3_bottomk_near_duplicates": r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM docs),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, a AS other FROM edges
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, coalesce(r.c, d.doc_id)::BIGINT AS component_id, coalesce(r.c, d.doc_id) = d.doc_id AS kept
FROM docs d LEFT JOIN sizes z ON z.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id
""",
    "op4_vafile_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10
""",
    "op7_feistel_shards": f"""
WITH RECURSIVE crcs AS (
  SELECT list_transform(range(256), lambda v: list_reduce([v, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
docs AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 16 AS size,
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crcs),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS x FROM docs),
sides AS (
  SELECT n, a, (n + a - 1) // a AS b, {_ADD} AS add, {_TIMES} AS times
  FROM (SELECT count(*) AS n, floor(sqrt(greatest(count(*) - 1, 0)))::BIGINT + 1 AS a FROM docs)),
walk AS (
  SELECT x, x % a AS l, x // a AS r, 1 AS i FROM numbered, sides
  UNION ALL
  SELECT x, l2, (r + {_SQUARED.format(x="l2", i="i + 6")}) % b, i + 1
  FROM (SELECT x, (l + {_SQUARED.format(x="r", i="i")}) % a AS l2, r, i
        FROM (SELECT x, l, r, CASE WHEN i = 7 THEN 1 ELSE i END AS i FROM walk, sides WHERE i <= 6 OR r * a + l >= n), sides), sides),
placed AS (SELECT x, r * a + l AS position FROM walk, sides WHERE i = 7 AND r * a + l < n)
SELECT doc_id, size, text_crc32, 'rows' AS law, (position % 40)::INTEGER AS shard, position // 40 AS slot, NULL::INTEGER AS grown_shard, x AS row_number
FROM numbered JOIN placed USING (x)
""",
    "op9_pareto_mix": r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    (('0x' || substr(md5('11:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM docs GROUP BY source),
weighed AS (SELECT *, [5.0, 2.0, 1.0][rank % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS full_size, 1.5::DOUBLE * sum(source_size) OVER () AS all_words FROM sizes),
levels AS (
  SELECT *, (all_words - coalesce(sum(full_size) OVER (ORDER BY full_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY full_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
chosen AS (SELECT level FROM levels WHERE level * weight < full_size ORDER BY full_size / weight, rank LIMIT 1),
targets AS (
  SELECT source, source_size, least(full_size, coalesce((SELECT level FROM chosen) * weight, full_size))::DOUBLE AS target FROM levels),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets),
ranked AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u / (1 - d.u) / pow(2.0, (length(bin(d.size)) - 1) // 2), d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM docs d JOIN plan p ON p.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN upto - rest <= rest - (upto - size) AND upto - size < rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked
""",
}
