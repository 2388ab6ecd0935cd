"""The pipeline's stages one after another over a small table, each held against its own input."""

from __future__ import annotations

import corpus_pipeline
from sparquern.llm import secretscan
from tests.llm.test_operators import SCHEMA, plain_components, sample_rows


def test_stages(spark, tmp_path):
    rows = sample_rows(40)
    docs = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    seen = [docs]
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, seen[-1], str(tmp_path))
        out.write.parquet(f"{tmp_path}/{n}-{name}")
        seen.append(spark.read.parquet(f"{tmp_path}/{n}-{name}"))
        assert n == 4 or seen[-1].columns == columns
    language, dedup, clean, mixed, packed = seen[1:]
    assert all(r["text"] and any(c.isalpha() for c in r["text"]) for r in language.collect())
    expected = {c for d, _, c in plain_components([tuple(r) for r in language.collect()]) if d is not None}
    assert {r["doc_id"] for r in dedup.collect() if r["doc_id"] is not None} == expected
    assert clean.count() == dedup.count() and all(r["spans"] == "" for r in secretscan.scan_secrets(clean).collect())
    assert mixed.count() > 0 and set(r["doc_id"] for r in mixed.collect()) <= set(r["doc_id"] for r in clean.collect())
    assert packed.count() > 0


def test_run(spark, tmp_path):
    spark.createDataFrame(sample_rows(35), SCHEMA).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
