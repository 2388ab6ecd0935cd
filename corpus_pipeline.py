"""A cleaning pipeline over ``documents``: language, near copies, secrets, mixture, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs; run() writes each stage's rows to
the shared scratch folder and reads them again, so a lost executor costs no more than its stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparquern.llm import langid, mixing, neardup, packing, secretscan
from sparquern.llm.shared import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go: no letter at all, or no fit to any learned language."""
    return langid.drop_unidentified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest doc_id stays."""
    return neardup.drop_near_duplicates(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; n_chars follows the new text."""
    return secretscan.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: none, once or twice."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("identify_language", identify_language),
    ("drop_near_copies", drop_near_copies),
    ("hide_secrets", hide_secrets),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained models and tokenizers have no SQL form; the tests hold the stages against plain Python.
ORACLE_SQL = None
