"""Structured Streaming: chunking of documents as they arrive, and state by name."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import chunking


def stream(spark: SparkSession, folder: str, schema: str, files_a_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def chunk_stream(docs: DataFrame, most: int, out: str, checkpoint: str, paragraph: str = chunking.PARAGRAPH) -> StreamingQuery:
    """Chunks of new documents appended to ``out``; the same rows as a batch run over all of them.

    Chunking looks at one document at a time, so there is no state; the checkpoint makes each file count once.
    """
    rows = chunking.chunked(docs, most, paragraph)
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def step_stream(docs: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Any batch pipeline over each batch of new rows. A batch that is run again after a crash overwrites its own folder,
    so its rows appear once."""

    def each(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return docs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def canonical_stream(cards: DataFrame, name: str, key: str, field: str) -> DataFrame:
    """(key, name, field): each card with the field of the first card of its name to arrive; ties within a batch by key."""
    kinds = dict(cards.dtypes)
    schema = f"{key} {kinds[key]}, {name} {kinds[name]}, {field} {kinds[field]}"

    def run(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(frames)).sort_values(key)
        first = state.get[0] if state.exists else pdf[field].iloc[0]
        state.update((first,))
        yield pdf.assign(**{field: first})[[key, name, field]]

    return cards.select(key, name, field).groupBy(name).applyInPandasWithState(run, schema, f"first {kinds[field]}", "append", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Counts and sums of events by type in tumbling windows with a watermark; an extension, the data pipelines need none."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select("window.start", "event_type", "n", "total")
