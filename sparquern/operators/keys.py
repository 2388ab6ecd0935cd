"""Row keys, one-to-many and many-to-one reshaping, and merging of step results."""

from __future__ import annotations

import mmap
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: Bytes of the longest text: a row of Spark is one byte array of at most 2**31 - 16, in which 64 are left for the rest.
MOST_TEXT = (1 << 31) - 16 - 64
#: Bytes of a text from which on the buffer of its row is made to measure, and half of what a row's key may take beside it.
LONG_TEXT, KEY_ROOM = 1 << 26, 1 << 12


def ordinals(df: DataFrame, *order: Column | str, name: str = "ordinal") -> DataFrame:
    """Rows numbered from 0 in the given order.

    Range partitions are sorted in parallel; each gets the number of rows before it, of which one count
    a partition meets on the driver. No task sees more than its range.
    """
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    placed = stored(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id()), "ordinals")
    counts = {r["p"]: r["n"] for r in placed.groupBy(F.shiftright("_place", 33).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for p in range(max(counts, default=0) + 1):
        starts.append(total)
        total += counts.get(p, 0)
    first = F.element_at(F.lit(starts), F.shiftright("_place", 33).cast("int") + 1)
    return placed.withColumn(name, (first + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))).cast("long")).drop("_place")


def children(df: DataFrame, key: str, items: Column, name: str = "child") -> DataFrame:
    """One row a list item with parent_key, child_idx and row_key parent-idx-sha256; empty lists give no row."""
    rows = df.select("*", F.posexplode(items).alias("child_idx", name)).withColumnRenamed(key, "parent_key")
    content = F.col(name) if dict(rows.dtypes)[name] == "string" else F.to_json(name)
    return rows.withColumn("row_key", F.concat_ws("-", F.col("parent_key").cast("string"), F.col("child_idx").cast("string"), F.sha2(content, 256)))


def recombined(df: DataFrame, parent: str, idx: str, *values: str) -> DataFrame:
    """Children back in order: one row a parent with ``sorted``."""
    return df.groupBy(parent).agg(F.array_sort(F.collect_list(F.struct(idx, *values))).alias("sorted"))


def merged(rows: DataFrame, saved: DataFrame, key: str) -> DataFrame:
    """Key-wise full outer merge in which a saved row takes the place of the whole row. Keys are unique in each side."""
    new, old = rows.select(F.col(key).alias("_k"), F.struct(*rows.columns).alias("_new")), saved.select(F.col(key).alias("_k"), F.struct(*rows.columns).alias("_old"))
    return new.join(old, "_k", "full_outer").select(F.coalesce("_old", "_new").alias("r")).select("r.*")


def upserted(rows: DataFrame, saved: DataFrame, key: str) -> DataFrame:
    """Column by column: what is saved stays, what is missing comes from the new row."""
    a, b = rows.alias("a"), saved.alias("b")
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer").select(*[F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) for c in rows.columns])


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no result yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def not_expanded(parents: DataFrame, kids: DataFrame, key: str, parent_key: str = "parent_key") -> DataFrame:
    """Parents without any child."""
    return parents.join(kids.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def united(frames: list[DataFrame], *key: str) -> DataFrame:
    """All rows of the frames, of which rows of one key come once, from the first frame that has it. Frames may number their
    rows alike; what tells rows apart is the key, so nothing is overwritten."""
    from .quality import first_by

    all_ = None
    for i, df in enumerate(frames):
        one = df.withColumn("_frame", F.lit(i))
        all_ = one if all_ is None else all_.unionByName(one)
    rest = [c for c in frames[0].columns if c not in key]
    return first_by(all_, [F.col(k) for k in key], "_frame", *rest).drop("_frame")


def collected_by(df: DataFrame, index: str, order: str, *values: str) -> DataFrame:
    """One row an index with ``outputs``: the values of all runs in their order."""
    return df.groupBy(index).agg(F.array_sort(F.collect_list(F.struct(order, *values))).alias("outputs"))


def questions_by_text(df: DataFrame, paragraph: str, question: str, answer: str, order: str) -> DataFrame:
    """One row a paragraph with its questions and answers as one text, in order, missing order last. A missing question
    or answer leaves its block out; a paragraph without any block has no text."""
    block = F.concat(F.lit("\n\n**QUESTION:**\n"), question, F.lit("\n\n**ANSWER:**\n"), answer, F.lit("\n"))
    placed = df.select(paragraph, order, question, answer).repartition(paragraph).sortWithinPartitions(paragraph, F.col(order).asc_nulls_last(), question, answer)
    return _run_texts(placed.select(paragraph, block.alias("question_answer_pairs")), lead="\n\n")


def _run_texts(rows: DataFrame, lead: str) -> DataFrame:
    """The blocks, in the second column, of each run of one key in a partition on end, without the first one's ``lead``. Each
    block begins with that and goes on with something else.

    A text may take any share of the rows. It grows in a temporary file of its task and goes from there to the JVM once
    the partition's rows are read and their sort is over. The columns keep their names: what Spark holds of a text is the
    row that is asked for, and a projection would be one more.

    Spark doubles the buffer of a row that is too long for it, and keeps it for the next rows. So before long texts comes
    half of the longest, lead included, by which it is dropped again; then the buffer has that text's length, not twice as
    much. The filter hides its condition in a function without generated code: a generated filter would copy the row."""
    names, skip = rows.columns, len(lead.encode())

    def record(key, text: pa.Buffer | None):
        n = 0 if text is None else text.size
        column = pa.nulls(1, pa.string()) if text is None else pa.Array.from_buffers(pa.string(), 1, [None, pa.array([0, n], pa.int32()).buffers()[1], text])
        return pa.RecordBatch.from_arrays([pa.array([key.as_py()], key.type), column], names)

    def gathered(batches, f):
        runs: list[list] = []  # key, first byte, last byte
        at = 0
        for batch in batches:
            ends = pc.run_end_encode(batch.column(0), run_end_type=pa.int32()) if batch.num_rows else None
            blocks, first = batch.column(1), 0
            for key, last in zip(ends.values, ends.run_ends.to_pylist(), strict=True) if ends else ():
                if not runs or not runs[-1][0].equals(key):
                    runs.append([key, at, at])
                if data := blocks.buffers()[2]:
                    offsets = np.frombuffer(blocks.buffers()[1], np.int32)[blocks.offset :]
                    at += f.write(memoryview(data)[offsets[first] : offsets[last]])
                runs[-1][2], first = at, last
        f.flush()
        return runs, at

    def run(batches):
        with tempfile.TemporaryFile() as f:
            runs, at = gathered(batches, f)  # a function of its own, after which no batch is held
            pa.default_memory_pool().release_unused()
            data = pa.py_buffer(mmap.mmap(f.fileno(), at, access=mmap.ACCESS_READ)) if at else None
            key, first, last = max(runs, key=lambda r: r[2] - r[1], default=(None, 0, 0))
            if (n := last - first - skip) > MOST_TEXT:
                raise ValueError(f"the text of one key has {n} bytes, and a string of Spark at most {MOST_TEXT}")
            if n >= LONG_TEXT:
                half = record(key, data.slice(first, min(n, n // 2 + KEY_ROOM)))
                yield half
                yield half.slice(0, 0)  # for which the JVM gives the half's memory back
            for key, first, last in runs:
                yield record(key, data.slice(first + skip, last - first - skip) if last > first else None)

    texts = rows.mapInArrow(run, rows.schema)
    return texts.filter(F.exists(F.array(~F.coalesce(F.col(names[1]).startswith(lead), F.lit(False))), lambda kept: kept))
