"""Parts that the training-data operators share: scratch tables, word handling, Arrow glue."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed, scratch_path, stored  # noqa: F401  for the operators

def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished jobs now, not at the next chance collection.

    The job of one row comes first because the session holds on to the last job's plan."""
    spark.range(1, numPartitions=1).write.format("noop").mode("overwrite").save()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8.

    bytes.split() parts at just these six characters, and bytes.lower() changes A-Z alone.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordIndex(dict):
    """Word to a dense number local to a worker. ``words`` lists them by number."""

    def __init__(self) -> None:
        super().__init__()
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        return n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def forget(self) -> None:
        self.clear()
        self.words.clear()


class WordHashes(WordIndex):
    """Words to their 64-bit hashes; each word is hashed once, until ``bound`` distinct words are held."""

    def __init__(self, bound: int = 300_000) -> None:
        super().__init__()
        self.bound, self.known = bound, np.zeros(0, np.int64)

    def hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self.words) > self.bound:
            self.forget()
            self.known = np.zeros(0, np.int64)
        numbers = self.numbers(words)
        if len(self.words) > len(self.known):
            fresh = self.words[len(self.known) :]
            self.known = np.concatenate([self.known, hash_words(fresh)])
        return self.known[numbers]


def hash_words(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words)).view(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = x.view(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def arrow_map(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[dict[str, list]]]], schema: str, rows: int = 256) -> DataFrame:
    """mapInArrow with a function made once per task; it turns a batch of at most ``rows`` rows into column lists."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, rows):
                for out in work(part):
                    yield pa.RecordBatch.from_arrays([_array(out[f.name], f.type) for f in arrow], schema=arrow)
        finish = getattr(work, "finish", None)
        if finish is not None:
            for out in finish():
                yield pa.RecordBatch.from_arrays([_array(out[f.name], f.type) for f in arrow], schema=arrow)
        del work, finish
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return the memory of a task that ended to the system, as a worker waits for its next task with what it holds."""
    import ctypes

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array per row."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))
