"""Token-id files of patched frame-of-reference blocks.

One file is a run of documents in ascending doc_id order (fixed layout, little endian)::

    magic "PFR1" | u32 documents | u64 ids | u32 blocks | u32 block length
    documents x (i64 doc_id, u8 has_doc_id, u32 ids)
    (blocks + 1) x u32 byte start of each block, from the first block on
    blocks: u32 minimum | u8 width | u16 exceptions | packed (id - minimum) low bits
            | exceptions x (u16 place, u32 id - minimum)

A block's width is that which holds a given percentile of its offsets; the ids above it are patched
from the exception list. Any block can be decoded alone from its start.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import arrow_map, scratch_path
from .tokens import WordPieces, shared_pieces, vocabulary_path

MAGIC = b"PFR1"
BLOCK = 1024
HEAD = struct.Struct("<4sIQII")
DOC = np.dtype([("id", "<i8"), ("has", "u1"), ("n", "<u4")])


def pack_bits(values: np.ndarray, width: int) -> bytes:
    if not width:
        return b""
    bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(bits[:, :width].ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(n, np.uint32)
    bits = np.zeros((n, 32), np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint32)


def encode_block(ids: np.ndarray, percentile: float = 0.95) -> bytes:
    """ids: unsigned 32-bit, at least one and at most 65,535 of them."""
    least = ids.min()
    offsets = ids - least
    at = min(len(ids) - 1, int(percentile * len(ids)))
    width = int(np.partition(offsets, at)[at]).bit_length()
    out = np.flatnonzero(offsets >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    mask = np.uint32((1 << width) - 1) if width < 32 else np.uint32(0xFFFFFFFF)
    extra = np.zeros(len(out), np.dtype([("at", "<u2"), ("v", "<u4")]))
    extra["at"], extra["v"] = out, offsets[out]
    return struct.pack("<IBH", int(least), width, len(out)) + pack_bits(offsets & mask, width) + extra.tobytes()


def decode_block(data: bytes, n: int) -> np.ndarray:
    least, width, exceptions = struct.unpack_from("<IBH", data)
    packed = (n * width + 7) // 8
    values = unpack_bits(data[7 : 7 + packed], n, width)
    extra = np.frombuffer(data, np.dtype([("at", "<u2"), ("v", "<u4")]), exceptions, 7 + packed)
    values[extra["at"]] = extra["v"]
    return values + np.uint32(least)


def encode_file(docs: list[tuple[int | None, bytes]], percentile: float = 0.95, block: int = BLOCK) -> bytes:
    """docs: (doc_id, ids as little-endian unsigned 32-bit bytes) in order."""
    table = np.zeros(len(docs), DOC)
    table["id"] = [d or 0 for d, _ in docs]
    table["has"] = [d is not None for d, _ in docs]
    table["n"] = [len(b) // 4 for _, b in docs]
    ids = np.frombuffer(b"".join(b for _, b in docs), "<u4").astype(np.uint32)
    blocks = [encode_block(ids[i : i + block], percentile) for i in range(0, len(ids), block)]
    starts = np.zeros(len(blocks) + 1, "<u4")
    np.cumsum([len(b) for b in blocks], out=starts[1:])
    return HEAD.pack(MAGIC, len(docs), len(ids), len(blocks), block) + table.tobytes() + starts.tobytes() + b"".join(blocks)


class TokenFile:
    """One file, of which the tables are read at once and blocks when they are asked for, each by its start in the index."""

    def __init__(self, file) -> None:
        self.file = file
        magic, docs, self.n, blocks, self.length = HEAD.unpack(file.read(HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        self.table = np.frombuffer(file.read(docs * DOC.itemsize), DOC)
        self.ends = np.cumsum(self.table["n"].astype(np.int64))
        self.begins = self.ends - self.table["n"]
        self.starts = np.frombuffer(file.read(4 * (blocks + 1)), "<u4").astype(np.int64) + HEAD.size + docs * DOC.itemsize + 4 * (blocks + 1)
        self.last = -1, np.zeros(0, np.uint32)

    def block(self, i: int) -> np.ndarray:
        if self.last[0] != i:
            self.file.seek(int(self.starts[i]))
            self.last = i, decode_block(self.file.read(int(self.starts[i + 1] - self.starts[i])), min(self.length, self.n - i * self.length))
        return self.last[1]

    def ids(self, document: int) -> np.ndarray:
        """The ids of a document by its place in the file, from the blocks that hold it."""
        begin, end = int(self.begins[document]), int(self.ends[document])
        parts = [self.block(i)[max(0, begin - i * self.length) : end - i * self.length] for i in range(begin // self.length, -(-end // self.length))]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def store(path: str):
    """The file system of a URI or local path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


MANIFEST = "part int, file int, name string, first_id long, n_ids long, n_docs long, least long, most long, nulls long"


def write_token_files(df: DataFrame, path: str, end_id: int = 2, vocabulary: str | None = None, ids_a_file: int = 1 << 18, percentile: float = 0.95) -> None:
    """Tokenise (doc_id, text) and write its files, in ascending doc_id order, to the folder ``path``.

    ``path`` is a URI that the driver and all executors reach (file, hdfs, s3, gs or abfs, by pyarrow.fs). Each file
    is written under a name of the attempt's own and then moved to its place, so a task that runs again
    replaces whole files by equal ones. The table ``path``/manifest, which Spark commits, lists the files that count:
    part, file, name, first_id within the part, sizes, and the least and greatest doc_id. Documents of equal
    doc_id follow the hash of their text; null doc_ids come first. A file holds whole documents and ends
    after ``ids_a_file`` ids.
    """
    vocab = vocabulary or vocabulary_path("word_bpe_49k.json")
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "_tie")]
    rows = df.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("_tie"))
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    system, folder = store(path)
    system.create_dir(folder, recursive=True)

    def make():
        from pyspark import TaskContext

        pieces, end = shared_pieces(WordPieces, vocab), int(end_id).to_bytes(4, "little")
        state = {"docs": [], "ids": 0, "file": 0, "first": 0}
        task = TaskContext.get()
        system, folder = store(path)

        def flush() -> dict[str, list]:
            name = f"part-{task.partitionId():05d}-{state['file']:05d}.pfr"
            own = f"{folder}/.{name}-{task.taskAttemptId()}"
            with system.open_output_stream(own) as f:
                f.write(encode_file(state["docs"], percentile))
            system.move(own, f"{folder}/{name}")
            known = [d for d, _ in state["docs"] if d is not None]
            out = {
                "part": [task.partitionId()], "file": [state["file"]], "name": [name], "first_id": [state["first"]], "n_ids": [state["ids"]], "n_docs": [len(state["docs"])],
                "least": [min(known, default=None)], "most": [max(known, default=None)], "nulls": [len(state["docs"]) - len(known)],
            }
            state.update(docs=[], ids=0, file=state["file"] + 1, first=state["first"] + state["ids"])
            return out

        def work(batch):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = pieces.ids(text or "") + end
                state["docs"].append((doc, ids))
                state["ids"] += len(ids) // 4
                if state["ids"] >= ids_a_file:
                    yield flush()

        work.finish = lambda: [flush()] if state["docs"] else []
        return work

    arrow_map(placed.select("doc_id", "text"), make, MANIFEST).write.parquet(f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents from the files of ``path``: doc_id, start, n_tokens, ids_crc32. Only a total for each part meets on the driver."""
    files = manifest(spark, path)
    totals = sorted((r["part"], r["ids"]) for r in files.groupBy("part").agg(F.sum("n_ids").alias("ids")).collect())
    before, total = {}, 0
    for part, n in totals:
        before[part] = total
        total += n
    starts = [before.get(i, 0) for i in range(max(before, default=0) + 1)]

    def make():
        system, folder = store(path)

        def work(batch):
            for part, name, first in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                with system.open_input_file(f"{folder}/{name}") as f:
                    file = TokenFile(pa.BufferReader(f.read()))
                table = file.table
                yield {
                    "doc_id": pa.array(table["id"], mask=table["has"] == 0), "start": file.begins + (starts[part] + first), "n_tokens": table["n"].astype(np.int64),
                    "ids_crc32": [zlib.crc32(file.ids(i).astype("<u4", copy=False)) for i in range(len(table))],
                }

        return work

    return arrow_map(files.select("part", "name", "first_id"), make, "doc_id long, start long, n_tokens long, ids_crc32 long", rows=16)


def document_ids(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of each document of this doc_id: from the manifest's ranges the files, and of each file its tables and the blocks that hold it."""
    system, folder = store(path)
    found = []
    for r in manifest(spark, path).filter((F.col("least") <= doc_id) & (F.col("most") >= doc_id)).orderBy("part", "file").select("name").collect():
        with system.open_input_file(f"{folder}/{r['name']}") as f:
            file = TokenFile(f)
            found += [file.ids(int(i)) for i in np.flatnonzero((file.table["id"] == doc_id) & (file.table["has"] == 1))]
    return found


def round_trip(df: DataFrame, **parameters) -> DataFrame:
    """Write the files of (doc_id, text) to the shared scratch folder and read them back.

    Null or empty text: the end id alone. An empty table gives no rows. Other columns are ignored.
    """
    path = scratch_path(df.sparkSession, "tokens")
    path = path if "://" in path else f"file://{path.removeprefix('file:')}"
    write_token_files(df, path, **parameters)
    return read_token_files(df.sparkSession, path)
