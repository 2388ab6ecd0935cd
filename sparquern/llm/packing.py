"""Harmonic packing of tokenised documents into sequences of fixed capacity.

Whole sequences are cut off a document first. What remains stays whole: its length falls into a
reciprocal-capacity class, where class j holds lengths over capacity / (j + 1) and up to capacity / j, and each
of its bins takes j of them. The gap that such a bin has left is filled by pieces of some other remainder,
which alone is cut. Every task fills its own bins; nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

from pyspark.sql import DataFrame

from .shared import arrow_map
from .tokens import SpacedPieces, shared_pieces, vocabulary_path

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, capacity long"


Piece = tuple[int | None, int, bytes, int]  # doc_id, start, ids, the document's number of ids


def cut(piece: Piece, n: int) -> tuple[Piece, Piece]:
    """The first n ids of a piece, and the others."""
    doc, start, ids, tokens = piece
    return (doc, start, ids[: 4 * n], tokens), (doc, start + n, ids[4 * n :], tokens)


def length(piece: Piece) -> int:
    return len(piece[2]) // 4


class HarmonicBins:
    """Open bins by class, the bins that lack but their filling, and the remainder that is cut to fill them."""

    def __init__(self, capacity: int, first_id: int) -> None:
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[Piece]] = defaultdict(list)
        self.waiting: list[Piece] = []
        self.filler: Piece | None = None

    def put(self, document: Piece) -> list[tuple]:
        """The rows of the sequences that this document fills."""
        rows: list[tuple] = []
        doc, start, ids, tokens = document
        whole = length(document) // self.capacity * self.capacity
        for at in range(0, whole, self.capacity):
            rows += self.closed([(doc, start + at, ids[4 * at : 4 * (at + self.capacity)], tokens)])
        document = doc, start + whole, ids[4 * whole :], tokens
        n = length(document)
        if not n:
            return rows
        if self.waiting:  # then there is no filler left
            self.filler = document
        else:
            j = self.capacity // n
            self.open[j].append(document)
            if len(self.open[j]) == j:
                self.waiting = self.open.pop(j)
        while self.waiting and (gap := self.capacity - sum(map(length, self.waiting))) and self.filler is not None:
            piece, rest = cut(self.filler, gap)
            self.filler = rest if length(rest) else None
            self.waiting.append(piece)
        if self.waiting and sum(map(length, self.waiting)) == self.capacity:
            rows += self.closed(self.waiting)
            self.waiting = []
        return rows

    def closed(self, bin_: list[Piece]) -> list[tuple]:
        rows, offset = [], 0
        for piece in bin_:
            doc, start, ids, tokens = piece
            rows.append((doc, start, length(piece), zlib.crc32(ids), tokens, self.next_id, offset, self.capacity))
            offset += length(piece)
        self.next_id += 1
        return rows

    def finish(self) -> list[tuple]:
        """What is left at the end of the task, less than one bin of each class, one piece after another.

        It is cut where a sequence ends; the last sequences end at powers of two, where no padding is due.
        """
        left = [*self.waiting, *([self.filler] if self.filler else []), *(p for bin_ in self.open.values() for p in bin_)]
        self.open.clear()
        self.waiting, self.filler = [], None
        total, rows, bin_, goal = sum(map(length, left)), [], [], 0
        for piece in left:
            while length(piece):
                goal = goal or min(self.capacity, 1 << total.bit_length() - 1)
                first, piece = cut(piece, goal - sum(map(length, bin_)))
                bin_.append(first)
                if sum(map(length, bin_)) == goal:
                    rows += self.closed(bin_)
                    total, bin_, goal = total - goal, [], 0
        return rows


def pack_documents(df: DataFrame, capacity: int = 1024, end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents of (doc_id, text) with their place in the packed sequences.

    A document is its ids and then ``end_id``; each id lies in just one piece, and but for the fillers of other
    bins a document lies in as few sequences as its length needs. ``capacity`` is a power of two. Null or empty text: the end id alone. Null doc_ids and repeated rows
    are documents of their own. An empty table gives no rows. Other columns are ignored.
    sequence_id has the number of the task above its 33 lower bits.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    path = vocabulary or vocabulary_path("byte_bpe_50k.json")

    def make():
        from pyspark import TaskContext

        pieces, end = shared_pieces(SpacedPieces, path), int(end_id).to_bytes(4, "little")
        bins = HarmonicBins(capacity, TaskContext.get().partitionId() << 33)

        def columns(rows: list[tuple]) -> dict[str, list]:
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            return dict(zip(names, zip(*rows, strict=True), strict=True)) if rows else {n: [] for n in names}

        def work(batch):
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = pieces.ids(text or "") + end
                rows += bins.put((doc, 0, ids, len(ids) // 4))
            yield columns(rows)

        work.finish = lambda: [columns(bins.finish())]
        return work

    return arrow_map(df.select(df["doc_id"].cast("long"), df["text"].cast("string")), make, SCHEMA)
