"""Sum-of-squares packing of documents into windows of tokens."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.bpe import encoder
from quayside.session import ship_package

#: Closes every document.
END_ID = 0
#: Sequence numbers of one task; tasks number from their partition on.
TASK_SHIFT = 36
_EMIT_ROWS = 20_000
_NUMBERS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@dataclass
class Piece:
    """A run of one document's ids."""

    doc: object
    start: int
    ids: bytes
    total: int

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.start, self.ids[: 4 * at], self.total),
            Piece(self.doc, self.start + at, self.ids[4 * at :], self.total),
        )


@dataclass
class Window:
    pieces: list[Piece] = field(default_factory=list)
    fill: int = 0

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.fill += len(piece)


class SumOfSquares:
    """Online packing: each piece goes to the fill level that leaves the least sum of squared level counts.

    ``levels[h]`` counts the windows filled to ``h``; empty and full windows do not count. Only partly filled windows
    are held, so memory follows their number and not the number of documents.
    """

    def __init__(self, size: int):
        self.size = size
        self.levels = np.zeros(size + 1, dtype=np.int64)
        self.open: list[list[Window]] = [[] for _ in range(size + 1)]

    def level_for(self, length: int) -> int:
        """The level whose window takes a piece of ``length``; 0 is a new window. Ties take the fullest."""
        counts = self.levels
        reach = self.size - length
        gain = np.where(counts[: reach + 1] > 0, 1 - 2 * counts[: reach + 1], np.iinfo(np.int64).max // 2)
        gain[0] = 0
        grown = 2 * counts[length : self.size + 1] + 1
        grown[reach] = 0  # a full window leaves the count
        change = gain + grown
        return reach - int(np.argmin(change[::-1]))

    def place(self, piece: Piece) -> Window | None:
        """Put a piece shorter than a window; returns the window if that fills it."""
        level = self.level_for(len(piece))
        if level:
            window = self.open[level].pop()
            self.levels[level] -= 1
        else:
            window = Window()
        window.add(piece)
        if window.fill == self.size:
            return window
        self.open[window.fill].append(window)
        self.levels[window.fill] += 1
        return None

    def close(self) -> Iterator[Window]:
        """Windows for what is still open, without padding.

        The emptiest windows are cut up to fill the fullest; what is left over, less than one window, is cut into
        windows whose lengths are powers of two.
        """
        rest = [w for level in reversed(self.open) for w in level]
        spare: list[Piece] = []
        low, high = 0, len(rest)
        while low < high:
            window = rest[low]
            low += 1
            while window.fill < self.size:
                if not spare:
                    if low == high:
                        break
                    high -= 1
                    spare = rest[high].pieces[::-1]
                piece = spare.pop()
                room = self.size - window.fill
                if len(piece) > room:
                    piece, back = piece.cut(room)
                    spare.append(back)
                window.add(piece)
            if window.fill == self.size:
                yield window
            else:
                spare = window.pieces[::-1]
        held = sum(map(len, spare))
        while held:
            size = self.size if held >= self.size else 1 << (held.bit_length() - 1)
            window = Window()
            while window.fill < size:
                piece = spare.pop()
                if len(piece) > size - window.fill:
                    piece, back = piece.cut(size - window.fill)
                    spare.append(back)
                window.add(piece)
            held -= size
            yield window


def pack(docs: Iterator[tuple[object, bytes]], size: int) -> Iterator[Window]:
    """Windows over ``(document, ids)``: whole windows of long documents at once, remainders by level."""
    packer = SumOfSquares(size)
    for doc, ids in docs:
        total = len(ids) // 4
        whole = total - total % size
        for start in range(0, whole, size):
            window = Window()
            window.add(Piece(doc, start, ids[4 * start : 4 * (start + size)], total))
            yield window
        if whole < total:
            full = packer.place(Piece(doc, whole, ids[4 * whole :], total))
            if full:
                yield full
    yield from packer.close()


def _pack_task(batches: Iterator[pa.RecordBatch], path: str, size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    tool = encoder(path)
    end = np.array([END_ID], dtype="<u4").tobytes()
    base = TaskContext.get().partitionId() << TASK_SHIFT

    def encoded() -> Iterator[tuple[object, bytes]]:
        for batch in batches:
            docs = iter(batch.column(0))
            for ids, counts in tool.column_ids(pc.fill_null(batch.column(1), ""), end):
                last = np.cumsum(counts)
                for begin, stop in zip((last - counts).tolist(), last.tolist(), strict=True):
                    yield next(docs).as_py(), ids[begin:stop].tobytes()

    rows: list[tuple] = []

    def emit() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    for number, window in enumerate(pack(encoded(), size)):
        offset = 0
        for piece in window.pieces:
            rows.append((piece.doc, piece.start, len(piece), zlib.crc32(piece.ids), piece.total, base + number, offset))
            offset += len(piece)
        if len(rows) >= _EMIT_ROWS:
            yield emit()
            rows.clear()
    if rows:
        yield emit()


def pack_documents(docs: DataFrame, path: str, size: int = 1024, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per piece: ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every task packs its own part of the input, without a shuffle; sequence numbers carry the part's number. Each document
    ends with id 0, so null and empty texts are one id long. Documents longer than a window fill whole windows first.
    Repeated rows are packed each, a null key stays null, an empty table gives no rows, and other columns are ignored.
    A task that is run again packs the same rows in the same order if its input is a stored table.
    """
    ship_package(docs.sparkSession)
    narrow = docs.select(F.col(key), F.col(text).cast("string").alias(text))
    kind = narrow.schema[0].dataType.simpleString()
    schema = pa.schema([(key, narrow.limit(0).toArrow().schema.field(0).type), *[(n, pa.int64()) for n in _NUMBERS]])
    return narrow.mapInArrow(
        functools.partial(_pack_task, path=path, size=size, schema=schema),
        ", ".join([f"`{key}` {kind}", *[f"{n} long" for n in _NUMBERS]]),
    )
