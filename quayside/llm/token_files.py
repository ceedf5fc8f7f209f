"""Token ids in binary files of patched frame-of-reference blocks.

A file is a run of segments, one after the other. A segment holds the ids of consecutive documents:

    magic, version, part, sequence number, documents, ids, blocks, exceptions, bytes of keys, bytes of body   (header)
    document keys as one Arrow column, then the number of ids of each document
    block index: start of each block in the body, its minimum, its width, its number of exceptions
    body: for each block of 128 ids their distances from the minimum, packed at the block's width
    exceptions: places in the block, and whole distances

The width of a block is the one that ``SHARE`` of its distances fit; the others are exceptions. Two lanes of 64 values are
packed into 64-bit words, so that numpy works off all blocks of one width at once. A block is read alone by its index.
Files are written by Spark's text writer, each segment as one line of raw bytes, and so to any file system and with
Spark's commit; the line break behind a segment is part of the format. They are read by Spark's binary reader.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.bpe import encoder
from quayside.operators.matching import small_side
from quayside.operators.ordering import parts_for
from quayside.session import settle, ship_package

MAGIC, VERSION = b"QPFR", 1
_HEADER = struct.Struct("<4sIQQQQQQQQ")
BLOCK, LANES = 128, 2
_DEEP = BLOCK // LANES
#: Part of a block's distances that its width has to hold.
SHARE = 0.9
#: Ids of a segment; a longer document is a segment of its own.
SEGMENT_IDS = 1 << 20
#: Closes every document.
END_ID = 0
_BREAK = b"\n"


def _pack_width(values: np.ndarray, width: int) -> np.ndarray:
    """``(blocks, 128)`` values below ``2 ** width`` as ``(blocks, 2 * width)`` words."""
    count = len(values)
    deep = np.ascontiguousarray(values.reshape(count, _DEEP, LANES).transpose(1, 0, 2)).astype(np.uint64)
    words = np.zeros((width, count, LANES), dtype=np.uint64)
    for i in range(_DEEP):
        word, shift = divmod(i * width, 64)
        words[word] |= deep[i] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= deep[i] >> np.uint64(64 - shift)
    return words.transpose(1, 0, 2).reshape(count, LANES * width)


def _unpack_width(words: np.ndarray, width: int) -> np.ndarray:
    count = len(words)
    deep = np.ascontiguousarray(words.reshape(count, width, LANES).transpose(1, 0, 2))
    mask = np.uint64((1 << width) - 1)
    out = np.empty((_DEEP, count, LANES), dtype=np.uint32)
    for i in range(_DEEP):
        word, shift = divmod(i * width, 64)
        value = deep[word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (deep[word + 1] << np.uint64(64 - shift))
        out[i] = value & mask
    return out.transpose(1, 0, 2).reshape(count, BLOCK)


def _widths(distances: np.ndarray) -> np.ndarray:
    """The width of each block: bits of the distance at the percentile."""
    at = int(np.ceil(SHARE * BLOCK)) - 1
    pivot = np.partition(distances, at, axis=1)[:, at]
    return np.frexp(pivot.astype(np.float64))[1].astype(np.uint8)


@dataclass
class Packed:
    """Blocks of ids and their index; all arrays are views of the segment where it was read."""

    ids: int
    starts: np.ndarray
    minima: np.ndarray
    widths: np.ndarray
    exceptions: np.ndarray
    body: np.ndarray
    places: np.ndarray
    values: np.ndarray

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.starts, self.minima, self.widths, self.exceptions, self.body, self.values, self.places

    def read(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last`` (exclusive): only the blocks that hold them are unpacked."""
        last = min(last, self.ids)
        if first >= last:
            return np.empty(0, dtype=np.uint32)
        low, high = first // BLOCK, -(-last // BLOCK)
        widths = self.widths[low:high]
        out = np.zeros((high - low, BLOCK), dtype=np.uint32)
        for width in np.unique(widths[widths > 0]).tolist():
            chosen = np.flatnonzero(widths == width)
            words = self.body[self.starts[low + chosen].astype(np.int64)[:, None] + np.arange(LANES * width)]
            out[chosen] = _unpack_width(words, width)
        ends = np.cumsum(self.exceptions, dtype=np.int64)
        begin, end = int(ends[low] - self.exceptions[low]), int(ends[high - 1])
        rows = np.repeat(np.arange(high - low), self.exceptions[low:high])
        out[rows, self.places[begin:end]] = self.values[begin:end]
        out += self.minima[low:high, None]
        return out.reshape(-1)[first - low * BLOCK : last - low * BLOCK]


def pack_blocks(ids: np.ndarray) -> Packed:
    """Blocks of ids; the last one is filled up with its last id."""
    blocks = -(-len(ids) // BLOCK)
    padded = np.empty(blocks * BLOCK, dtype=np.uint32)
    padded[: len(ids)] = ids
    padded[len(ids) :] = ids[-1] if len(ids) else 0
    values = padded.reshape(blocks, BLOCK)
    minima = values.min(axis=1) if blocks else np.empty(0, dtype=np.uint32)
    distances = values - minima[:, None]
    widths = _widths(distances) if blocks else np.empty(0, dtype=np.uint8)
    over = distances >= (np.uint64(1) << widths.astype(np.uint64))[:, None]
    rows, places = np.nonzero(over)
    found = distances[rows, places]
    distances[rows, places] = 0
    sizes = widths.astype(np.int64) * LANES
    starts = np.cumsum(sizes) - sizes
    body = np.zeros(int(sizes.sum()), dtype=np.uint64)
    for width in np.unique(widths[widths > 0]).tolist():
        chosen = np.flatnonzero(widths == width)
        body[starts[chosen][:, None] + np.arange(LANES * width)] = _pack_width(distances[chosen], width)
    return Packed(len(ids), starts.astype(np.uint64), minima, widths, np.bincount(rows, minlength=blocks).astype(np.uint8), body, places.astype(np.uint8), found)


def segment(part: int, number: int, keys: pa.Array, lengths: Sequence[int], ids: np.ndarray) -> bytes:
    """The bytes of one segment."""
    packed = pack_blocks(ids)
    sink = pa.BufferOutputStream()
    named = pa.RecordBatch.from_arrays([keys], names=["key"])
    with pa.ipc.new_stream(sink, named.schema) as stream:
        stream.write_batch(named)
    index = sink.getvalue().to_pybytes()
    arrays = [np.asarray(lengths, dtype=np.uint64), *packed.arrays()]
    head = _HEADER.pack(MAGIC, VERSION, part, number, len(lengths), packed.ids, len(packed.widths), len(packed.values), len(index), len(packed.body))
    return b"".join([head, index, *[a.tobytes() for a in arrays]])


@dataclass
class Segment:
    part: int
    number: int
    keys: pa.Array
    lengths: np.ndarray
    packed: Packed


def segments(content: memoryview) -> Iterator[Segment]:
    """The segments of a file, by their headers."""
    at = 0
    while at < len(content):
        magic, version, part, number, docs, ids, blocks, exceptions, index, body = _HEADER.unpack_from(content, at)
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"no segment of token ids at byte {at}")
        at += _HEADER.size
        with pa.ipc.open_stream(pa.py_buffer(content[at : at + index])) as stream:
            keys = stream.read_all().column(0).combine_chunks()
        at += index
        arrays = []
        for kind, count in ((np.uint64, docs), (np.uint64, blocks), (np.uint32, blocks), (np.uint8, blocks), (np.uint8, blocks), (np.uint64, body), (np.uint32, exceptions), (np.uint8, exceptions)):
            arrays.append(np.frombuffer(content, dtype=kind, count=count, offset=at))
            at += arrays[-1].nbytes
        lengths, starts, minima, widths, numbers, words, values, places = arrays
        yield Segment(part, number, keys, lengths, Packed(ids, starts, minima, widths, numbers, words, places, values))
        if content[at : at + 1] != _BREAK:
            raise ValueError(f"the segment before byte {at} does not end there")
        at += 1


def _write_task(batches: Iterator[pa.RecordBatch], path: str, most: int) -> Iterator[pa.RecordBatch]:
    tool, part, number = encoder(path), TaskContext.get().partitionId(), 0
    end = np.array([END_ID], dtype="<u4").tobytes()
    #: Documents of the segment at hand: slices of key columns, counts of ids, ids.
    keys: list[pa.Array] = []
    lengths: list[np.ndarray] = []
    parts: list[np.ndarray] = []
    held = 0

    def emit() -> pa.RecordBatch:
        made = segment(part, number, pa.concat_arrays(keys), np.concatenate(lengths), np.concatenate(parts))
        return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["segment"])

    for batch in batches:
        row = 0
        for ids, counts in tool.column_ids(batch.column(1), end):
            ends, done, at = np.cumsum(counts), 0, 0
            while done < len(counts):
                fit = int(np.searchsorted(ends, at + most - held, side="right"))
                if fit <= done and held:
                    yield emit()
                    keys, lengths, parts, held, number = [], [], [], 0, number + 1
                    continue
                fit = max(fit, done + 1)
                keys.append(batch.column(0).slice(row + done, fit - done))
                lengths.append(counts[done:fit])
                parts.append(ids[at : ends[fit - 1]])
                held += int(ends[fit - 1]) - at
                done, at = fit, int(ends[fit - 1])
            row += len(counts)
    if held:
        yield emit()


def write_token_files(docs: DataFrame, tokenizer: str, path: str, text: str = "text", key: str = "doc_id", segment_ids: int = SEGMENT_IDS) -> None:
    """Files of the ids of all documents below ``path``, in ascending order of ``key`` (null first, ties by text).

    Texts are range-partitioned and sorted by key, and each task encodes its range into one file, a segment at a time; every document
    ends with id 0, so that null and empty texts are one id long. Repeated rows are written each, an empty table gives no
    segments, and other columns are ignored. A task that is run again writes the same file.
    """
    spark = docs.sparkSession
    ship_package(spark)
    narrow = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    order = ["key", F.xxhash64("text"), "text"]
    ranged = narrow.repartitionByRange(parts_for(narrow), *order[:2]).sortWithinPartitions(*order)
    packed = ranged.mapInArrow(functools.partial(_write_task, path=tokenizer, most=segment_ids), "segment binary")
    # The text writer writes the bytes of a string as they are, and the line break.
    packed.select(F.col("segment").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "none").text(path)


def _read_task(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for cell in batch.column(0):
            start = 0
            for found in segments(memoryview(cell.as_buffer())):
                ends = np.cumsum(found.lengths, dtype=np.int64)
                ids = found.packed.read(0, found.packed.ids).astype("<u4", copy=False)
                raw = memoryview(ids).cast("B")
                bounds = zip((ends - found.lengths.astype(np.int64)).tolist(), ends.tolist(), strict=True)
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in bounds]
                columns = [
                    found.keys,
                    pa.array(np.full(len(ends), found.part)),
                    pa.array(start + ends - found.lengths.astype(np.int64)),
                    pa.array(found.lengths.astype(np.int64)),
                    pa.array(sums, pa.int64()),
                ]
                start += found.packed.ids
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def read_token_files(spark: SparkSession, path: str, key_type: str = "long", key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every document, read from the files below ``path``.

    ``start`` counts the ids of all documents before. Each file is unpacked once; only the ids that each file holds, one row a
    file, are summed up across files.
    """
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    names = f"key {key_type}, part long, at long, n_tokens long, ids_crc32 long"
    key_field = spark.createDataFrame([], f"key {key_type}").toArrow().schema.field(0)
    schema = pa.schema([key_field, *[pa.field(n, pa.int64()) for n in ("part", "at", "n_tokens", "ids_crc32")]])
    docs = settle(files.mapInArrow(functools.partial(_read_task, schema=schema), names), "token-docs")
    held = docs.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    before = F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = held.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    found = docs.join(small_side(starts), "part")
    return found.select(F.col("key").alias(key), (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
