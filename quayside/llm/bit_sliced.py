"""SimHash near-duplicates, compared by vertical bit planes and carry-save counters."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.block_tables import BITS, BUCKET, dealt, hex_of, shared_buckets
from quayside.llm.components import connected_components
from quayside.session import settle, ship_package

#: Seed of the shingle hash, as Spark's own xxhash64 uses it.
SEED = 42
#: Rows compared together, and machine words of lanes that are abandoned together.
BATCH_ROWS = 1 << 16
BLOCK_WORDS = 16
_CHECK_EVERY = 8
_VOTES = 1 << 14


def fingerprint(raw: bytes, shingle: int) -> int:
    """SimHash of a UTF-8 text: a bit is 1 if it is set in over half of the shingles' hashes; 0 without words."""
    words = raw.lower().split()  # of bytes: A-Z only, and exactly the six ASCII white spaces
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype=">u8")
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _VOTES):
        part = hashes[at : at + _VOTES]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(hashes)).tobytes(), "big")


def _fingerprint_task(batches: Iterator[pa.RecordBatch], shingle: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(x.as_py() or b"", shingle) for x in batch.column(batch.num_columns - 1)], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found.view(np.int64))], schema=schema)


def with_fingerprints(docs: DataFrame, shingle: int, keep: list[str], text: str = "text", name: str = "fp") -> DataFrame:
    """Columns ``keep`` and the fingerprint of each whole text as a signed long; null texts count as empty."""
    ship_package(docs.sparkSession)
    narrow = docs.select(*keep, F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8").alias(name))
    kinds = narrow.drop(name).limit(0).toArrow().schema
    schema = pa.schema([*kinds, pa.field(name, pa.int64())])
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema[:-1]], f"{name} long"])
    return narrow.mapInArrow(functools.partial(_fingerprint_task, shingle=shingle, schema=schema), ddl)


def _planes(prints: np.ndarray) -> np.ndarray:
    """Bit plane ``b`` holds bit ``b`` of every fingerprint, 64 fingerprints a word; shape (64, words)."""
    lanes = -(-len(prints) // 64) * 64
    bits = np.zeros((lanes, BITS), np.uint8)
    bits[: len(prints)] = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _ahead(planes: np.ndarray, lanes: int) -> np.ndarray:
    """Planes moved down so that each lane faces the lane ``lanes`` further on."""
    words, bits = divmod(lanes, 64)
    moved = np.zeros_like(planes)
    moved[:, : planes.shape[1] - words] = planes[:, words:]
    if bits:
        carry = np.zeros_like(planes)
        carry[:, :-1] = moved[:, 1:] << np.uint64(64 - bits)
        moved = (moved >> np.uint64(bits)) | carry
    return moved


def _beyond(mine: np.ndarray, theirs: np.ndarray, wanted: np.ndarray, radius: int) -> np.ndarray:
    """Lanes, as words, whose distance exceeds the radius or that are not wanted.

    One counter for each lane, itself stored as planes: every differing bit is added to all lanes at once by carries. The
    counters start so high that the last carry leaves them at ``radius + 1``. Blocks of lanes that are all beyond the
    radius are not looked at again.
    """
    width = max(1, radius.bit_length())
    start = (1 << width) - (radius + 1)
    blocks = len(wanted) // BLOCK_WORDS
    out = ~wanted.reshape(blocks, BLOCK_WORDS)
    live = np.flatnonzero((out != ~np.uint64(0)).any(axis=1))
    a, b = (x.reshape(BITS, blocks, BLOCK_WORDS) for x in (mine, theirs))
    counters = [np.full((len(live), BLOCK_WORDS), ~np.uint64(0) if start >> k & 1 else np.uint64(0)) for k in range(width)]
    gone = out[live]
    for first in range(0, BITS, _CHECK_EVERY):
        for bit in range(first, first + _CHECK_EVERY):
            carry = a[bit, live] ^ b[bit, live]
            for k in range(width):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            gone |= carry
        stay = (gone != ~np.uint64(0)).any(axis=1)
        if not stay.all():
            out[live] = gone
            live, gone, counters = live[stay], gone[stay], [c[stay] for c in counters]
            if not len(live):
                break
    out[live] = gone
    return out.reshape(-1)


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        above = parent[parent]
        if (above == parent).all():
            return parent
        parent = above


def forest(prints: np.ndarray, bucket: np.ndarray, radius: int) -> np.ndarray:
    """Parents (positions) of a forest that joins exactly the fingerprints linked inside a bucket.

    ``bucket`` numbers the rows' buckets in ascending order. At step ``s`` every row meets the row ``s`` further on; pairs
    already joined need no comparison.
    """
    rows = len(prints)
    words = -(-rows // 64)
    words = -(-words // BLOCK_WORDS) * BLOCK_WORDS
    padded = np.zeros(words * 64, np.uint64)
    padded[:rows] = prints
    planes = _planes(padded)
    parent = np.arange(rows)
    last = np.searchsorted(bucket, bucket, side="right") - 1
    for step in range(1, int((last - np.arange(rows)).max(initial=0)) + 1):
        wanted = np.zeros(words * 64, bool)
        wanted[: rows - step] = (bucket[:-step] == bucket[step:]) & (parent[:-step] != parent[step:])
        if not wanted.any():
            continue
        lanes = np.packbits(wanted, bitorder="little").view("<u8")
        beyond = _beyond(planes, _ahead(planes, step), lanes, radius)
        near = np.flatnonzero(np.unpackbits((~beyond).view(np.uint8), bitorder="little"))
        if not len(near):
            continue
        for i in near.tolist():
            x, y = i, i + step
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            parent[max(x, y)] = min(x, y)
        parent = _roots(parent)
    return parent


def _link_task(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Forest links of the buckets of one task; a bucket that continues in the next batch is kept back."""

    def links(table: pa.Table) -> pa.RecordBatch:
        keys = [table.column(c).to_numpy() for c in BUCKET]
        new = np.zeros(table.num_rows, bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        prints = table.column("fp").to_numpy().view(np.uint64)
        parent = forest(prints, np.cumsum(new), radius)
        child = np.flatnonzero(parent != np.arange(len(parent)))
        return pa.RecordBatch.from_pydict(
            {"a": pa.array(prints[child].view(np.int64)), "b": pa.array(prints[parent[child]].view(np.int64))}
        )

    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        if held.num_rows < BATCH_ROWS:
            continue
        differs = np.zeros(held.num_rows, bool)
        for c in BUCKET:
            values = held.column(c).to_numpy()
            differs |= values != values[-1]
        cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
        if cut:
            yield links(held.slice(0, cut).combine_chunks())
            held = held.slice(cut).combine_chunks()
    if held is not None and held.num_rows:
        yield links(held)


def near_components(prints: DataFrame, radius: int) -> DataFrame:
    """``(node, component)`` of distinct fingerprints ``fp`` linked by chains of at most ``radius`` differing bits.

    Fingerprints without a link have no row. Two copies of a pair may be joined by way of others inside a task, so links
    form forests and their number stays below the number of rows.
    """
    buckets = dealt(shared_buckets(prints, radius))
    links = buckets.select(*BUCKET, "fp").mapInArrow(functools.partial(_link_task, radius=radius), "a long, b long")
    return connected_components(links)


def _grouped(docs: DataFrame, shingle: int, radius: int, text: str, key: str) -> DataFrame:
    """``key, text_hash, fp, root, component_id``; ``root`` names a group, also one without keys."""
    hashed = docs.select(F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), F.col(text).alias("text"))
    prints = settle(with_fingerprints(hashed, shingle, [key, "text_hash"], "text"), "fingerprints")
    classes = settle(prints.groupBy("fp").agg(F.min(key).alias("lowest")), "classes")
    found = near_components(classes.select("fp"), radius)
    rooted = settle(
        classes.join(found.select(F.col("node").alias("fp"), "component"), "fp", "left").select(
            "fp", "lowest", F.coalesce("component", "fp").alias("root")
        ),
        "roots",
    )
    lowest = settle(rooted.groupBy("root").agg(F.min("lowest").alias("component_id")), "lowest")
    named = settle(rooted.join(lowest, "root").select("fp", "root", "component_id"), "named")
    return prints.join(named, "fp").select(key, "text_hash", "fp", "root", "component_id")


def group_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, fingerprint, component_id`` of every document.

    ``component_id`` is the smallest key among documents that chains of near fingerprints reach, the document's own
    included. Null and empty texts, and texts of white space, have fingerprint 0 and are linked like any other. Copies share a
    fingerprint and are compared once. Null keys are kept and never are the smallest; a group of null keys has a null
    component. Repeated rows stay repeated. An empty table gives no rows; other columns are ignored.
    """
    return _grouped(docs, shingle, radius, text, key).select(key, hex_of("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each group of ``group_near_duplicates``: that of the smallest key, null keys last.

    Rows of one key are told apart by a hash of their text, and rows with equal key and text are one. Columns and their order
    stay. The chosen keys are a stored table; texts are shuffled only if it is too large to broadcast.
    """
    grouped = settle(_grouped(docs, shingle, radius, text, key), "grouped")
    first = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("k"), F.col("text_hash").alias("h"))).alias("x")
    chosen = grouped.groupBy("root").agg(first).select("x.k", "x.h")
    copies = grouped.groupBy(F.col(key).alias("k"), F.col("text_hash").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    chosen = chosen.alias("c").join(copies.alias("n"), F.col("c.k").eqNullSafe(F.col("n.k")) & (F.col("c.h") == F.col("n.h")))
    chosen = settle(chosen.select("c.k", "c.h", "n.n"), "chosen")
    same = docs[key].eqNullSafe(chosen["k"]) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == chosen["h"])
    alone = docs.join(chosen.where("n = 1"), same, "left_semi")
    repeated = docs.join(chosen.where("n > 1"), same, "left_semi").dropDuplicates([key, text])
    return alone.unionByName(repeated)
