"""Document fingerprints: SimHash votes of weighted terms, and all near fingerprints from permuted block tables."""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.block_tables import BITS, BUCKET, block_masks, dealt, hex_of, shared_buckets
from quayside.session import settle, ship_package

#: Words whose hashes a worker remembers, and terms voted on together.
CACHE_WORDS = 500_000
_VOTES = 1 << 14
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd 64-bit multipliers
_EMIT_ROWS = 5_000


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


@functools.cache
def _words() -> _WordHashes:
    return _WordHashes()


def term_hashes(text: str) -> np.ndarray:
    """A hash for each pair of neighbouring lower-cased words; the first word also pairs with the start of the text."""
    words = text.lower().split()
    known = _words()
    ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    before = np.concatenate((np.zeros(1, np.uint64), ids[:-1])) if len(ids) else ids
    mixed = ids * _LEFT + (before ^ (before >> np.uint64(29))) * _RIGHT
    mixed ^= mixed >> np.uint64(32)
    mixed *= _LEFT
    return mixed ^ (mixed >> np.uint64(29))


def simhash(text: str) -> int:
    """64 signed votes; a term that occurs n times weighs 1 + ln(n), and a bit is 1 if its votes are above zero."""
    terms, counts = np.unique(term_hashes(text), return_counts=True)
    votes = np.zeros(BITS, np.float64)
    for at in range(0, len(terms), _VOTES):
        part = terms[at : at + _VOTES].astype(">u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1)
        n = counts[at : at + _VOTES]
        often = n > 1
        extra = np.log(n[often])
        votes += 2.0 * bits.sum(axis=0, dtype=np.int64) - len(part)
        votes += 2.0 * (extra @ bits[often]) - extra.sum()
    return int.from_bytes(np.packbits(votes > 0).tobytes(), "big")


def likeness(a: int, b: int) -> float:
    """Cosine that the share of equal bits stands for, 0 for unrelated texts and 1 for equal fingerprints."""
    return max(0.0, math.cos(math.pi * (a ^ b).bit_count() / BITS))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as many first characters of the next document, or all it has."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


_RESULT = (
    "place int, rank long, edge boolean, n_chars long, fp long, edited_sha256 string, edited_fp long, near_edited double, "
    "near_next double, text string"
)
_ARROW = [
    ("place", pa.int32()), ("rank", pa.int64()), ("edge", pa.bool_()), ("n_chars", pa.int64()), ("fp", pa.int64()),
    ("edited_sha256", pa.string()), ("edited_fp", pa.int64()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ("text", pa.string()),
]


def compared(text: str, mine: int, following: str, next_print: int) -> tuple:
    changed = edited(text, following)
    other = simhash(changed) if changed != text else mine
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return digest, _signed(other), likeness(mine, other), likeness(mine, next_print)


def _pair_up(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order; each but the last meets its follower. First and last rows leave with their texts."""
    place, rank = TaskContext.get().partitionId(), 0
    held: tuple | None = None  # key, text, fingerprint
    rows: list[tuple] = []

    def row(key, text: str, fp: int, after: tuple | None) -> tuple:
        edge = rank == 0 or after is None
        made = compared(text, fp, after[1], after[2]) if after else (None, None, None, None)
        return key, place, rank, edge, len(text), _signed(fp), *made, text if edge else None

    def emit() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py() or ""
            now = (key.as_py(), text, simhash(text))
            if held:
                rows.append(row(*held, now))
                rank += 1
                if len(rows) >= _EMIT_ROWS:
                    yield emit()
                    rows.clear()
            held = now
    if held:
        rows.append(row(*held, None))
    if rows:
        yield emit()


def _close_edges(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows that end a range, each with the text that starts the next one."""
    for batch in batches:
        rows = []
        for x in batch.to_pylist():
            fp = x["fp"] % (1 << BITS)
            made = compared(x["text"], fp, x["next_text"], x["next_fp"] % (1 << BITS))
            rows.append((x[schema.names[0]], x["n_chars"], x["fp"], *made))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)


def edited_fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_chars, fp, edited_sha256, edited_fp, near_edited, near_next`` of every document.

    The next document is the next in ascending key (nulls first; rows with equal keys by a hash of the text); after the last comes the first,
    which is itself in a table of one row. Null texts count as empty. Texts are dealt once, by ranges of the key, in sorted order;
    only the first and last row of each range leave their task with a text, to meet the neighbouring range. An empty table gives
    no rows; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    narrow = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = narrow.schema[0].dataType.simpleString()
    id_field = pa.field(key, narrow.limit(0).toArrow().schema.field(0).type)
    full = pa.schema([id_field, *[pa.field(*x) for x in _ARROW]])
    by = [F.col(key).asc_nulls_first(), F.xxhash64("text")]
    ranged = narrow.repartitionByRange(*by).sortWithinPartitions(*by, "text")
    made = settle(ranged.mapInArrow(functools.partial(_pair_up, schema=full), f"`{key}` {kind}, {_RESULT}"), "prints")

    names = ["n_chars", "fp", "edited_sha256", "edited_fp", "near_edited", "near_next"]
    firsts = made.where("rank = 0").select("place", F.col("text").alias("next_text"), F.col("fp").alias("next_fp"))
    # One row per range that has rows: the range after it, or the first one again.
    places = firsts.select("place").agg(F.sort_array(F.collect_list("place")).alias("all"))
    pairs = places.select(F.explode(F.arrays_zip(F.col("all").alias("place"), F.concat(F.slice("all", 2, 1 << 30), F.slice("all", 1, 1)).alias("after"))).alias("p"))
    steps = pairs.select(F.col("p.place").alias("place"), F.col("p.after").alias("after"))
    lasts = made.where("edge AND edited_sha256 IS NULL").join(steps, "place").select(key, "n_chars", "fp", "text", F.col("after"))
    ends = lasts.join(firsts, lasts["after"] == firsts["place"]).select(key, "n_chars", "fp", "text", "next_text", "next_fp")
    ended_schema = pa.schema([id_field, *[pa.field(n, dict(_ARROW)[n]) for n in names]])
    ended = ends.mapInArrow(
        functools.partial(_close_edges, schema=ended_schema),
        f"`{key}` {kind}, n_chars long, fp long, edited_sha256 string, edited_fp long, near_edited double, near_next double",
    )
    return made.where("edited_sha256 IS NOT NULL").select(key, *names).unionByName(ended)


def _count_near(batches: Iterator[pa.RecordBatch], radius: int, masks: list[int]) -> Iterator[pa.RecordBatch]:
    """Near partners of each fingerprint in the buckets of one task, weighted by the partner's documents.

    A pair counts in the first table that holds it, and across parts only between a left and a right row.
    """
    table_masks = np.array(masks, dtype=np.uint64)

    def counted(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        fp, n, left = rows["fp"].view(np.uint64), rows["rows"], rows["in_left"]
        first = int(rows["bucket_table"][0])
        across = rows["bucket_left"][0] != rows["bucket_right"][0]
        apart = np.bitwise_count(fp[:, None] ^ fp[None, :])
        near = apart <= radius
        np.fill_diagonal(near, False)
        if across:
            near &= left[:, None] != left[None, :]
        for mask in table_masks[:first]:
            part = fp & mask
            near &= part[:, None] != part[None, :]
        total = near @ n
        some = total > 0
        return rows["fp"][some], total[some]

    def batch_of(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        fp, near = (np.concatenate(x).astype(np.int64) for x in zip(*found))
        return pa.RecordBatch.from_pydict({"fp": pa.array(fp), "near": pa.array(near)})

    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        now = {name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)}
        if held is not None:
            now = {name: np.concatenate((held[name], now[name])) for name in now}
        new = np.zeros(len(now["fp"]), bool)
        for name in BUCKET:
            new[1:] |= now[name][1:] != now[name][:-1]
        cuts = [0, *np.flatnonzero(new).tolist()]
        if len(cuts) > 1:
            yield batch_of([counted({name: x[a:b] for name, x in now.items()}) for a, b in zip(cuts, cuts[1:])])
        held = {name: x[cuts[-1] :] for name, x in now.items()}
    if held is not None and len(held["fp"]):
        yield batch_of([counted(held)])


def near_counts(prints: DataFrame, radius: int) -> DataFrame:
    """``(fp, n_near)``: other rows of ``prints`` whose fingerprint ``fp`` differs in at most ``radius`` bits.

    Every row with that fingerprint has the count. Equal fingerprints are searched once and counted with their number, so copies
    are not expanded into pairs. The search is exact: see ``block_tables``.
    """
    ship_package(prints.sparkSession)
    classes = settle(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("rows")), "classes")
    buckets = shared_buckets(classes, radius).join(classes, "fp")
    found = dealt(buckets).mapInArrow(functools.partial(_count_near, radius=radius, masks=block_masks(radius)), "fp long, near long")
    near = settle(found.groupBy("fp").agg(F.sum("near").alias("near")), "near")
    return classes.join(near, "fp", "left").select("fp", (F.col("rows") - 1 + F.coalesce("near", F.lit(0))).alias("n_near"))


def fingerprint_documents(docs: DataFrame, radius: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``edited_fingerprints`` as hex digits, with ``n_near``: other documents within the Hamming radius."""
    made = settle(edited_fingerprints(docs, text, key), "fingerprints")
    near = settle(near_counts(made.select("fp"), radius), "near")
    return made.join(near, "fp").select(
        key,
        "n_chars",
        "edited_sha256",
        hex_of("fp").alias("fingerprint"),
        hex_of("edited_fp").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "n_near",
    )
