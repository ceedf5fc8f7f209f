"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.block_tables import in_part_pairs
from quayside.llm.components import connected_components
from quayside.session import local_table, settle, ship_package

SEED = 20
#: Least sort orders in a round, sign hashes in each, and how many rows ahead a row is compared.
PASSES, HASHES, WINDOW = 16, 63, 64
#: Share of the links at the least cosine that the passes of one round should find among vectors that are spread out.
RECALL = 0.95
_ROWS = 512


def passes_for(classes: int, least: float, window: int, recall: float = RECALL) -> int:
    """Passes of a round for ``classes`` vectors, as many as the recall asks for.

    Two vectors at the least cosine share a sign with probability ``1 - acos(least) / pi``, and stay within the window if they
    share about log2(classes / window) leading ones.
    """
    same = 1 - math.acos(max(-1.0, min(1.0, least))) / math.pi
    met = same ** max(0.0, math.log2(max(1, classes) / window))
    if met >= recall:
        return 1
    return math.ceil(math.log1p(-recall) / math.log1p(-met))


def usable(vector: Column) -> Column:
    """A vector with a direction: not null or empty, all components finite, one of them not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


@functools.cache
def _directions(dims: int, passes: int, turn: int) -> np.ndarray:
    return np.random.default_rng((SEED, dims, turn)).standard_normal((dims, passes * HASHES))


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Unit rows in double precision; all vectors have one length."""
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares of very large or small numbers stay in range
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _code_task(batches: Iterator[pa.RecordBatch], passes: int, turn: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per vector and pass: the signs of the pass's random projections, joined to a number."""
    for batch in batches:
        dims = batch.column(2).to_numpy()
        for d in np.unique(dims):
            part = batch.filter(pa.array(dims == d))
            unit, directions = _matrix(part.column(1)), _directions(int(d), passes, turn)
            for p in range(passes):
                signs = np.zeros((len(part), 64), bool)
                signs[:, 64 - HASHES :] = unit @ directions[:, p * HASHES : (p + 1) * HASHES] > 0
                codes = np.packbits(signs, axis=1).view(">i8")[:, 0].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), p, np.int32)), part.column(2), pa.array(codes), *(part.column(c) for c in (3, 0, 1))],
                    schema=schema,
                )


class _Joined:
    """Union-find over the classes that one task has linked."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        parent = self.parent
        while (above := parent.setdefault(node, node)) != node:
            parent[node] = parent[above]
            node = parent[node]
        return node

    def add(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _window_task(batches: Iterator[pa.RecordBatch], window: int, least: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Verified links between rows at most ``window`` apart in the sorted order of their pass, inside one range.

    The first and last ``window`` rows of the range leave with their rank in it, to meet the neighbouring ranges, and a row
    without a class tells how many rows the range has.
    """
    joined = _Joined()
    run: tuple[int, int] | None = None
    ids, rows = np.empty(0, np.int64), np.empty((0, 0))
    place, seen = TaskContext.get().partitionId(), 0
    last: list[tuple[int, pa.RecordBatch]] = []  # rank of the first row, rows

    def edge(rank: int, part: pa.RecordBatch) -> pa.RecordBatch:
        n, none = len(part), pa.nulls(len(part), pa.int64())
        ranks = pa.array(np.arange(rank, rank + n, dtype=np.int64))
        own = [part.column(c) for c in (0, 1, 4, 5)]
        return pa.RecordBatch.from_arrays([none, none, pa.array(np.full(n, place, np.int32)), ranks, *own], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        found: list[tuple[int, int]] = []
        passes, dims = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((passes[1:] != passes[:-1]) | (dims[1:] != dims[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if run != (passes[a], dims[a]):
                run, ids, rows = (passes[a], dims[a]), np.empty(0, np.int64), np.empty((0, int(dims[a])))
            part = batch.slice(a, b - a)
            new_ids, new_rows = part.column(4).to_numpy(), _matrix(part.column(5))
            for at in range(0, len(new_ids), _ROWS):
                mine, block = new_ids[at : at + _ROWS], new_rows[at : at + _ROWS]
                before = len(ids)
                ids, rows = np.concatenate((ids, mine)), np.concatenate((rows, block))
                near = block @ rows.T >= least
                later = before + np.arange(len(mine))[:, None] - np.arange(len(ids))[None, :]
                i, j = np.nonzero(near & (later > 0) & (later <= window))
                found += [x for x in zip(mine[i].tolist(), ids[j].tolist()) if joined.add(*x)]
                ids, rows = ids[-window:], rows[-window:]
        if found:
            yield _link_batch(found, schema)
        opening = min(batch.num_rows, max(0, window - seen))
        if opening:
            yield edge(seen, batch.slice(0, opening))
        if opening < batch.num_rows:
            last.append((seen + opening, batch.slice(opening)))
        seen += batch.num_rows
        while last and last[0][0] + len(last[0][1]) <= seen - window:
            last.pop(0)
    for rank, part in last:
        cut = max(0, seen - window - rank)
        yield edge(rank + cut, part.slice(cut))
    if seen:
        values = [None, None, place, seen, None, None, None, None]
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def _link_batch(found: list[tuple[int, int]], schema: pa.Schema) -> pa.RecordBatch:
    links = [pa.array(side, pa.int64()) for side in zip(*found)]
    return pa.RecordBatch.from_arrays([*links, *(pa.nulls(len(found), f.type) for f in list(schema)[2:])], schema=schema)


def _border_task(batches: Iterator[pa.RecordBatch], window: int, least: float) -> Iterator[pa.RecordBatch]:
    """Verified links across each border between ranges, from the rows within ``window`` of it, sorted by border and position."""
    held: pa.Table | None = None
    joined = _Joined()

    def met(rows: pa.Table) -> list[tuple[int, int]]:
        border = rows.column("border")[0].as_py()
        found: list[tuple[int, int]] = []
        passes, dims, at, ids = (rows.column(c).to_numpy() for c in ("pass", "dims", "at", "class_id"))
        cuts = np.flatnonzero((passes[1:] != passes[:-1]) | (dims[1:] != dims[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rows)]):
            unit = _matrix(rows.column("vector").slice(a, b - a).combine_chunks())
            here, mine = at[a:b], ids[a:b]
            later = here[:, None] - here[None, :]
            across = (here[:, None] >= border) & (here[None, :] < border)
            i, j = np.nonzero((unit @ unit.T >= least) & across & (later <= window))
            found += [x for x in zip(mine[i].tolist(), mine[j].tolist()) if joined.add(*x)]
        return found

    def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = now if held is None else pa.concat_tables([held, now]).combine_chunks()
        border = now.column("border").to_numpy()
        cuts = [0, *(np.flatnonzero(border[1:] != border[:-1]) + 1).tolist()]
        if len(cuts) > 1:
            yield batch_of([x for a, b in zip(cuts, cuts[1:]) for x in met(now.slice(a, b - a))])
        held = now.slice(cuts[-1])
    if held is not None:
        yield batch_of(met(held))


def _borders(sizes: dict[int, int], window: int) -> dict[str, list]:
    """For each range the position of its first row, once for every border within ``window`` of a row of it."""
    places = sorted(sizes)
    starts = [0, *np.cumsum([sizes[p] for p in places]).tolist()]
    inner = np.array(starts[1:-1], np.int64)
    near: dict[str, list] = {"place": [], "start": [], "border": []}
    for place, start, end in zip(places, starts, starts[1:]):
        for border in inner[np.searchsorted(inner, start - window) : np.searchsorted(inner, end + window, "right")].tolist():
            near["place"].append(place)
            near["start"].append(start)
            near["border"].append(border)
    return near


def _round_links(source: DataFrame, passes: int, turn: int, window: int, least: float) -> DataFrame:
    """``(a, b)``: verified links that the fresh passes of one round find, alike for any number of ranges."""
    item = source.limit(0).toArrow().schema.field("vector")
    kind = source.schema["vector"].dataType.simpleString()
    kinds = [("pass", pa.int32()), ("dims", pa.int32()), ("code", pa.int64()), ("tie", pa.int64()), ("class_id", pa.int64())]
    coded = source.mapInArrow(
        functools.partial(_code_task, passes=passes, turn=turn, schema=pa.schema([*[pa.field(*k) for k in kinds], item])),
        f"pass int, dims int, code long, tie long, class_id long, vector {kind}",
    )
    order = ("pass", "dims", "code", "tie", "class_id")
    kinds = [("a", pa.int64()), ("b", pa.int64()), ("place", pa.int32()), ("rank", pa.int64()), *kinds[:2], kinds[4]]
    made = settle(
        coded.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(
            functools.partial(_window_task, window=window, least=least, schema=pa.schema([*[pa.field(*k) for k in kinds], item])),
            f"a long, b long, place int, rank long, pass int, dims int, class_id long, vector {kind}",
        ),
        "windows",
    )
    links = made.where("a IS NOT NULL").select("a", "b")
    sizes = {r["place"]: r["rank"] for r in made.where("place IS NOT NULL AND class_id IS NULL").select("place", "rank").collect()}
    if len(sizes) < 2:
        return links
    near = F.broadcast(local_table(source.sparkSession, _borders(sizes, window)))
    at = F.col("start") + F.col("rank")
    edges = made.where("class_id IS NOT NULL").join(near, "place").select("border", at.alias("at"), "pass", "dims", "class_id", "vector")
    edges = edges.where((F.col("at") >= F.col("border") - window) & (F.col("at") < F.col("border") + window))
    across = edges.repartition("border").sortWithinPartitions("border", "at").mapInArrow(
        functools.partial(_border_task, window=window, least=least), "a long, b long"
    )
    return links.unionByName(across)


def _linked_classes(source: DataFrame, passes: int, window: int, least: float) -> DataFrame:
    """``(node, component)`` of linked classes, as of ``connected_components``; rounds go on until one joins no components."""
    found = settle(connected_components(_round_links(source, passes, 0, window, least)), "components")
    turn = 1
    while True:
        links = _round_links(source, passes, turn, window, least)
        a, b = (found.select(F.col("node").alias(x), F.col("component").alias(f"{x}_root")) for x in "ab")
        roots = [F.coalesce(f"{x}_root", x).alias(x) for x in "ab"]
        new = settle(links.join(a, "a", "left").join(b, "b", "left").select(*roots).where("a <> b").distinct(), "joins")
        if new.isEmpty():
            return found
        every = found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(new)
        found, turn = settle(connected_components(every), "components"), turn + 1


_GROUP = ("component", "bucket_left", "bucket_right")


def _degree_task(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows of linked classes for each class of a component, from the pairs that meet in this task."""
    held: pa.Table | None = None

    def counted(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids, n, left = (part.column(c).to_numpy() for c in ("class_id", "copies", "in_left"))
        rows = _matrix(part.column("vector").combine_chunks())
        near = rows @ rows.T >= least
        np.fill_diagonal(near, False)
        if part.column("bucket_left")[0] != part.column("bucket_right")[0]:
            near &= left[:, None] != left[None, :]
        return ids, near @ n

    def batch_of(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids, n = (np.concatenate(x).astype(np.int64) for x in zip(*found))
        return pa.RecordBatch.from_pydict({"class_id": pa.array(ids), "near": pa.array(n)})

    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = now if held is None else pa.concat_tables([held, now]).combine_chunks()
        new = np.zeros(now.num_rows, bool)
        for c in _GROUP:
            values = now.column(c).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        cuts = [0, *np.flatnonzero(new).tolist()]
        if len(cuts) > 1:
            yield batch_of([counted(now.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])])
        held = now.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield batch_of([counted(held)])


def _degrees(members: DataFrame, least: float) -> DataFrame:
    """``(class_id, near)``: rows directly linked to each class, exactly, among the classes of its component."""
    sizes = settle(members.groupBy("component").agg(F.count(F.lit(1)).alias("classes")), "sizes")
    dealt = in_part_pairs(members.join(sizes, "component"), "classes", "class_id")
    sorted_rows = dealt.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "class_id")
    found = sorted_rows.select(*_GROUP, "in_left", "class_id", "copies", "vector").mapInArrow(
        functools.partial(_degree_task, least=least), "class_id long, near long"
    )
    return found.groupBy("class_id").agg(F.sum("near").alias("near"))


def near_duplicate_vectors(
    vectors: DataFrame,
    least: float = 0.9,
    passes: int = PASSES,
    window: int = WINDOW,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``key, n_links, component_id, kept`` of every row; links are pairs whose cosine in double precision is ``least`` or more.

    Equal vectors form one class and are compared once. In each pass the classes are sorted by the joined signs of seeded random
    projections and compared with the ``window`` rows behind them, also across the borders of the sorted ranges, so that the
    number of ranges does not matter; verified links of all passes are united. A round has ``passes`` passes, or as many as
    ``passes_for`` asks for by the number of classes; rounds with fresh projections follow until one joins no two components,
    so a crowded cone gets as many as it needs. The links of a class are then counted exactly among all classes of its
    component, in bounded blocks, so a dense group of any size has its full counts. A link can be missed only if its two
    vectors are neither close in any pass of any round nor joined through others.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and vectors of different
    length link with each other in no case. Rows with a null key count as links but never name a component; they are not kept.
    Repeated keys are rows of their own. An empty table gives no rows; other columns are ignored.
    """
    ship_package(vectors.sparkSession)
    rows = vectors.select(F.col(key).alias("vec"), F.when(usable(F.col(vector)), F.col(vector)).alias("vector"))
    classes = settle(
        rows.where("vector IS NOT NULL")
        .groupBy("vector")
        .agg(F.min("vec").alias("lowest"), F.count(F.lit(1)).alias("copies"))
        .select(F.monotonically_increasing_id().alias("class_id"), "lowest", "copies", "vector"),
        "classes",
    )
    source = classes.select("class_id", "vector", F.size("vector").alias("dims"), F.xxhash64("vector").alias("tie"))
    turns = max(passes, passes_for(classes.count(), least, window))
    found = _linked_classes(source, turns, window, least)
    rooted = found.select(F.col("node").alias("class_id"), "component").unionByName(
        found.select(F.col("component").alias("class_id"), "component").distinct()
    )
    members = settle(classes.join(rooted, "class_id"), "members")
    lowest = settle(members.groupBy("component").agg(F.min("lowest").alias("component_id")), "lowest")
    near = settle(_degrees(members, least), "degrees")
    linked = members.select("class_id", "component").join(lowest, "component").join(near, "class_id", "left")
    described = settle(
        classes.join(linked.select("class_id", "component_id", "near"), "class_id", "left").select(
            "vector",
            F.coalesce("component_id", "lowest").alias("component_id"),
            (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
        ),
        "described",
    )
    component = F.when(F.col("vector").isNull(), F.col("vec")).otherwise(F.col("component_id"))
    return (
        rows.join(described, "vector", "left")
        .withColumn("component_id", component)
        .select(
            F.col("vec").alias(key),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            "component_id",
            F.coalesce(F.col("vec") == F.col("component_id"), F.lit(False)).alias("kept"),
        )
    )
