"""Repair of conversation structure: the cheapest edits, found by an auction for shortest paths.

The rows of a conversation, in order, are read as a word: one letter a row for the initial of its role and its fault. Edits
lead through a lattice of places between rows and states of the pattern ``(s?(ua)+)?``. The auction keeps a price for every
node and one path from the origin: where the path's end is priced below its cheapest arc, the price is raised and the
path contracted, else it is extended along that arc. Prices never exceed the least cost to the goal, so that at the end
the arcs of all cheapest paths are tight, and the least of these paths is traced along them.

Long conversations are cut into chunks. A chunk's costs between its border states are a small matrix; products of matrices
after a chunk give the prices at its end, and what its traces do to the state is passed on from chunk to chunk.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.matching import small_side
from quayside.operators.ordering import PART, in_order, join_same, number_ordered
from quayside.session import settle, ship_package

#: Costs of the edits; a truncated row that stays costs one more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: The pattern's states: nothing yet, after s, after u, after a; what each may be followed by; where it may end.
STATES = range(4)
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, None, None, 0)
#: What may be inserted in, or a row be rerolled to from, a state.
FRESH = ("u", "u", "a", "u")
ROLES = {"u": "user", "a": "assistant"}
#: Letters of a word: the initial s, u, a or ? as lower case, truncated as upper case or !, and x for what must go.
MUST_GO, OTHER, OTHER_TRUNCATED = "x", "?", "!"
#: Rows of a chunk, and chunks or groups of chunks that one task scans together.
CHUNK, SCAN = 64, 256
#: Words whose traces a worker remembers.
KNOWN = 50_000
_LEGAL = ("su", "ua", "au")


class Lattice:
    """Places 0 to n of a word times the states; arcs are edits, and one goal lies behind the last place.

    ``exits[q]`` is the cost from state q behind the last row to the goal, or None. Behind the last row there are insertions only if
    the word is ``closing`` its conversation; else they belong to the word that follows.
    """

    def __init__(self, word: str, exits: Sequence[int | None], closing: bool = True):
        self.size = len(word)
        self.goal = 4 * (self.size + 1)
        self.word, self.exits, self.closing = word, exits, closing
        #: Least prices to start with: what the rows left cost at least. They satisfy price <= arc + price at its end.
        self.prices = [0] * (self.goal + 1)
        bound = min((x for x in exits if x is not None), default=0)
        floor = bound
        for place in range(self.size, -1, -1):
            if place < self.size:
                floor += self._least(word[place])
            self.prices[4 * place : 4 * place + 4] = [floor] * 4
        #: Arcs between nodes from which the goal can be reached.
        self._arcs: dict[int, list[tuple[str, int, int]]] = {self.goal: []}
        for place in range(self.size, -1, -1):
            for _ in STATES:  # insertions stay at their place
                for state in STATES:
                    ways = [arc for arc in self._arcs_from(place, state) if arc[2] in self._arcs]
                    if ways:
                        self._arcs[4 * place + state] = ways

    @staticmethod
    def _least(letter: str) -> int:
        if letter == MUST_GO:
            return DELETE
        stays = REROLE if letter in (OTHER, OTHER_TRUNCATED) else KEEP
        return min(DELETE, stays + (TRUNCATED if letter.isupper() or letter == OTHER_TRUNCATED else 0))

    def _arcs_from(self, place: int, state: int) -> Iterator[tuple[str, int, int]]:
        """``(edit, cost, node)``, edits in ASCII order; what is inserted or rerolled to is ``FRESH`` of the state."""
        here, fresh = 4 * place, NEXT[state][FRESH[state]]
        if place < self.size:
            yield "D", DELETE, here + 4 + state
        if place < self.size or self.closing:
            yield "I", INSERT, here + fresh
        if place == self.size:
            if self.exits[state] is not None:
                yield "", self.exits[state], self.goal
            return
        letter = self.word[place]
        if letter != MUST_GO:
            more = TRUNCATED if letter.isupper() or letter == OTHER_TRUNCATED else 0
            kept = NEXT[state].get(letter.lower())
            if kept is not None:
                yield "K", KEEP + more, here + 4 + kept
            yield "R", REROLE + more, here + 4 + fresh

    def auction(self, origin: int) -> int | None:
        """The least cost from ``origin`` to the goal, which is then its price; None without a path."""
        if origin not in self._arcs:
            return None
        prices, path = self.prices, [origin]
        while path[-1] != self.goal:
            end = path[-1]
            best, then = min((cost + prices[node], node) for _, cost, node in self._arcs[end])
            if prices[end] < best:
                prices[end] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(then)
        return prices[origin]

    def trace(self, origin: int) -> tuple[str, str, int]:
        """The ASCII-least cheapest path after the auction from ``origin``: its edits, the fresh role or ``-`` of each, the state behind.

        Tight arcs alone may lead astray, so a node without a tight way on is left again and not entered twice.
        """
        prices, dead = self.prices, set()
        path = [(origin, "")]
        while path[-1][0] != self.goal:
            here = path[-1][0]
            for edit, cost, node in self._arcs[here]:
                if prices[here] == cost + prices[node] and node not in dead:
                    path.append((node, edit))
                    break
            else:
                dead.add(here)
                path.pop()
        fresh = [FRESH[here % 4] if edit in ("I", "R") else "-" for (here, _), (_, edit) in zip(path[:-2], path[1:-1], strict=True)]
        return "".join(edit for _, edit in path), "".join(fresh), path[-2][0] % 4


@functools.lru_cache(maxsize=KNOWN)
def costs(word: str, closing: bool = True) -> tuple[tuple[int | None, ...], ...]:
    """Least costs from each state before the word to each state behind it; one goal serves all origins."""
    columns = []
    for target in STATES:
        lattice = Lattice(word, [0 if q == target else None for q in STATES], closing)
        columns.append([lattice.auction(q) for q in STATES])
    return tuple(zip(*columns, strict=True))


@functools.lru_cache(maxsize=KNOWN)
def traces(
    word: str, exits: tuple[int | None, ...], origins: tuple[int, ...] = (0,), closing: bool = True
) -> tuple[tuple[int, str, str, int] | None, ...]:
    """``(cost, edits, fresh roles, state behind)`` of the cheapest way from each origin, or None."""
    lattice = Lattice(word, exits, closing)
    found = []
    for q in origins:
        cost = lattice.auction(q)
        found.append(None if cost is None else (cost, *lattice.trace(q)))
    return tuple(found)


def _then(a: int | None, b: int | None) -> int | None:
    return None if a is None or b is None else a + b


def _product(left: Sequence, right: Sequence) -> list[list[int | None]]:
    """Min-plus product: costs of what comes first, then what follows."""
    return [[min((c for c in (_then(left[p][m], right[m][q]) for m in STATES) if c is not None), default=None) for q in STATES] for p in STATES]


def scanned(rows: DataFrame, keys: Sequence[str], place: str, value: str, combine: Callable, label: str) -> DataFrame:
    """``keys, place, before``: for each row the values of all earlier places of its key, combined; null for the first.

    ``value`` is an array; ``combine(earlier, later)`` is associative. Up to ``SCAN`` rows are scanned in one group; the totals of the
    groups are scanned in the same way first, so that a long key is never in one task.
    """
    kind = rows.schema[value].dataType.simpleString()
    grouped = rows.select(*keys, F.col(place).alias("spot"), value).withColumn("scan_group", F.floor(F.col("spot") / SCAN).cast("long"))
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in grouped.select(*keys).schema]
    last = grouped.agg(F.max("scan_group")).first()[0] or 0

    def total(part: pd.DataFrame) -> pd.DataFrame:
        values = [list(v) for v in part.sort_values("spot")[value]]
        return part[[*keys, "scan_group"]].head(1).assign(**{value: [functools.reduce(combine, values)]})

    if last:
        totals = grouped.groupBy(*keys, "scan_group").applyInPandas(total, ", ".join([*names, "scan_group long", f"{value} {kind}"]))
        above = scanned(settle(totals, label), keys, "scan_group", value, combine, label)
        grouped = join_same(grouped, above.withColumnRenamed("before", "scan_start"), [*keys, "scan_group"])
    else:
        grouped = grouped.withColumn("scan_start", F.lit(None).cast(kind))

    def within(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("spot")
        state, before = part["scan_start"].iloc[0], []
        state = None if state is None else list(state)
        for found in part[value]:
            before.append(state)
            state = list(found) if state is None else combine(state, list(found))
        return part[[*keys, "spot"]].assign(before=before)

    done = grouped.groupBy(*keys, "scan_group").applyInPandas(within, ", ".join([*names, "spot long", f"before {kind}"]))
    return settle(done.withColumnRenamed("spot", place), label)


#: An array cannot hold None for pandas without turning to floats, so a missing cost is this.
_NEVER = 1 << 60


def _flat(matrix: Sequence[Sequence[int | None]]) -> list[int]:
    return [_NEVER if c is None else c for row in matrix for c in row]


def _square(flat: Sequence[int]) -> list[list[int | None]]:
    return [[None if c >= _NEVER else int(c) for c in flat[4 * p : 4 * p + 4]] for p in STATES]


def _later_first(earlier: list, later: list) -> list[int]:
    """For scans from the end: what was met earlier in the scan comes later in the conversation."""
    return _flat(_product(_square(later), _square(earlier)))


def _states_on(earlier: list, later: list) -> list[int]:
    return [int(later[q]) if q >= 0 else -1 for q in earlier]


def _costs_of(words: pd.Series, closing: pd.Series) -> pd.Series:
    return pd.Series([_flat(costs(w, bool(c))) for w, c in zip(words, closing, strict=True)])


_TRACE = "cost:bigint,edits:string,fresh:string,state:bigint"


def _exits(behind: Sequence[int] | None) -> list[int | None]:
    """Least cost from each state at the end of a chunk through all chunks behind it."""
    if behind is None:
        return list(ENDS)
    return [min((c for c in map(_then, row, ENDS) if c is not None), default=None) for row in _square(behind)]


def _traces_of(words: pd.Series, behind: pd.Series, closing: pd.Series) -> pd.Series:
    def one(word: str, exits: list[int | None], closing: bool) -> list[dict | None]:
        base = min(c for c in exits if c is not None)  # what all exits cost alike is left out, so that words repeat
        found = traces(word, tuple(None if c is None else c - base for c in exits), tuple(STATES), closing)
        return [None if f is None else {"cost": f[0] + base, "edits": f[1], "fresh": f[2], "state": f[3]} for f in found]

    return pd.Series([one(w, _exits(b), bool(c)) for w, b, c in zip(words, behind, closing, strict=True)])


def _whole_trace(words: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([traces(w, ENDS)[0] for w in words], columns=["cost", "edits", "fresh", "state"])


def solve(chunks: DataFrame) -> DataFrame:
    """``conv, chunk, cost, edits, fresh`` of chunks ``conv, chunk, chunks, word``; the first chunk has the cost of the conversation.

    A conversation of one chunk needs one auction. The chunks of a longer one get the prices at their ends from a scan of cost matrices
    from the last chunk on, and the state before them from a scan of what the traces do to states.
    """
    ship_package(chunks.sparkSession)
    names = ("cost", "edits", "fresh")
    short = chunks.where("chunks = 1").withColumn("t", F.pandas_udf(_whole_trace, f"struct<{_TRACE}>")("word"))
    short = short.select("conv", "chunk", *[F.col(f"t.{n}").alias(n) for n in names])
    long = chunks.where("chunks > 1")
    if long.isEmpty():
        return short
    long = long.withColumn("from_end", F.col("chunks") - 1 - F.col("chunk")).withColumn("closing", F.col("from_end") == 0)
    long = settle(long.withColumn("matrix", F.pandas_udf(_costs_of, "array<bigint>")("word", "closing")), "matrices")
    after = scanned(long, ["conv"], "from_end", "matrix", _later_first, "after")
    priced = join_same(long, after, ["conv", "from_end"])
    traced = settle(priced.select("conv", "chunk", F.pandas_udf(_traces_of, f"array<struct<{_TRACE}>>")("word", "before", "closing").alias("t")), "traces")
    moves = traced.withColumn("moves", F.transform("t", lambda t: F.coalesce(t["state"], F.lit(-1))))
    met = scanned(moves, ["conv"], "chunk", "moves", _states_on, "states")
    # A conversation begins in state 0.
    state = F.coalesce(F.element_at("before", 1), F.lit(0)).cast("int")
    chosen = join_same(traced, met, ["conv", "chunk"]).withColumn("t", F.element_at("t", state + 1))
    total = F.when(F.col("chunk") == 0, F.col("t.cost")).otherwise(F.lit(0).cast("long")).alias("cost")
    return short.unionByName(chosen.select("conv", "chunk", total, F.col("t.edits").alias("edits"), F.col("t.fresh").alias("fresh")))


def initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def in_turn(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows stored in order, with what is worked out from a text: its hash, whether it is blank, whether its end is cut off."""
    named = rows.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").cast("string").alias("role"), F.col(f"`{text}`").cast("string").alias("text")
    )
    # The white space behind is cut off without a pattern, which would try each run of white space in a long text.
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    flagged = named.withColumns({"hash": F.sha2("text", 256), "blank": last == "", "cut": ~last.isin(".", "!", "?")})
    return in_order(flagged, ["conv", "turn", "role", "hash"], "turns")


def find_faults(ordered: DataFrame) -> DataFrame:
    """``conv, turn, role, rn, at, rows, fault`` of rows from :func:`in_turn`, stored.

    ``at`` counts from 0 in the conversation of ``rows`` rows. ``fault`` is ``blank``, ``duplicate`` (an earlier row of the conversation
    has the role and text), ``truncated`` or null. What spans rows is worked out over narrow columns with the part of the order in
    the key, so that no hot conversation or text meets in one task; texts stay where they are.
    """
    numbered = number_ordered(ordered.drop("text"), "rn").drop("_position")

    def starts(keys: list[str]) -> DataFrame:
        runs = numbered.groupBy(*keys, PART).agg(F.min("rn").alias("run"), F.count(F.lit(1)).alias("held"))
        whole = runs.groupBy(*keys).agg(F.min("run").alias("first"), F.sum("held").alias("rows"))
        return join_same(runs.select(*keys, PART), whole, keys)

    keys = ["conv", "role", "hash", PART]
    repeats = settle(starts(keys[:3]).where("rows > 1").withColumnsRenamed({k: f"o_{k}" for k in keys}).withColumnRenamed("first", "same"), "repeats")
    placed = join_same(numbered, small_side(settle(starts(["conv"]), "runs")), ["conv", PART])
    marked = placed.join(small_side(repeats.drop("rows")), [F.col(k).eqNullSafe(F.col(f"o_{k}")) for k in keys], "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("rn") > F.col("same"), "duplicate").when(F.col("cut"), "truncated")
    return settle(marked.select("conv", "turn", "role", "rn", (F.col("rn") - F.col("first")).alias("at"), "rows", fault.alias("fault")), "faults")


def _letter() -> Column:
    start = initial(F.col("role"))
    known = start.isin("s", "u", "a")
    stays = F.when(known, start).otherwise(OTHER)
    cut = F.when(known, F.upper(start)).otherwise(OTHER_TRUNCATED)
    return F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).when(F.col("fault") == "truncated", cut).otherwise(stays)


def chunked(faults: DataFrame) -> DataFrame:
    """``conv, chunk, chunks, word, illegal``: letters of up to ``CHUNK`` rows, and neighbours that no conversation has in its right order."""
    chunk = F.floor(F.col("at") / CHUNK).cast("long")
    own = faults.select("conv", chunk.alias("chunk"), "at", "rows", _letter().alias("letter"), initial(F.col("role")).alias("start"))
    # The last row of a chunk also stands before the next one, for its neighbour there.
    border = own.where((F.col("at") % CHUNK == CHUNK - 1) & (F.col("at") + 1 < F.col("rows")))
    both = own.unionByName(border.withColumn("chunk", F.col("chunk") + 1).withColumn("letter", F.lit("")))
    gathered = both.groupBy("conv", "chunk", "rows").agg(F.array_sort(F.collect_list(F.struct("at", "letter", "start"))).alias("r"))
    pairs = F.transform(F.slice("r", 2, CHUNK + 1), lambda r, i: F.concat(F.element_at("r", i + 1)["start"], r["start"]))
    return gathered.select(
        "conv",
        "chunk",
        F.ceil(F.col("rows") / CHUNK).cast("long").alias("chunks"),
        F.array_join(F.transform("r", lambda r: r["letter"]), "").alias("word"),
        F.size(F.filter(pairs, lambda p: ~p.isin(*_LEGAL))).cast("long").alias("illegal"),
    )


class Repaired(NamedTuple):
    """``rows``: ``conv, chunk, step, edit, role, text`` of what is left, in order of chunk and step; ``summary``: one row per conversation."""

    rows: DataFrame
    summary: DataFrame


def repair_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """Conversations brought to ``(s?(ua)+)?`` by the cheapest edits, the ASCII-least of them on ties.

    Rows are taken by turn, null first; rows of one turn by role and the text's hash. A null role or text counts as one space. A role
    that does not begin with s, u or a is never kept as it is. Rows of a null conversation are one conversation, repeated rows are
    duplicates, an empty table gives none, and other columns are ignored whatever they are called. ``summary`` has
    ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``; only its audit is as long as the conversation.
    """
    filled = rows.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role, text)})
    ordered = in_turn(filled, conv, turn, role, text)
    faults = find_faults(ordered)
    chunks = settle(chunked(faults), "chunks")
    solved = settle(solve(chunks), "solved")

    turns = faults.groupBy("conv", "turn").agg(*[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")])
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    counted = turns.groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
    pairs = chunks.groupBy("conv").agg(F.sum("illegal").alias("illegal"))
    in_words = F.transform(F.array_sort(F.collect_list(F.struct("chunk", "edits"))), lambda c: c["edits"])
    audits = solved.groupBy("conv").agg(F.sum("cost").alias("cost"), F.array_join(in_words, "").alias("audit"))
    summary = join_same(join_same(counted, pairs, ["conv"]), audits, ["conv"])

    steps = solved.select("conv", "chunk", "edits", "fresh", F.posexplode(F.split("edits", "")).alias("step", "edit")).where("edit <> 'D'")
    consumed = F.length(F.replace(F.substr("edits", F.lit(1), F.col("step")), F.lit("I"), F.lit("")))
    fresh = F.substr("fresh", F.col("step") + 1, F.lit(1))
    steps = steps.select(
        "conv",
        "chunk",
        "step",
        "edit",
        F.when(fresh == "u", ROLES["u"]).when(fresh == "a", ROLES["a"]).alias("new_role"),
        (F.col("chunk") * CHUNK + consumed).alias("at"),
    )
    stay = join_same(steps.where("edit <> 'I'"), faults.select("conv", "at", "rn"), ["conv", "at"])
    texts = number_ordered(ordered, "rn").select("rn", "role", "text")
    left = stay.join(texts, "rn").select("conv", "chunk", "step", "edit", F.coalesce("new_role", "role").alias("role"), "text")
    added = steps.where("edit = 'I'").select("conv", "chunk", "step", "edit", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return Repaired(left.unionByName(added), summary)


def _hash_runs(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One digest per run of rows with the same key; texts pass through and are not held."""
    nothing = object()
    current, state, done = nothing, None, []

    def emit() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema, strict=True)], schema=schema)

    for batch in batches:
        for key, line in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if key != current or state is None:
                if state is not None:
                    done.append((current, state.hexdigest()))
                current, state = key, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(line.as_buffer() if line.is_valid else b"")
        if len(done) >= 10_000:
            yield emit()
            done.clear()
    if state is not None:
        done.append((current, state.hexdigest()))
    if done:
        yield emit()


def conversation_digests(rows: DataFrame) -> DataFrame:
    """``conv, digest``: SHA-256 of the ``role:text`` lines of each conversation in order.

    A digest takes its text from the start to the end, so each conversation is one task's, which lets its lines pass and
    holds none; the sort before it spills.
    """
    ship_package(rows.sparkSession)
    lines = rows.select("conv", F.encode(F.concat("role", F.lit(":"), "text"), "UTF-8").alias("line"), "chunk", "step")
    sorted_lines = lines.repartition("conv").sortWithinPartitions("conv", "chunk", "step").select("conv", "line")
    schema = pa.schema([rows.select("conv").limit(0).toArrow().schema.field(0), pa.field("digest", pa.string())])
    return sorted_lines.mapInArrow(functools.partial(_hash_runs, schema=schema), f"conv {rows.schema['conv'].dataType.simpleString()}, digest string")
