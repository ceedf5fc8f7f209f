"""Joins between landed paths, rules and records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import paths as P
from quayside.functions.timepat import bind
from quayside.operators.ordering import MOST_PARTS, join_same, with_next
from quayside.session import settle

BROADCAST_BYTES = 8 * 1024 * 1024
BROADCAST_ROWS = 100_000

#: Rows of either side that meet in one cell of a join with repeated keys, and rows of its result that a task is meant to give.
CELL_ROWS, TASK_ROWS = 2048, 2 * 1024**2


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a lookup side may be broadcast: its rows are counted and their sizes added up.

    Only the sizes reach the driver, and no more than ``max_rows + 1`` of them: Spark
    stops reading a larger side once it has found that many.
    """
    sizes = df.select(F.octet_length(F.to_json(F.struct("*"))).alias("n")).take(max_rows + 1)
    return len(sizes) <= max_rows and sum(row["n"] for row in sizes) <= max_bytes


def small_side(df: DataFrame) -> DataFrame:
    """Mark a lookup side for broadcast once it is measured to be small.

    A larger side stays unmarked; the join is then a sort-merge join whose hot keys
    adaptive execution splits.
    """
    return F.broadcast(df) if is_small(df) else df


def _segments(directory: Column) -> Column:
    return F.length(directory) - F.length(F.replace(directory, F.lit("/"), F.lit("")))


def directory_runs(directory: Column, depths: Column) -> Column:
    """Every run of n consecutive segments, for each n of ``depths``: ``/a/b`` with 1 and 2 gives /a, /b, /a/b."""

    def all_runs(folder: Column) -> Column:
        def runs(depth: Column) -> Column:
            def run(start: Column) -> Column:
                upto = F.call_function("substring_index", folder["text"], F.lit("/"), start + depth)
                return F.concat(F.lit("/"), F.call_function("substring_index", upto, F.lit("/"), -depth))

            starts = F.sequence(F.lit(1), folder["n"] - depth + 1)
            return F.when(folder["n"] >= depth, F.transform(starts, run)).otherwise(F.array().cast("array<string>"))

        return F.array_distinct(F.flatten(F.transform(depths, runs)))

    return bind(F.struct(directory.alias("text"), _segments(directory).alias("n")), all_runs)


def _occurring(df: DataFrame, number: Column) -> Column:
    """The different values of a small number as a constant array.

    It holds segment counts or name lengths: no more entries than a path has characters.
    """
    found = df.agg(F.array_sort(F.collect_set(number))).first()[0]
    return F.array(*[F.lit(n) for n in found]).cast("array<int>")


def join_contained(paths: DataFrame, path: str, rules: DataFrame, directory: str) -> DataFrame:
    """Paths with every rule whose directory, followed by ``/``, occurs in the path.

    A rule directory without a leading ``/`` gets one, and a trailing ``/`` is ignored, so a hit covers
    whole segments, and the path's segment runs are matched by equality; no rule list is searched row by row.
    Blank and null directories match nothing. Few
    rules are broadcast, so paths are not moved. With many rules the distinct
    directories are matched first, and files get the hits of their directory.
    """
    whole = F.concat(F.lit("/"), F.regexp_replace(F.trim(F.col(directory)), "^/+|/+$", ""))
    rooted = rules.withColumn("_dir", whole).where("length(_dir) > 1")
    depths = _occurring(rooted, _segments(F.col("_dir")))
    located = paths.withColumn("_folder", P.parent(F.col(path)))
    if is_small(rooted):
        keyed = located.withColumn("_dir", F.explode(directory_runs(F.col("_folder"), depths)))
        return keyed.join(F.broadcast(rooted), "_dir").drop("_dir", "_folder")
    folders = located.select("_folder").distinct()
    hits = folders.withColumn("_dir", F.explode(directory_runs(F.col("_folder"), depths))).join(rooted, "_dir")
    return located.join(hits, "_folder").drop("_dir", "_folder")


def join_in_cells(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that many rows of both sides share, in tasks that give about as many rows each.

    The result has the product of both sides' rows for each key, so tasks cut by keys or by bytes read would differ and grow.
    The rows of a key are dealt into slices on both sides, and each slice of one side meets each of the other in a cell of its own.
    Cells are spread over as many tasks as the result asks for; both sides of a task may spill. Null keys match nothing. The deal is stored with
    the rows, so a task that runs again sees the same cells.
    """

    def dealt(side: DataFrame, label: str) -> DataFrame:
        keyed = side.dropna(subset=list(keys))
        return settle(keyed.withColumn("_deal", F.xxhash64(F.monotonically_increasing_id())), label)

    def counted(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    def sliced(side: DataFrame, own: str, other: str) -> DataFrame:
        cut = side.join(small_side(sizes), list(keys)).withColumn(own, F.pmod("_deal", own))
        cut = cut.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1))).drop("_deal", "_rows")
        return cut.repartition(parts, *cell) if total > TASK_ROWS else cut

    lefts, rights = dealt(left, "lefts"), dealt(right, "rights")
    sizes = counted(lefts, "_left").join(counted(rights, "_right"), list(keys)).withColumn("_rows", F.col("_left") * F.col("_right").cast("decimal(19,0)"))
    slices = {name: F.ceil(F.col(name) / CELL_ROWS) for name in ("_left", "_right")}
    sizes = settle(sizes.withColumns(slices), "cells")
    total = int(sizes.agg(F.sum("_rows")).first()[0] or 0)
    least = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # with fewer, Spark would shuffle again
    parts = max(least, min(-(-total // TASK_ROWS), MOST_PARTS))
    cell = [*keys, "_left", "_right"]
    return sliced(lefts, "_left", "_right").join(sliced(rights, "_right", "_left").hint("merge"), cell).drop("_left", "_right")


def delivery_interfaces(landed: DataFrame, interfaces: DataFrame, db: str = "db", tb: str = "tb", active: str = "use_yn") -> DataFrame:
    """Landed tables with each active delivery interface of the same database and table."""
    return join_in_cells(landed, interfaces.where(F.col(active) == "Y").drop(active), [db, tb])


def first_with_prefix(bases: DataFrame, base: str, paths: DataFrame, path: str) -> DataFrame:
    """Each base with the smallest path that starts with it; bases without one are left out.

    In sorted order that path is the next one at or after the base, so no base is
    compared with more than one path.
    """
    marked = bases.select(F.col(base).alias("_key"), F.lit(0).alias("_kind"), F.col(base), F.lit(None).cast("string").alias(path))
    listed = paths.select(F.col(path).alias("_key"), F.lit(1).alias("_kind"), F.lit(None).cast("string").alias(base), F.col(path))
    both = marked.unionByName(listed).distinct()
    ahead = with_next(both, ["_key", "_kind"], F.col(path), "first_path")
    return ahead.where((F.col("_kind") == 0) & F.startswith("first_path", base)).select(base, "first_path")


def leaf_paths(paths: DataFrame, path: str) -> DataFrame:
    """Paths not followed, in sorted order, by one below them; ``_SUCCESS`` markers are left out.

    The order puts ``/`` before every other character, so that what lies below a path follows it directly.
    """
    listed = paths.select(path).distinct().withColumn("_order", F.translate(F.col(path), "/", "\u0001"))
    ahead = with_next(listed, ["_order"], F.col(path), "_next")
    below = F.coalesce(F.startswith("_next", F.concat(F.col(path), F.lit("/"))), F.lit(False))
    return ahead.where(~below & ~F.endswith(F.col(path), F.lit("/_SUCCESS"))).select(path)


def retry_lookup(files: DataFrame, retries: DataFrame, seq: str, name: str, retry_name: str) -> DataFrame:
    """Files with the retry records of their source: a blank name takes all files, else equal names.

    Two equality joins instead of one with an OR, which could not be hashed.
    """
    mark = F.broadcast if is_small(retries) else (lambda side: side)
    blank = F.coalesce(F.trim(retry_name), F.lit("")) == ""
    for_all = files.join(mark(retries.where(blank)), seq)
    by_name = files.join(mark(retries.where(~blank).withColumn(name, F.col(retry_name))), [seq, name])
    return for_all.unionByName(by_name.select(for_all.columns))


def missing_partitions(source: DataFrame, target: DataFrame, day: str = "dt") -> DataFrame:
    """Previous days of the source partitions that the target does not have yet."""
    before = F.date_format(F.date_sub(F.to_date(F.col(day), "yyyyMMdd"), 1), "yyyyMMdd")
    wanted = source.select(*[c for c in source.columns if c != day], before.alias(day)).distinct()
    return wanted.join(target.select(*wanted.columns).distinct(), wanted.columns, "left_anti")


GRAM = 4


def archives_holding(members: DataFrame, wanted: DataFrame, archive: str, member: str, name: str) -> DataFrame:
    """Archives with a member whose path contains a wanted name.

    A path gives its substrings of ``GRAM`` characters, as many as it is long, and each wanted name waits at the one of its own
    that the fewest paths hold; where they meet, the name is looked for in the path. Names shorter than that wait at
    the path's substrings of their own length, at most ``GRAM - 1`` lengths. An empty name is in every path.
    """
    names = wanted.select(F.col(name).alias("_name")).where("_name IS NOT NULL").distinct()
    held = members.select(F.col(archive).alias(archive), F.col(member).alias("_path")).where("_path IS NOT NULL").distinct()
    few = is_small(names)
    grams = lambda text: F.array_distinct(_substrings(F.col(text), F.lit(GRAM)))
    long_names = names.where(F.length("_name") >= GRAM).select("_name", F.explode(grams("_name")).alias("_gram"))
    asked = long_names.select("_gram").distinct()
    spread = held.select(archive, "_path", F.explode(grams("_path")).alias("_gram"))
    if few:  # grams that no name has are dropped as they arise
        spread = spread.join(F.broadcast(asked), "_gram", "left_semi")
    counted = spread.groupBy("_gram").agg(F.count(F.lit(1)).alias("_paths"))
    # A gram that no path holds is the rarest: such a name is nowhere.
    rated = long_names.join(counted, "_gram", "left").withColumn("_paths", F.coalesce("_paths", F.lit(0)))
    rarest = rated.groupBy("_name").agg(F.min_by("_gram", F.struct("_paths", "_gram")).alias("_gram"))
    met = spread.join(small_side(rarest) if few else rarest, "_gram").where(F.contains("_path", "_name")).select(archive)
    short = names.where(F.length("_name") < GRAM)
    lengths = _occurring(short.where("length(_name) > 0"), F.length("_name"))
    keys = F.array_distinct(F.flatten(F.transform(lengths, lambda length: _substrings(F.col("_path"), length))))
    by_short = held.select(archive, F.explode(keys).alias("_name")).join(small_side(short), "_name", "left_semi").select(archive)
    everywhere = held.select(archive).join(names.where("_name = ''").limit(1).select(F.lit(1).alias("_one")), F.lit(True), "left_semi")
    return met.unionByName(by_short).unionByName(everywhere).distinct()


def _substrings(text: Column, length: Column) -> Column:
    last = F.length(text) - length + 1
    return F.when(
        last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, length))
    ).otherwise(F.array().cast("array<string>"))


def glob_regex(glob: Column) -> Column:
    """A file glob with ``*`` and ``?`` as a regular expression for the whole name."""
    quoted = F.replace(F.regexp_replace(glob, r"([\\.^$|()+{}])", r"\\$1"), F.lit("[!"), F.lit("[^"))
    return F.concat(
        F.lit("^(?s:"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit(")$")
    )


def match_files(
    listed: DataFrame, group: Sequence[str], name: str, pattern: str, file_pattern: str, use_regex: bool = False
) -> DataFrame:
    """Files of a listing chosen in two stages, per group (interface or directory).

    ``listed`` holds one row per file with its group's patterns. A file must match
    ``pattern`` from its start. When it is the group's only such file and is named exactly
    like the pattern, it is taken. Otherwise the name must fit the glob
    ``file_pattern`` or contain it, in any case; with ``use_regex`` it must match it
    from its start instead. The group's count is a partial
    aggregate joined back, so a large group is not gathered in one task.
    """
    staged = listed.where(F.regexp_like(F.col(name), F.concat(F.lit("^(?:"), F.col(pattern), F.lit(")"))))
    counts = staged.groupBy(*group).agg(F.count(F.lit(1)).alias("_hits"))
    literal = (F.col("_hits") == 1) & (F.col(name) == F.col(pattern))
    if use_regex:
        chosen = F.regexp_like(F.col(name), F.concat(F.lit("^(?:"), F.col(file_pattern), F.lit(")")))
    else:
        holds = F.lower(F.col(name)).contains(F.lower(F.col(file_pattern)))
        chosen = holds | F.regexp_like(F.col(name), glob_regex(F.col(file_pattern)))
    return join_same(staged, counts, group).where(literal | chosen).drop("_hits")


#: Lengths at which the fixed beginnings of patterns are compared; a longer beginning is cut to one of them.
PREFIX_LENGTHS = (0, 1, 2, 4, 8, 16, 32)


def fixed_prefix(pattern: Column) -> Column:
    """What every name that matches a regular expression from its start begins with; empty where that is not plain to see.

    Letters, digits, ``_``, ``-``, space and escaped marks count up to the first other character; one that a quantifier follows is
    left out, and alternatives outside a class have no common beginning.
    """
    plain = F.regexp_extract(pattern, r"^\^?((?:[A-Za-z0-9_ -]|\\[^A-Za-z0-9])*+)", 1)
    rest = F.substr(F.regexp_replace(pattern, r"^\^", ""), F.length(plain) + 1, F.lit(1))
    kept = F.when(rest.isin("?", "*", "+", "{"), F.regexp_replace(plain, r"(?:\\.|[^\\])$", "")).otherwise(plain)
    return F.when(F.contains(pattern, F.lit("|")) | F.contains(pattern, F.lit("(?")), "").otherwise(F.regexp_replace(kept, r"\\(.)", "$1"))


def match_patterns(files: DataFrame, name: str, patterns: DataFrame, pattern: str) -> DataFrame:
    """Each file with each pattern that its name matches from the start; both sides may be long, and are not joined beforehand.

    A pattern waits at its fixed beginning, cut to one of ``PREFIX_LENGTHS``; a name comes there with its own beginnings of the
    lengths that occur, by equality, and only then is matched. Patterns without a fixed beginning all wait at the empty one, where
    they meet every name; that side is broadcast if it is small. Null names and patterns match nothing.
    """
    fixed = patterns.where(F.col(pattern).isNotNull()).withColumn("_fixed", fixed_prefix(F.col(pattern)))
    length = F.lit(0)
    for size in PREFIX_LENGTHS:
        length = F.when(F.length("_fixed") >= size, size).otherwise(length)
    keyed = fixed.withColumn("_length", length.cast("int")).withColumn("_key", F.substr("_fixed", F.lit(1), F.col("_length"))).drop("_fixed")
    used = _occurring(keyed, F.col("_length"))
    ways = F.filter(used, lambda n: F.length(F.col(name)) >= n)
    beginnings = F.transform(ways, lambda n: F.struct(n.alias("_length"), F.substr(F.col(name), F.lit(1), n).alias("_key")))
    spread = files.where(F.col(name).isNotNull()).withColumn("_at", F.explode(beginnings))
    spread = spread.select(*files.columns, "_at._length", "_at._key")
    met = spread.join(small_side(keyed), ["_length", "_key"]).drop("_length", "_key")
    return met.where(F.regexp_like(F.col(name), F.concat(F.lit("^(?:"), F.col(pattern), F.lit(")"))))
