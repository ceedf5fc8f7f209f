"""Ordered operators against brute force, over many parts and hot keys."""

import datetime
import decimal
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.operators import matching, ordering, ranges


@pytest.fixture()
def many_parts(spark):
    """Keep small inputs in several parts, so that borders between parts occur."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def hot_rows(n=400, seed=1):
    """A third of all rows share one group."""
    rng = random.Random(seed)
    return [(i, "hot" if rng.random() < 0.34 else f"g{rng.randrange(20)}", rng.randrange(1, 50)) for i in range(n)]


@pytest.fixture()
def hot(many_parts):
    return many_parts.createDataFrame(hot_rows(), "id long, grp string, size long")


def test_parts_are_used(hot):
    parts = ordering.in_order(hot, ["grp", "id"]).select(ordering.PART).distinct().count()
    assert parts > 3


def test_row_numbers_and_pages(hot):
    rows = sorted(hot_rows(), key=lambda r: (r[1], r[0]))
    got = {r["id"]: (r["rn"], r["page"]) for r in ordering.page_rows(hot, ["grp", "id"], 100).collect()}
    assert got == {r[0]: (n, (n - 1) // 100) for n, r in enumerate(rows, start=1)}
    assert max(page for _, page in got.values()) == 3  # 400 rows fill four pages, without an empty fifth


@pytest.mark.parametrize("parts", [1, 3, 7, 400, 500])
def test_even_split_loses_nothing(hot, parts):
    sizes = {r["tile"]: r["n"] for r in ordering.split_evenly(hot, ["id"], parts).groupBy("tile").agg(F.count("*").alias("n")).collect()}
    base, extra = divmod(400, parts)
    assert sizes == {t: base + (t <= extra) for t in range(1, parts + 1) if base + (t <= extra)}


def test_running_sum_and_bins(hot):
    total, want = 0, {}
    for row_id, _, size in hot_rows():
        total += size
        want[row_id] = (total, (total - 1) // 100)
    got = ordering.assign_bins(hot, ["id"], "size", 100).collect()
    assert {r["id"]: (r["cum_size"], r["bin"]) for r in got} == want


def test_numbers_within_hot_groups(hot):
    seen, want = {}, {}
    for row_id, grp, _ in sorted(hot_rows(), key=lambda r: -r[0]):
        seen[grp] = seen.get(grp, 0) + 1
        want[row_id] = seen[grp]
    got = ordering.number_within(hot, ["grp"], [F.desc("id")]).collect()
    assert {r["id"]: r["seq"] for r in got} == want


def test_rows_without_a_group_are_kept(many_parts):
    frame = many_parts.range(100).select("id", F.when(F.col("id") % 3 > 0, F.lit("g")).alias("grp"))
    got = ordering.number_within(frame, ["grp"], ["id"])
    assert got.count() == 100 and got.where("grp is null").agg(F.max("seq")).first()[0] == 34


def test_next_value_over_part_borders(hot):
    rows = hot_rows()
    want = {}
    for i, (row_id, _, _) in enumerate(rows):
        want[row_id] = next((r[0] for r in rows[i + 1 :] if r[2] == 7), None)
    got = ordering.with_next(hot, ["id"], F.when(F.col("size") == 7, F.col("id"))).collect()
    assert {r["id"]: r["next_value"] for r in got} == want


def test_empty_input(many_parts):
    empty = many_parts.createDataFrame([], "id long, grp string, size long")
    assert ordering.page_rows(empty, ["id"], 10).count() == 0
    assert ordering.split_evenly(empty, ["id"], 3).count() == 0
    assert ordering.with_next(empty, ["id"], F.col("id")).count() == 0
    assert ordering.number_within(empty, ["grp"], ["id"]).count() == 0


def test_top_by_key(hot):
    got = [r["size"] for r in ordering.top_by_key(hot, "size", ["id"], 5, 1).collect()]
    assert got == [r[2] for r in hot_rows()[1:6]]


segments = st.lists(st.sampled_from(["a", "b", "ab", "a-b", "x.dat"]), min_size=1, max_size=4)
path_lists = st.lists(segments.map(lambda s: "/" + "/".join(s)), min_size=1, max_size=15, unique=True)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(path_lists)
def test_leaf_paths(many_parts, paths):
    want = {p for p in paths if not any(q.startswith(p + "/") for q in paths)}
    frame = many_parts.createDataFrame([(p,) for p in paths], "path string")
    assert {r[0] for r in matching.leaf_paths(frame, "path").collect()} == want


def test_leaf_paths_without_markers(spark):
    frame = spark.createDataFrame([("/a",), ("/a/b",), ("/a/b/c.dat",), ("/d/_SUCCESS",)], "path string")
    assert [r[0] for r in matching.leaf_paths(frame, "path").collect()] == ["/a/b/c.dat"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(path_lists, path_lists)
def test_first_path_with_prefix(many_parts, paths, bases):
    want = {b: min(p for p in paths if p.startswith(b)) for b in bases if any(p.startswith(b) for p in paths)}
    left = many_parts.createDataFrame([(b,) for b in bases], "base string")
    right = many_parts.createDataFrame([(p,) for p in paths], "path string")
    got = matching.first_with_prefix(left, "base", right, "path").collect()
    assert {r["base"]: r["first_path"] for r in got} == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(path_lists, path_lists, st.booleans())
def test_contained_directories(spark, paths, rules, many):
    want = sorted((p, r) for p in paths for r in rules if r + "/" in p)
    left = spark.createDataFrame([(p,) for p in paths], "path string")
    right = spark.createDataFrame([(r,) for r in rules], "rule string")
    small = matching.is_small
    if many:  # take the way for rule sets too large to broadcast
        matching.is_small = lambda df: False
    try:
        got = matching.join_contained(left, "path", right, "rule").collect()
    finally:
        matching.is_small = small
    assert sorted((r["path"], r["rule"]) for r in got) == want


def test_small_side_is_measured(spark):
    assert matching.is_small(spark.range(10))
    assert not matching.is_small(spark.range(10), max_rows=9)
    assert not matching.is_small(spark.range(10), max_bytes=20)


def test_match_files(spark):
    rows = [
        ("one", "f.dat", "f.dat", "zzz"), ("one", "g.dat", "f.dat", "zzz"),
        ("glob", "a_1.csv", "a_", "*_1.csv"), ("glob", "a_2.csv", "a_", "*_1.csv"), ("glob", "b_1.csv", "a_", "*_1.csv"),
        ("text", "x_KPI_1", "x_", "kpi"), ("text", "x_none", "x_", "kpi"),
        ("class", "a1", "a", "a[0-4]"), ("class", "a7", "a", "a[0-4]"), ("neg", "a1", "a", "a[!0-4]"), ("neg", "a7", "a", "a[!0-4]"),
        ("quoted", "a+b.csv", "a", "a+b.*"), ("quoted", "aab.csv", "a", "a+b.*"),
    ]
    frame = spark.createDataFrame(rows, "grp string, name string, pattern string, file_pattern string")
    got = {(r["grp"], r["name"]) for r in matching.match_files(frame, ["grp"], "name", "pattern", "file_pattern").collect()}
    assert got == {
        ("one", "f.dat"), ("glob", "a_1.csv"), ("text", "x_KPI_1"), ("class", "a1"), ("neg", "a7"), ("quoted", "a+b.csv"),
    }


def test_match_files_by_regex(spark):
    rows = [("g", "kpi_12.csv", "kpi", r"kpi_\d{2}\."), ("g", "kpi_123.csv", "kpi", r"kpi_\d{2}\.")]
    frame = spark.createDataFrame(rows, "grp string, name string, pattern string, file_pattern string")
    got = matching.match_files(frame, ["grp"], "name", "pattern", "file_pattern", use_regex=True).collect()
    assert [r["name"] for r in got] == ["kpi_12.csv"]


def test_archives_holding(spark):
    members = spark.createDataFrame(
        [("a.zip", "in/x_2024.csv"), ("a.zip", "in/other"), ("b.zip", "y.csv"), ("c.zip", "deep/x_2024.csv.bak")],
        "archive string, member string",
    )
    wanted = spark.createDataFrame([("x_2024.csv",), ("nothing",)], "name string")
    got = matching.archives_holding(members, wanted, "archive", "member", "name").collect()
    assert sorted(r[0] for r in got) == ["a.zip", "c.zip"]
    assert matching.archives_holding(members, wanted.limit(0), "archive", "member", "name").count() == 0


def test_missing_partitions(spark):
    source = spark.createDataFrame([("t", "20240301"), ("t", "20240303")], "tb string, dt string")
    target = spark.createDataFrame([("t", "20240302")], "tb string, dt string")
    got = matching.missing_partitions(source, target).collect()
    assert [tuple(r) for r in got] == [("t", "20240229")]


def test_retry_lookup(spark):
    files = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "a")], "seq string, nm string")
    retries = spark.createDataFrame([("1", "b", "h1"), ("2", "", "h2"), ("2", None, "h3")], "seq string, file string, hist string")
    got = {(r["seq"], r["nm"], r["hist"]) for r in matching.retry_lookup(files, retries, "seq", "nm", "file").collect()}
    assert got == {("1", "b", "h1"), ("2", "a", "h2"), ("2", "a", "h3")}


def pages_by_conditions(rows, borders):
    """Which pages' conditions each row meets, all of them."""
    conditions = ranges.range_predicates(borders, "k", "s")
    met = F.array_compact(F.array(*[F.when(F.expr(c), F.lit(i)) for i, c in enumerate(conditions)]))
    return {r.id: r.met for r in rows.select("id", met.alias("met")).collect()}, len(conditions)


@pytest.mark.parametrize("kind", ["number", "date", "timestamp", "decimal"])
def test_key_ranges_hold_each_row_once_and_stay_even(many_parts, kind):
    day, draw = datetime.date(2024, 1, 1), random.Random(6)
    make = {
        "number": lambda n: n,
        "date": lambda n: day + datetime.timedelta(days=n),
        "timestamp": lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=n, microseconds=n),
        "decimal": lambda n: decimal.Decimal(n) / 4,
    }[kind]
    drawn = [(i, draw.choice([None, 5, 5, 5, 30, 30, *range(40)]), None if i % 50 == 0 else i) for i in range(1200)]
    values = [(i, None if k is None else make(k), s) for i, k, s in drawn]
    sql = {"number": "long", "date": "date", "timestamp": "timestamp", "decimal": "decimal(10,2)"}[kind]
    rows = many_parts.createDataFrame(values, f"id long, k {sql}, s long")
    borders = ranges.key_borders(rows, "k", "s", 40)
    met, pages = pages_by_conditions(rows, borders)
    assert pages > 20 and len(met) == 1200 and all(len(m) == 1 for m in met.values())
    placed = {r.id: r.page for r in ranges.with_page(rows, borders, "k", "s").collect()}
    assert placed == {i: m[0] for i, m in met.items()}
    sizes = [list(placed.values()).count(p) for p in range(pages)]
    assert sum(sizes) == 1200 and max(sizes) <= 2.1 * 40 + 60, "null keys, about 30, lie in the first page"
    assert max(sizes[1:]) <= 2.1 * 40


def test_key_ranges_of_few_and_equal_rows(spark):
    none = spark.createDataFrame([], "id long, k long, s long")
    assert ranges.key_borders(none, "k", "s", 10) == [] and ranges.range_predicates([], "k", "s") == ["1 = 1"]
    assert ranges.with_page(none, [], "k", "s").columns == ["id", "k", "s", "page"]
    same = spark.createDataFrame([(i, 1, 1) for i in range(50)], "id long, k long, s long")
    met, _ = pages_by_conditions(same, ranges.key_borders(same, "k", "s", 10))
    assert all(len(m) == 1 for m in met.values()), "equal pairs cannot be cut, and are neither lost nor doubled"
    no_second = spark.createDataFrame([(i, 1, None) for i in range(50)], "id long, k long, s long")
    met, _ = pages_by_conditions(no_second, ranges.key_borders(no_second, "k", "s", 10))
    assert all(len(m) == 1 for m in met.values())
    with pytest.raises(ValueError):
        ranges.key_borders(same, "k", "s", 0)
    with pytest.raises(TypeError):
        ranges.range_predicates([("text", None)], "k", "s")
