"""Steps whose tasks, files and broadcasts must follow the size of what they are given."""

from pyspark.sql import functions as F

from quayside.operators import copies, governance, matching
from quayside.sinks import bins


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_discovery_broadcasts_no_catalogue(spark, tmp_path):
    fields = "array<struct<name:string,type:string>>"
    catalogue = spark.createDataFrame(
        [("d.a", [("cdr_x", "string"), ("lat", "double")]), ("d.a", [("cdr_x", "string")]), ("d.b", [("x_cdr", "string")]), (None, [("cdr", "string")])],
        f"stem string, fields {fields}",
    )
    ddl = spark.createDataFrame([("d.a", "`cdr_x` string COMMENT 'one', `lat` double COMMENT '위도'"), ("d.z", "`cdr` string COMMENT 'two'"), (None, "`cdr` string COMMENT 'x'")], "stem string, ddl string")
    found = governance.discover_sensitive(stored(catalogue, tmp_path / "a"), stored(ddl, tmp_path / "b"), tokens=("cdr",))
    assert "Broadcast" not in plan_of(found)
    rows = found.select("stem", "index", "name", "comment", "rule").collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(
        map(repr, [("d.a", 0, "cdr_x", "one", "comment")] * 2 + [("d.a", 1, "lat", "위도", "comment"), ("d.b", 0, "x_cdr", None, "name"), (None, 0, "cdr", None, "name")])
    )


def test_a_hot_key_is_joined_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(matching, "CELL_ROWS", 20, raising=False)
    monkeypatch.setattr(matching, "TASK_ROWS", 1000, raising=False)
    landed = [("d", "t", i) for i in range(200)] + [("d", "u", 7), ("d", "u", 7), (None, "t", 8), ("e", None, 9), ("f", "v", 10)]
    active = [("d", "t", 1000 + i, "Y") for i in range(300)] + [("d", "u", 1, "Y"), ("d", "u", 1, "Y"), ("d", "u", 2, "N"), (None, "t", 3, "Y"), ("e", None, 4, "Y"), ("g", "v", 5, "Y")]
    found = matching.delivery_interfaces(
        spark.createDataFrame(landed, "db string, tb string, s long"), spark.createDataFrame(active, "db string, tb string, c long, use_yn string")
    )
    assert found.columns == ["db", "tb", "s", "c"]
    wanted = [(d, t, s, c) for d, t, s in landed for e, u, c, y in active if (d, t) == (e, u) and d and t and y == "Y"]
    assert len(wanted) == 60004 and sorted(map(tuple, found.collect())) == sorted(wanted)
    most = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < 60000 / 5


def test_cells_of_nothing(spark):
    none = spark.createDataFrame([], "db string, tb string, s long")
    assert matching.join_in_cells(none, none.withColumnRenamed("s", "c"), ["db", "tb"]).collect() == []


def test_a_large_copy_has_more_buckets(spark, monkeypatch):
    """Differences a fixed way apart leave few rows to read again, however many rows there are."""
    monkeypatch.setattr(copies, "BUCKETS", 4)
    monkeypatch.setattr(copies, "BUCKET_ROWS", 8, raising=False)
    left = spark.range(20_000).selectExpr("'p' AS part", "id", "cast(id AS string) AS v")
    right = left.where("id % 500 <> 3").repartition(3)
    buckets = copies.buckets_for(20_000)
    found = copies.unequal_buckets(left, right, "part", ["id"], buckets)
    assert found.agg(F.sum("left_rows")).first()[0] < 1000
    gone = copies.differing_keys(left, right, "part", ["id"], buckets, found=found).collect()
    assert sorted(map(tuple, gone)) == [("p", n, "removed") for n in range(3, 20_000, 500)]
    summed = copies._branches(left.select("part", *copies._row_sums(["id", "v"])), ["part"])
    assert set(dict(summed.dtypes).values()) == {"string", "bigint"} and min(summed.drop("part").first()) > 0


def test_a_task_writes_many_small_bins(spark, tmp_path):
    """Bytes stay as they are, and bins are many more than the tasks that write them."""
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    lines = [b"%d:" % i + b"\xff\r\xc3" * (i % 40) for i in range(4000)] + [b"", b"", b"y" * 5000, b"end"]
    (source / "a.txt").write_bytes(b"\n".join(lines[:3000]) + b"\n")
    (source / "b.txt").write_bytes(b"\n".join(lines[3000:]))
    sizes = bins.bin_text(spark, [str(source)], str(out), 1000).collect()
    files = sorted(out.glob("part-*"))
    assert sorted(line for f in files for line in f.read_bytes().removesuffix(b"\n").split(b"\n")) == sorted(lines)
    assert sum(r.lines for r in sizes) == len(lines) and sum(r.bytes for r in sizes) == sum(map(len, lines)) + len(lines)
    assert sorted(r.bytes for r in sizes)[-2] <= 1000 and len(sizes) > 200
    assert len({f.name.split("-")[1] for f in files}) == 1
