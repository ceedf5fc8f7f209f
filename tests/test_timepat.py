"""Vectors for time patterns, offsets and file names."""

import pytest
from pyspark.sql import functions as F

from quayside.functions import paths as P
from quayside.functions import timepat as TP

BASE = "202402281745"


def rows_of(spark, vectors, schema):
    return spark.createDataFrame(vectors, schema)


def test_move_clock(spark):
    vectors = [
        ("2d", "202402281745", "+", "20240301"),  # over a leap day
        ("2d", "202302281745", "+", "20230302"),
        ("1y", "202402290600", "+", "2025"),
        ("1M", "202403310600", "-", "202402"),  # a day the month lacks
        ("13M", "202402281745", "-", "202301"),
        ("7H", "202412311800", "+", "2025010101"),
        ("45m", "202503010015", "-", "202502282330"),
        ("4000m", "202402281745", "+", "202403021225"),
        ("365d", "202401010000", "+", "20241231"),
        ("0d", "202406300000", "-", "20240630"),
    ]
    frame = rows_of(spark, vectors, "p string, t string, o string, want string")
    for row in frame.select("*", TP.move_clock(F.col("p"), F.col("t"), F.col("o")).alias("got")).collect():
        assert row["got"] == row["want"], row


@pytest.mark.parametrize(
    "pattern, time, operator",
    [("3w", BASE, "-"), ("d3", BASE, "+"), ("5H", "", "-"), ("5H", "28.02.2024", "+"), ("5H", BASE, "/")],
)
def test_move_clock_errors(values, pattern, time, operator):
    with pytest.raises(Exception):
        values(TP.move_clock(F.lit(pattern), F.lit(time), F.lit(operator)))


def test_offsets_in_patterns(spark):
    vectors = [
        ("${yyyyMMdd+2d}", "20240301"), ("${yyyyMMddHH+7H}", "2024022900"), ("${yyyyMMddHH-18H}", "2024022723"),
        ("${yyyyMMddHH+15m}", "2024022818"), ("${yyyyMMdd+12M}", "20250228"), ("${yyyyMMdd-3y}", "20210228"),
        ("${yyyyMM-2M}", "202312"), ("${yyyyMM}01", "20240201"), ("${yyMMddHH}", "24022817"), ("${HHmm}", "1745"),
    ]
    frame = rows_of(spark, vectors, "p string, want string")
    for row in frame.select("*", TP.resolve_pattern(F.col("p"), BASE).alias("got")).collect():
        assert row["got"] == row["want"], row


def test_constant_patterns_agree_with_columns(values):
    for pattern in ("${yyyyMMdd+2d}", "${yyyyMMddHH-75m}", "${yyyyMM-14M}", "${yyyy+3y}", "${HHmm-50m}", "${yyyyMM}01"):
        assert values(TP.resolve_pattern(pattern, BASE)) == values(TP.resolve_pattern(F.lit(pattern), BASE))
    for name in ("in_${yyyyMMdd-9H}_${HH-9H}.gz", "fixed", "${yyyyMM}"):
        assert values(TP.resolve_name(name, BASE)) == values(TP.resolve_name(F.lit(name), BASE))
        assert values(TP.expand_path(name, BASE)) == values(TP.expand_path(F.lit(name), BASE))
    for wrong in ("", "-2M", "${other}", "${yyyyMMdd+4w}"):
        with pytest.raises(ValueError):
            TP.resolve_pattern(wrong, BASE)


@pytest.mark.parametrize("pattern", ["", "-2M", "${other}"])
def test_unknown_pattern_fails(values, pattern):
    with pytest.raises(Exception):
        values(TP.resolve_pattern(F.lit(pattern), BASE))


def test_names_and_target_times(spark):
    vectors = [
        ("stock_${yyyyMM}.orc", BASE, None, "stock_202402.orc", BASE),
        ("stock_${yyyyMMdd+2d}.orc", BASE, None, "stock_20240301.orc", "202403011745"),
        ("${yyyyMMddHH-18H}.gz", BASE, None, "2024022723.gz", "202402272345"),
        ("sum_${yyyyMMddHH+15m}", BASE, None, "sum_2024022818", "202402281800"),
        ("sum_${yyyyMMdd-1d}", BASE, "202405060708", "sum_20240506", "202405060708"),
        ("q_${yyyyMMdd-20H}_${HH-20H}.csv", BASE, None, "q_20240227_21.csv", "202402272145"),
        ("fixed.orc", BASE, None, "fixed.orc", BASE),
    ]
    frame = rows_of(spark, vectors, "n string, s string, t string, want string, time string")
    for row in frame.select("*", TP.resolve_name(F.col("n"), F.col("s"), F.col("t")).alias("got")).collect():
        assert (row["got"]["name"], row["got"]["target_time"]) == (row["want"], row["time"]), row


def test_digit_patterns_in_names(values):
    def named(name, token):
        got = values(TP.resolve_name(F.lit(name), F.lit(BASE), tokens=F.array(F.lit(token))))
        return got["name"], got["target_time"]

    assert named(r"\d{10}-load.bin", r"\d{10}") == ("2024022817-load.bin", BASE)
    assert named(r"\d{12}", r"\d{12}") == (BASE, BASE)
    assert named(r"m\d{6}", r"\d{6}") == ("m202402", BASE)
    with pytest.raises(Exception):
        named(r"\d{7}.bin", r"\d{7}")
    with pytest.raises(Exception):
        values(TP.resolve_name(F.lit("day_${yyyyMMdd}"), F.lit("202404310000")))


def test_names_by_source_date(spark):
    vectors = [
        ("202402281745", "${yyyyMMdd}/part.orc", "20240228/part.orc"),
        ("2024022817", "hour_${yyyyMMddHH}.gz", "hour_2024022817.gz"),
        ("202402281745", "min_${yyyyMMddhhmm}", "min_202402281745"),
        ("202402281745", "low_${yyyyMMddhh}.gz", "low_2024022817.gz"),
        ("20240228", "d${yyyyMMdd}99", "d2024022899"),
        ("2024022817", r"h\d{10}.bin", "h2024022817.bin"),
        ("20240228", r"\d{8}_d", "20240228_d"),
        ("20240228", "fixed", "fixed"),
    ]
    frame = rows_of(spark, vectors, "d string, n string, want string")
    for row in frame.select("*", TP.name_by_source_date(F.col("d"), F.col("n")).alias("got")).collect():
        assert row["got"] == row["want"], row


def test_query_parameters(values):
    got = values(
        TP.resolve_parameter("all", BASE),
        TP.resolve_parameter("${yyyyMMdd}", BASE),
        TP.resolve_parameter("${yyyyMMdd-18H}", BASE),
        TP.resolve_parameter("${yyyyMMddHH-60d}", BASE),
    )
    assert got == ("all", "20240228", "2024022723", "20231230")


def test_partition_values_by_cycle(spark):
    vectors = [
        ("202301020304", "MI", "20230102", None, "0304"), ("2023010203", "HH", "20230102", "03", None),
        ("20230102", "DD", "20230102", None, None), ("202301", "MM", "202301", None, None),
        ("2023010203", "WW", "20230102", None, None),
    ]
    frame = rows_of(spark, vectors, "t string, c string, dt string, hh string, hm string")
    for row in frame.select("*", TP.partition_values(F.col("t"), F.col("c")).alias("got")).collect():
        assert tuple(row["got"]) == (row["dt"], row["hh"], row["hm"]), row


@pytest.mark.parametrize("time, cycle", [("2023", "DD"), ("20230101", "QQ"), ("20231301", "DD")])
def test_bad_partition_values_fail(values, time, cycle):
    with pytest.raises(Exception):
        values(TP.partition_values(F.lit(time), F.lit(cycle)))


def test_paths_by_pattern(values):
    got = values(TP.expand_path("/db=d/tb=t/dt=${yyyyMMdd}/hh=${HH-5H}", "202401010300"))
    assert tuple(got) == ("/db=d/tb=t/dt=20240101/hh=22", "2024010122")
    assert tuple(values(TP.expand_path("/db=d", "202401010300"))) == ("/db=d", "202401010300")
    assert values(TP.path_by_source_date("202510", "/x/dt=${yyyyMM}/${yyyyMMdd-1M}")) == "/x/dt=202510/20251001"


def test_clean_names(spark):
    names = ["load_20240228.zip", "20240228-load.orc", "20240228174500_load.csv", "load-20240228174500.tar.gz", "load.bin"]
    frame = rows_of(spark, [(f"/in/{n}",) for n in names], "p string")
    assert {r[0] for r in frame.select(P.clean_file_name(F.col("p"))).collect()} == {"load"}


def test_names_and_partitions(values):
    day, none = F.lit("20250422"), F.lit(None).cast("string")
    got = values(
        P.align_name_with_partition(F.lit("data_20250422101530.csv"), day, F.lit("10"), none),
        P.align_name_with_partition(F.lit("data_202504221015.csv"), day, none, F.lit("1015")),
        P.align_name_with_partition(F.lit("data_2025042210.csv"), day, none, none),
        P.align_name_with_partition(F.lit("data.csv"), day, none, none),
        P.align_name_with_partition(F.lit("data_2025042210.csv"), none, none, none),
        P.name_without_date(F.lit("a_20250101b-202501.dat")),
        P.wildcard_prefix(F.lit("/data/CM/EMS00*/2026*"), F.lit("/data/CM/EMS001/20260223/")),
        P.wildcard_prefix(F.lit("/data/*"), F.lit("/data/a/b")),
        P.prefix_from_directory(F.lit("f"), F.lit("/x/y"), "/z/(.)"),
    )
    assert got == (
        "data_2025042210.csv", "data_202504221015.csv", "data_20250422.csv", "data.csv", "data_2025042210.csv",
        "ab.dat", "EMS001_20260223", "b", "f",
    )


def test_file_stems(values):
    clock = F.lit("202501020304")
    got = values(
        P.file_stem(F.lit("/db=a/tb=t/dt=20250102"), "HH", clock),
        P.file_stem(F.lit("/db=a/tb=t/dt=20250102/hh=05"), "MI", clock),
        P.file_stem(F.lit("/db=a/tb=t"), "HH", clock),
        P.file_stem(F.lit("/db=a/tb=t/dt=20250102/x.y.csv"), "HH", clock),
        P.named_by_partitions(F.lit("/db=a/tb=t/dt=20250102/hh=05/hm=0506")),
    )
    assert got == ("t_20250102_03", "t_20250102_0304_05", "t_03", "x.y", "t_20250102_05_0506")


def test_partitions_of_paths(values):
    got = values(P.partitions_of(F.lit("/db=a/event_dt=1/dt=20250102/hh=05/nw=4g/sys=s1/f")))
    assert got.asDict() == {"dt": "20250102", "hh": "05", "hm": "0500", "ym": None, "nw": "4g", "sys": "s1"}
    parts = P.partition_list(F.lit("/ym=202501/x"))
    assert values(parts) == [{"ym": "202501"}]
    assert values(P.joined_partition_values(P.partition_list(F.lit("/dt=20250102/hh=05/f")))) == "2025010205"
    assert values(P.first_of_month(F.lit("202501"))) == "20250101"


def test_target_paths(values):
    parts = P.partitions_of(F.lit("/dt=20250102/hh=05/f"))
    assert values(P.target_path("/a/occr_dt=${x}/hr=${HH}/b", parts)) == "hdfs:///a/occr_dt=20250102/hr=05/b"
    assert values(P.target_path("s3a://b/event_time=${x}", parts)) == "s3a://b/event_time=2025010205"
    with pytest.raises(Exception):
        values(P.target_path("/a/nw=${x}", parts))


def test_source_dates_and_partition_from_name(values):
    none = P.partitions_of(F.lit("/ym=202501/hh=05/f"))
    assert values(P.source_date(F.lit("a_202501021530.csv"), none)) == "202501021530"
    assert values(P.source_date(F.lit("a.csv"), none)) == "20250105"
    assert values(P.partition_from_name(F.lit("x_4g_1.csv"), "x_(?<nw>[0-9a-z]+)_")) == "4g"
    with pytest.raises(Exception):
        values(P.partition_from_name(F.lit("none.csv"), "x_(.+)_"))
