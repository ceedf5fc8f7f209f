"""Time patterns, file names and paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import paths as P
from quayside.functions import text as X
from quayside.functions import timepat as TP
from quayside.plans.registry import check, table


def _by_kind(column: str, options: dict[str, str]) -> Column:
    """A literal per value of a column, null for the others."""
    pairs = [F.lit(item) for pair in options.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(column))


_CYCLES = {"signup": "MI", "purchase": "HH", "error": "DD", "view": "MM", "click": "WW"}


@check(
    "partition_derive",
    """
    WITH e AS (SELECT event_id, ts, event_type FROM events)
    SELECT event_id,
           CASE event_type WHEN 'signup' THEN strftime(ts, '%Y%m%d%H%M') WHEN 'purchase' THEN strftime(ts, '%Y%m%d%H')
             WHEN 'view' THEN strftime(ts, '%Y%m') ELSE strftime(ts, '%Y%m%d') END AS target,
           CASE WHEN event_type = 'view' THEN strftime(ts, '%Y%m') ELSE strftime(ts, '%Y%m%d') END AS dt,
           CASE WHEN event_type = 'purchase' THEN strftime(ts, '%H') END AS hh,
           CASE WHEN event_type = 'signup' THEN strftime(ts, '%H%M') END AS hm,
           CASE WHEN event_type = 'view' THEN strftime(ts, '%Y%m') || '01' ELSE strftime(ts, '%Y%m%d') END AS day
    FROM e
    """,
)
def partition_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target time and partition values by collection cycle."""
    cycled = table(spark, sf_dir, "events", wide=True).select(
        "event_id", "ts", _by_kind("event_type", _CYCLES).alias("cycle")
    )
    timed = cycled.withColumn("target", TP.cycle_time(F.col("cycle"), F.col("ts")))
    parts = timed.withColumn("p", TP.partition_values(F.col("target"), F.col("cycle")))
    return parts.select("event_id", "target", "p.dt", "p.hh", "p.hm", P.first_of_month(F.col("p.dt")).alias("day"))


_PATTERNS = {
    "1-URGENT": "${yyyyMMdd-1d}",
    "2-HIGH": "${yyyyMMddHH+30m}",
    "3-MEDIUM": "${yyyyMM-1M}",
    "4-NOT SPECIFIED": "${yyyyMMdd_HHmm-90m}",
    "5-LOW": "${yyyy+1y}",
}


@check(
    "time_offset",
    """
    WITH o AS (
      SELECT o_orderkey, o_orderpriority AS p, o_orderdate + INTERVAL 45 MINUTE AS t,
             CASE o_orderpriority WHEN '1-URGENT' THEN o_orderdate + INTERVAL 45 MINUTE - INTERVAL 1 DAY
               WHEN '2-HIGH' THEN o_orderdate + INTERVAL 75 MINUTE
               WHEN '3-MEDIUM' THEN o_orderdate + INTERVAL 45 MINUTE - INTERVAL 1 MONTH
               WHEN '4-NOT SPECIFIED' THEN o_orderdate - INTERVAL 45 MINUTE
               ELSE o_orderdate + INTERVAL 45 MINUTE + INTERVAL 1 YEAR END AS moved
      FROM orders),
    f AS (
      SELECT *, CASE p WHEN '1-URGENT' THEN strftime(moved, '%Y%m%d') WHEN '2-HIGH' THEN strftime(moved, '%Y%m%d%H')
               WHEN '3-MEDIUM' THEN strftime(moved, '%Y%m') WHEN '4-NOT SPECIFIED' THEN strftime(moved, '%Y%m%d_%H%M')
               ELSE strftime(moved, '%Y') END AS resolved FROM o)
    SELECT o_orderkey, resolved, 'log_' || resolved || '.dat' AS name, strftime(moved, '%Y%m%d%H%M') AS target_time,
           'log_' || CASE p WHEN '1-URGENT' THEN '20200229' WHEN '2-HIGH' THEN '2020022912' WHEN '3-MEDIUM' THEN '202002'
             WHEN '4-NOT SPECIFIED' THEN '20200229_1234' ELSE '2020' END || '.dat' AS fixed_name,
           CASE p WHEN '1-URGENT' THEN strftime(moved, '%Y%m%d') WHEN '2-HIGH' THEN strftime(moved, '%Y%m%d%H%M')
             WHEN '3-MEDIUM' THEN strftime(moved, '%Y%m') WHEN '4-NOT SPECIFIED' THEN strftime(moved, '%Y%m%d%H%M')
             ELSE strftime(moved, '%Y') END AS parameter
    FROM f
    """,
)
def time_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns with offsets resolved per row: alone, within a name, and as a query parameter."""
    orders = table(spark, sf_dir, "orders", wide=True).select(
        "o_orderkey",
        F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("0045")).alias("start"),
        _by_kind("o_orderpriority", _PATTERNS).alias("pattern"),
    )
    pattern, start = F.col("pattern"), F.col("start")
    name = F.concat(F.lit("log_"), pattern, F.lit(".dat"))
    named = orders.withColumn("n", TP.resolve_name(name, start))
    return named.select(
        "o_orderkey",
        TP.resolve_pattern(pattern, start).alias("resolved"),
        "n.name",
        "n.target_time",
        TP.resolve_name(name, start, F.lit("202002291234"))["name"].alias("fixed_name"),
        TP.resolve_parameter(pattern, start).alias("parameter"),
    )


@check(
    "source_pattern_paths",
    """
    SELECT event_id, '/db=d_x/tb=' || event_type || '/dt=' || strftime(ts - INTERVAL 5 HOUR, '%Y%m%d') || '/hh='
             || strftime(ts - INTERVAL 5 HOUR, '%H') AS path,
           strftime(ts - INTERVAL 5 HOUR, '%Y%m%d%H') AS target_time,
           '/out/dt=' || strftime(ts, '%Y%m%d') || '/' || strftime(ts, '%H%M') AS delivered
    FROM events
    """,
)
def source_pattern_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source path pattern expanded; its resolved parts make the target time."""
    start = F.date_format("ts", "yyyyMMddHHmm")
    pattern = F.concat(F.lit("/db=d_x/tb="), "event_type", F.lit("/dt=${yyyyMMdd-5H}/hh=${HH-5H}"))
    done = table(spark, sf_dir, "events", wide=True).withColumn("x", TP.expand_path(pattern, start))
    return done.select(
        "event_id",
        "x.path",
        "x.target_time",
        TP.path_by_source_date(start, "/out/dt=${yyyyMMdd-1d}/${HHmm}").alias("delivered"),
    )


@check(
    "name_template",
    r"""
    WITH e AS (
      SELECT event_id, event_type AS k, strftime(ts, '%Y%m%d') AS d, strftime(ts, '%H') AS h, strftime(ts, '%H%M') AS hm, ts
      FROM events)
    SELECT event_id,
           'A_' || CASE k WHEN 'view' THEN d || h WHEN 'click' THEN d ELSE d || hm END || '.dat' AS delivered,
           k AS clean,
           k || '.csv' AS undated,
           CASE k WHEN 'view' THEN k || '_' || d || h || '.csv' WHEN 'click' THEN k || '_' || d || hm || '.csv'
             ELSE k || '_' || d || '.csv' END AS aligned,
           CASE k WHEN 'view' THEN k || '_' || d || '_' || h WHEN 'click' THEN k || '_' || d || '_' || hm
             WHEN 'error' THEN 'f' ELSE k || '_' || d END AS stem,
           k || CASE k WHEN 'view' THEN '.gz.parquet' WHEN 'click' THEN '.zstd.parquet' ELSE '.parquet' END AS merged,
           CASE WHEN k = 'error' THEN d || h ELSE d END AS source_date,
           'EMS' || h || '_' || k AS prefixed
    FROM e
    """,
)
def name_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names filled from dates, cleaned of dates, and aligned with their partition."""
    kind = F.col("event_type")
    day, hour, minute = (F.date_format("ts", f) for f in ("yyyyMMdd", "HH", "HHmm"))
    template = F.when(kind == "view", r"A_${yyyyMMddHH}.dat").when(kind == "click", r"A_\d{8}.dat").otherwise(r"A_${yyyyMMddhhmm}.dat")
    dated = F.concat(kind, F.lit("_"), day, minute, F.lit(".csv"))
    zipped = F.concat(F.lit("/a/b/"), day, F.lit("_"), kind, F.lit(".tar.gz"))
    path = F.concat(
        F.lit("/db=x/tb="), kind, F.lit("/dt="), day, F.when(kind == "error", "/f.dat").otherwise("")
    )
    cycle = F.when(kind == "view", "HH").when(kind == "click", "MI").otherwise("DD")
    codec = F.when(kind == "view", "gzip").when(kind == "click", "zstd").otherwise("none")
    named = F.when(kind == "error", "plain.dat").otherwise(F.concat(kind, F.lit("-"), day, F.lit(".dat")))
    parts = P.partitions_of(F.concat(F.lit("/tb=x/dt="), day, F.lit("/hh="), hour, F.lit("/f")))
    directory = F.concat(F.lit("/data/EMS"), hour, F.lit("/in"))
    return table(spark, sf_dir, "events", wide=True).select(
        "event_id",
        TP.name_by_source_date(F.concat(day, minute), template).alias("delivered"),
        P.clean_file_name(zipped).alias("clean"),
        P.name_without_date(dated).alias("undated"),
        P.align_name_with_partition(
            dated, day, F.when(kind == "view", hour), F.when(kind == "click", minute)
        ).alias("aligned"),
        P.file_stem(path, cycle, F.concat(day, minute)).alias("stem"),
        P.merged_name(kind, codec, "parquet").alias("merged"),
        P.source_date(named, parts).alias("source_date"),
        P.prefix_from_directory(kind, directory, "/data/([A-Z]+[0-9]+)").alias("prefixed"),
    )


@check(
    "target_path_template",
    """
    SELECT event_id,
           CASE event_type
             WHEN 'view' THEN 'hdfs:///out/etl_dt=' || strftime(ts, '%Y%m%d') || '/hr=' || strftime(ts, '%H')
             WHEN 'click' THEN 's3a://bucket/event_time=' || strftime(ts, '%Y%m%d%H')
             ELSE 'hdfs:///out/dt=' || strftime(ts, '%Y%m%d') || '/hm=' || strftime(ts, '%H') || '00/x' END AS dest_path
    FROM events
    """,
)
def target_path_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery paths filled from the partitions of the landed path."""
    kind = F.col("event_type")
    template = (
        F.when(kind == "view", "/out/etl_dt=${yyyyMMdd}/hr=${HH}")
        .when(kind == "click", "s3a://bucket/event_time=${yyyyMMddHH}")
        .otherwise("hdfs:///out/dt=${yyyyMMdd}/hm=${HHmm}/x")
    )
    path = P.landed_path(
        F.lit("d"), kind, ("dt", F.date_format("ts", "yyyyMMdd")), ("hh", F.date_format("ts", "HH"))
    )
    return table(spark, sf_dir, "events", wide=True).select("event_id", P.target_path(template, P.partitions_of(path)).alias("dest_path"))


@check(
    "partition_lists",
    """
    WITH e AS (SELECT event_id, event_type AS k, strftime(ts, '%Y%m%d') AS d, strftime(ts, '%H') AS h, ts FROM events)
    SELECT event_id,
           CASE k WHEN 'view' THEN 'dt=' || d || ',hh=' || h || ',nw=4g' WHEN 'click' THEN 'dt=X' ELSE 'dt=' || d || ',hh=' || h || ',sys=a' END AS specs,
           CASE k WHEN 'error' THEN '' ELSE 'dt=' || strftime(ts - INTERVAL 1 DAY, '%Y%m%d') || ',nw=4g' END AS noti,
           k AS from_name,
           d || h AS target_dt,
           CASE k WHEN 'view' THEN '0 * * * *' WHEN 'click' THEN '0 0 * * *' WHEN 'error' THEN '5 5 * * *' ELSE '' END AS cron,
           CASE k WHEN 'view' THEN 'MM' WHEN 'click' THEN 'DD' WHEN 'error' THEN 'HH' ELSE 'MI' END AS cycle
    FROM e
    """,
)
def partition_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition lists: defaults added, notification lists resolved or cleared, values joined."""
    kind = F.col("event_type")
    day, hour = F.date_format("ts", "yyyyMMdd"), F.date_format("ts", "HH")

    def entry(key: str, value: Column | str) -> Column:
        return F.create_map(F.lit(key), TP.as_col(value))

    def shown(parts: Column) -> Column:
        pair = lambda p: F.concat(F.map_keys(p)[0], F.lit("="), F.map_values(p)[0])
        return F.array_join(F.transform(parts, pair), ",")

    defaults = F.array(entry("dt", day), entry("hh", hour))
    custom = F.when(kind == "view", F.array(entry("nw", "4g"))).when(kind == "click", F.array(entry("dt", "X"))).otherwise(F.array(entry("sys", "a")))
    noti = F.when(kind == "error", F.array(entry("empty", "true"))).otherwise(F.array(entry("dt", "${yyyyMMdd-1d}"), entry("nw", "4g")))
    path = P.landed_path(F.lit("d"), kind, ("dt", day), ("hh", hour))
    marked = F.concat(F.lit("/x/period="), F.when(kind == "view", "1h").when(kind == "click", "1d").otherwise("none"), F.lit("/y"))
    digits = F.when(kind == "view", F.lit("202401")).when(kind == "click", day).otherwise(F.concat(day, hour))
    return table(spark, sf_dir, "events", wide=True).select(
        "event_id",
        shown(P.partition_specs(custom, defaults)).alias("specs"),
        shown(P.notification_partitions(noti, TP.pad_start_time(F.concat(day, hour)), TP.resolve_pattern)).alias("noti"),
        P.partition_from_name(F.concat(F.lit("kpi_"), kind, F.lit(".csv")), r"kpi_([a-z]+)\.").alias("from_name"),
        P.joined_partition_values(P.partition_list(path)).alias("target_dt"),
        P.schedule_of(marked, F.when(kind == "error", "5 5 * * *")).alias("cron"),
        TP.cycle_of_length(digits, F.when(kind.isin("view", "click", "error"), "OD").otherwise("MI")).alias("cycle"),
    )


@check(
    "key_routing",
    """
    WITH k AS (SELECT o_orderkey, upper(substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS id FROM orders),
    d AS (SELECT o_orderkey, id, strpos('0123456789ABCDEFGHJKMNPQRSTVWXYZ', id[-4:-4]) - 1 AS a, strpos('0123456789ABCDEFGHJKMNPQRSTVWXYZ', id[-3:-3]) - 1 AS b,
                 strpos('0123456789ABCDEFGHJKMNPQRSTVWXYZ', id[-2:-2]) - 1 AS c, strpos('0123456789ABCDEFGHJKMNPQRSTVWXYZ', id[-1:-1]) - 1 AS e FROM k)
    SELECT o_orderkey, CAST((((a * 32 + b) * 32 + c) * 32 + e) % 7 AS INTEGER) AS partition,
           CAST((((a * 32 + b) * 32 + c) * 32 + e) % 5 AS INTEGER) AS plain FROM d
    """,
)
def key_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic partition of an id by its last four characters."""
    key = F.upper(F.left(F.md5(F.col("o_orderkey").cast("string")), F.lit(8)))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        X.routing_partition(key, 7).alias("partition"),
        X.routing_partition(key, 5, X.ALPHABET_PLAIN).alias("plain"),
    )


@check(
    "error_truncate",
    """
    WITH d AS (SELECT doc_id, '[Encoding Error] file=' || doc_id || ' error=' AS prefix,
                      regexp_replace(text, '[^ -~]', '?', 'g') AS detail FROM documents)
    SELECT doc_id, prefix || CASE WHEN length(detail) > 200 - length(prefix) - 3
             THEN left(detail, CAST(200 - length(prefix) - 3 AS INTEGER)) || '...' ELSE detail END AS message
    FROM d
    """,
)
def error_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages cut to 200 bytes."""
    prefix = F.concat(F.lit("[Encoding Error] file="), F.col("doc_id").cast("string"), F.lit(" error="))
    detail = F.regexp_replace("text", "[^ -~]", "?")
    return table(spark, sf_dir, "documents").select("doc_id", X.truncated_message(prefix, detail).alias("message"))
