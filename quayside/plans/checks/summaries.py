"""Listings, audit rows, reconciliation and other summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import paths as P
from quayside.operators import frames, governance
from quayside.plans.checks.matching import landed_events
from quayside.plans.registry import check, table
from quayside.session import scratch_path


def event_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing with data files, parquet files and success markers."""
    kind = F.col("event_type")
    folder = P.landed_path(F.lit("d"), kind, ("dt", F.date_format("ts", "yyyyMMdd")))
    name = F.when(kind == "error", "_SUCCESS").when(kind == "view", "f.parquet").otherwise("f.dat")
    return table(spark, sf_dir, "events").select(
        F.concat(folder, F.lit("/"), F.col("event_id").cast("string"), name).alias("path"),
        (F.col("user_id") * 1_000_000).alias("length"),
    )


@check(
    "inventory_stats",
    """
    WITH l AS (SELECT '/db=d/tb=' || event_type || '/dt=' || strftime(ts, '%Y%m%d') AS dir, event_type, user_id * 1000000 AS length
               FROM events WHERE event_type <> 'error')
    SELECT count(*) AS files, CAST(sum(length) AS BIGINT) AS total_bytes, CAST(sum(length) / count(*) >= 10485760 AS BOOLEAN) AS large,
           count(DISTINCT dir) AS directories, count(*) FILTER (event_type = 'view') AS new_format, true AS holds_parquet
    FROM l
    """,
)
def inventory_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes, directories and formats of a listing without its markers."""
    listing = frames.data_paths(event_listing(spark, sf_dir))
    sizes = frames.size_summary(listing).drop("avg_bytes")
    folders = frames.distinct_parents(listing).agg(F.count(F.lit(1)).alias("directories"))
    formats = listing.agg(F.count_if(governance.landed_version(F.col("path")) == "2").alias("new_format"))
    return sizes.withColumns(
        {
            "directories": folders.scalar(),
            "new_format": formats.scalar(),
            "holds_parquet": governance.holds_parquet(listing).scalar(),
        }
    )


@check(
    "distinct_parents",
    "SELECT DISTINCT '/db=d/tb=' || event_type || '/dt=' || strftime(ts, '%Y%m%d') AS directory FROM events WHERE event_type <> 'error'",
)
def distinct_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.distinct_parents(frames.data_paths(event_listing(spark, sf_dir)))


@check(
    "file_counts",
    """
    SELECT count(*) FILTER (event_type <> 'error') AS source_files, count(*) FILTER (event_type NOT IN ('error', 'view')) AS target_files,
           count(*) FILTER (event_type <> 'error') = count(*) FILTER (event_type NOT IN ('error', 'view')) AS matches
    FROM events
    """,
)
def file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File counts of a source and a target that lacks its parquet files."""
    listing = event_listing(spark, sf_dir)
    return governance.file_count_match(listing, listing.where(~F.endswith("path", F.lit(".parquet"))))


@check(
    "audit_summary",
    """
    SELECT count(*) FILTER (event_type = 'view') AS succeeded, count(*) AS total,
           CAST(sum(CASE WHEN event_type = 'view' THEN user_id ELSE 0 END) AS BIGINT) AS converted_bytes
    FROM events
    """,
)
def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.status_summary(table(spark, sf_dir, "events"), "event_type", "view", "user_id")


@check(
    "repeated_runs",
    """
    SELECT user_id, event_type, strftime(ts, '%Y%m%d') AS day, count(*) AS runs FROM events
    GROUP BY user_id, event_type, strftime(ts, '%Y%m%d') HAVING count(*) > 1
    """,
)
def repeated_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyyMMdd"))
    return frames.repeated_runs(runs, ["user_id", "event_type", "day"])


@check(
    "first_seen",
    """
    SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1
    """,
)
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest row per key."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return frames.first_seen(events, ["user_id"], F.struct("ts", "event_id")).drop("ts")


@check(
    "param_extremes",
    "SELECT event_type, min(strftime(ts, '%Y%m%d%H%M')) AS target_time, max('dag_' || strftime(ts, '%Y%m%d')) AS latest FROM events GROUP BY event_type",
)
def param_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest query parameter and latest template name."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.min(F.date_format("ts", "yyyyMMddHHmm")).alias("target_time"),
        F.max(F.concat(F.lit("dag_"), F.date_format("ts", "yyyyMMdd"))).alias("latest"),
    )


@check(
    "reconcile",
    """
    WITH n AS (SELECT count(*) AS rows, count(*) FILTER (l_linenumber <> 7) AS kept FROM lineitem)
    SELECT 'whole' AS copy, rows AS source_rows, rows AS target_rows, 4 AS status FROM n
    UNION ALL SELECT 'short', rows, kept, 5 FROM n
    UNION ALL SELECT 'changed', rows, rows, 5 FROM n
    UNION ALL SELECT 'unchecked', rows, kept, 4 FROM n
    UNION ALL SELECT 'reordered', rows, rows, 4 FROM n
    UNION ALL SELECT 'nulls moved', rows, rows, 5 FROM n
    """,
)
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole, a short, a changed and a reordered copy, and one whose nulls stand in another column."""
    lines = table(spark, sf_dir, "lineitem")
    parts = [scratch_path(spark, "copy"), scratch_path(spark, "copy")]
    lines.where("l_returnflag = 'R'").write.parquet(parts[0])
    lines.where("l_returnflag <> 'R'").write.parquet(parts[1])
    whole = frames.concat_all([spark.read.parquet(p) for p in parts])
    short = lines.where("l_linenumber <> 7")
    changed = lines.withColumn("l_tax", F.when(F.col("l_linenumber") == 7, F.col("l_tax") + 1).otherwise(F.col("l_tax")))
    none = F.lit(None).cast("string")
    left = lines.withColumn("l_linestatus", none)
    right = lines.withColumns({"l_linestatus": F.col("l_returnflag"), "l_returnflag": none})
    checks = [
        ("whole", lines, whole, False),
        ("short", lines, short, False),
        ("changed", lines, changed, False),
        ("unchecked", lines, short, True),
        ("reordered", lines, lines.select(*reversed(lines.columns)), False),
        ("nulls moved", left, right, False),
    ]
    return frames.concat_all(
        [governance.reconcile(source, copy, skip).withColumn("copy", F.lit(name)) for name, source, copy, skip in checks]
    )


@check(
    "collect_audit",
    """
    SELECT event_id, 'd_ev' AS db, event_type AS tb, 'ev_' || event_id || '.dat' AS filenm, strftime(ts, '%Y%m%d%H') AS target_dt,
           'dt=' || strftime(ts, '%Y%m%d') || ',hh=' || strftime(ts, '%H') AS partitions,
           CASE WHEN event_type = 'error' THEN 'R6' ELSE 'R0' END AS status_cd, event_type = 'error' AS retry, CAST(-1 AS BIGINT) AS file_size, '1' AS version
    FROM events
    """,
)
def collect_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of landed files; retries are marked."""
    attempts = landed_events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("collect_hist_id"),
        F.col("path").alias("dest_path"),
        F.when(F.col("event_type") == "error", F.lit(1)).alias("retry_id_seq"),
    )
    audit = governance.collect_audit(attempts, "R0", "R6")
    shown = F.transform("partitions", lambda p: F.concat(F.map_keys(p)[0], F.lit("="), F.map_values(p)[0]))
    return audit.select(
        F.col("collect_hist_id").cast("bigint").alias("event_id"),
        "db",
        "tb",
        "filenm",
        "target_dt",
        F.array_join(shown, ",").alias("partitions"),
        "status_cd",
        "retry",
        "file_size",
        "version",
    )


@check(
    "audit_messages",
    """
    WITH k AS (SELECT event_id, upper(substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS id FROM events),
    d AS (SELECT *, strpos('0123456789ABCDEFGHJKMNPQRSTVWXYZ', id[-1:-1]) - 1 AS e FROM k)
    SELECT event_id, id, CAST(e % 4 AS INTEGER) AS partition FROM d
    """,
)
def audit_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery audit rows as routed JSON messages."""
    key = F.upper(F.left(F.md5(F.col("event_id").cast("string")), F.lit(8)))
    deliveries = landed_events(spark, sf_dir).select(
        key.alias("id"), F.col("path").alias("filepath"), F.array(F.lit("lake")).alias("target")
    )
    messages = governance.audit_messages(governance.provide_audit(deliveries), "id", 4)
    name = F.get_json_object("value", "$.filenm")
    return messages.select(
        F.regexp_extract(name, r"ev_(\d+)", 1).cast("bigint").alias("event_id"),
        F.get_json_object("value", "$.id").alias("id"),
        "partition",
    )
