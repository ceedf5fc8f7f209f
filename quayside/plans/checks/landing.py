"""Whole jobs read back: kept columns, named files, raw lines, exported partitions, arrivals in turn."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import CryptoRule, ReadSpec, WriteSpec
from quayside.functions.crypto import apply_rules
from quayside.operators import frames, governance
from quayside.plans import jobs
from quayside.plans.checks.exchange import order_texts
from quayside.plans.checks.typing import ALL_TYPES, event_texts
from quayside.plans.registry import CHECK_KEYS, check, table
from quayside.session import local_table, scratch_path
from quayside.sinks import writers
from quayside.sources import files
from quayside.streaming.messages import consume, file_messages

_RULES = [CryptoRule("mdn", (2,))]


@check(
    "protect_keeps_columns",
    """
    SELECT event_id, event_type, strftime(ts, '%Y%m%d') AS dt, 'data' AS dt_from FROM events
    UNION ALL SELECT event_id, event_type, '20240101', 'path' FROM events
    """,
)
def protect_keeps_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A data column ``dt`` stays as it is; only a ``dt`` that stands in the path is added."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("dt"))
    results = []
    for origin, rows, place in (("data", events, "/tb=ev"), ("path", events.drop("dt"), "/tb=ev/dt=20240101")):
        source, path = scratch_path(spark, "plain") + place, scratch_path(spark, "sealed") + place
        rows.write.parquet(source)
        jobs.protect(spark, source, path, ReadSpec("parquet"), WriteSpec(), _RULES, CHECK_KEYS)
        sealed = spark.read.option("basePath", path).parquet(path)  # ``dt`` of the files, not of the folder's name
        results.append(apply_rules(sealed, _RULES, CHECK_KEYS, "decryption").withColumn("dt_from", F.lit(origin)))
    return frames.concat_all([r.select("event_id", "event_type", "dt", "dt_from") for r in results])


@check(
    "lines_any_charset",
    """
    SELECT CASE event_type WHEN 'view' THEN '' ELSE event_type || '#' || event_id END AS line, charset
    FROM events, (VALUES ('UTF-8'), ('EUC-KR')) c(charset)
    """,
)
def lines_any_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines keep NUL and blank lines, whatever the charset."""
    path = scratch_path(spark, "lines")
    marked = F.concat("event_type", F.lit("\x00"), F.col("event_id").cast("string"))
    table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "view", "").otherwise(marked).alias("value")).write.text(path)
    read = [files.read_lines(spark, path, charset).withColumn("charset", F.lit(charset)) for charset in ("UTF-8", "EUC-KR")]
    return frames.concat_all(read).select(F.translate("value", "\x00", "#").alias("line"), "charset")


@check(
    "merge_named_files",
    """
    SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice, 'orders.' || fmt AS file
    FROM orders, (VALUES ('parquet'), ('orc')) f(fmt)
    """,
)
def merge_named_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged output has the asked file name in every format."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"))
    results = []
    for fmt in ("parquet", "orc"):
        path = scratch_path(spark, "named")
        writers.write_files(orders.repartition(4), path, WriteSpec(fmt, merge=True, file_name=f"orders.{fmt}"))
        results.append(files.read_files(spark, path, ReadSpec(fmt)).select("*", F.col("_metadata.file_name").alias("file")))
    return frames.concat_all(results)


@check(
    "sized_parts",
    "SELECT p_partkey, p_name, CAST(4 AS BIGINT) AS files FROM part",
)
def sized_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows split by size into ``total // target + 1`` files of even row counts."""
    path = scratch_path(spark, "sized")
    writers.write_sized(table(spark, sf_dir, "part").select("p_partkey", "p_name"), path, 3500, 1000)
    listed = files.list_files(spark, path, ".parquet").agg(F.count(F.lit(1)))
    return spark.read.parquet(path).withColumn("files", listed.scalar())


@check(
    "export_partition",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, '20240101' AS dt, '05' AS hh FROM events
    """,
)
def export_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed partition as merged text, with its keys as columns."""
    source, path = scratch_path(spark, "landed") + "/tb=ev/dt=20240101/hh=05", scratch_path(spark, "export")
    table(spark, sf_dir, "events").select("event_id", "event_type").write.parquet(source)
    jobs.export_partition(spark, source, path, "|", add_partitions=True, merge=True)
    names = {"fields": [{"name": c, "type": "string"} for c in ("event_id", "event_type", "dt", "hh")]}
    return files.read_text_columns(spark, path, ReadSpec("csv", "|", schema=names))


@check(
    "damaged_text",
    """
    SELECT count(*) AS rows, count(*) FILTER (c_custkey % 3 = 0) AS damaged FROM customer
    """,
)
def damaged_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in EUC-KR read as UTF-8: those with Hangul are damaged, and counted."""
    path = scratch_path(spark, "legacy")
    name = F.when(F.col("c_custkey") % 3 == 0, "가나다").otherwise("abc")
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), name.alias("name"))
    writers.write_lines(people, path, "|", encoding="EUC-KR")
    return files.replacement_rate(files.read_lines(spark, path), ["value"])


@check(
    "landing_report",
    """
    SELECT 'rows' AS measure, count(*) AS n FROM events
    UNION ALL SELECT 'c_int', count(*) FILTER (event_type IN ('error', 'view')) FROM events
    UNION ALL SELECT 'c_ts', count(*) FILTER (event_type IN ('error', 'view')) FROM events
    """,
)
def landing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a landing job says of itself: its rows, and the values its types did not accept."""
    text, landed = scratch_path(spark, "dirty"), scratch_path(spark, "landed")
    writers.write_lines(event_texts(spark, sf_dir), text, "\x1e")
    done = jobs.land_delimited(spark, text, landed, ReadSpec("csv", "\\036", schema=ALL_TYPES))
    said = {"rows": done.rows, **{name: done.failed[name] for name in ("c_int", "c_ts")}}
    return local_table(spark, {"measure": list(said), "n": list(said.values())})


@check(
    "audit_table",
    """
    SELECT event_id, '/db=d_ev/tb=' || event_type || '/f.dat' AS filepath, 'd_ev' AS db, event_type AS tb
    FROM (SELECT CAST(event_id AS VARCHAR) AS event_id, event_type FROM events)
    """,
)
def audit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries appended to the audit table in two turns, and read back."""
    path = scratch_path(spark, "audit")
    where = F.concat(F.lit("/db=d_ev/tb="), "event_type", F.lit("/f.dat"))
    sent = table(spark, sf_dir, "events").select("event_type", F.col("event_id").cast("string").alias("id"), where.alias("filepath"))
    for turn in (F.col("event_type") == "view", F.col("event_type") != "view"):
        governance.append_audit(governance.provide_audit(sent.where(turn)), path)
    return spark.read.parquet(path).select(F.col("id").alias("event_id"), "filepath", "db", "tb")


_ARRIVAL = {"fields": [{"name": "o_orderkey", "type": "bigint"}, {"name": "o_orderpriority", "type": "string"}]}


@check("consume_restart", "SELECT o_orderkey, o_orderpriority, left(o_orderpriority, 1) AS level FROM orders")
def consume_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals with a restart between them: every message lands once."""
    source, path, offsets = (scratch_path(spark, name) for name in ("arrivals", "landed", "offsets"))
    orders = order_texts(spark, sf_dir).select(F.concat_ws("|", "o_orderkey", "o_orderpriority").alias("value"))
    first = F.crc32(F.encode("value", "UTF-8")) % 2 == 0
    level = {"level": F.substring("o_orderpriority", 1, 1)}
    for arrival in (first, ~first):
        orders.where(arrival).write.mode("append").parquet(source)
        messages = file_messages(spark, source, orders.schema, F.col("value"))
        consume(messages, _ARRIVAL, path, offsets, sep="|", partitions=level)
    return spark.read.parquet(path).select("o_orderkey", "o_orderpriority", "level")


@check(
    "extract_pages",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS note,
           translate(CAST(o_orderkey AS VARCHAR), '0123456789', '가나다라마바사아자차') AS memo, o_orderstatus AS status,
           CAST(ceil(count(*) OVER () / 1000) AS BIGINT) AS pages
    FROM orders
    """,
)
def extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as a database gives them, with nulls, bytes and marked hex columns, to pages of text and typed parquet."""
    hangul = F.translate(F.col("o_orderkey").cast("string"), "0123456789", "가나다라마바사아자차")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("note"),
        F.hex(F.encode(hangul, "EUC-KR")).alias("memo_decode_to_euc_kr"),
        F.col("o_orderstatus").cast("binary").alias("status"),
    )
    kinds = {"o_orderkey": "bigint", "note": "string", "memo": "string", "status": "string"}
    schema = {"fields": [{"name": name, "type": kind} for name, kind in kinds.items()]}
    text_path, path = scratch_path(spark, "pages"), scratch_path(spark, "extracted")
    jobs.extract_rows(rows, ["o_orderkey"], 1000, text_path, path, schema)
    pages = spark.read.text(text_path).agg(F.count_distinct("page").alias("pages"))
    return spark.read.parquet(path).withColumn("pages", pages.scalar())


@check(
    "sample_files",
    """
    WITH long AS (
      SELECT reader, 'c_name' AS column_name, 0 AS index, c_name AS value FROM customer, (VALUES ('parquet'), ('orc'), ('csv')) r(reader)
      UNION ALL SELECT reader, 'c_mktsegment', 1, c_mktsegment FROM customer, (VALUES ('parquet'), ('orc'), ('csv')) r(reader)
      WHERE c_mktsegment <> 'BUILDING')
    SELECT reader, column_name, index, value
    FROM (SELECT *, row_number() OVER (PARTITION BY reader, column_name ORDER BY md5(value), value) AS rn FROM long) WHERE rn BETWEEN 2 AND 6
    UNION ALL SELECT NULL, NULL, NULL, NULL
    """,
)
def sample_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of listed columns of files in three formats, and a file that no reader fits."""
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", segment)
    listed: dict[str, list] = {"path": ["/landed/people.bin"], "format": [None], "sep": [None]}
    for name, fmt, sep in (("people.parquet", "parquet", None), ("people.orc", "orc", None), ("people.dat", "dat", "|")):
        folder = scratch_path(spark, "landed")
        writers.write_files(people, folder, WriteSpec(fmt, sep=sep or ",", merge=True, file_name=name))
        for key, value in zip(listed, (f"{folder}/{name}", fmt, sep), strict=True):
            listed[key].append(value)
    size = len(listed["path"])
    inventory = local_table(spark, {**listed, "fields": [people.columns] * size, "columns": [["c_name", "c_mktsegment"]] * size})
    return jobs.sample_files(spark, inventory).drop("path")
