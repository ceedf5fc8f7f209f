"""Files written and read back: formats, separators, charsets, partitions, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import CryptoRule, CryptoRules, ReadSpec, WriteSpec
from quayside.functions import paths as P
from quayside.functions import text as X
from quayside.functions.crypto import apply_rules
from quayside.operators import frames
from quayside.plans import jobs
from quayside.plans.checks.typing import ALL_TYPES, TYPED_SQL, comparable, event_texts
from quayside.plans.registry import CHECK_KEYS, check, table
from quayside.session import scratch_path
from quayside.sinks import writers
from quayside.sources import files

_ORDER_TEXT = {
    "fields": [
        {"name": "o_orderkey", "type": "string"},
        {"name": "o_totalprice", "type": "string"},
        {"name": "o_orderdate", "type": "string"},
        {"name": "o_orderpriority", "type": "string"},
    ]
}
_ORDER_SQL = """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
"""


def order_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_totalprice").cast("decimal(15,2)").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority",
    )


@check("csv_roundtrip_sep", _ORDER_SQL + ", sep FROM orders, (VALUES ('1e'), ('pipes'), ('symbol')) s(sep)")
def csv_roundtrip_sep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written and read with one- and many-character separators."""
    orders = order_texts(spark, sf_dir)
    results = []
    for name, sep in (("1e", "\x1e"), ("pipes", "|^|"), ("symbol", "␞")):
        path = scratch_path(spark, "sep")
        if len(sep.encode()) == 1:
            writers.write_files(orders, path, WriteSpec("csv", None, sep))
        else:
            writers.write_lines(orders, path, sep)
        back = files.read_text_columns(spark, path, ReadSpec("csv", sep, schema=_ORDER_TEXT))
        results.append(back.withColumn("sep", F.lit(name)))
    return frames.concat_all(results)


@check("csv_header_skip", _ORDER_SQL + " FROM orders")
def csv_header_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of every file is a header and is dropped."""
    path = scratch_path(spark, "header")
    spread = order_texts(spark, sf_dir).repartition(4)
    writers.write_files(spread, path, WriteSpec("csv", None, "|", header=True))
    return files.read_files(spark, path, ReadSpec("csv", "|", header=True, schema=_ORDER_TEXT))


@check(
    "format_convert",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
    FROM lineitem
    """,
)
def format_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet to ORC and back, with the default codec of each."""
    orc, parquet = scratch_path(spark, "orc"), scratch_path(spark, "parquet")
    jobs.convert(spark, f"{sf_dir}/lineitem.parquet", orc, ReadSpec("parquet"), WriteSpec("orc"))
    jobs.convert(spark, orc, parquet, ReadSpec("orc"), WriteSpec("parquet", "snappy"))
    return spark.read.parquet(parquet).withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))


@check("land_delimited", TYPED_SQL)
def land_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty delimited text landed as typed parquet."""
    text, landed = scratch_path(spark, "dirty"), scratch_path(spark, "landed")
    writers.write_lines(event_texts(spark, sf_dir), text, "\x1e", "gzip")
    jobs.land_delimited(spark, text, landed, ReadSpec("csv", "\\036", schema=ALL_TYPES))
    return comparable(spark.read.parquet(landed))


@check(
    "export_csv",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS ts,
           CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type, strftime(ts, '%Y%m%d') AS dt,
           strftime(ts, '%H') AS hh
    FROM events
    """,
)
def export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed partitions exported as text: partition columns added, zone moved, the word null emptied."""
    kind = F.when(F.col("event_type") == "error", "null").otherwise(F.col("event_type"))
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_trunc("second", "ts").alias("ts"),
        kind.alias("event_type"),
        F.date_format("ts", "yyyyMMdd").alias("dt"),
        F.date_format("ts", "HH").alias("hh"),
    )
    path = scratch_path(spark, "export")
    jobs.export_csv(events, path, "␞", string_null=True)
    names = {"fields": [{"name": c, "type": "string"} for c in events.columns]}
    back = files.read_text_columns(spark, path, ReadSpec("csv", "␞", schema=names))
    return back.withColumn("event_type", F.nullif("event_type", F.lit("")))


@check(
    "partition_publish",
    "SELECT event_id, user_id, strftime(ts, '%Y%m%d') AS dt, strftime(ts, '%H') AS hh FROM events",
)
def partition_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published to ``dt=/hh=`` directories; partition values stay strings."""
    path = scratch_path(spark, "published") + "/db=d_events/tb=events"
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.date_format("ts", "yyyyMMdd").alias("dt"), F.date_format("ts", "HH").alias("hh")
    )
    writers.write_partitions(events, path, ["dt", "hh"])
    read = spark.read.parquet(path).select("event_id", "user_id", "_metadata")
    return files.with_path_partitions(read, ["dt", "hh"]).drop("_metadata")


@check(
    "reencode_roundtrip",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, translate(c_name, '0123456789', '가나다라마바사아자차') AS c_name FROM customer
    """,
)
def reencode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text delivered in EUC-KR with another separator, and read back."""
    path = scratch_path(spark, "euckr")
    hangul = F.translate("c_name", "0123456789", "가나다라마바사아자차")
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), hangul.alias("c_name"))
    writers.write_lines(people, path, "|^|", encoding="EUC-KR")
    names = {"fields": [{"name": c, "type": "string"} for c in people.columns]}
    return files.read_text_columns(spark, path, ReadSpec("csv", "|^|", "EUC-KR", schema=names))


@check(
    "redelimit",
    """
    SELECT CAST(o_orderkey AS VARCHAR) || chr(30) || CAST(o_custkey AS VARCHAR) || chr(30) || o_orderpriority AS pipes,
           '"' || CAST(o_orderkey AS VARCHAR) || '"' || chr(30) || '"' || o_orderpriority || '"' AS quoted
    FROM orders
    """,
)
def redelimit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many-character separators of raw lines replaced; the quoted form keeps its quotes."""
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    lines = table(spark, sf_dir, "orders").select(
        F.concat_ws("|^|", key, cust, "o_orderpriority").alias("a"),
        F.concat(F.lit('"'), key, F.lit('","'), "o_orderpriority", F.lit('"')).alias("b"),
    )
    return lines.select(
        X.replace_separator(F.col("a"), "|^|", "\x1e").alias("pipes"),
        X.replace_separator(F.col("b"), '","', "\x1e").alias("quoted"),
    )


@check("drop_and_pick_columns", "SELECT p_partkey, p_size, p_name, p_retailprice FROM part")
def drop_and_pick_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns removed by 1-based position in any order, then picked by 0-based position."""
    kept = frames.drop_columns(table(spark, sf_dir, "part"), [4, 3])
    return frames.pick_columns(kept, [0, 2, 1, 3])


@check(
    "db_rows_to_text",
    """
    SELECT row_number() OVER (ORDER BY o_orderkey) AS rn,
           CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 1000) AS BIGINT) AS page,
           concat_ws(chr(30), CAST(o_orderkey AS VARCHAR),
             CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE replace(o_orderpriority, '-', '') END,
             o_orderstatus) AS line
    FROM orders
    """,
)
def db_rows_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted rows as numbered text lines: nulls spelled out, line breaks cut."""
    broken = F.replace("o_orderpriority", F.lit("-"), F.lit("\r\n"))
    note = F.when(F.col("o_orderstatus") != "P", broken)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", note.alias("note"), "o_orderstatus")
    return jobs.rows_to_lines(rows, ["o_orderkey"], 1000)


@check("text_merge", "SELECT c_name AS value FROM customer UNION ALL SELECT s_name FROM supplier")
def text_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two text outputs merged into files of a wanted size."""
    left, right, merged = (scratch_path(spark, f"text-{i}") for i in range(3))
    table(spark, sf_dir, "customer").select("c_name").write.text(left)
    table(spark, sf_dir, "supplier").select("s_name").write.text(right)
    writers.merge_text(spark, [left, right], merged)
    return spark.read.text(merged)


@check("merge_small_files", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(1 AS BIGINT) AS files FROM supplier")
def merge_small_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight small parquet files merged into one in a new directory."""
    small, merged = scratch_path(spark, "small"), scratch_path(spark, "merged")
    table(spark, sf_dir, "supplier").repartition(8).write.parquet(small)
    writers.merge_small_files(spark, small, merged)
    listed = files.list_files(spark, merged, ".parquet").agg(F.count(F.lit(1)))
    return spark.read.parquet(merged).withColumn("files", listed.scalar())


_FILE_SCHEMA = {
    "fields": [
        {"name": "c_custkey", "type": "bigint"},
        {"name": "c_name", "type": "string"},
        {"name": "c_mktsegment", "type": "string"},
        {"name": "c_acctbal", "type": "double"},
    ]
}


def _land_customers(spark: SparkSession, sf_dir: str, raw_path: str | None = None) -> DataFrame:
    source, landed = scratch_path(spark, "incoming"), scratch_path(spark, "landed")
    balance = F.col("c_acctbal").cast("decimal(15,2)").cast("string")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", balance.alias("c_acctbal"))
    writers.write_lines(people, source, "|^|")
    jobs.land_text_files(
        spark,
        source,
        landed,
        _FILE_SCHEMA,
        "|^|",
        CryptoRules(encryption=(CryptoRule("mdn", (2,)),)),
        CHECK_KEYS,
        delete_columns=[3],
        raw_path=raw_path,
    )
    return spark.read.parquet(landed)


@check("file_landing", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def file_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines to typed parquet with an encrypted and a removed column, then decrypted."""
    return apply_rules(_land_customers(spark, sf_dir), [CryptoRule("mdn", (2,))], CHECK_KEYS, "decryption")


@check(
    "raw_and_protected",
    """
    SELECT c_custkey, true AS sealed, md5(c_name) AS name_md5 FROM customer
    """,
)
def raw_and_protected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw copy and encrypted rows side by side: the raw one is unchanged, the other is sealed."""
    raw_path = scratch_path(spark, "raw")
    landed = _land_customers(spark, sf_dir, raw_path).select("c_custkey", F.col("c_name").alias("cipher"))
    raw = files.split_lines(spark.read.text(raw_path), "|^|", ["key", "c_name"])
    keyed = raw.select(F.col("key").cast("bigint").alias("c_custkey"), "c_name")
    return keyed.join(landed, "c_custkey").select(
        "c_custkey", (F.col("cipher") != F.col("c_name")).alias("sealed"), F.md5("c_name").alias("name_md5")
    )


@check(
    "partition_from_path",
    """
    SELECT event_id, 'd_events' AS db, lower(event_type) AS tb, strftime(ts, '%Y%m%d') AS dt, strftime(ts, '%H') AS hh,
           CASE WHEN event_type = 'view' THEN strftime(ts, '%H%M') ELSE strftime(ts, '%H') || '00' END AS hm,
           CASE WHEN event_type = 'click' THEN '4g' END AS nw
    FROM events
    """,
)
def partition_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition values read from paths; ``event_dt=`` is not ``dt=``, and an hour also gives minutes."""
    kind = F.col("event_type")
    path = F.concat(
        F.lit("/landed/db=D_EVENTS/tb="),
        F.upper(kind),
        F.lit("/event_dt=19990101/dt="),
        F.date_format("ts", "yyyyMMdd"),
        F.lit("/hh="),
        F.date_format("ts", "HH"),
        F.when(kind == "view", F.concat(F.lit("/hm="), F.date_format("ts", "HHmm"))).otherwise(""),
        F.when(kind == "click", "/nw=4g").otherwise(""),
        F.lit("/f.dat"),
    )
    paths = table(spark, sf_dir, "events").select("event_id", path.alias("path"))
    parts = paths.withColumn("p", P.partitions_of(F.col("path")))
    return parts.select(
        "event_id",
        P.database_of(F.col("path")).alias("db"),
        P.table_of(F.col("path")).alias("tb"),
        "p.dt",
        "p.hh",
        "p.hm",
        "p.nw",
    )
