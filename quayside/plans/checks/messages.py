"""Bounded message consumption, driven from a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.plans.registry import check, table
from quayside.session import scratch_path
from quayside.streaming.messages import consume, file_messages

_SCHEMA = {
    "fields": [
        {"name": "event_id", "type": "bigint"},
        {"name": "event_type", "type": "string"},
        {"name": "user_id", "type": "int"},
        {"name": "ts", "type": "timestamp"},
    ]
}


def _event_messages(spark: SparkSession, sf_dir: str, sep: str) -> DataFrame:
    """Each event as one text message."""
    path = f"{sf_dir}/events.parque[t]"  # a glob takes one file as well as a directory
    message = F.concat_ws(
        sep,
        F.col("event_id").cast("string"),
        "event_type",
        F.when(F.col("event_type") == "click", "x").otherwise(F.col("user_id").cast("string")),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    )
    return file_messages(spark, path, table(spark, sf_dir, "events").schema, message)


@check(
    "stream_filter",
    """
    SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN NULL ELSE CAST(user_id AS INTEGER) END AS user_id
    FROM events WHERE event_type NOT IN ('error', 'view')
    """,
)
def stream_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that match the pattern are dropped; the rest lands typed."""
    path = scratch_path(spark, "stream")
    consume(_event_messages(spark, sf_dir, "\x1e"), _SCHEMA, path, scratch_path(spark, "offsets"), drop_pattern="\x1e(error|view)\x1e")
    return spark.read.parquet(path).select("event_id", "event_type", "user_id")


@check(
    "consume_bounded",
    """
    SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, strftime(ts, '%Y%m%d') AS dt FROM events
    """,
)
def consume_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages present, landed in day partitions; a second run with the same offsets adds nothing."""
    path, offsets = scratch_path(spark, "landed"), scratch_path(spark, "offsets")
    parts = {"dt": F.date_format("ts", "yyyyMMdd")}
    for _ in range(2):
        consume(_event_messages(spark, sf_dir, "|"), _SCHEMA, path, offsets, sep="|", partitions=parts)
    landed = spark.read.parquet(path)
    return landed.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).select("event_id", "event_type", "ts", "dt")
