"""Bounded consumption of message streams into partitioned parquet."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quayside.config import UNIT_SEPARATOR
from quayside.functions.crypto import sep_regex
from quayside.operators.frames import drop_matching
from quayside.schema import fields_of
from quayside.sources.files import MissingConnector, typed_columns

#: Messages of one partition in one micro-batch.
BATCH_MESSAGES = 100_000
#: How often a query that waits for messages looks for them.
POLL_MILLIS = 200


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, partitions: int, starting: str = "earliest", batch: int = BATCH_MESSAGES
) -> DataFrame:
    """Message texts of a topic, at most ``batch`` for each of its partitions at a time.

    Offsets are kept by the query's checkpoint; ``starting`` counts for its first run only.
    """
    try:
        source = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .option("maxOffsetsPerTrigger", batch * partitions)
            .load()
        )
    except Exception as error:
        if "kafka" in str(error).lower():
            raise MissingConnector("Kafka needs the spark-sql-kafka package") from error
        raise
    return source.select(F.col("value").cast("string").alias("value"))


def file_messages(
    spark: SparkSession, path: str, schema: T.StructType, message: Column, fmt: str = "parquet", files: int = 1000
) -> DataFrame:
    """The same message shape from files that arrive in a directory."""
    source = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files).load(path)
    return source.select(message.alias("value"))


def parsed_messages(messages: DataFrame, schema: Mapping | str, sep: str = UNIT_SEPARATOR) -> DataFrame:
    """Message texts to the declared typed columns; fields that do not parse are null."""
    names = [name for name, _ in fields_of(schema)]
    fields = F.split(F.col("value"), sep_regex(sep), -1)
    text = messages.select(*[F.get(fields, F.lit(i)).alias(name) for i, name in enumerate(names)])
    return typed_columns(text, schema)


def consume(
    messages: DataFrame,
    schema: Mapping | str,
    path: str,
    checkpoint: str,
    drop_pattern: str | None = None,
    sep: str = UNIT_SEPARATOR,
    partitions: Mapping[str, Column] | None = None,
    idle_seconds: float | None = None,
) -> int:
    """Take all messages present now, drop the matching ones and land the rest as parquet; returns how many were taken.

    With ``idle_seconds`` messages that arrive meanwhile are taken too, until none has come for so long; a batch that has
    begun is always finished and committed before the end.

    The checkpoint and the file sink's log make a restart continue where the last
    run ended, without losing or repeating a message; it must therefore outlive the run.
    """
    if not checkpoint:
        raise ValueError("a checkpoint folder is needed")
    kept = parsed_messages(drop_matching(messages, "value", drop_pattern), schema, sep)
    keys: Sequence[str] = tuple(partitions or {})
    if partitions:
        # Rows of one partition meet, so that no task opens every directory; rebalancing splits a hot one.
        kept = kept.withColumns(dict(partitions)).hint("rebalance", *[F.col(k) for k in keys])
    writer = (
        kept.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if keys:
        writer = writer.partitionBy(*keys)
    if idle_seconds is None:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return _taken(query, -1)[0]
    query = writer.trigger(processingTime=f"{POLL_MILLIS} milliseconds").start()
    taken, batch, quiet_since = 0, -1, time.monotonic()
    while query.isActive and time.monotonic() - quiet_since < idle_seconds:
        query.awaitTermination(POLL_MILLIS / 1000)  # raises what ended the query
        more, batch = _taken(query, batch)
        taken += more
        if more or query.status["isDataAvailable"]:
            quiet_since = time.monotonic()
    query.processAllAvailable()  # a batch under way is committed, not cut off
    more, batch = _taken(query, batch)
    query.stop()
    return taken + more


def _taken(query: StreamingQuery, after: int) -> tuple[int, int]:
    """Messages of the batches that ended after batch ``after``, and the last of these."""
    fresh = [p for p in query.recentProgress if p["batchId"] > after and p["numInputRows"]]
    return sum(p["numInputRows"] for p in fresh), max((p["batchId"] for p in fresh), default=after)
