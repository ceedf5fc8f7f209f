"""Text files packed into bins of bytes: small ones together, large ones cut at line ends."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A task costs far more than a small file, so it writes many bins up to this size; it reads about so many bytes.
SMALL_BIN, TASK_BYTES = 1024**2, 8 * 1024**2
_LINES_A_BATCH = 256


@contextmanager
def _planned(spark: SparkSession, **settings: str):
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def bin_text(spark: SparkSession, paths: Sequence[str], path: str, budget: int) -> DataFrame:
    """Lines of ``paths`` in files of at most about ``budget`` bytes below ``path``; returns ``bin, lines, bytes`` of each.

    The scan plans (file, offset, length) pieces from the listing alone, packs them into tasks, and each task streams
    its pieces: it reads a little beyond a cut to the end of the line there, and a piece that does not begin a file
    passes over the line the piece before has read. So no line is lost or cut, and nothing is shuffled. Compressed files
    cannot be cut and are one piece each. A task is a bin, which exceeds the budget by one line a piece at most; with a budget
    up to ``SMALL_BIN`` a task packs its lines into many bins, and only a line longer than the budget exceeds it.
    """
    small = budget <= SMALL_BIN
    with _planned(
        spark,
        **{
            "spark.sql.files.maxPartitionBytes": str(max(budget, TASK_BYTES) if small else budget),
            "spark.sql.files.openCostInBytes": "0",
            "spark.sql.files.minPartitionNum": "1",
            "spark.sql.execution.arrow.maxRecordsPerBatch": str(_LINES_A_BATCH),
        },
    ):
        lines = spark.read.option("lineSep", "\n").text(list(paths)).select("value")
        if small:  # a bin is one record, and a record is one file
            packed = lines.select(F.col("value").cast("binary")).mapInArrow(_packer(budget), "value binary")
            packed.select(F.col("value").cast("string")).write.mode("overwrite").option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)
        else:
            lines.write.mode("overwrite").option("lineSep", "\n").text(path)
    return bin_sizes(spark, path)


def _packer(budget: int):
    """Joins lines, which come in order, to records of at most ``budget`` bytes with their line breaks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def record() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"\n".join(held)], pa.binary())], ["value"])

        for batch in batches:
            for line in batch.column(0).to_pylist():
                if held and size + len(line) + 1 > budget:
                    yield record()
                    held, size = [], 0
                held.append(line)
                size += len(line) + 1
        if held:
            yield record()

    return pack


def bin_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``bin, lines, bytes`` of the files below ``path``; bytes count the line breaks."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_name").alias("bin"), F.octet_length("value").alias("n"))
    return lines.groupBy("bin").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.col("n") + 1).alias("bytes"))
