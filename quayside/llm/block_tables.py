"""Exact candidate search for 64-bit fingerprints within a Hamming radius.

Cut the bits into ``radius + SHARED`` blocks: two fingerprints within the radius agree in at least ``SHARED`` blocks. One
table for each choice of ``SHARED`` blocks therefore holds every such pair in one of its buckets.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.session import settle

BITS = 64
#: Blocks that form a key; two keep buckets small at billions of fingerprints.
SHARED = 2
#: A larger bucket is cut into parts, and each pair of parts becomes a task's work of its own.
PART_ROWS = 128


def block_masks(radius: int, shared: int = SHARED) -> list[int]:
    """Bit masks of the tables, one for each choice of blocks."""
    if not 0 <= radius <= BITS - shared:
        raise ValueError(f"radius {radius} is out of range")
    blocks = radius + shared
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, shared)]


def signed(value: int) -> int:
    """A 64-bit pattern as Spark's signed long."""
    return value - (1 << BITS) if value >> (BITS - 1) else value


def in_part_pairs(rows: DataFrame, size: str, by: str) -> DataFrame:
    """Rows of groups, dealt to pairs of parts: adds ``bucket_left, bucket_right, in_left``.

    ``size`` holds the rows of the row's group. A group of more than ``PART_ROWS`` is cut by a hash of ``by``, and a row goes
    once to every pair of parts that holds its own. No task then needs more than two parts of a group, and every two rows of
    it meet exactly once: inside a part where left = right, across parts where left < right.
    """
    return (
        rows.withColumn("parts", F.ceil(F.col(size) / PART_ROWS).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64(by), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("bucket_left", F.least("own", "other"))
        .withColumn("bucket_right", F.greatest("own", "other"))
        .withColumn("in_left", F.col("own") <= F.col("other"))
        .drop("parts", "own", "other")
    )


def shared_buckets(prints: DataFrame, radius: int, column: str = "fp") -> DataFrame:
    """``bucket_table, bucket_key, bucket_left, bucket_right, in_left, fp`` for fingerprints that share a bucket.

    ``prints`` has distinct fingerprints. Buckets of one row are left out by a join with the counted keys, and large ones are
    dealt to pairs of parts.
    """
    masks = block_masks(radius)
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(signed(m)).alias("m")) for i, m in enumerate(masks)])
    keyed = (
        prints.select(F.col(column).alias("fp"))
        .select("fp", F.explode(tables).alias("x"))
        .select("fp", F.col("x.t").alias("bucket_table"), F.col("fp").bitwiseAND(F.col("x.m")).alias("bucket_key"))
    )
    sizes = keyed.groupBy("bucket_table", "bucket_key").agg(F.count(F.lit(1)).alias("bucket_rows")).where("bucket_rows > 1")
    found = keyed.join(settle(sizes, "buckets"), ["bucket_table", "bucket_key"])
    return in_part_pairs(found, "bucket_rows", "fp").drop("bucket_rows")


#: What one task must see together.
BUCKET: tuple[str, ...] = ("bucket_table", "bucket_key", "bucket_left", "bucket_right")


def dealt(buckets: DataFrame) -> DataFrame:
    """Each bucket in one task, its rows next to each other."""
    return buckets.repartition(*BUCKET).sortWithinPartitions(*BUCKET, "fp")


def hex_of(column: str) -> Column:
    """16 lower-case hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
