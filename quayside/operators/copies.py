"""Where two copies of a table differ, found by a tree of hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.matching import small_side
from quayside.operators.ordering import join_same
from quayside.session import settle

BUCKETS = 1024
#: Rows of a copy for each bucket of a partition beyond that, and the most buckets, as the unequal ones are looked up by each task.
BUCKET_ROWS, MOST_BUCKETS = 512, 128 * 1024
_SUMS = ("rows", "low_0", "low_1", "high_0", "high_1")


def _row_sums(columns: Sequence[str], within: str = "") -> list[Column]:
    """Commutative sums over rows: two halves of a digest that tells nulls from values and one value from the next.

    Each half of 60 bits is summed in two parts, so that sums of 2^33 rows are whole numbers of 64 bits.
    """

    def tagged(name: str) -> Column:
        text = F.col(f"{within}`{name}`").cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    digest = F.sha2(F.concat(*map(tagged, columns)), 256)
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint").alias(name) for name, at in (("low", 1), ("high", 16))]


def _branches(df: DataFrame, by: Sequence[str]) -> DataFrame:
    parts = [
        F.sum(part).alias(f"{half}_{n}")
        for half in ("low", "high")
        for n, part in enumerate((F.col(half).bitwiseAND(2**30 - 1), F.shiftright(half, 30)))
    ]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *parts)


def _unequal(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Branches whose sums are not the same on both sides, with the rows of each."""
    both = left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(-1)))
    net = [F.sum(F.col(s) * F.col("side")).alias(f"net_{s}") for s in _SUMS]
    sides = [F.sum(F.when(F.col("side") == n, F.col("rows")).otherwise(0)).alias(name) for n, name in ((1, "left_rows"), (-1, "right_rows"))]
    return both.groupBy(*by).agg(*net, *sides).where(" OR ".join(f"net_{s} <> 0" for s in _SUMS)).select(*by, "left_rows", "right_rows")


def buckets_for(rows: int) -> int:
    """Buckets of a partition for a copy of so many rows: with more rows a bucket, each would hold a difference and all be read again."""
    return min(max(BUCKETS, rows // BUCKET_ROWS), MOST_BUCKETS)


def unequal_buckets(left: DataFrame, right: DataFrame, partition: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``partition, bucket, left_rows, right_rows`` of the buckets of keys in which the copies differ, stored.

    Each side is read once and summed up by partition and bucket before anything is shuffled: at most one row per task, partition
    and bucket. Sums do not depend on order, so files and tasks may be cut differently on both sides.
    """
    columns = sorted(left.columns)
    if columns != sorted(right.columns):
        raise ValueError("the copies have different columns")

    def summed(side: DataFrame) -> DataFrame:
        marked = side.select(F.col(f"`{partition}`").alias("part"), _bucket(keys, buckets).alias("bucket"), *_row_sums(columns))
        return _branches(marked, ["part", "bucket"])

    return settle(_unequal(summed(left), summed(right), ["part", "bucket"]), "unequal")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def differing_keys(left: DataFrame, right: DataFrame, partition: str, keys: Sequence[str], buckets: int = BUCKETS, found: DataFrame | None = None) -> DataFrame:
    """``part, keys..., change`` for every key at which the copies differ: ``added``, ``removed`` or ``changed`` on the right.

    Only the unequal partitions and buckets are read again, the former as a filter that prunes partitioned tables, and only
    their rows are shuffled. A key that is repeated differs if its rows together do.
    """
    found = unequal_buckets(left, right, partition, keys, buckets) if found is None else found
    columns = sorted(left.columns)
    places = found.select("part").distinct().limit(1001).collect()
    pruned = F.lit(True) if len(places) > 1000 else _any_of(F.col(f"`{partition}`"), [r["part"] for r in places])

    def again(side: DataFrame) -> DataFrame:
        names = [f"key_{i}" for i in range(len(keys))]
        rows = side.where(pruned).select(
            F.col(f"`{partition}`").alias("part"),
            _bucket(keys, buckets).alias("bucket"),
            *[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)],
            F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        )
        inside = join_same(rows, small_side(found.select("part", "bucket")), ["part", "bucket"])
        return _branches(inside.select("part", *names, *_row_sums(columns, "row.")), ["part", *names])

    names = [f"key_{i}" for i in range(len(keys))]
    differing = _unequal(again(left), again(right), ["part", *names])
    change = F.when(F.col("left_rows") == 0, "added").when(F.col("right_rows") == 0, "removed").otherwise("changed")
    return differing.select("part", *[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], change.alias("change"))


def _any_of(column: Column, values: Sequence) -> Column:
    known = [v for v in values if v is not None]
    wanted = column.isin(known) if known else F.lit(False)
    return (wanted | column.isNull()) if len(known) < len(values) else wanted
