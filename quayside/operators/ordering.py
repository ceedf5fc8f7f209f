"""Row numbers, neighbours and running sums over one total order, in parallel.

A window without partition keys, or with one huge key, puts its rows into one
task. Here the rows are range-partitioned and sorted instead, stored once in the
shared folder with their part number and position, and only one small row per
part (its size, its sum, its first value) is worked out across parts. The order
must be total: give a unique last column, so that no part can be hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import settle

PART, POSITION = "_part", "_position"
_POSITION_BITS = 33
#: One row per part must stay a small table; beyond this, parts grow instead.
MOST_PARTS = 100_000
_UNKNOWN_BYTES = 2**62


#: Planned bytes of one part.
PART_BYTES = 128 * 1024**2


def parts_for(df: DataFrame) -> int:
    """Parts of an ordered table: as many as the tables it reads ask for, and at least the shuffle partitions."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    wanted = -(-sum(s for s in sizes if s < _UNKNOWN_BYTES) // PART_BYTES)
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(least, wanted), MOST_PARTS)


def in_order(df: DataFrame, order_by: Sequence[str | Column], label: str = "ordered") -> DataFrame:
    """``df`` stored in order, with ``_part`` (ordered) and ``_position`` within the part."""
    marker = F.monotonically_increasing_id()
    ordered = (
        df.repartitionByRange(parts_for(df), *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_marker", marker)
        .withColumn(PART, F.shiftright("_marker", _POSITION_BITS).cast("int"))
        .withColumn(POSITION, F.col("_marker").bitwiseAND((1 << _POSITION_BITS) - 1))
        .drop("_marker")
    )
    return settle(ordered, label)


def _across_parts(ordered: DataFrame, *aggregates: Column) -> DataFrame:
    """One row per part: never more rows than tasks of the sort."""
    return ordered.groupBy(PART).agg(*aggregates)


def _with_part_values(ordered: DataFrame, values: DataFrame) -> DataFrame:
    """Put the per-part values on the rows; the side has one row per part."""
    return ordered.join(F.broadcast(values), PART, "left")


def _earlier() -> Window:
    return Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def number_ordered(ordered: DataFrame, name: str = "rn") -> DataFrame:
    """1, 2, 3... over rows from :func:`in_order`."""
    sizes = _across_parts(ordered, F.count(F.lit(1)).alias("_size"))
    starts = sizes.select(PART, F.coalesce(F.sum("_size").over(_earlier()), F.lit(0)).alias("_start"))
    return _with_part_values(ordered, starts).withColumn(name, F.col("_start") + F.col(POSITION) + 1).drop("_start")


def number_rows(df: DataFrame, order_by: Sequence[str | Column], name: str = "rn") -> DataFrame:
    """Row number over the whole of ``df``."""
    return number_ordered(in_order(df, order_by), name).drop(PART, POSITION)


def page_rows(df: DataFrame, order_by: Sequence[str | Column], page_size: int) -> DataFrame:
    """Row number and 0-based page; a full last page is not followed by an empty one."""
    if page_size < 1:
        raise ValueError("a page holds at least one row")
    numbered = number_rows(df, order_by)
    return numbered.withColumn("page", F.floor((F.col("rn") - 1) / page_size).cast("bigint"))


def split_evenly(df: DataFrame, order_by: Sequence[str | Column], parts: int, name: str = "tile") -> DataFrame:
    """Consecutive parts 1..n whose sizes differ by one at most; no row is lost."""
    ordered = in_order(df, order_by)
    sizes = _across_parts(ordered, F.count(F.lit(1)).alias("_size"))
    total = sizes.agg(F.coalesce(F.sum("_size"), F.lit(0))).scalar()
    numbered = number_ordered(ordered, "_rn").withColumn("_total", total)
    base = F.floor(F.col("_total") / parts).cast("bigint")
    extra = F.col("_total") % parts  # the first parts get one row more
    zero_based = F.col("_rn") - 1
    in_long = zero_based < extra * (base + 1)
    long_tile = F.floor(zero_based / (base + 1)) + 1
    short_tile = extra + F.floor((zero_based - extra * (base + 1)) / F.greatest(base, F.lit(1))) + 1
    tile = F.when(in_long, long_tile).otherwise(short_tile).cast("int")
    return numbered.withColumn(name, tile).drop("_rn", "_total", PART, POSITION)


def running_sum(
    df: DataFrame, order_by: Sequence[str | Column], value: str, name: str = "running"
) -> DataFrame:
    """Sum of ``value`` up to and including each row (null counts as 0)."""
    ordered = in_order(df, order_by)
    amount = F.coalesce(F.col(value), F.lit(0))
    sums = _across_parts(ordered, F.sum(amount).alias("_sum"))
    starts = sums.select(PART, F.coalesce(F.sum("_sum").over(_earlier()), F.lit(0)).alias("_start"))
    within = Window.partitionBy(PART).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, 0)
    local = ordered.withColumn("_local", F.sum(amount).over(within))
    return _with_part_values(local, starts).withColumn(name, F.col("_start") + F.col("_local")).drop(
        "_start", "_local", PART, POSITION
    )


def assign_bins(df: DataFrame, order_by: Sequence[str | Column], size: str, budget: int) -> DataFrame:
    """Bins of about ``budget``: the bin a row's last unit falls into, by running size."""
    summed = running_sum(df, order_by, size, "cum_size")
    return summed.withColumn("bin", F.floor((F.greatest(F.col("cum_size"), F.lit(1)) - 1) / budget).cast("bigint"))


def with_next(
    df: DataFrame,
    order_by: Sequence[str | Column],
    value: Column,
    name: str = "next_value",
) -> DataFrame:
    """The next non-null ``value`` in order, over part borders."""
    ordered = in_order(df.withColumn("_value", value), order_by)
    firsts = _across_parts(ordered, F.min_by("_value", F.when(F.col("_value").isNotNull(), F.col(POSITION))).alias("_head"))
    # Backwards frames grow row by row; a frame to the following rows would be rebuilt for each row.
    seen = Window.unboundedPreceding, -1
    heads = firsts.select(
        PART,
        F.last("_head", ignorenulls=True).over(Window.orderBy(F.desc(PART)).rowsBetween(*seen)).alias("_beyond"),
    )
    ahead = Window.partitionBy(PART).orderBy(F.desc(POSITION)).rowsBetween(*seen)
    local = ordered.withColumn("_ahead", F.last("_value", ignorenulls=True).over(ahead))
    return _with_part_values(local, heads).withColumn(name, F.coalesce("_ahead", "_beyond")).drop(
        "_ahead", "_beyond", "_value", PART, POSITION
    )


def number_within(
    df: DataFrame, group: Sequence[str], order_by: Sequence[str | Column], name: str = "seq"
) -> DataFrame:
    """1, 2, 3... within each group; a hot group is spread over many parts.

    Rows are sorted by group, then by ``order_by``, so a group is one run of
    consecutive rows. Its number is the overall row number less the start of the run.
    """
    ordered = number_ordered(in_order(df, [*group, *order_by]), "_rn")
    # One row per group and part; a join on both keys keeps a hot group spread.
    runs = ordered.groupBy(*group, PART).agg(F.min("_rn").alias("_from"))
    starts = runs.groupBy(*group).agg(F.min("_from").alias("_start"))
    spread = join_same(runs, starts, group).select(*group, PART, "_start")
    joined = join_same(ordered, spread, [*group, PART])
    return joined.withColumn(name, F.col("_rn") - F.col("_start") + 1).drop("_rn", "_start", PART, POSITION)


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys where null equals null, so that no row of a null group is lost."""
    renamed = right.withColumnsRenamed({key: f"_same_{key}" for key in keys})
    condition = [F.col(key).eqNullSafe(F.col(f"_same_{key}")) for key in keys]
    return left.join(renamed, condition).drop(*[f"_same_{key}" for key in keys])


def top_by_key(df: DataFrame, value: str, order_by: Sequence[str | Column], count: int, skip: int = 0) -> DataFrame:
    """``count`` non-null values of one column after the first ``skip``, in order.

    Every task keeps ``skip + count`` rows at most, so nothing larger is moved.
    """
    return df.where(F.col(value).isNotNull()).orderBy(*order_by).offset(skip).limit(count)
