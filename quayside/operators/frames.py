"""Projections, filters and summaries over whole DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import casting as C
from quayside.functions import paths as P
from quayside.functions.crypto import sep_regex


def pick_columns(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Columns by 0-based position."""
    return df.select(*[F.col(f"`{df.columns[i]}`") for i in positions])


def drop_columns(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Columns removed by 1-based position; the order of the positions does not matter."""
    gone = set(positions)
    return df.select(*[F.col(f"`{name}`") for i, name in enumerate(df.columns, start=1) if i not in gone])


def all_strings(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def zoned_timestamps(df: DataFrame, zone: str = "Asia/Seoul") -> DataFrame:
    """All timestamp columns moved from UTC to a zone."""
    stamps = [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({name: C.utc_to_zone(F.col(f"`{name}`").cast("timestamp"), zone) for name in stamps})


def literal_nulls(df: DataFrame) -> DataFrame:
    """The word ``null`` in string columns becomes a null."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: C.literal_null_to_null(F.col(f"`{name}`")) for name in texts})


#: Fixed value: the end of the name of a column that holds EUC-KR bytes as hex digits.
EUC_KR_MARK = "DECODE_TO_EUC_KR"


def decode_marked(df: DataFrame) -> DataFrame:
    """Extracted bytes as text: hex columns whose name ends with the EUC-KR mark, in any case, and binary ones as UTF-8.

    Names and order stay. Text that is no hex becomes null.
    """

    def decoded(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if field.name.upper().endswith(EUC_KR_MARK):
            return C.hex_to_text(value.cast("string"), "EUC-KR").alias(field.name)
        return F.decode(value, "UTF-8").alias(field.name) if isinstance(field.dataType, T.BinaryType) else value

    return df.select(*map(decoded, df.schema))


def drop_matching(df: DataFrame, column: str, pattern: str | None) -> DataFrame:
    """Rows whose text matches are dropped; without a pattern all stay."""
    if not pattern:
        return df
    return df.where(~F.col(column).rlike(pattern))


def data_paths(listing: DataFrame, path: str = "path") -> DataFrame:
    return listing.where(~F.col(path).contains("_SUCCESS"))


def active_rows(df: DataFrame, flag: str, identifier: str, test_mark: str = "%-TEST-%") -> DataFrame:
    return df.where((F.col(flag) == "Y") & ~F.col(identifier).like(test_mark))


def concat_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def first_seen(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The earliest row per key, as a partial aggregate: a hot key is reduced before it is moved."""
    kept = df.groupBy(*keys).agg(F.min_by(F.struct("*"), order).alias("_row"))
    return kept.select("_row.*")


def distinct_parents(listing: DataFrame, path: str = "path") -> DataFrame:
    return listing.select(P.parent(F.col(path)).alias("directory")).distinct()


def size_summary(listing: DataFrame, length: str = "length", threshold: int = 10 * 1024 * 1024) -> DataFrame:
    """Count, total and average size, with the decision for large files."""
    summed = listing.agg(
        F.count(F.lit(1)).alias("files"), F.sum(length).alias("total_bytes"), F.avg(length).alias("avg_bytes")
    )
    return summed.withColumn("large", F.col("avg_bytes") >= threshold)


def status_summary(attempts: DataFrame, status: str, success: str, size: str) -> DataFrame:
    """Successes, all attempts and converted bytes; failed rows count 0 bytes."""
    good = F.col(status) == success
    return attempts.agg(
        F.count_if(good).alias("succeeded"),
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(good, F.col(size)).otherwise(0)).alias("converted_bytes"),
    )


def repeated_runs(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return runs.groupBy(*keys).agg(F.count(F.lit(1)).alias("runs")).where(F.col("runs") > 1)


def to_long(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key and column: name, 0-based index, value as text."""
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.lit(i).alias("index"), F.col(name).cast("string").alias("value"))
            for i, name in enumerate(columns)
        ]
    )
    return df.select(*keys, F.explode(cells).alias("_cell")).select(*keys, "_cell.*")


def parse_record(df: DataFrame, column: str, names: Sequence[str], sep: str = ",") -> DataFrame:
    """A separated text column as named fields."""
    fields = F.split(F.col(column), sep_regex(sep), -1)
    return df.select(*[F.get(fields, F.lit(i)).alias(name) for i, name in enumerate(names)])


def listed_matches(matches: DataFrame, table: str, index: str, columns: Sequence[str], chunk: int = 100) -> DataFrame:
    """Column matches per table as ordered lists of at most ``chunk`` entries.

    Lists are cut by column index, so a very wide table gives several rows
    instead of one unbounded list.
    """
    grouped = matches.groupBy(table, F.floor(F.col(index) / chunk).cast("bigint").alias("chunk"))
    return grouped.agg(F.sort_array(F.collect_list(F.struct(index, *columns))).alias("matches"))
