"""Pages of about equal size by ranges of a key, for readers that take one predicate for each task.

Borders come from one mergeable quantile sketch of the key. A value that fills more than a page by itself is cut again by
quantiles of a second key. Ranges are half-open and in the order of (key, second), so each row is in exactly one.
"""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.ordering import running_sum

#: A border: rows from this key on, or from this key and second key on.
Border = tuple[object, object]
#: Ranks of the sketch are off by a hundredth of a page at most, up to the last of these accuracies.
PAGE_ACCURACY, MOST_ACCURACY = 100, 10_000_000


def _fractions(parts: int) -> list[float]:
    return [i / parts for i in range(1, parts)]


def key_borders(rows: DataFrame, key: str, second: str, page_rows: int) -> list[Border]:
    """Ascending borders between pages of about ``page_rows``; no border for an empty table or a single page.

    ``key`` and ``second`` are whole numbers, decimals, dates or timestamps. Null keys belong to the first page, null second keys to
    the first page of their key. A page has up to about twice ``page_rows``, more only if one pair of keys repeats so often.
    The driver gets the borders: about two for each page.
    """
    if page_rows < 1:
        raise ValueError("a page holds at least one row")
    known = rows.select(F.col(key).alias("k"), F.col(second).alias("s")).where("k IS NOT NULL")
    pages = -(-known.count() // page_rows)
    if pages < 2:
        return []
    accuracy = min(PAGE_ACCURACY * pages, MOST_ACCURACY)
    bounds = known.agg(F.percentile_approx("k", _fractions(pages), accuracy).alias("b")).first().b
    often = sorted({a for a, b in zip(bounds, bounds[1:]) if a == b})
    return sorted({(b, None) for b in bounds} | _inner_borders(known, often, page_rows), key=_place)


def _place(border: Border):
    return border[0], border[1] is not None, border[1] if border[1] is not None else 0


def _inner_borders(known: DataFrame, often: Sequence, page_rows: int) -> set[Border]:
    """Borders inside the keys that fill pages by themselves, one sketch for each such key."""
    if not often:
        return set()
    spark = known.sparkSession
    hot = spark.createDataFrame([(b,) for b in often], known.select("k").schema)  # fewer than half the pages
    theirs = known.join(F.broadcast(hot), "k")
    sizes = theirs.groupBy("k").agg(F.count("s").alias("n"))
    most = -(-sizes.agg(F.max("n")).first()[0] // page_rows)
    if most < 2:
        return set()
    # A grid for the most frequent key; the others take the points next to theirs, less than half a page away.
    cut = theirs.groupBy("k").agg(
        F.count("s").alias("n"),
        F.percentile_approx("s", _fractions(most), min(PAGE_ACCURACY * most, MOST_ACCURACY)).alias("grid"),
    )
    parts = F.ceil(F.col("n") / page_rows).cast("int")
    points = F.transform(F.sequence(F.lit(1), parts - 1), lambda j: F.greatest(F.lit(1), F.round(j * most / parts).cast("int")))
    inner = cut.where((parts > 1) & F.col("grid").isNotNull()).select("k", F.explode(points).alias("at"), "grid")
    return {(r.k, r.s) for r in inner.select("k", F.element_at("grid", F.col("at")).alias("s")).collect()}


def _literal(value: object) -> str:
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, (int, decimal.Decimal)) and not isinstance(value, bool):
        return str(value)
    raise TypeError(f"keys of type {type(value).__name__} cannot be cut into ranges")


def range_predicates(borders: Sequence[Border], key: str, second: str) -> list[str]:
    """One SQL condition for each page, in order; together they hold for each row once, null keys included."""

    def before(border: Border) -> str:
        k, s = border[0], border[1]
        if s is None:
            return f"{key} < {_literal(k)}"
        return f"({key} < {_literal(k)} OR ({key} = {_literal(k)} AND ({second} < {_literal(s)} OR {second} IS NULL)))"

    def onwards(border: Border) -> str:
        k, s = border[0], border[1]
        if s is None:
            return f"{key} >= {_literal(k)}"
        return f"({key} > {_literal(k)} OR ({key} = {_literal(k)} AND {second} >= {_literal(s)}))"

    if not borders:
        return ["1 = 1"]
    inner = [f"{onwards(a)} AND {before(b)}" for a, b in zip(borders, borders[1:])]
    return [f"({before(borders[0])} OR {key} IS NULL)", *inner, onwards(borders[-1])]


def with_page(rows: DataFrame, borders: Sequence[Border], key: str, second: str, name: str = "page") -> DataFrame:
    """``rows`` with the 0-based page of each: borders and rows in one order, and the running count of the borders."""
    if not borders:
        return rows.withColumn(name, F.lit(0).cast("bigint"))
    keys = rows.select(F.col(key).alias("k"), F.col(second).alias("s")).schema
    for field in keys:
        field.nullable = True
    held = rows.select(F.col(key).alias("k"), F.col(second).alias("s"), F.struct(*rows.columns).alias("r"), F.lit(0).alias("border"))
    marks = rows.sparkSession.createDataFrame(list(borders), keys)
    marks = marks.withColumns({"r": F.lit(None).cast(held.schema["r"].dataType), "border": F.lit(1)})
    # A border without a second key comes before all rows of its key; nulls come first.
    order = [F.col("k").asc_nulls_first(), F.col("s").asc_nulls_first(), F.desc("border"), F.xxhash64("r")]
    placed = running_sum(marks.unionByName(held), order, "border", "below").where("border = 0")
    return placed.select("r.*", F.col("below").cast("bigint").alias(name))

