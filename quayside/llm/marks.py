"""Places of pattern matches in a text, with built-in functions only, and names that meet no other."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands around matches; where a text has it, its stand-in is searched instead. Patterns must match neither.
MARK, STAND_IN = "\ue000", "\ue001"
SPANS = "array<struct<start:int,end:int,value:string>>"


def searchable(text: Column) -> Column:
    """The text without marks, of the same length; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), MARK, STAND_IN)


def pieces(text: Column, pattern: str) -> Column:
    """Text before, match, text between, match, ... of the leftmost matches that do not overlap."""
    return F.split(F.regexp_replace(text, F.lit(pattern), F.lit(f"{MARK}$0{MARK}")), MARK, -1)


def spans(found: Column) -> Column:
    """Start, end (exclusive, in code points) and value of each match among ``pieces``."""
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.array().cast(SPANS).alias("out"))

    def add(state: Column, piece: Column) -> Column:
        end = (state["at"] + F.length(piece)).cast("int")
        span = F.struct(state["at"].alias("start"), end.alias("end"), piece.alias("value"))
        out = F.when(state["inside"], F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct(end.alias("at"), (~state["inside"]).alias("inside"), out.alias("out"))

    return F.aggregate(found, start, add, lambda state: state["out"])


def matches(text: Column, pattern: str, hint: str | None = None) -> Column:
    """``spans`` of a pattern; texts without a match are not taken apart.

    ``hint`` is a cheap pattern that stands in every match; a text without it is not searched further.
    """
    found = F.rlike(text, F.lit(pattern))
    if hint is not None:
        found = F.rlike(text, F.lit(hint)) & found
    return F.when(found, spans(pieces(text, pattern))).otherwise(F.array().cast(SPANS))


class Shield:
    """A table whose columns have numbered names while an operator adds its own, so that none can meet another."""

    def __init__(self, docs: DataFrame, **more: Column):
        """``more`` are columns worked out from ``docs`` under its own names."""
        self.names = docs.columns
        self.inner = docs.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(self.names)], *[v.alias(n) for n, v in more.items()])

    def inner_name(self, column: str | None) -> str | None:
        """The number of a column; None if there is no such column."""
        return f"in_{self.names.index(column)}" if column in self.names else None

    def restored(self, rows: DataFrame, changes: Mapping[str, Column], added: Mapping[str, Column] | None = None) -> DataFrame:
        """The columns under their names and in their order, with ``changes``; ``added`` ones follow, in place of any of the same name."""
        added = added or {}
        kept = [(changes[c] if c in changes else F.col(f"in_{i}")).alias(c) for i, c in enumerate(self.names) if c not in added]
        return rows.select(*kept, *[value.alias(name) for name, value in added.items()])
