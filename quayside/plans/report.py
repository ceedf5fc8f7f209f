"""Counts of a job, observed while its result is written."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Report:
    """Where a result is, how many rows it has, and how many values each column lost."""

    path: str
    rows: int
    failed: Mapping[str, int] = field(default_factory=dict)

    @property
    def failures(self) -> int:
        return sum(self.failed.values())


def watched(df: DataFrame, failures: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with its row count and failure counts taken in the same pass."""
    seen = Observation()
    counts = [F.count_if(F.coalesce(bad, F.lit(False))).alias(f"failed_{name}") for name, bad in failures.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def report(path: str, seen: Observation) -> Report:
    found = seen.get
    failed = {k.removeprefix("failed_"): v for k, v in found.items() if k.startswith("failed_")}
    return Report(path, found["rows"], failed)
