"""Registry of the checked queries: a Spark plan and, where SQL can say it, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from quayside.config import CipherKeys
from quayside.session import configure
from quayside.sources.files import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Made-up keys for checks and benchmarks only.
CHECK_KEYS = CipherKeys(
    {"imsi": "imsi-check-key-1", "mdn": "mdn--check-key-2", "enb": "enb--check-key-3", "svrcd": "svrcdcheck-key-4"}
)
CHECK_HOME = "99901"


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``."""

    def register(query: Query) -> Query:
        @wraps(query)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(configure(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str, wide: bool = False) -> DataFrame:
    """A given table; ``wide`` spreads a scan of few tasks over all cores, for costly expressions."""
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(frame) if wide else frame
