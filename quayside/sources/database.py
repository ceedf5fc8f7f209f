"""Extraction from relational databases over JDBC, page by page."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from quayside.operators.ranges import key_borders, range_predicates
from quayside.session import settle
from quayside.sources.files import MissingConnector


def fill_query(query: str, params: Sequence[str]) -> str:
    """Each ``#`` of a query replaced by the next parameter."""
    pieces = query.split("#")
    if len(pieces) != len(params) + 1:
        raise ValueError(f"the query has {len(pieces) - 1} places for {len(params)} parameters")
    filled = pieces[0]
    for param, rest in zip(params, pieces[1:]):
        filled += str(param) + rest
    return filled


def page_ranges(row_count: int, page_rows: int) -> list[tuple[int, int]]:
    """Row ranges ``(after, up to]`` that cover all rows, without an empty last page."""
    if page_rows <= 0:
        return [(0, row_count)]
    return [(start, min(start + page_rows, row_count)) for start in range(0, row_count, page_rows)]


def _read(load: Callable[[], DataFrame]) -> DataFrame:
    try:
        return load()
    except Exception as error:
        if "No suitable driver" in str(error) or "ClassNotFoundException" in str(error):
            raise MissingConnector("the JDBC driver of this database is not on the class path") from error
        raise


def count_rows(spark: SparkSession, options: Mapping[str, str], query: str) -> int:
    """Number of rows the database would return."""
    probe = f"(SELECT count(*) AS n FROM ({query}) q) c"
    return int(_read(lambda: spark.read.format("jdbc").options(**options).option("dbtable", probe).load()).first()[0])


def extract(
    spark: SparkSession, options: Mapping[str, str], query: str, order_by: str, page_rows: int = 0
) -> DataFrame:
    """Rows of a query; pages are numbered by ``order_by`` in the database and read in parallel.

    ``options`` are JDBC options (url, user, driver...). The driver jar must be on the class path.
    """
    if page_rows <= 0:
        return _read(lambda: spark.read.format("jdbc").options(**options).option("dbtable", f"({query}) q").load())
    numbered = f"(SELECT q.*, ROW_NUMBER() OVER (ORDER BY {order_by}) AS rn FROM ({query}) q) p"
    pages = page_ranges(count_rows(spark, options, query), page_rows)
    predicates = [f"rn > {after} AND rn <= {upto}" for after, upto in pages] or ["1 = 0"]
    url = options["url"]
    rest = {k: v for k, v in options.items() if k != "url"}
    return _read(lambda: spark.read.jdbc(url, numbered, predicates=predicates, properties=rest)).drop("rn")


def extract_by_key(
    spark: SparkSession, options: Mapping[str, str], query: str, key: str, second: str, page_rows: int
) -> DataFrame:
    """Rows of a query in pages by ranges of ``key``, each read by a condition that an index on the key can answer.

    Only the two keys are read beforehand, for the borders; the database numbers nothing. See :func:`ranges.key_borders`.
    """
    keys = f"(SELECT q.{key}, q.{second} FROM ({query}) q) k"
    known = settle(_read(lambda: spark.read.format("jdbc").options(**options).option("dbtable", keys).load()), "keys")
    predicates = range_predicates(key_borders(known, key, second, page_rows), key, second)
    rest = {k: v for k, v in options.items() if k != "url"}
    return _read(lambda: spark.read.jdbc(options["url"], f"({query}) q", predicates=predicates, properties=rest))
