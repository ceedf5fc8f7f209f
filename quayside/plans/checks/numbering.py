"""Row numbers, pages, even parts, bins and neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import matching, ordering, ranges
from quayside.plans.registry import check, table

URL_PATH = r"^https?://[^?#]*"


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of the pages, their site directories and a success marker per site."""
    url = F.regexp_replace(F.regexp_extract("url", URL_PATH, 0), "^https?:/|/$", "")
    leaf = table(spark, sf_dir, "pages").select(url.alias("path"))
    site = leaf.select(F.regexp_extract("path", "^/[^/]+", 0).alias("path"))
    marker = site.select(F.concat("path", F.lit("/_SUCCESS")).alias("path"))
    return leaf.unionByName(site).unionByName(marker).distinct()


_PATHS_SQL = """
    WITH leaf AS (SELECT regexp_replace(regexp_replace(regexp_extract(url, '^https?://[^?#]*'), '^https?:/', ''), '/$', '') AS path FROM pages),
    site AS (SELECT regexp_extract(path, '^/[^/]+') AS path FROM leaf),
    paths AS (SELECT path FROM leaf UNION SELECT path FROM site UNION SELECT path || '/_SUCCESS' FROM site)
"""


@check(
    "leaf_paths",
    _PATHS_SQL
    + """
    , listed AS (SELECT path FROM paths UNION SELECT path || '-old/x' FROM site)
    SELECT path FROM listed l WHERE NOT ends_with(path, '/_SUCCESS')
      AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT regexp_extract(path, '^(.*)/[^/]+$', 1) AS above FROM listed) p
                      WHERE p.above = l.path OR starts_with(p.above, l.path || '/'))
    """,
)
def leaf_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves of the page paths and of sibling directories whose names sort between a path and what lies below it."""
    listed = page_paths(spark, sf_dir)
    siblings = listed.select(F.concat(F.regexp_extract("path", "^/[^/]+", 0), F.lit("-old/x")).alias("path"))
    return matching.leaf_paths(listed.unionByName(siblings), "path")


@check(
    "first_match_prefix",
    _PATHS_SQL
    + """
    , bases AS (SELECT DISTINCT path || '/' || 'e' AS base FROM site)
    SELECT base, min(path) AS first_path FROM bases JOIN paths ON starts_with(path, base) GROUP BY base
    """,
)
def first_match_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each base path with the first listed path that starts with it."""
    listed = page_paths(spark, sf_dir)
    bases = listed.where(~F.col("path").rlike("^/[^/]+/")).select(F.concat("path", F.lit("/e")).alias("base"))
    return matching.first_with_prefix(bases, "base", listed, "path")


@check(
    "row_pages",
    """
    SELECT o_orderkey, o_custkey, rn, CAST(floor((rn - 1) / 5000) AS BIGINT) AS page
    FROM (SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS rn FROM orders)
    """,
)
def row_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return ordering.page_rows(orders, ["o_custkey", "o_orderkey"], 5000)


_LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@check(
    "split_even",
    f"""
    SELECT tile, count(*) AS rows, min(l_shipdate)::VARCHAR AS first_day, CAST(sum(l_orderkey) AS BIGINT) AS key_sum
    FROM (SELECT l_shipdate, l_orderkey, CAST(ntile(7) OVER (ORDER BY {', '.join(_LINE_ORDER)}) AS INTEGER) AS tile FROM lineitem)
    GROUP BY tile
    """,
)
def split_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items cut into seven consecutive parts of even size, none lost."""
    tiled = ordering.split_evenly(table(spark, sf_dir, "lineitem").select(*_LINE_ORDER), _LINE_ORDER, 7)
    return tiled.groupBy("tile").agg(
        F.count(F.lit(1)).alias("rows"),
        F.date_format(F.min("l_shipdate"), "yyyy-MM-dd HH:mm:ss").alias("first_day"),
        F.sum("l_orderkey").alias("key_sum"),
    )


@check(
    "size_bins",
    """
    SELECT doc_id, cum_size, CAST(floor((cum_size - 1) / 100000) AS BIGINT) AS bin
    FROM (SELECT doc_id, CAST(sum(n_chars) OVER (ORDER BY source, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_size FROM documents)
    """,
)
def size_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed, in order, into bins of 100,000 characters."""
    sizes = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return ordering.assign_bins(sizes, ["source", "doc_id"], "n_chars", 100_000).select("doc_id", "cum_size", "bin")


@check(
    "file_sequence",
    """
    SELECT event_id, event_type || '_' || row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) || '.zstd.parquet' AS name
    FROM events
    """,
)
def file_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence numbers within each base name."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    numbered = ordering.number_within(events, ["event_type"], ["ts", "event_id"])
    name = F.concat("event_type", F.lit("_"), F.col("seq").cast("string"), F.lit(".zstd.parquet"))
    return numbered.select("event_id", name.alias("name"))


@check(
    "next_event",
    """
    SELECT event_id, lead(CASE WHEN event_type = 'error' THEN event_id END IGNORE NULLS) OVER (ORDER BY ts, event_id) AS next_error
    FROM events
    """,
)
def next_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next error after each event: the neighbour search behind path matching, over the whole table."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    error = F.when(F.col("event_type") == "error", F.col("event_id"))
    return ordering.with_next(events, ["ts", "event_id"], error, "next_error").select("event_id", "next_error")


_RANGE_ROWS = 5000
_SKEWED = "CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_suppkey END"


@check(
    "key_range_pages",
    f"""
    SELECT page_key, count(*) AS rows, CAST(sum(l_linenumber) AS BIGINT) AS line_sum, true AS even
    FROM (SELECT {_SKEWED} AS page_key, l_linenumber FROM lineitem) GROUP BY page_key
    """,
)
def key_range_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in pages by ranges of a key of which one value holds a third of them: none lost, none twice, no page too large."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.expr(_SKEWED).cast("bigint").alias("page_key"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line"), "l_linenumber"
    )
    borders = ranges.key_borders(rows, "page_key", "line", _RANGE_ROWS)
    paged = ranges.with_page(rows, borders, "page_key", "line")
    cells = paged.groupBy("page_key", "page").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"))
    largest = cells.groupBy("page").agg(F.sum("n").alias("n")).agg(F.max("n") <= 2.1 * _RANGE_ROWS).scalar()
    return cells.groupBy("page_key").agg(F.sum("n").alias("rows"), F.sum("lines").alias("line_sum")).withColumn("even", largest)
