"""Sensitive columns, samples, shapes and completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import text as X
from quayside.functions.crypto import base64_text
from quayside.operators import frames, governance
from quayside.plans.registry import check, table
from quayside.sources.files import format_of

_TOKENS = ("cdr", "ring")


def _name() -> Column:
    return F.replace("p_name", F.lit(" "), F.lit("_"))


def schema_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One declared schema of three columns per part."""

    def declared(name: Column, kind: Column) -> Column:
        return F.struct(name.alias("name"), kind.alias("type"))

    first = declared(_name(), F.when(F.col("p_type") == "SMALL", "int").otherwise("string"))
    second = declared(F.when(F.col("p_size") < 10, "x_cdr").otherwise("cdrx"), F.lit("string"))
    third = declared(F.lit("lat"), F.lit("double"))
    stem = F.concat(F.lit("d_part.t"), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select(stem.alias("stem"), F.array(first, second, third).alias("fields"))


def ddl_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table definitions with comments for most parts."""
    stem = F.concat(F.lit("d_part.t"), F.col("p_partkey").cast("string"))
    note = F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("단말 번호 "), "p_brand")).otherwise("plain")
    place = F.when(F.col("p_size") > 20, "위도").otherwise("위 도")
    ddl = F.concat(
        F.lit("CREATE TABLE x (\n  `"),
        _name(),
        F.lit("` string COMMENT '"),
        note,
        F.lit("',\n  `x_cdr` varchar(10) comment 'record',\n  `lat` double COMMENT \""),
        place,
        F.lit('",\n  `bare` int)'),
    )
    return table(spark, sf_dir, "part").where("p_size <= 40").select(stem.alias("stem"), ddl.alias("ddl"))


@check(
    "schema_discovery",
    r"""
    WITH p AS (SELECT 'd_part.t' || p_partkey AS stem, replace(p_name, ' ', '_') AS nm, p_size, p_type, p_brand,
                      regexp_matches(replace(p_name, ' ', '_'), '(^|_)(cdr|ring)(_|$)') AS tok FROM part),
    by_comment AS (
      SELECT stem, 0 AS index, nm AS name, CASE WHEN p_type = 'ECONOMY' THEN '단말 번호 ' || p_brand ELSE 'plain' END AS comment
        FROM p WHERE p_size <= 40 AND p_type <> 'SMALL' AND (p_type = 'ECONOMY' OR tok)
      UNION ALL SELECT stem, 1, 'x_cdr', 'record' FROM p WHERE p_size < 10
      UNION ALL SELECT stem, 2, 'lat', '위도' FROM p WHERE p_size <= 40 AND p_size > 20),
    by_name AS (SELECT stem, 0 AS index, nm AS name, CAST(NULL AS VARCHAR) AS comment FROM p
                WHERE p_type <> 'SMALL' AND tok AND stem NOT IN (SELECT stem FROM by_comment))
    SELECT '/db=' || split_part(stem, '.', 1) || '/tb=' || split_part(stem, '.', 2) AS path, index, name, comment, rule
    FROM (SELECT *, 'comment' AS rule FROM by_comment UNION ALL SELECT *, 'name' FROM by_name)
    """,
)
def schema_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensitive columns of catalogued tables, by comment and otherwise by name."""
    found = governance.discover_sensitive(
        schema_documents(spark, sf_dir), ddl_documents(spark, sf_dir), tokens=_TOKENS
    )
    return found.select("path", "index", "name", "comment", "rule")


@check(
    "ddl_comments",
    """
    WITH p AS (SELECT 'd_part.t' || p_partkey AS stem, replace(p_name, ' ', '_') AS nm, p_size,
                      CASE WHEN p_type = 'ECONOMY' THEN '단말 번호 ' || p_brand ELSE 'plain' END AS note FROM part WHERE p_size <= 40)
    SELECT stem, nm AS name, note AS comment FROM p
    UNION ALL SELECT stem, 'x_cdr', 'record' FROM p
    UNION ALL SELECT stem, 'lat', CASE WHEN p_size > 20 THEN '위도' ELSE '위 도' END FROM p
    """,
)
def ddl_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names and comments out of table definitions."""
    found = ddl_documents(spark, sf_dir).select("stem", F.explode(X.ddl_columns(F.col("ddl"))).alias("c"))
    return found.select("stem", "c.name", "c.comment")


@check(
    "matches_per_table",
    """
    SELECT p_brand, p_partkey // 100 AS chunk, count(*) AS n,
           string_agg(p_partkey || ':' || p_name, ',' ORDER BY p_partkey) AS matches
    FROM part WHERE regexp_matches(replace(p_name, ' ', '_'), '(^|_)(cdr|ring)(_|$)') GROUP BY p_brand, p_partkey // 100
    """,
)
def matches_per_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches per table as ordered lists of bounded length."""
    hits = table(spark, sf_dir, "part").where(X.has_token(_name(), _TOKENS))
    lists = frames.listed_matches(hits, "p_brand", "p_partkey", ["p_name"])
    shown = F.transform("matches", lambda m: F.concat(m["p_partkey"].cast("string"), F.lit(":"), m["p_name"]))
    return lists.select("p_brand", "chunk", F.size("matches").cast("bigint").alias("n"), F.array_join(shown, ",").alias("matches"))


_SAMPLED = ["c_name", "c_acctbal", "c_mktsegment"]


def _sampled_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("decimal(15,2)")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"),
    )


@check(
    "sample_values",
    """
    WITH long AS (
      SELECT c_custkey, 'c_name' AS column_name, 0 AS index, c_name AS value FROM customer
      UNION ALL SELECT c_custkey, 'c_acctbal', 1, CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR) FROM customer WHERE c_acctbal > 0
      UNION ALL SELECT c_custkey, 'c_mktsegment', 2, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING')
    SELECT column_name, index, value
    FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY c_custkey) AS rn FROM long) WHERE rn BETWEEN 2 AND 6
    """,
)
def sample_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five non-null values per column after the first: the sampling report."""
    return governance.sample_values(_sampled_customers(spark, sf_dir), _SAMPLED, ["c_custkey"])


@check(
    "encrypted_samples",
    """
    WITH long AS (
      SELECT c_custkey, 'c_name' AS column_name, to_base64(encode(c_name)) AS value FROM customer
      UNION ALL SELECT c_custkey, 'c_mktsegment', lower(c_mktsegment) || '-' FROM customer)
    SELECT column_name, bool_or(length(value) % 4 = 0 AND regexp_matches(value, '^[A-Za-z0-9+/]*={0,2}$')) AS encrypted
    FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY c_custkey) AS rn FROM long) WHERE rn BETWEEN 2 AND 6
    GROUP BY column_name
    """,
)
def encrypted_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns whose samples look like cipher text."""
    people = table(spark, sf_dir, "customer").select(
        "c_custkey",
        base64_text(F.col("c_name").cast("binary")).alias("c_name"),
        F.concat(F.lower("c_mktsegment"), F.lit("-")).alias("c_mktsegment"),
    )
    return governance.encrypted_columns(governance.sample_values(people, ["c_name", "c_mktsegment"], ["c_custkey"]))


@check(
    "flatten_report",
    """
    SELECT c_custkey, 'c_name' AS column_name, 0 AS index, c_name AS value FROM customer
    UNION ALL SELECT c_custkey, 'c_acctbal', 1, CASE WHEN c_acctbal > 0 THEN CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR) END FROM customer
    UNION ALL SELECT c_custkey, 'c_mktsegment', 2, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END FROM customer
    """,
)
def flatten_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report row per key and column."""
    return frames.to_long(_sampled_customers(spark, sf_dir), ["c_custkey"], _SAMPLED)


@check(
    "base64_shape",
    """
    WITH d AS (SELECT doc_id, lang, CASE lang WHEN 'en' THEN to_base64(encode(text)) WHEN 'fr' THEN 'T1' || to_base64(encode(text))
                        WHEN 'es' THEN to_base64(encode(text)) || '=' ELSE text END AS value FROM documents),
    b AS (SELECT doc_id, CASE WHEN lang = 'fr' THEN substr(value, 3) ELSE value END AS body FROM d)
    SELECT doc_id, length(body) % 4 = 0 AND regexp_matches(body, '^[A-Za-z0-9+/]*={0,2}$') AS encrypted FROM b
    """,
)
def base64_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether whole texts have the shape of cipher text."""
    coded, lang = base64_text(F.col("text").cast("binary")), F.col("lang")
    value = (
        F.when(lang == "en", coded)
        .when(lang == "fr", F.concat(F.lit("T1"), coded))
        .when(lang == "es", F.concat(coded, F.lit("=")))
        .otherwise(F.col("text"))
    )
    name = F.when(lang == "fr", "x_imsi").otherwise("note")
    return table(spark, sf_dir, "documents").select("doc_id", X.looks_encrypted(value, name).alias("encrypted"))


@check(
    "completeness_report",
    """
    WITH f AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '.dat' WHEN '2-HIGH' THEN '.gz' WHEN '3-MEDIUM' THEN '.dat.lz4'
                        WHEN '5-LOW' THEN '.snappy' ELSE '' END AS ext,
                      CASE WHEN o_orderstatus = 'F' THEN 'csv' END AS fmt, CASE WHEN o_orderstatus = 'O' THEN '|' END AS sep FROM orders)
    SELECT o_orderkey,
           CASE WHEN ext IN ('.dat', '.dat.lz4') AND sep IS NULL THEN 'delimiter'
                WHEN ext = '.snappy' AND fmt IS NULL AND sep IS NULL THEN 'format, delimiter'
                WHEN ext IN ('.gz', '') AND fmt IS NULL THEN 'format' END AS missing,
           fmt IS NOT NULL AND fmt <> 'csv' AND sep IS NULL AS converts,
           CASE WHEN ext IN ('.dat', '.dat.lz4') AND sep IS NOT NULL THEN 'csv' WHEN fmt = 'csv' AND sep IS NOT NULL THEN 'csv' END AS reader
    FROM f
    """,
)
def completeness_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is missing in file metadata, whether a file is converted, and which reader takes it."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    ext = (
        F.when(priority == "1-URGENT", ".dat")
        .when(priority == "2-HIGH", ".gz")
        .when(priority == "3-MEDIUM", ".dat.lz4")
        .when(priority == "5-LOW", ".snappy")
        .otherwise("")
    )
    path = F.concat(F.lit("/db=a/tb=b/f"), F.col("o_orderkey").cast("string"), ext)
    fmt, sep = F.when(status == "F", "csv"), F.when(status == "O", "|")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        governance.completeness(path, fmt, sep).alias("missing"),
        governance.needs_conversion(fmt, sep.isNotNull(), F.lit(False)).alias("converts"),
        format_of(path, fmt, sep).alias("reader"),
    )
