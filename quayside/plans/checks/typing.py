"""Text to typed values, nulls, charsets and zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import casting as C
from quayside.operators import frames
from quayside.plans.registry import check, table
from quayside.sources.files import rejected_values, typed_columns

ALL_TYPES = {
    "fields": [
        {"name": "c_key", "type": "bigint"},
        {"name": "c_int", "type": "int"},
        {"name": "c_big", "type": "bigint"},
        {"name": "c_dbl", "type": "double"},
        {"name": "c_bool", "type": "boolean"},
        {"name": "c_ts", "type": "timestamp"},
        {"name": "c_dec", "type": "decimal"},
        {"name": "c_last", "type": "string"},
    ]
}


def event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as text columns with blanks, malformed numbers and odd booleans among them."""
    kind, value = F.col("event_type"), F.col("value")
    number = F.col("user_id").cast("string")
    return table(spark, sf_dir, "events", wide=True).select(
        F.col("event_id").cast("string").alias("c_key"),
        F.when(kind == "error", "abc").when(kind == "view", "1.9").when(kind == "click", " ").otherwise(number).alias("c_int"),
        F.when(kind == "error", F.concat(F.lit("-"), number, F.lit(".5")))
        .when(kind == "view", F.concat(F.lit("90071992547409"), F.lpad(number, 3, "0")))
        .when(kind == "click", "x9")
        .otherwise(F.concat(F.lit(" "), number, F.lit(" ")))
        .alias("c_big"),
        F.when(kind == "error", "").when(kind == "view", "1e").otherwise(value.cast("decimal(12,2)").cast("string")).alias("c_dbl"),
        F.when(kind == "error", "Yes").when(kind == "view", "TRUE").when(kind == "click", "0").when(kind == "signup", " ").otherwise("t").alias("c_bool"),
        F.when(kind == "error", F.date_format("ts", "yyyy/MM/dd"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("c_ts"),
        F.when(kind == "error", F.concat(number, F.lit(".50"))).when(kind == "view", "x").otherwise(number).alias("c_dec"),
        F.when(kind == "view", F.concat(kind, F.lit("\t"))).otherwise(kind).alias("c_last"),
    )


TYPED_SQL = """
    SELECT event_id AS c_key,
           CASE WHEN event_type IN ('error', 'view', 'click') THEN NULL ELSE CAST(user_id AS INTEGER) END AS c_int,
           CASE event_type WHEN 'error' THEN -user_id WHEN 'click' THEN NULL
             WHEN 'view' THEN CAST('90071992547409' || lpad(CAST(user_id AS VARCHAR), 3, '0') AS BIGINT)
             ELSE user_id END AS c_big,
           CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) END AS c_dbl,
           CASE event_type WHEN 'click' THEN false WHEN 'signup' THEN NULL ELSE true END AS c_bool,
           CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS c_ts,
           CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE CAST(user_id AS VARCHAR) END AS c_dec,
           event_type AS c_last
    FROM events
"""


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps and decimals as text, so that engines agree on their form."""
    return df.withColumns(
        {"c_ts": F.date_format("c_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "c_dec": F.col("c_dec").cast("string")}
    )


@check("typed_casts", TYPED_SQL)
def typed_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(typed_columns(event_texts(spark, sf_dir), ALL_TYPES))


@check(
    "rejected_values",
    """
    SELECT CAST(0 AS BIGINT) AS c_key,
           count(*) FILTER (event_type IN ('error', 'view')) AS c_int,
           count(*) FILTER (event_type = 'click') AS c_big,
           count(*) FILTER (event_type = 'view') AS c_dbl,
           CAST(0 AS BIGINT) AS c_bool,
           count(*) FILTER (event_type IN ('error', 'view')) AS c_ts,
           count(*) FILTER (event_type IN ('error', 'view')) AS c_dec,
           CAST(0 AS BIGINT) AS c_last
    FROM events
    """,
)
def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_values(event_texts(spark, sf_dir), ALL_TYPES)


@check(
    "bigint_trunc_vs_floor",
    """
    SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS truncated, CAST(floor(c_acctbal) AS BIGINT) AS floored
    FROM customer
    """,
)
def bigint_trunc_vs_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal").cast("decimal(15,2)").cast("string")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", C.to_bigint(balance, "trunc").alias("truncated"), C.to_bigint(balance, "floor").alias("floored")
    )


@check(
    "string_null_clean",
    """
    WITH d AS (SELECT doc_id, CASE lang WHEN 'fr' THEN 'null' WHEN 'de' THEN ' ' WHEN 'es' THEN '' ELSE lang END AS lang,
                      text, source FROM documents)
    SELECT doc_id, CASE WHEN lang IN ('', ' ') THEN NULL ELSE lang END AS blanks,
           nullif(lang, 'null') AS words,
           md5(replace(replace(text, chr(13), ''), chr(10), '')) AS one_line,
           source AS untabbed
    FROM d
    """,
)
def string_null_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.when(F.col("lang") == "fr", "null").when(F.col("lang") == "de", " ").when(F.col("lang") == "es", "").otherwise(F.col("lang"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        C.blank_to_null(lang).alias("blanks"),
        C.literal_null_to_null(lang).alias("words"),
        F.md5(C.strip_line_breaks(F.col("text"))).alias("one_line"),
        C.strip_trailing_tab(F.concat("source", F.lit("\t"))).alias("untabbed"),
    )


@check(
    "hex_decode",
    """
    SELECT doc_id, md5(text) AS text_md5, translate(source, '0123456789', '가나다라마바사아자차') AS hangul FROM documents
    """,
)
def hex_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hex digits of UTF-8 and EUC-KR bytes back to text."""
    hangul = F.translate("source", "0123456789", "가나다라마바사아자차")
    coded = table(spark, sf_dir, "documents").select(
        "doc_id", F.hex(F.encode("text", "UTF-8")).alias("utf"), F.hex(F.encode(hangul, "EUC-KR")).alias("euc")
    )
    return coded.select(
        "doc_id", F.md5(C.hex_to_text(F.col("utf"), "UTF-8")).alias("text_md5"), C.hex_to_text(F.col("euc")).alias("hangul")
    )


@check(
    "tz_export",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type
    FROM events
    """,
)
def tz_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTC moved to Seoul first, then all columns to strings."""
    moved = frames.zoned_timestamps(table(spark, sf_dir, "events").select("event_id", "ts", "event_type"))
    return frames.all_strings(moved.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")))
