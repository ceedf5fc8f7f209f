"""Checks and reports: sensitive columns, reconciliation, completeness, audit rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import paths as P
from quayside.functions import text as X
from quayside.functions.timepat import bind
from quayside.operators.frames import to_long
from quayside.sources.files import MissingConnector

# Name tokens and comment patterns of sensitive columns, and the
# words that mark a location column.
SENSITIVE_TOKENS = ("imsi", "imei", "mdn", "msisdn", "cdr", "enb_id", "cell_id", "svc_mgmt_num", "xdr", "cust_no")
SENSITIVE_COMMENTS = (".*단말.*번호", ".*단말.*모델", ".*단말.*코드", "위도", "경도", "위경도", "경위도")
LOCATION_WORDS = ("위도", "경도", "위경도", "경위도")

SAMPLE_SKIP, SAMPLE_SIZE = 1, 5


def schema_columns(catalogue: DataFrame) -> DataFrame:
    """(stem, fields) to one row per column: stem, index, name, type."""
    return catalogue.select("stem", F.posexplode("fields").alias("index", "field")).select(
        "stem", "index", F.col("field.name").alias("name"), F.col("field.type").alias("type")
    )


def commented_columns(ddl: DataFrame, tokens: Sequence[str], keywords: Sequence[str]) -> DataFrame:
    """Commented columns that match a keyword or a token; the first comment of a column counts."""
    found = ddl.select("stem", F.posexplode(X.ddl_columns(F.col("ddl"))).alias("pos", "c")).select(
        "stem", "pos", F.col("c.name").alias("name"), F.col("c.comment").alias("comment")
    )
    wanted = found.where(X.has_keyword(F.col("comment"), keywords) | X.has_token(F.col("name"), tokens))
    return wanted.groupBy("stem", "name").agg(F.min_by("comment", "pos").alias("comment"))


def sensitive_columns(
    columns: DataFrame,
    comments: DataFrame,
    tokens: Sequence[str] = SENSITIVE_TOKENS,
    location_words: Sequence[str] = LOCATION_WORDS,
) -> DataFrame:
    """Sensitive columns as rows (stem, index, name, comment, rule).

    ``comment``: the column has a wanted comment and is a string or a location.
    ``name``: in tables without any such column, string columns with a sensitive name.
    All joins shuffle: the catalogue grows with its tables, and Spark's guess from the size of packed files would
    have the driver broadcast millions of rows.
    """
    located = F.lit(False)
    for word in location_words:
        located = located | F.col("comment").contains(word)
    by_comment = columns.join(comments.hint("merge"), ["stem", "name"]).where(located | (F.col("type") == "string"))
    covered = by_comment.select("stem").distinct()
    by_name = columns.where((F.col("type") == "string") & X.has_token(F.col("name"), tokens)).join(
        covered.hint("merge"), "stem", "left_anti"
    )
    return by_comment.select("stem", "index", "name", "comment", F.lit("comment").alias("rule")).unionByName(
        by_name.select("stem", "index", "name", F.lit(None).cast("string").alias("comment"), F.lit("name").alias("rule"))
    )


def discover_sensitive(
    catalogue: DataFrame,
    ddl: DataFrame,
    tokens: Sequence[str] = SENSITIVE_TOKENS,
    keywords: Sequence[str] = SENSITIVE_COMMENTS,
    location_words: Sequence[str] = LOCATION_WORDS,
) -> DataFrame:
    """Sensitive columns of all catalogued tables; definitions without a schema are left out."""
    known = ddl.join(catalogue.select("stem").distinct().hint("merge"), "stem", "left_semi")
    found = sensitive_columns(
        schema_columns(catalogue), commented_columns(known, tokens, keywords), tokens, location_words
    )
    db, tb = F.substring_index("stem", ".", 1), F.get(F.split("stem", r"\."), F.lit(1))
    return found.withColumn("path", P.landed_path(db, tb))


def sampled(cells: DataFrame, group: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Five non-null ``value`` cells per group after the first, in order; tasks drop all beyond six before the exchange."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order_by))
    ranked = cells.where(F.col("value").isNotNull()).withColumn("_rank", rank)
    return ranked.where((F.col("_rank") <= SAMPLE_SKIP + SAMPLE_SIZE) & (F.col("_rank") > SAMPLE_SKIP)).drop("_rank")


def sample_values(df: DataFrame, columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Five non-null values per column after the first, in key order, as long rows; the table is read once."""
    return sampled(to_long(df, order_by, columns), ["column_name"], order_by).select("column_name", "index", "value")


def encrypted_columns(samples: DataFrame) -> DataFrame:
    """Whether any sampled value of a column looks like cipher text."""
    shaped = X.looks_encrypted(F.col("value"), F.col("column_name"))
    return samples.groupBy("column_name").agg(F.bool_or(F.coalesce(shaped, F.lit(False))).alias("encrypted"))


def completeness(path: Column, fmt: Column, sep: Column) -> Column:
    """What is missing in the metadata of a file, by extension; null when nothing is."""
    no_format, no_sep = fmt.isNull(), sep.isNull()

    def missing(ext: Column) -> Column:
        return (
            F.when((ext == ".dat") & no_sep, "delimiter")
            .when((ext == ".snappy") & no_format & no_sep, "format, delimiter")
            .when((ext == ".gz") & no_format, "format")
            .when((ext == "") & no_format, "format")
            .when((ext == ".dat.lz4") & no_sep, "delimiter")
            .when((ext == ".lz4") & no_format & no_sep, "format, delimiter")
            .when((ext == ".dat.gz") & no_format & no_sep, "format, delimiter")
        )

    return bind(P.full_extension(path), missing)


def needs_conversion(target_format: Column, external: Column, raw: Column) -> Column:
    """Whether a delivery is converted: not without a target, for csv, external or raw deliveries."""
    return ~F.coalesce(target_format, F.lit("")).isin("", "csv") & ~external & ~raw


def landed_version(name: Column) -> Column:
    return F.when(F.endswith(name, F.lit(".parquet")), "2").otherwise("1")


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and a checksum of all rows that depends on neither row nor column order.

    The hash passes over nulls, so each row also gives which of its columns are null.
    """
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    row_hash = F.xxhash64(*columns, *[c.isNull() for c in columns])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_hash.cast("decimal(28,0)")), F.lit(0).cast("decimal(38,0)")).alias("checksum"),
    )


# Copy status codes.
COPY_SUCCESS, COPY_UNEQUAL = 4, 5


def reconcile(source: DataFrame, target: DataFrame, skip_verify: bool = False) -> DataFrame:
    """Counts of both sides and the copy status; ``skip_verify`` accepts any copy.

    Columns are compared by name; other names make the copy unequal.
    """
    sides = fingerprint(source).withColumn("target", fingerprint(target).select(F.struct("rows", "checksum")).scalar())
    same = (F.col("rows") == F.col("target.rows")) & (F.col("checksum") == F.col("target.checksum"))
    same = same & F.lit(sorted(source.columns) == sorted(target.columns))
    return sides.select(
        F.col("rows").alias("source_rows"),
        F.col("target.rows").alias("target_rows"),
        F.when(same | F.lit(skip_verify), COPY_SUCCESS).otherwise(COPY_UNEQUAL).alias("status"),
    )


def file_count_match(source: DataFrame, target: DataFrame, path: str = "path") -> DataFrame:
    """File counts of two listings without ``_SUCCESS`` markers."""

    def counted(listing: DataFrame) -> DataFrame:
        return listing.agg(F.count_if(~F.col(path).contains("_SUCCESS")).alias("source_files"))

    both = counted(source).withColumn("target_files", counted(target).scalar())
    return both.withColumn("matches", F.col("source_files") == F.col("target_files"))


def holds_parquet(listing: DataFrame, path: str = "path") -> DataFrame:
    return listing.agg((F.count_if(F.endswith(F.col(path), F.lit(".parquet"))) > 0).alias("holds_parquet"))


_TEXT = T.StringType()
COLLECT_AUDIT = T.StructType(
    [
        T.StructField("version", _TEXT),
        T.StructField("collect_hist_id", _TEXT),
        T.StructField("retry_id_seq", T.IntegerType()),
        T.StructField("protocol_cd", _TEXT),
        T.StructField("period", _TEXT),
        T.StructField("interface_id", _TEXT),
        T.StructField("system_cd", _TEXT),
        T.StructField("collect_source_seq", T.IntegerType()),
        T.StructField("local_path", _TEXT),
        T.StructField("db", _TEXT),
        T.StructField("tb", _TEXT),
        T.StructField("dest_path", _TEXT),
        T.StructField("filenm", _TEXT),
        T.StructField("target_dt", _TEXT),
        T.StructField("partitions", T.ArrayType(T.MapType(_TEXT, _TEXT))),
        T.StructField("file_size", T.LongType()),
        T.StructField("started_at", _TEXT),
        T.StructField("ended_at", _TEXT),
        T.StructField("task_log_url", _TEXT),
        T.StructField("err_msg", _TEXT),
        T.StructField("status_cd", _TEXT),
        T.StructField("retry", T.BooleanType()),
        T.StructField("host_nm", _TEXT),
    ]
)

PROVIDE_AUDIT = T.StructType(
    [
        T.StructField("id", _TEXT),
        T.StructField("version", _TEXT),
        T.StructField("type", _TEXT),
        T.StructField("period", _TEXT),
        T.StructField("source", _TEXT),
        T.StructField("target", T.ArrayType(_TEXT)),
        T.StructField("filepath", _TEXT),
        T.StructField("filenm", _TEXT),
        T.StructField("source_ip", _TEXT),
        T.StructField("db", _TEXT),
        T.StructField("tb", _TEXT),
        T.StructField("retry", T.BooleanType()),
        T.StructField("partitions", T.ArrayType(T.MapType(_TEXT, _TEXT))),
    ]
)


def _shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of an audit schema in order; those the input lacks are null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def collect_audit(attempts: DataFrame, started_code: str, retry_code: str) -> DataFrame:
    """One audit row per file attempt, with db, tb, name and partitions taken from ``dest_path``.

    A row with ``retry_id_seq`` is a retry; unset codes and sizes get their defaults.
    """
    have = set(attempts.columns)
    retry_seq = F.col("retry_id_seq") if "retry_id_seq" in have else F.lit(None)
    status = F.when(retry_seq.isNotNull(), retry_code).otherwise(started_code)
    dest = F.col("dest_path")
    parts = P.partition_list(dest)
    filled = attempts.withColumns(
        {
            "db": P.partition_value(dest, "db"),
            "tb": P.partition_value(dest, "tb"),
            "filenm": P.base_name(dest),
            "partitions": parts,
            "target_dt": P.joined_partition_values(parts),
            "retry": retry_seq.isNotNull(),
            "status_cd": F.coalesce(F.col("status_cd"), status) if "status_cd" in have else status,
            "file_size": F.coalesce(F.col("file_size"), F.lit(-1)) if "file_size" in have else F.lit(-1),
            "version": landed_version(dest),
        }
    )
    return _shaped(filled, COLLECT_AUDIT)


def provide_audit(deliveries: DataFrame) -> DataFrame:
    """One audit row per delivery."""
    path = F.col("filepath")
    filled = deliveries.withColumns(
        {
            "db": P.partition_value(path, "db"),
            "tb": P.partition_value(path, "tb"),
            "filenm": P.base_name(path),
            "partitions": P.partition_list(path),
        }
    )
    return _shaped(filled, PROVIDE_AUDIT)


def audit_messages(audit: DataFrame, key: str, partitions: int, alphabet: str = X.ALPHABET_CROCKFORD) -> DataFrame:
    """Audit rows as JSON messages with their topic partition."""
    return audit.select(
        X.routing_partition(F.col(key), partitions, alphabet).alias("partition"),
        F.to_json(F.struct("*")).alias("value"),
    )


def append_audit(audit: DataFrame, path: str) -> None:
    """Add audit rows to the audit table."""
    audit.write.mode("append").parquet(path)


def send_audit(messages: DataFrame, servers: str, topic: str) -> None:
    """Messages of :func:`audit_messages` to a topic; needs the Spark Kafka package."""
    try:
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    except Exception as error:
        if "Failed to find" in str(error) or "DATA_SOURCE_NOT_FOUND" in str(error):
            raise MissingConnector("Kafka needs the spark-sql-kafka package") from error
        raise
