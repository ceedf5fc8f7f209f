"""Reading delimited and columnar files, catalogues and listings."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.config import ReadSpec, unescape_separator
from quayside.functions import casting as C
from quayside.functions import paths as P
from quayside.functions.crypto import sep_regex
from quayside.functions.timepat import bind
from quayside.schema import fields_of, struct_of, text_struct

COLUMNAR = ("parquet", "orc", "avro")
DELIMITED = ("csv", "dat", "txt")


class MissingConnector(RuntimeError):
    """A format needs a Spark package that the session does not have."""


def escape_glob(path: str) -> str:
    """Brackets in a path are part of the name, not a character class."""
    return path.replace("[", "\\[").replace("]", "\\]")


def _load(spark: SparkSession, fmt: str, path: str | Sequence[str], **options: str) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    try:
        return reader.load(path if isinstance(path, str) else list(path))
    except Exception as error:
        if fmt == "avro" and "avro" in str(error).lower() and "DATA_SOURCE" in str(error).upper().replace(" ", "_"):
            raise MissingConnector("reading avro needs the spark-avro package") from error
        raise


def read_files(spark: SparkSession, path: str | Sequence[str], spec: ReadSpec) -> DataFrame:
    """Files of one format; a declared schema applies to delimited files only."""
    if spec.format in COLUMNAR:
        return _load(spark, spec.format, path)
    reader = _text_reader(spark, spec)
    if spec.schema is not None:
        reader = reader.schema(struct_of(spec.schema))
    return reader.csv(path if isinstance(path, str) else list(path))


def _text_reader(spark: SparkSession, spec: ReadSpec) -> DataFrameReader:
    return (
        spark.read.option("sep", unescape_separator(spec.sep))
        .option("encoding", spec.encoding)
        .option("header", spec.header)
        .option("enforceSchema", True)
        .option("quote", spec.quote)
        .option("escape", spec.quote)
        .option("multiLine", spec.multi_line)
    )


def read_text_columns(spark: SparkSession, path: str | Sequence[str], spec: ReadSpec) -> DataFrame:
    """Delimited files with the declared names, every value as text; doubled quotes stand for one."""
    reader = _text_reader(spark, spec).schema(text_struct(spec.schema))
    return reader.csv(path if isinstance(path, str) else list(path))


def read_lines(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8", header: bool = False) -> DataFrame:
    """Raw text lines as ``value``, decoded; with ``header`` the first line of every file is dropped.

    Lines are cut as bytes by the one text reader and then decoded, so blank lines and NUL stay in every charset whose line
    break is a single byte. Bytes that are not valid in the charset become replacement characters.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    if header:
        # The first line of a file is the first row of the block that starts it; one small row per file says which.
        placed = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
        placed = placed.withColumn("line", F.monotonically_increasing_id())
        firsts = placed.where("start = 0").groupBy("file").agg(F.min("line").alias("line"))
        lines = placed.join(firsts, ["file", "line"], "left_anti").select("value")
    return lines.select(decoded(F.col("value"), encoding).alias("value"))


def decoded(line: Column, encoding: str) -> Column:
    """Text of a raw line in a charset; the text reader keeps the bytes as they are."""
    if encoding.upper().replace("-", "") == "UTF16":
        raise ValueError("lines of UTF-16 cannot be cut as bytes")
    return F.decode(line.cast("binary"), encoding)


def typed_columns(text: DataFrame, schema, bigint_mode: str = "trunc") -> DataFrame:
    """Text columns to their declared types: blanks and malformed values become null.

    Columns are matched by position; the last one loses a trailing tab first.
    """
    names = [name for name, _ in fields_of(schema)]
    return typed_beside_text(text, schema, bigint_mode).select(*names)


def typed_beside_text(text: DataFrame, schema, bigint_mode: str = "trunc") -> DataFrame:
    """The typed columns and, as ``_text_0`` and so on, the cleaned text they come from."""
    fields = fields_of(schema)
    if len(text.columns) < len(fields):
        raise ValueError(f"{len(text.columns)} columns cannot fill {len(fields)} declared ones")
    cleaned = []
    for position, name in enumerate(text.columns[: len(fields)]):
        value = F.col(f"`{name}`")
        if position == len(fields) - 1:
            value = C.strip_trailing_tab(value)
        cleaned.append(C.blank_to_null(value).alias(f"_text_{position}"))
    return text.select(*cleaned).select(
        "*", *[C.typed(F.col(f"_text_{i}"), kind, bigint_mode).alias(name) for i, (name, kind) in enumerate(fields)]
    )


def rejected_values(text: DataFrame, schema, bigint_mode: str = "trunc") -> DataFrame:
    """Number of non-blank values per column that its type does not accept, in one pass."""
    both = typed_beside_text(text, schema, bigint_mode)
    counts = [
        F.count_if(F.col(f"_text_{i}").isNotNull() & F.col(name).isNull()).alias(name)
        for i, (name, _) in enumerate(fields_of(schema))
    ]
    return both.agg(*counts)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores when a scan has fewer tasks than that; larger scans stay as they are.

    One gzip file or one parquet row group is read by one task, which would then do
    all the work behind the scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def split_lines(lines: DataFrame, sep: str, names: Sequence[str], column: str = "value") -> DataFrame:
    """Raw text lines to columns; missing fields are null. Bare lines are dropped by the caller.

    A filter here would make Spark compute ``column`` twice, below and above it.
    """
    fields = F.split(F.col(column), sep_regex(sep), -1)
    return lines.select(*[F.get(fields, F.lit(i)).alias(name) for i, name in enumerate(names)])


def replacement_rate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and rows with a replacement character, for text read in a given charset."""
    damaged = F.lit(False)
    for name in columns:
        damaged = damaged | F.coalesce(F.col(name).contains("�"), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(damaged).alias("damaged"))


def best_charset(spark: SparkSession, path: str | Sequence[str], candidates: Sequence[str]) -> DataFrame:
    """``file, charset, damaged, lines``: per file the candidate charset that damages the fewest lines; the first one wins a tie.

    One scan decodes each raw line by every candidate, and a partial aggregate per file counts. Files without a line are read by
    any charset and get the first; they come from the listing, since no scan has a row of them.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select("value", F.col("_metadata.file_path").alias("file"))
    hurt = [F.count_if(decoded(F.col("value"), charset).contains("�")).alias(f"damaged_{i}") for i, charset in enumerate(candidates)]
    counted = lines.groupBy("file").agg(F.count(F.lit(1)).alias("lines"), *hurt)
    tries = [F.struct(F.col(f"damaged_{i}").alias("damaged"), F.lit(i).alias("order"), F.lit(c).alias("charset")) for i, c in enumerate(candidates)]
    best = counted.select("file", F.array_min(F.array(*tries)).alias("best"), "lines").select("file", "best.charset", "best.damaged", "lines")
    nothing = spark.createDataFrame([(name,) for name in _without_bytes(spark, path)], "file string")
    first = nothing.select("file", F.lit(candidates[0]).alias("charset"), F.lit(0).cast("long").alias("damaged"), F.lit(0).cast("long").alias("lines"))
    return best.unionByName(first)


def _without_bytes(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Empty files below the paths, as URIs; the listing of one level of globs and folders."""
    jvm, conf, found = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for each in [path] if isinstance(path, str) else path:
        place = jvm.org.apache.hadoop.fs.Path(each)
        fs = place.getFileSystem(conf)
        for status in fs.globStatus(place) or []:
            for below in fs.listStatus(status.getPath()):
                name = below.getPath().getName()
                if below.isFile() and below.getLen() == 0 and name[0] not in "_.":
                    found.append(below.getPath().toUri().toString().replace(":/", ":///", 1) if below.getPath().toUri().getAuthority() is None else below.getPath().toUri().toString())
    return sorted(set(found))


def list_files(spark: SparkSession, path: str | Sequence[str], suffix: str | None = None) -> DataFrame:
    """Listing of a directory tree: path, length, modification time; content is not read.

    As in every Spark scan, hidden files (``_SUCCESS``) and empty ones are not listed.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    found = reader.load(path if isinstance(path, str) else list(path))
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


SCHEMA_FILE = T.StructType(
    [
        T.StructField(
            "fields",
            T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType())])),
        )
    ]
)


def _stem(name: Column, suffix: str) -> Column:
    return F.regexp_replace(name, "\\Q" + suffix + "\\E$", "")


def read_schema_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """All ``<db>.<tb>.json`` files of a folder as rows (stem, fields)."""
    found = (
        spark.read.schema(SCHEMA_FILE).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder)
    )
    return found.select(_stem(F.col("_metadata.file_name"), ".json").alias("stem"), "fields")


def read_ddl_texts(spark: SparkSession, folder: str) -> DataFrame:
    """All ``.hql`` files of a folder as rows (stem, ddl)."""
    found = spark.read.option("pathGlobFilter", "*.hql").text(folder, wholetext=True)
    return found.select(_stem(F.col("_metadata.file_name"), ".hql").alias("stem"), F.col("value").alias("ddl"))


def read_schema_file(spark: SparkSession, path: str) -> dict:
    """One schema file; it is a single small document."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise ValueError(f"schema file {path} is empty")
    return json.loads(text[0])


def format_of(path: Column, declared: Column, sep: Column) -> Column:
    """Reader for a file: by extension, then by declared format; null when nothing fits."""

    def reader(ext: Column) -> Column:
        kind = F.when(ext.contains("dat") | ext.contains("DAT"), "csv").otherwise(declared)
        known_text = F.lit(False)
        for mark in ("DAT", "dat", "csv", "txt"):
            known_text = known_text | ext.contains(mark)
        return (
            F.when(ext.contains("parquet") | (kind == "parquet"), "parquet")
            .when(ext.contains("orc") | (kind == "orc"), "orc")
            .when((known_text | kind.isin("csv", "dat")) & (F.coalesce(sep, F.lit("")) != ""), "csv")
            .when(ext.contains("avro") | (kind == "avro"), "avro")
        )

    return bind(P.full_extension(path), reader)


def with_path_partitions(df: DataFrame, keys: Sequence[str] = ("dt", "hh", "hm"), path: Column | None = None) -> DataFrame:
    """Partition values of each row's own file path as string columns; keys not in the path stay out."""
    origin = F.col("_metadata.file_path") if path is None else path
    return df.withColumns({key: P.partition_value(origin, key) for key in keys})
