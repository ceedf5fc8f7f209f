"""Writing results: formats, sized parts, single named files, markers."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import CODEC_EXTENSIONS, WriteSpec
from quayside.sources.files import MissingConnector

MERGE_BYTES = 4 * 1024**3
TEXT_MERGE_BYTES = 1024**3


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target, jvm.org.apache.hadoop.fs.Path


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names below ``path`` and sizes of the files a reader of it takes, whatever they are called.

    As in every Spark scan, names that start with ``_`` or ``.`` are hidden, with all below them.
    """
    fs, target, _ = _hadoop(spark, path)
    root = fs.makeQualified(target).toString().rstrip("/")
    listed, found = fs.listFiles(target, True), []
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().toString().removeprefix(root).lstrip("/") or status.getPath().getName()
        if not any(part[0] in "_." and "=" not in part for part in name.split("/")):
            found.append((name, status.getLen()))
    return sorted(found)


def _writer(df: DataFrame, spec: WriteSpec):
    writer = df.write.format(spec.spark_format).mode("overwrite").option("compression", spec.codec)
    if spec.spark_format == "csv":
        writer = (
            writer.option("sep", spec.sep)
            .option("header", spec.header)
            .option("nullValue", "")
            .option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("escape", '"' if spec.escape is None else spec.escape)
        )
    if spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    return writer


def write_files(df: DataFrame, path: str, spec: WriteSpec = WriteSpec()) -> str:
    """Write ``df``, by default as zstd parquet; ``merge`` makes files of about ``MERGE_BYTES``, named and numbered."""
    if spec.merge and not spec.partition_by:
        return _write_merged(df, path, spec)
    if spec.files is not None:
        df = df.repartition(spec.files)  # coalescing would run the whole job in as few tasks
    try:
        _writer(df, spec).save(path)
    except Exception as error:
        if spec.spark_format == "avro" and "avro" in str(error).lower():
            raise MissingConnector("writing avro needs the spark-avro package") from error
        raise
    return path


def _write_merged(df: DataFrame, path: str, spec: WriteSpec, limit: int = MERGE_BYTES) -> str:
    """Written in parallel first, and then put into files of about ``limit`` bytes.

    Merging right away would run the whole job in one task. A result of up to ``limit`` is one file with the
    wanted name; a larger one is files with that name and a number.
    """
    spark = df.sparkSession
    above, slash, _ = path.rstrip("/").rpartition("/")
    staged = f"{above}{slash}_parts-{uuid.uuid4().hex}"  # beside the target; readers skip the underscore
    as_text = spec.spark_format == "csv" and not spec.header
    # Text with a header is staged as parquet, or every part would bring its own header line.
    rows_format = "parquet" if spec.header else spec.format
    staging = WriteSpec(spec.format, spec.compression, spec.sep) if as_text else WriteSpec(rows_format)
    _writer(df, staging).save(staged)
    parts = max(1, math.ceil(sum(size for _, size in data_files(spark, staged)) / limit))
    if as_text:
        lines = spark.read.text(staged, lineSep="\n").coalesce(parts)
        lines.write.mode("overwrite").option("compression", spec.codec).option("lineSep", "\n").text(path)
    else:
        rows = spark.read.format(staging.spark_format).schema(df.schema).load(staged)
        _writer(rows.coalesce(parts), spec).save(path)
    fs, target, _ = _hadoop(spark, staged)
    fs.delete(target, True)
    if spec.file_name:
        rename_parts(spark, path, spec.file_name)
    return path


def merge_small_files(spark: SparkSession, source: str, path: str, limit: int = MERGE_BYTES, force: bool = False) -> bool:
    """Merge the parquet files of a directory, whatever their names, when there are several and they are small."""
    sizes = [size for _, size in data_files(spark, source)]
    small = sum(sizes) <= limit
    if len(sizes) < 2 or not (small or force):
        return False
    frame = spark.read.parquet(source)
    parts = 1 if small else math.ceil(sum(sizes) / limit)
    frame.coalesce(parts).write.mode("overwrite").parquet(path)
    return True


def rename_parts(spark: SparkSession, path: str, name: str) -> list[str]:
    """Give one file ``name``, and several ``stem_1.ext``, ``stem_2.ext`` and so on, in their order."""
    fs, target, make_path = _hadoop(spark, path)
    parts = [part for part, _ in data_files(spark, path)]
    stem, dot, extension = name.partition(".")
    width = len(str(len(parts)))
    names = [name] if len(parts) == 1 else [f"{stem}_{i:0{width}d}{dot}{extension}" for i in range(1, len(parts) + 1)]
    for part, wanted in zip(parts, names, strict=True):
        if not fs.rename(make_path(target, part), make_path(target, wanted)):
            raise RuntimeError(f"could not rename {part} of {path} to {wanted}")
    return names


def rename_single_part(spark: SparkSession, path: str, name: str) -> str:
    """Rename the one part file of a directory; anything but exactly one is an error."""
    parts = data_files(spark, path)
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {path}, found {len(parts)}")
    fs, target, make_path = _hadoop(spark, path)
    wanted = make_path(target, name)
    if fs.exists(wanted):
        fs.delete(wanted, True)
    if not fs.rename(make_path(target, parts[0][0]), wanted):
        raise RuntimeError(f"could not rename the part file of {path} to {name}")
    return wanted.toString()


def merged_file_name(stem: str, fmt: str, codec: str | None = None) -> str:
    extension = CODEC_EXTENSIONS.get((codec or "").lower(), "")
    return f"{stem}{extension}.{fmt}"


def write_marker(spark: SparkSession, path: str) -> None:
    """A zero-byte file, such as ``_SUCCESS`` or ``<name>.CHK``."""
    fs, target, _ = _hadoop(spark, path)
    fs.create(target, True).close()


def as_lines(df: DataFrame, sep: str, null: str = "", line_break: str = " ") -> Column:
    """A row as one unquoted line; separators of any length. A line break inside a value becomes ``line_break``."""

    def value(name: str) -> Column:
        return F.regexp_replace(F.col(f"`{name}`").cast("string"), "\r\n|[\r\n]", line_break)

    return F.concat_ws(sep, *[F.coalesce(value(c), F.lit(null)) for c in df.columns])


def write_lines(df: DataFrame, path: str, sep: str, compression: str = "none", encoding: str | None = None) -> str:
    """Unquoted text export, for separators the CSV writer would quote around."""
    lines = df.select(as_lines(df, sep).alias("value"))
    if encoding is None or encoding.upper() in ("UTF-8", "UTF8"):
        lines.write.mode("overwrite").option("compression", compression).text(path)
    else:
        # The text writer is UTF-8 only; one unquoted CSV column carries the line in another charset.
        writer = lines.write.mode("overwrite").option("encoding", encoding).option("sep", "\x00")
        writer.option("quote", "").option("escapeQuotes", False).option("emptyValue", "").option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).option("compression", compression).csv(path)
    return path


def write_sized(df: DataFrame, path: str, total_bytes: int, target_bytes: int = MERGE_BYTES, spec: WriteSpec = WriteSpec()) -> int:
    """Split by size: ``total // target + 1`` files of even row counts, without losing the remainder."""
    parts = total_bytes // target_bytes + 1
    _writer(df.repartition(parts), spec).save(path)
    return parts


def write_partitions(df: DataFrame, path: str, keys: Sequence[str], spec: WriteSpec = WriteSpec()) -> str:
    """Publish to ``/k=v/`` directories, replacing only the partitions at hand.

    Rows are brought together by key, so that no task opens every directory;
    rebalancing splits a hot key over several tasks and joins small ones.
    """
    spread = df.hint("rebalance", *[F.col(k) for k in keys])
    _writer(spread, WriteSpec(spec.format, spec.compression, spec.sep, spec.header)).option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*keys).save(path)
    return path


def merge_text(spark: SparkSession, paths: Sequence[str], path: str, target_bytes: int = TEXT_MERGE_BYTES) -> int:
    """All lines of several text outputs, in as few files of about ``target_bytes`` as hold them."""
    total = sum(size for source in paths for _, size in data_files(spark, source))
    parts = max(1, math.ceil(total / target_bytes))
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select("value")  # a lone carriage return belongs to its line
    lines.coalesce(parts).write.mode("overwrite").option("lineSep", "\n").text(path)
    return parts


def write_text_pages(lines: DataFrame, path: str) -> str:
    """Lines ``value`` in a ``page=`` folder for each page."""
    lines.write.mode("overwrite").partitionBy("page").option("lineSep", "\n").text(path)
    return path


def write_report(df: DataFrame, path: str) -> str:
    r"""Report with record separators and ``\`` as escape."""
    writer = df.write.mode("overwrite").option("sep", "\x1e").option("escape", "\\").option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target, _ = _hadoop(spark, path)
    return fs.exists(target)


def move(spark: SparkSession, source: str, path: str) -> None:
    """Rename one file or folder, making the folders above."""
    fs, target, make_path = _hadoop(spark, path)
    fs.mkdirs(target.getParent())
    if not fs.rename(make_path(source), target):
        raise RuntimeError(f"could not move {source} to {path}")


def replace_folder(spark: SparkSession, source: str, path: str) -> None:
    """Make ``source`` the folder ``path`` by a rename; what was there goes aside first and is deleted last. No source gives an empty folder."""
    fs, target, make_path = _hadoop(spark, path)
    aside = make_path(f"{path.rstrip('/')}-{uuid.uuid4().hex}")
    if target.getParent() is not None:
        fs.mkdirs(target.getParent())
    old = fs.exists(target) and fs.rename(target, aside)
    if not exists(spark, source):
        fs.mkdirs(target)
    elif not fs.rename(make_path(source), target):
        raise RuntimeError(f"could not put {source} in place of {path}")
    if old:
        fs.delete(aside, True)
