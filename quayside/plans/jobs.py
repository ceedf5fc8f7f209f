"""Whole jobs: convert, protect, land, export, extract, discover, plan deliveries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import CipherKeys, CryptoRule, CryptoRules, ReadSpec, WriteSpec, normalise_separator
from quayside.functions import paths as P
from quayside.functions import text as X
from quayside.functions.crypto import apply_rules, apply_rules_to_lines
from quayside.operators import frames, governance, matching
from quayside.operators.ordering import page_rows
from quayside.plans.report import Report, report, watched
from quayside.session import scratch_path
from quayside.sinks import writers
from quayside.sources import archives, files


def convert(spark: SparkSession, source: str, path: str, read: ReadSpec, write: WriteSpec) -> Report:
    """Files of one format and codec to another."""
    frame = files.read_files(spark, source, read)
    if read.format not in files.COLUMNAR:
        frame = files.spread(frame)  # parsing is the costly part; columnar rows are not worth moving
    frame, seen = watched(frame, {})
    writers.write_files(frame, path, write)
    return report(path, seen)


def protect(
    spark: SparkSession,
    source: str,
    path: str,
    read: ReadSpec,
    write: WriteSpec,
    rules: Sequence[CryptoRule],
    keys: CipherKeys,
    mode: str = "encryption",
    home_prefix: str = "",
) -> Report:
    """Encrypt or decrypt columns and change the format in one pass; partitions come from the path.

    A value that cannot be turned becomes null and is counted, never logged. Only keys that stand in the path are
    added; a column of the data with such a name stays, and must agree with the path.
    """
    frame = files.read_files(spark, source, read)
    data_columns = frame.columns
    added = _present_keys(source, data_columns)
    located = files.with_path_partitions(_same_as_path(frame, source), added).select(*data_columns, *added)
    targets = sorted({data_columns[pos - 1] for rule in rules for pos in rule.col_pos})
    kept = files.spread(located).withColumns({f"_before_{name}": F.col(name).cast("string") for name in targets})
    turned = apply_rules(kept, rules, keys, mode, home_prefix)
    lost = {name: (F.col(f"_before_{name}") != "") & F.col(name).isNull() for name in targets}
    result, seen = watched(turned, lost)
    if write.merge and write.file_name is None:
        write = WriteSpec(write.format, write.compression, write.sep, write.header, True, merged_name(path, write))
    writers.write_files(result.select(*located.columns), path, write)
    return report(path, seen)


def _present_keys(source: str, have: Sequence[str]) -> list[str]:
    """Date keys in the path that the reader has not already added."""
    return [key for key in ("dt", "hh", "hm") if f"/{key}=" in source and key not in have]


def _same_as_path(frame: DataFrame, source: str) -> DataFrame:
    """``frame`` with its file metadata; a value of a date key that differs from the path's is an error."""
    rows = frame.select("*", "_metadata")
    for key in (k for k in ("dt", "hh", "hm") if f"/{k}=" in source and k in frame.columns):
        there = P.partition_value(F.col("_metadata.file_path"), key)
        fault = F.raise_error(F.concat(F.lit(f"column {key} differs from the path: "), F.col("_metadata.file_path")))
        rows = rows.withColumn(key, F.when(F.col(key).cast("string").eqNullSafe(there), F.col(key)).otherwise(fault.cast(frame.schema[key].dataType)))
    return rows


def merged_name(path: str, write: WriteSpec) -> str:
    """``tb_dt_hh_hm.format`` from a partition path."""
    segments = dict(part.split("=", 1) for part in path.split("/") if "=" in part)
    values = [segments[key] for key in ("tb", "dt", "hh", "hm") if key in segments]
    if "tb" not in segments:
        raise ValueError(f"no tb= in {path}")
    return "_".join(values) + f".{write.format}"


def land_delimited(
    spark: SparkSession,
    source: str | Sequence[str],
    path: str,
    read: ReadSpec,
    write: WriteSpec = WriteSpec(),
    bigint_mode: str = "trunc",
) -> Report:
    """Delimited text to typed parquet; an empty input still gives a file with the schema.

    Values that their type does not accept become null and are counted per column.
    """
    text = files.spread(files.read_text_columns(spark, source, read))
    return _write_typed(text, path, read.schema, write, bigint_mode)


def _write_typed(text: DataFrame, path: str, schema, write: WriteSpec, bigint_mode: str = "trunc") -> Report:
    both = files.typed_beside_text(text, schema, bigint_mode)
    names = [name for name, _ in files.fields_of(schema)]
    lost = {name: F.col(f"_text_{i}").isNotNull() & F.col(name).isNull() for i, name in enumerate(names)}
    result, seen = watched(both, lost)
    writers.write_files(result.select(*names), path, write)
    return report(path, seen)


def export_csv(
    df: DataFrame,
    path: str,
    sep: str = ",",
    zone: str | None = "Asia/Seoul",
    string_null: bool = False,
    compression: str = "none",
) -> str:
    """Text export without header: zoned timestamps, all columns as strings, nulls as empty fields.

    Values that hold a one-byte separator are quoted, with doubled quotes inside; longer
    separators are written without any quoting.
    """
    result = frames.zoned_timestamps(df, zone) if zone else df
    result = frames.all_strings(result)
    if string_null:
        result = frames.literal_nulls(result)
    if len(sep.encode()) > 1:
        return writers.write_lines(result, path, sep, compression)
    return writers.write_files(result, path, WriteSpec("csv", compression, sep, escape='"'))


def export_partition(
    spark: SparkSession,
    source: str,
    path: str,
    sep: str = ",",
    add_partitions: bool = False,
    merge: bool = False,
    string_null: bool = False,
    zone: str | None = "Asia/Seoul",
) -> str:
    """A landed parquet partition as text, optionally with its dt and hh as columns and in one file.

    Merged output is files of about 4 GiB; less than that is one file.
    """
    frame = files.read_files(spark, source, ReadSpec("parquet"))
    if add_partitions:
        keys = [key for key in _present_keys(source, ()) if key in ("dt", "hh")]
        if "dt" not in keys:
            raise ValueError(f"no dt= in {source}")
        data_columns = [c for c in frame.columns if c not in keys]
        frame = files.with_path_partitions(frame.select("*", "_metadata"), keys).select(*data_columns, *keys)
    if not merge:
        return export_csv(frame, path, sep, zone, string_null)
    staged = export_csv(frame, scratch_path(spark, "export"), sep, zone, string_null)
    writers.merge_text(spark, [staged], path, writers.MERGE_BYTES)
    return path


def land_text_files(
    spark: SparkSession,
    source: str,
    path: str,
    schema: Mapping,
    sep: str,
    rules: CryptoRules = CryptoRules(),
    keys: CipherKeys | None = None,
    home_prefix: str = "",
    delete_columns: Sequence[int] = (),
    from_archives: bool = False,
    raw_path: str | None = None,
    encoding: str = "UTF-8",
    header: bool = False,
) -> Report:
    """Raw text lines to typed parquet: ciphers by position, columns removed, all in one plan.

    ``schema`` names the columns before any is removed. With ``raw_path`` the readable
    lines are kept there as UTF-8: the incoming ones, or, for sources that arrive
    encrypted, the decrypted ones while the main path keeps them as they came.
    """
    if from_archives:
        lines = archives.read_archive_lines(spark, source, encoding).select(F.col("line").alias("value"))
    else:
        lines = files.read_lines(spark, source, encoding, header)
    incoming = files.spread(lines)
    if raw_path is None:
        incoming = incoming.where(F.col("value").contains(sep))
    else:  # bare lines stay in the readable copy
        incoming = incoming.withColumn("_line", F.col("value")).withColumn("_bare", ~F.col("value").contains(sep))
    turned = incoming
    for mode, wanted in (("encryption", rules.encryption), ("decryption", rules.decryption)):
        if wanted:
            turned = apply_rules_to_lines(turned, sep, wanted, keys, mode, home_prefix, drop_bare=raw_path is None)
    processed = turned
    if raw_path is not None:
        processed = _kept_apart(spark, incoming, turned, raw_path, rules.already_encrypted)
    names = [name for name, _ in files.fields_of(schema)]
    text = frames.drop_columns(files.split_lines(processed, sep, names), delete_columns)
    kept = {"fields": [f for i, f in enumerate(schema["fields"], start=1) if i not in set(delete_columns)]}
    return _write_typed(text, path, kept, WriteSpec())


def _kept_apart(spark: SparkSession, incoming: DataFrame, turned: DataFrame, raw_path: str, already_encrypted: bool) -> DataFrame:
    """Write the readable lines to ``raw_path`` and give back the others, out of one pass over the source and the cipher.

    Each line is written once for either side into one partitioned table; the readable side's folder then becomes ``raw_path`` by a
    rename, and the other side is read on from where it was stored.
    """
    readable, sealed = ("value", "_line") if already_encrypted else ("_line", "value")
    sides = F.array(
        F.when(~F.col("_bare") | F.lit(not already_encrypted), F.struct(F.lit("readable").alias("side"), F.col(readable).alias("value"))),
        F.when(~F.col("_bare"), F.struct(F.lit("landed").alias("side"), F.col(sealed).alias("value"))),
    )
    place = scratch_path(spark, "sides")
    both = turned.select(F.explode(F.array_compact(sides)).alias("s")).select("s.side", "s.value")
    both.write.partitionBy("side").option("lineSep", "\n").text(place)
    writers.replace_folder(spark, f"{place}/side=readable", raw_path)
    landed = f"{place}/side=landed"
    return spark.read.option("lineSep", "\n").text(landed) if writers.exists(spark, landed) else incoming.select("value").limit(0)


def redelimit(
    spark: SparkSession, source: str, path: str, old: str, new: str | None = None, encoding: str = "UTF-8", target_encoding: str = "UTF-8"
) -> str:
    """Text files with another separator and charset; values stay as they are.

    Without ``new`` a known separator of several characters becomes the record separator, and any other one stays.
    """
    new = normalise_separator(old) if new is None else new
    lines = files.read_lines(spark, source, encoding)
    changed = lines.select(X.replace_separator(F.col("value"), old, new).alias("value"))
    return writers.write_lines(changed, path, new, encoding=target_encoding)


def rows_to_lines(rows: DataFrame, order_by: Sequence[str], page_size: int, sep: str = "\x1e") -> DataFrame:
    """Extracted rows as text lines with their page."""
    columns = rows.columns
    paged = page_rows(rows, order_by, page_size)
    return paged.select("rn", "page", X.row_as_line([F.col(c) for c in columns], sep).alias("line"))


def extract_rows(
    rows: DataFrame, order_by: Sequence[str], page_size: int, text_path: str, path: str, schema: Mapping, sep: str = "\x1e"
) -> Report:
    """Extracted rows, of JDBC or any other source, to text lines in a folder for each page, and these to typed parquet.

    ``schema`` names the columns in their order. Marked and binary columns are decoded; line breaks inside values are
    cut; nulls are written as ``null`` and come back as nulls, and so does that word. No rows give no page, and a file with
    the schema.
    """
    spark = rows.sparkSession
    lines = rows_to_lines(frames.decode_marked(rows), order_by, page_size, sep)
    ordered = lines.sortWithinPartitions("page", "rn").select("page", F.col("line").alias("value"))
    writers.write_text_pages(ordered, text_path)
    names = [name for name, _ in files.fields_of(schema)]
    back = spark.read.text(text_path, lineSep="\n").select("value")
    return _write_typed(frames.literal_nulls(files.split_lines(back, sep, names)), path, schema, WriteSpec())


def sample_files(spark: SparkSession, inventory: DataFrame) -> DataFrame:
    """``path, reader, column_name, index, value``: five sampled values of each listed column of each inventoried file.

    ``inventory`` has ``path``, ``format``, ``sep``, ``fields`` (all column names of a text file) and ``columns`` (those
    to sample). Files alike in all but the path share a scan; the driver gets the inventory to plan the scans, and
    no data. Values are taken in the order of their hash. A file that no reader fits gives one row without reader and value.
    """
    shape = ["reader", "sep", "fields", "columns"]
    listed = inventory.withColumn("reader", files.format_of(F.col("path"), F.col("format"), F.col("sep")))
    unread = listed.where("reader IS NULL").selectExpr("path", "reader", "NULL AS column_name", "CAST(NULL AS int) AS index", "NULL AS value")
    taken = [unread.select(*[F.col(c).cast("int" if c == "index" else "string").alias(c) for c in unread.columns])]
    for kind in listed.where("reader IS NOT NULL").groupBy(*shape).agg(F.array_sort(F.collect_list("path")).alias("paths")).collect():
        places = [files.escape_glob(p) for p in kind["paths"]]
        if kind["reader"] == "csv":
            names = {"fields": [{"name": name, "type": "string"} for name in kind["fields"]]}
            found = files.read_text_columns(spark, places, ReadSpec("csv", kind["sep"], schema=names))
        else:
            found = files.read_files(spark, places, ReadSpec(kind["reader"]))
        wanted = found.select(F.col("_metadata.file_path").alias("_path"), *[F.col(f"`{c}`") for c in kind["columns"]])
        cells = governance.sampled(frames.to_long(wanted, ["_path"], kind["columns"]), ["_path", "column_name"], [F.md5("value"), "value"])
        taken.append(cells.select(F.col("_path").alias("path"), F.lit(kind["reader"]).alias("reader"), "column_name", "index", "value"))
    return frames.concat_all(taken)


def avro_to_delimited(spark: SparkSession, source: str, path: str, sep: str = "\x1e") -> str:
    """Avro partition to unquoted text; needs the spark-avro package."""
    return writers.write_lines(files.read_files(spark, source, ReadSpec("avro")), path, sep)


def discover(spark: SparkSession, schema_dir: str, ddl_dir: str) -> DataFrame:
    """Sensitive columns of a catalogue folder."""
    return governance.discover_sensitive(
        files.read_schema_catalogue(spark, schema_dir), files.read_ddl_texts(spark, ddl_dir)
    )


def plan_delivery(landed: DataFrame, path: str, rules: DataFrame) -> DataFrame:
    """Landed paths × delivery rules, with the destination of each delivery.

    ``rules`` has collect_dir and target_dir columns; directories without a
    matching rule give no row.
    """
    matched = matching.join_contained(landed, path, rules, "collect_dir")
    return matched.withColumn("dest_path", P.target_path(F.col("target_dir"), P.partitions_of(F.col(path))))
