"""Landing by manifest: faults stay with their file, and what has landed lands once."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.crypto import sep_regex
from quayside.schema import fields_of
from quayside.session import settle, ship_package
from quayside.sinks.publish import publish, published, read_published
from quayside.sources import files

#: Causes a file is refused for, in the order in which they are looked for.
CAUSES = ("missing", "damaged", "empty", "charset", "fields")
LOG_SCHEMA = "path string, length long, modified timestamp, status string, cause string, lines long, faulty long, run string"
_CHUNK = 1 << 20


def _tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether a gzip file unpacks to its end; what is unpacked is thrown away piece by piece."""
    for batch in batches:
        sound = []
        for content in batch.column(1):
            data, good, tool = memoryview(content.as_buffer()), True, zlib.decompressobj(31)
            try:
                rest = data
                while rest:
                    tool.decompress(rest, _CHUNK)
                    rest = tool.unconsumed_tail
                    if tool.eof and tool.unused_data:  # members may follow each other
                        rest, tool = tool.unused_data, zlib.decompressobj(31)
                good = tool.eof
            except zlib.error:
                good = False
            sound.append(good)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sound, pa.bool_())], names=["path", "sound"])


def _sound_archives(spark: SparkSession, listed: DataFrame) -> DataFrame:
    """``path, sound`` of gzip files. A reader that comes upon a broken one would otherwise end the job, or lose its rest unseen."""
    packed = [r["path"] for r in listed.where(F.lower("path").endswith(".gz")).select("path").collect()]
    if not packed:
        return spark.createDataFrame([], "path string, sound boolean")
    ship_package(spark)
    content = spark.read.format("binaryFile").load([files.escape_glob(p) for p in packed]).select("path", "content")
    return content.mapInArrow(_tested, "path string, sound boolean")


def _empty_files(spark: SparkSession, unlisted: DataFrame) -> DataFrame:
    """Those of the named files that are there and empty; a scan does not list them."""
    jvm, conf, found = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for row in unlisted.collect():
        place = jvm.org.apache.hadoop.fs.Path(row["path"])
        if place.getFileSystem(conf).exists(place):
            when = place.getFileSystem(conf).getFileStatus(place).getModificationTime()
            found.append((row["path"], 0, when))
    rows = spark.createDataFrame(found, "path string, length long, millis long")
    return rows.select("path", "length", F.timestamp_millis("millis").alias("modified"))


def _located(path: Column) -> Column:
    """A path as Hadoop spells it: one slash where there is no authority."""
    return F.regexp_replace(path, "^([a-z0-9]+):///", "$1:/")


def _plain(path: Column) -> Column:
    """The path that a row's metadata give as a URI."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _below(spark: SparkSession, folder: str, path: Column) -> Column:
    """A path with the scheme of its folder, where it has none of its own."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    whole = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()
    scheme = whole[: len(whole) - len(place.toUri().getPath())]
    return _located(F.when(path.startswith("/"), F.concat(F.lit(scheme), path)).otherwise(path))


def land_manifest(
    spark: SparkSession, manifest: DataFrame, folder: str, path: str, schema: Mapping, sep: str, run: str, encoding: str = "UTF-8"
) -> DataFrame:
    """Land the files that ``manifest(path)`` names and that have not landed yet; returns the log of this run.

    ``folder`` holds the files. A file lands whole or not at all: it is refused if it is missing, a gzip file that does not unpack, empty,
    not in the charset, or has a line with another number of fields, and then gives a log row with the cause and the number of
    faulty lines. Refused files are tried again by the next run, and a landed one if its size or time has changed.

    All files are read in one pass whose lines are kept with their path in the shared folder, judged per file by a partial
    aggregate, and typed where their file is sound. Rows and log are published as partitions ``run=`` by one pointer each, rows
    first: a run that breaks in between is repeated under its name and replaces its own rows.
    """
    names = [name for name, _ in fields_of(schema)]
    named = manifest.select(_below(spark, folder, F.col("path")).alias("path")).distinct()
    there = files.list_files(spark, folder).withColumn("path", _located(F.col("path")))
    log = read_published(spark, f"{path}/log", LOG_SCHEMA).where((F.col("status") == "landed") & (F.col("run") != run))
    there = there.unionByName(_empty_files(spark, named.join(there, "path", "left_anti")))
    listed = named.join(there, "path", "left").join(log.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")
    listed = settle(listed, "listed")

    here = listed.where("length IS NOT NULL")
    sound = settle(_sound_archives(spark, here).withColumn("path", _located(F.col("path"))), "sound")
    whole = here.join(sound.where("NOT sound"), "path", "left_anti")
    places = [files.escape_glob(r["path"]) for r in whole.select("path").collect()]  # the manifest itself is the driver's, never a file's content
    if places:
        read = spark.read.text(places).select(_located(_plain(F.col("_metadata.file_path"))).alias("path"), files.decoded(F.col("value"), encoding).alias("value"))
    else:
        read = spark.createDataFrame([], "path string, value string")
    lines = settle(read.withColumn("n", F.size(F.split("value", sep_regex(sep), -1))), "lines")
    garbled = F.col("value").contains("�")
    judged = lines.groupBy("path").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(garbled).alias("garbled"), F.count_if((F.col("n") != len(names)) & ~garbled).alias("uneven")
    )
    cause = (
        F.when(F.col("length").isNull(), "missing")
        .when(~F.coalesce("sound", F.lit(True)), "damaged")
        .when(F.coalesce("lines", F.lit(0)) == 0, "empty")
        .when(F.col("garbled") > 0, "charset")
        .when(F.col("uneven") > 0, "fields")
    )
    verdict = listed.join(judged, "path", "left").join(sound, "path", "left").withColumn("cause", cause)
    verdict = verdict.select(
        "path",
        "length",
        "modified",
        F.when(F.col("cause").isNull(), "landed").otherwise("refused").alias("status"),
        "cause",
        F.coalesce("lines", F.lit(0)).cast("long").alias("lines"),
        F.coalesce(F.col("garbled") + F.col("uneven"), F.lit(0)).cast("long").alias("faulty"),
        F.lit(run).alias("run"),
    )
    verdict = settle(verdict, "verdict")

    good = lines.join(verdict.where("status = 'landed'").select("path"), "path", "left_semi")
    typed = files.typed_columns(files.split_lines(good, sep, names), schema)
    publish(typed.withColumn("run", F.lit(run)), f"{path}/rows", ["run"])
    publish(verdict, f"{path}/log", ["run"])
    return verdict


def read_landed(spark: SparkSession, path: str, row_schema: str) -> DataFrame:
    """The rows of all runs that have been logged; rows of a run that broke before its log are not seen."""
    logged = published(spark, f"{path}/log")
    rows = read_published(spark, f"{path}/rows", f"{row_schema}, run string")
    return rows.where(F.col("run").isin([k.removeprefix("run=") for k in logged])) if logged else rows.limit(0)
