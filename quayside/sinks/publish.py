"""Publishing partitions so that a reader sees the old or the new ones and never a mixture.

Every publication writes its partitions to folders of its own, ``k=v/publication=<id>``. Which publication of each partition
counts is said by one small pointer file, and the publication is done when a new pointer is renamed over the old one,
which is a single step of the file system. A run that breaks before that has changed nothing that readers see; what it left
behind is swept away later. The driver handles one line per partition and no file.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import WriteSpec

POINTER, PUBLICATION = "_published", "publication"


def _places(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm, target.getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)


def published(spark: SparkSession, path: str) -> dict[str, str]:
    """Partition folder to publication, as the pointer says; empty if nothing has been published."""
    jvm, fs, _ = _places(spark, path)
    pointer = jvm.org.apache.hadoop.fs.Path(path, POINTER)
    if not fs.exists(pointer):
        return {}
    stream = fs.open(pointer)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return dict(line.split("\t", 1) for line in text.splitlines())


def _point(spark: SparkSession, path: str, listed: dict[str, str]) -> None:
    jvm, fs, context = _places(spark, path)
    make = jvm.org.apache.hadoop.fs.Path
    fresh = make(path, f"{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(fresh, False)
    out.write(bytearray("".join(f"{k}\t{v}\n" for k, v in sorted(listed.items())).encode()))
    out.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fresh, make(path, POINTER), over)


def _folders(spark: SparkSession, path: str, depth: int) -> list[tuple[str, str]]:
    """``(partition folder, publication)`` of all publication folders."""
    jvm, fs, _ = _places(spark, path)
    make = jvm.org.apache.hadoop.fs.Path
    root = fs.makeQualified(make(path)).toString().rstrip("/")
    found = fs.globStatus(make(path, "/".join(["*=*"] * depth + [f"{PUBLICATION}=*"])))
    names = [status.getPath().toString().removeprefix(root + "/") for status in found or []]
    return [tuple(name.rsplit(f"/{PUBLICATION}=", 1)) for name in names]


def stage(df: DataFrame, path: str, keys: Sequence[str], spec: WriteSpec = WriteSpec()) -> str:
    """Write the partitions of a publication beside those that are read; returns its name."""
    name = uuid.uuid4().hex
    spread = df.hint("rebalance", *[F.col(k) for k in keys]).withColumn(PUBLICATION, F.lit(name))
    writer = spread.write.format(spec.spark_format).mode("append").option("compression", spec.codec)
    writer.partitionBy(*keys, PUBLICATION).save(path)
    return name


def commit(spark: SparkSession, path: str, keys: Sequence[str], name: str) -> list[str]:
    """Let the partitions of a publication count, all at once; others keep theirs. Doing it again changes nothing."""
    fresh = {folder: found for folder, found in _folders(spark, path, len(keys)) if found == name}
    _point(spark, path, {**published(spark, path), **fresh})
    return sorted(fresh)


def publish(df: DataFrame, path: str, keys: Sequence[str], spec: WriteSpec = WriteSpec()) -> list[str]:
    """Replace the partitions at hand in one step; returns their folders."""
    return commit(df.sparkSession, path, keys, stage(df, path, keys, spec))


def read_published(spark: SparkSession, path: str, schema, spec: WriteSpec = WriteSpec()) -> DataFrame:
    """The partitions that count now, with their keys as columns; ``schema`` is that of the data and keys."""
    listed = published(spark, path)
    columns = spark.createDataFrame([], schema).columns
    if not listed:
        return spark.createDataFrame([], schema)
    folders = [f"{path.rstrip('/')}/{folder}/{PUBLICATION}={name}" for folder, name in sorted(listed.items())]
    return spark.read.format(spec.spark_format).schema(schema).option("basePath", path).load(folders).select(*columns)


def sweep(spark: SparkSession, path: str, keys: Sequence[str]) -> int:
    """Delete folders of publications that broke or were replaced; for a time when no other run publishes or reads old ones."""
    jvm, fs, _ = _places(spark, path)
    listed, gone = published(spark, path), 0
    for folder, name in _folders(spark, path, len(keys)):
        if listed.get(folder) != name:
            gone += bool(fs.delete(jvm.org.apache.hadoop.fs.Path(path, f"{folder}/{PUBLICATION}={name}"), True))
    return gone
