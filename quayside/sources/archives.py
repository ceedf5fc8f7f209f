"""Text members of tar, tar.gz and zip archives as rows."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import ship_package

LINES = "archive string, member string, line_no bigint, line string"
MEMBERS = "archive string, member string, size bigint"

WHOLE_BYTES = 256 * 1024**2
_BATCH = 10_000
_NAMES = r"\.(zip|tar|tar\.gz|tgz)$"


def _members(name: str, stream) -> Iterator[tuple[str, int, Callable]]:
    """Name, size and opener of each file in an archive."""
    if name.endswith(".zip"):
        with zipfile.ZipFile(stream) as bundle:
            for item in bundle.infolist():
                if not item.is_dir():
                    yield item.filename, item.file_size, lambda item=item: bundle.open(item)
    else:
        with tarfile.open(fileobj=stream, mode="r:" if name.endswith(".tar") else "r:gz") as bundle:
            for item in bundle:
                if item.isfile():
                    yield item.name, item.size, lambda item=item: bundle.extractfile(item)


@contextmanager
def _stored(path: str):
    """A large archive opened where it is stored, without loading it."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    with system.open_input_file(inner) as stream:
        yield stream


def _frames(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    batch: list[tuple] = []
    for row in rows:
        batch.append(row)
        if len(batch) >= _BATCH:
            yield pd.DataFrame(batch, columns=columns)
            batch = []
    if batch:
        yield pd.DataFrame(batch, columns=columns)


def _lines(archive: str, member: str, opened, encoding: str) -> Iterator[tuple]:
    text = io.TextIOWrapper(opened, encoding=encoding, errors="replace", newline="\n")
    for number, line in enumerate(text, start=1):
        yield archive, member, number, line.rstrip("\r\n")


def _archives(spark: SparkSession, path: str) -> DataFrame:
    ship_package(spark)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.where(F.col("path").rlike(_NAMES))


def list_members(spark: SparkSession, path: str) -> DataFrame:
    """Archive, member and size of every file in every archive."""
    return _listed(_archives(spark, path).select("path"))


def _listed(paths: DataFrame) -> DataFrame:
    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                with _stored(path) as stream:
                    found = ((path, member, size) for member, size, _ in _members(path, stream))
                    yield from _frames(found, ["archive", "member", "size"])

    return paths.repartition("path").mapInPandas(listed, MEMBERS)


def read_archive_lines(
    spark: SparkSession, path: str, encoding: str = "utf-8", whole_bytes: int = WHOLE_BYTES
) -> DataFrame:
    """Every line of every member, in batches of bounded size.

    Small archives are opened from memory, one task for many. Large ones are opened
    where they are stored: zip and plain tar files member by member in separate
    tasks, compressed tar files front to back, as their format demands.
    """
    columns = ["archive", "member", "line_no", "line"]

    def from_memory(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                for member, _, opened in _members(name, io.BytesIO(content)):
                    yield from _frames(_lines(name, member, opened(), encoding), columns)

    def front_to_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["path"]:
                with _stored(name) as stream:
                    for member, _, opened in _members(name, stream):
                        yield from _frames(_lines(name, member, opened(), encoding), columns)

    def by_member(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, wanted in batch.groupby("archive")["member"]:
                names = set(wanted)
                with _stored(name) as stream:
                    for member, _, opened in _members(name, stream):
                        if member in names:
                            yield from _frames(_lines(name, member, opened(), encoding), columns)

    found = _archives(spark, path)
    large = found.where(F.col("length") > whole_bytes).select("path")
    sequential = F.col("path").rlike(r"gz$")
    small = found.where(F.col("length") <= whole_bytes).select("path", "content")
    members = _listed(large.where(~sequential)).select("archive", "member").repartition("archive", "member")
    return (
        small.mapInPandas(from_memory, LINES)
        .unionByName(large.where(sequential).repartition("path").mapInPandas(front_to_back, LINES))
        .unionByName(members.mapInPandas(by_member, LINES))
    )
