"""Archives of documents, packed by tasks into the shared folder and read back line by line."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.plans.registry import check, table
from quayside.session import scratch_path, ship_package
from quayside.sources import archives


def packed(kind: str, members: Iterator[tuple[str, bytes]]) -> bytes:
    """The bytes of one zip or tar.gz archive."""
    target = io.BytesIO()
    if kind == "zip":
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as bundle:
            for name, content in members:
                bundle.writestr(name, content)
    else:
        with tarfile.open(fileobj=target, mode="w:gz") as bundle:
            for name, content in members:
                entry = tarfile.TarInfo(name)
                entry.size = len(content)
                bundle.addfile(entry, io.BytesIO(content))
    return target.getvalue()


def pack_documents(spark: SparkSession, sf_dir: str) -> str:
    """One archive per batch of documents, a member per document.

    An archive is named after its first document, so a repeated task writes it again.
    """
    ship_package(spark)
    folder = scratch_path(spark, "archives")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for kind, part in (("zip", batch[::2]), ("tar.gz", batch[1::2])):
                if part.empty:
                    continue
                path = f"{folder}/a{part['doc_id'].iloc[0]}.{kind}"
                system, inner = fs.FileSystem.from_uri(path)
                system.create_dir(inner.rpartition("/")[0], recursive=True)
                members = ((f"in/{i}.txt", t.encode()) for i, t in zip(part["doc_id"], part["text"]))
                with system.open_output_stream(inner, compression=None) as out:
                    out.write(packed(kind, members))
                yield pd.DataFrame({"members": [len(part)]})

    documents = table(spark, sf_dir, "documents", wide=True).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    documents.mapInPandas(pack, "members long").agg(F.sum("members")).first()
    return folder


_LINES_SQL = """
    WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
    l AS (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS line_no, len(parts) AS n FROM d)
    SELECT doc_id, line_no, md5(rtrim(line, chr(13))) AS line_md5 FROM l WHERE NOT (line_no = n AND line = '')
"""


@check("archive_lines", _LINES_SQL)
def archive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document, out of zip and tar.gz archives."""
    lines = archives.read_archive_lines(spark, pack_documents(spark, sf_dir))
    document = F.regexp_extract("member", r"in/(\d+)\.txt", 1).cast("bigint")
    return lines.select(document.alias("doc_id"), "line_no", F.md5("line").alias("line_md5"))


@check("archive_members", "SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS size FROM documents")
def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of the archives and their sizes, without reading their content."""
    members = archives.list_members(spark, pack_documents(spark, sf_dir))
    return members.select(F.regexp_extract("member", r"in/(\d+)\.txt", 1).cast("bigint").alias("doc_id"), "size")
