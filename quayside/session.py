"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Cipher keys are literals of aes_* expressions; this keeps them out of plan text.
_REDACT = r"(?i)aes_?(en|de)crypt\([^\n]*"

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",  # bytes that do not decode become replacement characters
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.redaction.string.regex": _REDACT,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

_local_folders: dict[str, str] = {}
_scratch: dict[str, list[str]] = {}
_shipped: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job of this package relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "quayside", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("QUAYSIDE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach, from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary
    folder of its own. A cluster session without it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="quayside-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_folder(spark)}/quayside/{label}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables of this application; for the end of a job."""
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in paths:
        target = hadoop.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, for the few operators that run Python in tasks."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    bundle = Path(tempfile.mkdtemp(prefix="quayside-")) / "quayside.zip"
    with zipfile.ZipFile(bundle, "w") as target:
        for source in sorted(root.rglob("*.py")):
            target.write(source, source.relative_to(root.parent))
    context.addPyFile(str(bundle))
    _shipped.add(context.applicationId)


def local_table(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A small configuration table held in the plan itself; reading it needs no Python worker."""
    return spark.createDataFrame(pa.table(columns))


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps then start from stored files: a lost executor re-reads its part
    instead of recomputing the whole lineage, and everything that refers to the
    result sees the same rows in the same parts.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
