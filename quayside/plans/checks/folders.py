"""Folders, file names, markers and catalogues: written, read back and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import CryptoRule, ReadSpec, WriteSpec, normalise_separator
from quayside.plans import jobs
from quayside.plans.registry import CHECK_KEYS, check, table
from quayside.session import scratch_path
from quayside.sinks import writers
from quayside.sources import files


def _texts(*names: str) -> dict:
    return {"fields": [{"name": name, "type": "string"} for name in names]}


@check(
    "redelimit_files",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderpriority FROM orders",
)
def redelimit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of lines with a separator of several characters, found by a glob and written anew with the one it becomes."""
    source, path = scratch_path(spark, "pipes"), scratch_path(spark, "records")
    columns = ["o_orderkey", "o_custkey", "o_orderpriority"]
    orders = table(spark, sf_dir, "orders").select(*columns, (F.col("o_custkey") % 4).alias("page"))
    writers.write_text_pages(orders.select(writers.as_lines(orders.select(*columns), "|^|").alias("value"), "page"), source)
    jobs.redelimit(spark, f"{source}/page=*", path, "|^|")
    return files.read_text_columns(spark, path, ReadSpec("csv", normalise_separator("|^|"), schema=_texts(*columns)))


@check("file_count", "SELECT c_custkey, c_name, 3 AS files FROM customer")
def file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A format change with the number of files set."""
    source, path = scratch_path(spark, "many"), scratch_path(spark, "three")
    table(spark, sf_dir, "customer").select("c_custkey", "c_name").repartition(7).write.parquet(source)
    jobs.convert(spark, source, path, ReadSpec("parquet"), WriteSpec("orc", files=3))
    written = spark.read.orc(path)
    return written.withColumn("files", written.select(F.count_distinct("_metadata.file_name").cast("int")).scalar())


@check(
    "merged_file",
    "SELECT c_custkey, c_mktsegment, '20240102' AS dt, 'customer_20240102.parquet' AS file FROM customer",
)
def merged_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partition encrypted into one file, named after its path, and decrypted again."""
    source, path, back = (f"{scratch_path(spark, name)}/db=sales/tb=customer/dt=20240102" for name in ("plain", "sealed", "opened"))
    table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").repartition(5).write.parquet(source)
    rules = [CryptoRule("mdn", [2])]
    jobs.protect(spark, source, path, ReadSpec("parquet"), WriteSpec("parquet", merge=True), rules, CHECK_KEYS)
    jobs.protect(spark, path, back, ReadSpec("parquet"), WriteSpec("parquet", merge=True), rules, CHECK_KEYS, "decryption")
    return spark.read.parquet(back).select("c_custkey", "c_mktsegment", F.col("dt").cast("string").alias("dt"), F.col("_metadata.file_name").alias("file"))


@check(
    "partitions_replaced",
    """
    SELECT o_orderkey, o_orderpriority, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS load FROM orders
    WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0
    """,
)
def partitions_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load clears and fills only the partitions it brings."""
    path = scratch_path(spark, "loads")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    writers.write_partitions(orders.withColumn("load", F.lit(1)), path, ["o_orderstatus"])
    writers.write_partitions(orders.where("o_orderstatus = 'F' AND o_orderkey % 2 = 0").withColumn("load", F.lit(2)), path, ["o_orderstatus"])
    return spark.read.parquet(path)


@check(
    "report_and_marker",
    r"""
    SELECT c_custkey, c_name || ' "' || c_mktsegment || '" \ ' || chr(30) AS note, 'false,true' AS marked FROM customer
    """,
)
def report_and_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report with quotes, backslashes and separators in its values, and a marker beside it once it is complete."""
    path = scratch_path(spark, "report")
    note = F.concat("c_name", F.lit(' "'), "c_mktsegment", F.lit('" \\ \x1e'))
    people = table(spark, sf_dir, "customer").select("c_custkey", note.alias("note"))
    writers.write_report(people, path)
    before = writers.exists(spark, f"{path}/_customer.CHK")
    found = spark.read.csv(path, sep="\x1e", escape="\\", header=True, schema="c_custkey long, note string")
    if found.count() == people.count():
        writers.write_marker(spark, f"{path}/_customer.CHK")
    marked = f"{before},{writers.exists(spark, f'{path}/_customer.CHK')}".lower()
    return found.withColumn("marked", F.lit(marked))


@check(
    "catalogue_folder",
    """
    WITH tables AS (SELECT p_brand, count(*) AS n, max(p_size) AS largest FROM part GROUP BY p_brand),
    names AS (SELECT DISTINCT p_brand, replace(p_name, ' ', '_') || '_imsi' AS name FROM part)
    SELECT '/db=parts/tb=' || replace(p_brand, '#', '_') AS path, CAST(0 AS INTEGER) AS index, 'size_' || largest AS name,
           '단말 번호 ' || n AS comment, 'comment' AS rule FROM tables WHERE n % 2 = 0
    UNION ALL
    SELECT '/db=parts/tb=' || replace(p_brand, '#', '_'), CAST(row_number() OVER (PARTITION BY p_brand ORDER BY name) AS INTEGER), name, NULL, 'name'
    FROM names WHERE p_brand IN (SELECT p_brand FROM tables WHERE n % 2 = 1)
    """,
)
def catalogue_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensitive columns of a folder with a schema file for each brand and one of table definitions."""
    part = table(spark, sf_dir, "part").withColumn("name", F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_imsi")))
    stem = F.concat(F.lit("parts."), F.replace("p_brand", F.lit("#"), F.lit("_")))
    brands = part.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"),
        F.concat(F.lit("size_"), F.max("p_size").cast("string")).alias("first"),
        F.array_sort(F.collect_set("name")).alias("names"),
    )
    declared = F.transform(F.concat(F.array("first"), "names"), lambda n: F.struct(n.alias("name"), F.lit("string").alias("type")))
    note = F.when(F.col("n") % 2 == 0, F.concat(F.lit("단말 번호 "), F.col("n").cast("string"))).otherwise("plain")
    ddl = F.concat(F.lit("CREATE TABLE x (\n  `"), "first", F.lit("` string COMMENT '"), note, F.lit("')"))
    schemas = brands.select(stem.alias("stem"), F.to_json(F.struct(declared.alias("fields"))).alias("value"))
    folders = [_one_file_each(schemas, ".json"), _one_file_each(brands.select(stem.alias("stem"), ddl.alias("value")), ".hql")]
    return jobs.discover(spark, *folders).select("path", "index", "name", "comment", "rule")


def _one_file_each(texts: DataFrame, suffix: str) -> str:
    """A folder with the file ``stem`` and ``suffix`` for each row; a catalogue has few."""
    spark, staged, folder = texts.sparkSession, scratch_path(texts.sparkSession, "staged"), scratch_path(texts.sparkSession, "catalogue")
    texts.write.partitionBy("stem").text(staged)
    for name, _ in writers.data_files(spark, staged):
        writers.move(spark, f"{staged}/{name}", f"{folder}/{name.split('/')[0].removeprefix('stem=')}{suffix}")
    return folder
