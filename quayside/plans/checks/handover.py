"""Checks of landing by manifest, atomic publication, bins of bytes, and where copies differ."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.operators import copies, matching
from quayside.plans import manifest
from quayside.plans.registry import check, table
from quayside.session import scratch_path, settle
from quayside.sinks import bins, publish, writers
from quayside.sources import files
from quayside.streaming.messages import consume, file_messages

#: Orders are dealt to so many files; what is wrong with a file follows from its number.
FILES = 40
_FAULTS = {3: "fields", 5: "charset", 7: "empty", 11: "missing", 13: "damaged"}
_ORDER_FIELDS = {"fields": [{"name": "o_orderkey", "type": "bigint"}, {"name": "o_totalprice", "type": "double"}, {"name": "o_orderpriority", "type": "string"}]}


def _fault(number: Column) -> Column:
    found = F.lit(None).cast("string")
    for divisor, cause in sorted(_FAULTS.items()):
        found = F.when(number % divisor == divisor - 1, cause).otherwise(found)
    return found


_SQL_FAULT = " ".join(f"WHEN file % {d} = {d - 1} THEN '{c}'" for d, c in sorted(_FAULTS.items(), reverse=True))


def _order_files(spark: SparkSession, sf_dir: str) -> str:
    """Orders as text files, one in a folder for each number, some of them broken: one line cut short, bytes of another charset,
    nothing in it, not there, or a gzip file cut off."""
    folder = scratch_path(spark, "arrived")
    orders = table(spark, sf_dir, "orders").withColumn("file", (F.col("o_orderkey") % FILES).cast("int"))
    orders = orders.withColumn("fault", _fault(F.col("file"))).where("fault IS NULL OR fault <> 'missing'")
    first = F.col("o_orderkey") == F.min("o_orderkey").over(Window.partitionBy("file"))
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string"), "o_orderpriority")
    line = F.when((F.col("fault") == "fields") & first, F.col("o_orderkey").cast("string")).otherwise(line)
    broken = F.concat(F.encode(line, "UTF-8"), F.unhex(F.lit("c328"))).cast("string")
    line = F.when((F.col("fault") == "charset") & first, broken).otherwise(line)
    text = orders.where("fault IS NULL OR fault IN ('fields', 'charset')").select("file", line.alias("value"))
    text.repartition(FILES, "file").write.partitionBy("file").text(folder)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for number in range(FILES):
        cause = next((c for d, c in sorted(_FAULTS.items(), reverse=True) if number % d == d - 1), None)
        place = jvm.org.apache.hadoop.fs.Path(f"{folder}/file={number}/part.txt{'.gz' if cause == 'damaged' else ''}")
        if cause in ("empty", "damaged"):
            out = place.getFileSystem(conf).create(place, True)
            out.write(bytearray(bytes.fromhex("1f8b0800000000000003cb48cdc9") if cause == "damaged" else b""))
            out.close()
    return folder


def _named_files(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest: what is there, and one name for each file that is not."""
    listed = writers.data_files(spark, folder)
    named = {int(name.split("/")[0].removeprefix("file=")): f"{folder}/{name}" for name, _ in listed}
    return spark.createDataFrame([(n, named.get(n, f"{folder}/file={n}/part.txt")) for n in range(FILES)], "file int, path string")


@check(
    "landing_faults",
    f"""
    WITH numbered AS (SELECT (o_orderkey % {FILES})::INT AS file, o_totalprice FROM orders),
    causes AS (SELECT file, CASE {_SQL_FAULT} END AS cause FROM range({FILES}) t(file)),
    held AS (SELECT file, count(*) AS n, sum(o_totalprice) AS total FROM numbered GROUP BY file)
    SELECT c.file::INT AS file, CASE WHEN cause IS NULL THEN 'landed' ELSE 'refused' END AS status, cause,
           CASE WHEN cause IS NULL OR cause IN ('fields', 'charset') THEN coalesce(n, 0) ELSE 0 END AS lines,
           CASE WHEN cause IN ('fields', 'charset') THEN 1 ELSE 0 END::BIGINT AS faulty,
           CASE WHEN cause IS NULL THEN coalesce(n, 0) ELSE 0 END AS landed_rows, round(CASE WHEN cause IS NULL THEN total END, 2) AS landed_total,
           0::BIGINT AS landed_again
    FROM causes c LEFT JOIN held h ON h.file = c.file
    WHERE n IS NOT NULL
    """,
)
def landing_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken files give a log row each and keep no other file from landing; the second run lands nothing twice."""
    folder, path = _order_files(spark, sf_dir), scratch_path(spark, "landed")
    named = settle(_named_files(spark, folder), "manifest")
    rows = "o_orderkey long, o_totalprice double, o_orderpriority string"
    first = manifest.land_manifest(spark, named, folder, path, _ORDER_FIELDS, "|", "first")
    second = manifest.land_manifest(spark, named, folder, path, _ORDER_FIELDS, "|", "second")
    landed = manifest.read_landed(spark, path, rows).groupBy((F.col("o_orderkey") % FILES).cast("int").alias("file"), "run")
    sums = landed.agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    sums = sums.groupBy("file").agg(
        F.sum(F.when(F.col("run") == "first", F.col("n"))).alias("landed_rows"),
        F.sum(F.when(F.col("run") == "first", F.col("total"))).alias("landed_total"),
        F.sum(F.when(F.col("run") == "second", F.col("n"))).alias("again"),
    )
    number = F.regexp_extract("path", "file=([0-9]+)/", 1).cast("int")
    seen = first.withColumn("file", number).join(second.where("status = 'landed'").select(number.alias("file"), F.lit(1).alias("twice")), "file", "left")
    asked = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % FILES).cast("int").alias("file")).distinct()
    out = seen.join(asked, "file").join(sums, "file", "left")
    return out.select(
        "file",
        "status",
        "cause",
        "lines",
        "faulty",
        F.coalesce("landed_rows", F.lit(0)).alias("landed_rows"),
        F.round("landed_total", 2).alias("landed_total"),
        (F.coalesce("again", F.lit(0)) + F.coalesce("twice", F.lit(0))).cast("long").alias("landed_again"),
    )


@check(
    "atomic_publish",
    """
    WITH e AS (SELECT strftime(ts, '%Y%m%d') AS dt, event_id FROM events),
    d AS (SELECT dt, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS total FROM e GROUP BY dt)
    SELECT dt, rows, total, rows AS broken_rows, total AS broken_total, rows AS later_rows,
           CASE WHEN CAST(dt AS INT) % 2 = 0 THEN total + rows ELSE total END AS later_total, 1 AS kept_folders
    FROM d
    """,
)
def atomic_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days are published; a second run that breaks before its commit changes nothing a reader sees, and is swept; a third replaces even days."""
    path, schema = scratch_path(spark, "published"), "event_id long, dt string"
    events = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyyMMdd").alias("dt"))
    changed = events.where("CAST(dt AS INT) % 2 = 0").withColumn("event_id", F.col("event_id") + 1)

    def seen(label: str) -> DataFrame:
        found = publish.read_published(spark, path, schema).groupBy("dt").agg(F.count(F.lit(1)).alias(f"{label}rows"), F.sum("event_id").alias(f"{label}total"))
        return settle(found, "seen")

    publish.publish(events, path, ["dt"])
    first = seen("")
    publish.stage(changed, path, ["dt"])  # and here the run breaks
    broken = seen("broken_")
    publish.sweep(spark, path, ["dt"])
    publish.publish(changed, path, ["dt"])
    publish.sweep(spark, path, ["dt"])
    later = seen("later_")
    folders = [(f.removeprefix("dt="),) for f, _ in publish._folders(spark, path, 1)]
    kept = spark.createDataFrame(folders, "dt string").groupBy("dt").agg(F.count(F.lit(1)).cast("int").alias("kept_folders"))
    return first.join(broken, "dt").join(later, "dt").join(kept, "dt")


@check(
    "text_bins",
    """
    SELECT doc_id, md5(replace(replace(text, chr(13), ' '), chr(10), ' ')) AS line_md5, true AS within FROM documents WHERE text IS NOT NULL
    """,
)
def text_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as lines of a few large files, packed into bins of bytes smaller than those: every line is there once, and no bin too large."""
    budget, source, target = 40_000, scratch_path(spark, "lines"), scratch_path(spark, "bins")
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    line = F.concat_ws("\x1e", F.col("doc_id").cast("string"), F.translate("text", "\r\n", "  "))
    docs.select(line.alias("value")).repartition(3).write.option("lineSep", "\n").text(source)
    sizes = bins.bin_text(spark, [source], target, budget)
    read = spark.read.option("lineSep", "\n").text(target)
    longest = read.agg(F.max(F.octet_length("value")).alias("n")).scalar()
    pieces = 3 + F.lit(1)  # a bin takes the ends of three files at most, and a line beyond each
    fits = sizes.agg((F.max("bytes") <= F.lit(budget) + pieces * (longest + 1)).alias("fits")).scalar()
    cells = F.split("value", "\x1e")
    return read.select(F.get(cells, F.lit(0)).cast("bigint").alias("doc_id"), F.md5(F.get(cells, F.lit(1))).alias("line_md5"), fits.alias("within"))


@check(
    "copy_differences",
    """
    WITH l AS (SELECT strftime(l_shipdate, '%Y') AS part, l_orderkey, l_linenumber FROM lineitem)
    SELECT DISTINCT part, l_orderkey, l_linenumber,
           CASE WHEN l_orderkey % 997 = 5 THEN 'removed' WHEN l_orderkey % 991 = 7 THEN 'changed' ELSE 'added' END AS change, true AS narrow
    FROM (SELECT * FROM l WHERE l_orderkey % 997 = 5 OR (l_orderkey % 991 = 7 AND part >= '1995')
          UNION ALL SELECT part, -l_orderkey, l_linenumber FROM l WHERE l_orderkey % 499 = 3 AND l_linenumber = 1) x
    """,
)
def copy_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows removed, changed and added in a copy are found by its hash tree, and few other rows are read again."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", F.date_format("l_shipdate", "yyyy").alias("part"))
    left = settle(lines, "left")
    kept = left.where("l_orderkey % 997 <> 5")
    mode = F.when((F.col("l_orderkey") % 991 == 7) & (F.col("part") >= "1995"), F.concat("l_returnflag", F.lit("?"))).otherwise(F.col("l_returnflag"))
    fresh = left.where("l_orderkey % 499 = 3 AND l_linenumber = 1").withColumn("l_orderkey", -F.col("l_orderkey"))
    right = settle(kept.withColumn("l_returnflag", mode).unionByName(fresh).repartition(5), "right")
    keys = ["l_orderkey", "l_linenumber"]
    rows = left.count()
    buckets = copies.buckets_for(rows)
    found = copies.unequal_buckets(left, right, "part", keys, buckets)
    differing = settle(copies.differing_keys(left, right, "part", keys, buckets, found=found), "differing")
    again = found.agg(F.coalesce(F.sum("left_rows"), F.lit(0)).alias("n")).scalar()
    each = rows / (copies.BUCKETS * 7)  # rows of a bucket
    least = differing.agg((F.count(F.lit(1)) * F.lit(8 * (each + 1))).alias("n")).scalar()
    return differing.select("part", *keys, "change", (again <= least).alias("narrow"))


@check(
    "file_charsets",
    """
    SELECT * FROM (VALUES ('utf8', 'UTF-8', 0::BIGINT), ('euckr', 'EUC-KR', 0), ('damaged', 'UTF-8', 1), ('empty', 'UTF-8', 0)) v(kind, charset, damaged_share)
    JOIN (SELECT count(*) AS n FROM orders) c ON true
    """,
)
def file_charsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in files of two charsets, one with bytes of neither, and an empty one: each gets its charset in one scan."""
    folder = scratch_path(spark, "charsets")
    orders = table(spark, sf_dir, "orders")
    line = F.concat(F.lit("주문 "), F.col("o_orderkey").cast("string"))
    written = {"utf8": F.encode(line, "UTF-8"), "euckr": F.encode(line, "EUC-KR"), "damaged": F.concat(F.unhex(F.lit("c328")), F.encode(line, "UTF-8"))}
    for kind, value in written.items():
        orders.select(value.cast("string").alias("value")).coalesce(1).write.text(f"{folder}/{kind}")
    writers.write_marker(spark, f"{folder}/empty/part-0.txt")
    found = files.best_charset(spark, [f"{folder}/{kind}" for kind in (*written, "empty")], ["UTF-8", "EUC-KR"])
    per_kind = found.groupBy(F.regexp_extract("file", "/([^/]+)/[^/]*$", 1).alias("kind"), "charset").agg(F.sum("damaged").alias("damaged"), F.sum("lines").alias("lines"))
    whole = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n")).scalar()
    share = F.when(F.col("lines") > 0, F.col("damaged") / F.col("lines")).otherwise(0).cast("bigint")
    return per_kind.select("kind", "charset", share.alias("damaged_share"), whole.alias("n"))


_ARRIVAL = {"fields": [{"name": "o_orderkey", "type": "bigint"}, {"name": "o_orderpriority", "type": "string"}]}


@check("consume_until_idle", "SELECT o_orderkey, o_orderpriority, left(o_orderpriority, 1) AS level, count(*) OVER () AS taken FROM orders")
def consume_until_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that arrive while a run waits are taken by it, once; a run after it takes nothing."""
    source, path, offsets = (scratch_path(spark, name) for name in ("arrivals", "landed", "offsets"))
    orders = table(spark, sf_dir, "orders").select(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("value"))
    first = F.crc32(F.encode("value", "UTF-8")) % 2 == 0
    orders.where(first).write.parquet(source)
    late = threading.Timer(1.0, lambda: orders.where(~first).write.mode("append").parquet(source))
    late.start()
    level = {"level": F.substring("o_orderpriority", 1, 1)}
    messages = lambda: file_messages(spark, source, orders.schema, F.col("value"))
    taken = consume(messages(), _ARRIVAL, path, offsets, sep="|", partitions=level, idle_seconds=6)
    late.join()
    taken += consume(messages(), _ARRIVAL, path, offsets, sep="|", partitions=level)
    return spark.read.parquet(path).select("o_orderkey", "o_orderpriority", "level", F.lit(taken).cast("bigint").alias("taken"))


@check(
    "many_patterns",
    """
    WITH names AS (SELECT c_custkey, 'in_' || c_mktsegment || '_' || c_custkey || '.txt' AS name FROM customer),
    patterns AS (
      SELECT n_nationkey AS id, 'in_' || s || '_[0-9]*' || n_nationkey || '[.]txt$' AS pattern FROM nation, (SELECT DISTINCT c_mktsegment AS s FROM customer)
      UNION ALL SELECT 1000 + n_nationkey, '.*_' || n_nationkey || '[.]t' FROM nation)
    SELECT c_custkey, id, count(*) AS hits FROM names JOIN patterns ON regexp_matches(name, '^(?:' || pattern || ')') GROUP BY c_custkey, id
    """,
)
def many_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names against a table of patterns, without a pair of every name and pattern."""
    customers, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    number = F.col("n_nationkey").cast("string")
    names = customers.select("c_custkey", F.concat(F.lit("in_"), "c_mktsegment", F.lit("_"), F.col("c_custkey").cast("string"), F.lit(".txt")).alias("name"))
    segments = customers.agg(F.collect_set("c_mktsegment").alias("s")).scalar()
    fixed = nation.withColumn("s", F.explode(segments)).select(
        F.col("n_nationkey").alias("id"), F.concat(F.lit("in_"), "s", F.lit("_[0-9]*"), number, F.lit("[.]txt$")).alias("pattern")
    )
    loose = nation.select((F.col("n_nationkey") + 1000).alias("id"), F.concat(F.lit(".*_"), number, F.lit("[.]t")).alias("pattern"))
    hits = matching.match_patterns(names, "name", fixed.unionByName(loose), "pattern")
    return hits.groupBy("c_custkey", "id").agg(F.count(F.lit(1)).alias("hits"))
