"""Metadata joins and delivery plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import paths as P
from quayside.operators import frames, matching
from quayside.plans import jobs
from quayside.plans.registry import check, table
from quayside.session import local_table


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed file path per event."""
    path = F.concat(
        P.landed_path(
            F.lit("d_ev"), F.col("event_type"), ("dt", F.date_format("ts", "yyyyMMdd")), ("hh", F.date_format("ts", "HH"))
        ),
        F.lit("/ev_"),
        F.col("event_id").cast("string"),
        F.lit(".dat"),
    )
    return table(spark, sf_dir, "events", wide=True).select("event_id", "event_type", "user_id", "ts", path.alias("path"))


_LANDED_SQL = """
    landed AS (SELECT event_id, event_type, user_id, ts, '/db=d_ev/tb=' || event_type || '/dt=' || strftime(ts, '%Y%m%d')
                      || '/hh=' || strftime(ts, '%H') || '/ev_' || event_id || '.dat' AS path FROM events)
"""


@check(
    "meta_join",
    """
    SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """,
)
def meta_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with their interface."""
    nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    joined = table(spark, sf_dir, "supplier").join(matching.small_side(nation), "s_nationkey")
    return joined.select("s_suppkey", "s_name", "n_name")


@check(
    "meta_left_chain",
    """
    SELECT c_custkey, n_name, r_name FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey > 3
    LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'
    """,
)
def meta_left_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interfaces with system and target, both optional."""
    nation = table(spark, sf_dir, "nation").where("n_nationkey > 3").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, sf_dir, "region").where("r_name <> 'ASIA'").withColumnRenamed("r_regionkey", "n_regionkey")
    chained = (
        table(spark, sf_dir, "customer")
        .join(matching.small_side(nation), "c_nationkey", "left")
        .join(matching.small_side(region), "n_regionkey", "left")
    )
    return chained.select("c_custkey", "n_name", "r_name")


@check(
    "interface_lookup",
    """
    WITH src AS (SELECT s_suppkey, lower(n_name) AS db, 't' || s_suppkey % 7 AS tb FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    prov AS (SELECT c_custkey, lower(n_name) AS db, 't' || c_custkey % 7 AS tb FROM customer JOIN nation ON c_nationkey = n_nationkey
             WHERE c_mktsegment <> 'BUILDING')
    SELECT db, tb, s_suppkey, c_custkey FROM src JOIN prov USING (db, tb)
    """,
)
def interface_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery interfaces in use, looked up by database and table."""
    nation = matching.small_side(table(spark, sf_dir, "nation"))

    def named(name: str, key: str, home: str) -> DataFrame:
        rows = table(spark, sf_dir, name).join(nation, F.col(home) == F.col("n_nationkey"))
        return rows.withColumns({"db": F.lower("n_name"), "tb": F.concat(F.lit("t"), (F.col(key) % 7).cast("string"))})

    landed = named("supplier", "s_suppkey", "s_nationkey").select("db", "tb", "s_suppkey")
    in_use = F.when(F.col("c_mktsegment") == "BUILDING", "N").otherwise("Y").alias("use_yn")
    interfaces = named("customer", "c_custkey", "c_nationkey").select("db", "tb", "c_custkey", in_use)
    return matching.delivery_interfaces(landed, interfaces)


@check(
    "meta_computed_key",
    """
    WITH src AS (SELECT s_suppkey, '/db=' || lower(n_name) || '/tb=t' || s_suppkey % 7 AS hdfs_dir
                 FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    prov AS (SELECT c_custkey, lower(n_name) AS db, 't' || c_custkey % 7 AS tb
             FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT s_suppkey, hdfs_dir, count(*) AS provides FROM src JOIN prov ON hdfs_dir = '/db=' || db || '/tb=' || tb
    GROUP BY s_suppkey, hdfs_dir
    """,
)
def meta_computed_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tables joined through a directory built from database and table.

    Deliveries are counted per directory before the join, so no directory fans out.
    """
    nation = matching.small_side(table(spark, sf_dir, "nation"))
    source = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    source = source.select(
        "s_suppkey",
        P.landed_path(F.lower("n_name"), F.concat(F.lit("t"), (F.col("s_suppkey") % 7).cast("string"))).alias("hdfs_dir"),
    )
    provided = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    directory = P.landed_path(F.lower("n_name"), F.concat(F.lit("t"), (F.col("c_custkey") % 7).cast("string")))
    counted = provided.groupBy(directory.alias("hdfs_dir")).agg(F.count(F.lit(1)).alias("provides"))
    return source.join(counted, "hdfs_dir").select("s_suppkey", "hdfs_dir", "provides")


@check(
    "meta_theta",
    "WITH "
    + _LANDED_SQL
    + """, rules AS (SELECT DISTINCT '/db=d_ev/tb=' || event_type AS dir, event_type AS rule FROM events WHERE event_type <> 'error'
            UNION ALL SELECT '/db=d_ev', 'all' UNION ALL SELECT '/tb=view/dt=20240105', 'day' UNION ALL SELECT '/tb=vie', 'none')
    SELECT event_id, rule FROM landed JOIN rules ON contains(path, dir || '/')
    """,
)
def meta_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed paths with every rule whose directory they contain."""
    landed = landed_events(spark, sf_dir)
    kinds = landed.where("event_type <> 'error'").select("event_type").distinct()
    rules = kinds.select(F.concat(F.lit("/db=d_ev/tb="), "event_type").alias("dir"), F.col("event_type").alias("rule"))
    fixed = local_table(spark, {"dir": ["/db=d_ev", "/tb=view/dt=20240105", "/tb=vie"], "rule": ["all", "day", "none"]})
    hits = matching.join_contained(landed, "path", rules.unionByName(fixed), "dir")
    return hits.select("event_id", "rule")


@check(
    "delivery_plan",
    "WITH "
    + _LANDED_SQL
    + """
    SELECT event_id, rule, CASE rule WHEN 'lake' THEN 'hdfs:///lake/' || 'dt=' || strftime(ts, '%Y%m%d') || '/etl_hh=' || strftime(ts, '%H')
             ELSE 's3a://out/event_time=' || strftime(ts, '%Y%m%d%H') END AS dest_path
    FROM landed JOIN (VALUES ('lake', '/db=d_ev/tb=view'), ('cloud', '/db=d_ev/tb=view'), ('cloud2', '/db=d_ev/tb=click')) r(rule, dir)
      ON contains(path, dir || '/')
    """,
)
def delivery_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery per landed path and rule, with its destination."""
    rules = local_table(
        spark,
        {
            "rule": ["lake", "cloud", "cloud2"],
            "collect_dir": ["/db=d_ev/tb=view", "/db=d_ev/tb=view", "/db=d_ev/tb=click"],
            "target_dir": ["/lake/dt=${yyyyMMdd}/etl_hh=${HH}", *["s3a://out/event_time=${yyyyMMddHH}"] * 2],
        },
    )
    return jobs.plan_delivery(landed_events(spark, sf_dir), "path", rules).select("event_id", "rule", "dest_path")


@check(
    "retry_lookup",
    """
    WITH files AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS seq, 'f_' || o_orderpriority AS nm FROM orders),
    retries AS (SELECT CAST(c_custkey AS VARCHAR) AS seq, 'h' || c_custkey AS hist,
                       CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN 'f_2-HIGH' ELSE 'f_5-LOW' END AS file_name FROM customer)
    SELECT o_orderkey, hist FROM files JOIN retries USING (seq) WHERE file_name = '' OR file_name = nm
    """,
)
def retry_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with the retry record of their source, parsed from comma-separated text."""
    name = F.when(F.col("c_mktsegment") == "BUILDING", "").when(F.col("c_mktsegment") == "MACHINERY", "f_2-HIGH").otherwise("f_5-LOW")
    key = F.col("c_custkey").cast("string")
    record = F.concat_ws(",", F.lit("if-1"), F.concat(F.lit("h"), key), key, F.lit("20240101"), F.lit("FTP"), F.lit("t"), F.lit("1"), name)
    texts = table(spark, sf_dir, "customer").select(record.alias("line"))
    names = ["interface", "hist", "seq", "target_dt", "protocol", "started_at", "retry_seq", "file_name"]
    retries = frames.parse_record(texts, "line", names).select("hist", "seq", "file_name")
    files = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("seq"), F.concat(F.lit("f_"), "o_orderpriority").alias("nm")
    )
    return matching.retry_lookup(files, retries, "seq", "nm", "file_name").select("o_orderkey", "hist")


@check(
    "partition_missing",
    """
    WITH days AS (SELECT DISTINCT event_type AS tb, CAST(ts AS DATE) AS d FROM events),
    target AS (SELECT DISTINCT event_type AS tb, CAST(ts AS DATE) AS d FROM events WHERE event_type IN ('view', 'click') OR user_id > 50)
    SELECT DISTINCT tb, strftime(d - 1, '%Y%m%d') AS dt FROM days
    WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.tb = days.tb AND t.d = days.d - 1)
    """,
)
def partition_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous days that the target does not have."""
    days = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("tb"), F.date_format("ts", "yyyyMMdd").alias("dt"), "user_id"
    )
    target = days.where(F.col("tb").isin("view", "click") | (F.col("user_id") > 50))
    return matching.missing_partitions(days.select("tb", "dt"), target.select("tb", "dt"))


@check(
    "status_lookup",
    """
    SELECT event_id, status_nm FROM events
    LEFT JOIN (VALUES ('error', 'Failed'), ('view', 'Success'), ('click', 'Retry')) s(status_cd, status_nm) ON event_type = status_cd
    """,
)
def status_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status names by code."""
    codes = local_table(
        spark, {"event_type": ["error", "view", "click"], "status_nm": ["Failed", "Success", "Retry"]}
    )
    return table(spark, sf_dir, "events").join(matching.small_side(codes), "event_type", "left").select("event_id", "status_nm")


@check(
    "archive_membership",
    """
    SELECT DISTINCT 'a' || p_size || '.tar.gz' AS archive FROM part
    WHERE EXISTS (SELECT 1 FROM nation WHERE contains('/in/' || p_partkey || '/NATION_' || p_size || '_' || p_brand || '.dat', n_name))
    """,
)
def archive_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives with a member whose path contains a wanted name."""
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    members = table(spark, sf_dir, "part").select(
        F.concat(F.lit("a"), size, F.lit(".tar.gz")).alias("archive"),
        F.concat(F.lit("/in/"), key, F.lit("/NATION_"), size, F.lit("_"), "p_brand", F.lit(".dat")).alias("member"),
    )
    return matching.archives_holding(members, table(spark, sf_dir, "nation"), "archive", "member", "n_name")


@check(
    "file_match",
    r"""
    WITH f AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host,
                      regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', '') AS u FROM pages),
    l AS (SELECT page_id, host, regexp_extract(u, '[^/]+$') AS name,
                 CASE WHEN host LIKE 'm.%' THEN regexp_extract(min(u) OVER (PARTITION BY host), '[^/]+$') ELSE '[0-9]+' END AS pattern,
                 CASE WHEN host LIKE 'blog.%' THEN '*.HTML' WHEN host LIKE 'm.%' THEN 'zzz' ELSE '[1-5]*' END AS file_pattern FROM f),
    s AS (SELECT *, count(*) OVER (PARTITION BY host) AS hits FROM l WHERE regexp_matches(name, '^(?:' || pattern || ')'))
    SELECT page_id, name FROM s
    WHERE (hits = 1 AND name = pattern)
       OR CASE file_pattern WHEN '*.HTML' THEN name GLOB '*.HTML' WHEN 'zzz' THEN name = 'zzz' ELSE name GLOB '[1-5]*' END
       OR contains(lower(name), lower(file_pattern))
    """,
)
def file_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed files chosen by source pattern, then by glob or contained text."""
    bare = F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "/$", "")
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    listed = table(spark, sf_dir, "pages").select("page_id", host.alias("host"), bare.alias("u"))
    first = listed.groupBy("host").agg(P.base_name(F.min("u")).alias("literal"))
    mobile, blog = F.startswith("host", F.lit("m.")), F.startswith("host", F.lit("blog."))
    ruled = listed.join(first, "host").select(
        "page_id",
        "host",
        P.base_name(F.col("u")).alias("name"),
        F.when(mobile, F.col("literal")).otherwise("[0-9]+").alias("pattern"),
        F.when(blog, "*.HTML").when(mobile, "zzz").otherwise("[1-5]*").alias("file_pattern"),
    )
    return matching.match_files(ruled, ["host"], "name", "pattern", "file_pattern").select("page_id", "name")


@check(
    "path_predicates",
    """
    WITH p AS (SELECT event_id, event_type, user_id, '/db=D_EV/tb=' || event_type AS dir FROM events)
    SELECT event_id,
           substring(upper(dir), strpos(dir, 'tb=') + 3) = 'VIEW' AS is_view,
           contains('/landed/db=D_EV/tb=click/dt=20240101/', dir || '/') AS holds
    FROM p WHERE event_type NOT LIKE '%urch%' AND user_id > 10
    """,
)
def path_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active rows with position and containment tests on their directory."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.when(F.col("user_id") > 10, "Y").otherwise("N").alias("use_yn"), P.landed_path(F.lit("D_EV"), F.col("event_type")).alias("dir")
    )
    active = frames.active_rows(rows, "use_yn", "event_type", "%urch%")
    upper_table = F.substring(F.upper("dir"), F.instr("dir", "tb=") + 3, F.length("dir"))
    return active.select(
        "event_id",
        (upper_table == "VIEW").alias("is_view"),
        F.contains(F.lit("/landed/db=D_EV/tb=click/dt=20240101/"), F.concat("dir", F.lit("/"))).alias("holds"),
    )


@check(
    "json_meta_max",
    """
    SELECT event_type, max(json_extract_string(props, '$.k')) AS max_k,
           count(*) FILTER (json_extract_string(props, '$.k') = '7') AS sevens
    FROM events GROUP BY event_type
    """,
)
def json_meta_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest JSON field per table, and rows whose field equals a value."""
    field = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.max(field).alias("max_k"), F.count_if(field == "7").alias("sevens")
    )


@check(
    "basic_predicates",
    "SELECT event_id, event_type, value FROM events WHERE event_type IN ('view', 'error') AND value IS NOT NULL AND props IS NOT NULL",
)
def basic_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "error"))
    return rows.where(F.col("value").isNotNull() & F.col("props").isNotNull()).select("event_id", "event_type", "value")
