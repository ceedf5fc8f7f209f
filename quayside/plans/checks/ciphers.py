"""Column ciphers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import CryptoRule, ReadSpec, WriteSpec
from quayside.functions import crypto
from quayside.plans import jobs
from quayside.plans.registry import CHECK_HOME, CHECK_KEYS, check, table
from quayside.session import scratch_path
from quayside.sources.files import split_lines

_HEX_KEY = "a-made-up-key-of-thirty-two-byte"
NAME_RULE = [CryptoRule("mdn", (2,))]


@check(
    "crypto_roundtrip",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def crypto_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encrypt the names into parquet, then read and decrypt them."""
    sealed = scratch_path(spark, "sealed")
    jobs.protect(
        spark, f"{sf_dir}/customer.parquet", sealed, ReadSpec("parquet"), WriteSpec("parquet"), NAME_RULE, CHECK_KEYS
    )
    return crypto.apply_rules(spark.read.parquet(sealed), NAME_RULE, CHECK_KEYS, "decryption")


@check(
    "crypto_join_on_cipher",
    """
    SELECT c_mktsegment, count(*) AS n_orders,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
    """,
)
def crypto_join_on_cipher(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal values have equal cipher text, so encrypted keys still join.

    Orders are summed per key before the join, which leaves one row of a hot key.
    """
    rule = [CryptoRule("enb", (1,))]
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("k"), "o_totalprice")
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("k"), "c_mktsegment")
    per_key = orders.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents")
    )
    left = crypto.apply_rules(per_key, rule, CHECK_KEYS, "encryption")
    right = crypto.apply_rules(people, rule, CHECK_KEYS, "encryption")
    return left.join(right, "k").groupBy("c_mktsegment").agg(
        F.sum("n").alias("n_orders"), F.sum("cents").alias("total_cents")
    )


@check(
    "crypto_imsi_prefix",
    """
    WITH ids AS (
      SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN '99901' ELSE '99902' END
        || lpad(CAST(c_custkey AS VARCHAR), CASE WHEN c_mktsegment = 'BUILDING' THEN 9 ELSE 10 END, '7') AS id
      FROM customer)
    SELECT c_custkey,
           CASE WHEN length(id) < 15 THEN '' ELSE
             (CASE WHEN starts_with(id, '99901') THEN 'T' ELSE 'O' END) || substr(id, 6, 1) END AS mark,
           CASE WHEN length(id) < 15 THEN 0 ELSE 26 END AS cipher_length,
           CASE WHEN length(id) < 15 THEN NULL ELSE id END AS opened
    FROM ids
    """,
)
def crypto_imsi_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber ids carry a network mark in front of the cipher text; short ids give an empty string."""
    width = F.when(F.col("c_mktsegment") == "BUILDING", 9).otherwise(10)
    home = F.when(F.col("c_nationkey") < 12, CHECK_HOME).otherwise("99902")
    subscriber = F.concat(home, F.lpad(F.col("c_custkey").cast("string"), width, F.lit("7")))
    key = crypto.secret(spark, CHECK_KEYS["imsi"])
    sealed = table(spark, sf_dir, "customer").select(
        "c_custkey", crypto.encrypt(subscriber, "imsi", key, CHECK_HOME).alias("sealed")
    )
    return sealed.select(
        "c_custkey",
        F.left("sealed", F.lit(2)).alias("mark"),
        F.length("sealed").alias("cipher_length"),
        crypto.decrypt(F.col("sealed"), "imsi", key).alias("opened"),
    )


@check(
    "crypto_text_lines",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
           CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS o_orderpriority
    FROM orders
    """,
)
def crypto_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of raw lines encrypted and decrypted by position; lines without a separator drop out."""
    note = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.concat("o_orderpriority", F.lit("  ")))
    line = F.concat_ws("\x1e", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), note)
    orders = table(spark, sf_dir, "orders", wide=True)
    lines = orders.select(line.alias("value")).unionByName(
        orders.select(F.concat(F.lit("no separator "), F.col("o_orderkey").cast("string")).alias("value"))
    )
    rules = [CryptoRule("svrcd", (2,)), CryptoRule("mdn", (3,))]
    stored = scratch_path(spark, "sealed-lines")
    crypto.apply_rules_to_lines(lines, "\x1e", rules, CHECK_KEYS, "encryption").write.text(stored)
    opened = crypto.apply_rules_to_lines(spark.read.text(stored), "\x1e", rules, CHECK_KEYS, "decryption")
    return split_lines(opened, "\x1e", ["o_orderkey", "o_custkey", "o_orderpriority"])


@check(
    "hex_decrypt",
    "SELECT p_partkey, CASE WHEN p_size < 5 THEN NULL ELSE p_name END AS p_name FROM part",
)
def hex_decrypt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AES-256 hex cipher text opened; damaged text gives null."""
    key = crypto.secret(spark, _HEX_KEY)
    sealed = table(spark, sf_dir, "part").select("p_partkey", "p_size", crypto.encrypt_hex(F.col("p_name"), key).alias("sealed"))
    damaged = F.when(F.col("p_size") < 5, F.concat(F.lit("zz"), "sealed")).otherwise(F.col("sealed"))
    return sealed.select("p_partkey", crypto.decrypt_hex(damaged, key).alias("p_name"))


@check(
    "crypto_failures",
    "SELECT count(*) FILTER (c_nationkey >= 12) AS c_name FROM customer",
)
def crypto_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that are not cipher text are counted, not logged."""
    sealed = crypto.encrypt(F.col("c_name"), "mdn", crypto.secret(spark, CHECK_KEYS["mdn"]))
    mixed = table(spark, sf_dir, "customer").withColumn(
        "c_name", F.when(F.col("c_nationkey") >= 12, F.col("c_name")).otherwise(sealed)
    )
    return crypto.crypto_failures(mixed, NAME_RULE, CHECK_KEYS, "decryption")
