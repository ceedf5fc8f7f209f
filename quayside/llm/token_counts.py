"""Token counts by a two-tier lookup: a broadcast table of frequent pieces, then a cache in each worker."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from quayside.llm.bpe import PieceEncoder, encoder
from quayside.session import ship_package

#: Documents whose pieces fill the broadcast table, and its largest size. Both change speed, never a count.
SAMPLE_DOCUMENTS = 1_000
FREQUENT_PIECES = 20_000


def _count_sample(batches: Iterator[pa.RecordBatch], path: str, most: int) -> Iterator[pa.RecordBatch]:
    tool, seen = encoder(path), Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen.update(tool.pieces(text or "")[1])
    frequent = sorted((p for p, n in seen.items() if n > 1), key=lambda p: (-seen[p], p))[:most]
    tool.learn(set(frequent))
    yield pa.RecordBatch.from_pydict(
        {"piece": pa.array(frequent, pa.string()), "tokens": pa.array([len(tool.known[p]) // 4 for p in frequent], pa.int64())}
    )


def frequent_lengths(docs: DataFrame, path: str, text: str, key: str) -> dict[str, int]:
    """Lengths of pieces frequent in a bounded sample in hash order; at most ``FREQUENT_PIECES`` rows reach the driver.

    Keys alone are ordered, and only the texts of the chosen ones leave their tasks. One task counts these without a shuffle
    of pieces.
    """
    keys = docs.select(F.col(key).alias("k")).orderBy(F.xxhash64("k"), "k").limit(SAMPLE_DOCUMENTS)
    chosen = F.broadcast(keys.distinct())  # at most SAMPLE_DOCUMENTS rows of one key
    sample = docs.join(chosen, docs[key].eqNullSafe(chosen["k"]), "left_semi").select(text)
    counted = sample.limit(SAMPLE_DOCUMENTS).coalesce(1).mapInArrow(
        functools.partial(_count_sample, path=path, most=FREQUENT_PIECES), "piece string, tokens long"
    )
    return {row.piece: row.tokens for row in counted.collect()}


def count_tokens(tool: PieceEncoder, frequent: dict[str, int], text: str) -> int:
    """Tokens of one text: first tier the frequent table, second tier the worker's cache, else the tokenizer."""
    head, pieces = tool.pieces(text)
    first = list(map(frequent.get, pieces))
    rest = [p for p, n in zip(pieces, first, strict=True) if n is None]
    if any(p not in tool.known for p in rest):
        tool.learn(set(rest))
    held = sum(len(tool.known[p]) for p in rest) + len(tool.encode([head])[0])
    return sum(filter(None, first)) + held // 4


def with_token_counts(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", name: str = "n_tokens") -> DataFrame:
    """``docs`` with the token count of each whole text, as the tokenizer's library gives it by default.

    Null and empty texts count 0. Repeated rows are counted each. Very long texts are counted whole. An empty table gives
    an empty table. A column already called ``name`` is replaced; no other column is touched, and nothing is shuffled.
    """
    spark = docs.sparkSession
    ship_package(spark)
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, text, key))

    @pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        tool = encoder(path)
        return pd.Series(np.array([count_tokens(tool, table.value, t or "") for t in texts], dtype="int64"))

    return docs.withColumn(name, counted(F.coalesce(F.col(text), F.lit(""))))
