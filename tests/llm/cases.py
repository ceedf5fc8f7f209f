"""Small tables with awkward rows, shared by the operator tests."""

import random

from pyspark.sql import DataFrame, SparkSession

#: Names that operators use for columns of their own.
CLASHING = {"start": 7, "fp": 1, "rank": 2, "kind": "k", "tokens": 3, "node": 4, "component": 5, "place": 6, "rows": 8, "events": 9}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    syllables = "an be cor du el fi go ha is jo ka lu mi no or pa".split()
    return " ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(words))


def awkward_texts() -> list[str | None]:
    long = prose(1, 20_000)
    return [None, "", " \t\n", "x", "é", "two words", "a b c", prose(2, 50), prose(2, 50), prose(3, 200), long, long + " more", "ÀÉ ß 😀 x", "A  B\n\nC   D"]


def documents(spark: SparkSession, texts, keys=None, clash: bool = False) -> DataFrame:
    keys = range(len(texts)) if keys is None else keys
    rows = [(k, t, "en" if i % 3 else None, f"src{i % 4}" if i % 5 else None, len(t) if t is not None else None) for i, (k, t) in enumerate(zip(keys, texts))]
    frame = spark.createDataFrame(rows, SCHEMA)
    if clash:
        from pyspark.sql import functions as F

        frame = frame.withColumns({name: F.lit(value) for name, value in CLASHING.items()})
    return frame


def awkward(spark: SparkSession, clash: bool = True) -> DataFrame:
    """Nulls, ties and repeated rows: two rows without a key, one key twice with one text and once with another."""
    texts = awkward_texts()
    keys = [*range(len(texts) - 2), None, None]
    return documents(spark, [*texts, texts[7], texts[7], texts[9]], [*keys, 7, 7, 7], clash)


def empty(spark: SparkSession) -> DataFrame:
    return documents(spark, [])
