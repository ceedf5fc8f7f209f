"""Text to typed values. Malformed text becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that counts as true.
TRUE_WORDS = ("true", "1", "t", "y", "yes")

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

_NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf|infinity|nan)\s*$"
_WHOLE = r"^\s*[+-]?\d+(\.0*)?\s*$"


def to_int(text: Column) -> Column:
    return F.trim(text).try_cast("int")


def _as_double(text: Column) -> Column:
    """Only plain number text; the JVM would also take ``1d`` or ``0x1p3``."""
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def to_bigint(text: Column, mode: str = "trunc") -> Column:
    """Whole number of number text; integers of any size are exact.

    ``trunc`` cuts toward zero, ``floor`` rounds down: they differ below zero.
    """
    if mode not in ("trunc", "floor"):
        raise ValueError(f"mode must be trunc or floor, not {mode!r}")
    number = _as_double(text)
    whole = number.try_cast("bigint")  # toward zero; null when it does not fit
    if mode == "floor":
        whole = whole - F.when(number < whole, 1).otherwise(0)
    return F.coalesce(F.trim(text).try_cast("bigint"), whole)


def to_float(text: Column) -> Column:
    return _as_double(text).cast("float")


def to_double(text: Column) -> Column:
    return _as_double(text)


def to_boolean(text: Column) -> Column:
    """Null stays null; every other word outside the true list is false."""
    return F.lower(text).isin(*TRUE_WORDS)


def to_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT))


def to_decimal(text: Column) -> Column:
    """``decimal(30,0)``; a fraction that does not fit scale 0 gives null."""
    return F.when(text.rlike(_WHOLE), F.trim(text).try_cast(T.DecimalType(30, 0)))


def blank_to_null(text: Column) -> Column:
    return F.when(~text.isin("", " "), text)


def literal_null_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit("null"))


def strip_trailing_tab(text: Column) -> Column:
    return F.regexp_replace(text, "\t$", "")


def strip_line_breaks(text: Column) -> Column:
    return F.translate(text, "\r\n", "")


def hex_to_text(text: Column, charset: str = "EUC-KR") -> Column:
    """Hex digits of encoded bytes, as text. EUC-KR needs ``spark.sql.legacy.javaCharsets``."""
    return F.decode(F.unhex(text), charset)


def utc_to_zone(ts: Column, zone: str = "Asia/Seoul") -> Column:
    return F.from_utc_timestamp(ts, zone)


def typed(text: Column, type_name: str, bigint_mode: str = "trunc") -> Column:
    """Text cast by JSON type name."""
    builders = {
        "int": to_int,
        "bigint": lambda c: to_bigint(c, bigint_mode),
        "long": lambda c: to_bigint(c, bigint_mode),
        "float": to_float,
        "double": to_double,
        "boolean": to_boolean,
        "timestamp": to_timestamp,
        "datetime": to_timestamp,
        "decimal": to_decimal,
    }
    build = builders.get(type_name.strip().lower())
    return build(text) if build else text
