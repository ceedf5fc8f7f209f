"""Declared table schemas: JSON type names to Spark types."""

from __future__ import annotations

import json
import warnings
from collections.abc import Mapping

from pyspark.sql import types as T

# Type names of the JSON schema files.
JSON_TYPES: Mapping[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "datetime": T.TimestampType(),
    "decimal": T.DecimalType(30, 0),
}


def spark_type(name: str, decimal_as_long: bool = False) -> T.DataType:
    """Spark type of a JSON type name; an unknown name becomes a string, with a warning."""
    key = name.strip().lower()
    if key == "decimal" and decimal_as_long:
        return T.LongType()
    if key not in JSON_TYPES:
        warnings.warn(f"unknown column type {name!r}, read as string", stacklevel=2)
        return T.StringType()
    return JSON_TYPES[key]


def fields_of(spec: str | Mapping) -> list[tuple[str, str]]:
    """``[(name, type name), ...]`` of a JSON schema given as text or mapping."""
    parsed = json.loads(spec) if isinstance(spec, str) else spec
    if "fields" not in parsed:
        raise ValueError("schema has no 'fields' list")
    return [(field["name"], field["type"]) for field in parsed["fields"]]


def struct_of(spec: str | Mapping, decimal_as_long: bool = False) -> T.StructType:
    """The declared schema as a ``StructType``."""
    return T.StructType(
        [T.StructField(name, spark_type(kind, decimal_as_long)) for name, kind in fields_of(spec)]
    )


def text_struct(spec: str | Mapping) -> T.StructType:
    """The declared column names, all read as strings."""
    return T.StructType([T.StructField(name, T.StringType()) for name, _ in fields_of(spec)])
