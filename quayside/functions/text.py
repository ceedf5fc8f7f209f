"""Small text functions: routing keys, messages, name and comment matching."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digit alphabets of the two audit topics.
ALPHABET_CROCKFORD = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
ALPHABET_PLAIN = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MESSAGE_BYTES = 200


def routing_partition(key: Column, partitions: int, alphabet: str = ALPHABET_CROCKFORD) -> Column:
    """Topic partition of an id: its last four characters, read in base 32, modulo ``partitions``.

    Null when a character is not in the alphabet.
    """
    total, valid = F.lit(0), F.lit(True)
    for place in range(4):
        char = F.substring(key, -1 - place, 1)
        digit = F.instr(F.lit(alphabet), char) - 1
        valid = valid & (digit >= 0)
        total = total + digit * (32**place)
    return F.when(valid, total % partitions)


def truncated_message(prefix: Column, detail: Column, limit: int = MESSAGE_BYTES) -> Column:
    """``prefix`` and ``detail`` in at most ``limit`` UTF-8 bytes; a cut detail ends in dots."""
    room = F.greatest(F.lit(limit) - F.octet_length(prefix) - 3, F.lit(0))
    raw = F.substring(detail.cast("binary"), F.lit(1), room)
    # A cut inside a character leaves an incomplete tail, which is dropped.
    whole = F.regexp_replace(F.make_valid_utf8(raw.cast("string")), "�+$", "")
    return F.concat(
        prefix, F.when(F.octet_length(detail) > room, F.concat(whole, F.lit("..."))).otherwise(detail)
    )


def has_token(name: Column, tokens: Sequence[str]) -> Column:
    """Whether a column name holds one of the tokens between underscores."""
    if not tokens:
        return F.lit(False)
    return name.rlike("(?:^|_)(?:" + "|".join(re.escape(t) for t in tokens) + ")(?:_|$)")


def has_keyword(comment: Column, keywords: Sequence[str]) -> Column:
    """Whether a comment, without blanks, matches one of the keyword patterns."""
    if not keywords:
        return F.lit(False)
    return F.replace(comment, F.lit(" "), F.lit("")).rlike("|".join(f"(?:{k})" for k in keywords))


def looks_encrypted(value: Column, name: Column | None = None) -> Column:
    """Base64 shape: length a multiple of 4, right alphabet, decodable. ``imsi`` columns carry a 2-character mark."""
    body = value
    if name is not None:
        body = F.when(name.contains("imsi"), F.substring(value, 3, 2**31 - 3)).otherwise(value)
    return (
        (F.length(body) % 4 == 0)
        & body.rlike(r"^[A-Za-z0-9+/]*={0,2}$")
        & F.try_to_binary(body, F.lit("base64")).isNotNull()
    )


# A column line of a table definition with its comment.
_DDL_COLUMN = r"(?i)`(\w+)`\s+\w+(?:\(\d+\))?\s+COMMENT\s+['\"](.*?)['\"]"


def ddl_columns(ddl: Column) -> Column:
    """Array of ``(name, comment)`` of the commented columns in a table definition."""
    names = F.regexp_extract_all(ddl, F.lit(_DDL_COLUMN), F.lit(1))
    comments = F.regexp_extract_all(ddl, F.lit(_DDL_COLUMN), F.lit(2))
    return F.arrays_zip(names.alias("name"), comments.alias("comment"))


def row_as_line(columns: Sequence[Column], sep: str) -> Column:
    """One text line of a row: line breaks cut, null written as ``null``."""
    return F.concat_ws(
        sep, *[F.coalesce(F.translate(c.cast("string"), "\r\n", ""), F.lit("null")) for c in columns]
    )


def replace_separator(line: Column, old: str, new: str) -> Column:
    """A separator replaced in raw lines. The quoted form ``","`` keeps its outer quotes."""
    inner = f'"{new}"' if old == '","' else new
    return F.replace(line, F.lit(old), F.lit(inner))
