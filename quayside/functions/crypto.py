"""Column ciphers as built-in AES expressions, without Python workers.

AES in CBC mode with PKCS padding; the IV is the first 16 bytes of the key, so
equal values give equal cipher text and stay joinable. That is by design and
weaker than a random IV: it shows which rows share a value.

Keys enter a plan as scalar subqueries over a one-row table. As literals they
would be readable in the event log, which plan redaction does not cover.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import CipherKeys, CryptoRule
from quayside.session import local_table

IMSI_LENGTH = 15


def secret(spark: SparkSession, key: str) -> Column:
    """A key as a column that no plan text shows."""
    raw = key.encode()
    if len(raw) not in (16, 24, 32):
        raise ValueError("an AES key has 16, 24 or 32 bytes")
    return local_table(spark, {"secret": [raw]}).scalar()


def secrets_for(spark: SparkSession, keys: CipherKeys, rules: Iterable[CryptoRule]) -> dict[str, Column]:
    """Key columns of the cipher types a rule set uses."""
    return {kind: secret(spark, keys[kind]) for kind in {rule.type for rule in rules}}


def base64_text(data: Column) -> Column:
    """Base64 in one line; Spark breaks long output into lines of 76 characters."""
    return F.translate(F.base64(data), "\r\n", "")


def _cipher_bytes(value: Column, key: Column) -> Column:
    iv = F.substring(key, 1, 16)
    sealed = F.aes_encrypt(value.cast("binary"), key, F.lit("CBC"), F.lit("PKCS"), iv)
    return F.substring(sealed, 17, 2**31 - 17)  # Spark puts the IV in front


def _plain_text(data: Column, key: Column) -> Column:
    iv = F.substring(key, 1, 16)
    opened = F.try_aes_decrypt(F.concat(iv, data), key, F.lit("CBC"), F.lit("PKCS"))
    return F.try_validate_utf8(opened.cast("string"))


def encrypt(value: Column, kind: str, key: Column, home_prefix: str = "", empty_to_null: bool = True) -> Column:
    """Base64 cipher text of ``value``.

    ``imsi`` values shorter than 15 characters give ``""``; longer ones carry a
    two-character mark in front: T (home network) or O, then their 6th character.
    ``empty_to_null=False`` encrypts an empty string to one padding block.
    """
    value = value.cast("string")
    sealed = base64_text(_cipher_bytes(value, key))
    if kind == "imsi":
        home = F.startswith(value, F.lit(home_prefix)) if home_prefix else F.lit(False)
        mark = F.concat(F.when(home, "T").otherwise("O"), F.substring(value, 6, 1))
        sealed = F.when(F.length(value) < IMSI_LENGTH, F.lit("")).otherwise(F.concat(mark, sealed))
    return F.when(value != "", sealed) if empty_to_null else sealed


def decrypt(value: Column, kind: str, key: Column, empty_to_null: bool = True) -> Column:
    """Plain text of base64 cipher text; anything malformed gives null."""
    value = value.cast("string")
    body = F.substring(value, 3, 2**31 - 3) if kind == "imsi" else value
    opened = _plain_text(F.try_to_binary(body, F.lit("base64")), key)
    return F.when(value == "", F.lit(None if empty_to_null else "")).otherwise(opened)


def encrypt_hex(value: Column, key: Column) -> Column:
    return F.lower(F.hex(_cipher_bytes(value.cast("string"), key)))


def decrypt_hex(value: Column, key: Column) -> Column:
    """Plain text of hex cipher text (AES-256 with a 32-byte key); malformed gives null."""
    return _plain_text(F.try_to_binary(value, F.lit("hex")), key)


def _by_column(names: Sequence[str], rules: Iterable[CryptoRule]) -> dict[str, list[str]]:
    """Cipher types per column, in rule order."""
    found: dict[str, list[str]] = {}
    for rule in rules:
        for pos in rule.col_pos:
            if pos > len(names):
                raise ValueError(f"column position {pos} is beyond the {len(names)} columns")
            found.setdefault(names[pos - 1], []).append(rule.type)
    return found


def _turn(
    value: Column, kinds: Sequence[str], keys: Mapping[str, Column], mode: str, home_prefix: str, empty_to_null: bool
) -> Column:
    for kind in kinds:
        if mode == "encryption":
            value = encrypt(value, kind, keys[kind], home_prefix, empty_to_null)
        elif mode == "decryption":
            value = decrypt(value, kind, keys[kind], empty_to_null)
        else:
            raise ValueError(f"mode must be encryption or decryption, not {mode!r}")
    return value


def apply_rules(
    df: DataFrame, rules: Iterable[CryptoRule], keys: CipherKeys, mode: str, home_prefix: str = ""
) -> DataFrame:
    """Encrypt or decrypt the columns named by position, all in one projection."""
    rules = list(rules)
    targets = _by_column(df.columns, rules)
    secrets = secrets_for(df.sparkSession, keys, rules)
    return df.withColumns(
        {name: _turn(F.col(f"`{name}`"), kinds, secrets, mode, home_prefix, True) for name, kinds in targets.items()}
    )


def crypto_failures(before: DataFrame, rules: Iterable[CryptoRule], keys: CipherKeys, mode: str) -> DataFrame:
    """Number of non-empty values per column that a rule set turns into null."""
    rules = list(rules)
    secrets = secrets_for(before.sparkSession, keys, rules)
    counts = []
    for name, kinds in _by_column(before.columns, rules).items():
        value = F.col(f"`{name}`")
        failed = (value.cast("string") != "") & _turn(value, kinds, secrets, mode, "", True).isNull()
        counts.append(F.count_if(failed).alias(name))
    return before.agg(*counts)


def apply_rules_to_lines(
    lines: DataFrame,
    sep: str,
    rules: Iterable[CryptoRule],
    keys: CipherKeys,
    mode: str,
    home_prefix: str = "",
    column: str = "value",
    drop_bare: bool = True,
) -> DataFrame:
    """The same over raw text lines: fields by position, trailing blanks of a target field cut.

    Lines without the separator are dropped, or with ``drop_bare=False`` stay as they are. An empty field is encrypted like any
    other, and an empty cipher text opens to an empty string. A line too short for a
    position keeps its fields.
    """
    rules = list(rules)
    secrets = secrets_for(lines.sparkSession, keys, rules)
    wanted: dict[int, list[str]] = {}
    for rule in rules:
        for pos in rule.col_pos:
            wanted.setdefault(pos, []).append(rule.type)
    fields = F.split(F.col(column), sep_regex(sep), -1)
    pieces, after = [], 1
    for pos, kinds in sorted(wanted.items()):
        field = F.regexp_replace(F.get(fields, F.lit(pos - 1)), r"\s+$", "")
        turned = F.array(F.coalesce(_turn(field, kinds, secrets, mode, home_prefix, False), F.lit("")))
        pieces += [F.slice(fields, after, pos - after)] if pos > after else []
        pieces.append(F.when(F.size(fields) >= pos, turned).otherwise(F.array().cast("array<string>")))
        after = pos + 1
    pieces.append(F.slice(fields, after, 2**31 - 1))
    turned_line = F.array_join(F.concat(*pieces), sep)
    if not drop_bare:
        return lines.withColumn(column, F.when(F.col(column).contains(sep), turned_line).otherwise(F.col(column)))
    return lines.where(F.col(column).contains(sep)).withColumn(column, turned_line)


def sep_regex(sep: str) -> str:
    """A separator as a regular expression that matches it literally."""
    return "\\Q" + sep + "\\E"
