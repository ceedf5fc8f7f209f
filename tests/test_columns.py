"""Casting, ciphers and small text functions."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from quayside.config import CipherKeys, CryptoRule, CryptoRules, normalise_separator, unescape_separator
from quayside.functions import casting as C
from quayside.functions import crypto
from quayside.functions import text as X
from quayside.schema import spark_type, struct_of

KEY = "0123456789abcdef"
KEYS = CipherKeys({k: KEY for k in ("imsi", "mdn", "enb", "svrcd")})


def column(spark, items):
    return spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, v string")


def results(spark, items, build):
    rows = column(spark, items).select("i", build(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


def test_numbers(spark):
    assert results(spark, ["12", " 7 ", "1.9", "abc", "", None], C.to_int) == [12, 7, None, None, None, None]
    big = ["2.9", "-1.5", "9007199254740993", "x", "1e3", "1d", "0x10", "nan", "1e400", None]
    assert results(spark, big, C.to_bigint) == [2, -1, 9007199254740993, None, 1000, None, None, None, None, None]
    floors = [2, -2, 9007199254740993, None, 1000, None, None, None, None, None]
    assert results(spark, big, lambda c: C.to_bigint(c, "floor")) == floors
    assert results(spark, ["-3.0", "-0.2", "inf", "-Infinity"], lambda c: C.to_bigint(c, "floor")) == [-3, -1, None, None]
    assert results(spark, [" 1.5 ", "1f", "-.5", "inf"], C.to_double) == [1.5, None, -0.5, float("inf")]
    assert results(spark, ["12", "1.50", "x", "3.0"], C.to_decimal) == [decimal.Decimal(12), None, None, decimal.Decimal(3)]


def test_booleans_and_times(spark):
    words = ["TRUE", "1", "t", "Y", "yes", "no", "", None]
    assert results(spark, words, C.to_boolean) == [True] * 5 + [False, False, None]
    stamps = ["2024-01-01 01:02:03.5", "2024/01/01", "2024-01-01 01:02:03", None]
    assert results(spark, stamps, C.to_timestamp) == [datetime.datetime(2024, 1, 1, 1, 2, 3, 500000), None, None, None]


def test_text_cleaning(spark):
    assert results(spark, ["", " ", "  ", "a", None], C.blank_to_null) == [None, None, "  ", "a", None]
    assert results(spark, ["null", "NULL", "x"], C.literal_null_to_null) == [None, "NULL", "x"]
    assert results(spark, ["a\t", "\ta", "a\t\t"], C.strip_trailing_tab) == ["a", "\ta", "a\t"]
    assert results(spark, ["a\r\nb"], C.strip_line_breaks) == ["ab"]
    assert results(spark, ["가나".encode("euc-kr").hex()], C.hex_to_text) == ["가나"]


def test_types():
    assert spark_type("decimal").simpleString() == "decimal(30,0)"
    assert spark_type("decimal", True).simpleString() == "bigint"
    with pytest.warns(UserWarning):
        assert spark_type("blob").simpleString() == "string"
    struct = struct_of({"fields": [{"name": "a", "type": "int"}, {"name": "b", "type": "datetime"}]})
    assert struct.simpleString() == "struct<a:int,b:timestamp>"
    with pytest.raises(ValueError):
        struct_of({})


@pytest.fixture()
def key(spark):
    return crypto.secret(spark, KEY)


def test_known_cipher_texts(spark, key):
    enc = lambda c: crypto.encrypt(c, "mdn", key)
    assert results(spark, ["hello", "", None], enc) == ["MOfLtxzZ0YgS4+5cPylFYw==", None, None]
    whole = lambda c: crypto.encrypt(c, "mdn", key, empty_to_null=False)
    assert results(spark, [""], whole) == ["7Uf+4FRcP6fdBw1EuG6Y2Q=="]


def test_round_trips(spark, key):
    texts = ["a", "x" * 15, "y" * 16, "z" * 17, "한글 텍스트 😀", "long " * 500]
    both = lambda c: crypto.decrypt(crypto.encrypt(c, "enb", key), "enb", key)
    assert results(spark, texts, both) == texts
    assert not any("\n" in t for t in results(spark, texts, lambda c: crypto.encrypt(c, "enb", key)))
    long = crypto.secret(spark, KEY * 2)
    hexed = lambda c: crypto.decrypt_hex(crypto.encrypt_hex(c, long), long)
    assert results(spark, texts, hexed) == texts


def test_subscriber_marks(spark, key):
    enc = lambda c: crypto.encrypt(c, "imsi", key, "99901")
    got = results(spark, ["999017000000001", "888017000000001", "12345678901234"], enc)
    assert got[0].startswith("T7") and got[1].startswith("O7") and got[2] == ""
    assert results(spark, got, lambda c: crypto.decrypt(c, "imsi", key)) == ["999017000000001", "888017000000001", None]
    assert results(spark, [""], lambda c: crypto.decrypt(c, "imsi", key, empty_to_null=False)) == [""]


def test_damaged_cipher_text_is_null(spark, key):
    broken = ["not base64!", "AAAA", "MOfLtxzZ0YgS4+5cPylAYw==", "한글"]
    assert results(spark, broken, lambda c: crypto.decrypt(c, "mdn", key)) == [None] * 4


def test_rules(spark):
    frame = spark.createDataFrame([("a", "b", "c")], "x string, y string, z string")
    rules = [CryptoRule("mdn", (1, 3)), CryptoRule("enb", (1,))]
    sealed = crypto.apply_rules(frame, rules, KEYS, "encryption")
    assert sealed.first()["y"] == "b" and sealed.first()["x"] != "a"
    reverse = [CryptoRule("enb", (1,)), CryptoRule("mdn", (1, 3))]
    assert tuple(crypto.apply_rules(sealed, reverse, KEYS, "decryption").first()) == ("a", "b", "c")
    with pytest.raises(ValueError):
        crypto.apply_rules(frame, [CryptoRule("mdn", (4,))], KEYS, "encryption")
    with pytest.raises(ValueError):
        crypto.apply_rules(frame, rules, KEYS, "sideways")
    with pytest.raises(ValueError):
        CryptoRule("other", (1,))
    with pytest.raises(ValueError):
        CipherKeys({"mdn": "short"})
    assert KEY not in repr(KEYS)
    parsed = CryptoRules.parse({"rules": {"encryption": [{"type": "mdn", "col_pos": [2]}]}, "is_encrypted": True})
    assert parsed.encryption[0].col_pos == (2,) and parsed.already_encrypted


def test_keys_stay_out_of_plans(spark):
    frame = spark.createDataFrame([("a",)], "x string")
    sealed = crypto.apply_rules(frame, [CryptoRule("mdn", (1,))], KEYS, "encryption")
    sealed.collect()
    shown = sealed._jdf.queryExecution().executedPlan().treeString()
    assert KEY not in shown and KEY.encode().hex().upper() not in shown.upper()


def test_lines(spark):
    lines = spark.createDataFrame([("a|b  |c|",), ("a|b",), ("none",), ("|",)], "value string")
    rules = [CryptoRule("enb", (4,)), CryptoRule("mdn", (2,))]
    sealed = crypto.apply_rules_to_lines(lines, "|", rules, KEYS, "encryption")
    first = sealed.first()[0].split("|")
    assert first[0] == "a" and first[2] == "c" and len(first[1]) == len(first[3]) == 24
    opened = crypto.apply_rules_to_lines(sealed, "|", rules, KEYS, "decryption")
    assert sorted(r[0] for r in opened.collect()) == ["a|b", "a|b|c|", "|"]


def test_separators():
    assert unescape_separator("\\036") == "\x1e" and unescape_separator("\\u001e") == "\x1e"
    assert unescape_separator("␞") == "␞" and unescape_separator(None) is None
    assert [normalise_separator(s) for s in ("|^|", ",|'", '","', ",", "||")] == ["\x1e"] * 3 + [",", "||"]


def test_routing(values):
    def expected(key, n, alphabet):
        number = 0
        for char in key[-4:]:
            number = number * 32 + alphabet.index(char)
        return number % n

    for key in ("01ARZ3NDEKTSV4RRFFQ69G5FAV", "AB", "ZZZZ"):
        assert values(X.routing_partition(F.lit(key), 7)) == expected(key, 7, X.ALPHABET_CROCKFORD)
        assert values(X.routing_partition(F.lit(key), 7, X.ALPHABET_PLAIN)) == expected(key, 7, X.ALPHABET_PLAIN)
    assert values(X.routing_partition(F.lit("AB-C"), 7)) is None


def test_messages(values):
    assert values(X.truncated_message(F.lit("p "), F.lit("short"))) == "p short"
    long = values(X.truncated_message(F.lit("p "), F.lit("가" * 200)))
    assert long == "p " + "가" * 65 + "..." and len(long.encode()) <= 200


def test_name_tokens_and_comments(spark):
    names = ["cdr", "x_cdr", "cdr_id", "cdrx", "acdr"]
    assert results(spark, names, lambda c: X.has_token(c, ["cdr"])) == [True, True, True, False, False]
    notes = ["단말 모델 번 호", "위 도", "other"]
    assert results(spark, notes, lambda c: X.has_keyword(c, [".*단말.*번호", "위도"])) == [True, True, False]


def test_base64_shape(spark):
    items = ["aGVsbG8=", "hello", "abcd", "T7aGVsbG8=", "a===", "=abc", ""]
    assert results(spark, items, X.looks_encrypted) == [True, False, True, False, False, False, True]
    assert results(spark, ["T7aGVsbG8="], lambda c: X.looks_encrypted(c, F.lit("x_imsi"))) == [True]


def test_row_lines(spark):
    frame = spark.createDataFrame([("a\r\nb", None, 3)], "x string, y string, z int")
    line = frame.select(X.row_as_line([F.col("x"), F.col("y"), F.col("z")], "\x1e")).first()[0]
    assert line == "ab\x1enull\x1e3"
