"""Surrogates: nothing found is left, formats stay, entities stay distinct and recognisable."""

import re

from pyspark.sql import functions as F

from quayside.llm import surrogates
from tests.llm.cases import awkward, documents, empty, prose

KEY = "test-key"
TEXTS = [
    "mail bosbt.42@mail8.example.com now", "again BOSBT.42@mail8.example.com, loogm.24@mail8.example.com.", "call +1 (456) 555-2186 or +1 456 555 2186", "ip 42.144.35.254 and 8.8.8.8.", "card 4111 1111 1111 1111 and 4111111111111112",
    "Mr. John Smith met Mrs Smith and Mr John Smith", "Госпожа Анна Каренина и Господин Петров", "ssn 123-45-6789.", "no data, 3.14 and 2.0.1, 12 words", None, "", "😀 x@y.co 😀 x@y.co", "v1.2.3.4.5 and 999.1.1.1",
]


def replaced(spark, docs, key=KEY):
    return surrogates.replace_personal_data(docs, key)


def test_formats_and_coreference(spark):
    out = {r.doc_id: r for r in replaced(spark, documents(spark, TEXTS)).collect()}
    old = dict(enumerate(TEXTS))
    assert re.fullmatch(r"mail [a-z]{5}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com now", out[0].text) and out[0].text != old[0]
    first = re.search(r"\S+@\S+", out[0].text)[0]
    again, other = re.findall(r"[\w.]+@[\w.]+\w", out[1].text)
    assert again == first != other and again.split("@")[1] == other.split("@")[1]
    a, b = re.findall(r"\+\d[^+]*\d", out[2].text)
    assert re.fullmatch(r"\+\d \(\d{3}\) \d{3}-\d{4}", a) and re.fullmatch(r"\+\d \d{3} \d{3} \d{4}", b) and re.sub(r"\D", "", a) == re.sub(r"\D", "", b)
    assert all(0 < int(o) < 255 for ip in re.findall(r"\d+\.\d+\.\d+\.\d+", out[3].text) for o in ip.split(".")) and "42.144" not in out[3].text
    spaced, plain = re.findall(r"\d[\d ]{14,}\d", out[4].text)

    def luhn(number):
        digits = [int(c) for c in number if c.isdigit()][::-1]
        return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10

    assert re.fullmatch(r"\d{4} \d{4} \d{4} \d{4}", spaced) and luhn(spaced) == 0 and len(plain) == 16
    names = re.match(r"Mr\. (\w+ \w+) met Mrs (\w+) and Mr (\w+ \w+)", out[5].text)
    assert names[1] == names[3] and names[1].split()[0] in surrogates.FIRST["latin", "m"].split() and "Smith" not in out[5].text
    assert re.fullmatch(r"Госпожа [А-Яа-яё]+ [А-Яа-я]+ и Господин [А-Яа-я]+", out[6].text) and "Каренина" not in out[6].text
    assert out[6].text.split()[1] in surrogates.FIRST["cyrillic", "f"].split()
    assert re.fullmatch(r"ssn \d{3}-\d\d-\d{4}\.", out[7].text) and out[7].text != old[7]
    for i in (8, 9, 10, 12):
        assert (out[i].text, out[i].pii_count) == (old[i], 0)
    assert out[11].text.count(re.search(r"\w@\w\.co", out[11].text)[0]) == 2
    assert all(r.n_chars == len(r.text) for r in out.values() if r.pii_count)


def test_spans_and_clean_rows(spark):
    docs = awkward(spark).drop("events")
    rows = replaced(spark, docs).collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert replaced(spark, empty(spark)).collect() == []
    r = replaced(spark, documents(spark, [TEXTS[0]])).first()
    assert r.pii_spans == f"email:5:{5 + len('bosbt.42@mail8.example.com')}"


def test_distinct_entities_stay_distinct(spark):
    """Two letters and a digit leave few surrogates, so most entities have to draw again."""
    idents = [f"{a}@b.co" for a in "abcdefghijkl"]
    entities = spark.createDataFrame([("email", i) for i in idents], "kind string, ident string")
    moved = {r.ident: r.attempt for r in surrogates.retries(entities, KEY).collect()}
    assert moved
    secret = F.lit(KEY)
    rows = spark.createDataFrame([("email", i, moved.get(i, 0)) for i in idents], "kind string, ident string, attempt int")
    fresh = [r.s for r in rows.select(surrogates.surrogate(F.col("kind"), F.col("ident"), F.col("attempt"), secret).alias("s")).collect()]
    assert len(set(fresh)) == len(idents) and not set(fresh) & set(idents)
    out = replaced(spark, documents(spark, [" ".join(idents)])).first().text.split()
    assert len(set(out)) == len(idents) and not set(out) & set(idents)


def test_keys_give_other_surrogates_and_long_texts_work(spark):
    long = prose(1, 20_000) + " " + TEXTS[0]
    a, b = (replaced(spark, documents(spark, [long]), k).first().text for k in ("one", "two"))
    assert a != b and a[: len(long) - 60] == long[: len(long) - 60]


def test_entities_without_room_settle(spark):
    """No letter or digit to change, hosts that reshape alike, a domain with all one-letter addresses, most short numbers."""
    mails = ["-@-.com", "..@-.com", *(f"_@{a}.com" for a in "abcdefghijklmnopqrstuvwxyz"), *(f"{a}@-.org" for a in "abcdefghijklmnopqrstuvwxyz")]
    text = " ".join(mails)
    out = replaced(spark, documents(spark, [text])).first()
    fresh = out.text.split()
    assert out.pii_count == len(mails) == len(fresh) == len(set(fresh)) and not set(fresh) & set(mails)
    assert all(re.fullmatch(surrogates.PATTERNS["email"], f) for f in fresh)
    secret, attempt = F.lit(KEY), F.lit(surrogates.LONGER_FROM + 1)
    kinds = {"email": "-@-.com", "ip": "1.2.3.4", "phone": "12345", "ssn": "123456789", "card": "4111111111111111", "name": "m|latin|Smith"}
    rows = spark.createDataFrame(list(kinds.items()), "kind string, ident string")
    late = {r.kind: r.s for r in rows.select("kind", surrogates.surrogate(F.col("kind"), F.col("ident"), attempt, secret).alias("s")).collect()}
    assert all(len(late[k]) >= len(i) + 2 for k, i in kinds.items() if k not in ("ip", "name")) and late["ip"].count(".") == 5
    shown = surrogates._formatted(F.lit("phone"), F.lit("+1 22 33"), F.lit("9876543"))
    assert spark.range(1).select(shown).first()[0] == "+9 87 6543"
