"""Texts made to break patterns, and columns with the names that operators use inside."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quayside.llm import bit_sliced, mixing, queries, secrets, surrogates
from tests.llm.cases import documents, prose

#: Every name the operators give to a column of their own.
INNER = (
    "secret_text secret_base secret_all secret_rough secret_hot secret_clean pii_secret pii_match pii_found pii_turns pii_text k e kind ident "
    "attempt mix_domain mix_language mix_origin mix_epoch mix_key mix_whole mix_cut mix_last taken_whole taken_cut taken_last taken_epoch whole cut "
    "root text_hash fp in_0 in_1 in_2 h n toxicity_score"
).split()


def parts(size):
    """One candidate, domain, path, name, run of digits and assignment, each ``size`` characters long."""
    made = {
        "slug": "ab1/" * (size // 4), "words": "some-" * (size // 5), "domain": "x@" + "a." * (size // 2) + "com", "name": "Mr " + "A" + "b" * size, "names": "Mr Ab " * (size // 600),
        "digits": "1" * size, "card": "4 " * (size // 2), "phone": "+1 " + "23 " * (size // 3), "ip": "1." * (size // 2), "assign": "password=" + "x/" * (size // 2), "one": "a" * size,
        "separators": "-" * size, "hex": "0f" * (size // 2), "random": "".join(random.Random(size).choices("abcdefXYZ0189_/+-", k=size)),
    }
    return made


@pytest.mark.parametrize("size", [6_000, 100_000])
def test_no_text_ends_a_job(spark, size):
    made = parts(size)
    docs = documents(spark, list(made.values()))
    found = {r.doc_id: r for r in secrets.scan_secrets(docs).collect()}
    order = {name: i for i, name in enumerate(made)}
    assert found[order["slug"]].n_entropy == found[order["words"]].n_entropy == found[order["one"]].n_entropy == 0
    assert found[order["hex"]].n_hex == 1 and found[order["assign"]].n_assign == 1
    clean = {r.doc_id: r.text for r in secrets.redact_secrets(docs).collect()}
    assert clean[order["slug"]] == made["slug"] and clean[order["hex"]] == "[secret]"
    replaced = {r.doc_id: r for r in surrogates.replace_personal_data(docs, "k").collect()}
    domain = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    assert replaced[order["domain"]].pii_spans == f"email:0:{domain.match(made['domain']).end()}"
    assert replaced[order["slug"]].text == made["slug"]


def test_a_million_characters(spark):
    made = parts(1_000_000)
    chosen = ["slug", "words", "domain", "one", "digits", "assign"]
    docs = documents(spark, [made[n] for n in chosen]).repartition(6)
    assert docs.count() == secrets.scan_secrets(docs).count()
    assert sum(r.pii_count for r in surrogates.with_entities(docs, "text").select(F.size("pii_found").alias("pii_count")).collect()) == 1


def clashing(spark):
    texts = [f"{prose(i, 30)} password=abcdefgh{i} Mr John Smith, john{i}@mail.example.net" for i in range(40)]
    docs = documents(spark, texts)
    return docs, docs.withColumns({name: F.concat(F.lit(f"{name}-"), "doc_id") for name in INNER if name not in docs.columns})


def same(plain, wide, given, replaced=()):
    """The results agree, and every clashing column still has its values."""
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, wide.select(*plain.columns).collect()))
    kept = [c for c in INNER if c in given.columns and c not in replaced]
    assert [c for c in wide.columns if c in given.columns] == [c for c in given.columns if c not in replaced] + [c for c in replaced if c in given.columns]
    for row in wide.select("doc_id", *kept).collect():
        assert all(row[c] == f"{c}-{row.doc_id}" for c in kept)


def test_clashing_names(spark):
    docs, wide = clashing(spark)
    same(secrets.redact_secrets(docs), secrets.redact_secrets(wide), wide)
    same(bit_sliced.keep_one(docs), bit_sliced.keep_one(wide), wide)
    same(corpus_pipeline.mix_sources(spark, docs, ""), corpus_pipeline.mix_sources(spark, wide, ""), wide)
    shown = ["mix_domain", "mix_language", "mix_origin", "mix_epoch", "mix_key"]
    levels = (queries.MIX_LEVELS, 0.6, 2, 7)
    same(mixing.mix(docs, *levels), mixing.mix(wide, *levels), wide, shown)
    key = "the-key-that-never-leaves"
    out = surrogates.replace_personal_data(wide, key)
    same(surrogates.replace_personal_data(docs, key), out, wide)
    assert not any(key in str(value) for row in out.collect() for value in row)
