"""The pipeline, stage by stage against brute force over the smallest tables."""

import os
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quayside.llm import mixing, queries, toxicity
from tests.llm.cases import awkward, empty
from tests.llm.test_mixing import plain_mix
from tests.llm.test_secrets import plain as plain_spans
from tests.llm.test_simhash import plain_components, plain_print

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


def rows_of(frame):
    return Counter(tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in frame.collect())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stored = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{name}")
        stored.append((docs, docs := spark.read.parquet(f"{tmp_path}/{name}")))
    (given, clean), (_, single), (_, redacted), (_, mixed), (_, packed) = stored

    model = toxicity.fit(given, spark.read.parquet(f"{DATA}/labels.parquet"))
    want = Counter({k: n for k, n in rows_of(given).items() if toxicity.score(toxicity.events(k[1] or "", model), model) < toxicity.THRESHOLD})
    assert rows_of(clean) == want and clean.count() < given.count()

    rows = sorted(rows_of(clean))
    roots = plain_components([plain_print(r[1]) for r in rows])
    assert rows_of(single) == Counter(r for i, r in enumerate(rows) if roots[i] == i) and single.count() < clean.count()

    before, after = {r[0]: r for r in rows_of(single)}, {r[0]: r for r in rows_of(redacted)}
    assert before.keys() == after.keys()
    assert all((before[k] == after[k]) == (not plain_spans(before[k][1])[1]) for k in before)

    def path(lang, source):
        number = source[3:]
        return ("forum" if int(number) % 2 else "web", lang, source)

    wanted = plain_mix([(k, t, path(lang, source)) for k, t, lang, source, _ in rows_of(redacted)], queries.MIX_LEVELS, queries.MIX_SHARE, queries.MIX_EPOCHS, queries.MIX_SEED)
    assert Counter(k for k, *_ in rows_of(mixed).elements()) == Counter(k for k, *_ in wanted.elements())
    assert mixed.columns == given.columns

    library = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    total = sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in mixed.collect())
    assert packed.agg({"length": "sum"}).first()[0] == total


def test_run_equals_stages(spark):
    got = corpus_pipeline.run(spark, DATA)
    again = corpus_pipeline.run(spark, DATA)
    assert sorted(got.collect()) == sorted(again.collect())


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (awkward(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, DATA)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            assert {"doc_id", "text", "lang", "source", "n_chars"} <= set(docs.columns), name
        corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
