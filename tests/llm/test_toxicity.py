"""The clause grammar by hand, and held-out accuracy of a fitted model."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from quayside.llm import toxicity
from tests.llm.cases import awkward, documents, empty, prose

BARE = toxicity.Model(frozenset(), frozenset())
NAMES = dict(zip(toxicity.EVENTS, range(len(toxicity.EVENTS))))


@pytest.mark.parametrize(
    ("text", "events"),
    [
        ("", {}),
        ("the weather is fine", {}),
        ("You are an idiot", {"J": 1}),
        ("what an IDIOT", {"I": 1}),
        ("idiot, go away you", {"J": 1}),
        ("idiot, go away now from here you", {"I": 1}),
        ("you are not an idiot", {"n": 1}),
        ("not one of the many people here is an idiot", {"I": 1}),
        ("she said you are an idiot", {"q": 1}),
        ("she said so. you idiot", {"J": 1}),
        ("I will kill you", {"U": 1}),
        ("ich werde dich töten", {"U": 1}),
        ("we are going to hurt them", {"V": 1}),
        ("I will not hurt you", {"n": 1}),
        ("kill the process", {}),
        ("kill you", {"U": 1}),
        ("she said kill you", {}),
        ("you piece of garbage", {"J": 1}),
        ("a piece of cake in the garbage", {}),
        ("halt dein maul", {"J": 1}),
        ("the shop is shut", {}),
        ("never hurt anyone", {"n": 1}),
        ("he wrote not an idiot", {"q": 1}),
        ("idiot idiot | moron", {"I": 3}),
    ],
)
def test_clauses(text, events):
    want = [0] * len(NAMES)
    for symbol, n in events.items():
        want[NAMES[symbol]] = n
    assert toxicity.events(text, BARE) == tuple(want)


def test_composition_equals_one_after_the_other():
    draw = random.Random(1)
    parts = [toxicity.insults(), toxicity.threats(), toxicity.negation(), toxicity.reported_speech(), toxicity.aiming()]
    for _ in range(300):
        symbols = draw.choices(toxicity.WORDS, k=draw.randint(0, 20))
        want = list(symbols)
        for machine in parts:
            state, out = 0, []
            for s in want:
                state, o = machine.step(state, s)
                out.append(o)
            want = out
        state, got = 0, []
        for s in symbols:
            state, o = toxicity.grammar().step(state, s)
            got.append(o)
        assert got == want


def matches(symbols):
    """What the grammar says, read off the positions of a clause without any machine."""
    words = list(symbols)
    opener = None  # insults of several words: the last opening word, within 2 words, used once
    for i, s in enumerate(symbols):
        if s in "HS":
            opener = i
        elif s in "DM":
            fits = opener is not None and i - opener <= 2 and (symbols[opener], s) in (("H", "D"), ("S", "M"))
            words[i] = "I" if fits else "."
            if fits:
                opener = None
    for i, s in enumerate(words):  # threats: an intent within 4 words before
        before = [j for j in range(max(0, i - 4), i) if symbols[j] == "W"]
        if s == "A" and before:
            words[i] = "U" if "Y" in symbols[before[-1] : i] else "V"
    for i, s in enumerate(words):  # a negation within 3 words before, a report anywhere before
        if s in ("I", "V", "U", "A") and "N" in symbols[max(0, i - 3) : i]:
            words[i] = "n"
        if "R" in symbols[:i] and words[i] in ("I", "V", "U", "n", "A"):
            words[i] = "." if words[i] == "A" else "q"
    found = {}
    for i, s in enumerate(words):
        if s in ("I", "V", "A"):
            back = next((j for j in range(i - 1, max(-1, i - 5), -1) if words[j] in ("Y", "V", "A")), None)
            ahead = next((j for j in range(i + 1, len(words)) if words[j] in ("Y", "I", "V", "A")), None)
            met = s == "I" and back is not None and words[back] == "Y"
            met = met or (ahead is not None and words[ahead] == "Y" and ahead - i <= (2 if s == "A" else 4))
            s = {"I": "J", "V": "U", "A": "U"}[s] if met else {"A": "."}.get(s, s)
        found[s] = found.get(s, 0) + 1
    return {e: found.get(e, 0) for e in toxicity.EVENTS}


def test_grammar_equals_reading_off_positions():
    draw = random.Random(3)
    for _ in range(20_000):
        symbols = "".join(draw.choices(toxicity.WORDS[:-1], [4, 3, 1, 1, 1, 1, 2, 2, 2, 1, 0.3], k=draw.randint(0, 16)))
        got = toxicity.clause_events(symbols)
        assert {e: got[e] for e in toxicity.EVENTS} == matches(symbols), symbols


def test_aimed_outweighs_bare_outweighs_denied_whatever_is_fitted():
    draw = random.Random(4)
    one = [tuple(int(e == f) for f in toxicity.EVENTS) for e in toxicity.EVENTS]
    for _ in range(20):
        rows = sorted({tuple(draw.choices((0, 0, 1, 3), k=6)) for _ in range(8)} | {(0,) * 6, *one})
        weights, bias = toxicity._fit_weights([(e, y, draw.randint(0, 50)) for e in rows for y in (0, 1)])
        model = toxicity.Model(frozenset(), frozenset(), weights, bias)
        bare, aimed, threat, aimed_threat, denied, reported = (toxicity.score(e, model) for e in one)
        assert aimed_threat >= aimed >= toxicity.THRESHOLD > bare == threat >= denied == reported >= toxicity.score((0,) * 6, model)


def test_terms_are_chosen_as_by_the_plain_loop():
    draw = random.Random(5)
    for _ in range(50):
        terms = [w + e for w in "abcdefgh" for e in ("x", "-")]
        share = {t: draw.choice((0.9, 0.95, 1.0)) for t in terms}
        holding = [frozenset(draw.sample(terms, draw.randint(0, 6))) for _ in range(30)]
        lacks, want = [toxicity.COVER] * len(holding), []
        while True:
            gain = {t: sum(n for n, h in zip(lacks, holding) if t in h) * share[t] ** 2 for t in terms if t not in want}
            best = max(gain, key=lambda t: (gain[t], t.endswith("-"), t), default=None)
            if best is None or gain[best] < toxicity.LEAST_GAIN * toxicity.COVER / 2:
                break
            want.append(best)
            lacks = [max(0, n - (best in h)) for n, h in zip(lacks, holding)]
        assert toxicity.choose_terms(holding, share) == want


def corpus(spark, n=600):
    """Toxic texts hold one of many words with two unknown stems; one toxic text has many copies."""
    draw = random.Random(2)
    texts, labels = [], []
    for i in range(n):
        words = prose(i, draw.randint(20, 120)).split()
        toxic = i % 5 == 0
        if toxic:
            if i % 50 == 0:
                words = prose(7777, 60).split()
            for _ in range(2):
                words.insert(draw.randrange(len(words)), draw.choice(["vzxq", "wrgh"]) + draw.choice("ab cd ef gh ij kl mn op qr st".split()))
        texts.append(" ".join(words))
        labels.append((i, int(toxic), 1))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels)
    rows = toxicity.with_toxicity(docs, model).withColumn("out", toxicity.held_out("doc_id")).join(labels, "doc_id").collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r.out]
    assert len(out) > 100 and all((r.score >= toxicity.THRESHOLD) == bool(r.toxic) for r in out)
    assert all(0 <= r.score <= 1 for r in rows)
    assert len(model.words) + len(model.stems) < 40, "copies teach no words of their own"


def test_held_out_labels_change_nothing(spark):
    docs, labels = corpus(spark, 200)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs.drop("lang", "source"), turned)


def test_without_labels_and_awkward_rows(spark):
    nothing = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    docs = awkward(spark)
    model = toxicity.fit(docs, nothing)
    assert model == BARE
    scored = toxicity.with_toxicity(docs, model)
    assert scored.count() == docs.count() and set(docs.columns) < set(scored.columns)
    assert toxicity.with_toxicity(empty(spark), toxicity.fit(empty(spark), nothing)).collect() == []
    assert all(r.score < toxicity.THRESHOLD for r in scored.collect())
    scores = [toxicity.score(toxicity.events(t, BARE), BARE) for t in ("you are an idiot", "idiot", "you are not an idiot", "fine")]
    assert scores == sorted(scores, reverse=True) and scores[0] >= toxicity.THRESHOLD > scores[1]
