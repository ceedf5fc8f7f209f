"""Budgets against a recursive water filling, and prefixes against whole sorted epochs."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quayside.llm import mixing
from tests.llm.cases import awkward, documents, empty, prose

LEVELS = [
    mixing.Level("domain", "CASE WHEN lang IS NOT NULL THEN 'known' END", {"known": 3}, 1),
    mixing.Level("language", "lang", {"en": 2}),
    mixing.Level("origin", "source", {"src1": 4, "src3": 0}),
]


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def weight(level, node):
    return level.weights.get(node, level.default)


def fill(children, budget):
    """Quota of each child of (weight, supply): shares rounded down after the short ones are taken out one by one."""
    live = {k: (w, s) for k, (w, s) in children.items() if w > 0 and s > 0}
    quota = dict.fromkeys(children, 0)
    while live:
        total = sum(w for w, _ in live.values())
        short = [k for k, (w, s) in live.items() if Fraction(s, w) <= Fraction(budget, total)]
        if not short:
            quota.update({k: budget * w // total for k, (w, _) in live.items()})
            break
        k = min(short, key=lambda k: Fraction(live[k][1], live[k][0]))
        quota[k] = live.pop(k)[1]
        budget -= quota[k]
    return quota


def plain_budgets(rows, levels, budget, epochs):
    """Leaf quotas; rows are (path, tokens)."""
    supply = Counter()
    for path, n in rows:
        able = all(weight(level, node) > 0 for level, node in zip(levels, path))
        for depth in range(len(path) + 1):
            supply[path[:depth]] += n * epochs * able
    quotas = {(): min(budget, supply[()])}
    for depth, level in enumerate(levels):
        groups = defaultdict(dict)
        for path in [p for p in supply if len(p) == depth + 1]:
            groups[path[:-1]][path] = (weight(level, path[-1]), supply[path])
        quotas = {path: q for parent, children in groups.items() for path, q in fill(children, quotas[parent]).items()}
    return quotas


def plain_mix(rows, levels, share, epochs, seed):
    """(key, path, epoch) taken; rows are (key, text, path)."""
    tokens = [(path, words(text)) for _, text, path in rows]
    total = sum(n for _, n in tokens)
    taken = []
    for path, quota in plain_budgets(tokens, levels, int(total * share), epochs).items():
        own = [(k, n) for (k, _, p), (_, n) in zip(rows, tokens) if p == path]
        size = sum(n for _, n in own)
        if not quota:
            continue
        whole, rest = divmod(quota, size)
        taken += [(k, path, e) for e in range(1, whole + 1) for k, _ in own]
        place = lambda k: hashlib.md5(f"{seed}:{whole + 1}:{'' if k is None else k}".encode()).hexdigest()  # noqa: B023, E731
        sums = Counter()
        for k, n in own:
            sums[place(k)] += n
        upto, cut = 0, ""
        for key in sorted(sums):
            if upto >= rest:
                break
            upto, cut = upto + sums[key], key
        taken += [(k, path, whole + 1) for k, _ in own if rest and place(k) <= cut]
    return Counter(taken)


def path_of(r):
    return ("known" if r.lang is not None else None, r.lang, r.source)


@pytest.mark.parametrize(("share", "epochs"), [(0.3, 1), (0.8, 2), (1.7, 2), (9.0, 3)])
def test_mix_equals_brute_force(spark, share, epochs):
    docs = documents(spark, [prose(i, 5 + 7 * (i % 13)) for i in range(150)]).unionByName(awkward(spark, clash=False))
    docs = docs.withColumns({"node": F.lit(1), "rows": F.lit(2), "place": F.lit(3), "tokens": F.lit(4)})
    got = Counter((r.doc_id, (r.mix_domain, r.mix_language, r.mix_origin), r.mix_epoch) for r in mixing.mix(docs, LEVELS, share, epochs, 5).collect())
    want = plain_mix([(r.doc_id, r.text, path_of(r)) for r in docs.collect()], LEVELS, share, epochs, 5)
    assert got == want and sum(got.values()) > 20


def test_shortage_goes_to_siblings_before_ancestors(spark):
    levels = [mixing.Level("a", "a"), mixing.Level("b", "b")]
    supplies = spark.createDataFrame([("x", "p", 1, 10), ("x", "q", 1, 500), ("y", "r", 1, 500), ("y", "s", 1, 500)], "a string, b string, rows long, tokens long")
    quota = {(r.a, r.b): int(r.quota) for r in mixing.leaf_budgets(supplies, levels, F.lit(400), 1).collect()}
    assert quota == {("x", "p"): 10, ("x", "q"): 190, ("y", "r"): 100, ("y", "s"): 100}
    quota = {(r.a, r.b): int(r.quota) for r in mixing.leaf_budgets(supplies, levels, F.lit(1400), 1).collect()}
    assert quota == {("x", "p"): 10, ("x", "q"): 500, ("y", "r"): 445, ("y", "s"): 445}


def test_empty_tables(spark):
    assert mixing.mix(empty(spark), LEVELS).collect() == []
    assert mixing.mix(documents(spark, [None, "", " "]), LEVELS).collect() == []


def test_quotients_are_not_rounded(spark):
    pairs = spark.createDataFrame([(2_999_999_999, 3_000_000_000), (6 * 10**18, 3), (7, 2)], "a long, b long")
    assert [r[0] for r in pairs.select(mixing.whole_parts(F.col("a"), F.col("b"))).collect()] == [0, 2 * 10**18, 3]
