"""The manifest against a tree built node by node, with blocks so small that several rounds follow."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quayside.llm import merkle
from tests.llm.cases import awkward, documents, empty, prose

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    values = [row[c] for c in FIELDS]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves, fan):
    """Root, and for each leaf its siblings before and after, level by level."""
    level, owners, proofs = leaves, [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(level) > 1:
        runs = [range(i, min(i + fan, len(level))) for i in range(0, len(level), fan)]
        for run in runs:
            for at in run:
                for who in owners[at]:
                    proofs[who].append(("".join(level[run.start : at]), "".join(level[at + 1 : run.stop])))
        owners = [[who for at in run for who in owners[at]] for run in runs]
        level = [digest("".join(level[at] for at in run)) for run in runs]
    return level[0], proofs


def plain(rows, fan):
    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    lower = {}
    for name in names:
        groups[name].sort()
        lower[name] = tree([x[2] for x in groups[name]], fan)
    root, upper = tree([lower[n][0] for n in names], fan)
    out = []
    for n, top in zip(names, upper, strict=True):
        for (known, key, h), proof in zip(groups[n], lower[n][1], strict=True):
            out.append((key if known else None, n, h, lower[n][0], root, tuple(proof + top)))
    return sorted(out, key=repr)


def found(rows):
    return sorted([(r["doc_id"], r["lang"], r["leaf"], r["subroot"], r["root"], tuple((s["before"], s["after"]) for s in r["proof"])) for r in rows], key=repr)


@pytest.fixture(params=[(2, 7), (2, 2), (3, 1)], ids=str)
def shape(request, monkeypatch):
    fan, depth = request.param
    for name, value in (("FAN", fan), ("DEPTH", depth), ("BLOCK", fan**depth)):
        monkeypatch.setattr(merkle, name, value)
    return fan


@pytest.mark.parametrize("case", ["awkward", "one", "many"])
def test_manifest_equals_a_tree_built_node_by_node(spark, shape, case):
    if case == "awkward":  # nulls in every column, repeated rows and keys, empty and long texts, clashing names
        docs = awkward(spark).withColumns({n: F.lit("x") for n in ("tree_hash", "proof", "levels", "leaf", "_part", "root")})
        docs = docs.unionByName(docs.limit(3).withColumns({c: F.lit(None).cast(docs.schema[c].dataType) for c in docs.columns}))
    elif case == "one":
        docs = documents(spark, ["alone"])
    else:
        docs = documents(spark, [prose(i, 3) for i in range(150)])
    docs = docs.persist()
    rows = merkle.manifest(docs, FIELDS).collect()
    assert found(rows) == plain([r.asDict() for r in docs.collect()], shape)
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in rows)


def test_changed_rows_are_found(spark):
    docs = documents(spark, [prose(i, 3) for i in range(300)])
    changed = F.col("doc_id").isin(3, 77, 298)
    now = merkle.leaf(*[F.when(changed, F.lit("other")).otherwise(F.col(c)) if c == "text" else F.col(c) for c in FIELDS])
    rows = merkle.manifest(docs, FIELDS, found=now).collect()
    assert sorted(r["doc_id"] for r in rows if not r["verified"]) == [3, 77, 298]
    by_key = {r["doc_id"]: r for r in rows}
    bad = by_key[77]
    h = leaf({**docs.where("doc_id = 77").first().asDict(), "text": "other"})
    for s in bad["proof"]:
        h = digest(s["before"] + h + s["after"])
    assert bad["folded_root"] == h != bad["root"]


def test_one_hot_group_and_very_long_text(spark):
    docs = documents(spark, ["y" * 1_000_000, *[str(i) for i in range(700)]]).withColumn("lang", F.lit("en"))
    rows = merkle.manifest(docs, FIELDS).collect()
    assert found(rows) == plain([r.asDict() for r in docs.collect()], merkle.FAN)


def test_empty_table(spark):
    assert merkle.manifest(empty(spark), FIELDS).collect() == []
