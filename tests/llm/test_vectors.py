"""Near-duplicate vectors against all pairs."""

import numpy as np

from quayside.llm import block_tables, embedding_dups


def brute(rows, least=0.9):
    unit = {}
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            x = x / np.abs(x).max()
            unit[i] = x / np.sqrt(x @ x)
    links = {i: set() for i in range(len(rows))}
    for i in unit:
        for j in unit:
            if i != j and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= least:
                links[i].add(j)
    seen, names = {}, {}
    for i in range(len(rows)):
        if i in seen:
            continue
        todo, members = [i], {i}
        while todo:
            for j in links[todo.pop()] - members:
                members.add(j)
                todo.append(j)
        keys = [rows[m][0] for m in members if rows[m][0] is not None]
        for m in members:
            seen[m], names[m] = i, min(keys, default=None)
    return sorted(((rows[i][0], len(links[i]), names[i], rows[i][0] is not None and rows[i][0] == names[i]) for i in range(len(rows))), key=repr)


def run(spark, rows, kind="array<float>", **options):
    frame = spark.createDataFrame([(k, v, 1, 2) for k, v in rows], f"vec_id long, embedding {kind}, vec int, lowest int")
    found = embedding_dups.near_duplicate_vectors(frame, **options).collect()
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in found), key=repr)


def vectors(seed, groups, each, noise, dims=32):
    draw = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        base = draw.standard_normal(dims)
        rows += [(base + noise * draw.standard_normal(dims)).astype(np.float32).tolist() for _ in range(each)]
    return rows


def test_awkward_vectors(spark):
    near = vectors(1, 6, 5, 0.05)
    rows = [(i + 10, v) for i, v in enumerate(near)]
    rows += [(None, near[0]), (3, near[1]), (4, None), (5, []), (6, [0.0] * 32), (7, [float("nan")] * 32), (8, [None, *near[0][1:]]), (9, [float("inf"), *near[0][1:]])]
    rows += [(100, [3e38] * 32), (101, [1e-30] * 32), (102, [-1.0] * 32), (103, near[0][:16]), (104, near[0][:16]), (11, near[1]), (11, near[1])]
    assert run(spark, rows) == brute(rows)


def test_dense_groups_have_all_their_links(spark, monkeypatch):
    monkeypatch.setattr(block_tables, "PART_ROWS", 16)
    rows = [(i, v) for i, v in enumerate(vectors(2, 2, 150, 0.05))]
    assert run(spark, rows, window=8) == brute(rows)


def test_recall_near_the_threshold(spark):
    rows = [(i, v) for i, v in enumerate(vectors(3, 400, 3, 0.28, dims=64))]
    want = brute(rows)
    got = run(spark, rows)
    links = sum(n for _, n, *_ in want)
    assert links > 100 and sum(n for _, n, *_ in got) >= 0.9 * links
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, [])]) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_passes_follow_the_number_of_classes():
    same = 1 - np.arccos(0.9) / np.pi
    for classes in (1, 64, 100_000, 1_000_000, 10_000_000):
        passes = embedding_dups.passes_for(classes, 0.9, 64)
        missed = (1 - same ** max(0.0, np.log2(classes / 64))) ** passes
        assert missed <= 1 - embedding_dups.RECALL + 1e-9
    assert embedding_dups.passes_for(10_000_000, 0.9, 64) > embedding_dups.PASSES


def at_cosine(draw, base, cosine):
    """A vector at the cosine from a unit one."""
    other = draw.standard_normal(len(base))
    other -= (other @ base) * base
    return cosine * base + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def test_recall_at_the_threshold_beside_a_dense_cone(spark):
    """Pairs at 0.90 to 0.92; a third of all rows lies in one cone, at about 0.75 from each other."""
    draw, dims = np.random.default_rng(5), 64
    axis = draw.standard_normal(dims)
    axis /= np.linalg.norm(axis)
    pairs, rows = [], []
    for i in range(6000):
        base = at_cosine(draw, axis, 0.866) if i % 3 == 0 else draw.standard_normal(dims)
        base /= np.linalg.norm(base)
        if i % 6 < 2:
            pairs.append((len(rows), len(rows) + 1))
            rows.append(at_cosine(draw, base, draw.uniform(0.901, 0.92)))
        rows.append(base)
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(rows)]
    got = {k: c for k, _, c, _ in run(spark, rows)}
    recall = {cone: np.mean([got[a] == got[b] for n, (a, b) in enumerate(pairs) if (n % 2 == 0) == cone]) for cone in (False, True)}
    assert len(pairs) == 2000 and recall[False] >= 0.95 and recall[True] >= 0.95, recall


def test_borders_of_ranges_do_not_matter(spark):
    """One round of one pass must give the same links for one range and for many, some shorter than the window."""
    rows = [(i, v) for i, v in enumerate(vectors(7, 150, 3, 0.25))]
    frame = spark.createDataFrame(rows, "class_id long, vector array<float>").selectExpr("*", "size(vector) AS dims", "xxhash64(vector) AS tie")
    found = {}
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for parts in (1, 7, 40):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            links = embedding_dups._round_links(frame, 1, 0, 16, 0.9)
            found[parts] = sorted(tuple(r) for r in embedding_dups.connected_components(links).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert len(found[1]) > 100 and found[1] == found[7] == found[40]
