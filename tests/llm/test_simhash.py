"""SimHash operators against brute force."""

import hashlib
import random
import re

import numpy as np
import xxhash

from quayside.llm import bit_sliced, block_tables, fingerprints
from tests.llm.cases import awkward, awkward_texts, documents, empty, prose

U64 = (1 << 64) - 1


def plain_print(text, k=3):
    raw = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in raw))
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=3):
    """Smallest position reachable, of each position."""
    label = list(range(len(prints)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(prints)):
        for j in range(i + 1, len(prints)):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def near_prints(seed, groups=25, each=8, flips=5):
    draw = random.Random(seed)
    found = []
    for _ in range(groups):
        base = draw.getrandbits(64)
        for _ in range(each):
            x = base
            for _ in range(draw.randint(0, flips)):
                x ^= 1 << draw.randrange(64)
            found.append(x)
    return found


def test_fingerprints(spark):
    texts = [t or "" for t in awkward_texts()]
    assert [bit_sliced.fingerprint(t.encode(), 3) for t in texts] == [plain_print(t) for t in texts]


def test_forest_equals_brute_force():
    for radius in (0, 1, 2, 3, 4, 7, 8):
        prints = np.array(sorted(set(near_prints(radius))), np.uint64)
        bucket = np.sort(np.random.default_rng(radius).integers(0, 3, len(prints)))
        want = []
        for b in range(3):
            rows = np.flatnonzero(bucket == b)
            want += [int(rows[i]) for i in plain_components([int(prints[r]) for r in rows], radius)]
        assert bit_sliced.forest(prints, bucket, radius).tolist() == want


def test_block_tables_hold_every_near_pair():
    masks = block_tables.block_masks(3)
    assert len(masks) == 10
    draw = random.Random(4)
    for _ in range(500):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), 3):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def grouped(spark, docs):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in bit_sliced.group_near_duplicates(docs).collect()), key=repr)


def expected(rows, radius=3):
    prints = [plain_print(t) for _, t in rows]
    roots = plain_components(prints, radius)
    lowest = {}
    for (k, _), r in zip(rows, roots):
        if k is not None:
            lowest[r] = min(k, lowest.get(r, k))
    return sorted(((k, f"{p:016x}", lowest.get(r)) for (k, _), p, r in zip(rows, prints, roots)), key=repr)


def test_groups_equal_brute_force(spark):
    texts = [prose(i // 4, 120) + (f" tail{i}" if i % 4 > 1 else "") for i in range(60)]
    docs = documents(spark, texts, [1000 - i for i in range(60)])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = grouped(spark, docs)
    assert got == expected(rows)
    assert len({c for *_, c in got}) < 40


def test_groups_of_awkward_rows(spark):
    docs = awkward(spark)
    assert grouped(spark, docs) == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert grouped(spark, empty(spark)) == []


def test_large_buckets_are_cut_without_losing_links(spark, monkeypatch):
    monkeypatch.setattr(block_tables, "PART_ROWS", 4)
    prints = sorted(set(near_prints(9, groups=6, each=40, flips=6)))
    frame = spark.createDataFrame([(block_tables.signed(p),) for p in prints], "fp long")
    found = {r.node & U64: r.component & U64 for r in bit_sliced.near_components(frame, 3).collect()}
    want = plain_components(prints)
    groups = {}
    for p, r in zip(prints, want):
        groups.setdefault(found.get(p, p), set()).add(r)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_keep_one(spark):
    docs = awkward(spark)
    kept = bit_sliced.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    roots = plain_components([plain_print(t) for _, t in rows])
    assert kept.count() == len(set(roots))
    names = {c for *_, c in expected(rows)}
    assert {r.doc_id for r in kept.collect()} == names


def test_edited_text_and_next_document(spark):
    docs = awkward(spark).repartition(5)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    got = fingerprints.fingerprint_documents(docs).collect()
    assert len(got) == len(rows)
    alone = [k for k, _ in rows if [x for x, _ in rows].count(k) == 1]
    by_key = {r.doc_id: r for r in got}
    for (k, text), (_, after) in zip(rows, [*rows[1:], rows[0]]):
        if k not in alone or [x for x, t in rows if t == after and x not in alone]:
            continue
        cut = len(text) // 4
        want = text[: len(text) - cut] + after[:cut]
        r = by_key[k]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(want.encode()).hexdigest()
        mine, other = fingerprints.simhash(text), fingerprints.simhash(want)
        assert (r.fingerprint, r.edited_fingerprint) == (f"{mine:016x}", f"{other:016x}")
        assert r.near_edited == fingerprints.likeness(mine, other)
        assert r.near_next == fingerprints.likeness(mine, fingerprints.simhash(after))


def test_edges_of_small_tables(spark):
    assert fingerprints.fingerprint_documents(empty(spark)).collect() == []
    only = fingerprints.fingerprint_documents(documents(spark, ["abcdefgh"])).first()
    assert only.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and only.near_next == 1.0


def test_near_counts_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(block_tables, "PART_ROWS", 5)
    prints = near_prints(11, groups=8, each=12, flips=3)
    prints += prints[:7]
    frame = spark.createDataFrame([(block_tables.signed(p),) for p in prints], "fp long")
    got = {r.fp & U64: r.n_near for r in fingerprints.near_counts(frame, 3).collect()}
    assert got == {p: sum((p ^ q).bit_count() <= 3 for q in prints) - 1 for p in prints}


def test_edits_stay_near_and_others_do_not():
    near = [fingerprints.likeness(fingerprints.simhash(a), fingerprints.simhash(fingerprints.edited(a, b))) for a, b in ((prose(i, 300), prose(i + 99, 300)) for i in range(30))]
    far = [fingerprints.likeness(fingerprints.simhash(prose(i, 300)), fingerprints.simhash(prose(i + 99, 300))) for i in range(30)]
    assert np.mean(near) > 0.6 and np.mean(far) < 0.3
