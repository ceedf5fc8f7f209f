"""Landing by manifest, atomic publication, bins of bytes, hash trees of copies, names within paths."""

import gzip
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from quayside.config import CipherKeys, CryptoRule, CryptoRules
from quayside.operators import copies, matching
from quayside.plans import jobs, manifest
from quayside.sinks import bins, publish, writers
from quayside.sources import files

FIELDS = {"fields": [{"name": "id", "type": "bigint"}, {"name": "name", "type": "string"}]}
ROWS = "id long, name string"


def run(spark, folder, path, names, run_name):
    named = spark.createDataFrame([(f"{folder}/{n}",) for n in names], "path string")
    log = manifest.land_manifest(spark, named, str(folder), str(path), FIELDS, "|", run_name).collect()
    return {os.path.basename(r.path): (r.status, r.cause, r.lines, r.faulty) for r in log}


def landed(spark, path):
    return sorted((r.id, r.run) for r in manifest.read_landed(spark, str(path), ROWS).collect())


def test_faults_stay_with_their_file(spark, tmp_path):
    folder, path = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    whole = gzip.compress(b"5|e\n") + gzip.compress(b"6|f\n")  # two members
    made = {
        "good.txt": b"1|a\n2|b\n", "[odd] name.txt": b"3|c\n", "short.txt": b"4|d\n4\n4|x|y\n", "bytes.txt": b"7|\xc3\x28\n8|h\n", "empty.txt": b"",
        "good.gz": whole, "cut.gz": whole[:-6], "junk.gz": b"no archive", "none.gz": gzip.compress(b""),
    }
    for name, content in made.items():
        (folder / name).write_bytes(content)
    names = [*made, "gone.txt", "good.txt"]
    assert run(spark, folder, path, names, "a") == {
        "good.txt": ("landed", None, 2, 0), "[odd] name.txt": ("landed", None, 1, 0), "good.gz": ("landed", None, 2, 0),
        "short.txt": ("refused", "fields", 3, 2), "bytes.txt": ("refused", "charset", 2, 1), "empty.txt": ("refused", "empty", 0, 0),
        "cut.gz": ("refused", "damaged", 0, 0), "junk.gz": ("refused", "damaged", 0, 0), "none.gz": ("refused", "empty", 0, 0), "gone.txt": ("refused", "missing", 0, 0),
    }
    assert landed(spark, path) == [(i, "a") for i in (1, 2, 3, 5, 6)]
    # The same run again gives the same rows once; the next one takes what was mended or has changed, and nothing twice.
    run(spark, folder, path, names, "a")
    assert landed(spark, path) == [(i, "a") for i in (1, 2, 3, 5, 6)]
    (folder / "short.txt").write_bytes(b"4|d\n")
    (folder / "good.txt").write_bytes(b"1|a\n2|b\n9|i\n")
    second = run(spark, folder, path, names, "b")
    assert {n for n, v in second.items() if v[0] == "landed"} == {"short.txt", "good.txt"}
    assert landed(spark, path) == sorted([*[(i, "a") for i in (1, 2, 3, 5, 6)], *[(i, "b") for i in (1, 2, 4, 9)]])


def test_a_run_that_breaks_before_its_log_is_not_seen(spark, tmp_path):
    folder, path = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    (folder / "x.txt").write_bytes(b"1|a\n")
    run(spark, folder, path, ["x.txt"], "a")
    broken = spark.createDataFrame([(99, "z", "b")], "id long, name string, run string")
    publish.publish(broken, f"{path}/rows", ["run"])
    assert landed(spark, path) == [(1, "a")]
    (folder / "y.txt").write_bytes(b"2|b\n")
    run(spark, folder, path, ["x.txt", "y.txt"], "b")
    assert landed(spark, path) == [(1, "a"), (2, "b")]


def test_publication_counts_in_one_step(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "v long, dt string, hh string"
    first = spark.createDataFrame([(1, "20240101", "00"), (2, "20240101", "01"), (3, "20240102", "00")], schema)
    seen = lambda: sorted(map(tuple, publish.read_published(spark, path, schema).collect()))
    assert seen() == []
    assert publish.publish(first, path, ["dt", "hh"]) == ["dt=20240101/hh=00", "dt=20240101/hh=01", "dt=20240102/hh=00"]
    name = publish.stage(first.where("hh = '00'").withColumn("v", F.col("v") + 10), path, ["dt", "hh"])
    assert seen() == sorted(map(tuple, first.collect()))
    publish.commit(spark, path, ["dt", "hh"], name)
    publish.commit(spark, path, ["dt", "hh"], name)
    assert seen() == [(2, "20240101", "01"), (11, "20240101", "00"), (13, "20240102", "00")]
    publish.stage(first, path, ["dt", "hh"])  # never committed
    assert publish.sweep(spark, path, ["dt", "hh"]) == 5  # two replaced, three never committed
    assert seen() == [(2, "20240101", "01"), (11, "20240101", "00"), (13, "20240102", "00")]


def test_bins_lose_no_line(spark, tmp_path):
    draw, lines = random.Random(2), []
    source = tmp_path / "in"
    source.mkdir()
    for n, count in enumerate((2000, 3, 1, 700)):
        part = [f"{n}:{i}:" + "x" * draw.randint(0, 90) for i in range(count)]
        lines += part
        text = "\n".join(part) + ("\n" if n % 2 else "")
        if n == 3:
            (source / f"f{n}.txt.gz").write_bytes(gzip.compress(text.encode()))
        else:
            (source / f"f{n}.txt").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    sizes = bins.bin_text(spark, [str(source)], str(tmp_path / "out"), 10_000).collect()
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == sorted(lines)
    packed = sum(len(line) + 1 for line in lines if line.startswith("3:"))  # the archive cannot be cut
    assert sum(r.lines for r in sizes) == len(lines) and len(sizes) > 9
    assert sorted(r.bytes for r in sizes)[-2] <= 10_000 + 4 * 110 and max(r.bytes for r in sizes) <= packed + 10_000 + 4 * 110


def test_copies_differ_where_they_do(spark):
    schema = "part string, k1 long, k2 string, v double"
    rows = [("p" if i % 3 else None, i, None if i % 5 == 0 else str(i % 7), i / 3) for i in range(400)] + [("p", 1, "1", 9.0), ("p", 1, "1", 9.0)]
    left = spark.createDataFrame(rows, schema)
    assert copies.differing_keys(left, left.repartition(3).select("v", "k2", "k1", "part"), "part", ["k1", "k2"]).collect() == []
    other = [r for r in rows if r[1] not in (7, 30)] + [(None, 1000, None, None)]
    other = [(p, a, b, None if a == 44 else v) for p, a, b, v in other]
    other.remove(("p", 1, "1", 9.0))  # one of two equal rows
    other = [(p, a, "" if a == 55 and b is None else b, v) for p, a, b, v in other]  # an empty string is not null
    found = copies.differing_keys(left, spark.createDataFrame(other, schema), "part", ["k1", "k2"], buckets=16).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(
        map(repr, [("p", 7, "0", "removed"), (None, 30, None, "removed"), (None, 1000, None, "added"), ("p", 44, "2", "changed"), ("p", 1, "1", "changed"), ("p", 55, None, "removed"), ("p", 55, "", "added")])
    )
    buckets = copies.unequal_buckets(left, spark.createDataFrame(other, schema), "part", ["k1", "k2"], 4096).collect()
    assert 5 <= len(buckets) <= 7 and sum(r.left_rows for r in buckets) <= 12
    with pytest.raises(ValueError):
        copies.differing_keys(left, left.drop("v"), "part", ["k1"])


@pytest.mark.parametrize("few", [True, False])
def test_names_within_paths(spark, monkeypatch, few):
    monkeypatch.setattr(matching, "is_small", lambda df, *a: few)
    draw = random.Random(3)
    paths = ["".join(draw.choices("abc/.é", k=draw.randint(0, 25))) for _ in range(120)] + [None, "", "abcabcabc"]
    members = [(f"a{i % 40}", p) for i, p in enumerate(paths)]
    for wanted in (["abca", "zzzz", None], ["b", "é/"], ["cab", "a.b", "bcabc", "abcabcabc", "ab/c"], [""], ["abcabcabcabc"], []):
        frame = spark.createDataFrame([(w,) for w in wanted], "name string")
        got = matching.archives_holding(spark.createDataFrame(members, "archive string, member string"), frame, "archive", "member", "name").collect()
        assert sorted(r.archive for r in got) == sorted({a for a, p in members for w in wanted if p is not None and w is not None and w in p})


def test_readable_and_sealed_come_from_one_pass(spark, tmp_path, monkeypatch):
    (tmp_path / "in.txt").write_text("1^010\nbare line\n2^011\n")
    reads, plain = [], jobs.files.read_lines
    monkeypatch.setattr(jobs.files, "read_lines", lambda s, p, *a: reads.append(p) or plain(s, p, *a))
    rules = CryptoRules(encryption=[CryptoRule("mdn", (2,))])
    jobs.land_text_files(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"), FIELDS, "^", rules, CipherKeys({"mdn": "0123456789abcdef"}), raw_path=str(tmp_path / "raw" / "x"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "raw" / "x")).collect()) == ["1^010", "2^011", "bare line"]
    sealed = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.id for r in sealed) == [1, 2] and not {r.name for r in sealed} & {"010", "011"}
    assert len(reads) == 1


def test_a_folder_is_replaced(spark, tmp_path):
    for name in ("new", "old"):
        spark.range(2).write.parquet(str(tmp_path / name))
    writers.replace_folder(spark, str(tmp_path / "new"), str(tmp_path / "old"))
    assert sorted(os.listdir(tmp_path)) == ["old"] and spark.read.parquet(str(tmp_path / "old")).count() == 2
    writers.replace_folder(spark, str(tmp_path / "none"), str(tmp_path / "deep" / "er"))
    assert os.listdir(tmp_path / "deep" / "er") == []


def test_patterns_meet_names_by_their_beginnings(spark):
    draw = random.Random(5)
    names = ["".join(draw.choices("ab_.1", k=draw.randint(0, 12))) for _ in range(150)] + [None, "a.b", "a+b", "ab" * 20]
    patterns = ["a", "ab*", "ab+_", r"a\.b", r"a\+b", "(ab|a_)1", "a|b", "", ".*1", "[ab]1", "^ab", "a{2}", "_{1,2}a", "ab" * 18, "abab.?", None, "(?i:AB)", r"\d", "a(b)", "b?a"]
    files_, wanted = spark.createDataFrame([(n,) for n in names], "name string"), spark.createDataFrame([(p,) for p in patterns], "pattern string")
    found = matching.match_patterns(files_, "name", wanted, "pattern")
    plain = sorted((n, p) for n in names for p in patterns if n is not None and p is not None and re.match(f"(?:{p})", n))
    assert sorted((r["name"], r["pattern"]) for r in found.collect()) == plain
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()
    prefixes = {r[0]: r[1] for r in wanted.select("pattern", matching.fixed_prefix(F.col("pattern"))).collect()}
    assert prefixes["ab+_"] == "a" and prefixes[r"a\.b"] == "a.b" and prefixes["a|b"] == "" and prefixes["^ab"] == "ab" and prefixes["a(b)"] == "a"


def test_charsets_in_one_scan(spark, tmp_path):
    for name, content in {"u.txt": "가\n나\n".encode(), "k.txt": "가\n나\n".encode("euc-kr"), "e.txt": b"", "bad.txt": b"\xc3\x28\nok\n"}.items():
        (tmp_path / name).write_bytes(content)
    found = {os.path.basename(r.file): (r.charset, r.damaged, r.lines) for r in files.best_charset(spark, str(tmp_path), ["UTF-8", "EUC-KR"]).collect()}
    assert found == {"u.txt": ("UTF-8", 0, 2), "k.txt": ("EUC-KR", 0, 2), "e.txt": ("UTF-8", 0, 0), "bad.txt": ("UTF-8", 1, 2)}
