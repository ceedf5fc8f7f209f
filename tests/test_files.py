"""Files: formats, separators, charsets, names, markers, archives and streams."""

import io
import json
import os
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.config import CipherKeys, CryptoRule, CryptoRules, ReadSpec, WriteSpec
from quayside.functions.crypto import apply_rules
from quayside.operators import frames, governance, matching, ordering
from quayside.plans import jobs
from quayside.sinks import writers
from quayside.sources import archives, database, files
from quayside.streaming.messages import consume, file_messages, kafka_messages

KEYS = CipherKeys({"mdn": "0123456789abcdef"})
SCHEMA = {
    "fields": [
        {"name": "c_str", "type": "string"},
        {"name": "c_int", "type": "int"},
        {"name": "c_big", "type": "bigint"},
        {"name": "c_last", "type": "string"},
    ]
}


@pytest.fixture()
def people(spark):
    return spark.createDataFrame([(i, f"name {i}", i * 1.5) for i in range(50)], "id long, name string, v double")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("fmt, codec", [("parquet", None), ("parquet", "snappy"), ("parquet", "gzip"), ("orc", None), ("orc", "snappy")])
def test_columnar_round_trip(spark, people, tmp_path, fmt, codec):
    path = writers.write_files(people, str(tmp_path / "x"), WriteSpec(fmt, codec))
    assert rows(files.read_files(spark, path, ReadSpec(fmt))) == rows(people)


@pytest.mark.parametrize("sep", [",", "\x1e", "|^|", ",|'", "␞"])
@pytest.mark.parametrize("codec", [None, "gzip", "bzip2"])
def test_text_round_trip(spark, people, tmp_path, sep, codec):
    schema = {"fields": [{"name": "id", "type": "bigint"}, {"name": "name", "type": "string"}, {"name": "v", "type": "double"}]}
    path = str(tmp_path / "x")
    if len(sep.encode()) == 1:
        writers.write_files(people, path, WriteSpec("dat", codec, sep))
    else:
        writers.write_lines(people, path, sep, codec or "none")
    assert rows(files.read_files(spark, path, ReadSpec("csv", sep, schema=schema))) == rows(people)


def test_dirty_text_lands_typed(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.dat").write_text("x\x1e1\x1e2.9\x1eabc\t\n \x1eabc\x1e-1.5\x1e\nonly\ntoo\x1e1\x1e2\x1e3\x1e4\n")
    done = jobs.land_delimited(spark, str(source), str(tmp_path / "out"), ReadSpec("csv", "\\036", schema=SCHEMA))
    assert (done.rows, done.failures, done.failed["c_int"]) == (4, 1, 1)
    got = spark.read.parquet(done.path)
    assert {tuple(r) for r in got.collect()} == {
        ("x", 1, 2, "abc"), (None, None, -1, None), ("only", None, None, None), ("too", 1, 2, "3"),
    }
    floor = jobs.land_delimited(spark, str(source), str(tmp_path / "floor"), ReadSpec("csv", "\x1e", schema=SCHEMA), bigint_mode="floor")
    assert -2 in [r["c_big"] for r in spark.read.parquet(floor.path).collect()]


def test_empty_input_keeps_the_schema(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.dat").write_text("")
    target = str(tmp_path / "out")
    assert jobs.land_delimited(spark, str(source), target, ReadSpec("csv", schema=SCHEMA)).rows == 0
    got = spark.read.parquet(target)
    assert got.count() == 0 and [f.simpleString() for f in got.schema][1] == "c_int:int"
    assert len(writers.data_files(spark, target)) >= 1


def test_header_of_every_file_is_dropped(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(f"h1,h2\n{name},1\n")
    schema = {"fields": [{"name": "x", "type": "string"}, {"name": "y", "type": "int"}]}
    got = files.read_files(spark, str(tmp_path), ReadSpec("csv", ",", header=True, schema=schema))
    assert rows(got) == [("a", 1), ("b", 1)]


@pytest.mark.parametrize("charset", ["EUC-KR", "MS949"])
def test_legacy_charsets(spark, tmp_path, charset):
    (tmp_path / "a.dat").write_bytes("가나|다라\n".encode("cp949"))
    schema = {"fields": [{"name": "x", "type": "string"}, {"name": "y", "type": "string"}]}
    got = files.read_text_columns(spark, str(tmp_path / "a.dat"), ReadSpec("csv", "|", charset, schema=schema))
    assert rows(got) == [("가나", "다라")]


def test_malformed_bytes_are_replaced_and_counted(spark, tmp_path):
    (tmp_path / "a.dat").write_bytes(b"ok|1\n\xff\xfe|2\n")
    schema = {"fields": [{"name": "x", "type": "string"}, {"name": "y", "type": "int"}]}
    got = files.read_text_columns(spark, str(tmp_path / "a.dat"), ReadSpec("csv", "|", schema=schema))
    assert tuple(files.replacement_rate(got, ["x"]).first()) == (2, 1)


def test_best_charset(spark, tmp_path):
    (tmp_path / "k.dat").write_bytes("가나다\n".encode("euc-kr"))
    (tmp_path / "u.dat").write_text("가나다\nabc\n")
    (tmp_path / "e.dat").write_text("")
    got = files.best_charset(spark, str(tmp_path), ["UTF-8", "EUC-KR"]).collect()
    assert {os.path.basename(r["file"]): r["charset"] for r in got} == {"k.dat": "EUC-KR", "u.dat": "UTF-8", "e.dat": "UTF-8"}


def test_single_named_file(spark, people, tmp_path):
    path = str(tmp_path / "db=a/tb=t/dt=20240101/hh=03")
    spec = WriteSpec("parquet", "zstd", merge=True, file_name=writers.merged_file_name("t_20240101", "parquet", "zstd"))
    writers.write_files(people.repartition(5), path, spec)
    assert sorted(n for n in os.listdir(path) if not n.startswith((".", "_"))) == ["t_20240101.zstd.parquet"]
    assert rows(spark.read.parquet(path)) == rows(people)
    assert jobs.merged_name(path, spec) == "t_20240101_03.parquet"
    with pytest.raises(ValueError):
        jobs.merged_name("/x", spec)


def test_rename_needs_exactly_one_part(spark, people, tmp_path):
    path = str(tmp_path / "x")
    people.repartition(3).write.parquet(path)
    with pytest.raises(RuntimeError):
        writers.rename_single_part(spark, path, "y.parquet")


def test_large_results_are_numbered(spark, people, tmp_path):
    path = str(tmp_path / "x")
    writers._write_merged(people.repartition(3), path, WriteSpec("parquet", merge=True, file_name="x.parquet"), limit=1)
    assert [n for n, _ in writers.data_files(spark, path)] == ["x_1.parquet", "x_2.parquet", "x_3.parquet"]
    assert rows(spark.read.parquet(path)) == rows(people)


def test_files_count_under_any_name(spark, people, tmp_path):
    for i in range(6):
        (tmp_path / "in" / f"k={i % 2}").mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / f"k={i % 2}" / f"tb_{i}.dat").write_text(f"line {i}\n" * 100)
    (tmp_path / "in" / "_SUCCESS").write_text("")
    (tmp_path / "in" / "_temporary").mkdir()
    (tmp_path / "in" / "_temporary" / "left.dat").write_text("x")
    assert len(writers.data_files(spark, str(tmp_path / "in"))) == 6
    named = str(tmp_path / "named")
    for i in range(2):
        writers.write_files(people, f"{named}/p={i}", WriteSpec("parquet", merge=True, file_name=f"n_{i}.parquet"))
    assert writers.merge_small_files(spark, named, str(tmp_path / "one"))
    assert len(writers.data_files(spark, str(tmp_path / "one"))) == 1
    assert writers.merge_text(spark, [str(tmp_path / "in")], str(tmp_path / "text"), target_bytes=2000) == 3


def test_text_survives_merging_and_reading(spark, tmp_path):
    values = ["a\rb", 'say "x"', "back\\slash", "a|b", "plain", 'end"', "\\"]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    spec = WriteSpec("csv", None, "|", merge=True, file_name="all.csv")
    writers.write_files(frame.repartition(3), str(tmp_path / "x"), spec)
    read = ReadSpec("csv", sep="|", quote='"', schema={"fields": [{"name": "i", "type": "int"}, {"name": "v", "type": "string"}]})
    got = files.read_text_columns(spark, str(tmp_path / "x"), read)
    # A reader that may split files takes a carriage return for a line break; all other values come back.
    assert {v for v in values if "\r" not in v} <= {r["v"] for r in got.collect()}
    assert b'a\rb' in (tmp_path / "x" / "all.csv").read_bytes()
    writers.write_lines(spark.createDataFrame([("a\nb", "c\r\nd")], "x string, y string"), str(tmp_path / "lines"), "\u241e")
    assert [r[0] for r in spark.read.text(str(tmp_path / "lines")).collect()] == ["a b\u241ec d"]


def test_protect_keeps_data_columns(spark, tmp_path):
    keys = CipherKeys({"mdn": "0123456789abcdef"})
    rule = [CryptoRule("mdn", [1])]
    frame = spark.createDataFrame([("010", "20240101")], "n string, dt string")
    for place, wanted in (("plain", ["20240101"]), ("dt=20240101", ["20240101"]), ("dt=20240202", None)):
        source, target = str(tmp_path / "in" / place), str(tmp_path / "out" / place)
        frame.write.parquet(source)
        if wanted is None:
            with pytest.raises(Exception, match="differs from the path"):
                jobs.protect(spark, source, target, ReadSpec("parquet"), WriteSpec(), rule, keys)
        else:
            jobs.protect(spark, source, target, ReadSpec("parquet"), WriteSpec(), rule, keys)
            read = spark.read.parquet(target)
            assert read.columns == ["n", "dt"] and [r["dt"] for r in read.collect()] == wanted


def test_lines_are_the_same_in_every_charset(spark, tmp_path):
    for charset in ("utf-8", "euc-kr"):
        (tmp_path / charset).mkdir()
        (tmp_path / charset / "a.dat").write_bytes("머리\na\0b\n\n가z\n".encode(charset))
        got = files.read_lines(spark, str(tmp_path / charset), charset.upper()).collect()
        assert [r[0] for r in got] == ["머리", "a\0b", "", "가z"]
        got = files.read_lines(spark, str(tmp_path / charset), charset.upper(), header=True).collect()
        assert [r[0] for r in got] == ["a\0b", "", "가z"]


def test_relative_rules_and_siblings(spark):
    paths = spark.createDataFrame([("/x/db=a/tb=t/f",), ("/x/db=ab/tb=t/f",)], "path string")
    rules = spark.createDataFrame([("db=a/tb=t", 1), ("/db=ab/", 2), ("", 3), (None, 4)], "dir string, r int")
    got = matching.join_contained(paths, "path", rules, "dir")
    assert sorted((r["path"], r["r"]) for r in got.collect()) == [("/x/db=a/tb=t/f", 1), ("/x/db=ab/tb=t/f", 2)]
    listed = spark.createDataFrame([("/a/b",), ("/a/b-old/x",), ("/a/b/c",)], "path string")
    assert sorted(r[0] for r in matching.leaf_paths(listed, "path").collect()) == ["/a/b-old/x", "/a/b/c"]


def test_parts_follow_the_volume(spark, people, tmp_path, monkeypatch):
    path = str(tmp_path / "x")
    people.repartition(1).write.parquet(path)
    small = ordering.parts_for(spark.read.parquet(path))
    monkeypatch.setattr(ordering, "PART_BYTES", 50)
    assert small == 8 < ordering.parts_for(spark.read.parquet(path))


def test_reconcile_sees_nulls_and_names(spark):
    left = spark.createDataFrame([(None, "x")], "a string, b string")
    right = spark.createDataFrame([("x", None)], "a string, b string")
    assert governance.reconcile(left, right).first()["status"] == 5
    assert governance.reconcile(left, left.select("b", "a")).first()["status"] == 4
    assert governance.reconcile(left, left.toDF("a", "c")).first()["status"] == 5


def test_merged_csv(spark, people, tmp_path):
    path = str(tmp_path / "x")
    writers.write_files(people.repartition(3), path, WriteSpec("csv", None, "|", merge=True, file_name="all.csv"))
    lines = (tmp_path / "x" / "all.csv").read_text().splitlines()
    assert sorted(lines) == sorted(f"{i}|name {i}|{i * 1.5}" for i in range(50))


def test_text_is_merged_by_size(spark, people, tmp_path):
    source = str(tmp_path / "in")
    people.select("name").repartition(6).write.text(source)
    assert writers.merge_text(spark, [source], str(tmp_path / "one")) == 1
    assert len(writers.data_files(spark, str(tmp_path / "one"))) == 1
    assert writers.merge_text(spark, [source], str(tmp_path / "more"), target_bytes=150) > 1
    assert spark.read.text(str(tmp_path / "more")).count() == 50


@pytest.mark.parametrize("limit", [writers.MERGE_BYTES, 1])
def test_merged_csv_has_one_header_per_file(spark, people, tmp_path, limit):
    path = str(tmp_path / "x")
    writers._write_merged(people.repartition(3), path, WriteSpec("csv", None, "|", header=True, merge=True), limit)
    assert (len(writers.data_files(spark, path)) == 1) == (limit > 1)
    assert spark.read.option("header", True).option("sep", "|").csv(path).count() == 50


def test_raw_lines(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.dat").write_bytes(f'h|{name}\n가|"x\\"y|\\\n'.encode("euc-kr"))
    got = files.read_lines(spark, str(tmp_path), "EUC-KR", header=True)
    assert rows(got) == [('가|"x\\"y|\\',)] * 2


def test_redelimit_and_reencode(spark, tmp_path):
    (tmp_path / "a.dat").write_bytes('"가","b,c"\n'.encode("euc-kr"))
    jobs.redelimit(spark, str(tmp_path / "a.dat"), str(tmp_path / "u"), '","', "\x1e", "EUC-KR")
    assert rows(spark.read.text(str(tmp_path / "u"))) == [('"가"\x1e"b,c"',)]
    jobs.redelimit(spark, str(tmp_path / "u"), str(tmp_path / "k"), "\x1e", "|^|", target_encoding="EUC-KR")
    assert b'"' + "가".encode("euc-kr") + b'"|^|"b,c"\n' in [p.read_bytes() for p in (tmp_path / "k").glob("part-*")]


def test_sources_that_arrive_encrypted(spark, tmp_path):
    rule = CryptoRules(decryption=(CryptoRule("mdn", (2,)),), already_encrypted=True)
    (tmp_path / "a.txt").write_text("1|MOfLtxzZ0YgS4+5cPylFYw==|2|z\n")
    schema = {"fields": [{"name": n, "type": "string"} for n in "abcd"]}
    jobs.land_text_files(
        spark, str(tmp_path / "a.txt"), str(tmp_path / "out"), schema, "|", rule, KEYS, raw_path=str(tmp_path / "raw")
    )
    assert rows(spark.read.text(str(tmp_path / "raw"))) == [("1|hello|2|z",)]
    assert spark.read.parquet(str(tmp_path / "out")).first()["b"].startswith("MOfL")


def test_wildcard_directories(spark, tmp_path):
    for name in ("EMS1/d1", "EMS2/d1", "OTHER/d1"):
        (tmp_path / name).mkdir(parents=True)
        (tmp_path / name / "f.dat").write_text(f"{name}|1\n")
    got = files.read_lines(spark, f"{tmp_path}/EMS*/d*")
    assert rows(got) == [("EMS1/d1|1",), ("EMS2/d1|1",)]


def test_sized_parts(spark, people, tmp_path):
    path = str(tmp_path / "x")
    assert writers.write_sized(people, path, total_bytes=2500, target_bytes=1000) == 3
    assert len(writers.data_files(spark, path)) == 3 and rows(spark.read.parquet(path)) == rows(people)


def test_partitions_replace_only_their_own(spark, tmp_path):
    path = str(tmp_path / "x")
    frame = spark.createDataFrame([(1, "20240101", "03"), (2, "20240102", "04")], "v int, dt string, hh string")
    writers.write_partitions(frame, path, ["dt", "hh"])
    again = spark.createDataFrame([(9, "20240101", "03")], "v int, dt string, hh string")
    writers.write_partitions(again, path, ["dt", "hh"])
    assert rows(spark.read.parquet(path)) == [(2, "20240102", "04"), (9, "20240101", "03")]


def test_markers_and_reports(spark, people, tmp_path):
    writers.write_marker(spark, str(tmp_path / "a.CHK"))
    assert (tmp_path / "a.CHK").stat().st_size == 0
    path = writers.write_report(people.limit(1).select("id", F.lit('a"b').alias("note")), str(tmp_path / "r"))
    back = spark.read.option("sep", "\x1e").option("escape", "\\").option("header", True).csv(path).first()
    assert back["note"] == 'a"b'


def test_schema_and_ddl_catalogues(spark, tmp_path):
    (tmp_path / "s").mkdir()
    for name in ("d_a.t1", "d_a.t2"):
        (tmp_path / "s" / f"{name}.json").write_text(
            json.dumps({"fields": [{"name": "x_cdr", "type": "string"}, {"name": "lat", "type": "double"}]}, indent=1)
        )
    (tmp_path / "s" / "d_a.t1.hql").write_text("create table t1 (\n `x_cdr` string COMMENT '단말 번호',\n `lat` double COMMENT '위도')")
    (tmp_path / "s" / "d_a.t9.hql").write_text("create table t9 (\n `x_cdr` string COMMENT '단말 번호')")
    found = jobs.discover(spark, str(tmp_path / "s"), str(tmp_path / "s")).select("path", "index", "name", "rule")
    assert rows(found) == [
        ("/db=d_a/tb=t1", 0, "x_cdr", "comment"),
        ("/db=d_a/tb=t1", 1, "lat", "comment"),
        ("/db=d_a/tb=t2", 0, "x_cdr", "name"),
    ]
    assert files.read_schema_file(spark, str(tmp_path / "s" / "d_a.t1.json"))["fields"][0]["name"] == "x_cdr"


def test_listing_and_readers(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "x"))
    listed = files.list_files(spark, str(tmp_path), ".parquet")
    assert listed.columns == ["path", "length", "modified"] and listed.count() >= 1
    cases = [("/a.b/x.parquet", None, None, "parquet"), ("/f.DAT", None, "|", "csv"), ("/f.DAT", None, None, None),
             ("/f", "orc", None, "orc"), ("/f.avro", None, None, "avro"), ("/f", "dat", ",", "csv"), ("/f.xls", None, None, None)]
    frame = spark.createDataFrame(cases, "p string, f string, s string, want string")
    for row in frame.select("*", files.format_of(F.col("p"), F.col("f"), F.col("s")).alias("got")).collect():
        assert row["got"] == row["want"], row


def test_bracketed_paths(spark, people, tmp_path):
    path = tmp_path / "x[1]"
    people.write.parquet(str(path))
    assert spark.read.parquet(files.escape_glob(str(path))).count() == 50


@pytest.mark.parametrize("kind", ["zip", "tar", "tar.gz"])
def test_archive_lines(spark, tmp_path, kind):
    lines = {f"in/m{i}.csv": "".join(f"{i}|{n}\n" for n in range(30)) for i in range(3)}
    target = tmp_path / f"a.{kind}"
    if kind == "zip":
        with zipfile.ZipFile(target, "w") as bundle:
            for name, text in lines.items():
                bundle.writestr(name, text)
    else:
        with tarfile.open(target, "w:gz" if kind == "tar.gz" else "w") as bundle:
            for name, text in lines.items():
                info = tarfile.TarInfo(name)
                info.size = len(text)
                bundle.addfile(info, io.BytesIO(text.encode()))
    (tmp_path / "ignored.txt").write_text("x")
    want = sorted((m, n + 1, line) for m, t in lines.items() for n, line in enumerate(t.splitlines()))
    for whole_bytes in (archives.WHOLE_BYTES, 0):  # from memory, and where they are stored
        got = archives.read_archive_lines(spark, str(tmp_path), whole_bytes=whole_bytes)
        assert rows(got.select("member", "line_no", "line")) == want
    assert {r["member"] for r in archives.list_members(spark, str(tmp_path)).collect()} == set(lines)


def test_text_landing_job(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("1|secret  |x|4\nno separator\n2|other|y|5\n")
    out = jobs.land_text_files(
        spark, str(source), str(tmp_path / "out"), SCHEMA, "|",
        CryptoRules(encryption=(CryptoRule("mdn", (2,)),), decryption=(CryptoRule("mdn", (2,)),)), KEYS,
        delete_columns=[3, 1], raw_path=str(tmp_path / "raw"),
    )
    got = spark.read.parquet(out.path)
    assert got.columns == ["c_int", "c_last"] and got.count() == 2
    assert out.rows == 2 and out.failed["c_int"] == 2  # "secret" and "other" are no numbers
    assert spark.read.text(str(tmp_path / "raw")).count() == 3


def test_protect_job_adds_path_partitions(spark, people, tmp_path):
    source, target = str(tmp_path / "db=a/tb=t/dt=20240101/hh=03"), str(tmp_path / "out")
    people.select("id", "name").write.parquet(source)
    done = jobs.protect(spark, source, target, ReadSpec("parquet"), WriteSpec("orc"), [CryptoRule("mdn", (2,))], KEYS)
    assert (done.rows, done.failures) == (50, 0)
    again = jobs.protect(
        spark, source, target + "2", ReadSpec("parquet"), WriteSpec("orc"), [CryptoRule("mdn", (2,))], KEYS, "decryption"
    )
    assert again.failed == {"name": 50}  # plain names are no cipher text
    sealed = spark.read.orc(target)
    assert sealed.columns == ["id", "name", "dt", "hh"]
    assert {(r["dt"], r["hh"]) for r in sealed.collect()} == {("20240101", "03")}
    opened = apply_rules(sealed, [CryptoRule("mdn", (2,))], KEYS, "decryption").select("id", "name")
    assert rows(opened) == rows(people.select("id", "name"))


def test_export_keeps_commas_inside_values(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a,b", None), (2, "null", "x")], "i int, t string, u string")
    jobs.export_csv(frame, str(tmp_path / "x"), "␞", string_null=True)
    assert rows(spark.read.text(str(tmp_path / "x"))) == [("1␞a,b␞",), ("2␞␞x",)]


def test_export_of_a_partition(spark, people, tmp_path):
    source = str(tmp_path / "db=a/tb=t/dt=20240101/hh=03")
    stamped = people.select("id", F.lit("2024-01-01 20:00:00").cast("timestamp").alias("ts")).repartition(3)
    stamped.write.parquet(source)
    path = jobs.export_partition(spark, source, str(tmp_path / "x"), "|^|", add_partitions=True, merge=True)
    assert len(writers.data_files(spark, path)) == 1
    lines = sorted(r[0] for r in spark.read.text(path).collect())
    assert lines[0] == "0|^|2024-01-02 05:00:00|^|20240101|^|03" and len(lines) == 50
    with pytest.raises(ValueError):
        stamped.write.parquet(str(tmp_path / "plain"))
        jobs.export_partition(spark, str(tmp_path / "plain"), str(tmp_path / "y"), add_partitions=True)


def test_quotes(spark, tmp_path):
    frame = spark.createDataFrame([(1, 'say "hi", you'), (2, "plain")], "i int, t string")
    path = jobs.export_csv(frame, str(tmp_path / "x"), ",")
    assert rows(spark.read.text(path)) == [('1,"say ""hi"", you"',), ("2,plain",)]
    names = {"fields": [{"name": "i", "type": "string"}, {"name": "t", "type": "string"}]}
    assert rows(files.read_text_columns(spark, path, ReadSpec("csv", ",", schema=names))) == [("1", 'say "hi", you'), ("2", "plain")]
    (tmp_path / "q.dat").write_text('1|"a\n')
    raw = files.read_text_columns(spark, str(tmp_path / "q.dat"), ReadSpec("csv", "|", quote="", schema=names))
    assert rows(raw) == [("1", '"a')]
    (tmp_path / "m.dat").write_text('1|"a\nb"\n')
    multi = files.read_text_columns(spark, str(tmp_path / "m.dat"), ReadSpec("csv", "|", schema=names, multi_line=True))
    assert rows(multi) == [("1", "a\nb")]


def test_database_helpers():
    assert database.page_ranges(10, 5) == [(0, 5), (5, 10)]
    assert database.page_ranges(11, 5)[-1] == (10, 11)
    assert database.page_ranges(0, 5) == [] and database.page_ranges(7, 0) == [(0, 7)]
    assert database.fill_query("a > # and b < #", ["1", "2"]) == "a > 1 and b < 2"
    with pytest.raises(ValueError):
        database.fill_query("a > #", [])


def test_audit_table_and_topic(spark, tmp_path):
    audit = governance.provide_audit(spark.createDataFrame([("A1", "/db=a/tb=t/f")], "id string, filepath string"))
    for _ in range(2):
        governance.append_audit(audit, str(tmp_path / "audit"))
    assert spark.read.parquet(str(tmp_path / "audit")).count() == 2
    with pytest.raises(files.MissingConnector):
        governance.send_audit(governance.audit_messages(audit, "id", 2), "localhost:1", "t")


def test_scratch_is_released(spark):
    from quayside.session import release_scratch, settle

    settle(spark.range(5).toDF("id"), "gone")
    path = f"{spark.conf.get('spark.checkpoint.dir')}/quayside"
    assert any(n.startswith("gone") for n in os.listdir(path))
    assert release_scratch(spark) >= 1
    assert not any(n.startswith("gone") for n in os.listdir(path))


def test_missing_connectors(spark, people, tmp_path):
    with pytest.raises(files.MissingConnector):
        files.read_files(spark, str(tmp_path), ReadSpec("avro"))
    with pytest.raises(files.MissingConnector):
        writers.write_files(people, str(tmp_path / "x"), WriteSpec("avro"))
    with pytest.raises(files.MissingConnector):
        kafka_messages(spark, "localhost:1", "t", partitions=4)
    with pytest.raises(files.MissingConnector):
        database.extract(spark, {"url": "jdbc:nosuch:x"}, "SELECT 1", "1", page_rows=10)


def test_bounded_stream_resumes(spark, tmp_path):
    source, target, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    schema = T.StructType([T.StructField("value", T.StringType())])
    message = {"fields": [{"name": "a", "type": "int"}, {"name": "b", "type": "string"}]}

    def send(*texts):
        spark.createDataFrame([(t,) for t in texts], schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = file_messages(spark, source, schema, F.col("value"), files=1)
        consume(stream, message, target, offsets, drop_pattern="^drop", sep="|", partitions={"p": F.col("b")})

    send("1|x", "drop|me", "bad|y")
    run()
    send("2|x")
    run()
    run()
    assert {tuple(r) for r in spark.read.parquet(target).select("a", "b", "p").collect()} == {(1, "x", "x"), (None, "y", "y"), (2, "x", "x")}


def test_a_checkpoint_is_needed(spark, tmp_path):
    with pytest.raises((TypeError, ValueError)):
        consume(None, {"fields": []}, str(tmp_path), "")


def test_reconcile_and_counts(spark, people):
    assert tuple(governance.reconcile(people, people.repartition(4)).first()) == (50, 50, 4)
    assert tuple(governance.reconcile(people, people.limit(49)).first()) == (50, 49, 5)
    empty = people.limit(0)
    assert tuple(governance.reconcile(empty, empty).first()) == (0, 0, 4)


def test_audit_shapes(spark):
    landed = spark.createDataFrame([("h1", "/db=a/tb=t/dt=20240101/hh=03/f.parquet", 2)], "collect_hist_id string, dest_path string, retry_id_seq int")
    audit = governance.collect_audit(landed, "S", "R")
    assert audit.schema.names == governance.COLLECT_AUDIT.names and len(audit.columns) == 23
    row = audit.first()
    assert (row["db"], row["tb"], row["filenm"], row["version"], row["status_cd"], row["retry"], row["target_dt"]) == (
        "a", "t", "f.parquet", "2", "R", True, "2024010103",
    )
    assert row["partitions"] == [{"dt": "20240101"}, {"hh": "03"}]


def test_frames(spark, people):
    assert frames.drop_columns(people, [3, 1]).columns == ["name"]
    assert frames.pick_columns(people, [2, 0]).columns == ["v", "id"]
    assert frames.drop_matching(people, "name", None).count() == 50
    assert frames.drop_matching(people, "name", "name 1").count() == 39
    wide = spark.range(250).select(F.lit("t").alias("tb"), F.col("id").alias("index"), F.lit("n").alias("name"))
    lists = frames.listed_matches(wide, "tb", "index", ["name"])
    assert sorted(r["n"] for r in lists.select(F.size("matches").alias("n")).collect()) == [50, 100, 100]


def test_marked_and_binary_columns_become_text(spark):
    rows = spark.createDataFrame([("b0a1", b"\xc3\xa9", 1), ("zz", None, 2), (None, b"\xff", 3)], "x_Decode_To_Euc_Kr string, raw binary, n int")
    got = frames.decode_marked(rows)
    assert got.columns == rows.columns
    assert [tuple(r) for r in got.orderBy("n").collect()] == [("가", "é", 1), (None, None, 2), (None, "�", 3)]


def test_extracted_rows_pages_and_nulls(spark, tmp_path):
    schema = {"fields": [{"name": "id", "type": "bigint"}, {"name": "note", "type": "string"}]}
    rows = spark.createDataFrame([(i, None if i % 2 else f"a\r\n{i}") for i in range(25)], "id long, note string")
    done = jobs.extract_rows(rows, ["id"], 10, str(tmp_path / "pages"), str(tmp_path / "typed"), schema)
    assert (done.rows, done.failures) == (25, 0)
    counts = spark.read.text(str(tmp_path / "pages")).groupBy("page").count().orderBy("page").collect()
    assert [(int(p), n) for p, n in counts] == [(0, 10), (1, 10), (2, 5)]
    got = spark.read.parquet(str(tmp_path / "typed")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(i, None if i % 2 else f"a{i}") for i in range(25)]


def test_extracting_no_rows(spark, tmp_path):
    schema = {"fields": [{"name": "id", "type": "bigint"}]}
    done = jobs.extract_rows(spark.createDataFrame([], "id long"), ["id"], 10, str(tmp_path / "pages"), str(tmp_path / "typed"), schema)
    assert done.rows == 0
    assert spark.read.parquet(str(tmp_path / "typed")).columns == ["id"]


def test_samples_read_the_table_once(spark, people, tmp_path):
    people.write.parquet(str(tmp_path / "people"))
    stored = spark.read.parquet(str(tmp_path / "people"))
    got = governance.sample_values(stored, ["name", "v", "id"], ["id"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]  # tasks drop rows before the exchange
    assert [r.value for r in got.where("column_name = 'id'").orderBy(F.col("value").cast("int")).collect()] == ["1", "2", "3", "4", "5"]


def test_files_sampled_each_by_its_format(spark, tmp_path):
    frame = spark.createDataFrame([(str(i), "x") for i in range(9)], "a string, b string").coalesce(1)
    writers.write_files(frame, str(tmp_path / "p"), WriteSpec("parquet", merge=True, file_name="t.parquet"))
    writers.write_files(frame, str(tmp_path / "q"), WriteSpec("parquet", merge=True, file_name="t.parquet"))
    listed = [(f"{tmp_path}/{d}/t.parquet", None, None, None, ["a"]) for d in "pq"] + [("/x.bin", None, None, None, ["a"])]
    inventory = spark.createDataFrame(listed, "path string, format string, sep string, fields array<string>, columns array<string>")
    got = jobs.sample_files(spark, inventory).collect()
    assert len(got) == 11 and len({r.path for r in got}) == 3
    assert [r.value for r in got if r.reader is None] == [None]
    assert jobs.sample_files(spark, inventory.limit(0)).count() == 0
