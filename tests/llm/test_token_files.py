"""Token files: exact round trips of blocks, segments and whole tables."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quayside.llm import bpe, token_files
from tests.llm.cases import awkward, documents, empty, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


def rounds():
    draw = np.random.default_rng(5)
    yield np.empty(0, dtype=np.uint32)
    for size in (1, 127, 128, 129, 5000):
        for top in (1, 2, 300, 50_257, 2**32):
            ids = draw.integers(0, top, size, dtype=np.uint32)
            yield ids
            ids = ids.copy()
            ids[draw.random(size) < 0.05] = 2**32 - 1  # outliers
            yield ids


def test_blocks_come_back():
    for ids in rounds():
        packed = token_files.pack_blocks(ids)
        assert packed.read(0, len(ids)).tolist() == ids.tolist()
        for a, b in ((0, 1), (len(ids) // 3, len(ids) // 2), (len(ids) - 1, len(ids))):
            if 0 <= a < b:
                assert packed.read(a, b).tolist() == ids[a:b].tolist()


def test_outliers_do_not_widen_a_block():
    ids = np.full(128, 1000, dtype=np.uint32)
    ids[::2] += 3
    ids[[5, 77]] = [2**31, 50_000]
    packed = token_files.pack_blocks(ids)
    assert packed.widths.tolist() == [2] and packed.exceptions.tolist() == [2] and len(packed.body) == 4
    assert packed.places.tolist() == [5, 77] and packed.values.tolist() == [2**31 - 1000, 49_000]


def test_segments_find_their_borders():
    parts = [(["a", None], [3, 200]), (["é"], [1]), (["c", "d", "c"], [128, 1, 1])]
    ids = [np.arange(sum(n), dtype=np.uint32) * 77 for _, n in parts]
    content = b"".join(token_files.segment(4, i, pa.array(k, pa.string()), n, x) + b"\n" for i, ((k, n), x) in enumerate(zip(parts, ids, strict=True)))
    found = list(token_files.segments(memoryview(content)))
    assert [(s.part, s.number, s.keys.to_pylist(), s.lengths.tolist()) for s in found] == [(4, i, k, n) for i, (k, n) in enumerate(parts)]
    assert all(s.packed.read(0, s.packed.ids).tolist() == x.tolist() for s, x in zip(found, ids, strict=True))
    with pytest.raises(ValueError):
        list(token_files.segments(memoryview(content[:-1] + b"x")))


def expected(rows):
    library, start, out = Tokenizer.from_file(PATH), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("size", [40, 1 << 20])
def test_columns_of_texts(monkeypatch, size):
    monkeypatch.setattr(bpe, "COLUMN_BYTES", size)
    library, tool, draw = Tokenizer.from_file(PATH), bpe.PieceEncoder(PATH, limit=300), random.Random(8)
    parts = [" ", "  ", "\n", "\t", "a", "word", "'s", "<|endoftext|>", ".", "1", "é", "\x1c", "\x85", "\xa0", "\u2003", "\r\n", "😀", "_", " b c", " word,"]
    texts = ["", *["".join(draw.choices(parts, k=draw.randint(0, 14))) for _ in range(1500)], prose(1, 300)]
    found = []
    for ids, counts in tool.column_ids(pa.array(texts), b"\x07\0\0\0"):
        found += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert found == [[*library.encode(t, add_special_tokens=False).ids, 7] for t in texts]
    assert list(tool.column_ids(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("most", [300, token_files.SEGMENT_IDS])
def test_files_come_back(spark, tmp_path, most):
    docs = documents(spark, [prose(i, i % 40) for i in range(200)], keys=[(i * 7919) % 1009 for i in range(200)])
    token_files.write_token_files(docs, PATH, f"{tmp_path}/ids", segment_ids=most)
    found = token_files.read_token_files(spark, f"{tmp_path}/ids")
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark).withColumns({n: F.lit(1) for n in ("key", "segment", "part", "at")})
    token_files.write_token_files(docs, PATH, f"{tmp_path}/ids")
    found = sorted(map(tuple, token_files.read_token_files(spark, f"{tmp_path}/ids").collect()), key=lambda r: r[1])
    plain = expected([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((r[0] or -1, *r[2:]) for r in found) == sorted((r[0] or -1, *r[2:]) for r in plain)
    assert [r[0] for r in found] == [r[0] for r in plain]
    assert [r[1] for r in found] == [sum(x[2] for x in found[:i]) for i in range(len(found))]


def test_text_keys_and_empty_table(spark, tmp_path):
    docs = documents(spark, ["b c", "a"]).withColumn("doc_id", F.concat(F.lit("k"), F.col("doc_id").cast("string")))
    token_files.write_token_files(docs, PATH, f"{tmp_path}/ids")
    assert {r.doc_id for r in token_files.read_token_files(spark, f"{tmp_path}/ids", "string").collect()} == {"k0", "k1"}
    token_files.write_token_files(empty(spark), PATH, f"{tmp_path}/none")
    assert token_files.read_token_files(spark, f"{tmp_path}/none").collect() == []
