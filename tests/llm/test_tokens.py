"""Token counts and packing against the tokenizer itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quayside.llm import packing, token_counts
from quayside.llm.bpe import PieceEncoder
from tests.llm.cases import awkward, documents, empty, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = ["a <|endoftext|> b", "x<|endoftext|>y", " lead", "trail ", "a  b", "a \n b", "it's we'll 12 ½ ²", "\x1c\x85\r\n", "_a_ __", "", "don't  stop", "a\n ", "a \n", "a   b \t c", "x\n\n y\n \nz", "Üß, straße. naïve!? 漢字。 ok...", "a word, a word. a word"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_library_ids(library):
    tool = PieceEncoder(PATH, limit=50)  # so small that the cache starts anew again and again
    for text in [*AWKWARD, prose(5, 400), prose(6, 400)]:
        assert np.frombuffer(tool.ids(text), "<u4").tolist() == ids(library, text)


def test_random_white_space(library):
    tool, draw = PieceEncoder(PATH), random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "word", "'s", "<|endoftext|>", ".", "1", "é", "\x1c", "\x85", "\xa0", "\r\n", "😀", "_", "²"]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randint(0, 14)))
        assert np.frombuffer(tool.ids(text), "<u4").tolist() == ids(library, text), repr(text)


def test_counts(spark, library):
    docs = documents(spark, AWKWARD).unionByName(awkward(spark, clash=False))
    rows = token_counts.with_token_counts(docs.withColumn("piece", docs.doc_id), PATH).collect()
    assert len(rows) == docs.count()
    assert [r.n_tokens for r in rows] == [len(ids(library, r.text)) for r in rows]


def test_counts_do_not_depend_on_the_frequent_table(library):
    tool = PieceEncoder(PATH)
    text = "the cat and the dog, don't"
    pieces = tool.pieces(text)[1]
    tool.learn(set(pieces))
    table = {p: len(tool.known[p]) // 4 for p in pieces[:3]}
    assert token_counts.count_tokens(tool, table, text) == token_counts.count_tokens(tool, {}, text) == len(ids(library, text))


def test_empty_tables(spark):
    assert token_counts.with_token_counts(empty(spark), PATH).collect() == []
    assert packing.pack_documents(empty(spark), PATH).collect() == []


@pytest.mark.parametrize("size", [16, 1024])
def test_packing_is_a_round_trip(spark, library, size):
    docs = documents(spark, [*AWKWARD, *[prose(i, 30 * i) for i in range(20)], None]).repartition(3, "doc_id")
    rows = packing.pack_documents(docs, PATH, size).collect()
    whole = {r.doc_id: [*ids(library, r.text), 0] for r in docs.collect()}
    windows, parts = defaultdict(list), defaultdict(list)
    for r in rows:
        part = whole[r.doc_id][r.start : r.start + r.length]
        assert r.length == len(part) > 0 and r.doc_tokens == len(whole[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        windows[r.sequence_id].append((r.offset, r.length))
        parts[r.doc_id].append((r.start, r.length))
    for doc, pieces in parts.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == len(whole[doc])
    assert set(parts) == set(whole)
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == size or (at < size and at & (at - 1) == 0), "no padding"


def test_packing_keeps_awkward_rows(spark):
    docs = awkward(spark)
    rows = packing.pack_documents(docs, PATH).collect()
    assert sum(r.start == 0 for r in rows) == docs.count()
    assert {r.doc_tokens for r in rows if r.doc_id == 0} == {1}


def test_level_minimises_squares():
    packer = packing.SumOfSquares(8)
    packer.levels[:] = [0, 3, 1, 0, 0, 2, 0, 0, 0]
    for length in range(1, 8):
        def squares(level):
            after = packer.levels.copy()
            if level:
                after[level] -= 1
            if level + length < 8:
                after[level + length] += 1
            return int((after[1:8] ** 2).sum())

        allowed = [h for h in range(0, 9 - length) if h == 0 or packer.levels[h]]
        best = min(map(squares, allowed))
        assert packer.level_for(length) == max(h for h in allowed if squares(h) == best)
