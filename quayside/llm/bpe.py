"""Byte-level BPE over space-led pieces, with a bounded cache in each worker.

Where a space is followed by a non-space, the tokenizer always starts a new pre-token, whatever stands before. Cutting there
therefore gives pieces that can be encoded one by one, and each distinct piece is encoded once for each worker. The ids
are those of the library.
"""

from __future__ import annotations

import functools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Pieces that a worker remembers; about 250 MB.
CACHE_PIECES = 1_200_000

#: Spaces that start no piece: those before white space, and a last one behind white space.
_RUN = re.compile(r" \s|\s \Z")
_CUT = re.compile(r" (?=\S)")
#: The same for whole columns, with all that Python calls white space: a space before white space.
_RUN_IN_COLUMN = r" [\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Bytes of texts that a column is taken apart in at once.
COLUMN_BYTES = 6 << 20
#: Marks that may follow a word in a piece, as one pre-token; none of them begins a special token or a contraction.
_MARKS = ".,;:!?\"#$%&()*+-/=>@[\\]^_`{|}~"
#: Letters below it are letters in every version of Unicode.
_LATIN_END = "\u0250"


class PieceEncoder:
    """Ids of whole texts by the tokenizer at ``path``, without added special tokens."""

    def __init__(self, path: str, limit: int = CACHE_PIECES):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.limit = limit
        #: Ids of pieces, given without the space in front.
        self.known: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        #: Ids of words without a space in front, for those that follow a line break.
        self.bare: dict[str, bytes] = {}
        #: Pieces may be cut at spaces only if this is the byte-level scheme that keeps spaces in front.
        scheme = self.tokenizer.pre_tokenizer
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.cuts = (
            self.tokenizer.normalizer is None
            and "ByteLevel" in str(scheme)
            and "add_prefix_space=False" in str(scheme)
            and not any(" " in t.content or t.lstrip or t.rstrip or t.single_word for t in added)
        )

        if self.cuts:
            #: The character that stands for each byte inside the model, learned from the tokenizer itself.
            points = [*range(0x800), *range(0x800, 0x10FFFF, 0x1000)]
            chars = [chr(x) for x in points if not 0xD800 <= x < 0xE000]
            shown = ("".join(p for p, _ in scheme.pre_tokenize_str(c)) for c in chars)
            self.shown = {b: s for c, mapped in zip(chars, shown) for b, s in zip(c.encode(), mapped, strict=True)}
            self.model = self.tokenizer.model

    def _encode_word(self, word: str, space: str = " ") -> bytes:
        """Ids of a space and letters, which are one pre-token, straight from the model."""
        found = self.model.tokenize((space + word).encode().decode("latin-1").translate(self.shown))
        return struct.pack(f"<{len(found)}I", *[t.id for t in found])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, by the library, as little-endian unsigned 32-bit numbers."""
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(x.ids)}I", *x.ids) for x in found]

    def pieces(self, text: str) -> tuple[str, list[str]]:
        """The part before the first cut, and the pieces behind cuts without their space."""
        if not self.cuts:
            return text, []
        first, *rest = _CUT.split(text) if _RUN.search(text) else text.split(" ")
        return first, rest

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces not yet known; where the cache is full it starts anew.

        Letters, and letters with marks behind them, are cut once more, as the tokenizer does: a mark starts a pre-token.
        """
        known = self.known
        new = [x for x in pieces if x not in known]
        if len(known) + 2 * len(new) > self.limit:
            known.clear()
            self.marks.clear()
            new = list(pieces)
        other = []
        for piece in new:
            ids = self._parted(piece)
            if ids is None:
                other.append(piece)
            else:
                known[piece] = ids
        known.update(zip(other, self.encode([" " + x for x in other]), strict=True))

    def look_up(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces; only words and what cannot be parted are remembered, so that the cache holds more of them."""
        found = list(map(self.known.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if len(self.known) + len(missing) > self.limit:
            self.known.clear()
        other = []
        for i in missing:
            ids = self._parted(pieces[i])
            if ids is None:
                other.append(i)
            else:
                found[i] = ids
        for i, ids in zip(other, self.encode([" " + pieces[i] for i in other]), strict=True):
            found[i] = self.known[pieces[i]] = ids
        return found

    def _parted(self, piece: str) -> bytes | None:
        """Ids of a word with marks, or of two such with a line break between, which is a pre-token of its own; None for all else."""
        if "\n" not in piece:
            return self._marked(piece, True)
        above, _, below = piece.partition("\n")
        ids = self._marked(above, True)
        rest = None if ids is None else self._marked(below, False)
        if rest is None:
            return None
        if "\n" not in self.marks:
            self.marks["\n"] = self.encode(["\n"])[0]
        return ids + self.marks["\n"] + rest

    def _marked(self, piece: str, space: bool) -> bytes | None:
        """Ids of letters with marks behind them, after a space or not; None for all else."""
        word = piece.rstrip(_MARKS)
        if not (word.isalpha() and (word.isascii() or max(word) < _LATIN_END)):
            return None
        store = self.known if space else self.bare
        ids = store.get(word)
        if ids is None:
            if len(self.bare) > self.limit // 8:
                self.bare.clear()
            ids = store[word] = self._encode_word(word, " " if space else "")
        marks = piece[len(word) :]
        if not marks:
            return ids
        if marks not in self.marks:
            self.marks[marks] = self.encode([marks])[0]
        return ids + self.marks[marks]

    def ids(self, text: str) -> bytes:
        first, rest = self.pieces(text)
        try:
            body = b"".join(map(self.known.__getitem__, rest))
        except KeyError:
            self.learn(set(rest))
            body = b"".join(map(self.known.__getitem__, rest))
        return self.encode([first])[0] + body


    def column_ids(self, texts: pa.Array, end: bytes = b"") -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(ids, number of ids of each text)`` of a column of texts without nulls, in slices; ``end`` closes each text.

        The column is cut into pieces and these are numbered as a whole, so that only the different pieces of a slice are looked up.
        Texts that are not cut at every space are encoded one by one.
        """
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < len(texts):
            begin = sizes[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, begin + COLUMN_BYTES, side="right")))
            yield self._slice_ids(texts.slice(first, last - first), end)
            first = last

    def _slice_ids(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        if self.cuts:
            odd = pc.or_(pc.match_substring_regex(texts, _RUN_IN_COLUMN), pc.ends_with(texts, " ")).to_numpy(zero_copy_only=False)
        else:
            odd = np.ones(len(texts), dtype=bool)
        whole = {i: self.ids(texts[i].as_py()) for i in np.flatnonzero(odd).tolist()}
        parts = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        offsets = parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py()
        coded = pc.dictionary_encode(parts.flatten())
        codes = coded.indices.to_numpy().astype(np.int64)
        # What stands before the first cut has no space in front, and is looked up in a list of its own.
        heads, (names, numbers) = offsets[:-1], np.unique(codes[offsets[:-1]], return_inverse=True)
        codes[heads] = -1
        used = np.zeros(len(coded.dictionary), dtype=bool)
        used[codes[codes >= 0]] = True
        pieces = pc.filter(coded.dictionary, pa.array(used)).to_pylist()
        known = self.look_up(pieces)
        rows = np.cumsum(used) - 1
        codes[codes >= 0] = rows[codes[codes >= 0]]
        codes[heads] = len(known) + numbers
        known += self.encode(coded.dictionary.take(pa.array(names)).to_pylist())
        for row, ids in whole.items():
            codes[heads[row]] = len(known)
            known.append(ids)
        codes = np.insert(codes, offsets[1:], len(known))
        known.append(end)
        flat = np.frombuffer(b"".join(known), dtype="<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts = np.cumsum(sizes) - sizes
        counts = sizes[codes]
        ends = np.cumsum(counts)
        places = np.repeat(starts[codes] - (ends - counts), counts)
        places += np.arange(len(places))
        lengths = np.add.reduceat(counts, offsets[:-1] + np.arange(len(texts))) if len(texts) else counts
        return flat[places], lengths


@functools.cache
def encoder(path: str, limit: int = CACHE_PIECES) -> PieceEncoder:
    """One encoder for each worker process."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    return PieceEncoder(path, limit)
