"""Token ids of text columns with a public tokenizer.

White space always ends a pre-token of the word-level vocabulary used here,
so a text's ids are those of its blank-separated chunks, end to end.  Texts
are cut into chunks, and chunks of Latin-1 letters and marks after them into a
word in lower case and its marks (:func:`_pieces`).  Each distinct piece of a
batch is looked up once, and only those that a bounded table doesn't hold reach
the tokenizer."""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import arrays

#: Id that ends each document.
END_ID = 1
#: Chunks that a worker remembers; the table starts anew beyond that.
REMEMBERED = 400_000
#: Text that one call of the encoder gets.
SLICE_BYTES = 6 << 20

# A chunk that normalisation only lower-cases and that splits into one run of
# letters and one run of marks.  Apostrophes are left out (they start
# contractions), as is everything beyond Latin-1.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")

# What a byte is in a chunk.
_BLANK, _LETTER, _MARK, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[0x20, 0x0A]] = _BLANK
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) != "'"]] = _MARK


def _pieces(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all rows end to end, and how many precede each row (n + 1
    counts).  A chunk of other bytes, with letters after marks or with what may
    be a special token is one piece, as it is."""
    data, off = arrays.utf8(column)
    kind = _KIND[data]
    inside = kind != _BLANK
    lower = arrays.lower(data)
    lead = np.flatnonzero(data[:-1] == 0xC3)  # of U+00C0 to U+00FF, all letters but two
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    lower[lead[data[lead + 1] < 0x9F] + 1] += 32
    start, stop, before = arrays.word_spans(data, off, _KIND != _BLANK)
    letter, mark = kind == _LETTER, kind == _MARK
    odd = kind == _OTHER
    odd[1:] |= mark[:-1] & letter[1:]
    odd[1:] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    whole = np.zeros(len(start), bool)
    whole[np.searchsorted(start, np.flatnonzero(odd), "right") - 1] = True
    cut = np.flatnonzero(letter[:-1] & mark[1:]) + 1
    chunk = np.searchsorted(start, cut, "right") - 1
    cut = cut[~whole[chunk] & (start[chunk] != cut)]
    text = np.where(np.repeat(whole, stop - start), data[inside], lower[inside])
    if len(cut):
        start, stop = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([stop, cut]))
        before = np.searchsorted(start, off)
    ahead = np.zeros(len(start) + 1, np.int64)
    np.cumsum(stop - start, out=ahead[1:])
    pieces = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ahead), pa.py_buffer(text))
    return pieces, before


def _strings(pieces: pa.Array) -> list[str]:
    """As to_pylist, for pieces: they have no newline."""
    if not len(pieces):
        return []
    one = pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces.cast(pa.string()))
    return pc.binary_join(one, "\n")[0].as_py().split("\n")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: the
    visible Latin-1 characters stand for themselves, the others follow from
    U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        if self.tok.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits; this vocabulary has more")
        sym = _byte_symbols()
        self._symbols = {i: s for i, s in sym.items()}
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}  # chunk -> its place in ``begin``
        self.flat, self.begin = array("H"), array("i", [0])
        self._add("", ())

    def _add(self, text: str, ids) -> int:
        self.flat.extend(ids)
        self.begin.append(len(self.flat))
        code = self.index[text] = len(self.begin) - 2
        return code

    def _ids(self, code: int) -> array:
        return self.flat[self.begin[code]:self.begin[code + 1]]

    def _piece(self, text: str) -> int:
        code = self.index.get(text)
        if code is None:
            raw = text if text.isascii() else "".join([self._symbols[b] for b in text.encode()])
            code = self._add(text, [t.id for t in self.model.tokenize(raw)])
        return code

    def _chunk(self, text: str) -> int:
        if text.isalpha() and text.isascii() and text.islower():
            return self._add(text, [t.id for t in self.model.tokenize(text)])
        m = _PLAIN.fullmatch(text)
        if m is None or "<|" in text:
            return self._add(text, self.tok.encode(text, add_special_tokens=False).ids)
        word, marks = m.groups()
        word = word.lower()
        if not marks:
            code = self._piece(word)
            if word != text:
                self.index[text] = code
            return code
        if not word:
            return self._piece(marks)
        return self._add(text, self._ids(self._piece(word)) + self._ids(self._piece(marks)))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end (uint16) and n + 1 offsets.  A null or
        empty text has no ids."""
        if len(self.index) > REMEMBERED:
            self._clear()
        pieces, before = _pieces(column)
        words = pieces.dictionary_encode()
        get, chunk = self.index.get, self._chunk
        place = [chunk(w) if c is None else c for w, c in ((w, get(w)) for w in _strings(words.dictionary))]
        code = np.array(place, np.int32)[words.indices.to_numpy(zero_copy_only=False)]
        begin, flat = np.array(self.begin, np.int32), np.array(self.flat, np.uint16)
        n = (begin[1:] - begin[:-1])[code]
        total = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=total[1:])
        at = np.repeat((begin[code] - total[:-1]).astype(np.int32), n)
        at += np.arange(total[-1], dtype=np.int32)
        return flat[at], total[before]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
