"""Splitting texts for a BPE vocabulary file into pieces that can be counted or encoded once.

Text between two runs of ASCII white space (a chunk) is tokenized independently of
its neighbours: no normaliser rule, no pre-token and no special token spans a
space. Inside a chunk of plain letters, digits and signs the file's own pattern
splits pre-tokens; a chunk with any other character, or with a special token's
string, stays one unit and the library sees it as it stands. So for every unit
the library's own encoding of that unit alone is its part of the text's ids.
"""

from __future__ import annotations

import os
import re
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Characters whose composition and lower case leave no room for doubt:
# ASCII and the precomposed letters of Latin-1.
_PLAIN = re.compile(rb"(?:[\x00-\x7f]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*")
_LETTERS, _DIGITS = "a-zß-öø-ÿ", "0-9"
# The file's pre-token pattern for those characters.
_PRETOKEN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}]+"
)


def worker_store() -> dict:
    """Things a Python worker keeps between the tasks it runs."""
    name = "_basketlens_worker"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return sys.modules[name].__dict__
# Texts that are not split by the column.
_HARD_RE2 = r"[^\x00-\x7FÀ-ÖØ-öø-ÿ]|'(?i:s|t|re|ve|m|ll|d)"
# Kind of each byte of a lower-cased plain text: space, letter, digit or other sign.
_LETTER, _DIGIT, _SIGN = 1, 2, 3
_LOWER_BYTE = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_KIND = np.array([
    0 if b == 32 or 9 <= b <= 13 else _LETTER if 97 <= b <= 122 or b >= 128
    else _DIGIT if 48 <= b <= 57 else _SIGN
    for b in range(256)
], np.uint8)
# Byte-level vocabularies write a printable byte as itself and the others as the
# characters from U+0100 on, in byte order.
_UNPRINTABLE = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_BYTE_CHARACTERS = {b: chr(256 + k) for k, b in enumerate(_UNPRINTABLE)}


class Units:
    """A vocabulary file opened for splitting and encoding units."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.code = "H" if self.library.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        added = self.library.get_added_tokens_decoder().values()
        self.specials = [token.content for token in added]
        specials = [re.escape(token.content.encode()) for token in added]
        self._special = re.compile(b"|".join(specials) or b"(?!)")

    @classmethod
    def opened(cls, path: str) -> Units:
        store = worker_store()
        if ("units", path) not in store:
            store["units", path] = cls(path)
        return store["units", path]

    def split(self, chunk: bytes) -> list[str] | None:
        """The pre-tokens of a chunk, or None for one that stays a single unit."""
        if chunk.isalpha():  # ASCII letters only
            return [chunk.decode().lower()]
        if not (chunk.isascii() or _PLAIN.fullmatch(chunk)):
            return None
        if b"<" in chunk and self._special.search(chunk):
            return None
        return _PRETOKEN.findall(chunk.decode().lower())

    def encode_pretokens(self, pretokens: list[str]) -> list[bytes]:
        """Ids of each pre-token from the library's model, as bytes of an array of ``dtype``."""
        tokenize, code = self.library.model.tokenize, self.code
        return [
            array(code, [t.id for t in tokenize(p if p.isascii() and p.isprintable() else self._mapped(p))]).tobytes()
            for p in pretokens
        ]

    def _mapped(self, pretoken: str) -> str:
        """The characters that stand for the pre-token's bytes in the vocabulary."""
        return pretoken.encode().decode("latin-1").translate(_BYTE_CHARACTERS)

    def encode_column(self, texts: pa.Array, pretokens: dict[str, bytes]) -> list[bytes]:
        """Ids of each text of a string column without nulls; ``pretokens`` is filled on the way."""
        easy = plain(texts, self.specials)
        codes, starts, names = split_column(texts if easy.all() else texts.filter(pa.array(easy)))
        names = names.to_pylist()
        known = list(map(pretokens.get, names))
        new = [i for i, ids in enumerate(known) if ids is None]
        for i, ids in zip(new, self.encode_pretokens([names[i] for i in new])):
            known[i] = pretokens[names[i]] = ids
        # The ids of all codes in a row, and where each text's begin and end in it.
        parts = pa.array(known, pa.binary())
        _, offsets, values = parts.take(codes).buffers()
        cuts = np.frombuffer(offsets, np.int32)[starts].tolist()
        ids = memoryview(values or b"")
        done = iter([bytes(ids[a:b]) for a, b in zip(cuts, cuts[1:])])
        hard = zip(easy, texts) if not easy.all() else ((True, None) for _ in easy)
        return [next(done) if quick else self._by_chunk(text.as_py()) for quick, text in hard]

    def column_units(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, pa.Array]]:
        """The units of a string column without nulls, in one or two groups of its rows.

        A group is: row numbers, codes of all their units, where each row's
        codes begin (and where the last row's end), and the unit of each code.
        """
        easy = plain(texts, self.specials)
        if easy.any():
            rows = np.flatnonzero(easy)
            yield rows, *split_column(texts if easy.all() else texts.take(pa.array(rows)))
        if not easy.all():
            rows = np.flatnonzero(~easy)
            units = [self._units(texts[int(i)].as_py()) for i in rows]
            found = pa.array([u for own in units for u in own], pa.string()).dictionary_encode()
            starts = np.cumsum([0, *map(len, units)])
            yield rows, found.indices, starts, found.dictionary

    def _units(self, text: str) -> list[str]:
        out: list[str] = []
        for chunk in chunks_of(text.encode()):
            out += self.split(chunk) or [chunk.decode()]
        return out

    def _by_chunk(self, text: str) -> bytes:
        chunks = chunks_of(text.encode())
        known = self.encode_chunks(list(set(chunks)), {})
        return b"".join(map(known.__getitem__, chunks))

    def encode_whole(self, text: bytes) -> bytes:
        """Ids of any text, straight from the library."""
        ids = self.library.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def encode_chunks(self, chunks: list[bytes], pretokens: dict[str, bytes]) -> dict[bytes, bytes]:
        """Ids of each of some distinct chunks; ``pretokens`` is filled on the way."""
        splits = list(map(self.split, chunks))
        new = {p for units in splits if units for p in units if p not in pretokens}
        fresh = list(new)
        pretokens.update(zip(fresh, self.encode_pretokens(fresh)))
        known = pretokens.__getitem__
        return {
            c: b"".join(map(known, units)) if units is not None else self.encode_whole(c)
            for c, units in zip(chunks, splits)
        }


def split_column(texts: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """Pre-tokens of a column of plain texts: codes, where each text's codes begin, names.

    Works on the bytes of all texts at once: a pre-token begins where the class
    of character changes, and at every digit. Texts with a contraction must not
    be given.
    """
    _, offsets, values = texts.buffers()
    cuts = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(values or b"", np.uint8)[cuts[0] : cuts[-1]]
    cuts = cuts - cuts[0]
    low = _LOWER_BYTE[raw]
    capital = np.flatnonzero(raw[:-1] == 0xC3) + 1  # second bytes of letters beyond ASCII
    low[capital] += np.where(raw[capital] < 0x9F, 0x20, 0).astype(np.uint8)
    kind = _KIND[low]
    begins = kind == _DIGIT
    begins[1:] |= kind[1:] != kind[:-1]
    begins[cuts[:-1][cuts[:-1] < len(raw)]] = True
    inside = kind != 0
    begins &= inside
    # Without the spaces, each pre-token ends where the next begins.
    packed, first = low[inside], np.flatnonzero(begins[inside])
    places = np.append(first, len(packed)).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(first), pa.py_buffer(places), pa.py_buffer(packed))
    found = pc.dictionary_encode(pieces)
    starts = np.searchsorted(np.flatnonzero(begins), cuts)
    return found.indices, starts, found.dictionary


def plain(texts: pa.Array, specials: list[str]) -> np.ndarray:
    """Which texts have plain characters, no contraction and no special token's string."""
    odd = pc.match_substring_regex(texts, _HARD_RE2)
    for special in specials:
        odd = pc.or_(odd, pc.match_substring(texts, special))
    return ~odd.to_numpy(zero_copy_only=False).astype(bool)


def slices(texts: pa.Array, rows: int, size: int):
    """(first, count) of runs of texts with at most ``rows`` rows, and ``size`` bytes or one text."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    first = held = 0
    for i, n in enumerate(lengths):
        if i > first and (held + n > size or i - first == rows):
            yield first, i - first
            first, held = i, 0
        held += n
    if lengths:
        yield first, len(lengths) - first


def chunks_of(text: bytes | None) -> list[bytes]:
    """A text's chunks; bytes.split() cuts at ASCII white space only."""
    return text.split() if text else []


def bounded(cache: dict, entries: int) -> dict:
    """Empty a cache that has grown past its bound."""
    if len(cache) > entries:
        cache.clear()
    return cache
