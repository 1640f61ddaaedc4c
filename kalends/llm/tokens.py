"""Tokenizer helpers shared by the operators that need token ids.

Texts repeat their words, so ids are kept per chunk (a word with its leading space, or a line
break) in a bounded per-worker dictionary and the library only sees chunks that are new. Chunks
are cut only where no pre-tokenizer match can span the cut, so the joined ids are the library's.
"""

from __future__ import annotations

import re
import sys
from array import array

import numpy as np

#: White space besides the plain blank and line feed, and marks that engines class differently.
ODD = "\x00\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2028\u2029\u202f\u205f\u2060\u3000\ufeff" + "".join(map(chr, range(0x2000, 0x2010)))
#: A blank between two plain characters: the byte-level pre-tokenizer always starts a match here.
SAFE_CUT = re.compile(r"(?<=[!-~\u00c0-\u024f])(?= [!-~\u00c0-\u024f])")
TOUCHING = ("  ", "\n\n", " \n", "\n ")
#: A word of plain Latin letters, perhaps after a blank and before a run of marks: one pre-token, or two.
PLAIN = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")
LIMIT = 500_000
LONG_CHUNK = 200

_encoders: dict = {}


class ChunkEncoder(dict):
    """text -> little-endian ids as bytes, equal to the library's encode(text, add_special_tokens=False).

    Chunks are kept in two generations: when the younger is full it becomes the older, whose chunks are
    taken over when they are met again, so frequent chunks stay and the others go.
    """

    def __init__(self, path: str, dtype: str = "<u4", words_only: bool = False) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype, self.words_only = np.dtype(dtype), words_only
        self.code = {4: "I", 2: "H"}[self.dtype.itemsize] if self.dtype.newbyteorder("=") == np.dtype(f"=u{self.dtype.itemsize}") and sys.byteorder == "little" else ""
        self.older: dict[str, bytes] = {}
        self.letters = byte_alphabet()
        self.tokenize = self.tokenizer.model.tokenize

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.pop(chunk, None) if self.older else None
        if ids is None:
            ids = self._learn(chunk)
        if len(chunk) <= LONG_CHUNK:
            if len(self) >= LIMIT:
                self.older = self.copy()
                self.clear()
            self[chunk] = ids
        return ids

    def _learn(self, chunk: str) -> bytes:
        m = PLAIN.fullmatch(chunk)
        if m is None:
            return self._packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        word, mark = m.groups()
        base = word.lower() if self.words_only else word
        if base == chunk:
            return self._merged(base)
        return self[base] + self[mark] if mark else self[base]

    def _merged(self, pre_token: str) -> bytes:
        """The library's merges for one pre-token, without its splitting."""
        if pre_token.isascii():  # plain letters and marks stand for themselves
            raw = pre_token.replace(" ", self.letters[32])
        else:
            raw = "".join(map(self.letters.__getitem__, pre_token.encode()))
        return self._packed([t.id for t in self.tokenize(raw)])

    def _packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes() if self.code else np.array(ids, self.dtype).tobytes()

    def chunks(self, text: str) -> list[str]:
        if self.words_only:  # white space is dropped by the tokenizer, so any blank is a cut
            return text.replace("\n", " ").split(" ")
        if any(x in text for x in TOUCHING) or any(c in text for c in ODD):
            return SAFE_CUT.split(text)
        return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.chunks(text)))

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode(text), self.dtype)


def encoder(path: str, dtype: str = "<u4", words_only: bool = False) -> ChunkEncoder:
    """One per worker process: its dictionary serves all tasks that run there."""
    key = (path, dtype, words_only)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(path, dtype, words_only)
    return _encoders[key]


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
