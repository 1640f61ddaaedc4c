"""Substring lookup of any number of keywords in one pass over a text.

The keywords make an automaton (Aho and Corasick) over bytes, kept as flat arrays: a state for each prefix, a table of transitions
by byte class, and for each state the first keyword in table order that ends there. All texts of a batch step
together, one byte at a time; long texts are stepped as pieces that overlap by a keyword's length. Nothing is
exploded or shuffled, and the work for a text does not depend on the number of keywords.

Tables of more than MOST_CELLS transitions are split into several automata, stepped one after the other.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MOST_CELLS = 1 << 24  # of a table, four bytes each
PIECE = 1024


class Automaton:
    def __init__(self, keywords: list[bytes], ranks: list[int]) -> None:
        used = sorted({b for k in keywords for b in k})
        self.classes = np.zeros(256, np.int32)
        self.classes[used] = np.arange(1, len(used) + 1)
        self.width, self.longest = len(used) + 1, max(map(len, keywords))
        code = {b: i + 1 for i, b in enumerate(used)}
        edges: list[dict[int, int]] = [{}]
        none = np.iinfo(np.int32).max
        first = [none]
        for key, rank in zip(keywords, ranks):
            at = 0
            for b in key:
                c = code[b]
                if c not in edges[at]:
                    edges[at][c] = len(edges)
                    edges.append({})
                    first.append(none)
                at = edges[at][c]
            first[at] = min(first[at], rank)
        self.first = np.array(first, np.int32)
        self.next = np.zeros((len(edges), self.width), np.int32)
        fall, level = [0] * len(edges), list(edges[0].values())
        self.next[0, list(edges[0])] = level
        while level:  # breadth first: a state's fallback is nearer to the root and complete
            below = []
            for s in level:
                self.next[s] = self.next[fall[s]]
                self.first[s] = min(self.first[s], self.first[fall[s]])
                for c, t in edges[s].items():
                    fall[t] = int(self.next[s, c])
                    self.next[s, c] = t
                    below.append(t)
            level = below

    def find(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """For each text the least rank of a keyword in it, or the largest int without one."""
        out = np.full(len(start), np.iinfo(np.int32).max, np.int32)
        pieces = np.maximum(1, -(-length // PIECE))
        row = np.repeat(np.arange(len(start)), pieces)
        shift = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * PIECE
        at, size = start[row] + shift, np.minimum(length[row] - shift, PIECE + self.longest - 1)
        order = np.argsort(-size, kind="stable")
        at, size, row = at[order], size[order], row[order]
        state, best = np.zeros(len(at), np.int64), np.full(len(at), np.iinfo(np.int32).max, np.int32)
        flat = self.next.ravel()
        alive = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1 if len(size) else 0), side="right")  # how many reach each byte
        for p, k in enumerate(alive):
            now = flat[state[:k] * self.width + self.classes[data[at[:k] + p]]]
            state[:k] = now
            np.minimum(best[:k], self.first[now], out=best[:k])
        np.minimum.at(out, row, best)
        return out


@lru_cache(maxsize=4)
def automata(keywords: tuple[str, ...]) -> list[Automaton]:
    """Of the keywords that are not empty; ranks are their places."""
    groups, cells, some = [], 0, []
    for rank, key in enumerate(keywords):
        raw = key.encode()
        if raw:
            some.append((raw, rank))
            cells += len(raw) * 64
            if cells > MOST_CELLS:
                groups.append(some)
                cells, some = 0, []
    return [Automaton(*map(list, zip(*g))) for g in [*groups, some] if g]


def first_places(texts: pa.Array, keywords: tuple[str, ...]) -> pa.Array:
    """For each text the place of the first keyword, in their order, that it holds; null without one."""
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    valid = np.ones(len(raw), bool) if not raw.null_count else raw.is_valid().to_numpy(zero_copy_only=False)
    length = np.where(valid, np.diff(offsets), 0)
    found = np.full(len(raw), np.iinfo(np.int32).max, np.int32)
    for a in automata(keywords):
        np.minimum(found, a.find(data, offsets[:-1], length), out=found)
    return pa.array(found, mask=found == np.iinfo(np.int32).max)


def first_keyword(text: Column, keywords: list[str]) -> Column:
    """The place (from 0) of the first keyword, in their order, that the text holds; letters compare as given. Null without one; empty keywords are never found."""
    keys = tuple(keywords)

    def find(texts: pa.Array) -> pa.Array:
        return first_places(texts, keys)

    return F.arrow_udf(find, "int")(text)
