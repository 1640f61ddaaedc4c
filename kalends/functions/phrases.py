"""Rule tables of phrases, all found in one scan of a text.

A text is cut into words and what stands between them once; phrases are walked in a trie over word positions, from the
places of their first words only, for all texts of a batch at a time. What comes back is one number per text
with a bit for each rule. A rule's alternative may name what must not follow it (rules.NOT_BEFORE); that concerns
this alternative alone, so another one can still be found at the same place.

Alternatives are written as in rules.py: letters, digits and marks, optional characters and groups, character sets,
white space (one, any, some), the rest of a word and any one character. Each is spelt out as the phrases that it
stands for. A word is a run of letters, digits and underscores of any script, so a word boundary is where one starts or ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE, SPACES, ANY, REST, WORD = r"\s", r"\s+", ".", r"\w*", r"\w+"
BATCH_CHARACTERS = 4 << 20
KEPT_WORDS, KEPT_LENGTH = 200_000, 40  # words whose meaning a worker remembers, and the longest of them


def spellings(source: str) -> list[tuple[str, ...]]:
    """What an alternative stands for, as sequences of single characters and the marks above."""
    found, end = _choice(source, 0)
    if end != len(source):
        raise ValueError(f"not a phrase: {source}")
    return list(dict.fromkeys(found))


def _choice(source: str, at: int) -> tuple[list[tuple[str, ...]], int]:
    every: list[tuple[str, ...]] = []
    some: list[tuple[str, ...]] = [()]
    while at < len(source) and source[at] != ")":
        if source[at] == "|":
            every, some, at = every + some, [()], at + 1
            continue
        item, at = _item(source, at)
        mark = source[at : at + 1]
        if mark == "?":
            item, at = [(), *item], at + 1
        elif mark in ("*", "+") and item in ([(SPACE,)], [("\\w",)]):
            kind = SPACES if item == [(SPACE,)] else REST if mark == "*" else WORD
            item, at = ([(), (kind,)] if kind == SPACES and mark == "*" else [(kind,)]), at + 1
        elif mark in ("*", "+", "{"):
            raise ValueError(f"not a phrase: {source}")
        some = [a + b for a in some for b in item]
    return every + some, at


def _item(source: str, at: int) -> tuple[list[tuple[str, ...]], int]:
    if source.startswith("(?:", at):
        inner, end = _choice(source, at + 3)
        return inner, end + 1
    if source[at] == "[":
        end = source.index("]", at + 1)
        body, out, k = source[at + 1 : end], [], 0
        while k < len(body):
            if body.startswith("\\s", k):
                out, k = [*out, (SPACE,)], k + 2
            elif body[k + 1 : k + 2] == "-" and k + 2 < len(body):
                out, k = [*out, *((chr(c),) for c in range(ord(body[k]), ord(body[k + 2]) + 1))], k + 3
            else:
                out, k = [*out, (body[k],)], k + 1
        return out, end + 1
    if source[at] == "\\":
        kind = source[at + 1]
        if kind not in "sw":
            raise ValueError(f"not a phrase: {source}")
        return [(SPACE,) if kind == "s" else ("\\w",)], at + 2
    if source[at] in "({^$*+?":
        raise ValueError(f"not a phrase: {source}")
    return [(source[at],)], at + 1


def _words(atoms: tuple[str, ...]) -> Iterator[tuple[tuple[str, ...], tuple[str, ...]]]:
    """(words, what lies between them) as patterns, for either reading of each "any character"."""
    if ANY in atoms:
        k = atoms.index(ANY)
        for reading in ("\\w", "[^\\w\\n]"):
            yield from _words((*atoms[:k], reading, *atoms[k + 1 :]))
        return
    words, between, last = [""], [], True
    for atom in atoms:
        inside = atom in ("\\w", REST, WORD) or (len(atom) == 1 and (atom.isalnum() or atom == "_"))
        text = re.escape(atom) if len(atom) == 1 else atom
        if inside and not last:
            words.append("")
        if inside:
            words[-1] += text
        elif last:
            between.append(text)
        else:
            between[-1] += text
        last = inside
    if not last:  # a boundary after white space: some word goes on
        words.append(WORD)
    if not words[0]:
        raise ValueError(f"a phrase starts with a word: {atoms}")
    yield tuple(words), tuple(between)


class Node:
    def __init__(self) -> None:
        self.next: dict[tuple[str, str], Node] = {}
        self.ends: list[tuple[int, re.Pattern | None]] = []


class Scanner:
    """A trie of all rules' phrases; each rule is a list of alternatives, some with what must not follow."""

    def __init__(self, rules: tuple[tuple[tuple[str, str | None], ...], ...]) -> None:
        self.root: dict[str, Node] = {}
        for rule, alternatives in enumerate(rules):
            for source, unless in alternatives:
                for atoms in spellings(source):
                    for words, between in _words(atoms):
                        node = self.root.setdefault(words[0], Node())
                        for gap, word in zip(between, words[1:], strict=True):
                            node = node.next.setdefault((gap, word), Node())
                        end = (rule, re.compile(unless) if unless else None)
                        if end not in node.ends:
                            node.ends.append(end)
        self.patterns = sorted({w for w in self._all() if "\\w" in w})
        self.forms = {w: re.compile(w) for w in self.patterns}
        self.plain = {w.replace("\\", "") for w in self._all() if "\\w" not in w}
        self.gaps: dict[tuple[str, str], bool] = {}
        self.known: dict[str, tuple[str, ...]] = {}

    def _all(self) -> set[str]:
        found, todo = set(self.root), list(self.root.values())
        while todo:
            node = todo.pop()
            found |= {w for _, w in node.next}
            todo += node.next.values()
        return found

    def meanings(self, word: str) -> tuple[str, ...]:
        """The trie's words that a text's word is."""
        got = self.known.get(word)
        if got is None:
            got = tuple(([re.escape(word)] if word in self.plain else []) + [p for p in self.patterns if self.forms[p].fullmatch(word)])
            if len(word) <= KEPT_LENGTH and len(self.known) < KEPT_WORDS:
                self.known[word] = got
        return got

    def gap(self, pattern: str, text: str) -> bool:
        key = (pattern, text)
        if key not in self.gaps:
            if len(self.gaps) > KEPT_WORDS or len(text) > KEPT_LENGTH:
                return re.fullmatch(pattern, text) is not None
            self.gaps[key] = re.fullmatch(pattern, text) is not None
        return self.gaps[key]

    def scan(self, texts: list[str]) -> np.ndarray:
        """A bit for each rule found in each text."""
        out = np.zeros(len(texts), np.int64)
        parts = re.split(r"(\W+)", "\0" + "\0".join(t.replace("\0", "\1") for t in texts) + "\0")
        words, between = parts[2::2], parts[1::2]  # between[k] stands before words[k]
        names: dict[str, int] = {}
        word = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
        gaps: dict[str, int] = {}
        gap = np.fromiter((gaps.setdefault(g, len(gaps)) for g in between), np.int64, len(between))
        cuts = np.array([g.count("\0") for g in gaps], np.int64)
        of = np.cumsum(cuts[gap]) - 1  # the text of each word
        by_meaning: dict[str, list[int]] = {}
        for w, k in names.items():
            for m in self.meanings(w) if w else ():
                by_meaning.setdefault(m, []).append(k)
        order = np.argsort(word, kind="stable")
        first = np.searchsorted(word[order], np.arange(len(names) + 1))
        is_word: dict[str, np.ndarray] = {}
        is_gap: dict[str, np.ndarray] = {}

        def word_is(meaning: str) -> np.ndarray:
            if meaning not in is_word:
                is_word[meaning] = np.zeros(len(names) + 1, bool)
                is_word[meaning][by_meaning.get(meaning, [])] = True
            return is_word[meaning]

        def gap_is(pattern: str) -> np.ndarray:
            if pattern not in is_gap:
                is_gap[pattern] = np.array([self.gap(pattern, g) for g in gaps], bool)
            return is_gap[pattern]

        def after(k: int) -> str:
            """What follows word k, far enough for any exception."""
            rest = []
            for j in range(k + 1, min(len(words), k + 7)):
                rest += [between[j], words[j]]
            return "".join(rest).split("\0")[0]

        def walk(node: Node, start: np.ndarray, at: np.ndarray) -> None:
            for rule, unless in node.ends:
                hit = at if unless is None else at[[unless.match(after(k)) is None for k in at.tolist()]] if len(at) else at
                np.bitwise_or.at(out, of[hit], np.int64(1) << rule)
            for (pattern, meaning), child in node.next.items():
                if meaning not in by_meaning:
                    continue
                go = at[at + 1 < len(words)]
                go = go[gap_is(pattern)[gap[go + 1]]]
                go = go[word_is(meaning)[word[go + 1]]] + 1 if len(go) else go
                if len(go):
                    walk(child, start, go)

        for meaning, node in self.root.items():
            ids = by_meaning.get(meaning)
            if ids:
                places = np.concatenate([order[first[i] : first[i + 1]] for i in ids])
                walk(node, places, places)
        return out


@lru_cache(maxsize=16)
def scanner(rules: tuple) -> Scanner:
    return Scanner(rules)


def found_rules(low: Column, tables: list[list[str]], unless: dict[str, str] | None = None) -> Column:
    """A long with bit k set where the lower-case text holds a phrase of table k; 0 for null. At most 63 tables.

    unless names alternatives and, as a pattern, what must not follow them.
    """
    if len(tables) > 63:
        raise ValueError("a long has 63 bits")
    rules = tuple(tuple((a, (unless or {}).get(a)) for a in table) for table in tables)

    def scan(texts: pa.Array) -> pa.Array:
        one, given, out, at = scanner(rules), [t or "" for t in texts.to_pylist()], [], 0
        while at < len(given):
            end, size = at, 0
            while end < len(given) and (end == at or size + len(given[end]) <= BATCH_CHARACTERS):
                size += len(given[end])
                end += 1
            out.append(one.scan(given[at:end]))
            at = end
        return pa.array(np.concatenate(out) if out else np.zeros(0, np.int64), pa.int64())

    return F.arrow_udf(scan, "long")(low)


def bit(found: Column, k: int) -> Column:
    return found.bitwiseAND(F.lit(1 << k).cast("long")) != 0
