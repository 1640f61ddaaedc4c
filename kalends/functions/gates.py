"""Which rules a text may meet: one scan for the words that their alternatives begin with.

A rule of ``rules.pattern`` can match only where a word begins as one of its alternatives does. One pattern, a trie of all
those beginnings, finds them in one pass; the rules that they belong to are bits of a number, and only those rules'
own patterns are tried. A gate never decides that a rule holds, only that it cannot.
"""

from __future__ import annotations

import os
import re
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOTS = 4096


def trie_pattern(words: list[str]) -> str:
    """A pattern of the words, the longest first where one begins another; tried letter by letter, not word by word."""
    heads: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        if w:
            heads.setdefault(w[0], []).append(w)
    if not heads:
        return ""
    shared = [os.path.commonprefix(some) for some in heads.values()]
    some = [re.escape(head) + trie_pattern([w[len(head) :] for w in own]) for head, own in zip(shared, heads.values())]
    return f"(?:{'|'.join(some)})" + ("?" if "" in words else "")


def beginnings(alternative: str) -> list[str]:
    """Letters and digits that every match of an alternative begins with, one of them for each choice of a leading group."""
    if alternative.startswith("(?:"):
        depth, at = 0, 0
        for at, c in enumerate(alternative):
            depth += (c == "(") - (c == ")")
            if not depth:
                break
        inner, choices, depth = alternative[3:at], [""], 0
        for c in inner:
            depth += (c == "(") - (c == ")")
            choices = [*choices, ""] if c == "|" and not depth else [*choices[:-1], choices[-1] + c]
        if alternative[at + 1 : at + 2] in ("?", "*", "{"):
            raise ValueError(f"nothing begins {alternative}")
        return [b for choice in choices for b in beginnings(choice)]
    found = re.match(r"[a-z0-9]+", alternative)
    head = found.group() if found else ""
    if alternative[len(head) : len(head) + 1] in ("?", "*", "{"):
        head = head[:-1]
    if not head or "|" in re.sub(r"\([^()]*\)|\[[^\]]*\]", "", re.sub(r"\([^()]*\)", "", alternative)):
        raise ValueError(f"nothing begins {alternative}")
    return [head]


class Gate:
    """Bits for up to 63 named rules, each a list of alternatives."""

    def __init__(self, rules: dict[str, list[str]]) -> None:
        if len(rules) > 63:
            raise ValueError("a gate has 63 bits")
        self.bit = {name: i for i, name in enumerate(rules)}
        heads = {name: {b for a in some for b in beginnings(a)} for name, some in rules.items()}
        self.pattern = r"\b" + trie_pattern(sorted(set().union(*heads.values())))
        self.slots = [0] * SLOTS
        words = set().union(*heads.values())
        for w in words:  # the longest word is found, and all that begin it are there as well
            for name, own in heads.items():
                if any(w.startswith(h) for h in own):
                    self.slots[zlib.crc32(w.encode()) % SLOTS] |= 1 << self.bit[name]

    def met(self, low: Column) -> Column:
        """The bits of the rules that a lower-case text may meet."""
        slots = F.expr(f"array({', '.join(f'{s}L' for s in self.slots)})")
        slot = lambda w: F.get(slots, (F.crc32(w.cast("binary")) % SLOTS).cast("int"))
        words = F.array_distinct(F.regexp_extract_all(low, F.lit(self.pattern), 0))
        return F.coalesce(F.aggregate(words, F.lit(0).cast("long"), lambda bits, w: bits.bitwiseOR(slot(w))), F.lit(0).cast("long"))

    def may(self, met: Column | None, name: str) -> Column:
        """Whether the rule's bit is set; true without bits."""
        return F.lit(True) if met is None else met.bitwiseAND(F.lit(1 << self.bit[name])) != 0
