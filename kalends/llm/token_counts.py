"""Operator 7: token counts with a whole-token shortcut.

Before the corpus is read, every vocabulary string that can stand as a pre-token is encoded once;
those that come back as exactly one token are proven, and in the corpus each such pre-token counts
one without being merged. Only the other pre-tokens go through the library, and their counts are
kept in a bounded dictionary.

A pre-token is a word with the blanks before it. The cut is proven offline as well: no vocabulary
string holds a blank mark after another character, so no merge can span a cut.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import ids_and_text, per_row

MARK = "▁"
LIMIT = 400_000
LONGEST_KEPT = 200  # longer strings without blanks are counted, never kept

_counters: dict = {}


def prove_whole_tokens(path: str) -> tuple[frozenset, bool]:
    """The pre-tokens (leading blank included) proven to encode alone as one token; whether blanks are safe cuts."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    safe = not any(MARK in p.lstrip(MARK) for p in pieces)
    words = [p[1:] for p in pieces if p[0] == MARK and len(p) > 1 and MARK not in p[1:]]
    # a text "word" gets a blank mark before it, as a word after a blank does
    return frozenset(w for w, ids in zip(words, sp.encode(words)) if len(ids) == 1 and MARK + w == sp.id_to_piece(ids[0])), safe


class Counter(dict):
    def __init__(self, path: str, whole: frozenset, safe: bool) -> None:
        import sentencepiece

        super().__init__()
        self.sp, self.whole, self.safe = sentencepiece.SentencePieceProcessor(model_file=path), whole, safe
        self.seed()

    def seed(self) -> None:
        self.clear()
        self.update(dict.fromkeys(self.whole, 1))

    def library(self, text: str) -> int:
        return len(self.sp.encode(text, num_threads=1) if text else [])

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.safe or "  " in text or text[0] == " " or text[-1] == " " or MARK in text:
            return self.by_runs(text)
        words = text.split(" ")
        try:
            return sum(map(self.__getitem__, words))
        except KeyError:
            return self.merge_rest(words)

    def merge_rest(self, words: list[str]) -> int:
        new = [w for w in dict.fromkeys(words) if w not in self]
        if len(self) + len(new) > LIMIT:
            self.seed()
            new = [w for w in dict.fromkeys(words) if w not in self]
        found = dict(zip(new, map(len, self.sp.encode(new, num_threads=1))))
        self.update((w, n) for w, n in found.items() if len(w) <= LONGEST_KEPT)
        return sum(found[w] if w in found else self[w] for w in words)

    def by_runs(self, text: str) -> int:
        """Texts with runs of blanks go to the library whole."""
        return self.library(text)


def counter(path: str, whole: frozenset, safe: bool) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path, whole, safe)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """Per document: UTF-8 bytes, tokens, and whether the tokens exceed limit.

    Null and empty texts have 0 bytes and 0 tokens; every row of docs gives one row.
    """
    whole, safe = prove_whole_tokens(path)

    def make():
        c = counter(path, whole, safe)
        return lambda text: (c.count(text), len(text.encode()))

    got = per_row(ids_and_text(docs), make, [("n_tokens", pa.int64()), ("n_bytes", pa.int64())], "doc_id long, n_tokens long, n_bytes long")
    return got.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
