"""Operator 4: byte-level BPE by tree concatenation, and decoding.

A text is halved down to leaves, leaves are encoded on their own, and neighbours are joined
bottom up. A join re-encodes a window around the seam and grows it until both sides agree:

* normally both window ends lie on blanks where the pre-tokenizer always starts a match; the ids
  that leave the window must be exactly the ids that each side had there;
* in unsplit text (a run with no such blank) the runs' pre-tokens are compared, and a long
  pre-token that spans the seam is joined by windows of tokens. A BPE sequence is the encoding
  exactly when each adjacent pair is, so a window whose first and last token equal the sides' own
  leaves only pairs that are known to be right.

Texts beyond ``split_chars`` are dealt out leaf by leaf over the cluster; shorter ones are
handled within their row. Nulls count as empty texts; repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import ids_and_text, per_row
from kalends.llm.tokens import SAFE_CUT, ChunkEncoder, byte_alphabet

LEAF_CHARS = 4096
SPLIT_CHARS = 65_536
UNSPLIT_CHARS = 1024

_trees: dict = {}


class TreeEncoder:
    def __init__(self, path: str, leaf: int = LEAF_CHARS, unsplit: int = UNSPLIT_CHARS) -> None:
        self.chunked, self.leaf, self.unsplit = ChunkEncoder(path), leaf, unsplit
        t = self.tokenizer = self.chunked.tokenizer
        self.letters = byte_alphabet()
        back = {c: b for b, c in self.letters.items()}
        self.specials = {i: x.content for i, x in t.get_added_tokens_decoder().items()}
        size = t.get_vocab_size(with_added_tokens=True)
        self.raw = [b""] * size
        for word, i in t.get_vocab(with_added_tokens=True).items():
            self.raw[i] = self.specials[i].encode() if i in self.specials else bytes(back[c] for c in word)
        self.length = np.array([len(b) for b in self.raw], np.int64)
        self.special = re.compile("|".join(map(re.escape, self.specials.values())) or "(?!)")
        self.cut = SAFE_CUT

    def flat(self, text: str) -> np.ndarray:
        return self.chunked.ids(text)

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= self.leaf:
            return self.flat(text)
        half = len(text) // 2
        return self.join(text[:half], self.encode(text[:half]), text[half:], self.encode(text[half:]))

    def join(self, x: str, xi: np.ndarray, y: str, yi: np.ndarray) -> np.ndarray:
        """Ids of x + y from the ids of x and of y."""
        if not x or not y:
            return yi if not x else xi
        wide = 32
        while True:
            left = self.cut.search(x, max(0, len(x) - wide))
            a = left.start() if left else 0 if wide >= len(x) else None
            right = [m.start() for m in self.cut.finditer(y, 0, wide)]
            b = right[-1] if right else len(y) if wide >= len(y) else None
            if a is not None and b is not None and (len(x) - a <= self.unsplit or left) and (b <= self.unsplit or right):
                tail, head = self.flat(x[a:]), self.flat(y[:b])
                if np.array_equal(xi[len(xi) - len(tail) :], tail) and np.array_equal(yi[: len(head)], head):
                    return np.concatenate([xi[: len(xi) - len(tail)], self.flat(x[a:] + y[:b]), yi[len(head) :]])
            if wide > self.unsplit or wide >= len(x) and wide >= len(y):
                return self.join_unsplit(x, xi, y, yi)
            wide *= 2

    def join_unsplit(self, x: str, xi: np.ndarray, y: str, yi: np.ndarray) -> np.ndarray:
        cuts = [m.start() for m in self.cut.finditer(x)]
        a = cuts[-1] if cuts else 0
        first = self.cut.search(y)
        b = first.start() if first else len(y)
        left, right = x[a:], y[:b]
        nx, ny = self.last(xi, len(left.encode())), self.first(yi, len(right.encode()))
        lt, rt = xi[len(xi) - nx :], yi[:ny]
        whole = left + right
        if self.special.search(whole):
            mid = self.flat(whole)
        else:
            mid = self.join_run(left, lt, right, rt, whole)
        return np.concatenate([xi[: len(xi) - nx], mid, yi[ny:]])

    def join_run(self, left: str, lt: np.ndarray, right: str, rt: np.ndarray, whole: str) -> np.ndarray:
        spans = lambda s: [p for _, p in self.tokenizer.pre_tokenizer.pre_tokenize_str(s)]
        own, other, joint, seam = spans(left), spans(right), spans(whole), len(left)
        same = 0
        while same < min(len(own), len(joint)) and own[same] == joint[same] and own[same][1] < seam:
            same += 1
        p0 = joint[same][0]
        ends = {seam + s for s, _ in other} | {len(whole)}
        stop = next(k for k in range(same, len(joint)) if joint[k][1] in ends and joint[k][1] >= seam)
        q0 = joint[stop][1]
        keep, drop = self.first(lt, len(left[:p0].encode())), self.first(rt, len(right[: q0 - seam].encode()))
        near, far = lt[keep:], rt[:drop]
        if same == stop and len(own) == same + 1 and (not other or other[0][1] == q0 - seam) and p0 < seam < q0:
            mid = self.join_tokens(near, far)
        else:
            mid = np.concatenate([self.bpe(whole[s:e].encode()) for s, e in joint[same : stop + 1]])
        return np.concatenate([lt[:keep], mid, rt[drop:]])

    def join_tokens(self, lt: np.ndarray, rt: np.ndarray) -> np.ndarray:
        """Two encodings of parts of one pre-token; the window doubles until both ends agree."""
        k = 8
        while True:
            lw, rw = lt[-k:], rt[:k]
            mid = self.bpe(b"".join(self.raw[i] for i in lw) + b"".join(self.raw[i] for i in rw))
            if (k >= len(lt) or mid[0] == lw[0]) and (k >= len(rt) or mid[-1] == rw[-1]):
                return np.concatenate([lt[:-k], mid, rt[k:]])
            k *= 2

    def bpe(self, raw: bytes) -> np.ndarray:
        return np.array([t.id for t in self.tokenizer.model.tokenize("".join(map(self.letters.__getitem__, raw)))], "<u4")

    def first(self, ids: np.ndarray, n_bytes: int) -> int:
        return int(np.searchsorted(np.cumsum(self.length[ids]), n_bytes)) + 1 if n_bytes else 0

    def last(self, ids: np.ndarray, n_bytes: int) -> int:
        return self.first(ids[::-1], n_bytes)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def digest(self, ids: np.ndarray) -> tuple[int, str, str]:
        text = ",".join(map(str, ids.tolist()))
        return len(ids), hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(self.decode(ids).encode("utf-8", "replace")).hexdigest()


def tree_encoder(path: str, leaf: int = LEAF_CHARS) -> TreeEncoder:
    if (path, leaf) not in _trees:
        _trees[path, leaf] = TreeEncoder(path, leaf)
    return _trees[path, leaf]


FIELDS = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_decode(docs: DataFrame, path: str, leaf: int = LEAF_CHARS, split_chars: int = SPLIT_CHARS) -> DataFrame:
    """Per document: token count, SHA-256 of the ids and of the text decoded from them.

    Null and empty texts have no tokens. Every row of docs gives one row, repeated ids included.
    """
    rows = ids_and_text(docs)
    short = rows.filter(F.char_length("text") <= split_chars)
    long = rows.filter(F.char_length("text") > split_chars).withColumn("row", F.monotonically_increasing_id())

    def make():
        tree = tree_encoder(path, leaf)
        return lambda text: tree.digest(tree.encode(text))

    part = split_chars // 4

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n = -(-len(r["text"]) // part)
                n = 1 << (n - 1).bit_length()
                cuts = [len(r["text"]) * i // n for i in range(n + 1)]
                kinds = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("part", pa.int32()), ("text", pa.string())])
                yield pa.RecordBatch.from_pylist([{"row": r["row"], "doc_id": r["doc_id"], "part": i, "text": r["text"][s:e]} for i, (s, e) in enumerate(zip(cuts, cuts[1:]))], kinds)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = tree_encoder(path, leaf)
        for batch in batches:
            ids = [tree.encode(t).tobytes() for t in batch.column("text").to_pylist()]
            yield batch.append_column("ids", pa.array(ids, pa.binary()))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = tree_encoder(path, leaf)
        pdf = pdf.sort_values("part")
        nodes = [(t, np.frombuffer(b, "<u4")) for t, b in zip(pdf.text, pdf.ids)]
        while len(nodes) > 1:
            pairs = [(nodes[i][0] + nodes[i + 1][0], tree.join(*nodes[i], *nodes[i + 1])) for i in range(0, len(nodes) - 1, 2)]
            nodes = pairs + nodes[len(pairs) * 2 :]
        return pd.DataFrame([(pdf.doc_id.iloc[0], *tree.digest(nodes[0][1]))], columns=["doc_id", *(n for n, _ in FIELDS)]).astype({"doc_id": "Int64"})

    parts = long.mapInArrow(deal, "row long, doc_id long, part int, text string").repartition("row", "part")
    grown = parts.mapInArrow(leaves, "row long, doc_id long, part int, text string, ids binary").groupBy("row").applyInPandas(grow, SCHEMA)
    return per_row(short, make, FIELDS, SCHEMA).unionByName(grown)
