"""Operator 12: ranked lexical search through hashed max-sketches.

Each document's impacts, what a term's occurrences count for in a text of its length, fold into a vector of
WIDTH coordinates: a term's coordinate is a hash, and of the terms that meet in one the largest impact stays. For a block of
documents and all items at once, the sum of an item's weights times the coordinates of its terms is a bound
that no exact score exceeds. Documents are scored exactly by descending bound until the bound falls below the item's
k-th best score so far, equal bounds included, for equal scores rank by id. A task sends on the k best of each item only.

Statistics (documents with a term, terms, documents holding each of the items' terms) are summed over all
documents first. Both passes read the texts where they lie; no text is shuffled. Items are read in groups of bounded
size, for a group's terms travel with each task; each group is a search over all documents.

A null text or one without a term is no document; a repeated row is one more document. Ids that are null rank before
others of equal score. Each row of items is an item, repeated ids too; one without a term finds nothing.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from heapq import heappush, heappushpop
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kalends.llm.common import slices

WIDTH = 2048
BLOCK = 256  # documents that are bounded together
CHUNK = 1 << 20  # bytes of a text that are split at once
GROUP_ITEMS, GROUP_BYTES = 4096, 8 << 20
K = 10
B_PERCENT = 75  # of the length in a document's m
#: Letters, digits and all bytes beyond ASCII make terms; all other bytes separate them.
SHAPE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The text's terms, some at a time."""
    at = 0
    while at < len(text):
        end = min(len(text), at + CHUNK)
        part = text[at:end].translate(SHAPE)
        while end < len(text) and not part.endswith(b" "):  # the term that a cut would part goes on
            more = text[end : end + CHUNK].translate(SHAPE)
            cut = more.find(b" ") + 1 or len(more)
            part, end = part + more[:cut], end + cut
        yield part.split()
        at = end


def counted(text: bytes) -> Counter:
    out: Counter = Counter()
    for some in terms(text):
        out.update(some)
    return out


def impact(tf, m):
    """What tf occurrences count for in a document of length measure m; ints or arrays of them."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_measure(n: int, documents: int, total: int) -> int:
    return 100 - B_PERCENT + (B_PERCENT * n * documents) // total


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def sketches(counts: list[Counter], measures: list[int], width: int = WIDTH) -> np.ndarray:
    """A row for each document: the largest impact of the terms at each coordinate."""
    sizes = np.array([len(c) for c in counts])
    at = np.fromiter((crc32(t) for c in counts for t in c), np.int64, sizes.sum()) & (width - 1)
    tf = np.fromiter((n for c in counts for n in c.values()), np.int64, sizes.sum())
    out = np.zeros((len(counts), width), np.float32)
    np.maximum.at(out.reshape(-1), np.repeat(np.arange(len(counts)) * width, sizes) + at, impact(tf, np.repeat(np.array(measures, np.int64), sizes)).astype(np.float32))
    return out


def statistics(docs: DataFrame, wanted: set[bytes], text_col: str = "text") -> tuple[int, int, dict[bytes, int]]:
    """Documents with a term, all their terms, and how many documents hold each wanted term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        documents = total = 0
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                met: set[bytes] = set()
                n = 0
                for some in terms(text):
                    n += len(some)
                    met |= wanted.intersection(some)
                held.update(met)
                documents, total = documents + (n > 0), total + n
        yield pa.RecordBatch.from_arrays([pa.array([None, *held], pa.binary()), pa.array([documents, *held.values()], pa.int64()), pa.array([total, *[0] * len(held)], pa.int64())], names=["term", "documents", "total"])

    texts = docs.select(F.col(text_col).cast("string").cast("binary").alias("text")).filter("text is not null")
    rows = texts.mapInArrow(run, "term binary, documents long, total long").groupBy("term").agg(F.sum("documents").alias("documents"), F.sum("total").alias("total")).collect()  # a row for each wanted term
    found = {bytes(r["term"]) if r["term"] is not None else None: (r["documents"], r["total"]) for r in rows}
    documents, total = found.pop(None, (0, 0))
    return documents, total, {t: n for t, (n, _) in found.items()}


class Board:
    """The k best documents so far of each item."""

    def __init__(self, items: list[list[tuple[bytes, int]]], k: int) -> None:
        self.items, self.k = items, k
        self.best: list[list[tuple[int, int]]] = [[] for _ in items]
        self.least = np.zeros(len(items), np.float32)

    def meet(self, ids: list[int], counts: list[Counter], measures: list[int], bounds: np.ndarray) -> int:
        """Scores documents by descending bound while the bound reaches the k-th best score; how many were scored."""
        scored = 0
        for j in np.flatnonzero(((bounds > 0) & (bounds >= self.least)).any(0)):
            best, column = self.best[j], bounds[:, j]
            asked = np.flatnonzero((column > 0) & (column >= self.least[j]))
            for i in asked[np.argsort(-column[asked], kind="stable")]:
                if column[i] < self.least[j]:
                    break
                scored += 1
                tf, m, score = counts[i], measures[i], 0
                for term, w in self.items[j]:
                    if n := tf.get(term):
                        score += w * impact(n, m)
                if score > 0:
                    entry = (score, -ids[i])
                    if len(best) < self.k:
                        heappush(best, entry)
                    elif entry > best[0]:
                        heappushpop(best, entry)
                    if len(best) == self.k:
                        self.least[j] = best[0][0] * (1 - 1e-6)  # 32-bit floats round
        return scored


NO_ID = -(1 << 63)


def _best(docs: DataFrame, items: list[Counter], k: int, width: int) -> DataFrame:
    """(item, doc_id, score): each task's k best documents of each item, items by their numbers."""
    documents, total, holding = statistics(docs, {t for item in items for t in item})
    weighed = [[(t, n * weight(documents, holding[t])) for t, n in item.items() if t in holding] for item in items]
    weighed = [[(t, w) for t, w in item if w > 0] for item in weighed]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        board = Board(weighed, k)
        lookup = np.zeros((width, len(weighed)), np.float32)
        for j, item in enumerate(weighed):
            for t, w in item:
                lookup[crc32(t) & (width - 1), j] += w
        used = np.flatnonzero(lookup.any(1))
        lookup = np.ascontiguousarray(lookup[used])
        for batch in slices(batches, BLOCK):
            ids, counts, measures = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                tf = counted(text)
                if tf:
                    ids.append(NO_ID if doc_id is None else doc_id)
                    counts.append(tf)
                    measures.append(length_measure(tf.total(), documents, total))
            if ids:
                bounds = (sketches(counts, measures, width)[:, used] @ lookup) * np.float32(1 + 1e-4)
                board.meet(ids, counts, measures, bounds)
        rows = [(j, None if -d == NO_ID else -d, s) for j, best in enumerate(board.best) for s, d in best]
        cols = list(zip(*rows)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["item", "doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).filter("text is not null")
    return texts.mapInArrow(run, "item long, doc_id long, score long")


def groups(items: DataFrame) -> Iterator[list[tuple[int | None, Counter]]]:
    """Items and their terms, a bounded group at a time."""
    held, size = [], 0
    for row in items.select(F.col("item_id").cast("long"), F.col("text").cast("string").cast("binary")).toLocalIterator():
        held.append((row[0], counted(bytes(row[1] or b""))))
        size += len(row[1] or b"")
        if len(held) == GROUP_ITEMS or size > GROUP_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k highest-scoring documents with a score above 0.

    docs has doc_id and text, items has item_id and text.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for group in groups(items):
        best = _best(docs, [c for _, c in group], k, width)
        w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(group)], "item long, item_id long")
        out = out.unionByName(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))  # GROUP_ITEMS names
    return out
