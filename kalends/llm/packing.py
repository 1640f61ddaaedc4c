"""Operator 8: cost-balanced packing of token sequences.

A document's ids are cut into full sequences and one remainder. Within a block of remainders the
number of sequences is the least that can hold them; each remainder, longest first, goes to the
sequence of lowest estimated cost (linear plus quadratic attention) that has room. A remainder that
fits nowhere whole is cut over the sequences of lowest cost with room left, so a block leaves one
part-filled sequence at most and no id is lost or repeated.

Blocks are runs of a partition's rows, bounded by buffered tokens; nothing is shuffled, and a lost
task gives the same sequences again because they are numbered by partition and order.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from kalends.llm.common import ids_and_text, slices
from kalends.llm.tokens import encoder

LINEAR, QUADRATIC = 1.0, 1.0 / 256
BLOCK_TOKENS = 4_000_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cost"]


def attention_cost(length: int) -> float:
    return LINEAR * length + QUADRATIC * length * length


def assign(lengths: list[int], size: int) -> list[list[tuple[int, int, int]]]:
    """For each sequence its pieces (item, from, length); items are in 1..size-1 tokens long."""
    count = -(-sum(lengths) // size)
    held: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]
    # sequences by room left; lowest[r] is the least cost among those with exactly r tokens of room
    heaps: list[list[tuple[float, int]]] = [[] for _ in range(size + 1)]
    heaps[size] = [(0.0, i) for i in range(count)]
    lowest = np.full(size + 1, np.inf)
    lowest[size] = 0.0 if count else np.inf

    def put(room: int, item: int, start: int, n: int) -> None:
        cost, seq = heapq.heappop(heaps[room])
        lowest[room] = heaps[room][0][0] if heaps[room] else np.inf
        held[seq].append((item, start, n))
        left, cost = room - n, cost + attention_cost(n)
        if left:
            heapq.heappush(heaps[left], (cost, seq))
            lowest[left] = heaps[left][0][0]

    cut: list[int] = []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[item]
        room = n + int(np.argmin(lowest[n:]))
        if np.isfinite(lowest[room]):
            put(room, item, 0, n)
        else:
            cut.append(item)
    for item in cut:
        start = 0
        while start < lengths[item]:
            room = 1 + int(np.argmin(lowest[1:]))
            n = min(room, lengths[item] - start)
            put(room, item, start, n)
            start += n
    return held


def pack(docs: DataFrame, path: str, end_id: int = 0, size: int = 1024, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece: where its ids lie in the document and in which sequence at which offset.

    Null and empty texts hold the end id only. Rows with equal or null ids are packed apart, as
    given. An empty table gives no pieces.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        at = TaskContext.get().partitionId() << 33
        rest: list[tuple[int | None, int, bytes, int]] = []
        full: list[tuple] = []
        held = 0
        whole = attention_cost(size)

        def flush() -> pa.RecordBatch:
            nonlocal at, held
            out = list(full)
            for pieces in assign([len(r[2]) // 4 for r in rest], size):
                offset = 0
                cost = sum(attention_cost(n) for _, _, n in pieces)
                for item, start, n in pieces:
                    doc, before, ids, total = rest[item]
                    out.append((doc, before + start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), total, at, offset, cost))
                    offset += n
                at += 1
            full.clear()
            rest.clear()
            held = 0
            kinds = [pa.int64()] * 7 + [pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 8, kinds)], names=NAMES)

        for batch in slices(batches, 256):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(text) + end
                total = len(ids) // 4
                start = 0
                while total - start >= size:
                    full.append((doc, start, size, zlib.crc32(ids[4 * start : 4 * (start + size)]), total, at, 0, whole))
                    at += 1
                    start += size
                if start < total:
                    rest.append((doc, start, ids[4 * start :], total))
                    held += total - start
            if held >= block_tokens or len(full) >= 100_000:
                yield flush()
        if rest or full:
            yield flush()

    return ids_and_text(docs).mapInArrow(run, SCHEMA)
