"""Operator 1: token ids in Re-Pair compressed shards with random access.

Rows are range-partitioned and sorted by doc_id; each task encodes its documents and cuts the id
stream into shards. In a shard every adjacent id pair that is found MIN_COUNT times is replaced by a new
symbol, round after round, until no pair is. A shard file holds

    header   magic, lengths of the parts below as little-endian 64-bit integers
    rules    two 32-bit symbols per nonterminal
    expand   32-bit expansion length of each nonterminal
    symbols  the compressed stream: the low 16 bits of each, then a plane of bits for each further bit

and documents are found in it by ids before them: the running sum of expansion lengths gives the
symbol that covers a position, so any document is decoded without the ones before it. Symbols may
span documents. Files have names of their own per attempt and only the manifest, which Spark
commits, says which of them count; a lost or repeated task does no harm.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyarrow import fs as pafs

from kalends.llm.common import ids_and_text, scratch, slices
from kalends.llm.tokens import encoder

MAGIC = b"REPAIR01"
SHARD_IDS = 2_000_000
MIN_COUNT = 24
SLOT_BITS = 20
SHORT_RULE = 64
MANIFEST = "shard string, part long, seq long, doc_id long, before long, n_tokens long"


def occurrences(keys: np.ndarray, at: np.ndarray, min_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs found min_count times or more among keys: (pairs, positions sorted by pair, each position's pair number).

    A count by hashed slots first drops what cannot be frequent, for a pair is found at most as often as its slot.
    """
    slot = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int32)
    often = (np.bincount(slot, minlength=1 << SLOT_BITS) >= min_count)[slot]
    keys, at = keys[often], at[often]
    if not len(keys):
        return keys, at, at
    left, right = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
    side, place = int(max(left.max(), right.max())).bit_length(), int(at[-1]).bit_length()
    if 2 * side + place <= 64:  # pair and position in one integer sort fastest
        packed = np.sort((((left << np.uint64(side)) | right) << np.uint64(place)) | at.astype(np.uint64))
        at = (packed & np.uint64((1 << place) - 1)).astype(np.int64)
        packed >>= np.uint64(place)
        keys = ((packed >> np.uint64(side)) << np.uint64(32)) | (packed & np.uint64((1 << side) - 1))
    else:
        order = np.argsort(keys, kind="stable")
        keys, at = keys[order], at[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    n = np.diff(np.r_[first, len(keys)])
    chosen = n >= min_count
    return keys[first[chosen]], at[np.repeat(chosen, n)], np.repeat(np.arange(int(chosen.sum())), n[chosen])


def pair_round(symbols: np.ndarray, newest: int, known: int, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """One round: (symbols, pairs as left << 32 | right); pairs become known, known + 1, ...

    Only pairs that hold a symbol from newest on are counted: all others were counted before and have
    not become more frequent. Occurrences are replaced left to right, and in a run of overlapping ones every second
    from the run's start, so no occurrence of a chosen pair is left.
    """
    fresh = symbols >= newest
    at = np.flatnonzero(fresh[:-1] | fresh[1:])
    pairs, at, number = occurrences((symbols[at].astype(np.uint64) << np.uint64(32)) | symbols[at + 1], at, min_count)
    if not len(pairs):
        return symbols, pairs
    new = np.full(len(symbols), -1, np.int64)
    new[at] = number
    at = np.flatnonzero(new >= 0)
    start = np.r_[True, np.diff(at) != 1]
    first = np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
    at = at[(np.arange(len(at)) - first) % 2 == 0]
    out = symbols.copy()
    out[at] = known + new[at]
    keep = np.ones(len(symbols), bool)
    keep[at + 1] = False
    return out[keep], pairs


def compress(ids: np.ndarray, base: int, min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): symbols below base are ids, base + k stands for the pair rules[k]. No pair is left min_count times."""
    symbols, rules, newest, known = ids.astype(np.uint32), [], 0, base
    while len(symbols) > 1:
        symbols, pairs = pair_round(symbols, newest, known, min_count)
        if not len(pairs):
            break
        rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        newest, known = known, known + len(pairs)
    return symbols, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def expansions(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids that each nonterminal stands for; rules only refer to earlier ones."""
    n = np.ones(len(rules), np.uint32)
    pending = np.ones(len(rules), bool)
    while pending.any():
        inner = rules.astype(np.int64) - base
        ready = pending & ~((inner >= 0) & pending[np.maximum(inner, 0)]).any(1)
        sizes = np.where(inner >= 0, n[np.maximum(inner, 0)], 1)
        n[ready] = sizes[ready].sum(1)
        pending &= ~ready
    return n


def expand(symbols: np.ndarray, rules: np.ndarray, base: int, most: int = 1 << 30) -> np.ndarray:
    """The ids that symbols stand for; with most, rules are replaced by their pairs so many times only."""
    while most and len(symbols) and (new := symbols >= base).any():
        most -= 1
        n = np.where(new, 2, 1)
        at = np.cumsum(n) - n
        out = np.empty(int(n.sum()), np.uint32)
        out[at] = symbols
        pair = rules[symbols[new] - base]
        out[at[new]], out[at[new] + 1] = pair[:, 0], pair[:, 1]
        symbols = out
    return symbols


def planes(symbols: np.ndarray, bits: int) -> bytes:
    """The low 16 bits of each symbol, then a packed plane for each bit above."""
    high = [np.packbits((symbols >> np.uint32(k)) & np.uint32(1) != 0, bitorder="little").tobytes() for k in range(16, bits)]
    return b"".join([(symbols & np.uint32(0xFFFF)).astype("<u2").tobytes(), *high])


def from_planes(raw: bytes, at: int, n: int, bits: int) -> np.ndarray:
    symbols = np.frombuffer(raw, "<u2", n, at).astype(np.uint32)
    for k in range(16, bits):
        plane = np.frombuffer(raw, np.uint8, -(-n // 8), at + 2 * n + (k - 16) * -(-n // 8))
        symbols |= np.unpackbits(plane, count=n, bitorder="little").astype(np.uint32) << np.uint32(k)
    return symbols


def dump(ids: np.ndarray, base: int) -> bytes:
    symbols, rules = compress(ids, base)
    bits = max(16, (base + len(rules)).bit_length())
    return b"".join([MAGIC, struct.pack("<5q", base, len(ids), len(rules), len(symbols), bits), rules.astype("<u4").tobytes(), expansions(rules, base).astype("<u4").tobytes(), planes(symbols, bits)])


class Shard:
    def __init__(self, raw: bytes) -> None:
        if raw[:8] != MAGIC:
            raise ValueError("not a shard file")
        self.base, self.n_ids, n_rules, n_symbols, bits = struct.unpack_from("<5q", raw, 8)
        at = 48
        self.rules = np.frombuffer(raw, "<u4", 2 * n_rules, at).reshape(-1, 2)
        sizes = np.frombuffer(raw, "<u4", n_rules, at + 8 * n_rules).astype(np.int64)
        self.symbols = from_planes(raw, at + 12 * n_rules, n_symbols, bits)
        self.sizes = np.concatenate([np.ones(self.base, np.int64), sizes])  # by symbol
        self.ends = np.cumsum(self.sizes[self.symbols])
        # expansions of ids and short rules, one after the other
        short = np.flatnonzero(self.sizes <= SHORT_RULE)
        self.flat = expand(short.astype(np.uint32), self.rules, self.base)
        self.first = np.full(len(self.sizes), -1, np.int64)
        self.first[short] = np.cumsum(self.sizes[short]) - self.sizes[short]

    def ids(self, start: int, length: int) -> np.ndarray:
        """Random access: ids[start : start + length], expanding only the symbols that cover them."""
        if not length:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(self.ends, start, "right"), np.searchsorted(self.ends, start + length)
        skip = start - (int(self.ends[a - 1]) if a else 0)
        some = self.symbols[a : b + 1]
        while (self.first[some] < 0).any():
            some = expand(some, self.rules, self.base, 1)
        n = self.sizes[some]
        ends = np.cumsum(n)
        return self.flat[np.arange(ends[-1]) + np.repeat(self.first[some] - ends + n, n)][skip : skip + length]


def write_shards(docs: DataFrame, path: str, folder: str, end_id: int = 2, partitions: int | None = None, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes the shards under folder and returns their manifest, one row per document.

    The order is ascending doc_id, nulls first, equal ids by text. Null and empty texts hold the
    end id only.
    """
    n = partitions or max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = ids_and_text(docs).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, words_only=True)
        base = coder.tokenizer.get_vocab_size(with_added_tokens=True)
        part, seq = TaskContext.get().partitionId(), 0
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        held: list[bytes] = []
        index: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal size, seq
            name = f"{part:06d}-{seq:06d}-{uuid.uuid4().hex}.rp"
            with store.open_output_stream(f"{root}/{name}") as f:
                f.write(dump(np.frombuffer(b"".join(held), "<u4"), base))
            cols = list(zip(*((name, part, seq, *x) for x in index)))
            kinds = [pa.string()] + [pa.int64()] * 5
            held.clear()
            index.clear()
            size, seq = 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["shard", "part", "seq", "doc_id", "before", "n_tokens"])

        for batch in slices(batches, 256):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = coder.encode(text) + end
                index.append((doc, size, len(ids) // 4))
                held.append(ids)
                size += len(ids) // 4
                if size >= shard_ids:
                    yield flush()
        if index:
            yield flush()

    return rows.mapInArrow(run, MANIFEST)


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) decoded from the files that the manifest names."""
    shards = manifest.groupBy("part", "seq", "shard").agg(F.sum("n_tokens").alias("ids"))
    starts = shards.select("shard", (F.sum("ids").over(Window.orderBy("part", "seq")) - F.col("ids")).alias("first"))
    entries = manifest.repartition("shard").sortWithinPartitions("shard", "before")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        name, shard = None, None
        for batch in batches:
            crc = []
            for at, before, n in zip(batch.column("shard").to_pylist(), batch.column("before").to_pylist(), batch.column("n_tokens").to_pylist()):
                if at != name:
                    name = at
                    with store.open_input_stream(f"{root}/{at}") as f:
                        shard = Shard(f.read())
                crc.append(zlib.crc32(shard.ids(before, n).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("shard", "doc_id", "before", "n_tokens")), pa.array(crc, pa.int64())], names=["shard", "doc_id", "before", "n_tokens", "ids_crc32"])

    read = entries.mapInArrow(run, "shard string, doc_id long, before long, n_tokens long, ids_crc32 long")
    return read.join(starts, "shard").select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    folder = scratch(docs.sparkSession, "repair")
    manifest_path = f"{folder}/manifest"
    write_shards(docs, path, f"{folder}/shards", end_id).write.parquet(manifest_path)
    return read_shards(docs.sparkSession.read.schema(MANIFEST).parquet(manifest_path), f"{folder}/shards")
