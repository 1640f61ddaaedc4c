"""Operator 10: SimHash near copies by tiled exact comparison.

Equal fingerprints are folded first, by a partial aggregation. The distinct ones are range-sorted
by a small integer key (their population count, or a step of their logarithmic size) and cut into
tiles, each a file in the shared folder; a tile is compared with itself and with the later tiles whose keys
are within reach, by numpy exclusive-or and bit counts. Only the tiles' names are shuffled. Inside a tile pair,
blocks whose population counts differ beyond the radius are skipped. A tile pair returns a spanning forest of its
links, which joins exactly what all its links join but never lists all pairs of a group.
"""

from __future__ import annotations

import functools
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kalends.llm.common import ids_and_bytes, per_row, scratch, slices, stored
from kalends.llm.components import components

SEED = 42
TILE_ROWS = 32_768
LEAST_TILE_ROWS = 1024
TILES = 48
OTHERS = 16  # tiles that a task row compares with its own
BLOCK_A, BLOCK_B = 256, 2048
#: Sizes within a step of each other differ by at most a twelfth.
SIZE_STEP = math.log(1 + 1 / 12)
SET_WORDS, HEAD_WORDS = 8, 2  # 64-bit words of a set's fingerprint, and those that are compared first
#: Beyond so many common shingles the share of differing bits is settled.
MOST_COMMON = 320
MISSED = 1e-9  # probability that a similar pair lies beyond the candidates' radius


def shingle_hashes(text: bytes, n: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of n words of the ASCII-lower-cased text, joined by blanks; all words if they are fewer."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    one = b" ".join(words)
    if len(words) <= n:
        return np.array([xxhash.xxh64_intdigest(one, seed)], np.uint64)
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[: len(words) - n])]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(one[s:e], seed) for s, e in zip(starts, ends[n - 1 :])], np.uint64)


def mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th further 64 bits of each hash; h itself for k = 0."""
    if not k:
        return h
    z = h + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprint(hashes: np.ndarray, words: int = 1) -> np.ndarray:
    """A bit is 1 if it is set in over half of the hashes; zero without hashes."""
    out = np.zeros(words, np.uint64)
    for k in range(words if len(hashes) else 0):
        h, ones = mixed(hashes, k), np.zeros(64, np.int64)
        for at in range(0, len(h), 16_384):
            part = np.ascontiguousarray(h[at : at + 16_384].astype("<u8"))
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[k] = np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, n: int = 3, words: int = 1, distinct: bool = False) -> DataFrame:
    """(doc_id, text_hash, fp, pop, size): a hash of the text, fingerprint bytes, their bits set, and the number of shingles. Null texts are empty."""

    def make():
        def one(text: bytes) -> tuple:
            h = shingle_hashes(text, n)
            h = np.unique(h) if distinct else h
            fp = fingerprint(h, words)
            return int.from_bytes(xxhash.xxh64_digest(text, SEED), signed=True), fp.astype("<u8").tobytes(), int(np.bitwise_count(fp).sum()), len(h)

        return one

    fields = [("text_hash", pa.int64()), ("fp", pa.binary()), ("pop", pa.int32()), ("size", pa.int64())]
    return per_row(ids_and_bytes(docs), make, fields, "doc_id long, text_hash long, fp binary, pop int, size long")


def forest(a: np.ndarray, b: np.ndarray, pop_a: np.ndarray, pop_b: np.ndarray, radius: int, same: bool, fits=None, head: tuple[int, int] | None = None) -> list[tuple[int, int]]:
    """Links between rows of a (n x words) and of b that span the components of all links within radius.

    head: so many first words must be within so many bits as well; they leave few pairs for the others to decide.
    """
    n = len(a)
    parent = np.arange(n if same else n + len(b))
    first, most = head or (a.shape[1], radius)

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i in range(0, n, BLOCK_A):
        x, px = a[i : i + BLOCK_A], pop_a[i : i + BLOCK_A]
        for j in range(i - i % BLOCK_B if same else 0, len(b), BLOCK_B):
            y, py = b[j : j + BLOCK_B], pop_b[j : j + BLOCK_B]
            if px.min() - py.max() > radius or py.min() - px.max() > radius:
                continue
            d = np.bitwise_count(x[:, :1] ^ y[None, :, 0])
            if first > 1:
                d = d.astype(np.int16)
                for k in range(1, first):
                    d += np.bitwise_count(x[:, k : k + 1] ^ y[None, :, k])
            hit = np.nonzero(d <= most)
            if first < x.shape[1]:
                near = np.bitwise_count(x[hit[0]] ^ y[hit[1]]).sum(1, dtype=np.int64) <= radius
                hit = tuple(h[near] for h in hit)
            u, v = hit[0] + i, hit[1] + j
            if same:
                u, v = u[u < v], v[u < v]
            if fits is not None and len(u):
                ok = fits(u, v)
                u, v = u[ok], v[ok]
            while len(u):
                ru = np.fromiter((root(k) for k in u[:20_000].tolist()), np.int64)
                rv = np.fromiter((root(k if same else k + n) for k in v[:20_000].tolist()), np.int64)
                apart = np.flatnonzero(ru != rv)
                for k in apart.tolist():
                    p, q = root(int(ru[k])), root(int(rv[k]))
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        links.append((int(u[k]), int(v[k])))
                u, v = u[20_000:], v[20_000:]
    return links


PARTS = {"fp": "<u8", "pop": "<i8", "size": "<i8", "node": "<i8"}  # of a tile's file, one after the other


def tile_links(distinct: DataFrame, words: int, radius: int, ratio: float | None = None, head: tuple[int, int] | None = None) -> DataFrame:
    """Links (a, b) that span the near fingerprints' components. distinct: (fp, pop, size, node), fp of so many words.

    ratio: sizes must be at least so close (smaller to larger); tiles then follow sizes, not bit counts.
    """
    spark = distinct.sparkSession
    if ratio is None:
        key, reach, most = F.col("pop"), radius, 64 * words
    else:
        key = F.floor(F.log(F.greatest("size", F.lit(1))) / F.lit(SIZE_STEP)).cast("int")
        reach, most = math.ceil(-math.log(ratio) / SIZE_STEP), int(math.log(2**62) / SIZE_STEP)
    count = distinct.count()
    rows = min(TILE_ROWS, max(LEAST_TILE_ROWS, -(-count // TILES)))
    parts = max(1, min(-(-count // rows), 4096))
    folder = scratch(spark, "tiles")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, home = pafs.FileSystem.from_uri(folder)
        store.create_dir(home, recursive=True)
        part, seq = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def tile(table: pa.Table) -> pa.RecordBatch:
            """Writes a tile under a name of its own attempt; Spark commits which names count."""
            nonlocal seq
            keys, name = table.column("key").to_numpy(), f"{part:06d}-{seq:06d}-{uuid.uuid4().hex}"
            with store.open_output_stream(f"{home}/{name}") as f:
                f.write(b"".join(table.column("fp").to_pylist()))
                for c in ("pop", "size", "node"):
                    f.write(table.column(c).to_numpy().astype("<i8").tobytes())
            row = {"part": part, "seq": seq, "lo": int(keys.min()), "hi": int(keys.max()), "name": name}
            seq += 1
            return pa.RecordBatch.from_pylist([row], pa.schema([(c, pa.int32()) for c in ("part", "seq", "lo", "hi")] + [("name", pa.string())]))

        n = 0
        for batch in slices(batches, 1024):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield tile(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield tile(pa.Table.from_batches(held))

    ordered = distinct.withColumn("key", key).repartitionByRange(parts, "key", "pop", "fp").sortWithinPartitions("key", "pop", "fp")
    tiles = stored(ordered.mapInArrow(cut, "part int, seq int, lo int, hi int, name string"), "tile-names")
    numbered = tiles.withColumn("tile", F.row_number().over(Window.orderBy("part", "seq")))  # a row per tile
    last = {r["lo"]: r["last"] for r in numbered.groupBy("lo").agg(F.max("tile").alias("last")).collect()}  # a row per key value at most
    if not last:
        return spark.createDataFrame([], "a long, b long")
    reached, until = [], 0
    for k in range(most + reach + 2):
        until = max(until, last.get(k, 0))
        reached.append(until)
    final = F.element_at(F.array(*map(F.lit, reached)), F.least(F.col("hi") + F.lit(reach), F.lit(most + reach + 1)) + 1)
    left = numbered.select("tile", "name", F.explode(F.sequence("tile", F.greatest(final, F.col("tile")))).alias("other"))
    right = numbered.select(F.col("tile").alias("other"), F.col("name").alias("o_name"))
    some = F.floor((F.col("other") - F.col("tile")) / OTHERS).alias("some")
    work = left.join(right, "other").groupBy("tile", "name", some).agg(F.collect_list("o_name").alias("others"))  # OTHERS names a row
    tile_count = max(last.values())
    spread = work.repartition(min(4096, tile_count * (1 + tile_count // (2 * OTHERS))), "tile", "some")  # the names are few bytes, the work is not

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, home = pafs.FileSystem.from_uri(folder)

        def load(name: str) -> list[np.ndarray]:
            with store.open_input_stream(f"{home}/{name}") as f:
                raw = f.read()
            n = len(raw) // (8 * (words + 3))
            flat = np.frombuffer(raw, "<u8")
            return [flat[: n * words].reshape(n, words), *(flat[n * (words + k) : n * (words + k + 1)].view("<i8") for k in range(3))]

        for batch in batches:
            for name, others in zip(batch.column("name").to_pylist(), batch.column("others").to_pylist()):
                a, pop_a, size_a, node_a = load(name)
                for other in others:
                    b, pop_b, size_b, node_b = load(other)
                    fits = None if ratio is None else lambda u, v: np.minimum(size_a[u], size_b[v]) >= ratio * np.maximum(size_a[u], size_b[v])  # noqa: B023
                    found = forest(a, b, pop_a, pop_b, radius, name == other, fits, head)
                    u, v = (np.array([x[k] for x in found], np.int64) for k in (0, 1))
                    yield pa.RecordBatch.from_arrays([pa.array(node_a[u]), pa.array(node_b[v])], names=["a", "b"])

    return spread.mapInArrow(compare, "a long, b long")


def near_copies(docs: DataFrame, n: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs.

    component_id is the least doc_id reachable over links of at most radius bits. Texts without
    words have fingerprint zero. Rows with a null doc_id get a fingerprint but take no part in links,
    and their component_id is null. Repeated rows are equal to each other; an id that occurs with two
    texts has a row for each, which are linked only if their fingerprints are.
    """
    prints = stored(fingerprints(docs, n), "prints")
    folded = prints.filter("doc_id is not null").groupBy("fp", "pop").agg(F.min("doc_id").alias("rep"), F.max("size").alias("size"))
    distinct = stored(folded.withColumn("node", F.monotonically_increasing_id()), "distinct")
    least = distinct.join(least_of_components(components(tile_links(distinct, 1, radius)), distinct), "node", "left")
    least = least.select("fp", F.coalesce("least", "rep").alias("component_id"))
    got = prints.join(least, "fp", "left").withColumn("hex", F.lower(F.hex("fp")))
    return got.select("doc_id", _big_endian("hex").alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def least_of_components(joined: DataFrame, distinct: DataFrame) -> DataFrame:
    """(node, least): the least rep of the nodes in the node's component. joined: (node, component)."""
    joined = stored(joined, "joined")
    least = joined.join(distinct.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("least"))
    return joined.join(least, "component").select("node", "least")


def _big_endian(column: str):
    """Hex digits of a little-endian 64-bit integer in the usual order."""
    return F.concat(*[F.substring(column, 2 * k + 1, 2) for k in range(7, -1, -1)])


@functools.lru_cache(4096)
def binomial(n: int, p: float = 0.5) -> np.ndarray:
    k = np.arange(n + 1)
    log = np.array([math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in k])
    return np.exp(log + k * math.log(p) + (n - k) * math.log1p(-p))


def differing_share(common: int, own_a: int, own_b: int) -> float:
    """Probability that a fingerprint bit differs between two sets with so many common shingles and shingles of their own."""

    def over_half(own: int) -> np.ndarray:
        """By the ones among the common shingles, the probability that over half of the set's are ones."""
        tail = np.cumsum(binomial(own)[::-1])[::-1]  # at least k
        need = np.clip((common + own) // 2 + 1 - np.arange(common + 1), 0, own + 1)
        return np.append(tail, 0.0)[need]

    a, b = over_half(own_a), over_half(own_b)
    return float(binomial(common) @ (a * (1 - b) + b * (1 - a)))


@functools.lru_cache
def worst_share(similarity: float) -> float:
    """The greatest differing_share() of two sets of at least that similarity, of any size."""
    worst = 0.0
    for common in range(1, MOST_COMMON):
        own = int(common * (1 - similarity) / similarity + 1e-9)
        splits = {(a, own - a) for a in range(own // 2 + 1)} | ({(0, own - 1)} if own else set())
        worst = max(worst, *(differing_share(common, a, b) for a, b in splits), 0.0)
    return worst


@functools.lru_cache
def radius_for(bits: int, share: float, missed: float = MISSED) -> int:
    """The least radius beyond which a pair of that differing share lies with at most the missed probability."""
    if not share:
        return 0
    tail = np.cumsum(binomial(bits, share)[::-1])[::-1]
    return int(np.argmax(tail <= missed)) - 1 if (tail <= missed).any() else bits


def candidate_links(distinct: DataFrame, similarity: float) -> DataFrame:
    """Links that span all pairs of sets that may be similar enough, by tiles over their long fingerprints.

    The radius comes from the exact distribution of differing bits, so small sets are found as surely as large ones.
    """
    share = worst_share(similarity)
    head = HEAD_WORDS, radius_for(64 * HEAD_WORDS, share)
    return tile_links(distinct, SET_WORDS, radius_for(64 * SET_WORDS, share), similarity, head)


def grouped_prints(docs: DataFrame, n: int, similarity: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(prints of rows, distinct sets with their first row, components (node, component) of similar sets).

    A set's first row has the least doc_id, nulls last, then the least text hash; these two name its text.
    """
    prints = stored(fingerprints(docs, n, SET_WORDS, distinct=True), "prints")
    order = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "text_hash")
    folded = prints.groupBy("fp", "pop", "size").agg(F.min(order).alias("rep"), F.count("*").alias("copies"))
    distinct = stored(folded.withColumn("node", F.monotonically_increasing_id()), "distinct")
    # texts without words are equal to each other only
    candidates = stored(components(candidate_links(distinct.filter("size > 0"), similarity)), "candidates")
    return prints, distinct, components(exact_links(docs, distinct, candidates, n, similarity))


def similar_groups(docs: DataFrame, n: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, component_id) for every row: the least doc_id among rows joined by links of sufficient similarity.

    Linked are rows whose sets of n-word shingles have a Jaccard similarity of at least similarity; rows
    without words are linked to each other. Long fingerprints of the sets find candidates by tiles; inside each
    candidate component the sets themselves decide, in blocks. Rows with a null doc_id take part; a group of only
    such rows has a null component_id.
    """
    prints, distinct, joined = grouped_prints(docs, n, similarity)
    reps = distinct.join(least_of_components(joined, distinct), "node", "left").select("fp", "size", F.coalesce("least", "rep")["doc_id"].alias("component_id"))
    return prints.join(reps, ["fp", "size"]).select("doc_id", "component_id")


def row_key(doc_id: str = "doc_id", text_hash: str = "text_hash") -> list:
    """Columns that name a row by id and text, without nulls."""
    return [F.col(doc_id).isNull().alias("_bare"), F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("_id"), F.col(text_hash).alias("_hash")]


KEY = ["_bare", "_id", "_hash"]


def exact_links(docs: DataFrame, distinct: DataFrame, candidates: DataFrame, n: int, similarity: float, block: int = 256) -> DataFrame:
    """Links (a, b) of nodes that span, within each candidate component, the pairs whose shingle sets are similar enough."""
    named = candidates.join(distinct.select("node", "rep.*"), "node").select("node", "component", *row_key())
    texts = ids_and_bytes(docs).withColumn("text_hash", F.xxhash64("text")).select("text", *row_key())
    # rows that repeat id and text are one; a node is one text
    texts = texts.join(named, KEY).dropDuplicates(["node"])
    sizes = candidates.groupBy("component").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(block))).cast("int").alias("blocks"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            shingles = [np.unique(shingle_hashes(t, n)).astype("<u8").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("component"), pa.array(shingles, pa.binary())], names=["doc_id", "component", "shingles"])

    rows = texts.select("node", "text", "component").mapInArrow(sets, "doc_id long, component long, shingles binary").join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    dealt = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("component", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "doc_id", "shingles")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        own, same = pdf.own.to_numpy(), pdf.i.iloc[0] == pdf.j.iloc[0]
        order = np.lexsort([pdf.doc_id.to_numpy(), own])
        ids, own = pdf.doc_id.to_numpy()[order], own[order]
        held = [np.frombuffer(pdf.shingles.iloc[k], "<u8") for k in order]
        size = np.array([len(h) for h in held], float)
        flat = np.concatenate(held) if held else np.zeros(0, np.uint64)
        row = np.repeat(np.arange(len(held)), size.astype(int))
        _, col, freq = np.unique(flat, return_inverse=True, return_counts=True)
        keep = freq[col] > 1
        row, col = row[keep], np.unique(col[keep], return_inverse=True)[1]
        common = np.zeros((len(held), len(held)), np.float32)
        for at in range(0, int(col.max()) + 1 if len(col) else 0, 4096):
            part = (col >= at) & (col < at + 4096)
            m = np.zeros((len(held), 4096), np.float32)
            m[row[part], col[part] - at] = 1
            common += m @ m.T
        similar = common >= similarity * (size[:, None] + size[None, :] - common) - 1e-6
        parent = list(range(len(ids)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        links = []
        for u, v in np.argwhere(np.triu(similar, 1)).tolist():
            if same or own[u] != own[v]:
                p, q = root(u), root(v)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    links.append((int(ids[u]), int(ids[v])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("component", "i", "j").applyInPandas(compare, "a long, b long")


def keep_one(docs: DataFrame, n: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of docs, all columns unchanged, without near copies: of each group the row with the least doc_id stays.

    Groups are those of similar_groups(). Null ids come last; of an id with several texts the least text hash counts, and
    of rows that repeat id and text one stays. Texts without words are copies of each other.
    """
    prints, distinct, joined = grouped_prints(docs, n, similarity)
    crowded = distinct.join(least_of_components(joined, distinct), "node", "left").filter("least is not null or copies > 1")
    stays = crowded.select("fp", "size", F.coalesce("least", "rep").alias("stays"))
    own = stored(prints.join(stays, ["fp", "size"]).select("doc_id", "text_hash", (F.col("doc_id").eqNullSafe(F.col("stays")["doc_id"]) & (F.col("text_hash") == F.col("stays")["text_hash"])).alias("first")), "crowded")
    gone = own.filter(~F.col("first")).select(*row_key()).distinct()
    repeated = own.filter("first").groupBy(*row_key()).count().filter("count > 1").drop("count")
    whole = docs.select(F.struct("*").alias("_row"))  # so that no column of docs can clash
    rows = whole.withColumn("_text_hash", F.xxhash64(F.coalesce(F.col("_row.text").cast("string"), F.lit("")).cast("binary"))).select("_row", *row_key("_row.doc_id", "_text_hash"))
    left = rows.join(gone, KEY, "left_anti")
    once = left.join(repeated, KEY, "left_anti").select("_row.*")
    again = left.join(repeated, KEY, "left_semi").groupBy(*KEY).agg(F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row")).select("_row.*")
    return once.unionByName(again)
