"""Operator 9: approximate nearest neighbours by cross-polytope hashing.

Vectors are dealt to bands of about equal length. In a band the nearest in angle are the largest in
inner product, so hashes follow the directions: these are turned by pseudo-random rotations, rounds of
random signs and a fast Hadamard transform. A table's hash is two nearest signed axes, one in either half of the turned
vector. A query probes, in every table and band, the pairs of axes with the largest sums of its own components;
all vectors in the probed buckets are reranked by exact inner products. What share of the buckets is probed follows
from the number of vectors in the band by one formula, for the k nearest of many stand out more than those of few; a band
of no more than k vectors is probed whole, as it must be. Buckets of neighbouring first axes are
shuffled together, as many as fill a block, and a query goes to each of a table's blocks once, with the sums that its probes
reach at each share. A query that met too few vectors is compared with all. Full blocks are salted by their counted size,
queries stream past a bounded block of vectors, and each task returns each query's best only, so no pair list is ever made.

Copies: only the k + 1 smallest ids of equal vectors can be among any query's nearest, for equal
scores rank by id; the others are left out of the buckets without loss. Equal queries are searched
once.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kalends.llm.common import stored

TABLES = 16
#: The share is that of a normal distribution beyond SHARE_SLOPE * z + SHARE_START, z the quantile that k of a band's vectors exceed.
SHARE_SLOPE, SHARE_START = 0.38, 1.0
SHARES = 2.0 ** (-0.25 * np.arange(81))  # of a table's buckets, for which a query's sums are prepared
ROTATIONS = 3
SEED = 20
BAND_RATIO = 1.25  # of the lengths in a band
MOST_AXES = 256  # of either half whose sums are ordered; of more, as many at equal distances in their order
BLOCK = 4096
HELD_ROWS = 400_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, table: int) -> np.ndarray:
    signs = np.random.default_rng([SEED, table]).choice([-1.0, 1.0], (ROTATIONS, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return x


def lengths(x: np.ndarray) -> np.ndarray:
    most = np.abs(x).max(1, keepdims=True)
    return most[:, 0] * np.linalg.norm(x / most, axis=1)


def directions(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in a power of two of dimensions."""
    out = np.zeros((len(x), axes_of(x.shape[1])))
    x = x / np.abs(x).max(1, keepdims=True)
    out[:, : x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
    return out


def halves(x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Components along the signed axes of either half of the turned rows: an axis, or axis + dimensions for its negative."""
    y = rotated(directions(x), table)
    half = y.shape[1] // 2
    return tuple(np.concatenate([part, -part], 1) for part in (y[:, :half], y[:, half:]))


def buckets(x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's bucket: the nearest signed axis of either half."""
    first, second = halves(x, table)
    return first.argmax(1), second.argmax(1)


def share_level(held: int, k: int) -> int:
    """The smallest prepared share, by its number, that is at least the one due to a band of so many vectors."""
    if held <= k:
        return 0
    due = 1 - NormalDist().cdf(SHARE_SLOPE * NormalDist().inv_cdf(1 - k / held) + SHARE_START)
    return int(np.flatnonzero(SHARES >= due)[-1])


def reached(x: np.ndarray, table: int) -> np.ndarray:
    """For each row and share, the sum that the row's buckets of that share reach."""
    first, second = halves(x, table)
    some = np.unique(np.linspace(0, first.shape[1] - 1, MOST_AXES).round().astype(int)) if first.shape[1] > MOST_AXES else np.arange(first.shape[1])
    a, b = (-np.sort(-part, axis=1)[:, some] for part in (first, second))
    total = -(a[:, :, None] + b[:, None, :]).reshape(len(x), -1)
    at = np.maximum(1, np.ceil(SHARES * total.shape[1])).astype(int) - 1
    return -np.partition(total, np.unique(at), axis=1)[:, at]


def axes_of(dim: int) -> int:
    """Signed axes of either half of the turned vectors."""
    return max(1 << (dim - 1).bit_length(), 2)


def by_dimension(dims: np.ndarray, query: bool) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of equal dimension; queries few at a time, for each holds a sum per bucket."""
    for dim in np.unique(dims):
        some = np.flatnonzero(dims == dim)
        rows = max(1, (1 << 20) // min(max(dim, 2), MOST_AXES) ** 2) if query else len(some)
        for at in range(0, len(some), rows):
            yield int(dim), some[at : at + rows]


def packed(x: np.ndarray) -> list[bytes]:
    """Rows as bytes; 32-bit where that loses nothing."""
    narrow = x.astype("<f4")
    return [r.tobytes() for r in (narrow if np.array_equal(narrow, x) else x.astype("<f8"))]


def unpacked(raw: list[bytes], dim: int) -> np.ndarray:
    return np.stack([np.frombuffer(r, "<f4" if len(r) == 4 * dim else "<f8").astype(np.float64) for r in raw])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): ids and double components of the vectors that take part."""
    v = F.col(vector_col)
    good = v.isNotNull() & F.col(id_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return vectors.filter(good).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: x.cast("double") + F.lit(0.0)).alias("v"))


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, query_modulus: int = 20, tables: int = TABLES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found, ties to the smaller id.

    Queries are the rows whose id is divisible by query_modulus; a query is never its own neighbour.
    Vectors of other dimensions than the query's are no candidates. A repeated id with one vector
    counts as one row.
    """
    rows = stored(usable(vectors, id_col, vector_col).dropDuplicates(["vec_id", "v"]), "vectors")
    most = F.array_max(F.transform("v", F.abs))
    longest = rows.select(most.alias("most"), "v").agg(F.max(F.col("most") * F.sqrt(F.aggregate(F.transform("v", lambda x: x / F.col("most")), F.lit(0.0), lambda a, x: a + x * x)))).first()[0]
    if longest is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = rows.filter(F.pmod("vec_id", F.lit(query_modulus)) == 0)
    asked = queries.groupBy("v").agg(F.min("vec_id").alias("vec_id"))
    base = rows.withColumn("copy", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("copy") <= k + 1).drop("copy")

    def hashed(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    ids, v = part.column("vec_id").to_numpy(), part.column("v")
                    dims = np.diff(v.offsets.to_numpy())
                    flat, start = v.flatten().to_numpy(), np.cumsum(dims) - dims
                    for dim, some in by_dimension(dims, query):
                        x = flat[start[some][:, None] + np.arange(dim)]
                        band = np.floor(np.maximum(0, np.log(longest) - np.log(lengths(x))) / np.log(BAND_RATIO) + 1e-4).astype(np.int32)
                        for t in range(tables):
                            if query:
                                bucket, second = np.zeros(len(x), np.int32), pa.array([r.tobytes() for r in reached(x, t)], pa.binary())
                            else:
                                bucket, axis = buckets(x, t)
                                second = pa.array([int(c).to_bytes(4, "little") for c in bucket * axes_of(dim) + axis], pa.binary())
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(x), dim, np.int32)), pa.array(band), pa.array(np.full(len(x), t, np.int32)), pa.array(bucket.astype(np.int32)), second, pa.array(ids[some]), pa.array(packed(x), pa.binary())],
                                names=["dim", "band", "tab", "bucket", "second", "vec_id", "raw"],
                            )

        return run

    schema = "dim int, band int, tab int, bucket int, second binary, vec_id long, raw binary"
    key = ["dim", "band", "tab", "bucket"]
    every = stored(base.mapInArrow(hashed(False), schema), "buckets")
    bands = every.filter("tab = 0").groupBy("dim", "band").agg(F.count("*").alias("held"))  # a row per band and dimension
    axes = F.expr("cast(greatest(2, pow(2, ceil(log2(dim)))) as int)")

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("held").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("dim"), batch.column("band"), batch.column("held"), pa.array([share_level(n, k) for n in held], pa.int32())], names=["dim", "band", "held", "level"])

    bands = stored(bands.mapInArrow(levels, "dim int, band int, held long, level int").withColumn("groups", F.least(axes, F.ceil(F.col("held") / F.lit(BLOCK)).cast("int"))), "bands")
    placed = every.join(bands.drop("held"), ["dim", "band"]).withColumn("bucket", F.floor(F.col("bucket") * F.col("groups") / axes).cast("int")).drop("groups")
    sizes = placed.groupBy(*key, "level").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("salts"))  # a row per group of buckets
    held = placed.join(sizes.drop("level"), key).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.col("salts")).cast("int")).withColumn("is_query", F.lit(0)).drop("salts")
    probing = asked.mapInArrow(hashed(True), schema).drop("band", "bucket")

    def best(found: list[tuple]) -> pa.RecordBatch:
        q, v, s = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort([v, -s, q])
        q, v, s = q[order], v[order], s[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (v[1:] != v[:-1])  # a vector met in several tables has one score
        q, v, s = q[new], v[new], s[new]
        first = np.maximum.accumulate(np.where(np.r_[True, q[1:] != q[:-1]], np.arange(len(q)), 0))
        top = np.arange(len(q)) - first <= k
        return pa.RecordBatch.from_arrays([pa.array(q[top]), pa.array(v[top]), pa.array(s[top])], names=["query_id", "vec_id", "score"])

    class Block:
        """Vectors of some buckets, bucket by bucket."""

        def __init__(self, dim: int, table: int, level: int) -> None:
            self.dim, self.table, self.level, self.ids, self.raw, self.axes = dim, table, level, [], [], []

        def add(self, ids: np.ndarray, raw: list[bytes], second: list[bytes]) -> None:
            self.ids.append(ids)
            self.raw += raw
            self.axes += second

        def close(self) -> None:
            axes = np.array([int.from_bytes(a, "little") for a in self.axes])
            order = np.argsort(axes, kind="stable")
            self.every, self.v = np.concatenate(self.ids)[order], unpacked([self.raw[i] for i in order], self.dim)
            self.kinds, self.first = np.unique(axes[order], return_index=True)

        def scores(self, x: np.ndarray, second: list[bytes | None]) -> np.ndarray:
            """Inner products with the vectors in the buckets that a query probes, all where it has no sums; else less than any."""
            if second[0] is None:
                return x @ self.v.T
            first, other = halves(x, self.table)
            least = np.array([np.frombuffer(m, np.float64)[self.level] for m in second])
            met = first[:, self.kinds // axes_of(self.dim)] + other[:, self.kinds % axes_of(self.dim)] >= least[:, None] - 1e-12
            out = np.full((len(x), len(self.every)), -np.inf)
            for c, (lo, hi) in enumerate(zip(self.first, [*self.first[1:], len(self.every)])):
                asking = np.flatnonzero(met[:, c])
                out[asking, lo:hi] = x[asking] @ self.v[lo:hi].T
            return out

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block, closed, found, n = None, None, False, [], 0
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in (*key, "salt", "is_query", "mapped", "level"))))
            vec, raw, second = batch.column("vec_id").to_numpy(), batch.column("raw").to_pylist(), batch.column("second").to_pylist()
            i = 0
            while i < len(keys):
                j = i
                while j < len(keys) and keys[j] == keys[i]:
                    j += 1
                if keys[i][:5] != at:
                    at, block, closed = keys[i][:5], None, False
                if not keys[i][5]:
                    block = block or Block(at[0], at[2], keys[i][7])
                    block.add(vec[i:j], raw[i:j], second[i:j])
                elif block is not None:
                    if not closed:
                        block.close()
                        closed = True
                    most = len(block.every) - min(k + 1, len(block.every))
                    for s in range(i, j, 512):
                        e = min(j, s + 512)
                        x = unpacked(raw[s:e], at[0])
                        near = block.scores(x, second[s:e])
                        kth = np.partition(near, most, axis=1)[:, most]
                        kth = np.where(np.isfinite(kth), kth - 1e-9 * (1 + np.abs(kth)), kth)
                        u, w = np.nonzero((near >= kth[:, None]) & np.isfinite(near))
                        found.append((vec[s:e][u], block.every[w], (x[u] * block.v[w]).sum(1)))
                        n += len(u)
                    if n > HELD_ROWS:
                        found, n = [tuple(c.to_numpy() for c in best(found).columns)], 0
                        n = len(found[0][0])
                        if n > HELD_ROWS // 2:
                            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found[0]], names=["query_id", "vec_id", "score"])
                            found, n = [], 0
                i = j
        if found:
            yield best(found)

    def nearest(met: DataFrame, held: DataFrame) -> DataFrame:
        """(query_id, vec_id, score): the k + 1 nearest among held of the queries that meet a bucket."""
        asking = met.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).withColumn("is_query", F.lit(1)).drop("salts")
        together = held.unionByName(asking).withColumn("mapped", F.col("is_query").cast("boolean") & F.col("second").isNotNull())
        together = together.repartition(*key, "salt").sortWithinPartitions(*key, "salt", "is_query", "mapped", "vec_id")
        merged = together.mapInArrow(rerank, "query_id long, vec_id long, score double").distinct()
        return merged.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("place") <= k + 1).drop("place")

    top = stored(nearest(probing.join(sizes, ["dim", "tab"]), held), "nearest")
    # queries that met fewer vectors than they want and their dimension has meet all of them
    counts = top.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("found"))
    wanted = bands.groupBy("dim").agg(F.least(F.lit(k + 1), F.sum("held")).alias("wanted"))
    short = probing.filter("tab = 0").select("dim", "vec_id", F.lit(None).cast("binary").alias("second"), "raw").join(wanted, "dim").join(counts, "vec_id", "left")
    short = stored(short.filter("coalesce(found, 0) < wanted").select("dim", "vec_id", "second", "raw"), "short")
    if not short.isEmpty():
        full = nearest(short.join(sizes.filter("tab = 0"), "dim"), held.filter("tab = 0"))
        top = top.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(full)
    # one search serves all queries with its vector
    share = queries.join(asked.select("v", F.col("vec_id").alias("asked_id")), "v").select("asked_id", F.col("vec_id").alias("query_id"))
    mine = share.join(top.withColumnRenamed("query_id", "asked_id"), "asked_id").filter("vec_id <> query_id")
    return mine.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
