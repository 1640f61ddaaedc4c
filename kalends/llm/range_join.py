"""Operator 13: embedding near-dedup as an exact metric range join.

Vectors are points of the unit sphere and angles between them are a metric, so pairs of a cosine of at least the threshold
lie within an angle theta. Pivots are vectors drawn from the table. A vector belongs to the cell of its nearest
pivot, to its core where it is within 2 theta of the pivot and to its rim elsewhere. It visits a part of another
cell only if a vector there can be within theta, by the triangle inequality: its angle to that pivot is within
theta of the angles that the part holds, and it is within theta of the boundary between the two cells (the plane
on which both pivots are equally near). Nothing is lost, for both are necessary for a link.

Parts of more than TILE rows are dealt to several tiles, so that a hot group is met by many tasks. Of two tiles one
is host, as parity says, so each pair of vectors is compared once. A task compares a tile's own
vectors with each other and with its visitors, and returns what each vector was linked to as a count, and a
spanning forest of the links: rows, never pairs. 32-bit products decide where they are clear of the
threshold by more than their rounding, 64-bit products elsewhere.

Equal vectors are compared once, with their number as weight. Vectors that are null, zero, or hold null or non-finite components,
and rows without an id, link with nothing; each such row is returned with its own id as component. Vectors link only with others of
their length. A repeated row is one more vector. If ids repeat, each row has its own links.

Vectors without structure are near no boundary's far side: then each visits most cells and the join costs what
comparing all tiles does, which no metric pruning helps (see README).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import stored
from kalends.llm.components import components
from kalends.llm.cross_polytope import packed, unpacked

THRESHOLD = 0.9
CELL_ROWS = 4096  # vectors for each pivot, while MOST_PIVOTS allow it
MOST_PIVOTS = 1024  # they travel with each task
TILE = 8192  # vectors that a task holds
STEP = 512  # vectors that it compares with them at once
CLEAR = 1e-4  # beyond the rounding of 32-bit products of unit vectors
SLACK = 1e-7  # in angles and products that decide visits


def numbered(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, dim, raw): the vectors that take part as bytes, equal ones equal; raw is null for the others."""
    v = F.col(vector_col)
    good = F.col(id_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(good, F.transform(v, lambda x: x.cast("double") + F.lit(0.0))).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v").to_pylist()
            raw = [None if x is None else packed(np.array([x], np.float64))[0] for x in v]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([0 if x is None else len(x) for x in v], pa.int32()), pa.array(raw, pa.binary())], names=["vec_id", "dim", "raw"])

    return rows.mapInArrow(run, "vec_id long, dim int, raw binary")


def unit(raw: list[bytes], dim: int) -> np.ndarray:
    x = unpacked(raw, dim)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


class Parts:
    """The cells' cores and rims, and which of them a vector has to meet."""

    def __init__(self, pivots: dict[int, np.ndarray], threshold: float) -> None:
        self.pivots, self.theta = pivots, math.acos(threshold)

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, core (0) or rim (1), and the cosines to all pivots; one cell where no pivot has that length."""
        pivots = self.pivots.get(x.shape[1])
        if pivots is None:
            return np.zeros(len(x), int), np.zeros(len(x), int), np.zeros((len(x), 0))
        cosines = x @ pivots.T
        cell = cosines.argmax(1)
        return cell, (angles(cosines[np.arange(len(x)), cell]) > 2 * self.theta).astype(int), cosines

    def visits(self, dim: int, cell: np.ndarray, cosines: np.ndarray, cells: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """(rows x parts): whether some vector of the part (its cell, its least and largest angle) can be linked."""
        pivots = self.pivots.get(dim)
        if pivots is None:
            return np.ones((len(cell), len(cells)), bool)
        theirs, own = cosines[:, cells], cosines[np.arange(len(cell)), cell][:, None]
        to = angles(theirs)
        near = (to >= low - self.theta - SLACK) & (to <= high + self.theta + SLACK)
        apart = np.sqrt(np.maximum(0, 2 - 2 * (pivots @ pivots.T)))[cell][:, cells]
        return near & (own - theirs <= math.sin(self.theta) * apart + SLACK)


def hosts(tile: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether another tile is the host of its pairs with this one: the smaller if the sum is odd, else the larger."""
    odd = (tile + others) % 2 == 1
    return np.where(odd, others < tile, others > tile)


class Forest:
    """Groups of a tile's vectors, merged as links are found."""

    def __init__(self, n: int) -> None:
        self.group = np.arange(n)

    def join(self, members: np.ndarray) -> None:
        met = self.group[members]
        if (met != met[0]).any():
            met = np.unique(met)
            self.group[np.isin(self.group, met)] = met[0]


def linked(x: np.ndarray, narrow_x: np.ndarray, v: np.ndarray, narrow_v: np.ndarray, threshold: float) -> np.ndarray:
    near = narrow_x @ narrow_v.T
    out = near >= threshold + CLEAR
    i, j = np.nonzero((near > threshold - CLEAR) & ~out)
    for at in range(0, len(i), 1 << 16):
        a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        out[a, b] = (x[a] * v[b]).sum(1) >= threshold
    return out


def _compare(threshold: float):
    names = ["node", "other", "n"]

    def rows(node: np.ndarray, other: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(other, pa.int64()), pa.array(n, pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, tile = None, [], None

        def close() -> tuple:
            node, weight = (np.concatenate([b.column(c).to_numpy() for b in own]) for c in ("node", "weight"))
            v = unit([r for b in own for r in b.column("raw").to_pylist()], own[0].column("dim")[0].as_py())
            tile = [node, weight.astype(np.float64), v, v.astype(np.float32), np.zeros(len(node)), Forest(len(node))]
            for lo in range(0, len(node), STEP):
                hi = min(lo + STEP, len(node))
                links = linked(v[lo:hi], tile[3][lo:hi], v, tile[3], threshold)
                links[np.arange(hi - lo), np.arange(lo, hi)] = False
                tile[4][lo:hi] += links @ tile[1]
                for i in np.flatnonzero(links.any(1)):
                    tile[5].join(np.append(np.flatnonzero(links[i]), lo + i))
            return tuple(tile)

        def flush(tile: tuple) -> pa.RecordBatch:
            node, _, _, _, found, forest = tile
            some = np.flatnonzero(found)
            return rows(node[some], node[forest.group[some]], found[some].astype(np.int64))

        for batch in batches:
            keys = np.stack([batch.column("tile").to_numpy(), batch.column("visitor").to_numpy()], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if keys[lo, 0] != at:
                    if own and tile is None:
                        tile = close()
                    if tile is not None:
                        yield flush(tile)
                    at, own, tile = keys[lo, 0], [], None
                if not keys[lo, 1]:
                    own.append(batch.slice(lo, hi - lo))
                    continue
                if tile is None and own:
                    tile, own = close(), []
                if tile is None:
                    continue  # visitors of a tile that has no vectors
                node, weight, v, narrow, found, forest = tile
                for s in range(lo, hi, STEP):
                    part = batch.slice(s, min(hi, s + STEP) - s)
                    x = unit(part.column("raw").to_pylist(), v.shape[1])
                    links = linked(x, x.astype(np.float32), v, narrow, threshold)
                    some = np.flatnonzero(links.any(1))
                    if len(some):
                        mine = links[some]
                        found += part.column("weight").to_numpy()[some] @ mine
                        for row in mine:
                            forest.join(np.flatnonzero(row))
                        yield rows(part.column("node").to_numpy()[some], node[mine.argmax(1)], (mine @ weight).astype(np.int64))
        if own and tile is None:
            tile = close()
        if tile is not None:
            yield flush(tile)

    return run


def links(points: DataFrame, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS, tile_rows: int = TILE) -> DataFrame:
    """(node, other, n): n more vectors are linked with a node; other is linked with it or reached from it.

    points has node, dim, raw and weight. A node can have several rows; one that is linked with nothing has none.
    """
    spark = points.sparkSession
    n = points.count()
    wanted = min(MOST_PIVOTS, 1 + math.ceil(n / cell_rows))
    pivots: dict[int, list[bytes]] = {}
    for r in points.select("dim", "raw").orderBy(F.xxhash64("raw"), "raw").limit(wanted).collect():  # at most MOST_PIVOTS
        pivots.setdefault(r["dim"], []).append(bytes(r["raw"]))
    parts = Parts({dim: unit(raw, dim) for dim, raw in pivots.items()}, threshold)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, raw = batch.column("dim").to_numpy(), batch.column("raw").to_pylist()
            cell, rim, angle = np.zeros(len(dims), int), np.zeros(len(dims), int), np.zeros(len(dims))
            for dim in np.unique(dims):
                some = np.flatnonzero(dims == dim)
                cell[some], rim[some], cosines = parts.home(unit([raw[i] for i in some], int(dim)))
                if cosines.shape[1]:
                    angle[some] = angles(cosines[np.arange(len(some)), cell[some]])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "dim", "raw", "weight")), pa.array(cell, pa.int32()), pa.array(rim, pa.int32()), pa.array(angle)], names=["node", "dim", "raw", "weight", "cell", "rim", "angle"])

    placed = stored(points.mapInArrow(homes, "node long, dim int, raw binary, weight long, cell int, rim int, angle double"), "cells")
    # a row for each part of each cell
    sizes = placed.groupBy("dim", "cell", "rim").agg(F.count("*").alias("held"), F.min("angle").alias("low"), F.max("angle").alias("high")).orderBy("dim", "cell", "rim").collect()
    where = {(s["dim"], s["cell"], s["rim"]): k for k, s in enumerate(sizes)}
    tiles_of = np.array([max(1, math.ceil(s["held"] / tile_rows)) for s in sizes], int)
    first = np.cumsum(tiles_of) - tiles_of
    part_of = np.repeat(np.arange(len(sizes)), tiles_of)
    tables = {dim: np.array([k for k, s in enumerate(sizes) if s["dim"] == dim]) for dim in {s["dim"] for s in sizes}}
    cells, low, high = np.array([s["cell"] for s in sizes], int), np.array([s["low"] for s in sizes]), np.array([s["high"] for s in sizes])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                dims, node = rows.column("dim").to_numpy(), rows.column("node").to_numpy()
                cell, rim, raw = rows.column("cell").to_numpy(), rows.column("rim").to_numpy(), rows.column("raw").to_pylist()
                for dim in np.unique(dims):
                    some = np.flatnonzero(dims == dim)
                    mine = np.array([where[int(dim), int(cell[i]), int(rim[i])] for i in some])
                    tile = first[mine] + (node[some] * 0x9E3779B1 >> 7) % tiles_of[mine]
                    there = tables[int(dim)]
                    _, _, cosines = parts.home(unit([raw[i] for i in some], int(dim)))
                    need = parts.visits(int(dim), cell[some], cosines, cells[there], low[there], high[there])
                    others = np.concatenate([np.arange(first[k], first[k] + tiles_of[k]) for k in there])
                    go = need[:, np.searchsorted(there, part_of[others])] & hosts(tile[:, None], others[None])
                    u, w = np.nonzero(go)
                    u, to, visitor = np.r_[np.arange(len(some)), u], np.r_[tile, others[w]], np.r_[np.zeros(len(some), bool), np.ones(len(w), bool)]
                    for lo in range(0, len(u), 8192):
                        take = pa.array(some[u[lo : lo + 8192]])
                        yield pa.RecordBatch.from_arrays([pa.array(to[lo : lo + 8192], pa.int32()), pa.array(visitor[lo : lo + 8192].astype(np.int8)), *(rows.column(c).take(take) for c in ("node", "dim", "raw", "weight"))], names=["tile", "visitor", "node", "dim", "raw", "weight"])

    if not sizes:
        return spark.createDataFrame([], "node long, other long, n long")
    together = placed.mapInArrow(dealt, "tile int, visitor byte, node long, dim int, raw binary, weight long")
    return together.repartition("tile").sortWithinPartitions("tile", "visitor", "node").mapInArrow(_compare(threshold), "node long, other long, n long")


def near_copies(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS, tile_rows: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: how many others are linked with it, the smallest id that links reach, whether that is its own."""
    rows = stored(numbered(vectors, id_col, vector_col), "vectors")
    points = rows.filter("raw is not null").groupBy("dim", "raw").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
    points = stored(points.withColumn("node", F.monotonically_increasing_id()), "points")
    found = stored(links(points.select("node", "dim", "raw", "weight"), threshold, cell_rows, tile_rows), "links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    groups = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    known = points.select("node", "least", "weight").join(counts, "node", "left").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select("node", "weight", "least", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    known = stored(known, "classes")
    lone = known.filter("weight = 1").select(F.col("least").alias("vec_id"), "n_links", "component_id")
    copied = known.filter("weight > 1").join(points.select("node", "dim", "raw"), "node")
    copied = rows.filter("raw is not null").join(copied.select("dim", "raw", "n_links", "component_id"), ["dim", "raw"]).select("vec_id", "n_links", "component_id")
    rest = rows.filter("raw is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return lone.unionByName(copied).unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
