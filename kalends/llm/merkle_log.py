"""Operator 11: a Merkle manifest of a dataset, kept as append logs in postorder.

Each tree (one per language, and one over their roots) is a log of node digests. Aligned builders own
2 ** SPAN consecutive nodes of a level each and append a node as soon as its last child is there, so a
log is in postorder. A node's place in it follows from subtree sizes alone: before node i of level l come
all subtrees that end before its last leaf m = (i + 1) * 2 ** l - 1, which hold 2 m - popcount(m) nodes, and
its own l lower ones on the right edge. Nodes over fewer leaves than that (the right edge of a tree
that is no power of two) follow all others, by level. Proofs are read from the log by those places: a
builder's own nodes answer for its levels, and what lies above is the same for all its leaves, so that
one path for each builder is joined, never one row for each leaf and level.

Texts are read once, by compiled code; what moves are digests. Rows without a language form a tree of
their own that comes first; rows of one language ascend by doc_id, nulls first, equal ids by digest.
Repeated rows are leaves like all others; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalends.llm.common import stored

SPAN = 10  # levels that a builder makes
TAMPER_EVERY = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: bytes) -> bytes:
    """Digests are handled as hexadecimal text."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def height(n: int) -> int:
    return (n - 1).bit_length()


def place(level: int, i: int, n: int) -> int:
    """Where the i-th node of a level stands in the log of a tree of n leaves."""
    if (i + 1) << level <= n:
        m = ((i + 1) << level) - 1
        return 2 * m - m.bit_count() + level
    return 2 * n - n.bit_count() + level - (n & -n).bit_length()


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digests(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, changed): changed is the leaf after tampering, null where nothing is tampered with."""

    def leaf(n_chars: Column) -> Column:
        return F.sha2(F.concat(*(field(n_chars if f == "n_chars" else F.col(f)) for f in FIELDS)), 256)

    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0) & F.col("n_chars").isNotNull()
    tree = F.when(F.col("lang").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("lang").cast("string")))
    return docs.select(
        tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf(F.col("n_chars").cast("long")).cast("binary").alias("leaf"),
        F.when(hit, leaf(F.col("n_chars").cast("long") + 1)).cast("binary").alias("changed"),
    )


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows with i, their number within their tree, and n, the tree's size.

    Rows are dealt by ranges and numbered inside them; what is summed up is one count for each range
    and tree. Equal rows may lie in several ranges, for they are told apart by where they were read.
    """
    rows = stored(rows, "leaves").withColumn("read_at", F.monotonically_increasing_id())
    key = ["tree", *order, "read_at"]
    dealt = stored(rows.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("at", F.monotonically_increasing_id()).drop("read_at"), "numbered")
    dealt = dealt.withColumn("part", F.shiftright("at", 33))
    counts = dealt.groupBy("tree", "part").agg(F.count("*").alias("held"), F.min("at").alias("first"))
    w = Window.partitionBy("tree")
    counts = counts.select("tree", "part", "first", F.coalesce(F.sum("held").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("held").over(w).alias("n"))
    return stored(dealt.join(counts, ["tree", "part"]).withColumn("i", F.col("before") + F.col("at") - F.col("first")).drop("part", "at", "first", "before"), "leaf-numbers")


def runs(batches: Iterator[pa.RecordBatch], *key: str) -> Iterator[pa.Table]:
    """The rows of each key; batches come sorted by it, and a builder's rows are few."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        at, keys = 0, list(zip(*(batch.column(c).to_pylist() for c in key)))
        for j in range(len(keys) + 1):
            if j == len(keys) or keys[j] != last:
                if j > at:
                    held.append(batch.slice(at, j - at))
                if j < len(keys):
                    if held:
                        yield pa.Table.from_batches(held)
                    held, last, at = [], keys[j], j
    if held:
        yield pa.Table.from_batches(held)


def _builders(base: int, span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "tree", "builder"):
            tree, n, i = (rows.column(c)[0].as_py() for c in ("tree", "n", "i"))
            top, pending, log = min(base + span, height(n)), {}, []
            for k, node in enumerate(rows.column("node").to_pylist()):
                level, at = base, i + k
                if not base:
                    log.append((level, at, node))
                while level < top and (at & 1 or at == (n - 1) >> level):  # its parent has all its children
                    node = digest(pending.pop(level), node) if at & 1 else digest(node)
                    level, at = level + 1, at >> 1
                    log.append((level, at, node))
                pending[level] = node
            if log:
                levels, ats, nodes = zip(*log)
                size, builder = len(log), rows.column("builder")[0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * size), pa.array([n] * size, pa.int64()), pa.array([builder] * size, pa.int64()), pa.array([place(*x, n) for x in zip(levels, ats)], pa.int64()),
                     pa.array(levels, pa.int32()), pa.array(ats, pa.int64()), pa.array(nodes, pa.binary())],
                    names=["tree", "n", "builder", "place", "level", "i", "node"],
                )

    return run


def _by_builder(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("tree", "builder").sortWithinPartitions("tree", "builder", *order)


def build(leaves: DataFrame, span: int = SPAN) -> list[DataFrame]:
    """The log of every tree, one table for each span levels: (tree, n, builder, place, level, i, node).

    leaves has tree, i, n and leaf. Each builder's rows are in the order in which its nodes are complete.
    """
    most = leaves.agg(F.max("n")).first()[0]
    logs, nodes = [], leaves.select("tree", "n", "i", F.col("leaf").alias("node"))
    for base in range(0, max(1, height(most or 1)), span):
        work = _by_builder(nodes.withColumn("builder", F.shiftright("i", span)), "i")
        logs.append(stored(work.mapInArrow(_builders(base, span), "tree string, n long, builder long, place long, level int, i long, node binary"), f"log-{base}"))
        nodes = logs[-1].filter((F.col("level") == base + span) & (F.col("n") > 1 << (base + span))).select("tree", "n", "i", "node")
    return logs


def roots(logs: list[DataFrame]) -> DataFrame:
    """(tree, leaf): each tree's root."""
    last = [log.filter((F.col("i") == 0) & (F.lit(2).cast("double") ** F.col("level") >= F.col("n"))) for log in logs]
    out = last[0]
    for log in last[1:]:
        out = out.unionByName(log)
    return out.select("tree", F.col("node").alias("leaf"))


class Segment:
    """A builder's part of a log, its nodes found by their places."""

    def __init__(self, n: int, base: int, span: int, places: np.ndarray, nodes: list[bytes]) -> None:
        self.n, self.base, self.places, self.nodes = n, base, places, nodes
        self.top = min(base + span, height(n))

    def path(self, i: int) -> list[bytes]:
        """For each level from base node i up: < or > (the sibling's side) and the sibling, or nothing beside a lone node."""
        out = []
        for level in range(self.base, self.top):
            beside = i ^ 1
            if beside <= (self.n - 1) >> level:
                found = self.nodes[int(np.searchsorted(self.places, place(level, beside, self.n)))]
                out.append((b"<" if i & 1 else b">") + found)
            else:
                out.append(b"")
            i >>= 1
        return out


def fold(node: bytes, path: list[bytes]) -> bytes:
    """The root that a leaf and its siblings give."""
    for beside in path:
        node = digest(node) if not beside else digest(beside[1:], node) if beside[:1] == b"<" else digest(node, beside[1:])
    return node


def _segments(batches: Iterator[pa.RecordBatch], base: int, span: int) -> Iterator[tuple[str, Segment, list[bytes], list[dict]]]:
    """Of each builder: tree, segment, the path above it, and the rows of nodes to prove."""
    for rows in runs(batches, "tree", "builder"):
        kind = rows.column("kind").to_numpy()
        log, asked = rows.filter(pa.array(kind == 1)), rows.filter(pa.array(kind == 2))
        above = next((p for p in rows.filter(pa.array(kind == 0)).column("path").to_pylist()), []) if (kind == 0).any() else []
        if asked.num_rows:
            n = asked.column("n")[0].as_py()
            order = np.argsort(log.column("place").to_numpy())
            nodes = log.column("node").to_pylist()
            yield rows.column("tree")[0].as_py(), Segment(n, base, span, log.column("place").to_numpy()[order], [nodes[k] for k in order]), above, asked.to_pylist()


def _meet(logs: list[DataFrame], group: int, asked: DataFrame, above: DataFrame, span: int) -> DataFrame:
    """A log table, what is asked of it and the paths above its builders, a builder's rows together.

    The base nodes of the upper tables stand in the table below, as its builders' last nodes.
    """
    base = group * span
    log = logs[group].select("tree", "builder", "place", "node")
    if group:
        below = logs[group - 1].filter(F.col("level") == base).select("tree", F.shiftright("i", span).alias("builder"), "place", "node")
        log = log.unionByName(below)
    rows = log.withColumn("kind", F.lit(1)).unionByName(asked.withColumn("builder", F.shiftright("i", span)).withColumn("kind", F.lit(2)), allowMissingColumns=True)
    return _by_builder(rows.unionByName(above.withColumn("kind", F.lit(0)), allowMissingColumns=True), "kind", "place")


def _paths(base: int, span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, segment, above, asked in _segments(batches, base, span):
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * len(asked)), pa.array([r["i"] for r in asked], pa.int64()), pa.array([segment.path(r["i"]) + above for r in asked], pa.list_(pa.binary()))], names=["tree", "i", "path"]
            )

    return run


def paths_above(logs: list[DataFrame], over: DataFrame | None = None, span: int = SPAN) -> DataFrame:
    """(tree, builder, path): for each builder of leaves, the siblings on the way from its top to the root.

    over holds (tree, path), the way on from each tree's root; without it paths end there.
    """
    last = len(logs) - 1
    owners = logs[0].filter("level = 0").select("tree", "n").distinct()  # a row for each tree
    groups = F.ceil(F.length(F.bin(F.col("n") - 1)) / F.lit(span)).cast("int") - 1
    start = owners.withColumn("last", F.greatest(F.lit(0), F.least(F.lit(last), groups)))
    start = start.join(over, "tree") if over is not None else start.withColumn("path", F.array().cast("array<binary>"))
    above = None
    for group in range(last, -1, -1):
        own = start.filter(F.col("last") == group).select("tree", F.lit(0).cast("long").alias("builder"), "path")
        above = own if above is None else above.unionByName(own)
        if group:
            asked = logs[group - 1].filter((F.col("level") == group * span) & (F.col("n") > 1 << (group * span))).select("tree", "n", "i")
            found = _meet(logs, group, asked, above, span).mapInArrow(_paths(group * span, span), "tree string, i long, path array<binary>")
            above = stored(found.select("tree", F.col("i").alias("builder"), "path"), f"paths-{group}")
    return above


def _proofs(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, segment, above, asked in _segments(batches, 0, span):
            paths = [segment.path(r["i"]) + above for r in asked]
            proofs = [digest(*(p[1:] for p in path)) for path in paths]
            folded = [fold(r["changed"] or r["leaf"], path) for r, path in zip(asked, paths)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["doc_id"] for r in asked], pa.int64()), *(pa.array([x.decode() for x in c]) for c in ([r["leaf"] for r in asked], [r["subroot"] for r in asked], [r["root"] for r in asked], proofs, folded))],
                names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"],
            )

    return run


def manifest(docs: DataFrame, span: int = SPAN) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """Numbered leaves, the logs of the languages' trees, and the logs of the tree over their roots."""
    leaves = numbered(leaf_digests(docs), "doc_id", "leaf")
    logs = build(leaves, span)
    tops = numbered(roots(logs).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "leaf"), "name")
    return leaves, logs, [tops, *build(tops, span)]


def prove(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    leaves, logs, (tops, *over) = manifest(docs, span)
    top_above = paths_above(over, span=span)
    found = _meet(over, 0, tops.select("tree", "i", "n"), top_above, span).mapInArrow(_paths(0, span), "tree string, i long, path array<binary>")
    onward = stored(found.join(tops.select("i", "name"), "i").select(F.col("name").alias("tree"), "path"), "paths-over")
    root = roots(over).select(F.col("leaf").alias("root"))  # one row
    ends = tops.select(F.col("name").alias("tree"), F.col("leaf").alias("subroot")).join(F.broadcast(root))  # a row for each tree
    asked = leaves.join(ends, "tree").select("tree", "i", "n", "doc_id", "leaf", "changed", "subroot", "root")
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return _meet(logs, 0, asked, paths_above(logs, onward, span), span).mapInArrow(_proofs(span), schema).withColumn("verified", F.col("folded_root") == F.col("root"))
