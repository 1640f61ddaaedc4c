"""Merkle logs, max-sketch search and the metric range join against brute-force versions and SQL on small tables of odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from kalends.llm import max_sketch, merkle_log, range_join, sql

DOC = "doc_id long, text string, lang string, source string, n_chars long, tree string, leaf string, n string"


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(level):
    out = [level]
    while len(level) > 1:
        level = [hashed(*level[k : k + 2]) for k in range(0, len(level), 2)]
        out.append(level)
    return out


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        out.append([(i & 1, level[i ^ 1])] if i ^ 1 < len(level) else [])
        i >>= 1
    return out


def proofs(rows):
    f = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, n: hashed(f(r[0]), f(r[3]), f(r[2]), f(n), f(r[1]))
    trees = collections.defaultdict(list)
    for r in rows:
        trees[r[2]].append((r, leaf(r, r[4])))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for t in names:
        trees[t].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    own = {t: levels_of([h for _, h in trees[t]]) for t in names}
    top, out = levels_of([own[t][-1][0] for t in names]), []
    for a, t in enumerate(names):
        for i, (r, h) in enumerate(trees[t]):
            path = siblings(own[t], i) + siblings(top, a)
            node = leaf(r, r[4] + 1) if None not in (r[0], r[4]) and zlib.crc32(str(r[0]).encode()) % 7 == 0 else h
            for s in path:
                node = hashed(node) if not s else hashed(s[0][1], node) if s[0][0] else hashed(node, s[0][1])
            out.append((r[0], h, own[t][-1][0], top[-1][0], hashed(*(s[0][1] for s in path if s)), node, node == top[-1][0]))
    return out


def odd_rows():
    rng = random.Random(5)
    langs = [None, "", "de", "de" * 40, "e", "é", "z"]
    rows = [(rng.choice([None, i, i, i]), rng.choice([None, "", "Text é", "x" * 5000]), rng.choices(langs, [1, 1, 9, 1, 1, 1, 30])[0], rng.choice([None, "s"]), rng.choice([None, 0, 9, 99])) for i in range(300)]
    return [*rows, rows[4], rows[4], (7, "lone", "one row", None, 9)]


@pytest.mark.parametrize("span", [1, 3, 10])
def test_merkle_proofs(spark, span):
    rows = odd_rows()
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], DOC).repartition(3)
    got = [tuple(r) for r in merkle_log.prove(docs, span).collect()]
    assert collections.Counter(got) == collections.Counter(proofs(rows))
    assert {r[-1] for r in got} == {True, False}


def test_merkle_empty_and_single(spark):
    assert merkle_log.prove(spark.createDataFrame([], DOC)).count() == 0
    one = [(1, None, None, None, None)]
    assert [tuple(r) for r in merkle_log.prove(spark.createDataFrame([(*one[0], "", "", "")], DOC)).collect()] == proofs(one)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 11, 64, 65, 100])
def test_places_are_the_postorder(n):
    """A recursive walk gives nodes in the order of their places."""
    order = []

    def walk(level, i):
        if level:
            walk(level - 1, 2 * i)
            if 2 * i + 1 <= (n - 1) >> (level - 1):
                walk(level - 1, 2 * i + 1)
        order.append((level, i))

    walk(merkle_log.height(n), 0)
    assert [merkle_log.place(level, i, n) for level, i in order] == list(range(len(order)))


def test_builders_append_in_completion_order(spark):
    docs = spark.createDataFrame([(*r, "", "", "") for r in odd_rows()], DOC)
    leaves = merkle_log.numbered(merkle_log.leaf_digests(docs), "doc_id", "leaf")
    logs = merkle_log.build(leaves, 3)
    rows = [r for log in logs for r in log.collect()]
    for tree in {r["tree"] for r in rows}:
        own = sorted(r["place"] for r in rows if r["tree"] == tree)
        assert own == list(range(len(own)))
    for log in logs:
        by = collections.defaultdict(list)
        for r in log.collect():
            by[r["tree"], r["builder"]].append(r["place"])
        assert all(p == sorted(p) for p in by.values())


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, k=10):
    terms = lambda t: [x.translate(LOWER) for x in TERM.findall(t or "")]
    held = [(i, c) for i, t in docs if (c := collections.Counter(terms(t)))]
    n, total, df = len(held), sum(c.total() for _, c in held), collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 25 + 75 * c.total() * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            scores += [(-s, (i is not None, i or 0), i)] if s > 0 else []
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def search_rows():
    rng = random.Random(9)
    vocab = ["Rain", "rain", "é", "日本", "İ", "x1", "don't", "the", "a-b", "ſ", *(f"w{i}" for i in range(400))]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 5, 40, 300])))) for i in range(400)]
    docs += [(None, docs[3][1]), (1000, None), (1001, ""), (1002, "?! -"), docs[3], docs[3], (1003, "x1 " * 300_000), *((2000 - i, docs[5][1]) for i in range(50))]
    items = [(1, docs[3][1]), (2, "rain rain RAIN x1"), (3, None), (4, "!!"), (5, "never seen"), (None, docs[5][1]), (2, docs[9][1]), *((10 + i, docs[i][1]) for i in range(30))]
    return docs, items


@pytest.mark.parametrize("width", [4, 2048])
def test_search_by_sketches(spark, width):
    docs, items = search_rows()
    d = spark.createDataFrame([(*r, "clash", "clash") for r in docs], "doc_id long, text string, item string, score string").repartition(5)
    q = spark.createDataFrame([(*r, "clash") for r in items], "item_id long, text string, rank string")
    got = [tuple(r) for r in max_sketch.search(d, q, width=width).collect()]
    assert collections.Counter(got) == collections.Counter(ranked(docs, items))
    assert max_sketch.search(d.limit(0), q).count() == 0 and max_sketch.search(d, q.limit(0)).count() == 0


def test_search_in_groups(spark, monkeypatch):
    docs, items = search_rows()
    monkeypatch.setattr(max_sketch, "GROUP_ITEMS", 15)
    got = max_sketch.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(ranked(docs, items))


def test_terms_of_long_texts(monkeypatch):
    monkeypatch.setattr(max_sketch, "CHUNK", 7)
    text = ("Some wörds thatgoon andon " * 20 + "end").encode()
    assert [t for some in max_sketch.terms(text) for t in some] == text.lower().split()


def test_bounds_hold_and_spare_work():
    """No exact score is above its bound, and most documents of an item are never scored."""
    rng = random.Random(2)
    counts = [collections.Counter(f"w{rng.randint(0, 3000)}".encode() for _ in range(100)) for _ in range(256)]
    items = [[(t, 1000) for t in list(counts[j])[:20]] for j in range(40)]
    lookup = np.zeros((2048, 40), np.float32)
    for j, item in enumerate(items):
        for t, w in item:
            lookup[zlib.crc32(t) & 2047, j] += w
    bounds = max_sketch.sketches(counts, [100] * 256) @ lookup * 1.0001
    for i, c in enumerate(counts):
        for j, item in enumerate(items):
            assert sum(w * max_sketch.impact(c[t], 100) for t, w in item) <= bounds[i, j]
    board = max_sketch.Board(items, 1)
    assert board.meet(list(range(256)), counts, [100] * 256, bounds) < 0.1 * 256 * 40
    assert [-best[0][1] for best in board.best] == list(range(40))


def vectors(seed=4, n=500, dim=12):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[50:150] = x[:1] + 0.18 * rng.normal(size=(100, dim))  # a chain of partial links
    x[150:250] = x[1:2] + 0.02 * rng.normal(size=(100, dim))
    x[250:300] = x[2]
    x[300:310] = 1e-200 * x[3]
    x[310:320] = 1e200 * x[3]
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(x)]
    odd = [(900, None), (901, []), (902, [0.0] * dim), (903, [None, *[1.0] * (dim - 1)]), (904, [float("nan")] * dim), (905, [float("inf")] * dim), (906, [1.0, 0.0]), (907, [2.0, 0.1]), (908, [-0.0, 3.0])]
    return [*rows, *odd, rows[260], (5, rows[6][1]), (None, rows[6][1])]


def joined(rows, threshold=0.9):
    good = [k for k, (i, v) in enumerate(rows) if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    unit = {}
    for k in good:
        v = np.array(rows[k][1])
        v = v / np.abs(v).max()
        unit[k] = v / np.linalg.norm(v)
    near = {k: [j for j in good if j != k and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= threshold] for k in good}
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((i, len(near.get(k, [])), least, i == least))
    return collections.Counter(out)


@pytest.mark.parametrize("cells, tile", [(4096, 8192), (20, 8192), (40, 16), (10**9, 30)])
def test_range_join(spark, cells, tile):
    rows = vectors()
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<double>, node string, weight int").repartition(3)
    got = range_join.near_copies(table, cell_rows=cells, tile_rows=tile).collect()
    assert collections.Counter(map(tuple, got)) == joined(rows)
    assert range_join.near_copies(table.limit(0)).count() == 0


def test_range_join_prunes_and_loses_nothing():
    """Every pair of near vectors is compared in some cell, and clustered vectors visit few cells."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 16))
    x = np.repeat(centres, 20, 0) + 0.1 * rng.normal(size=(600, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    parts = range_join.Parts({16: x[::20]}, 0.9)
    cell, rim, cosines = parts.home(x)
    angle = range_join.angles(cosines[np.arange(600), cell])
    keys = sorted(set(zip(cell, rim)))
    low, high = (np.array([f(angle[(cell == c) & (rim == r)]) for c, r in keys]) for f in (np.min, np.max))
    need = parts.visits(16, cell, cosines, np.array([c for c, _ in keys]), low, high)
    own = np.array([keys.index(k) for k in zip(cell, rim)])
    i, j = np.nonzero(x @ x.T >= 0.9)
    assert need[i, own[j]].all() and need.mean() < 0.2


def test_sql_agrees(spark):
    """The registered SQL gives what the operators give on the odd rows."""
    con = duckdb.connect()

    def view(name, schema, rows):
        con.execute(f"create or replace table {name} ({schema})")
        con.executemany(f"insert into {name} values ({', '.join('?' * (schema.count(',') + 1))})", rows)

    docs, items = search_rows()
    view("documents", "doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint", odd_rows())
    assert collections.Counter(con.execute(sql.OP11_SQL).fetchall()) == collections.Counter(proofs(odd_rows()))
    view("documents", "doc_id bigint, text varchar", docs)
    view("benchmark", "item_id bigint, text varchar", items)
    assert collections.Counter(con.execute(sql.OP12_SQL).fetchall()) == collections.Counter(ranked(docs, items))
    rows = [r for r in vectors() if not 300 <= (r[0] or 0) < 320]
    view("embeddings", "vec_id bigint, embedding double[]", rows)
    assert collections.Counter(con.execute(sql.OP13_SQL).fetchall()) == joined(rows)
