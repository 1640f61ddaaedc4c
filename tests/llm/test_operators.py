"""Each operator against a brute-force version on a small table of odd rows: nulls, empty and long texts, ties, repeats, clashing columns."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from kalends.llm import components as comp
from kalends.llm import cross_polytope, gru_lm, packing, repair, severity, simhash, token_counts, tree_bpe, warc, weak_quality
from kalends.llm.entries import tokenizer_path

DOC = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, fp string, row string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts():
    rng = random.Random(3)
    vocab = ["the", "of", "Rain", "fällt", "auf", "x1", "don't", "!!", "ocean", "b.", "日本", "<|endoftext|>", "a-b", "señor"]
    prose = [" ".join(rng.choices(vocab, k=rng.randint(1, 120))) for _ in range(40)]
    base = " ".join(f"w{i}" for i in range(120))
    return [None, "", " ", "\n\n", "one", "a a a a a a a a a a a a a a", base, base, base + " tail", "x" * 9000, "ab" * 40000, "é\tb  c\r\n", "tok " * 3000, "L1 x\nL1 x\nL2\n\nL1 x", *prose, prose[0]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 7 else None, t, None, "s", 1, "clash", "clash", "clash") for i, t in enumerate(texts())]
    rows.append((3, texts()[3], None, "s", 1, "clash", "clash", "clash"))  # a repeated row
    return spark.createDataFrame(rows, DOC).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def pairs(docs):
    return sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(name))



def as_set(found):
    return collections.Counter(found)


def test_repair_round_trip(docs, empty):
    t = tokenizer("word_bpe_49k.json")
    want, at = [], 0
    for i, text in pairs(docs):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = [tuple(r) for r in repair.round_trip(docs, tokenizer_path("word_bpe_49k.json")).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert as_set(got) == as_set(want)
    assert repair.round_trip(empty, tokenizer_path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 5000])
def test_repair_random_access(n):
    ids = np.random.default_rng(n).integers(0, 5, n).astype("<u4")
    shard = repair.Shard(repair.dump(ids, 10))
    for a in range(0, n, max(1, n // 7)):
        assert np.array_equal(shard.ids(a, n - a), ids[a:])
    symbols, rules = repair.compress(np.zeros(1000, "<u4"), 10, min_count=2)
    assert len(symbols) < 20 and np.array_equal(repair.expand(symbols, rules, 10), np.zeros(1000))


def test_repair_leaves_no_frequent_pair():
    """A phrase of 32 ids, 40 times among many pairs that compete for slots, and a pair 30 times."""
    rng, phrase = np.random.default_rng(1), np.arange(9000, 9032)
    parts = [np.r_[rng.integers(0, 9000, 5000), phrase, [9040, 9041] if i < 30 else []] for i in range(40)]
    ids = np.concatenate(parts).astype("<u4")
    symbols, rules = repair.compress(ids, 10_000)
    pairs = collections.Counter(zip(symbols[:-1].tolist(), symbols[1:].tolist()))
    assert max(pairs.values()) < repair.MIN_COUNT == 24 and repair.expansions(rules, 10_000).max() >= 32
    assert np.array_equal(repair.expand(symbols, rules, 10_000), ids)


@pytest.mark.parametrize("base", [10, 65_530, 1 << 22])
def test_repair_long_rules_and_wide_symbols(base):
    """Long runs give rules beyond the short ones; a large vocabulary gives symbols beyond 16 bits and pairs too wide to sort in one integer."""
    ids = np.concatenate([np.full(30_000, 7), np.random.default_rng(1).integers(0, 10, 3000), np.full(20_000, 7)]).astype("<u4")
    shard = repair.Shard(repair.dump(ids, base))
    assert shard.sizes.max() > repair.SHORT_RULE and len(shard.symbols) < 4000
    for a, n in [(0, 50), (29_990, 500), (31_000, 1), (12_345, 20_000), (0, len(ids))]:
        assert np.array_equal(shard.ids(a, n), ids[a : a + n])


def brute_pairs(symbols):
    return collections.Counter(zip(symbols[:-1].tolist(), symbols[1:].tolist()))


def test_repair_rounds_choose_exactly_the_frequent_pairs():
    ids = np.random.default_rng(5).zipf(1.3, 20_000).clip(0, 400).astype(np.uint32)
    symbols, newest, known = ids, 0, 401
    while True:
        want = {p for p, n in brute_pairs(symbols).items() if n >= 24}
        symbols, pairs = repair.pair_round(symbols, newest, known, 24)
        assert {(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in pairs} == want
        if not want:
            break
        newest, known = known, known + len(pairs)


def test_warc(spark):
    html = ["<a>", "<a>", "", None, "<b>é</b>", "x" * 100_000, "<a>", "\r\n\r\nWARC/1.0", "<c>"]
    pages = spark.createDataFrame([(i, f"http://h/{i}\n", h, "clash") for i, h in enumerate(html)] + [(None, None, "<a>", "clash"), (8, "u", "<c>", "clash")], "page_id long, url string, html string, payload string")
    got = collections.defaultdict(list)
    for r in warc.archive_round_trip(pages).collect():
        got[r["page_id"]].append(r)
    keep = {}
    for i, h in enumerate(html):
        keep[h or ""] = max(keep.get(h or "", -1), i)
    for i, h in enumerate(html):
        for r in got[i]:
            raw = (h or "").encode()
            assert r["payload_bytes"] == len(raw) and r["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
            assert (r["record_type"], r["refers_to"]) == (("response", None) if keep[h or ""] == i else ("revisit", keep[h or ""]))
    assert len(got[8]) == 2 and len(got[None]) == 1
    assert warc.archive_round_trip(pages.limit(0)).count() == 0
    assert warc.ranges([(0, 10), (12, 5), (1000, 5)], gap=4) == [(0, 17, [0, 1]), (1000, 5, [2])]


def slow_posteriors(patterns, rounds=60):
    """Expectation-maximisation row by row, in plain loops; virtual votes and start as the operator documents them."""
    import math

    rows = [k for k, n in sorted(patterns.items()) for _ in range(n)]
    start = {k: 0.5 + 0.4 * ((k.count("+") > k.count("-")) - (k.count("+") < k.count("-"))) for k in patterns}
    p = dict(start)
    for _ in range(rounds):
        odds = dict.fromkeys(patterns, 0.0)
        for good in (False, True):
            mass = {k: p[k] if good else 1 - p[k] for k in patterns}
            share = (sum(mass[k] for k in rows) + 1) / (len(rows) + 2)
            for k in odds:
                odds[k] += (1 if good else -1) * math.log(share)
            for j in range(len(weak_quality.RULES)):
                table = {"0": 1.0, "+": 2.0 if good else 0.2, "-": 0.2 if good else 2.0}
                for k in rows:
                    table[k[j]] += mass[k]
                for k in odds:
                    odds[k] += (1 if good else -1) * math.log(table[k[j]] / sum(table.values()))
        p = {k: 1 / (1 + math.exp(-max(-50, min(50, o)))) for k, o in odds.items()}
    return p


def test_weak_quality(docs, empty):
    got = collections.defaultdict(list)
    for r in weak_quality.judge(docs).collect():
        got[r["doc_id"]].append(r)
    for i, text in pairs(docs):
        words = WORD.findall(text)
        grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        count = collections.Counter(grams)
        covered = {p for k, g in enumerate(grams) if count[g] > 1 for p in range(k, k + 5)}
        seen, again = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                again += line in seen
                seen.add(line)
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered))
        for r in got[i]:
            assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
            assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
            assert not (r["kept"] and r["base_failed"])
    assert weak_quality.judge(empty).count() == 0
    clashing = docs.withColumnRenamed("fp", "votes").withColumnRenamed("row", "base_failed")
    kept = weak_quality.keep_good(clashing)
    assert kept.schema == clashing.schema
    good = collections.Counter((i, r["kept"]) for i in got for r in got[i])
    assert collections.Counter(r["doc_id"] for r in kept.collect()) == {i: n for (i, k), n in good.items() if k}
    assert weak_quality.keep_good(empty).count() == 0
    patterns = {r["votes"]: r["count"] for r in weak_quality.measure(docs).groupBy("votes").count().collect()}
    slow = slow_posteriors(patterns)
    assert all(abs(r["posterior"] - slow[r["votes"]]) < 1e-6 for i in got for r in got[i])


def test_em_separates_defects():
    posterior, accuracy, good = weak_quality.expectation_maximisation({"0000000+++": 900, "0-00000000": 40, "00--000000": 40, "00000000++": 20})
    assert posterior["0000000+++"] > 0.9 > 0.1 > posterior["0-00000000"] and posterior["00000000++"] > 0.5 and good > 0.8


def test_tree_bpe(docs, empty):
    t = tokenizer("byte_bpe_50k.json")
    want = []
    for i, text in pairs(docs):
        ids = t.encode(text, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    path = tokenizer_path("byte_bpe_50k.json")
    for split in (65_536, 500):  # the second deals most texts out leaf by leaf
        got = [tuple(r) for r in tree_bpe.encode_decode(docs, path, leaf=200, split_chars=split).collect()]
        assert as_set(got) == as_set(want)
    assert tree_bpe.encode_decode(empty, path).count() == 0


def test_tree_joins_agree_with_the_library():
    tree, rng = tree_bpe.TreeEncoder(tokenizer_path("byte_bpe_50k.json"), leaf=23, unsplit=40), random.Random(1)
    alphabet = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'re", "1", "é", "日", "🙂", "!", "<|endoftext|>", "ing", "'"]
    for k in range(300):
        some = alphabet if k % 3 else ["a", "b", "th", "e", "é"]
        text = "".join(rng.choices(some, k=rng.randint(1, 600)))
        assert tree.encode(text).tolist() == tree.tokenizer.encode(text, add_special_tokens=False).ids


def test_token_counts(docs, empty):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    want = [(i, len(t.encode()), len(sp.encode(t)), len(sp.encode(t)) > 4096) for i, t in pairs(docs)]
    assert as_set(tuple(r) for r in token_counts.count_tokens(docs, path).collect()) == as_set(want)
    assert token_counts.count_tokens(empty, path).count() == 0


def test_packing(docs, empty):
    path, t = tokenizer_path("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.json")
    every = packing.pack(docs, path).collect()  # with a null id and a repeated row
    own = collections.Counter((i, len(t.encode(text, add_special_tokens=False).ids) + 1) for i, text in pairs(docs))
    tokens = collections.Counter()
    for p in every:
        tokens[p["doc_id"], p["doc_tokens"]] += p["length"]
    assert tokens == {(i, n): n * copies for (i, n), copies in own.items()} and max(own.values()) == 2
    taken = collections.defaultdict(set)
    for p in every:
        assert not taken[p["sequence_id"]] & (span := set(range(p["offset"], p["offset"] + p["length"])))
        taken[p["sequence_id"]] |= span
    assert all(s == set(range(len(s))) for s in taken.values())
    pieces = packing.pack(docs.filter("doc_id is not null").dropDuplicates(["doc_id"]), path).collect()
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    for i, text in {i: t for i, t in pairs(docs) if i is not None}.items():
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids)) and p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for held in by_seq.values():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024
    assert packing.pack(empty, path).count() == 0


def test_packing_balances_and_fills():
    lengths = np.random.default_rng(0).integers(1, 1024, 2000).tolist()
    held = packing.assign(lengths, 1024)
    assert len(held) == -(-sum(lengths) // 1024) and sum(n for s in held for _, _, n in s) == sum(lengths)


def test_gru(docs, empty, spark):
    got = {r["doc_id"]: r for r in gru_lm.score(docs.filter("doc_id is not null")).collect()}
    seen = collections.Counter()
    own = [(i, t) for i, t in pairs(docs) if i is not None]
    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    for i, t in own:
        if not out(i):
            seen.update([*t.encode().lower().split(), b""])
    n, v = sum(seen.values()), len(seen)
    for i, t in own:
        w, r = [*t.encode().lower().split(), b""], got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out(i), len(w), sum(seen[x] > 0 for x in w), n)
        assert abs(r["base_score"] - sum(np.log10((seen[x] + 1) / (n + v + 1)) for x in w)) < 1e-6 * len(w) and np.isfinite(r["score"]) and r["score"] < 0
    assert gru_lm.score(empty).count() == 0


def slow_log_likelihood(vocab, p, symbols):
    """Forward pass of one text, step by step in double precision."""
    q, k, h, last, total = {n: v.astype(float) for n, v in p.items()}, gru_lm.HIDDEN, np.zeros(gru_lm.HIDDEN), gru_lm.END, 0.0
    for y in symbols:
        g, a = q["x"][last], q["h"] @ h
        z, r = (1 / (1 + np.exp(-(g[i * k : i * k + k] + a[i * k : i * k + k]))) for i in (0, 1))
        n = np.tanh(g[2 * k :] + r * a[2 * k :])
        h, last = (1 - z) * n + z * h, y
        spot = vocab.spot[y]
        c = vocab.klass[spot]
        lo, hi = vocab.edges[c], vocab.edges[c + 1]
        for logits, at in ((q["c"] @ [*h, 1], c), (q["o"][lo:hi] @ [*h, 1], spot - lo)):
            total += logits[at] - np.log(np.exp(logits).sum())
    return total / np.log(10)


def test_gru_scores_by_brute_force(docs, spark, monkeypatch):
    """The whole score for given parameters: symbols step by step, other words by their group's training counts."""
    monkeypatch.setattr(gru_lm, "MODEL_WORDS", 5)
    monkeypatch.setattr(gru_lm, "COUNT_BYTES", 300)
    rng, used = np.random.default_rng(9), {}

    def train(encoded, vocab):
        p = {n: (v + rng.standard_normal(v.shape) * 0.1).astype(np.float32) for n, v in vocab.start().items()}
        used.update(vocab=vocab, p=p)
        return p

    monkeypatch.setattr(gru_lm, "train", train)
    texts = ["a b c a b \u00e9t\u00e9 sing ring", "A a B b singing ringing x", "", None, "unseen \u5b57\u5b57 ing", "a b c d e f g h " * 40, "long" * 50 + " a"]
    rows = [(i, texts[i % len(texts)]) for i in range(40)]
    got = {r["doc_id"]: r["score"] for r in gru_lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    split = {i: (t or "").encode().lower().split() for i, t in rows}
    seen = collections.Counter(w for i, t in split.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    vocab, group = used["vocab"], lambda w: zlib.crc32(w[-3:]) % gru_lm.GROUPS
    assert len(vocab.ids) == 5 and min(seen[w] for w in vocab.ids) >= max(n for w, n in seen.items() if w not in vocab.ids)
    inside = collections.Counter()
    for w, n in seen.items():
        if w not in vocab.ids:
            inside[group(w)] += n + 1
    for i, words in split.items():
        other = [w for w in words if w not in vocab.ids]
        symbols = [*(vocab.ids[w] if w in vocab.ids else vocab.of[group(w)] for w in words), gru_lm.END]
        want = slow_log_likelihood(vocab, used["p"], symbols) + sum(np.log10((seen[w] + 1) / (inside[group(w)] + 1)) for w in other)
        assert abs(got[i] - want) < 1e-3 * len(symbols), i


def test_counters_keep_no_long_strings():
    path = tokenizer_path("piece_bpe_32k.model")
    c = token_counts.Counter(path, *token_counts.prove_whole_tokens(path))
    text = "a " + "\u5b57" * 5000 + " b " + "x" * 200 + " " + "\u5b57" * 5000
    assert c.count(text) == c.library(text) == c.count(text)
    assert max(map(len, set(c) - c.whole)) == 200


def test_gru_is_a_distribution_and_learns():
    words = [f"w{i}".encode() for i in range(30)]
    vocab = gru_lm.Vocabulary(words, list(range(60, 30, -1)), 10, 5)
    trainer = gru_lm.Trainer(vocab, vocab.start())
    for logp in [sum(np.exp(gru_lm.output(trainer.p, vocab, np.ones((1, gru_lm.HIDDEN), np.float32), np.array([y]))[0][0]) for y in range(len(vocab)))]:
        assert abs(logp - 1) < 1e-5
    cycle = np.array([*([2, 3, 4, 5, 6] * 12), 0], np.uint16)
    before = gru_lm.log_likelihoods(vocab, trainer.p, [cycle])[0]
    for _ in range(60):
        trainer.stream([cycle] * 64)
    assert gru_lm.log_likelihoods(vocab, trainer.p, [cycle])[0] > before / 2
    long = [cycle, np.array([0], np.uint16), np.tile(cycle, 9)]
    alone = [slow_log_likelihood(vocab, trainer.p, x) for x in long]
    for lanes in (1, 2, 512):
        assert np.allclose(gru_lm.log_likelihoods(vocab, trainer.p, long, lanes=lanes), alone, rtol=1e-4)


def test_gru_slopes(monkeypatch):
    """Every parameter's slope over one window against finite differences of the loss; state is reset inside the window."""
    rng = np.random.default_rng(6)
    vocab = gru_lm.Vocabulary([b"a", b"b", b"c", b"d"], [4, 3, 2, 1], 2, 1)
    p = {n: (v + rng.standard_normal(v.shape) * 0.3).astype(np.float64) for n, v in vocab.start().items()}
    x, y = rng.integers(0, 6, (7, 3)), rng.integers(0, 6, (7, 3))
    fresh, on, h = rng.random((7, 3)) < 0.2, rng.random((7, 3)) < 0.8, rng.standard_normal((gru_lm.HIDDEN, 3))
    found = {}
    monkeypatch.setattr(gru_lm.Trainer, "move", lambda self, name, slope, rows=slice(None): found.__setitem__(name, (slope * 3, rows)))
    trainer = gru_lm.Trainer(vocab, p)
    trainer.window(x, y, fresh, on, h)

    def loss():
        states = gru_lm.run_window(p, x, fresh, h)[0]
        return -gru_lm.output(p, vocab, gru_lm.by_lane(states)[on.ravel()], y[on])[0].sum()

    for name, (slope, rows) in found.items():
        whole = np.zeros_like(p[name])
        whole[rows] = slope
        for at in zip(*(rng.integers(0, n, 12) for n in whole.shape)):
            keep, step = p[name][at], 1e-2
            p[name][at] = keep + step
            high = loss()
            p[name][at] = keep - step
            low = loss()
            p[name][at] = keep
            assert abs((high - low) / (2 * step) - whole[at]) < 2e-3 * (1 + abs(whole[at])), (name, at)


def test_gru_beats_the_unigram_base_on_held_out_texts(spark):
    """Texts from a random walk over words: what the model learnt from training texts holds for the others."""
    rng = random.Random(8)
    after = {w: rng.sample(range(60), 3) for w in range(60)}

    def walk(n):
        w, out = rng.randrange(60), []
        for _ in range(n):
            out.append(f"w{w}")
            w = rng.choice(after[w]) if rng.random() < 0.9 else rng.randrange(60)
        return " ".join(out)

    frame = spark.createDataFrame([(i, walk(rng.randint(5, 300))) for i in range(800)], "doc_id long, text string").repartition(2)
    held = gru_lm.score(frame).filter("held_out").selectExpr("sum(score) as model", "sum(base_score) as base", "sum(n_tokens) as n").first()
    assert (held["model"] - held["base"]) / held["n"] > 0.2  # log10 units a token


def test_gru_learns_from_every_text(spark, monkeypatch):
    """Each document holds a word of its own, whose input row moves if the document is learnt from; a long one fills several windows."""
    docs = spark.createDataFrame([(i, " ".join([f"d{i}"] * (3 + 40 * (i % 5)))) for i in range(200)] + [(7, "d7")], "doc_id long, text string").repartition(3)
    words = [f"d{i}" for i in range(200)]
    vocab = gru_lm.Vocabulary([w.encode() for w in words], [9] * len(words), 200, 0)
    encoded = gru_lm.encode(gru_lm.ids_and_bytes(docs), vocab, [(w.encode(), 9) for w in words], 200)
    start, rng = vocab.start(), np.random.default_rng(1)
    start |= {n: rng.standard_normal(start[n].shape).astype(np.float32) for n in ("c", "o")}  # so that the first window moves input rows as well
    monkeypatch.setattr(gru_lm.Vocabulary, "start", lambda self: start)
    moved = np.any(gru_lm.train(encoded, vocab)["x"] != start["x"], axis=1)
    learnt = {w for w in words if moved[vocab.ids[w.encode()]]}
    assert learnt == {w for w in words if zlib.crc32(w[1:].encode()) % 7 != 2}


def test_hot_words_are_bounded(spark):
    """All words from a count on, at most so many of them; the end token always."""
    counts = spark.createDataFrame([(f"w{i}".encode(), 1 + i // 10) for i in range(100)] + [(b"", 1), (b"x" * 65, 99)], "word binary, n long")
    got = gru_lm.hot_words(counts, 35)
    assert (b"", 1) in got and [w for w in got if w[0]] == sorted(((f"w{i}".encode(), 1 + i // 10) for i in range(70, 100)), key=lambda w: (-w[1], w[0]))
    assert len(gru_lm.hot_words(counts, 1000)) == 101 and gru_lm.hot_words(counts.limit(0)) == []


@pytest.mark.parametrize("share", [0.0, 0.05, 0.1, 0.3, 0.7, 1.0])
@pytest.mark.parametrize("n_features", [0, 3, 300, 4096])
@pytest.mark.parametrize("only_worst", [False, True])
def test_severity_fit_settles(share, n_features, only_worst):
    """The loss never rises, everything stays finite and ordered, and marked rows are told from plain ones; some rows have no feature."""
    rng = np.random.default_rng(int(100 * share) + n_features)
    toxic, x, grades = rng.random(1500) < share, [], []
    for y in toxic:
        marks = int(rng.integers(1, 6)) if y else 0
        own = set(rng.integers(6, n_features, rng.integers(0, 20)).tolist()) if n_features > 6 else set()
        own |= set(rng.integers(0, min(6, n_features), marks).tolist()) if n_features else set()
        x.append(sorted(own))
        grades.append(0 if not y else 3 if only_worst else min(3, marks))
    losses, loss = [], severity.Likelihood.loss
    w, t = severity.fit(x, np.array(grades), n_features, rounds=120)
    f = severity.Likelihood(x, np.array(grades), n_features, 4e-5)
    flat = np.zeros(n_features)
    start = f.moved(flat, f.scores(flat), np.array([1.0, 2.0, 3.0]))
    losses = [loss(f, flat, f.scores(flat), start), loss(f, w, f.scores(w), t)]
    assert np.isfinite(w).all() and np.isfinite(t).all() and np.all(np.diff(t) > 0) and losses[1] <= losses[0] + 1e-9
    if n_features > 6 and 0 < share < 1:
        found = np.array([w[r].sum() for r in x]) > t[0]
        assert (found & toxic).sum() >= 0.8 * toxic.sum() and (~found & ~toxic).sum() >= 0.9 * (~toxic).sum()
    if not n_features:
        assert (t[0] > 0) == (share < 0.5)


def test_severity_slopes():
    """Slopes against finite differences; thresholds where no small move betters the loss."""
    rng = np.random.default_rng(0)
    x = [sorted(set(rng.integers(0, 5, rng.integers(0, 4)).tolist())) for _ in range(60)]
    f, w, t = severity.Likelihood(x, rng.integers(0, 4, 60), 5, 0.0), rng.standard_normal(5), np.array([-0.5, 0.3, 1.2])
    at = lambda w, t: f.loss(w, f.scores(w), t)
    assert np.allclose([(at(w - e, t) - at(w + e, t)) / 2e-5 for e in np.eye(5) * 1e-5], f.slope(f.scores(w), t), atol=1e-7)
    for _ in range(30):
        t = f.moved(w, f.scores(w), t)
    assert np.allclose([(at(w, t + e) - at(w, t - e)) / 2e-5 for e in np.eye(3) * 1e-5], 0, atol=1e-7)


def test_severity_odd_rows(spark):
    """Repeated rows count alike, a very long text is read to its end, clashing columns stay, an empty table gives an empty one."""
    fair, model = "fair words here ", severity.Ordinal({"vileness": 3.0}, np.array([1.0, 2.0, 4.0]))
    rows = [(1, fair + "vileness", "a"), (1, fair + "vileness", "a"), (2, fair * 100_000 + "Vileness!", "b"), (3, "", "c"), (None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    got = sorted((r["doc_id"] or 0, r["toxic"], r["severity"]) for r in severity.severities(frame, model).collect())
    assert got == [(0, False, 0), (1, True, 2), (1, True, 2), (2, True, 2), (3, False, 0)]
    kept = severity.drop_toxic(frame, model)
    assert kept.schema == frame.schema and {r["doc_id"] for r in kept.collect()} == {3, None}
    assert severity.drop_toxic(frame.limit(0), model).count() == 0


def test_severity_sample_is_bounded(spark, monkeypatch):
    """One labelled id holds most rows, with texts of its own."""
    frame = spark.createDataFrame([(i % 40 if i < 40 else 7, f"fair words {'vileness' if i % 40 < 8 or i >= 40 else 'ocean'} n{i}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 8)) for i in range(40)], "doc_id long, toxic int")
    sizes, fit = [], severity.fit
    monkeypatch.setattr(severity, "fit", lambda rows, *a: (sizes.append(len(rows)), fit(rows, *a))[1])
    severity.train(frame, labels, sample_rows=40)
    assert sizes == [40]


def F_toxic():
    from pyspark.sql import functions as F

    return F.col("toxic").cast("int").alias("toxic")


def test_cross_polytope(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 16)).astype(np.float32) * rng.uniform(0.5, 2, (400, 1)).astype(np.float32)
    x[50:90] = x[50]
    data = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    data += [(1000, None, 0), (1020, [0.0] * 16, 0), (1040, [float("nan")] + [1.0] * 15, 0), (1060, [None] + [1.0] * 15, 0), (None, data[1][1], 0), (7, data[7][1], 0)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, rank int")
    got = collections.defaultdict(dict)
    for r in cross_polytope.search(frame).collect():
        got[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    e, hit = x.astype(float), 0
    for q in range(0, 400, 20):
        s = (e * e[q]).sum(1)
        s[q] = -np.inf
        best = np.lexsort([np.arange(400), -s])[:20]
        found = [got[q][k] for k in range(1, 21)]
        assert found == sorted(found, key=lambda f: (-f[1], f[0])) and all(np.isclose(s[i], v) for i, v in found)
        hit += len({i for i, _ in found} & set(best.tolist()))
    assert set(got) == set(range(0, 400, 20)) and hit >= 0.9 * 400
    assert cross_polytope.search(frame.limit(0)).count() == 0


@pytest.mark.parametrize("norms, k", [("outlier", 20), ("lognormal", 20), ("unit", 600)])
def test_cross_polytope_skewed_norms(spark, norms, k):
    """Recall with one very long vector or lognormal lengths, all candidates of a few vectors, and a k beyond the probed buckets."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((700, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= {"outlier": np.where(np.arange(700) == 333, 100, 1), "lognormal": np.exp(rng.standard_normal(700)), "unit": np.ones(700)}[norms][:, None]
    few = rng.standard_normal((15, 64 + 1))
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000 + i, v.tolist()) for i, v in enumerate(few)]
    got = collections.defaultdict(set)
    for r in cross_polytope.search(spark.createDataFrame(data, "vec_id long, embedding array<double>"), k=k).collect():
        got[r["query_id"]].add(r["vec_id"])
    assert got[2000] == set(range(2001, 2015))
    hit = 0
    for q in range(0, 700, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(got[q] & set(np.argsort(-s)[:k].tolist()))
        assert len(got[q]) == k
    assert hit >= 0.9 * k * 35


def given_vectors(sf):
    rows = pq.read_table(f"/root/testdata/{sf}/embeddings.parquet").to_pylist()
    return np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)


def true_nearest(ids, x, k=20):
    asked = np.flatnonzero(ids % 20 == 0)
    s = x[asked] @ x.T
    s[np.arange(len(asked)), asked] = -np.inf
    return asked, s, np.argsort(-s, axis=1, kind="stable")[:, :k]


def test_cross_polytope_probes_a_falling_share():
    """On the given tables and 10,000 random vectors the probed buckets hold 0.9 or more of the nearest; the share of all vectors in them falls as the table grows."""
    x = np.random.default_rng(3).standard_normal((10_000, 64))
    shares = []
    for ids, x in [given_vectors("sf0.001"), given_vectors("sf0.1"), (np.arange(10_000), x / np.linalg.norm(x, axis=1, keepdims=True))]:
        asked, s, top = true_nearest(ids, x)
        asked, s, top = asked[:100], s[:100], top[:100]
        level, met = cross_polytope.share_level(len(x), 20), np.zeros(s.shape, bool)
        for t in range(cross_polytope.TABLES):
            first, second = cross_polytope.buckets(x, t)
            a, b = cross_polytope.halves(x[asked], t)
            met |= a[:, first] + b[:, second] >= cross_polytope.reached(x[asked], t)[:, level][:, None]
        assert np.take_along_axis(met, top, 1).mean() >= 0.9
        shares.append(met.mean())
    assert 0.5 > shares[0] > 1.2 * shares[1] > 1.2 * 1.2 * shares[2] and shares[2] < 0.25


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_cross_polytope_recall_on_given_tables(spark, sf):
    """Hashed recall, no scan: some true neighbour of some query is missed."""
    ids, x = given_vectors(sf)
    asked, s, top = true_nearest(ids, x)
    got = collections.defaultdict(set)
    for r in cross_polytope.search(spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")).collect():
        got[r["query_id"]].add(r["vec_id"])
    hit = sum(len(got[ids[q]] & set(ids[t].tolist())) for q, t in zip(asked, top))
    assert all(len(got[ids[q]]) == 20 for q in asked) and 0.9 * 20 * len(asked) <= hit < 20 * len(asked)


def test_share_levels():
    """All of a band of k vectors is probed; the share falls with each doubling."""
    levels = [cross_polytope.share_level(n, 20) for n in (1, 20, 40, 80, 500, 2000, 10**4, 10**6, 10**9)]
    assert levels[:2] == [0, 0] and levels == sorted(levels) and len(set(levels[1:])) == 8


def test_cross_polytope_hashed_bands(spark):
    """Found neighbours have exact scores, and recall is that of the probed buckets."""
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((60, 64))
    x = np.repeat(centre, 25, axis=0) + 0.5 * rng.standard_normal((1500, 64))
    got = collections.defaultdict(list)
    for r in cross_polytope.search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hit = 0
    for q in range(0, 1500, 20):
        s = x @ x[q]
        s[q] = -np.inf
        assert [k for k, _, _ in sorted(got[q])] == list(range(1, 21)) and all(np.isclose(s[i], v) for _, i, v in got[q])
        hit += len({i for _, i, _ in got[q]} & set(np.argsort(-s)[:20].tolist()))
    assert hit >= 0.9 * 20 * 75


def brute_components(n, linked):
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_simhash(docs, empty):
    own = [(i, t) for i, t in pairs(docs) if i is not None]
    prints = []
    for _, t in own:
        w = t.encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))] if w else []
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    linked = [(a, b) for a in range(len(own)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    label = brute_components(len(own), linked)
    want = [(i, f"{p:016x}", own[c][0]) for (i, _), p, c in zip(own, prints, label)]
    got = [tuple(r) for r in simhash.near_copies(docs).collect()]
    assert as_set(g for g in got if g[0] is not None) == as_set(want)
    assert [g[2] for g in got if g[0] is None] == [None]
    assert simhash.near_copies(empty).count() == 0


def test_forest_spans_all_links():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.concatenate([base, base ^ np.uint64(1), base ^ np.uint64(0b110000)])
    pops = np.bitwise_count(fps).astype(np.int64)
    links = simhash.forest(fps[:, None], fps[:, None], pops, pops, 3, True)
    all_links = [(a, b) for a in range(120) for b in range(a) if int(fps[a] ^ fps[b]).bit_count() <= 3]
    assert brute_components(120, links) == brute_components(120, all_links) and len(links) == 80
    wide = rng.integers(0, 2**63, (60, 4), dtype=np.uint64)
    wide = np.concatenate([wide, wide ^ np.uint64(3)])
    pops = np.bitwise_count(wide[:, :2]).sum(1).astype(np.int64)
    assert sorted(simhash.forest(wide, wide, pops, pops, 8, True, head=(2, 4))) == [(i, i + 60) for i in range(60)]


def test_similar_groups_find_all_pairs(spark):
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(3000)]
    docs = []
    for g in range(12):
        words = rng.choices(vocab, k=rng.choice([40, 200, 400]))
        for c in range(6):
            w = list(words)
            for _ in range(c):
                w[rng.randrange(len(w))] = f"new{rng.random()}"
            docs.append(" ".join(w))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in docs]
    linked = [(a, b) for a in range(len(docs)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)] + [(None, docs[0], "x")], "doc_id long, text string, component string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_groups(frame).collect()}
    assert [got[i] for i in range(len(docs))] == brute_components(len(docs), linked)
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(got.values()))


def test_candidate_radius_covers_small_sets():
    """Random pairs at the least similarity, of few and many shingles, lie within the radius; strangers far beyond it."""
    rng, share = np.random.default_rng(7), simhash.worst_share(0.8)
    bits, distance = 64 * simhash.SET_WORDS, lambda a, b: int(np.bitwise_count(simhash.fingerprint(a, simhash.SET_WORDS) ^ simhash.fingerprint(b, simhash.SET_WORDS)).sum())
    radius = simhash.radius_for(bits, share)
    assert 0.15 < share < 0.2 and radius < 0.35 * bits
    for common in (4, 8, 12, 40, 200):
        for own in {(int(common / 4), 0), (int(common / 4) // 2, int(common / 4) - int(common / 4) // 2)}:
            for _ in range(60):
                h = rng.integers(0, 2**63, common + sum(own), dtype=np.uint64)
                assert distance(np.r_[h[:common], h[common : common + own[0]]], np.r_[h[:common], h[common + own[0] :]]) <= radius
                assert distance(h, rng.integers(0, 2**63, len(h), dtype=np.uint64)) > radius


def test_keep_one_goes_by_row_not_by_id(spark, empty):
    """Ids with two texts, null ids, repeated rows, texts without words, clashing columns; copies and near copies go, no other row."""
    base = [" ".join(f"{a}{i}" for i in range(60)) for a in "abcd"]
    near = base[0] + " tail"
    rows = [
        (5, base[0], 1), (7, near, 2), (7, base[1], 3),  # id 7: a near copy of 5, and a text of its own
        (None, base[2], 4), (None, base[2], 5), (None, base[3], 6),  # exact copies without ids
        (9, base[1], 7), (9, base[1], 7), (3, "", 8), (4, None, 9), (None, " ", 10), (11, "one two", 11), (12, "one two three", 12),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, component long").repartition(3)
    kept = simhash.keep_one(frame)
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    want = [(5, base[0]), (7, base[1]), (None, base[2]), (None, base[3]), (3, ""), (11, "one two"), (12, "one two three")]
    assert kept.columns == frame.columns and got == sorted(want, key=str)
    assert simhash.keep_one(empty).count() == 0 and simhash.similar_groups(empty).count() == 0


def test_components_plans_stay_small(spark, monkeypatch):
    """Each step that is written reads its links a few times; plans of two whole rounds read them 144 times."""
    leaves, stored = [], comp.stored

    def counted(df, name):
        leaves.append(df._jdf.queryExecution().analyzed().collectLeaves().size())
        return stored(df, name)

    monkeypatch.setattr(comp, "stored", counted)
    links = spark.range(40).selectExpr("id as a", "id + 1 as b").filter("a % 10 <> 9")
    got = {r["node"]: r["component"] for r in comp.components(links).collect()}
    assert got == {n: n - n % 10 for n in range(40)}
    assert max(leaves) <= 5


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (9, 9), (3, 2), (20, 10), (10, 30), (2, 1), (2, 1)], "a long, b long")
    got = {r["node"]: r["component"] for r in comp.components(links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 10: 10, 20: 10, 30: 10}


def test_pipeline_on_planted_cases(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    vocab = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in ["r", "st", "nd", "l"]]
    prose = lambda n: ". ".join(" ".join(rng.choices(vocab, k=9)) for _ in range(n)) + "."
    rows = [(i, prose(12), "en", "s", 0) for i in range(120)]
    toxic = {i for i in range(0, 120, 6)}
    rows = [(i, t.replace(". ", f" vileness{'' if i % 4 else 's'} ", 2) if i in toxic else t, *r) for i, t, *r in rows]
    rows += [(200, rows[1][1], "en", "s", 0), (201, "###$$$ " * 60, "en", "s", 0), (202, None, "en", "s", 0), (203, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs.filter("doc_id < 120").selectExpr("doc_id", "1 as quality", "int(doc_id % 6 = 0) as toxic").write.parquet(str(tmp_path / "labels.parquet"))
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    assert kept == set(range(120)) - toxic


def test_stages_keep_clashing_columns(spark):
    """Columns of the caller that are named like the stages' own, differ from them by case, hold dots or maps pass through unchanged."""
    rng = random.Random(6)
    prose = lambda: " ".join(rng.choice(["rain", "falls", "on", "the", "old", "town", "and", "people", "walk", "home", "slowly", "today"]) + rng.choice(["", "s", "ed", "ing"]) for _ in range(60)) + "."
    own = [prose() for _ in range(20)]
    rows = [(i, t, i + 100, "v", f"d{i}", {"k": i}, True, "r", "h") for i, t in enumerate([*own, own[0], own[1]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _text_hash long, VOTES string, `a.b` string, m map<string,int>, Base_Failed boolean, _row string, _hash string")
    for stage, n in ((weak_quality.keep_good, None), (lambda d: simhash.keep_one(d), 20), (lambda d: severity.drop_toxic(d, severity.Ordinal({}, np.array([50.0] * severity.GRADES))), 22)):
        kept = stage(docs)
        assert kept.columns == docs.columns
        got = sorted(tuple(r) for r in kept.collect())
        assert all(r in rows for r in got) and (n is None or len(got) == n)
    assert weak_quality.keep_good(docs).count() > 0
