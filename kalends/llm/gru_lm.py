"""Operator 5: a gated recurrent language model in numpy.

Corpus statistics: every training token is counted, over the whole corpus, by a partial count in
each task and one aggregation. The MODEL_WORDS most frequent words are the model's own symbols; every
other word belongs to one of GROUPS groups by its last TAIL bytes. The network predicts the group, and
inside it the word has the add-one unigram probability of the group's training tokens, with one place
more for words never seen, so the model gives every text a proper log-probability.

Encoding: one pass turns each text into 16-bit symbols and its sums of unigram logarithms; training
and scoring read these, so no text is split again.

Training: data-parallel truncated backpropagation. The training documents are dealt over the rounds
by hash, so that together the rounds learn from every training token once. In a round every task starts from
the shared parameters and lays its documents end to end over side-by-side lanes, few at first and
more later; state is carried from window to window and reset where a document starts. Tasks return
their parameters; these are averaged by tokens in two aggregations.

The output softmax is factored by classes of about equal probability. Scoring runs documents side
by side in lanes and carries each document's state across windows, so a text is scored whole.

Broadcast: the parameters and the counts of at most HOT_WORDS words, all those from a count on that a
histogram gives; both are of bounded size. Counts of all other words are joined by shuffle; none of
those words is frequent, so no key is hot.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import ids_and_bytes, slices, stored

MODEL_WORDS = 4094
GROUPS = 1024
TAIL = 3
HOT_WORDS = 1 << 18
LONGEST_HOT = 64
HIDDEN = 24
ROUNDS = 2
WINDOW = 32
FIRST_LANES, MOST_LANES, SCORE_LANES = 128, 256, 512
LANE_TOKENS = 1024  # a block of training tokens holds MOST_LANES times so many
RATE = 0.08
BATCH_TOKENS = 4_000_000
COUNT_LIMIT, COUNT_BYTES = 400_000, 128 << 20  # a task's table of words is sent on at so many words or bytes of text
BLOCK = 8192
END, OTHER = 0, 1
HELD_OUT = 2


def held_out(doc_id):
    """Whether a row is kept from learning: crc32 of the id as text, modulo 7, is 2. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == HELD_OUT


def count_tokens(docs: DataFrame) -> DataFrame:
    """(word, n) over the training rows; the end token is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        size = 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
            seen.clear()
            return out

        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                seen.update(text.lower().split())
                size += len(text)
                if len(seen) > COUNT_LIMIT or size > COUNT_BYTES:
                    yield flush()
                    size = 0
            seen[b""] += batch.num_rows
        if seen:
            yield flush()

    return docs.filter(~held_out(F.col("doc_id"))).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def hot_words(counts: DataFrame, most: int = HOT_WORDS) -> list[tuple[bytes, int]]:
    """(word, n), most frequent first, of all words that occur so often that at most so many do. A histogram gives the count."""
    some = counts.filter(F.length("word") <= LONGEST_HOT)
    step = F.floor(F.log2("n") * 16).cast("int")
    sizes = dict(some.groupBy(step.alias("step")).agg(F.count("*")).collect())  # a row per sixteenth of a doubling
    least, held = None, 0
    for k in sorted(sizes, reverse=True):
        held += sizes[k]
        if held > most:
            break
        least = k
    found = some.filter((step >= (least if least is not None else 1 << 30)) | (F.length("word") == 0)).collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in found), key=lambda wn: (-wn[1], wn[0]))


def group(word: bytes, groups: int) -> int:
    return zlib.crc32(word[-TAIL:]) % groups


def group_totals(counts: DataFrame, own: list[tuple[bytes, int]], groups: int = GROUPS) -> tuple[np.ndarray, np.ndarray]:
    """(training tokens, distinct words) of each group, without the model's own words and the end token."""
    tail = F.when(F.length("word") > TAIL, F.substring("word", -TAIL, TAIL)).otherwise(F.col("word"))
    found = counts.filter(F.length("word") > 0).groupBy((F.crc32(tail) % groups).alias("g")).agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    n, v = np.zeros(groups, np.int64), np.zeros(groups, np.int64)
    for r in found.collect():  # a row per group at most
        n[r["g"]], v[r["g"]] = r["n"], r["v"]
    for w, c in own:
        n[group(w, groups)] -= c
        v[group(w, groups)] -= 1
    return n, v


class Vocabulary:
    """Symbols and their classes: END, OTHER, a symbol per group that has training tokens, then the most frequent words.

    A class is a run of the symbols in order of frequency. other: the groups' counts; groups without training
    tokens share OTHER, and so does a single group.
    """

    def __init__(self, words: list[bytes], counts: list[int], end: int, other: int | np.ndarray) -> None:
        other = np.atleast_1d(other)
        met = np.flatnonzero(other) if len(other) > 1 else np.zeros(0, int)
        self.of = np.full(len(other), OTHER)  # a group's symbol
        self.of[met] = OTHER + 1 + np.arange(len(met))
        self.ids = {w: i + OTHER + 1 + len(met) for i, w in enumerate(words)}
        n = np.array([end, other.sum() - other[met].sum(), *other[met], *counts], float) + 1
        self.share = n / n.sum()
        order = np.argsort(-self.share, kind="stable")
        self.spot = np.empty(len(n), np.int64)  # a symbol's place in that order
        self.spot[order] = np.arange(len(n))
        limit, most = 1 / max(1.0, np.sqrt(len(n))), max(128, int(2 * np.sqrt(len(n))))
        edges, mass = [0], 0.0
        for at, s in enumerate(order.tolist()):
            mass += self.share[s]
            if mass >= limit or at + 1 - edges[-1] >= most or at + 1 == len(n):
                edges.append(at + 1)
                mass = 0.0
        self.edges = np.array(edges)
        self.klass = np.repeat(np.arange(len(edges) - 1), np.diff(self.edges))  # by place
        self.ordered = self.share[order]

    def __len__(self) -> int:
        return len(self.share)

    def start(self) -> dict[str, np.ndarray]:
        """Parameters that give the unigram distribution whatever the state; small random recurrent ones.

        x: a row per symbol of inputs to the update gate, the reset gate and the new state; h: the same of the
        state; c and o: output weights of classes and, in order of frequency, of symbols, their last column a bias.
        """
        rng, k, v = np.random.default_rng(5), HIDDEN, len(self)
        mass = np.add.reduceat(self.ordered, self.edges[:-1])
        small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        biased = lambda share: np.concatenate([np.zeros((len(share), k)), np.log(share)[:, None]], 1).astype(np.float32)
        return {"x": small(v, 3 * k), "h": small(3 * k, k), "c": biased(mass), "o": biased(self.ordered)}


LARGEST = 60.0  # logits are held below, so that no exponential overflows


def soft(h: np.ndarray, weights: np.ndarray, target: np.ndarray, starts: np.ndarray | None, kinds: np.ndarray | None) -> tuple:
    """Log-probabilities of sorted targets under a softmax over the rows of weights, with their slopes if starts and kinds are given.

    starts: where each run of equal targets begins; kinds: those targets. Slopes: d loss / d weights, d loss / d h.
    """
    a = h @ weights.T
    np.minimum(a, LARGEST, out=a)
    logit = a[np.arange(len(h)), target]
    np.exp(a, out=a)
    total = a.sum(1)
    logp = logit - np.log(total)
    if starts is None:
        return logp, None, None
    share = (1 / total)[:, None]
    slope = a.T @ (h * share)
    slope[kinds] -= np.add.reduceat(h, starts)
    dh = a @ weights
    dh *= share
    dh -= weights[target]
    return logp, slope, dh


def output(p: dict, vocab: Vocabulary, states: np.ndarray, y: np.ndarray, learn: bool = False) -> tuple[np.ndarray, np.ndarray | None, dict]:
    """Natural log-probability of each target, by class and within it; to learn, also d loss / d state and the slopes of c and o."""
    order = np.argsort(vocab.spot[y], kind="stable")
    spot = vocab.spot[y][order]
    h = np.ones((len(y), HIDDEN + 1), p["o"].dtype)
    h[:, :HIDDEN] = states[order]
    runs = lambda v: np.unique(v, return_index=True)[::-1] if learn else (None, None)
    c = vocab.klass[spot]
    logp, slope, dh = soft(h, p["c"], c, *runs(c))
    grads = {"c": slope, "o": np.zeros_like(p["o"])} if learn else {}
    cuts = np.searchsorted(spot, vocab.edges)
    for k in np.flatnonzero((np.diff(cuts) > 0) & (np.diff(vocab.edges) > 1)).tolist():
        rows, lo, hi = slice(cuts[k], cuts[k + 1]), vocab.edges[k], vocab.edges[k + 1]
        inside = spot[rows] - lo
        more, slope, back = soft(h[rows], p["o"][lo:hi], inside, *runs(inside))
        logp[rows] += more
        if learn:
            grads["o"][lo:hi] = slope
            dh[rows] += back
    unsorted = np.empty(len(y))
    unsorted[order] = logp
    if learn:
        back = np.empty_like(states)
        back[order] = dh[:, :HIDDEN]
        return unsorted, back, grads
    return unsorted, None, grads


def run_window(p: dict, x: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """Gated recurrent steps over (steps x lanes) inputs from states h (units x lanes); fresh lanes start from zero.

    (steps x units x lanes): states, states before, both gates, new states, their recurrent parts.
    """
    k, steps, lanes = HIDDEN, *x.shape
    g = np.ascontiguousarray(p["x"][x].transpose(0, 2, 1))
    gate_weights, new_weights = -p["h"][: 2 * k], p["h"][2 * k :]
    states, before, new, inner = (np.empty((steps, k, lanes), g.dtype) for _ in range(4))
    gates = np.empty((steps, 2 * k, lanes), g.dtype)
    with np.errstate(over="ignore"):
        for t in range(steps):
            s = before[t]
            s[:] = states[t - 1] if t else h
            if fresh[t].any():
                s[:, fresh[t]] = 0
            a = gates[t]
            np.matmul(gate_weights, s, out=a)
            a -= g[t, : 2 * k]
            np.exp(a, out=a)
            a += 1
            np.reciprocal(a, out=a)
            np.matmul(new_weights, s, out=inner[t])
            n = np.multiply(a[k:], inner[t], out=new[t])
            n += g[t, 2 * k :]
            np.tanh(n, out=n)
            u = np.subtract(s, n, out=states[t])
            u *= a[:k]
            u += n
    return states, before, gates, new, inner


def by_lane(v: np.ndarray) -> np.ndarray:
    """(steps x units x lanes) as a row of units per step and lane."""
    return v.transpose(0, 2, 1).reshape(-1, v.shape[1])


class Trainer:
    """AdaGrad over windows of side-by-side lanes, state carried from window to window."""

    def __init__(self, vocab: Vocabulary, parameters: dict) -> None:
        self.vocab, self.p = vocab, {k: v.copy() for k, v in parameters.items()}
        self.seen = {k: np.full_like(v, 1e-2) for k, v in self.p.items()}
        self.tokens, self.lanes = 0, FIRST_LANES

    def move(self, name: str, slope: np.ndarray, rows=slice(None)) -> None:
        slope = np.clip(slope, -1, 1)
        seen = self.seen[name][rows] + slope * slope
        self.seen[name][rows] = seen
        self.p[name][rows] -= RATE * slope / np.sqrt(seen)

    def window(self, x: np.ndarray, y: np.ndarray, fresh: np.ndarray, on: np.ndarray, h: np.ndarray) -> np.ndarray:
        """One step of learning; the loss falls on the targets y where on. Returns the last states (units x lanes)."""
        p, k, steps, lanes = self.p, HIDDEN, *x.shape
        states, before, gates, new, inner = run_window(p, x, fresh, h)
        flat, scored = by_lane(states), on.ravel()
        dflat = np.zeros_like(flat)
        _, dflat[scored], grads = output(p, self.vocab, flat[scored], y.ravel()[scored], True)
        dout = np.ascontiguousarray(dflat.reshape(steps, lanes, k).transpose(0, 2, 1))
        # what does not hang on later steps, for all steps at once
        z, r = gates[:, :k], gates[:, k:]
        dn_by, dz_by, dr_by = (1 - z) * (1 - new * new), (before - new) * z * (1 - z), inner * r * (1 - r)
        da, dn, dh, back = np.empty((steps, 3 * k, lanes), flat.dtype), np.empty_like(new), np.zeros_like(h), np.ascontiguousarray(p["h"].T)
        for t in range(steps - 1, -1, -1):
            d = np.add(dh, dout[t], out=dout[t])
            np.multiply(d, dn_by[t], out=dn[t])
            np.multiply(d, dz_by[t], out=da[t, :k])
            np.multiply(dn[t], dr_by[t], out=da[t, k : 2 * k])
            np.multiply(dn[t], r[t], out=da[t, 2 * k :])
            dh = back @ da[t]
            d *= z[t]
            dh += d
            if fresh[t].any():
                dh[:, fresh[t]] = 0
        grads["h"] = by_lane(da).T @ by_lane(before)
        da[:, 2 * k :] = dn
        order = np.argsort(x, axis=None, kind="stable")
        rows, first = np.unique(x.ravel()[order], return_index=True)
        self.move("x", np.add.reduceat(by_lane(da)[order], first) / lanes, rows)
        for name, v in grads.items():
            self.move(name, v / lanes)
        self.tokens += int(on.sum())
        return states[-1]

    def stream(self, texts: list[np.ndarray]) -> None:
        """Learns from every symbol of the texts, laid end to end over the lanes, and doubles the lanes."""
        y = np.concatenate(texts).astype(np.int64)
        fresh = np.zeros(len(y), bool)
        fresh[np.cumsum([0, *map(len, texts[:-1])])] = True
        x = np.where(fresh, END, np.r_[END, y[:-1]])
        lanes = max(1, min(self.lanes, len(y) // WINDOW))
        size = -(-len(y) // lanes)
        on = np.arange(lanes * size) < len(y)
        shape = lambda v: np.ascontiguousarray(np.concatenate([v, np.zeros(lanes * size - len(v), v.dtype)]).reshape(lanes, size).T)
        x, y, fresh, on = map(shape, (x, y, fresh, on))
        h = np.zeros((HIDDEN, lanes), np.float32)
        for t in range(0, size, WINDOW):
            some = slice(t, t + WINDOW)
            h = self.window(x[some], y[some], fresh[some], on[some], h)
        self.lanes = min(MOST_LANES, 2 * self.lanes)


def train(encoded: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Parameters learnt from encoded rows (doc_id, symbols) that are not held out, each once."""
    parameters = vocab.start()
    names = sorted(parameters)
    shapes = {n: parameters[n].shape for n in names}
    for number in range(rounds):
        shared = encoded.sparkSession.sparkContext.broadcast((vocab, parameters))
        rows = encoded.filter(~held_out(F.col("doc_id")) & (F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == number)).select("symbols")

        def run(batches: Iterator[pa.RecordBatch], number: int = number, shared=shared) -> Iterator[pa.RecordBatch]:
            vocab, start = shared.value
            trainer, held, size = Trainer(vocab, start), [], 0
            trainer.lanes = min(MOST_LANES, FIRST_LANES << number)
            for batch in slices(batches):
                for raw in batch.column("symbols").to_pylist():
                    held.append(np.frombuffer(raw, "<u2"))
                    size += len(held[-1])
                    if size >= MOST_LANES * LANE_TOKENS:
                        trainer.stream(held)
                        held, size = [], 0
            if size:
                trainer.stream(held)
            if trainer.tokens:
                flat = np.concatenate([trainer.p[n].ravel() for n in names])
                blocks = range(0, len(flat), BLOCK)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(range(len(blocks))), pa.int32()), pa.array([TaskContext.get().partitionId()] * len(blocks), pa.int32()), pa.array([float(trainer.tokens)] * len(blocks)), pa.array([flat[b : b + BLOCK].astype("<f4").tobytes() for b in blocks], pa.binary())],
                    names=["block", "part", "weight", "v"],
                )

        def mean(pdf: pd.DataFrame) -> pd.DataFrame:
            w = pdf.weight.to_numpy()
            v = sum(np.frombuffer(b, "<f4").astype(float) * k for b, k in zip(pdf.v, w)) / w.sum()
            return pd.DataFrame({"block": pdf.block.iloc[:1], "part": pdf.part.iloc[:1], "weight": [w.sum()], "v": [v.astype("<f4").tobytes()]})

        schema = "block int, part int, weight double, v binary"
        some = rows.mapInArrow(run, schema).groupBy("block", F.pmod(F.col("part"), F.lit(32)).alias("of")).applyInPandas(mean, schema)
        found = some.groupBy("block").applyInPandas(mean, schema).orderBy("block").collect()  # one model
        if found:
            flat = np.frombuffer(b"".join(r["v"] for r in found), "<f4")
            cuts = np.cumsum([0, *(int(np.prod(shapes[n])) for n in names)])
            parameters = {n: flat[a:b].reshape(shapes[n]).copy() for n, a, b in zip(names, cuts, cuts[1:])}
    return parameters


def log_likelihoods(vocab: Vocabulary, p: dict, texts: list[np.ndarray], lanes: int = SCORE_LANES) -> np.ndarray:
    """log10 probability of each symbol sequence, state carried from its first symbol to its last."""
    total = np.zeros(len(texts))
    count = min(lanes, len(texts))
    held: list[list[int]] = [[] for _ in range(count)]
    heap = [(0, k) for k in range(count)]
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        n, k = heapq.heappop(heap)
        held[k].append(i)
        heapq.heappush(heap, (n + len(texts[i]), k))
    held.sort(key=lambda own: -sum(len(texts[i]) for i in own))
    lengths = np.array([sum(len(texts[i]) for i in own) for own in held])
    streams = [np.concatenate([texts[i] for i in own]) for own in held]
    owners = [np.repeat(own, [len(texts[i]) for i in own]) for own in held]
    h, before, last = np.zeros((HIDDEN, count), np.float32), np.full(count, -1), np.zeros(count, np.int64)
    for at in range(0, int(lengths.max()) if count else 0, WINDOW):
        n = int((lengths > at).sum())  # lanes end from the right
        y, own = np.zeros((WINDOW, n), np.int64), np.full((WINDOW, n), -1, np.int64)
        for k in range(n):
            part = streams[k][at : at + WINDOW]
            y[: len(part), k], own[: len(part), k] = part, owners[k][at : at + WINDOW]
        fresh = own != np.concatenate([before[None, :n], own[:-1]])
        x = np.where(fresh, END, np.concatenate([last[None, :n], y[:-1]]))
        states = run_window(p, x, fresh, h[:, :n])[0]
        h, before, last = states[-1], own[-1], y[-1]
        on = own.ravel() >= 0
        logp = output(p, vocab, by_lane(states)[on], y.ravel()[on])[0]
        total += np.bincount(own.ravel()[on], logp, len(texts))
    return total / np.log(10)


ENCODED = "row long, doc_id long, symbols binary, n_tokens long, hot_tokens long, inside_log double, own_log double, other_log double, rare array<binary>"


def encode(rows: DataFrame, vocab: Vocabulary, known: list[tuple[bytes, int]], end: int, inside: np.ndarray | None = None) -> DataFrame:
    """ENCODED rows of (doc_id, text): symbols, sums of logarithms, and the other words that are not hot.

    Sums of log10(count + 1) over own and other hot words, and of log10(inside) over all other words' groups.
    """
    # model words by their symbol, other hot words after them
    places = vocab.ids | {w: len(vocab) + i for i, w in enumerate(w for w, _ in known if w and w not in vocab.ids)}
    logs = np.zeros(len(vocab) + len(places))
    logs[END] = np.log10(end + 1)
    for w, c in known:
        if w:
            logs[places[w]] = np.log10(c + 1)
    own = len(vocab)
    # the symbol of each place, and what its group takes off
    symbol = np.arange(len(logs), dtype=np.int64)
    for w, at in places.items():
        if at >= own:
            symbol[at] = vocab.of[group(w, len(vocab.of))]
    scale = np.zeros(own)
    if inside is not None:
        scale[vocab.of] = np.log10(inside)
    of = vocab.of
    shared = rows.sparkSession.sparkContext.broadcast((places, logs, symbol, scale))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, logs, symbol, scale = shared.value
        at = TaskContext.get().partitionId() << 33
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.binary())]
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = text.lower().split()
                place = np.fromiter(map(places.get, words, itertools.repeat(-1)), np.int32, len(words))
                other = (place < 0) | (place >= own)
                unknown = np.flatnonzero(place < 0)
                rare = [words[i] for i in unknown.tolist()]
                s = np.append(symbol[place], END).astype("<u2")
                s[unknown] = of[[group(w, len(of)) for w in rare]] if rare else []
                own_log, other_log = logs[END] + logs[place[~other]].sum(), logs[place[place >= own]].sum()
                out.append((at, doc_id, s.tobytes(), len(s), len(s) - len(rare) - (not end), float(scale[s].sum()), float(own_log), float(other_log), rare))
                at += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * len(kinds), kinds)], names=[f.split()[0] for f in ENCODED.split(", ")])

    return rows.mapInArrow(run, ENCODED)


def model_scores(encoded: DataFrame, vocab: Vocabulary, parameters: dict) -> DataFrame:
    """The encoded rows, without their symbols and words, with model: log10 probability of the symbols."""
    shared = encoded.sparkSession.sparkContext.broadcast((vocab, parameters))
    rows = encoded.drop("rare")
    names = [c for c in rows.columns if c != "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, p = shared.value
        held: list[pa.RecordBatch] = []
        texts: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            yield from pa.Table.from_batches(held).append_column("model", pa.array(log_likelihoods(vocab, p, texts))).combine_chunks().to_batches()

        for batch in slices(batches):
            new = [np.frombuffer(raw, "<u2") for raw in batch.column("symbols").to_pylist()]
            held.append(batch.select(names))
            texts += new
            size += sum(map(len, new))
            if size >= BATCH_TOKENS:
                yield from flush()
                held, texts, size = [], [], 0
        if texts:
            yield from flush()

    return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in names) + ", model double")


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per row of docs.

    Null and empty texts are one end token. With no training row at all every token is unknown.
    """
    rows = ids_and_bytes(docs)
    counts = stored(count_tokens(rows), "counts")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    known = hot_words(counts)
    own = [(w, c) for w, c in known if w][:MODEL_WORDS]
    end = next((c for w, c in known if not w), 0)
    rest_n, rest_v = group_totals(counts, own)
    vocab = Vocabulary([w for w, _ in own], [c for _, c in own], end, rest_n)
    encoded = stored(encode(rows, vocab, known, end, rest_n + rest_v + 1), "encoded")
    model = model_scores(encoded, vocab, train(encoded, vocab))
    rare = encoded.select("row", F.explode("rare").alias("word")).join(counts, "word", "left").groupBy("row").agg(F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).alias("rare_known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("rare_log"))
    full = model.join(rare, "row", "left").withColumn("all_other", F.col("other_log") + F.coalesce("rare_log", F.lit(0.0)))
    whole = float(np.log10(n + v + 1))
    return full.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("hot_tokens") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("own_log") + F.col("all_other") - F.col("n_tokens") * F.lit(whole)).alias("base_score"), (F.col("model") + F.col("all_other") - F.col("inside_log")).alias("score"),
    )
