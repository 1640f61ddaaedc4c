"""Operator 6: toxicity severity by cumulative-link ordinal regression.

P(severity > k) = sigmoid(w . x - threshold_k): one weight vector serves all ordered thresholds. The
features are sparse: words and the first four and five letters of words, counted once per distinct
word. Weights are fitted with an L1 penalty on a bounded sample of labelled rows
(``sample_rows``, by a hash of the id); every document is scored whole.

Severity grades for training come from the labels: 0 for a row labelled not toxic, else 1 to 3 by
how many distinct words carry a feature that the sample's log-odds mark as toxic.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import filtered, ids_and_text, per_row, slices

SAMPLE_ROWS = 20_000
FEATURE_COUNT = 4096
MIN_DOCUMENTS = 5
LEAST_LOG_ODDS, MARKER_LOG_ODDS = 1.0, 2.5
GRADES = 3
SCORE_LIMIT, LONGEST_KEPT = 300_000, 200  # strings kept by a worker, and their length
VIRTUAL_WEIGHT = 0.05
WORD = re.compile(r"\w+")


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in (4, 5) if len(word) > n)]


def distinct_words(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


class Ordinal:
    """The fitted model; small, for its features are bounded."""

    def __init__(self, weights: dict[str, float], thresholds: np.ndarray) -> None:
        self.weights, self.thresholds = weights, thresholds

    def above(self, score: float) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(score - self.thresholds, -50, 50)))


class Scorer(dict):
    """Weight sums by raw (white-space separated, lower-case) word, in a bounded dictionary."""

    def __init__(self, model: Ordinal) -> None:
        super().__init__()
        self.model = model

    def parts(self, raw: str) -> tuple:
        return tuple((w, s) for w in WORD.findall(raw) if (s := sum(self.model.weights.get(f, 0.0) for f in word_features(w))))

    def score(self, text: str) -> float:
        raws = set(text.lower().split())
        if len(self) > SCORE_LIMIT:
            self.clear()
        hits: dict[str, float] = {}
        for raw in raws:
            found = self.get(raw)
            if found is None:
                found = self.parts(raw)
                if len(raw) <= LONGEST_KEPT:
                    self[raw] = found
            if found:
                hits.update(found)
        return float(sum(hits[w] for w in sorted(hits)))


class Likelihood:
    """The penalised cumulative-link loss of sparse rows of counted features; convex in weights and thresholds together.

    A virtual row without features, of small weight, stands for each grade, so that every threshold stays
    finite and apart from the next even where a grade has no row.
    """

    def __init__(self, x: list[list[int]], grades: np.ndarray, n_features: int, l1: float) -> None:
        self.n_rows, self.n_features, self.l1 = len(x), n_features, l1
        size = np.array([len(r) for r in x], np.int64)
        self.rows = np.repeat(np.arange(len(x)), size)
        self.cols = np.fromiter((c for r in x for c in r), np.int64, int(size.sum()))
        self.grades = np.concatenate([np.asarray(grades, np.int64), np.arange(GRADES + 1)])
        self.weight = np.concatenate([np.ones(len(x)), np.full(GRADES + 1, VIRTUAL_WEIGHT)])
        self.n = self.weight.sum()
        # a bound on the curvature of each weight: half of its mean count times the length of the rows that hold it
        self.step = 2 / np.maximum(np.bincount(self.cols, size[self.rows], n_features) / self.n, 1e-3)

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.rows, w[self.cols], self.n_rows), np.zeros(GRADES + 1)])

    def ends(self, scores: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, ...]:
        """Log-probability of each row's grade, and P(severity > k) at the grade's lower and upper end."""
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        low, high = (1 / (1 + np.exp(np.clip(edges[self.grades + k] - scores, -700, 700))) for k in (0, 1))
        width = edges[self.grades + 1] - edges[self.grades]
        # sigmoid(a) - sigmoid(b) = sigmoid(a) * (1 - sigmoid(b)) * (1 - exp(b - a)), which loses no digits
        with np.errstate(divide="ignore", invalid="ignore"):
            log_p = -np.logaddexp(0, edges[self.grades] - scores) - np.logaddexp(0, scores - edges[self.grades + 1]) + np.log(-np.expm1(-width))
        return log_p, low, high

    def loss(self, w: np.ndarray, scores: np.ndarray, t: np.ndarray) -> float:
        if not np.all(np.diff(t) > 0):
            return np.inf
        return float(-self.weight @ self.ends(scores, t)[0] / self.n + self.l1 * np.abs(w).sum())

    def slope(self, scores: np.ndarray, t: np.ndarray) -> np.ndarray:
        """d log-likelihood / d weights."""
        _, low, high = self.ends(scores, t)
        return np.bincount(self.cols, (1 - low - high)[self.rows], self.n_features) / self.n

    def moved(self, w: np.ndarray, scores: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Thresholds after a damped Newton step; never worse, for it is halved until the loss falls."""
        (_, low, high), c = self.ends(scores, t), self.weight
        slope, curve = np.zeros(GRADES), np.zeros((GRADES, GRADES))
        for k in range(GRADES):
            over, under = self.grades == k + 1, self.grades == k
            gap = [1 / np.expm1(t[j] - t[j - 1]) if 0 < j < GRADES else 0.0 for j in (k, k + 1)]
            n_over, n_under = c[over].sum(), c[under].sum()
            slope[k] = c[over] @ (1 - low[over]) + n_over * gap[1] - c[under] @ high[under] - n_under * gap[0]
            curve[k, k] = c[over] @ (low[over] * (1 - low[over])) + c[under] @ (high[under] * (1 - high[under])) + n_over * gap[1] * (1 + gap[1]) + n_under * gap[0] * (1 + gap[0])
            if k + 1 < GRADES:
                curve[k, k + 1] = curve[k + 1, k] = -n_over * gap[1] * (1 + gap[1])
        way = -np.linalg.solve(curve + 1e-9 * self.n * np.eye(GRADES), slope)
        now, pace = self.loss(w, scores, t), 1.0
        while pace > 1e-6:
            if self.loss(w, scores, t + pace * way) < now:
                return t + pace * way
            pace /= 2
        return t


def fit(x: list[list[int]], grades: np.ndarray, n_features: int, rounds: int = 600, l1: float = 4e-5) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds that minimise Likelihood; the loss never rises from round to round.

    Weights move by accelerated proximal gradient steps, each within its curvature bound; where momentum
    would raise the loss, the round falls back to a plain step, which cannot. Thresholds move by damped Newton steps.
    """
    f = Likelihood(x, grades, n_features, l1)
    share = np.bincount(f.grades, f.weight, GRADES + 1)[::-1].cumsum()[::-1][1:] / f.n  # P(severity > k), falling
    w, t = np.zeros(n_features), np.log1p(-share) - np.log(share)
    scores = f.scores(w)
    ahead, ahead_scores, pace, loss, still = w, scores, 1.0, f.loss(w, scores, t), 0

    def step(start: np.ndarray, start_scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        new = start + f.step * f.slope(start_scores, t)
        new = np.sign(new) * np.maximum(np.abs(new) - f.step * l1, 0)
        found = f.scores(new)
        return new, found, f.loss(new, found, t)

    for _ in range(rounds):
        new, new_scores, new_loss = step(ahead, ahead_scores)
        if new_loss > loss:
            pace = 1.0
            new, new_scores, new_loss = step(w, scores)
            if new_loss > loss:  # the minimum, to rounding
                new, new_scores, new_loss = w, scores, loss
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        by = (pace - 1) / faster
        ahead, ahead_scores, pace = new + by * (new - w), new_scores + by * (new_scores - scores), faster
        w, scores = new, new_scores
        t = f.moved(w, scores, t)
        before, loss = loss, f.loss(w, scores, t)
        still = still + 1 if before - loss < 1e-8 else 0
        if still == 5:
            break
    if not (np.isfinite(loss) and np.isfinite(w).all() and np.isfinite(t).all()):
        raise ArithmeticError("the ordinal fit left the finite numbers")
    return w, t


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, feature_count: int = FEATURE_COUNT) -> Ordinal:
    """Fits on the labelled rows of docs; labels with null or several values for an id are left out.

    Without any toxic row the model finds nothing toxic.
    """
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most and doc_id is not null")
    # the labels of the sample are bounded by sample_rows and broadcast; a repeated id counts once, by its least text
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = ids_and_text(docs).join(F.broadcast(marks.select("doc_id", F.col("toxic").cast("int").alias("toxic"))), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"))

    def tally(batches):
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in slices(batches):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                seen[int(bool(toxic))].update({f for w in distinct_words(text) for f in word_features(w)} | {""})
        names = list(seen[0].keys() | seen[1].keys())
        for at in range(0, len(names), 10_000):
            some = names[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), *(pa.array([seen[k][f] for f in some], pa.int64()) for k in (0, 1))], names=["feature", "clean", "toxic"])

    found = rows.mapInArrow(tally, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter(F.col("clean") + F.col("toxic") >= MIN_DOCUMENTS)
    best = found.withColumn("share", F.col("toxic") / (F.col("clean") + F.col("toxic"))).orderBy((F.col("feature") == "").desc(), (F.col("share") * F.sqrt("toxic")).desc(), "feature").limit(feature_count + 1).collect()
    total = next(((r["clean"], r["toxic"]) for r in best if r["feature"] == ""), (0, 0))
    if not total[1] or not total[0]:
        return Ordinal({}, np.array([50.0] * GRADES))
    log_odds = lambda r: np.log((r["toxic"] + 0.5) / (total[1] + 1)) - np.log((r["clean"] + 0.5) / (total[0] + 1))
    # words that toxic rows have no more often than others say nothing; without them a bare text has the base rate
    chosen = [r for r in best if r["feature"] and log_odds(r) >= LEAST_LOG_ODDS]
    names = {r["feature"]: i for i, r in enumerate(chosen)}
    odds = np.array([log_odds(r) for r in chosen])
    markers = {f for f, i in names.items() if odds[i] >= MARKER_LOG_ODDS}

    def encode(batches):
        for batch in slices(batches):
            ids, marked = [], []
            for text in batch.column("text").to_pylist():
                words = [word_features(w) for w in distinct_words(text)]
                ids.append(sorted(names[f] for fs in words for f in fs if f in names))
                marked.append(sum(any(f in markers for f in fs) for fs in words))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(ids, pa.list_(pa.int32())), pa.array(marked, pa.int32())], names=["doc_id", "toxic", "ids", "marked"])

    sample = rows.mapInArrow(encode, "doc_id long, toxic int, ids array<int>, marked int").collect()  # at most sample_rows sparse rows
    sample.sort(key=lambda r: (r["doc_id"], r["ids"]))
    grades = np.array([0 if not r["toxic"] else 1 if r["marked"] < 2 else 2 if r["marked"] < 4 else 3 for r in sample])
    w, t = fit([r["ids"] for r in sample], grades, len(chosen))
    return Ordinal({f: float(w[i]) for f, i in names.items() if w[i]}, t)


FIELDS = [("expected_severity", pa.float64()), ("severity", pa.int32()), ("p_toxic", pa.float64()), ("toxic", pa.bool_())]


def severities(docs: DataFrame, model: Ordinal) -> DataFrame:
    """Per row of docs the expected severity, the most probable grade, P(severity > 0) and the verdict.

    Null and empty texts carry no feature and get the base rate.
    """

    def make():
        scorer = Scorer(model)

        def one(text: str) -> tuple:
            above = model.above(scorer.score(text))
            p = -np.diff(np.concatenate([[1.0], above, [0.0]]))
            return float(above.sum()), int(np.argmax(p)), float(above[0]), bool(above[0] >= 0.5)

        return one

    return per_row(ids_and_text(docs), make, FIELDS, "doc_id long, expected_severity double, severity int, p_toxic double, toxic boolean")


def drop_toxic(docs: DataFrame, model: Ordinal) -> DataFrame:
    """The rows of docs, all columns unchanged, that the model does not find toxic."""
    text_at = docs.columns.index("text")

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            ok = [model.above(scorer.score(t or ""))[0] < 0.5 for t in batch.column(text_at).to_pylist()]
            yield batch.filter(pa.array(ok, pa.bool_()))

    return filtered(docs, run, {}, lambda rows: rows)
