"""Operator 3: quality rules under weak supervision.

Each rule looks at a document and votes good, votes bad or abstains. Expectation-maximisation over
the counts of vote patterns (a table of at most 3 to the number of rules, whatever the corpus)
estimates each rule's accuracy and the share of good documents; the posterior probability of good
quality then decides, in place of requiring that every rule pass.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import filtered, ids_and_bytes, per_row, slices, stored

SYMBOLS = b"#*$%&|<>"
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_letters", "n_bangs", "n_stops"]

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_UPPER = slice(ord("A"), ord("Z") + 1)
_LOWER = slice(ord("a"), ord("z") + 1)
WINDOW = 5


def repeated_words(codes: np.ndarray) -> int:
    """Words that lie in a five-word window found twice or more; equal words have equal codes below len(codes)."""
    n = len(codes)
    if n <= WINDOW:
        return 0
    if n <= 6000:  # five codes fit one 64-bit integer
        key = codes[: n - 4]
        for i in range(1, WINDOW):
            key = key * n + codes[i : n - 4 + i]
    else:
        two = np.unique(codes[:-1] * n + codes[1:], return_inverse=True)[1]
        four = np.unique(two[:-2] * n + two[2:], return_inverse=True)[1]
        key = four[: n - 4] * n + codes[4:]
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(key, twice))
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def features(text: bytes) -> tuple[int, ...]:
    """FEATURES of a text, words being runs of anything but ASCII white space."""
    words = text.split()
    n = len(words)
    first: dict[bytes, int] = {}
    codes = np.fromiter(map(first.setdefault, words, range(n)), np.int64, n)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = int(counts.sum() - counts[0x80:0xC0].sum() - counts[_SPACE].sum())
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    return (
        n, chars, int(counts[list(SYMBOLS)].sum()), len(lines) - len(set(lines)),
        repeated_words(codes) if len(first) < n else 0, len(lines), len(first), int(counts[_UPPER].sum()),
        int(counts[_UPPER].sum() + counts[_LOWER].sum() + counts[0xC0:].sum()), int(counts[ord("!")]), int(counts[[ord(c) for c in ".,;:?"]].sum()),
    )


Row = dict[str, float]
#: (name, vote): 1 good, -1 bad, 0 abstains. Rules for one defect abstain where they don't see it.
RULES: list[tuple[str, Callable[[Row], int]]] = [
    ("tiny", lambda r: -1 if r["n_words"] < 10 else 0),
    ("symbols", lambda r: -1 if r["n_symbols"] > 0.04 * r["word_chars"] else 0),
    ("shouting", lambda r: -1 if r["n_letters"] >= 20 and r["n_upper"] > 0.4 * r["n_letters"] else 0),
    ("exclaiming", lambda r: -1 if r["n_bangs"] > 0.2 * r["n_words"] else 0),
    ("repetition", lambda r: -1 if r["n_repeat_words"] > 0.2 * r["n_words"] else 0),
    ("monotony", lambda r: -1 if 30 <= r["n_words"] <= 2000 and r["n_distinct"] < 0.3 * r["n_words"] else 0),
    ("repeated_lines", lambda r: -1 if r["n_lines"] >= 3 and r["n_dup_lines"] > 0.5 * r["n_lines"] else 0),
    ("varied", lambda r: 1 if r["n_words"] >= 10 and r["n_repeat_words"] <= 0.1 * r["n_words"] and r["n_distinct"] >= min(0.4 * r["n_words"], 120) and r["n_symbols"] <= 0.02 * r["word_chars"] else 0),
    ("calm", lambda r: 1 if r["n_words"] >= 10 and r["n_upper"] <= 0.2 * r["n_letters"] and r["n_bangs"] <= 0.1 * r["n_words"] and r["n_symbols"] <= 0.02 * r["word_chars"] else 0),
    ("sentences", lambda r: 1 if 0.01 * r["n_words"] <= r["n_stops"] <= 0.6 * r["n_words"] and r["n_bangs"] <= 0.1 * r["n_words"] and r["n_symbols"] <= 0.02 * r["word_chars"] and r["n_repeat_words"] <= 0.2 * r["n_words"] else 0),
]


def votes(found: tuple[int, ...]) -> str:
    """One character for each rule: + good, - bad, 0 abstains."""
    row = dict(zip(FEATURES, found))
    return "".join("0+-"[rule(row)] for _, rule in RULES)


def expectation_maximisation(patterns: dict[str, int], rounds: int = 60) -> tuple[dict[str, float], np.ndarray, float]:
    """Posterior probability of good quality by pattern, the rules' accuracies, the share of good documents.

    For either class each rule votes good, votes bad or abstains with probabilities of its own; a
    rule's accuracy is the share of its votes that agree with the posterior class. The start is the
    majority of votes (ties at one half), and a few virtual votes on the side of each rule's purpose
    keep the classes from changing places.
    """
    if not patterns:
        return {}, np.full(len(RULES), 0.5), 0.5
    keys = sorted(patterns)
    v = np.array([[{"0": 0, "+": 1, "-": -1}[c] for c in k] for k in keys])
    n = np.array([patterns[k] for k in keys], float)
    cast = np.stack([v == 0, v > 0, v < 0], 2).astype(float)
    virtual = np.array([[1.0, 0.2, 2.0], [1.0, 2.0, 0.2]])  # class bad, good: abstains, good, bad
    p = 0.5 + 0.4 * np.sign(v.sum(1))
    for _ in range(rounds):
        odds = np.zeros(len(keys))
        share = [(n @ (1 - p) + 1) / (n.sum() + 2), (n @ p + 1) / (n.sum() + 2)]
        for c, sign in ((0, -1), (1, 1)):
            table = np.einsum("i,ijk->jk", n * (p if c else 1 - p), cast) + virtual[c]
            table /= table.sum(1, keepdims=True)
            odds += sign * (np.log(share[c]) + np.einsum("ijk,jk->i", cast, np.log(table)))
        p = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    right = (n[:, None] * np.where(v > 0, p[:, None], 1 - p[:, None]) * (v != 0)).sum(0)
    return dict(zip(keys, p.tolist())), (right + 1) / ((n[:, None] * (v != 0)).sum(0) + 2), float(share[1])


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, features, votes), one row per row of docs; null texts have no words."""

    def make():
        def one(text: bytes) -> tuple:
            found = features(text)
            return (*found, votes(found))

        return one

    return per_row(ids_and_bytes(docs), make, [*((f, pa.int64()) for f in FEATURES), ("votes", pa.string())], "doc_id long, " + ", ".join(f"{f} long" for f in FEATURES) + ", votes string")


def posteriors(measured: DataFrame, column: str = "votes") -> DataFrame:
    """(votes, posterior): a row per vote pattern, at most 3 to the number of rules; patterns are counted over all rows first."""
    patterns = {r["votes"]: r["count"] for r in measured.groupBy(F.col(column).alias("votes")).count().collect()}
    posterior, _, _ = expectation_maximisation(patterns)
    return measured.sparkSession.createDataFrame(sorted(posterior.items()), "votes string, posterior double")


BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def fails_base(found: tuple[int, ...]) -> bool:
    n, repeats = found[FEATURES.index("n_words")], found[FEATURES.index("n_repeat_words")]
    return n < 10 or 100 * repeats > 20 * n


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per document the features, base_failed, the posterior and the verdict.

    Empty and null texts fail the base rule. Equal texts get equal verdicts.
    """
    measured = stored(measure(docs), "quality")
    judged = measured.join(F.broadcast(posteriors(measured)), "votes", "left")  # a bounded table
    return judged.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all columns unchanged, that judge() keeps. Each text is looked at once: rows are stored beside their votes."""
    text_at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for part in slices([batch]):
                found = [features((t or "").encode("utf-8", "replace")) for t in part.column(text_at).to_pylist()]
                bad = [fails_base(f) for f in found]
                yield part.append_column("votes", pa.array([votes(f) for f in found], pa.string())).append_column("base_failed", pa.array(bad, pa.bool_()))

    def judged(rows: DataFrame) -> DataFrame:
        voted = stored(rows, "voted")
        good = posteriors(voted).filter(F.col("posterior") >= threshold).select("votes")
        return voted.filter(~F.col("base_failed")).join(F.broadcast(good), "votes", "left_semi")  # a bounded table

    return filtered(docs, run, {"votes": "string", "base_failed": "boolean"}, judged)
