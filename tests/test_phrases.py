"""The phrase trie against regular expressions with lookahead, and rule outcomes written by hand."""

import random
import re

import pytest
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions import phrases
from kalends.operators import pricing, scans, scores, tags

TABLES = {kind: (list(table.values()), not_before) for kind, (table, not_before) in scans.TABLES.items()}


def soup(tables, not_before, n, seed):
    """Texts of rule words, whole phrases, exceptions and odd separators."""
    rng = random.Random(seed)
    whole = [s for table in tables for a in table for s in phrases.spellings(a)]
    shown = ["".join({r"\s": " ", r"\s+": rng.choice([" ", "  ", "\n"]), ".": rng.choice(["x", "-", " ", ""]), r"\w*": rng.choice(["", "s", "ing"]), r"\w+": "word"}.get(c, c) for c in s) for s in whole]
    words = sorted({w for t in shown for w in re.findall(r"\w+", t)}) + ["in", "for", "teens", "oaks", "grounds", "kids", "é", "日本"]
    gaps = [" ", " ", " ", " ", "  ", "-", " - ", "\n", "", ".", ", ", "'", "/", "\0", " & "]
    out = []
    for _ in range(n):
        parts = [rng.choice(shown) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randint(0, 9))]
        out.append("".join(p + rng.choice(gaps) for p in parts))
    return [*out, "", " ", "\0", "fair", "walk in", "walk-in", "nature walk in", "fair fairfield fair"]


@pytest.mark.parametrize("name", TABLES)
def test_scanner_is_the_pattern(name):
    tables, not_before = TABLES[name]
    scanner = phrases.Scanner(tuple(tuple((a, not_before.get(a)) for a in t) for t in tables))
    texts = soup(tables, not_before, 3000, 7)
    forms = [re.compile(r"\b(?:" + "|".join(a + (f"(?!{not_before[a]})" if a in not_before else "") for a in t) + r")\b") for t in tables]
    got = scanner.scan(texts)
    for text, bits in zip(texts, got.tolist()):
        want = sum(1 << k for k, form in enumerate(forms) if form.search(text))
        assert bits == want, (text, [k for k in range(63) if (bits ^ want) >> k & 1])
    assert all((got >> k & 1).any() for k in range(len(tables)))


def test_scanner_refuses_what_is_no_phrase():
    for source in (r"\$\s*\d", "a{2}", "(a)", "ab+", r"\bx"):
        with pytest.raises(ValueError):
            phrases.Scanner((((source, None),),))


def test_batches_of_long_texts(spark, monkeypatch):
    texts = ["x " * 3000 + "fair", None, "", "fair oaks", "county fair", "y " * 90_000 + "walk"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = dict(df.select("i", phrases.found_rules(F.col("t"), [["fair"], ["walk"], ["zoo"]], rules.TAG_NOT_BEFORE)).collect())
    assert got == {0: 1, 1: 0, 2: 0, 3: 0, 4: 1, 5: 2}


def tags_of(spark, texts):
    none = F.lit(None).cast("string")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", tags.derive_tags(F.col("t"), none, none, none.cast("timestamp_ntz"), none).alias("x")).collect()
    return [set(r["x"]) for r in sorted(got, key=lambda r: r["i"])]


def test_exceptions_concern_one_alternative(spark):
    """What a rule's exception forbids, another alternative of the rule still finds."""
    got = tags_of(spark, ["Nature Walk in the Woods", "Walk-in Clinic", "Walk ins welcome, a walk follows", "Fair Grounds Open Day", "Fair Oaks Mall", "Fairgrounds Open Day", "County Fair", "Fair Oaks Fair"])
    assert [("hiking" in t) for t in got[:3]] == [True, False, True]
    assert [("festival" in t) for t in got[3:]] == [False, False, True, True, True]


def test_relevance_of_single_sentences(spark):
    cases = [
        ("Bird Watch at the Pond", 0.57, ["activity:nature_outdoor_family"]), ("Bird Watching", 0.57, ["activity:nature_outdoor_family"]),
        ("Storytime at the Town Hall", 0.70, ["pos:storytime"]), ("Town Hall meeting", 0.0, ["neg:civic_admin"]), ("Town Hall discussion", 0.0, ["neg:civic_admin"]), ("A town halls tour", 0.45, []),
        ("Career Fair", 0.0, ["neg:employment"]), ("Career fair for teens", 0.45, []), ("Career fair for teens and a job fair", 0.0, ["neg:employment"]), ("Dental clinic for kids", 0.70, ["pos:children_audience"]), ("Professional networking for teachers", 0.45, []),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, title string").withColumns({"summary": F.lit(None).cast("string"), "tags": F.array().cast("array<string>"), "source_name": F.lit("x")})
    got = {r["i"]: r["relevance"] for r in scores.with_relevance(df).collect()}
    for i, (title, score, reasons) in enumerate(cases):
        assert (got[i]["score"], got[i]["reasons"]) == (score, reasons), title


def test_prices_of_single_sentences(spark):
    cases = [
        ("Members only free guests $8", "mixed_pricing"), ("Member free, non-members $5", "mixed_pricing"), ("Free with $10 purchase", "mixed_pricing"), ("Donation-based yoga", "donation_language"), ("Donation+based yoga", "unknown_no_signals"),
        ("Sliding scale fee", "donation_language"), ("Sliding+scale fee", "weak_paid_signal"), ("Fee-free entry", "free_word_only"), ("Tickets $5", "strong_paid_signal"), ("Show (ticketed)", "strong_paid_signal"), ("Costs 12 dollars", "strong_paid_signal"),
        ("Cost: free", "conflicting_free_and_paid"), ("No fee, but tickets needed", "conflicting_free_and_paid"), ("Free admission", "explicit_free_text"), ("No fee", "explicit_free_text"), ("$7", "dollar_amount"), ("A fee applies", "weak_paid_signal"), ("Feel free", "free_word_only"), ("Freedom day", "unknown_no_signals"),
        ("Ticket free admission", "conflicting_free_and_paid"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, summary string")
    got = {r["i"]: r["pricing"]["reason"] for r in pricing.with_pricing(df).collect()}
    assert [(c[0], got[i]) for i, c in enumerate(cases)] == [(c[0], c[1]) for c in cases]
