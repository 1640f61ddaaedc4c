"""The keyword automaton against a search of every keyword in every text."""

import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kalends.functions import automaton
from kalends.operators import lookup


def brute(texts, keys):
    return [None if t is None else next((i for i, k in enumerate(keys) if k and k in t), None) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abé日", max_size=5), max_size=12), st.lists(st.one_of(st.none(), st.text("abcé日", max_size=30)), max_size=8))
def test_first_places(keys, texts):
    assert automaton.first_places(pa.array(texts, pa.string()), tuple(keys)).to_pylist() == brute(texts, keys)


def test_many_keywords_long_texts_and_slices(monkeypatch):
    rng = random.Random(3)
    keys = ["".join(rng.choices("abcdefgh ", k=rng.randint(2, 9))) for _ in range(10_000)]
    texts = ["".join(rng.choices("abcdefghxyz ", k=rng.choice([0, 5, 40, 5000]))) for _ in range(300)]
    array = pa.array([None, *texts, None])
    want = brute([None, *texts, None], keys)
    assert automaton.first_places(array, tuple(keys)).to_pylist() == want
    assert automaton.first_places(array.slice(7, 50), tuple(keys)).to_pylist() == want[7:57]
    automaton.automata.cache_clear()
    monkeypatch.setattr(automaton, "MOST_CELLS", 1 << 16)  # in groups
    assert len(automaton.automata(tuple(keys))) > 10 and automaton.first_places(array, tuple(keys)).to_pylist() == want
    automaton.automata.cache_clear()


def test_a_keyword_across_two_pieces():
    key = "needle" * 3
    for at in range(automaton.PIECE - 20, automaton.PIECE + 3):
        assert automaton.first_places(pa.array(["x" * at + key + "y" * 3000]), ("absent", key)).to_pylist() == [1]


@pytest.mark.parametrize("bound", [lookup.MOST_KEYWORD_BYTES, 0])
def test_hinted_either_way(spark, monkeypatch, bound):
    monkeypatch.setattr(lookup, "MOST_KEYWORD_BYTES", bound)
    texts = spark.createDataFrame([(1, "The Main LIBRARY"), (2, "a farm"), (3, None), (4, ""), (5, "lib"), (6, "Main"), (7, "The Main LIBRARY")], "ingest_seq int, t string")
    rules = spark.createDataFrame([(5, "library", "L"), (3, "main lib", "M"), (9, "FARM", "F"), (9, "a", "A"), (1, "", "E"), (0, None, "N"), (7, "library", "twice")], "rank int, keyword string, out string")
    got = sorted((r["ingest_seq"], r["out"]) for r in lookup.hinted(texts, rules, "t").collect())
    assert got == [(1, "M"), (2, "A"), (6, "A"), (7, "M")]
    assert lookup.hinted(texts, rules.limit(0), "t").count() == 0


def test_with_hint_of_many_keeps_the_callers_columns(spark):
    hints = [(f"zz{i}", ["x"], None) for i in range(500)] + [("farm", ["y"], "C")]
    df = spark.createDataFrame([(1, "none", "Farm", "a", "b"), (2, "FARM", None, "a", "b"), (3, None, None, "a", "b")], "i int, t string, u string, _t0 string, _place string")
    got = lookup.with_hint(df, ["t", "u"], hints, ["keyword", "tags", "city"])
    assert got.columns == [*df.columns, "hint"]
    assert sorted((r["i"], r["_t0"], r["_place"], r["hint"] and r["hint"]["city"]) for r in got.collect()) == [(1, "a", "b", "C"), (2, "a", "b", "C"), (3, "a", "b", None)]
