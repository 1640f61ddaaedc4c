"""The data source, counters while writing, increments and shared links against plain forms."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from kalends.functions.store import scratch, stored
from kalends.operators.candidates import outlier_urls
from kalends.operators.dedupe import deduplicate
from kalends.operators.filters import upcoming
from kalends.operators.normalise import normalise
from kalends.plans import counted, delta
from kalends.sources import ledger, records
from kalends.streaming import increments, shared_links

# ---- event records


def told(df):
    return sorted(((r["position"], r["event"], r["bad"]) for r in df.collect()), key=str)


@pytest.mark.parametrize(
    ("text", "events"),
    [
        ('[{"a": 1}, 2, "x", null]', ['{"a": 1}', "2", '"x"', "null"]), ('{"events": [{"a": 1}], "week": 3}', ['{"a": 1}']), ("[]", []), ('{"events": []}', []),
        ('{"a": 1}', None), ('{"events": {"a": 1}}', None), ("3", None), ("{broken", None), ("[NaN]", None), ("[" * 100_000, None), ('["\\ud800"]', ['"\\ud800"']), ('["é"]', ['"é"']),
    ],
)
def test_documents(text, events):
    assert records.events_of(text) == events


def test_every_split_reads_every_line_once(spark, tmp_path):
    rng = random.Random(3)
    lines = [json.dumps([i] * rng.randint(0, 3)) if rng.random() < 0.8 else rng.choice(["", "{", '{"events": [7]}', "[1" + " " * 300 + "]"]) for i in range(300)]
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.json").write_text("\n".join(lines[:200]))  # without a line's end at its end
    (tmp_path / "in" / "sub" / "b.json").write_text("\r\n".join(lines[200:]) + "\r\n")
    (tmp_path / "in" / "empty.json").write_text("")
    (tmp_path / "in" / "c.json.gz").write_bytes(gzip.compress(b'[1]\n[2,3]\n'))
    (tmp_path / "in" / "d.json").write_bytes(b"[1]\n[\"\xff\"]\n")
    (tmp_path / "in" / "_hidden.json").write_text("[9]")
    records.register(spark)
    want = []
    for text in [*lines, "[1]", "[2,3]", "[1]"]:
        found = records.events_of(text) if text.strip() else []
        want += [(None, None, text)] if found is None else [(n, e, None) for n, e in enumerate(found)]
    want = sorted([*want, (None, None, '["�"]')], key=str)
    for split in (1, 7, 64, 5_000, 128 << 20):
        assert told(spark.createDataFrame(list(records.read_spans(str(tmp_path / "in"), [s for t in records.Options({"path": str(tmp_path / "in"), "splitBytes": str(split)}).spans(records.files_of(str(tmp_path / "in"))) for s in t], False)), records.SCHEMA)) == want
    assert told(spark.read.format("event_records").option("splitBytes", 3_000_000).load(f"file://{tmp_path}/in")) == want


def test_whole_files_and_empty_folders(spark, tmp_path):
    records.register(spark)
    (tmp_path / "in").mkdir()
    assert spark.read.format("event_records").load(str(tmp_path / "in")).count() == 0
    (tmp_path / "in" / "a.json").write_text('{\n "events": [\n 1,\n 2]\n}\n')
    (tmp_path / "in" / "b.json").write_text("[\n")
    whole = spark.read.format("event_records").option("wholeFile", True).load(str(tmp_path / "in"))
    assert told(whole) == [(0, "1", None), (1, "2", None), (None, None, "[")]
    with pytest.raises(Exception, match="Missing|FileNotFound|missing"):
        spark.read.format("event_records").load(str(tmp_path / "missing")).count()


def test_a_stream_reads_new_files_once(spark, tmp_path):
    """Also when its checkpoint is behind the log, as after a driver that died, and when a file has grown since."""
    records.register(spark)
    base = f"file://{tmp_path}"
    (tmp_path / "in").mkdir()

    def run():
        stream = spark.readStream.format("event_records").option("log", f"{base}/log").load(f"{base}/in")
        increments.land(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
        return told(spark.read.schema(records.SCHEMA).parquet(f"{base}/out"))

    (tmp_path / "in" / "a.json").write_text("[1]\n")
    assert run() == [(0, "1", None)]
    assert run() == [(0, "1", None)]
    (tmp_path / "in" / "b.json").write_text("[2]\n{\n")
    reader = records.StreamReader({"path": f"{base}/in", "log": f"{base}/log"})
    assert reader.latestOffset() == {"lists": 2}  # logged, and then the driver dies
    with (tmp_path / "in" / "b.json").open("a") as more:
        more.write("[3]\n")
    assert run() == [(0, "1", None), (0, "2", None), (None, None, "{")]
    assert reader.latestOffset() == {"lists": 2}


# ---- counters while writing


def listing(spark, rows):
    """(ingest_seq, source, title, start, place)"""
    df = spark.createDataFrame(rows, "ingest_seq long, source_name string, title string, start_text string, location_text string")
    return df.withColumn("source_url", F.concat(F.lit("https://"), "source_name", F.lit(".example.org/e")))


ROWS = [
    (1, "a", "Family Storytime", "2024-01-16 10:00:00", "Main Library"), (2, "a", "Family Storytime", "2024-01-16 10:00:00", "Main Library"), (3, "b", "Family Storytime", "2024-01-16 10:00:00", "Main Library"),
    (4, "a", "Pottery Workshop", "2024-01-25 10:00:00", "Arts Studio"), (5, "a", "Nature Walk", "2024-01-02 10:00:00", "Park"), (6, "a", "", "2024-01-16 10:00:00", "Park"), (7, "a", None, "2024-01-16 10:00:00", "Park"),
    (8, "a", "Lego Club", "no date", "Park"), (9, "b", "Lego Club", "2024-01-17 10:00:00", "Park"),
]


def test_counters_of_a_run(spark):
    told = counted.run(listing(spark, ROWS), "2024-01-15", week="2024-01-15")
    want = {"rows": 9, "rejected": 3, "empty_title": 2, "generic_title": 0, "bad_start": 1, "schema": 0, "past": 1, "other_week": 1, "before_dedupe": 4, "survivors": 2, "kept": 2, "excluded": 0, "errors": 0, "failed": 0}
    assert {n: told.counts[n] for n in want} == want and not told.published


def test_the_gate_leaves_the_week_before_in_force(spark, tmp_path):
    path, raw = f"file://{tmp_path}/p", listing(spark, ROWS)
    assert counted.published(spark, path) is None
    assert not counted.run(raw, "2024-01-15", path=path, banned_hosts=["b.example"]).published and counted.published(spark, path) is None
    assert counted.run(raw, "2024-01-15", path=path).published
    before = sorted(r["id"] for r in counted.published(spark, path).collect())
    closed = counted.run(raw.filter("ingest_seq > 8"), "2024-01-15", path=path, banned_hosts=["b.example"])
    assert closed.counts["errors"] == closed.counts["failed"] == 1 and not closed.published
    assert sorted(r["id"] for r in counted.published(spark, path).collect()) == before
    assert before == sorted(r["id"] for r in deduplicate(normalise(raw, "2024-01-15")[0].filter(upcoming("2024-01-15"))).collect())
    assert counted.run(raw.filter("ingest_seq > 8"), "2024-01-15", week="2024-01-15", path=path).published  # another week's entry
    assert counted.published(spark, path, "2024-01-15").count() == 1 and counted.published(spark, path).count() == len(before)


def test_a_dry_run_writes_nothing_and_empty_tables_count_nothing(spark, tmp_path):
    empty = counted.run(listing(spark, ROWS).filter("ingest_seq < 0"), "2024-01-15", path=f"file://{tmp_path}/e")
    assert set(empty.counts.values()) == {0} and empty.published and counted.published(spark, f"file://{tmp_path}/e").count() == 0
    gone = counted.run(listing(spark, ROWS[4:8]), "2024-01-15")  # past and rejected rows alone
    assert gone.counts["rows"] == 4 and gone.counts["survivors"] == 0


def test_the_relevance_guard_is_read_from_the_counters(spark, tmp_path):
    rows = [(i, "a", t, "2024-01-16 10:00:00", "Hall") for i, t in enumerate(["Family Storytime", "Toddler Music", "Tax Help for Seniors", "Job Fair and Resume Workshop"])]
    few, many = listing(spark, rows[:3]), listing(spark, rows[2:])
    for name, raw, drops in (("few", few, 1), ("many", many, 0)):
        path = f"file://{tmp_path}/{name}"
        told = counted.run(raw, "2024-01-15", path=path, family_only=True)
        assert told.counts["excluded"] == drops and told.counts["kept"] == told.counts["survivors"] - drops
        assert counted.published(spark, path).count() == told.counts["kept"] and counted.excluded(spark, path).count() == drops


# ---- increments


def test_increments_equal_a_whole_run(spark, tmp_path):
    """Rows come, go, change and come back; each run classifies what it has not met, and equals the batch job."""
    path, rng = f"file://{tmp_path}/d", random.Random(5)
    titles, met = ["Family Storytime", "Pottery Workshop", "Lego Club", ""], set()
    rows = [(i, rng.choice("ab"), rng.choice(titles), f"2024-01-{rng.randint(10, 20)} 10:00:00", rng.choice(["Park", None])) for i in range(120)]
    changed = rows[:100] + [(i, "a", "Nature Walk", "2024-01-16 10:00:00", "Park") for i in range(100, 104)]
    for now, as_of in ((rows, "2024-01-15"), (changed, "2024-01-18"), (rows + rows[:5], "2024-01-15")):
        raw = listing(spark, now).withColumn("end_text", F.when(F.expr("ingest_seq % 4 = 0"), "2024-01-19 10:00:00"))
        told = delta.refresh(raw, "2024-01-15", path)
        assert told == {"rows": len(set(now)), "classified": len(set(now) - met)}
        met |= set(now)
        want = deduplicate(stored(normalise(raw, as_of)[0], "whole").filter(upcoming(as_of)))
        got = delta.survivors(spark, path, as_of)
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_segments_merge_and_other_rules_start_over(spark, tmp_path, monkeypatch):
    path, raw = f"file://{tmp_path}/d", listing(spark, ROWS)
    assert delta.survivors(spark, path, "2024-01-15") is None
    monkeypatch.setattr(delta, "SEGMENTS", 2)
    for n in (1, 4):
        delta.refresh(raw.filter(f"ingest_seq between {n} and {n + 3}"), "2024-01-15", path)
    assert len(ledger.Ledger(spark, path).newest()[1]["segments"]) == 1
    assert delta.refresh(raw.filter("ingest_seq between 4 and 7"), "2024-01-15", path, [("park", ["outdoor"], False, None, None)])["classified"] == 4
    assert delta.refresh(raw.filter("ingest_seq < 0"), "2024-01-15", path) == {"rows": 0, "classified": 0}
    assert delta.survivors(spark, path, "2024-01-15").count() == 0


# ---- shared links


@pytest.mark.parametrize("seed", range(3))
def test_links_after_any_split_are_those_of_all_rows(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(shared_links, "FAN_IN", 3)
    rng, path = random.Random(seed), f"file://{tmp_path}/l"
    weights = [rng.random() ** 4 for _ in range(8)]
    batches = []
    for n in range(7):  # links that rise, fall and rise again
        weights = weights[1:] + weights[:1] if n % 2 else weights
        batches.append([(rng.choice([None, ""]) if rng.random() < 0.1 else "u%d" % rng.choices(range(8), weights)[0],) for _ in range(rng.choice([0, 3, 40, 90]))])
    rows = []
    for n, batch in enumerate(batches):
        rows += batch
        df = spark.createDataFrame(batch, "candidate_original_url string")
        assert shared_links.merge_links(df, "s", n, path)
        assert not shared_links.merge_links(df, "s", n, path)
        want = outlier_urls(spark.createDataFrame(rows, "candidate_original_url string"))
        assert sorted(map(tuple, shared_links.shared_links(spark, path).collect())) == sorted(map(tuple, want.collect()))
    assert len(ledger.Ledger(spark, path).newest()[1]["parts"]) < 5
    with pytest.raises(ValueError, match="held by a share"):
        shared_links.merge_links(df, "s", 99, path, share=0.3)


def test_no_batch_gives_no_link(spark):
    assert shared_links.shared_links(spark, scratch(spark, "none")).count() == 0
