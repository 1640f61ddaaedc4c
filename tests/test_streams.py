"""Streams against their batch forms: weeks, first arrivals, two writers."""

import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from kalends.operators.dedupe import deduplicate
from kalends.sources import ledger
from kalends.streaming import first_seen, weeks

EVENT = "ingest_seq long, id string, title string, start timestamp_ntz, end timestamp_ntz, location_name string, summary string, image_url string, registration_url string, source_url string, source_name string, tags array<string>, family_friendly_score double"


def events(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in rng.sample(range(n), n):
        day = rng.randint(1, 28)
        rows.append((i, f"id{rng.randint(0, n // 3)}", rng.choice(["Fair", "fair ", "Walk", "Show"]), day, rng.choice(["Hall", "Park", None]), rng.choice([None, "Songs."])))
    df = spark.createDataFrame(rows, "ingest_seq long, id string, title string, day int, location_name string, summary string")
    return df.select(
        "ingest_seq", "id", "title", F.expr("make_timestamp_ntz(2024, 1, day, 10, 0, 0)").alias("start"), F.expr("cast(null as timestamp_ntz)").alias("end"), "location_name", "summary",
        *[F.lit(None).cast("string").alias(c) for c in ("image_url", "registration_url")], F.lit("https://a.example.org/").alias("source_url"), F.lit("S").alias("source_name"), F.array(F.lit("arts")).alias("tags"), F.lit(0.5).alias("family_friendly_score"),
    )


def survivors(df):
    return sorted((r["id"], r["ingest_seq"], str(r["start"])) for r in df.collect())


def test_weeks_after_any_split_are_the_batch_jobs(spark, tmp_path):
    rows = events(spark).cache()
    for split in (1, 3):
        path = f"file://{tmp_path}/w{split}"
        for n in range(split):
            assert weeks.merge_weeks(rows.filter(F.col("ingest_seq") % split == n), "s", n, path)
        assert not weeks.merge_weeks(rows, "s", split - 1, path)  # a repeated batch
        assert survivors(weeks.current_weeks(spark, path)) == survivors(deduplicate(rows))


def test_only_touched_weeks_are_written(spark, tmp_path):
    path, rows = f"file://{tmp_path}/w", events(spark).cache()
    weeks.merge_weeks(rows, "s", 0, path)
    before = ledger.Ledger(spark, path).newest()[1]["weeks"]
    one = rows.filter("id = 'id7'").withColumns({"start": F.expr("timestamp_ntz'2024-02-20 10:00:00'"), "summary": F.lit("Better."), "image_url": F.lit("https://i.example.org/"), "ingest_seq": F.lit(9999).cast("long")})
    assert one.count() >= 1
    weeks.merge_weeks(one.limit(1), "s", 1, path)
    after = ledger.Ledger(spark, path).newest()[1]["weeks"]
    moved = {w for w in {*before, *after} if before.get(w) != after.get(w)}
    assert "2024-02-19" in moved and len(moved) == 2
    assert survivors(weeks.current_weeks(spark, path)) == survivors(deduplicate(rows.unionByName(one.limit(1))))
    assert weeks.current_weeks(spark, path, ["2024-02-19"]).count() == 1


def test_a_stream_that_dies_before_the_ledger_starts_over(spark, tmp_path):
    rows, base = events(spark).cache(), f"file://{tmp_path}"
    fails = [True]

    def gate(staged):
        assert staged.count() > 0
        if fails.pop():
            raise ValueError("no")
        fails.append(False)

    rows.filter("ingest_seq % 2 = 0").write.parquet(f"{base}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
    with pytest.raises(StreamingQueryException):
        weeks.publish_weeks(stream, f"{base}/w", f"{base}/c", gate=gate).awaitTermination()
    assert weeks.current_weeks(spark, f"{base}/w") is None
    fails.append(False)
    weeks.publish_weeks(stream, f"{base}/w", f"{base}/c", gate=gate).awaitTermination()
    rows.filter("ingest_seq % 2 = 1").write.mode("append").parquet(f"{base}/in")
    weeks.publish_weeks(stream, f"{base}/w", f"{base}/c", gate=gate).awaitTermination()
    assert survivors(weeks.current_weeks(spark, f"{base}/w")) == survivors(deduplicate(rows))


def test_empty_batches_and_rows_without_start(spark, tmp_path):
    path, rows = f"file://{tmp_path}/w", events(spark)
    assert weeks.merge_weeks(rows.limit(0), "s", 0, path) and weeks.current_weeks(spark, path) is None
    assert weeks.merge_weeks(rows.withColumn("start", F.lit(None).cast("timestamp_ntz")), "s", 1, path) and weeks.current_weeks(spark, path) is None


def test_two_writers_lose_no_row(spark, tmp_path):
    """Another writer commits between a merge's read and its commit; both rows are there."""
    path, row = f"file://{tmp_path}/t", lambda i: spark.createDataFrame([(i,)], "i long")
    more = [2]

    def merge(old):
        if more:
            ledger.merge_table(spark, path, lambda o, i=more.pop(): row(i) if o is None else o.unionByName(row(i)))
        return row(1) if old is None else old.unionByName(row(1))

    assert ledger.merge_table(spark, path, merge)
    assert sorted(r["i"] for r in ledger.current(spark, path).collect()) == [1, 2]
    assert ledger.merge_table(spark, path, lambda o: o.unionByName(row(3)), ("s", 4)) and not ledger.merge_table(spark, path, lambda o: o.unionByName(row(3)), ("s", 4))
    assert ledger.current(spark, path).count() == 3
    for i in range(8):
        ledger.merge_table(spark, path, lambda o: o.unionByName(row(i)))
    assert len(ledger.Ledger(spark, path).numbers()) == ledger.KEPT_ENTRIES and ledger.current(spark, path).count() == 11


def test_first_seen_by_arrival(spark, tmp_path):
    """A late earlier arrival corrects what was told; a key forgotten after the delay is new again."""
    own, base = first_seen.stateful(spark), f"file://{tmp_path}"
    schema = "ingest_seq long, source_id string, source_url string, at timestamp_ntz, note string"
    batches = [
        [(5, "a", "u", 1, "x"), (6, "a", "u", 1, "x"), (7, "b", "u", 1, "x"), (8, "b", None, 1, "x"), (9, "b", "", 1, "x"), (10, None, "u", 1, "x")],
        [(3, "a", "u", 2, "late"), (11, "b", "u", 2, "x")], [(4, "a", "u", 2, "x"), (12, "c", "u", 20, "x")], [(13, "d", "u", 21, "x")], [(14, "a", "u", 21, "x")],
    ]
    told = []
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "ingest_seq long, source_id string, source_url string, day int, note string")
        df.select("ingest_seq", "source_id", "source_url", F.expr("make_timestamp_ntz(2024, 1, day, 0, 0, 0)").alias("at"), "note").coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = own.readStream.schema(schema).parquet(f"{base}/in")
        first_seen.first_by_arrival(stream, "at").writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start().awaitTermination()
        now = [tuple(r) for r in spark.read.schema(first_seen.OUT).parquet(f"{base}/out").collect()]
        told.append(sorted(set(now) - {r for t in told for r in t}, key=str))
    assert told[0] == sorted([("a", "u", 5, "first", None), ("b", "u", 7, "first", None), (None, "u", 10, "first", None)], key=str)
    assert told[1] == [("a", "u", 3, "correction", 5)]
    assert told[2] == [("c", "u", 12, "first", None)] and told[3] == [("d", "u", 13, "first", None)]
    assert told[4] == [("a", "u", 14, "first", None)]  # not met since the 2nd
