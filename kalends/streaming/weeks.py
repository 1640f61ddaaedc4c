"""ST3, the published weeks: each micro-batch of events rewrites the weeks that it touches and no other.

Kept are the survivors by id (DED2) with what a later merge needs, quality and first arrival; survivors by fingerprint (DED3)
are taken when a week is read, for a fingerprint holds the start's date and so lies in one week. An event that moves to another
week touches both. The result after any split into batches is that of deduplicating all events at once.

The weeks' files are written under new names, and an entry of the ledger then points each touched week to them and
records the batch, both at once: a stream that dies in between starts its batch over, and one that dies after it skips
the batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from kalends.functions.store import stored
from kalends.operators.dedupe import by_fingerprint, with_quality
from kalends.sources.ledger import Ledger

STATE = ["quality", "group_seq"]


def week_of(start: str = "start"):
    return F.date_format(F.date_trunc("WEEK", start), "yyyy-MM-dd")


def best_by_id(rows: DataFrame) -> DataFrame:
    """DED2 over rows with quality and group_seq, of which some are survivors themselves."""
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != "group_seq"]), F.struct("quality", -F.col("ingest_seq")))
    return rows.groupBy("id").agg(best.alias("_best"), F.min("group_seq").alias("group_seq")).select("_best.*", "group_seq")


def _read(spark: SparkSession, path: str, weeks: dict[str, str]) -> DataFrame | None:
    """Rows of the weeks, each from the data that its entry names."""
    if not weeks:
        return None
    paths = [f"{path}/{data}/week_start={week}" for week, data in sorted(weeks.items())]
    return spark.read.parquet(*paths)


def merge_weeks(batch: DataFrame, stream: str, number: int, path: str, gate: Callable[[DataFrame], None] | None = None, attempts: int = 10) -> bool:
    """Merges a batch into the weeks; False if it was merged before. Rows need id, ingest_seq, start and what quality() reads.

    gate sees the touched weeks before they count, and stops the merge by raising.
    """
    spark, ledger = batch.sparkSession, Ledger(batch.sparkSession, path)
    for _ in range(attempts):
        at, entry = ledger.newest()
        weeks, done = entry.get("weeks", {}), entry.get("batches", {})
        if done.get(stream, -1) >= number:
            return False
        new = stored(best_by_id(with_quality(batch.filter("id is not null and start is not null")).withColumn("group_seq", F.col("ingest_seq"))), "batch")
        held = _read(spark, path, weeks)
        touched = new.select(week_of().alias("week"))
        if held is not None:  # weeks from which the batch's events may move; ids and starts alone are read
            touched = touched.unionByName(held.select("id", week_of().alias("week")).join(new.select("id"), "id", "left_semi").select("week"))
        touched = {r["week"] for r in touched.distinct().collect()}  # a row for each week
        old = _read(spark, path, {w: d for w, d in weeks.items() if w in touched})
        merged = best_by_id(new if old is None else new.unionByName(old.select(new.columns)))
        data = ledger.fresh(at + 1)
        merged.withColumn("week_start", week_of()).write.partitionBy("week_start").parquet(f"{path}/{data}")
        there = {r["w"] for r in spark.read.parquet(f"{path}/{data}").select(F.col("week_start").cast("string").alias("w")).distinct().collect()} if touched else set()
        if gate is not None and there:
            gate(published(_read(spark, path, dict.fromkeys(there, data))))
        now = {w: d for w, d in weeks.items() if w not in touched} | dict.fromkeys(there, data)
        if ledger.commit(at + 1, {"weeks": now, "batches": done | {stream: number}}):
            ledger.tidy(lambda e: set(e["weeks"].values()))
            return True
    raise RuntimeError(f"other writers were first {attempts} times")


def published(rows: DataFrame) -> DataFrame:
    return by_fingerprint(rows).drop(*STATE)


def current_weeks(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame | None:
    """The published events with week_start, of all weeks or some; None while there are none."""
    weeks = Ledger(spark, path).newest()[1].get("weeks", {})
    rows = _read(spark, path, {w: d for w, d in weeks.items() if only is None or w in only})
    return None if rows is None else published(rows).withColumn("week_start", week_of())


def publish_weeks(events: DataFrame, path: str, checkpoint: str, stream: str | None = None, gate: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Merges a stream's batches into the weeks and stops when all that is there has been read.

    Batches are numbered by the checkpoint, so that is the stream's name unless it is given another.
    """
    return events.writeStream.foreachBatch(lambda batch, n: merge_weeks(batch, stream or checkpoint, n, path, gate) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
