"""PIPE1 with its counters gathered while writing, a gate read from them, and a staged commit (AGG9, AGG14, SNK9).

Two writes and no job for counts alone: the classified rows, then the survivors. Both counters sit behind the last shuffle of
their write, in tasks whose result counts once, so a task that an executor's loss repeats adds nothing. The survivors count
from the moment when the ledger names them; a closed gate leaves the week before in force.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.store import stored
from kalends.operators import filters, quality
from kalends.operators.dedupe import deduplicate
from kalends.operators.normalise import EVENT_COLUMNS, judged
from kalends.sources.ledger import Ledger

EVERY_WEEK = "all"


@dataclass(frozen=True)
class Told:
    """What a run counted, and whether it published. A dry run never does."""

    counts: dict[str, int]
    published: bool


def _counts(**conditions: Column) -> list[Column]:
    return [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()]


def _got(seen: Observation, names: list[str]) -> dict[str, int]:
    """An observation's counts; of rows that the optimiser knew to be none, all are 0."""
    found = seen.get
    return {n: found.get(n) or 0 for n in names}


CLASSIFIED = ["rows", "rejected", "empty_title", "generic_title", "bad_start", "schema", "past", "other_week", "before_dedupe"]
KEPT = ["kept", "free", "paid", "donation", "unknown", "failed", "errors", "warnings"]


@dataclass(frozen=True)
class Classified:
    """Stored rows, classified for a day and a week, with their counts; any number of runs may read them."""

    rows: DataFrame
    counts: dict[str, int]
    as_of: str
    week: str | None


def classify(raw: DataFrame, as_of: str, week: str | None = None, hints: Sequence[tuple] = ()) -> Classified:
    """The first write of a run: all rows, classified once."""
    reject, event = F.col("reject"), F.col("reject").isNull()
    past = event & ~filters.upcoming(as_of)
    away = event & filters.upcoming(as_of) & ~filters.in_week(week) if week else F.lit(False)
    seen = Observation()
    classified = judged(raw, as_of, list(hints)).select(*EVENT_COLUMNS, "reject").observe(
        seen, F.count(F.lit(1)).alias("rows"),
        *_counts(rejected=~event, empty_title=reject == "EMPTY_TITLE", generic_title=reject == "GENERIC_TITLE", bad_start=reject == "BAD_START", schema=reject.startswith("SCHEMA"), past=past, other_week=away, before_dedupe=event & ~past & ~away),
    )
    rows = stored(classified, "classified")
    return Classified(rows, _got(seen, CLASSIFIED), as_of, week)


def run(raw: DataFrame, as_of: str, week: str | None = None, path: str | None = None, hints: Sequence[tuple] = (), banned_hosts: Sequence[str] = (), family_only: bool = False, attempts: int = 10) -> Told:
    """classify() and finish() in one."""
    return finish(classify(raw, as_of, week, hints), path, banned_hosts, family_only, attempts)


def finish(given: Classified, path: str | None = None, banned_hosts: Sequence[str] = (), family_only: bool = False, attempts: int = 10) -> Told:
    """Drop past rows and other weeks, deduplicate, filter by relevance if asked, validate, publish.

    Without a path it is a dry run: the same counts, and no row is written but in the scratch folder. With
    family_only rows below the threshold are left out unless they are more than the guard's share (FLT4).
    Survivors have unique ids, so their errors are those of rows. What deduplication took (AGG14) is before_dedupe less survivors.
    """
    rows, as_of, week = given.rows, given.as_of, given.week
    spark, event, second = rows.sparkSession, F.col("reject").isNull(), Observation()
    counts = dict(given.counts)
    kept = rows.filter(event & filters.upcoming(as_of) & (filters.in_week(week) if week else F.lit(True))).drop("reject")
    survivors = quality.with_issues(deduplicate(kept), list(banned_hosts))
    low = F.coalesce(F.col("family_relevance_score") < rules.PUBLISH_THRESHOLD, F.lit(False)) if family_only else F.lit(False)
    of = lambda severity: F.size(F.filter("issues", lambda i: i["severity"] == severity)).cast("long")
    survivors = survivors.select(*EVENT_COLUMNS, low.alias("low"), of("error").alias("_errors"), of("warning").alias("_warnings"))
    of_kind = {"free": "free", "paid": "paid", "donation": "suggested_donation", "unknown": "unknown"}
    ones = {"kept": F.lit(True), **{n: F.col("cost_type") == k for n, k in of_kind.items()}, "failed": F.col("_errors") > 0}
    sums = {"errors": F.col("_errors"), "warnings": F.col("_warnings")}
    high = ~F.col("low")
    seen = survivors.observe(
        second, *_counts(**ones), *[F.sum(c).alias(n) for n, c in sums.items()],
        *_counts(**{f"{n}_high": c & high for n, c in ones.items()}), *[F.sum(F.when(high, c)).alias(f"{n}_high") for n, c in sums.items()],
    ).drop("_errors", "_warnings")
    ledger = Ledger(spark, path) if path else None
    if ledger is None:
        seen.write.format("noop").mode("overwrite").save()
        return Told(counts | _settled(second), False)
    data = ledger.fresh(ledger.newest()[0] + 1)
    seen.write.parquet(f"{path}/{data}")
    counts |= _settled(second)
    if counts["errors"]:
        return Told(counts, False)
    for _ in range(attempts):
        at, entry = ledger.newest()
        if ledger.commit(at + 1, {"weeks": entry.get("weeks", {}) | {week or EVERY_WEEK: {"data": data, "high": counts["excluded"] > 0}}}):
            ledger.tidy(lambda e: {w["data"] for w in e["weeks"].values()})
            return Told(counts, True)
    raise RuntimeError(f"other writers were first {attempts} times")


def _settled(seen: Observation) -> dict[str, int]:
    """The guard's decision, and the counts of the rows that it leaves."""
    found = _got(seen, [*KEPT, *[f"{n}_high" for n in KEPT]])
    low = found["kept"] - found["kept_high"]
    drops = 0 < low <= rules.GUARD_SHARE * found["kept"]
    return {n: found[f"{n}_high"] if drops else found[n] for n in KEPT} | {"survivors": found["kept"], "excluded": low if drops else 0}


def published(spark: SparkSession, path: str, week: str | None = None) -> DataFrame | None:
    """The week's events; None if it has not been published."""
    return _part(spark, path, week, False)


def excluded(spark: SparkSession, path: str, week: str | None = None) -> DataFrame | None:
    """What the relevance filter left out of the published week, for SNK6's report."""
    return _part(spark, path, week, True)


def _part(spark: SparkSession, path: str, week: str | None, out: bool) -> DataFrame | None:
    entry = Ledger(spark, path).newest()[1].get("weeks", {}).get(week or EVERY_WEEK)
    if entry is None:
        return None
    rows = spark.read.parquet(f"{path}/{entry['data']}")
    gone = F.col("low") & F.lit(entry["high"])
    return rows.filter(gone if out else ~gone).drop("low")


def counted_rows(spark: SparkSession, told: Told) -> DataFrame:
    """(step, n): a row per counter."""
    return spark.createDataFrame(sorted(told.counts.items()), "step string, n bigint")
