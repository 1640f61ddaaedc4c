"""Whole jobs (PIPE1-PIPE6). Builders are lazy; writers are called only with a path (SNK9)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.functions.store import stored
from kalends.operators import candidates as cand
from kalends.operators import filters, geo, quality, reports
from kalends.operators.dedupe import deduplicate
from kalends.operators.normalise import normalise, published_to_raw
from kalends.sources.publish import write_json, write_week


@dataclass
class Build:
    """Results of a build. Frames that several steps read are stored in the shared folder; nothing is published yet."""

    events: DataFrame
    rejects: DataFrame
    past: DataFrame
    excluded: DataFrame | None
    issues: DataFrame


def daily(raw: DataFrame, as_of: str, week: str | None = None, hints: list[tuple] = (), cache: DataFrame | None = None, family_only: bool = False, banned_hosts: list[str] = ()) -> Build:
    """PIPE1: normalise, drop past, week, deduplicate, geocode, filter, validate, in this order."""
    events, rejects = normalise(raw, as_of, hints, once=True)
    kept, past = filters.split(events, filters.upcoming(as_of))
    if week:
        kept = kept.filter(filters.in_week(week))
    kept = stored(deduplicate(kept), "deduplicated")
    if cache is not None:
        kept = stored(geo.geocode(kept, cache), "geocoded")
    excluded = None
    if family_only:
        kept, excluded = filters.relevance_split(kept)
    return Build(kept, rejects, past, excluded, quality.issues(kept, banned_hosts))


def publish(build: Build, path: str, week: str, banned_hosts: list[str] = ()) -> bool:
    """The gate, then the week's partition; false and nothing written if any error exists."""
    if not quality.publishable(build.events, banned_hosts):
        return False
    write_week(build.events, path, week)
    return True


def discover(candidates: DataFrame, pages: DataFrame, week: str, year: int) -> tuple[DataFrame, DataFrame]:
    """PIPE2: (raw records, candidates for review) of the week's open candidates."""
    open_rows = filters.open_candidates(cand.review_queue(candidates, week, year))
    return cand.resolve(cand.self_checks(open_rows), pages)


def repair(published: DataFrame, as_of: str, hints: list[tuple] = ()) -> tuple[DataFrame, DataFrame]:
    """PIPE3: the week's rows rebuilt from what was published, and the price report of one row."""
    events, _ = normalise(published_to_raw(published), as_of, hints)
    again = stored(deduplicate(events), "repaired")
    return again, reports.price_repair(again, published)


def geo_patch(published: DataFrame, cache: DataFrame, policy: str = "report") -> tuple[DataFrame, DataFrame]:
    """PIPE4: rows with coordinates patched from the purged cache, and the suspicious ones."""
    done = stored(geo.geocode(stored(published, "published"), geo.purge(cache), policy), "patched")
    return done, geo.suspicious(done)


def validate(events: DataFrame, banned_hosts: list[str] = ()) -> DataFrame:
    """PIPE5: AGG9's row with the number of rows that are no events."""
    good, bad = quality.split_valid(stored(events, "validated"))
    return quality.totals(good, banned_hosts).join(F.broadcast(bad.agg(F.count("*").alias("unreadable"))), F.lit(True))


def dedupe_file(events: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """PIPE6. columns: as in deduplicate()."""
    good, _ = quality.split_valid(events)
    return deduplicate(good, columns)


def exclusion_report(build: Build, path: str | None = None) -> DataFrame:
    rows = reports.exclusion_report(build.excluded)
    if path:
        write_json(rows, path)
    return rows
