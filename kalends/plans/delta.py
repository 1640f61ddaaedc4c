"""DED4 and PIPE3 by increments: only rows that are new are classified, only ids that they touch get a new survivor.

Each raw row has a digest. Classified events lie in segments; a row of a segment counts while its digest is among the raw
rows. A row that comes, goes or comes back touches its id, and the best rows of a touched id are taken anew; all other
best rows are copied. The state is the digests that were met, rejects included, with how often each is there, and the best row per id
and last day, which the clock may drop or keep; fingerprints are settled and the date of verification is set when survivors are read.
Other rules, hints, columns or another year start over.

What moves is narrow: digests, and the best rows' columns. Raw rows, segments and best rows are not shuffled to find the few of
them that changed (functions/sieve.py).
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.fence import fenced
from kalends.functions.sieve import among, sifted, without
from kalends.operators import filters
from kalends.operators.dedupe import by_fingerprint, with_quality
from kalends.operators.normalise import EVENT_COLUMNS, conform, judged
from kalends.sources.ledger import Ledger
from kalends.streaming.weeks import STATE

#: To be raised by a change of classifying code, which the digest of the rules does not see.
CODE = 2
#: So many segments become one, without the rows that no longer count.
SEGMENTS = 8
#: What deduplication and the clock read of an event.
READ = ["id", "ingest_seq", "title", "start", "end", "location_name"]


def rules_version(hints: Sequence[tuple], year: str, columns: Sequence[str] = EVENT_COLUMNS) -> str:
    """A digest of the rule tables, the hints, the columns and the year that dates without one fall in."""
    plain = lambda v: sorted(map(repr, v)) if isinstance(v, set | frozenset) else v
    named = [(n, plain(v)) for n, v in sorted(vars(rules).items()) if n.isupper()]
    return hashlib.sha256(repr((named, list(hints), list(columns), year, CODE)).encode()).hexdigest()


def keyed(raw: DataFrame) -> DataFrame:
    """The declared raw columns with a digest over all of them, 16 bytes of a SHA-256; equal rows have equal digests.

    Each value stands behind its length and null is a dash, so different rows have different texts.
    """
    rows = conform(raw)
    plain = {f.name: F.col(f.name).cast("string") if f.dataType.simpleString() != "array<string>" else F.to_json(f.name, {"ignoreNullFields": "false"}) for f in rows.schema}
    parts = [F.when(F.col(n).isNull(), "-").otherwise(F.concat(F.length(v).cast("string"), F.lit(":"), v)) for n, v in sorted(plain.items())]
    # a join's filter on the digest stays above the fence: it derives no digest a second time
    return fenced(rows, "digest", F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32)))


def refresh(raw: DataFrame, as_of: str, path: str, hints: Sequence[tuple] = (), attempts: int = 10, columns: Sequence[str] | None = None) -> dict[str, int]:
    """Brings the state up to these raw rows; returns how many rows there are and how many had to be classified.

    Repeated rows are classified once. The raw rows are read twice, by digests and by what is new; best rows are
    written anew, a copy without classification. columns: those that the caller reads of the survivors, where it
    does not read all; no others are derived or kept.
    """
    columns = EVENT_COLUMNS if columns is None else list(dict.fromkeys([*READ, *columns]))
    spark, ledger, version = raw.sparkSession, Ledger(raw.sparkSession, path), rules_version(hints, as_of[:4], columns)
    rows = keyed(raw)
    for _ in range(attempts):
        at, entry = ledger.newest()
        entry = entry if entry.get("version") == version else {}
        name = ledger.fresh(at + 1)
        base = f"{path}/{name}"
        there = rows.select("digest", F.lit(1).alias("n"), F.lit(0).alias("was"))
        if entry:
            met = spark.read.parquet(f"{path}/{entry['state']}/digests").filter("n > 0" if entry["merged"] else "true")
            there = there.unionByName(met.select("digest", F.lit(0).alias("n"), F.when(F.col("n") > 0, 1).otherwise(2).alias("was")))
        _write(there.groupBy("digest").agg(F.sum("n").alias("n"), F.max("was").cast("byte").alias("was")), f"{base}/digests")
        digests = spark.read.parquet(f"{base}/digests")
        once = among(rows, digests.filter("n > 0 and was = 0"), "digest").dropDuplicates(["digest"]) if entry else _once(rows, digests.filter("n > 1"))
        seen = Observation()
        new = with_quality(judged(once, as_of, list(hints), ["digest"])).select("digest", *columns, "quality", "reject")
        _write(new.observe(seen, F.count(F.lit(1)).alias("n")).filter("reject is null").drop("reject"), f"{base}/rows")
        segments = [*entry.get("segments", []), name]
        events = spark.read.parquet(*[f"{path}/{s}/rows" for s in segments])
        gone = digests.filter("n = 0")
        if entry:
            changed = digests.filter("(n > 0) <> (was = 1)")
            _write(among(events.select("digest", "id"), changed, "digest").select("id").distinct(), f"{base}/touched")
            touched = spark.read.parquet(f"{base}/touched")
            best = _best(among(events, touched, "id").join(gone.select("digest"), "digest", "left_anti"))
            whole = without(spark.read.parquet(f"{path}/{entry['state']}/best"), touched, "id").unionByName(best)
        else:
            whole = _best(events)
        _write(whole, f"{base}/best")
        merged = len(segments) >= SEGMENTS
        if merged:
            segments = [ledger.fresh(at + 1)]
            _write(without(events, gone, "digest"), f"{path}/{segments[0]}/rows")
        if ledger.commit(at + 1, {"version": version, "segments": segments, "state": name, "merged": merged}):
            ledger.tidy(lambda e: {*e["segments"], e["state"]})
            return {"rows": digests.filter("n > 0").count(), "classified": seen.get.get("n") or 0}
    raise RuntimeError(f"other writers were first {attempts} times")


def _write(df: DataFrame, path: str) -> None:
    df.write.option("compression", "zstd").parquet(path)


def _once(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Each row once; only those that may be repeated are shuffled."""
    if repeated.isEmpty():
        return rows
    some, none = sifted(rows, repeated, "digest")
    return none.unionByName(some.dropDuplicates(["digest"]))


def _best(events: DataFrame) -> DataFrame:
    """The best row per id and last day with its first arrival: a day that the clock drops takes no other's row along."""
    return _first(events.drop("digest").withColumn("group_seq", F.col("ingest_seq")), F.to_date(F.coalesce("end", "start")).alias("_day"))


def _first(rows: DataFrame, *more) -> DataFrame:
    """DED2's row per id, and what else is given, of rows with quality and group_seq; an id, 16 hex digits, moves as its 8 bytes, and once."""
    rest = [c for c in rows.columns if c not in ("id", "quality", "ingest_seq", "group_seq")]
    best = F.max(F.struct("quality", (-F.col("ingest_seq")).alias("_seq"), *[F.col(f"`{c}`") for c in rest]))
    found = rows.groupBy(F.unhex("id").alias("_id"), *more).agg(best.alias("_best"), F.min("group_seq").alias("group_seq"))
    return found.select(F.lower(F.hex("_id")).alias("id"), "_best.*", "group_seq").select(*[(-F.col("_seq")).alias(c) if c == "ingest_seq" else c for c in rows.columns])


def survivors(spark: SparkSession, path: str, as_of: str, upcoming: bool = True) -> DataFrame | None:
    """DED4's rows of the state; None before the first refresh."""
    _, entry = Ledger(spark, path).newest()
    if not entry:
        return None
    best = spark.read.parquet(f"{path}/{entry['state']}/best")
    kept = by_fingerprint(_first(best.filter(filters.upcoming(as_of)) if upcoming else best)).drop(*STATE)
    return kept.withColumns({c: F.to_timestamp(F.lit(as_of)) for c in kept.columns if c == "last_verified_at"})
