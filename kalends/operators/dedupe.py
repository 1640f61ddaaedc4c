"""Survivors: quality score, two-pass deduplication, first-seen rows, retention (DED1-DED7, SRT1, RET1, SET4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kalends import rules
from kalends.operators.scores import filled, points


def quality(summary: Column, image: Column, registration: Column, end: Column, place: Column, tags: Column, family: Column) -> Column:
    """DED1, rounded to six places."""
    w = rules.QUALITY_WEIGHTS
    whole = points(filled(summary), w["summary"]) + points(filled(image), w["image_url"]) + points(filled(registration), w["registration_url"]) + points(end.isNotNull(), w["end"]) + points(filled(place), w["location_name"]) + w["tag"] * F.least(F.coalesce(F.size(tags), F.lit(0)), F.lit(w["tags_counted"]))
    return F.round((whole + w["family"] * F.coalesce(family, F.lit(0.0))) / 100.0, 6)


def fingerprint(title: Column, start: Column, place: Column) -> Column:
    """Key of the same event told by several sources: title, start date, place."""
    text = lambda c: F.coalesce(F.lower(F.trim(c)), F.lit(""))
    return F.concat_ws("|", text(title), F.coalesce(F.to_date(start).cast("string"), F.lit("")), text(place))


def first_by(df: DataFrame, keys: list[str], order: list[Column], keep: str = "_place") -> DataFrame:
    """One row per key, the first by the order; the limit runs before the shuffle as well."""
    return df.withColumn(keep, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(keep) == 1).drop(keep)


def by_id(df: DataFrame) -> DataFrame:
    """DED2: the best row per id, the earliest arrival on a tie; group_seq is the id's first arrival.

    One aggregation, partial before the shuffle: a hot id sends one row per task, and df is computed once.
    """
    best = F.max_by(F.struct(*df.columns), F.struct("quality", -F.col("ingest_seq")))
    found = df.groupBy("id").agg(best.alias("_best"), F.min("ingest_seq").alias("group_seq"))
    return found.select("_best.*", "group_seq")


def by_fingerprint(df: DataFrame) -> DataFrame:
    """DED3: the best row per fingerprint; ties go to the id group that arrived first."""
    keyed = df.withColumn("_key", fingerprint(F.col("title"), F.col("start"), F.col("location_name")))
    return first_by(keyed, ["_key"], [F.desc("quality"), F.asc("group_seq")]).drop("_key")


def with_quality(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumn("quality", quality(c("summary"), c("image_url"), c("registration_url"), c("end"), c("location_name"), c("tags"), c("family_friendly_score")))


def deduplicate(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """DED4: both passes. Rows are returned unordered; sort with chronological() where order counts.

    columns: those that the caller reads of the survivors, where it does not read all; no others are derived or moved.
    """
    scored = with_quality(df)
    if columns is None:
        return by_fingerprint(by_id(scored)).drop("quality", "group_seq")
    read = dict.fromkeys(["id", "ingest_seq", "title", "start", "location_name", "quality", *columns])
    return by_fingerprint(by_id(scored.select(*read))).select(*columns)


def chronological(df: DataFrame) -> DataFrame:
    """SRT1."""
    return df.orderBy("start", "title")


def first_seen(df: DataFrame, source: str = "source_id", url: str = "source_url") -> DataFrame:
    """DED5: the first row per source and URL; rows without a URL all stay."""
    there = F.coalesce(F.col(url), F.lit("")) != ""
    return first_by(df.filter(there), [source, url], [F.asc("ingest_seq")]).unionByName(df.filter(~there))


def duplicate_flags(df: DataFrame) -> DataFrame:
    """DED6: every row after an id's first, with the first row's title.

    The ids that repeat are found by a partial aggregation and joined back, so no task holds all rows
    of an id. df is read twice: give it stored where it is costly.
    """
    first = F.min(F.struct("ingest_seq", "title"))
    repeated = df.groupBy("id").agg(first.alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    later = df.join(repeated, "id").filter(F.col("ingest_seq") > F.col("_first")["ingest_seq"])
    return later.withColumn("first_title", F.col("_first")["title"]).select(*df.columns, "first_title")


def retained_weeks(weeks: DataFrame, keep: int = rules.KEEP_WEEKS, protect: str | None = None, column: str = "week") -> DataFrame:
    """RET1: (week, kept) for the distinct weeks: the protected one and the newest others, keep in all.

    keep of 0 or less keeps everything. Null weeks are dropped. A row per week: the table is small.
    """
    spark = weeks.sparkSession
    distinct = weeks.select(F.col(column).cast("string").alias("week")).filter("week is not null")
    if protect is not None:
        distinct = distinct.unionByName(spark.range(1).select(F.lit(protect).alias("week")))
    distinct = distinct.distinct()
    if keep <= 0:
        return distinct.withColumn("kept", F.lit(True))
    order = Window.orderBy((F.col("week") == F.lit(protect)).desc() if protect is not None else F.lit(0), F.desc("week"))
    return distinct.withColumn("kept", F.row_number().over(order) <= keep)


def mirror_plan(source: DataFrame, target: DataFrame, column: str = "week") -> DataFrame:
    """SET4: (week, action): copy what the source has, delete what only the target has."""
    have = source.select(column).distinct()
    return have.withColumn("action", F.lit("copy")).unionByName(target.select(column).distinct().join(have, column, "left_anti").withColumn("action", F.lit("delete")))
