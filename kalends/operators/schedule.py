"""Curated schedules: checks, expansion into days, horizon, staleness (SRC7, EXP1, FLT5, FLT7, FLT9, FLT10, AGG13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.dates import schedule_date, schedule_time, weekday_codes
from kalends.functions.text import place_text

DAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]


def error_code() -> Column:
    """FLT10: why an entry cannot be expanded; null if it can."""
    run, dates = F.col("run"), F.col("dates")
    start, end = schedule_date(run["start_date"]), schedule_date(run["end_date"])
    codes = F.coalesce(weekday_codes(run["days_of_week"]), F.array().cast("array<string>"))
    bad_time = lambda t: t.isNotNull() & schedule_time(t).isNull()
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    listed = F.coalesce(dates, F.array().cast("array<struct<date:string,start_time:string,end_time:string,note:string>>"))
    return (
        F.when(blank(F.col("title")), "missing_title").when(blank(F.col("source_url")), "missing_url")
        .when(run.isNotNull() & (F.size(listed) > 0), "both_forms").when(run.isNull() & (F.size(listed) == 0), "no_form")
        .when(run.isNotNull() & (start.isNull() | end.isNull()), "bad_date").when(end < start, "reversed_run")
        .when(F.size(F.array_except(codes, F.array(*map(F.lit, DAYS)))) > 0, "unknown_weekday")
        .when(run.isNotNull() & (bad_time(run["start_time"]) | bad_time(run["end_time"])), "bad_time")
        .when(F.exists(listed, lambda d: schedule_date(d["date"]).isNull()), "bad_date")
        .when(F.exists(listed, lambda d: bad_time(d["start_time"]) | bad_time(d["end_time"])), "bad_time")
    )


def checked(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FLT7 and FLT10: enabled, well-formed entries, and the malformed ones with their code."""
    judged = entries.filter(F.coalesce("enabled", F.lit(True))).withColumn("code", error_code())
    return judged.filter("code is null").drop("code"), judged.filter("code is not null")


def strict(entries: DataFrame) -> DataFrame:
    """Fails the job at the first malformed entry."""
    judged = entries.filter(F.coalesce("enabled", F.lit(True))).withColumn("_code", error_code())
    return judged.filter(F.when(F.col("_code").isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("malformed schedule: "), "_code")).cast("boolean"))).drop("_code")


def occurrences(entries: DataFrame) -> DataFrame:
    """EXP1: one row per open day of well-formed entries, with start_text, end_text, all_day and the day's note."""
    run = F.col("run")
    start, end = schedule_date(run["start_date"]), schedule_date(run["end_date"])
    codes = weekday_codes(run["days_of_week"])
    day = F.explode(F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day"))))
    open_day = F.coalesce(F.size("_codes") <= 0, F.lit(True)) | F.array_contains("_codes", F.element_at(F.array(*map(F.lit, DAYS)), F.weekday("day") + 1))
    runs = entries.filter(run.isNotNull()).withColumn("_codes", codes).withColumn("day", day).filter(open_day).select(*entries.columns, "day", schedule_time(run["start_time"]).alias("from_time"), schedule_time(run["end_time"]).alias("to_time"), F.lit(None).cast("string").alias("note"))
    one = F.col("_one")
    dates = entries.filter(run.isNull()).withColumn("_one", F.explode("dates")).select(*entries.columns, schedule_date(one["date"]).alias("day"), schedule_time(one["start_time"]).alias("from_time"), schedule_time(one["end_time"]).alias("to_time"), F.trim(one["note"]).alias("note"))
    full = runs.unionByName(dates)
    at = lambda t: F.concat(F.col("day").cast("string"), F.lit(" "), t)
    return full.withColumns({
        "all_day": F.col("from_time").isNull(), "start_text": F.coalesce(at(F.col("from_time")), F.col("day").cast("string")),
        "end_text": F.when(F.col("from_time").isNotNull(), at(F.col("to_time"))), "summary_text": F.nullif(F.concat_ws(" ", F.nullif(F.trim("summary"), F.lit("")), F.nullif(F.col("note"), F.lit(""))), F.lit("")),
    })


def horizon_bucket(as_of: str, days: int = rules.HORIZON_DAYS) -> Column:
    """FLT5: kept, past, or beyond the horizon."""
    today = F.to_date(F.lit(as_of))
    return F.when(F.col("day") < today, "past").when(F.col("day") > F.date_add(today, days), "beyond").otherwise("kept")


def within_horizon(df: DataFrame, as_of: str, days: int = rules.HORIZON_DAYS) -> DataFrame:
    return df.filter(horizon_bucket(as_of, days) == "kept")


def bucket_counts(df: DataFrame, as_of: str, days: int = rules.HORIZON_DAYS) -> DataFrame:
    """AGG13."""
    return df.groupBy(horizon_bucket(as_of, days).alias("bucket")).count()


def stale(as_of: str, days: int = rules.STALE_DAYS) -> Column:
    """FLT9: not verified for so many days, or never; the row is still published."""
    return F.coalesce(F.date_diff(F.to_date(F.lit(as_of)), schedule_date(F.col("verified_on"))) > days, F.lit(True))


def curated_records(entries: DataFrame, as_of: str, source_id: str = "curated", days: int = rules.HORIZON_DAYS) -> DataFrame:
    """SRC7: raw records of all open days within the horizon, from well-formed entries."""
    good, _ = checked(entries)
    open_days = within_horizon(occurrences(good), as_of, days).withColumn("stale", stale(as_of))
    return open_days.select(
        F.lit(source_id).alias("source_id"), F.coalesce("title", F.lit("")).alias("title"), "source_url", "start_text", "end_text", "all_day", place_text(F.col("venue"), F.col("address")).alias("location_text"),
        "summary_text", "price_text", "city", "county", F.col("tags").alias("extra_tags"), F.lit("curated").alias("extracted_from"), F.lit(1.0).alias("extraction_confidence"), "stale",
    )
