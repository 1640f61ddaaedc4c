"""Summaries (AGG1-AGG8, AGG11, AGG12, AGG14, TOP1, TOP2, SNK6, SNK7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.functions.urls import host
from kalends.operators.lookup import price_changes


def by_source(df: DataFrame) -> DataFrame:
    """AGG1."""
    return df.groupBy("source_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source_name")


def costs(df: DataFrame) -> DataFrame:
    """AGG2: one row; free_share is null for no rows."""
    c = F.col("cost_type")
    return df.agg(F.count("*").alias("total"), F.count_if(c == "free").alias("free"), F.count_if(c == "paid").alias("paid"), F.count_if(c == "suggested_donation").alias("donation"), F.count_if(F.coalesce(c, F.lit("unknown")) == "unknown").alias("unknown")).withColumn("free_share", F.round(100 * F.try_divide(F.col("free"), F.col("total")), 1))


def reasons(df: DataFrame, reason: str = "reason") -> DataFrame:
    """AGG3."""
    return df.groupBy(F.col(reason).alias("reason")).agg(F.count("*").alias("n"))


def top_reasons(df: DataFrame, n: int = 6, reason: str = "reason") -> DataFrame:
    """TOP2."""
    return reasons(df, reason).orderBy(F.desc("n"), "reason").limit(n)


def exclusions(excluded: DataFrame) -> DataFrame:
    """AGG4: counts by label."""
    return excluded.groupBy("family_relevance_label").agg(F.count("*").alias("n"))


def lowest(excluded: DataFrame, n: int = 8) -> DataFrame:
    """TOP1: the n rows of least relevance, by id on a tie."""
    return excluded.orderBy("family_relevance_score", "id").limit(n).select("id", "title", "family_relevance_score", "family_relevance_label")


def exclusion_report(excluded: DataFrame) -> DataFrame:
    """SNK6's rows, the least relevant first."""
    return excluded.orderBy("family_relevance_score", "id").select("id", "title", "source_name", "start", "family_relevance_score", "family_relevance_label")


def price_repair(after: DataFrame, before: DataFrame) -> DataFrame:
    """AGG5: one row of counts before and after, newly free and newly paid."""
    both = price_changes(after, before)
    now, old = F.col("cost_type"), F.col("before")
    kinds = ["free", "paid", "suggested_donation", "unknown"]
    return both.agg(F.count("*").alias("total"), *[F.count_if(old == k).alias(f"before_{k}") for k in kinds], *[F.count_if(now == k).alias(f"after_{k}") for k in kinds], F.count_if((now == "free") & (old != "free")).alias("newly_free"), F.count_if((now == "paid") & (old != "paid")).alias("newly_paid"))


def repair_examples(after: DataFrame, before: DataFrame, kind: str = "free", n: int = 20) -> DataFrame:
    """SNK7: the first n rows by id that newly are of a kind."""
    return price_changes(after, before).filter((F.col("cost_type") == kind) & (F.col("before") != kind)).orderBy("id").limit(n).select("id", "title", "before", "cost_type", "price_text")


def addresses(df: DataFrame) -> DataFrame:
    """AGG6."""
    given = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    return df.agg(F.count("*").alias("total"), F.count_if(given("location_address")).alias("with_address"), F.count_if(given("city")).alias("with_city"), F.count_if(F.col("latitude").isNotNull()).alias("with_point"), F.count_if("is_mappable").alias("mappable"), F.count_if(F.array_contains("tags", "virtual")).alias("virtual"))


def source_count(df: DataFrame) -> DataFrame:
    """AGG8: distinct hosts, or distinct names where no row has a host."""
    return df.agg(F.count_distinct(host(F.col("source_url"))).alias("hosts"), F.count_distinct("source_name").alias("names")).select(F.when(F.col("hosts") == 0, F.col("names")).otherwise(F.col("hosts")).alias("source_count"))


def first_day(df: DataFrame) -> DataFrame:
    """AGG11: the earliest start and its week's Monday."""
    return df.agg(F.min("start").alias("first_start")).withColumn("week_start", F.to_date(F.date_trunc("WEEK", "first_start")))


def discovery(candidates: DataFrame) -> DataFrame:
    """AGG12."""
    return candidates.agg(F.count("*").alias("found"), F.count_if("requires_manual_review").alias("need_review"), F.count_if(F.col("status") == "resolved").alias("resolved"), F.count_if(F.col("status") == "needs_review").alias("queued"))


def removed(before: DataFrame, after: DataFrame) -> DataFrame:
    """AGG14: rows before, after, and removed."""
    b, a = before.agg(F.count("*").alias("rows_before")), after.agg(F.count("*").alias("rows_after"))
    return b.join(F.broadcast(a), F.lit(True)).withColumn("removed", F.col("rows_before") - F.col("rows_after"))
