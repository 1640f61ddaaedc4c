"""Row filters; each also offers what it dropped where the feed reports it (FLT1-FLT8, SET5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.fence import fenced
from kalends.functions.store import stored
from kalends.functions.text import has


def split(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """SET5: rows where keep is true, and all others, null included."""
    ok = F.coalesce(keep, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def upcoming(as_of: str) -> Column:
    """FLT1: not finished before as_of."""
    return F.to_date(F.coalesce("end", "start")) >= F.to_date(F.lit(as_of))


def in_week(week: str, column: str = "start") -> Column:
    """FLT2: within the seven days from week."""
    day = F.to_date(F.lit(week))
    return F.to_date(column).between(day, F.date_add(day, 6))


def candidate_in_week(week: str, parsed: Column) -> Column:
    """FLT3: in the week, or without a date that can be read."""
    day = F.to_date(F.lit(week))
    return parsed.isNull() | F.to_date(parsed).between(day, F.date_add(day, 6))


def relevance_split(df: DataFrame, threshold: float = rules.PUBLISH_THRESHOLD, guard: float = rules.GUARD_SHARE, score: str = "family_relevance_score") -> tuple[DataFrame, DataFrame]:
    """FLT4: rows at or above the threshold; if more than the guard's share would go, nothing goes.

    The guard is one row, joined by broadcast. df is stored first, for guard and both parts read it.
    """
    df = stored(df, "relevance")
    low = F.coalesce(F.col(score) < threshold, F.lit(False))
    share = df.agg(F.count_if(low).alias("_low"), F.count("*").alias("_all")).select((F.col("_low") > guard * F.col("_all")).alias("_guard"))
    judged = fenced(df.join(F.broadcast(share), F.lit(True)), "_gone", low & ~F.col("_guard"))
    return judged.filter(~F.col("_gone")).drop("_guard", "_gone"), judged.filter("_gone").drop("_guard", "_gone")


ADULT_ONLY = r"\b(?:adults?\s+only|ages?\s+(?:18|21)\s*(?:\+|and\s+(?:up|over))|18\+|21\+|for\s+adults|seniors?\s+only)"
FAMILY_WORDS = r"\b(?:famil(?:y|ies)|child(?:ren)?|kids?|toddlers?|bab(?:y|ies)|preschool|story\s*time|teens?|tweens?|youth|all\s+ages)\b"


def for_families(text: Column, permissive: bool = False) -> Column:
    """FLT6: not for adults only and, unless permissive, worded for families."""
    ok = ~has(text, ADULT_ONLY)
    return ok if permissive else ok & has(text, FAMILY_WORDS)


def open_candidates(df: DataFrame) -> DataFrame:
    """FLT8: neither rejected nor published, with one more attempt counted."""
    return df.filter(~F.coalesce(F.col("status").isin("rejected", "published"), F.lit(False))).withColumn("resolution_attempts", F.coalesce("resolution_attempts", F.lit(0)) + 1)
