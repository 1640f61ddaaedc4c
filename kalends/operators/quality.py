"""Data quality: construction checks and validation rules as (code, severity, message, Column) rows (DQ0, DQ1, AGG9)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.fence import fenced
from kalends.functions.store import stored
from kalends.functions.text import has, machine_name, named, several_sentences
from kalends.functions.urls import shortener, valid_url
from kalends.operators.dedupe import duplicate_flags

PROVENANCE = ["direct_scraper", "seed_resolved", "manual_review_approved", "curated"]
ADDRESS_IN_NAME = r"\b\d{3,5}\s+[A-Z][a-z]|Address[A-Z\d]|Get\s+Directions|Store\s+Hours?|Phone\s+Number"


def reject_reason(given_tags: bool = True, derived: bool = True) -> Column:
    """DQ0: why a row cannot be an event; null if it can.

    Without given_tags, tags are not looked at; without derived, the scores and the note are not: for rows of which they
    have just been derived, within their bounds, so that no verdict makes a query compute what it does not read.
    """
    c = F.col
    outside = lambda x, low, high: x.isNotNull() & ~x.between(low, high)
    return (
        F.when(F.coalesce(F.trim("title"), F.lit("")) == "", "title")
        .when(c("start").isNull(), "start")
        .when((F.coalesce(F.size(F.array_except("tags", F.array(*map(F.lit, rules.ALLOWED_TAGS)))), F.lit(0)) > 0) if given_tags else F.lit(False), "tags")
        .when(outside(c("age_min"), 0, 99) | outside(c("age_max"), 0, 99) | (c("age_min") > c("age_max")), "ages")
        .when(c("end") < c("start"), "end")
        .when((F.char_length("short_note") > 200) if derived else F.lit(False), "short_note")
        .when(~F.coalesce(c("extracted_from").isin(PROVENANCE), F.lit(True)), "extracted_from")
        .when(((outside(c("family_friendly_score"), 0, 1) | outside(c("family_relevance_score"), 0, 1)) if derived else F.lit(False)) | outside(c("extraction_confidence"), 0, 1) | outside(c("geo_confidence"), 0, 1), "score")
        .when(outside(c("latitude"), -90, 90) | outside(c("longitude"), -180, 180), "coordinates")
    )


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that pass DQ0, and the others with their reason."""
    judged = fenced(df, "reason", reject_reason())
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


def rule_table(banned_hosts: list[str]) -> list[tuple[str, str, str, Column]]:
    """DQ1's per-row rules. Append a row to add a rule (EXT3)."""
    c = F.col
    given = lambda n: F.coalesce(c(n), F.lit("")) != ""
    banned = lambda n: F.coalesce(reduce(or_, [F.contains(F.lower(n), F.lit(b)) for b in banned_hosts], F.lit(False)), F.lit(False))
    tag = lambda t: F.coalesce(F.array_contains("tags", t), F.lit(False))
    rainy = F.coalesce(c("rainy_day_friendly"), F.lit(False))
    return [
        ("EMPTY_TITLE", "error", "the title is blank", F.coalesce(F.trim("title"), F.lit("")) == ""),
        ("TITLE_TOO_LONG", "warning", "the title has over 300 characters", F.char_length("title") > 300),
        ("INVALID_START_DATETIME", "error", "there is no start", c("start").isNull()),
        ("INVALID_SOURCE_URL", "error", "source_url is not http or https", ~valid_url(c("source_url"))),
        ("INVALID_REGISTRATION_URL", "warning", "registration_url is not http or https", given("registration_url") & ~valid_url(c("registration_url"))),
        ("INVALID_IMAGE_URL", "warning", "image_url is not http or https", given("image_url") & ~valid_url(c("image_url"))),
        ("DISALLOWED_TAGS", "error", "a tag is not in the allowed set", F.size(F.array_except("tags", F.array(*map(F.lit, rules.ALLOWED_TAGS)))) > 0),
        ("SCORE_OUT_OF_RANGE", "error", "the friendliness score is outside 0 to 1", ~c("family_friendly_score").between(0, 1)),
        ("SUMMARY_TOO_LONG", "warning", "the summary has over 500 characters", F.char_length("summary") > 500),
        ("INVALID_AGE_RANGE", "error", "age_min exceeds age_max", c("age_min") > c("age_max")),
        ("BANNED_SOURCE_HOST", "error", "source_url is on a banned host", banned("source_url")),
        ("BANNED_REGISTRATION_HOST", "warning", "registration_url is on a banned host", banned("registration_url")),
        ("NO_ACTIONABLE_URL", "error", "neither URL is valid", ~valid_url(c("source_url")) & ~valid_url(c("registration_url"))),
        ("INVALID_SHORT_NOTE", "warning", "the note is too long or has several sentences", (F.char_length("short_note") > 200) | several_sentences(c("short_note"))),
        ("LOCATION_NAME_HAS_ADDRESS", "warning", "the place name holds an address or boilerplate", has(c("location_name"), ADDRESS_IN_NAME)),
        ("SUMMARY_HAS_SHORTCODES", "error", "the summary holds page-builder fragments", has(c("summary"), r"\[/?vc_")),
        ("MACHINE_SOURCE_NAME", "warning", "the source name looks generated", machine_name(c("source_name"))),
        ("TITLE_MATCHES_VENUE", "warning", "the title is the place name", F.lower(F.trim("title")) == F.lower(F.trim("location_name"))),
        ("SHORTENER_SOURCE_URL", "warning", "source_url is a shortened link", shortener(c("source_url"))),
        ("PRICE_TEXT_TOO_LONG", "warning", "the price text has over 80 characters", F.char_length("price_text") > 80),
        ("INDOOR_NOT_RAINY_DAY", "warning", "indoor but not for rainy days", tag("indoor") & ~rainy),
        ("OUTDOOR_RAINY_DAY_FRIENDLY", "warning", "outdoor but for rainy days", tag("outdoor") & ~tag("indoor") & rainy),
        ("LOW_EXTRACTION_CONFIDENCE", "warning", "resolved with little confidence", (c("extracted_from") == "seed_resolved") & (c("extraction_confidence") < 0.6)),
    ]


def with_issues(df: DataFrame, banned_hosts: list[str] = (), table: list | None = None) -> DataFrame:
    """Adds issues: array<struct<rule, severity, message>>, one pass and no shuffle.

    The numbers of the rules that apply are found by compiled code; structs are made for rows that have any.
    """
    rows = table or rule_table(list(banned_hosts))
    texts = F.array(*[F.struct(F.lit(code).alias("rule"), F.lit(severity).alias("severity"), F.lit(message).alias("message")) for code, severity, message, _ in rows])
    met = df.withColumn("_met_rules", named([(str(i), F.coalesce(cond, F.lit(False))) for i, (*_, cond) in enumerate(rows)]))
    some = F.transform("_met_rules", lambda i: F.get(texts, i.cast("int")))
    return met.withColumn("issues", F.when(F.size("_met_rules") > 0, some).otherwise(F.slice(texts, 1, 0))).drop("_met_rules")


def issues(df: DataFrame, banned_hosts: list[str] = ()) -> DataFrame:
    """DQ1 with DED6: one row per issue (id, title, rule, severity, message). df's rules are computed once."""
    judged = stored(with_issues(df, banned_hosts).select("id", "title", "ingest_seq", "issues"), "issues")
    own = judged.select("id", "title", F.inline("issues"))
    twice = duplicate_flags(judged.drop("issues")).select("id", "title", F.lit("DUPLICATE_ID").alias("rule"), F.lit("error").alias("severity"), F.concat(F.lit("id already used by "), F.coalesce("first_title", F.lit(""))).alias("message"))
    return own.unionByName(twice)


def totals(df: DataFrame, banned_hosts: list[str] = ()) -> DataFrame:
    """AGG9: one row; repeated ids count as errors but not as failed rows."""
    of = lambda severity: F.size(F.filter("issues", lambda i: i["severity"] == severity))
    judged = with_issues(df, banned_hosts).select("id", of("error").alias("e"), of("warning").alias("w"))
    # one pass: counts by id, then over ids; an id's rows after the first are one error each
    by_id = judged.groupBy("id").agg(
        F.count("*").alias("n"), F.count_if(F.col("e") == 0).alias("passed"), F.sum("e").alias("e"), F.sum("w").alias("w")
    )
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0))
    errors = whole("e") + whole(F.col("n") - 1)
    return by_id.agg(
        whole("n").alias("total"), whole("passed").alias("passed"), (whole("n") - whole("passed")).alias("failed"),
        errors.alias("errors"), whole("w").alias("warnings"), (errors == 0).alias("is_clean"),
    )


def publishable(df: DataFrame, banned_hosts: list[str] = ()) -> bool:
    """The gate before writers: false if any error exists. One action."""
    return bool(totals(df, banned_hosts).first()["is_clean"])


