"""Raw records to events, or rejects with a reason (NRM, PRJ1, SET1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends import schemas
from kalends.functions.dates import iso, parse_datetime
from kalends.functions.fence import fenced
from kalends.functions.store import stored
from kalends.functions.text import blank, clean_summary, clean_title, location, place_text, title_case
from kalends.functions.urls import event_id, url_or_null
from kalends.operators.lookup import apply_hint, with_hint
from kalends.operators.notes import with_short_note
from kalends.operators.pricing import with_pricing
from kalends.operators.quality import reject_reason
from kalends.operators.scores import friendliness, with_relevance
from kalends.operators.tags import GATE, derive_tags, lower_text, rainy_day, settle_setting

HINT_KEYS = ["keyword", "tags", "rainy", "city", "county"]


def union_all(parts: list[DataFrame]) -> DataFrame:
    """SET1."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def conform(raw: DataFrame, carry: list[str] = ()) -> DataFrame:
    """The declared raw columns, in order; unknown ones are dropped but for those to carry, missing ones are null."""
    declared = raw.sparkSession.createDataFrame([], schemas.RAW).schema
    return raw.select(*carry, *[(F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in declared])


def places(raw: DataFrame) -> DataFrame:
    """(ingest_seq, location_name, location_address, city, county): what normalise() makes of the place columns alone."""
    raw = conform(raw)
    given = lambda n: F.coalesce(blank(F.col(n)), F.col("_place")[n]).alias(n)
    return raw.withColumn("_place", location(F.col("location_text"))).select(
        "ingest_seq", F.col("_place")["location_name"].alias("location_name"),
        F.col("_place")["location_address"].alias("location_address"), given("city"), given("county"),
    )


EVENT_COLUMNS = ["ingest_seq", "pricing_reason", *[f.split()[0] for f in schemas.EVENT.split(", ")]]


def normalise(raw: DataFrame, as_of: str, hints: list[tuple] = (), once: bool = False) -> tuple[DataFrame, DataFrame]:
    """NRM: (events, rejects). One lazy projection without a shuffle; with once it is stored, for callers that read both.

    hints: ordered venue hints (keyword, tags, rainy, city, county). Rejects carry EMPTY_TITLE,
    GENERIC_TITLE, BAD_START or SCHEMA with the field at fault.
    """
    both = judged(raw, as_of, hints)
    if once:
        both = stored(both.select(*EVENT_COLUMNS, "source_id", "raw_title", "reject"), "normalised")
    return both.filter("reject is null").select(*EVENT_COLUMNS), both.filter("reject is not null").select("ingest_seq", "source_id", "raw_title", "source_url", F.col("reject").alias("reason"))


def judged(raw: DataFrame, as_of: str, hints: list[tuple] = (), carry: list[str] = ()) -> DataFrame:
    """NRM in one frame: EVENT_COLUMNS, source_id, raw_title, reject (null for an event) and the columns to carry."""
    year = int(as_of[:4])
    # a filter on the start stays above the fence: it parses no date a second time, nor in the tasks of a scan
    df = fenced(conform(raw, carry), "_start", parse_datetime(F.coalesce(blank(F.col("start_text")), F.col("date_text")), year))
    df = df.withColumns({"_title": clean_title(F.col("title")), "_end": parse_datetime(F.col("end_text"), year), "summary": clean_summary(F.col("summary_text")), "_place": location(F.col("location_text"))})
    df = df.withColumns({
        "raw_title": F.col("title"), "title": title_case(F.col("_title")), "start": F.col("_start"), "end": F.col("_end"), "location_name": F.col("_place")["location_name"], "location_address": F.col("_place")["location_address"],
        "city": F.coalesce(blank(F.col("city")), F.col("_place")["city"]), "county": F.coalesce(blank(F.col("county")), F.col("_place")["county"]),
        "registration_url": url_or_null(F.col("registration_url")), "image_url": url_or_null(F.col("image_url")), "all_day": F.coalesce("all_day", F.lit(False)),
        "extracted_from": F.coalesce(blank(F.col("extracted_from")), F.lit("direct_scraper")), "extraction_confidence": F.coalesce("extraction_confidence", F.lit(1.0)),
    })
    words = lambda *names: lower_text(*map(F.col, names))
    df = df.withColumn("_words", words("title", "summary", "location_name")).withColumn("_met", GATE.met(F.concat_ws(" ", "_words", words("price_text"))))
    met = F.col("_met")
    df = with_pricing(df, met=met).withColumn("id", event_id(F.col("title"), F.col("start"), F.col("location_name"), F.col("source_url")))
    df = df.withColumns({f: F.col("pricing")[f] for f in ("cost_type", "price_text", "is_free", "price_type", "pricing_summary", "registration_required", "registration_fee_text", "extracted_price_text")} | {"pricing_reason": F.col("pricing")["reason"]})
    df = df.withColumn("tags", derive_tags(F.col("title"), F.col("summary"), F.col("location_name"), F.col("start"), F.col("cost_type"), F.col("extra_tags"), F.col("_words"), met))
    if hints:
        df = with_hint(df, ["location_name", "title", "source_url"], list(hints), HINT_KEYS)
        df = apply_hint(df.withColumn("rainy_day_friendly", F.lit(None).cast("boolean")))
        df = df.withColumn("tags", settle_setting(F.col("tags"), F.col("title"), F.col("summary"), F.col("location_name"), F.col("extra_tags"), F.col("hint")["rainy"])).withColumn("rainy_day_friendly", rainy_day(F.col("tags"), F.col("hint")["rainy"])).drop("hint")
    else:
        df = df.withColumn("tags", settle_setting(F.col("tags"), F.col("title"), F.col("summary"), F.col("location_name"), F.col("extra_tags"))).withColumn("rainy_day_friendly", rainy_day(F.col("tags")))
    df = df.withColumn("family_friendly_score", friendliness(F.col("tags"), F.col("title"), F.col("location_name"), F.col("summary"), F.col("image_url"), F.col("registration_url")))
    df = with_relevance(df, met=met).withColumns({"family_relevance_score": F.col("relevance")["score"], "family_relevance_label": F.col("relevance")["label"]})
    df = with_short_note(df).withColumns({"latitude": F.lit(None).cast("double"), "longitude": F.lit(None).cast("double"), "geo_confidence": F.lit(None).cast("double"), "is_mappable": F.lit(False), "geo_within_service_region": F.lit(False), "last_verified_at": F.to_timestamp(F.lit(as_of))})
    reject = reject_reason(given_tags=bool(hints), derived=False)  # tags, scores and notes derived here hold by construction
    why = F.when(F.coalesce(F.trim("raw_title"), F.lit("")) == "", "EMPTY_TITLE").when(F.col("title").isNull(), "GENERIC_TITLE").when(F.col("start").isNull(), "BAD_START").when(reject.isNotNull(), F.concat(F.lit("SCHEMA:"), reject))
    return fenced(df, "reject", why)


def published_to_raw(events: DataFrame) -> DataFrame:
    """PRJ1: published rows as raw records; ages, places and provenance are carried through."""
    return events.select(
        F.col("ingest_seq") if "ingest_seq" in events.columns else F.lit(None).cast("long").alias("ingest_seq"), "source_name", "source_url", "title", iso(F.col("start")).alias("start_text"), iso(F.col("end")).alias("end_text"), "all_day",
        place_text(F.col("location_name"), F.col("location_address")).alias("location_text"), F.col("summary").alias("summary_text"), "price_text", "registration_url", "image_url", "city", "county", "age_min", "age_max",
        F.coalesce("extracted_from", F.lit("direct_scraper")).alias("extracted_from"), "extraction_confidence",
    )
