"""Candidates: discovery, URL choice, shared-link outliers, resolution, review queue (CAND1-CAND3, AGG10, JOIN9-JOIN11, FCT1, FCT2, SNK4, SNK5, PRJ2, SRC13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.dates import parse_datetime
from kalends.functions.store import stored
from kalends.functions.text import blank, generic_page_title, place_text, salvaged_price
from kalends.functions.urls import AGGREGATOR, host, outbound, site_name
from kalends.operators.scores import combined_confidence, extraction_confidence

#: Set by people; no merge replaces them.
HUMAN_STATUSES = ["manual_review_approved", "approved", "rejected"]


def self_checks(df: DataFrame, aggregator: str = AGGREGATOR, below: float = rules.REVIEW_BELOW) -> DataFrame:
    """CAND1: the aggregator's own URL is cleared; little confidence asks for review."""
    own = F.coalesce(F.contains(host(F.col("candidate_original_url")), F.lit(aggregator)), F.lit(False))
    return df.withColumns({"candidate_original_url": F.when(~own, F.col("candidate_original_url")), "requires_manual_review": F.coalesce("requires_manual_review", F.lit(False)) | (F.col("confidence") < below)})


def chosen_urls(candidates: DataFrame, pages: DataFrame | None = None, aggregator: str = AGGREGATOR) -> DataFrame:
    """CAND2 with JOIN10: the listing's outbound URL, else one from the seed's detail page (+0.50, at most 1).

    pages(url, anchors array<struct<text, href>>) holds fetched detail pages, one row per URL.
    """
    df = candidates.withColumn("_own", blank(F.col("candidate_original_url")))
    if pages is None:
        df = df.withColumn("_detail", F.lit(None).cast("string"))
    else:
        details = pages.groupBy(F.col("url").alias("seed_url")).agg(F.min(outbound(F.col("anchors"), aggregator)).alias("_detail"))
        df = df.join(details, "seed_url", "left").withColumn("_detail", F.when(F.col("_own").isNull(), F.col("_detail")))
    found = F.coalesce("_own", "_detail")
    return df.withColumns({
        "candidate_original_url": found, "confidence": F.when(F.col("_detail").isNotNull(), F.least(F.lit(1.0), F.coalesce("confidence", F.lit(0.0)) + 0.5)).otherwise(F.col("confidence")),
        "review_reason": F.when(found.isNull(), F.lit("no_original_url_found")),
    }).drop("_own", "_detail")


def outlier_urls(df: DataFrame, url: str = "candidate_original_url", least: int = rules.CHROME_LEAST, share: float = rules.CHROME_SHARE) -> DataFrame:
    """AGG10: (url, hits) of URLs that max(least, ceil(share * n)) or more of the n rows share.

    The counts are partial before the shuffle, so a URL that half the rows share costs one row per task.
    """
    n = df.agg(F.count("*").alias("_n"))
    counts = df.filter(F.coalesce(F.col(url), F.lit("")) != "").groupBy(F.col(url).alias("url")).agg(F.count("*").alias("hits"))
    return counts.join(F.broadcast(n), F.lit(True)).filter(F.col("hits") >= F.greatest(F.lit(least), F.ceil(F.lit(share) * F.col("_n")))).drop("_n")


def split_shared(df: DataFrame, url: str = "candidate_original_url") -> tuple[DataFrame, DataFrame]:
    """JOIN11: rows with a URL of their own, and rows with an outlier URL. Fewer than 1 / share URLs can be outliers."""
    shared = outlier_urls(df, url).select(F.col("url").alias("_shared"))
    match = F.col(url) == F.col("_shared")
    return df.join(F.broadcast(shared), match, "left_anti"), df.join(F.broadcast(shared), match, "left_semi").withColumn("review_reason", F.lit("shared_site_link"))


FACTS = ["title", "start_text", "end_text", "location_name", "location_address", "cost_text", "description_snippet", "registration_url", "image_url", "organizer"]


def merge_facts(*sources: Column) -> Column:
    """FCT1: field by field the first filled value, sources in order of trust."""
    return F.struct(*[F.coalesce(*[F.nullif(s[f], F.lit("")) for s in sources]).alias(f) for f in FACTS])


def arbitrate_title(extracted: Column, discovered: Column) -> Column:
    """FCT2: the page's title unless it is generic and the discovered one is not."""
    return F.when(~generic_page_title(extracted), extracted).otherwise(F.coalesce(blank(discovered), blank(extracted)))


def resolve(candidates: DataFrame, pages: DataFrame, aggregator: str = AGGREGATOR, below: float = rules.REVIEW_BELOW) -> tuple[DataFrame, DataFrame]:
    """CAND3: (resolved raw records, candidates for review).

    pages(url, final_url, anchors, facts struct, json_ld boolean) are fetched pages, one row per URL.
    Shared links are removed before pages are joined.
    """
    chosen = stored(chosen_urls(candidates, pages, aggregator), "chosen")
    missing = chosen.filter("candidate_original_url is null")
    own, shared = split_shared(chosen.filter("candidate_original_url is not null"))
    page = F.min(F.struct("final_url", "facts", "json_ld"))  # of a URL's several pages always the same one
    fetched = pages.groupBy(F.col("url").alias("candidate_original_url")).agg(page.alias("_page")).select("candidate_original_url", "_page.*", F.lit(True).alias("_there"))
    met = stored(own.join(fetched, "candidate_original_url", "left"), "met")
    dead = met.filter("_there is null").withColumn("review_reason", F.lit("original_url_dead"))
    found = F.struct(F.col("discovered_title").alias("title"), F.col("discovered_date_text").alias("start_text"), F.col("discovered_location_text").alias("location_name"))
    redirected = F.coalesce(F.col("final_url") != F.col("candidate_original_url"), F.lit(False))
    live = met.filter("_there").withColumns({"extraction": extraction_confidence(F.col("facts"), found, redirected, F.col("json_ld"))})
    live = live.withColumn("combined", combined_confidence(F.coalesce("confidence", F.lit(0.0)), F.col("extraction")))
    weak = live.filter(F.col("combined") < below).withColumn("review_reason", F.lit("low_confidence"))
    review = None
    for part in (missing, shared, dead, weak):
        part = part.select(*candidates.columns).withColumn("status", F.lit("needs_review")) if "review_reason" in candidates.columns else part.select(*candidates.columns, "review_reason").withColumn("status", F.lit("needs_review"))
        review = part if review is None else review.unionByName(part)
    return candidate_records(live.filter(F.col("combined") >= below)), review.withColumn("requires_manual_review", F.lit(True))


def candidate_records(live: DataFrame) -> DataFrame:
    """PRJ2: candidate facts as raw records."""
    f = F.col("facts")
    url = F.coalesce(blank(F.col("final_url")), F.col("candidate_original_url"))
    return live.select(
        F.coalesce("original_source_name", site_name(url)).alias("source_name"), url.alias("source_url"), arbitrate_title(f["title"], F.col("discovered_title")).alias("title"),
        F.coalesce(blank(f["start_text"]), F.col("discovered_date_text")).alias("start_text"), f["end_text"].alias("end_text"), F.coalesce(place_text(f["location_name"], f["location_address"]), F.col("discovered_location_text")).alias("location_text"),
        f["description_snippet"].alias("summary_text"), salvaged_price(f["cost_text"]).alias("price_text"), f["registration_url"].alias("registration_url"), f["image_url"].alias("image_url"),
        F.lit("seed_resolved").alias("extracted_from"), F.col("combined").alias("extraction_confidence"), "candidate_id",
    )


def review_queue(queue: DataFrame, week: str, year: int) -> DataFrame:
    """SRC13 with FLT3: open candidates of the week, or without a readable date."""
    day = F.to_date(F.lit(week))
    parsed = parse_datetime(F.col("discovered_date_text"), year)
    return queue.filter(~F.coalesce(F.col("status").isin("published", "rejected"), F.lit(False)) & (parsed.isNull() | F.to_date(parsed).between(day, F.date_add(day, 6))))


def merge_queue(old: DataFrame, new: DataFrame, policy: str = "full") -> DataFrame:
    """SNK4 and SNK5: one row per candidate_id.

    "full": known rows take all new values but keep notes that are not empty. "light": known rows take
    only confidence, status and, unless approved or rejected, notes. A human's old status is never
    replaced. Of repeated new rows the one with the highest confidence counts.
    """
    fields = [c for c in old.columns if c != "candidate_id"]
    one = new.groupBy("candidate_id").agg(F.max_by(F.struct(*fields), F.struct(F.coalesce("confidence", F.lit(-1.0)), F.xxhash64(*fields))).alias("n"))
    both = old.select("candidate_id", F.struct(*fields).alias("o")).join(one, "candidate_id", "full_outer")
    o, n = F.col("o"), F.col("n")
    human = F.coalesce(o["status"].isin(HUMAN_STATUSES), F.lit(False))

    def value(c: str) -> Column:
        if c == "status":
            known = F.when(human, o[c]).otherwise(n[c])
        elif c == "notes":
            known = F.coalesce(F.nullif(o[c], F.lit("")), n[c]) if policy == "full" else F.when(human, o[c]).otherwise(n[c])
        else:
            known = n[c] if policy == "full" or c == "confidence" else o[c]
        return F.when(o.isNull(), n[c]).when(n.isNull(), o[c]).otherwise(known).alias(c)

    return both.select("candidate_id", *[value(c) for c in fields]).select(*old.columns)
