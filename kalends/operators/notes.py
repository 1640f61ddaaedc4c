"""One-sentence notes from facts alone (NOTE1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.text import blank, contains_any, has, let, squeeze


def cost_phrase(cost: Column, price: Column) -> Column:
    cut = F.regexp_replace(F.substring(price, 1, 40), r"\s+\S*$", "")
    cut = F.nullif(F.regexp_replace(cut, "^[ ,;:—-]+|[ ,;:—-]+$", ""), F.lit(""))
    paid = F.when(F.coalesce(price, F.lit("")) == "", F.lit("Paid")).when(F.char_length(price) <= 40, price).otherwise(F.coalesce(cut, F.lit("Paid")))
    return F.when(cost == "free", F.lit("Free")).when(cost == "paid", paid).when(cost == "suggested_donation", F.lit("Suggested donation"))


def setting_phrase(tags: Column) -> Column:
    inside, outside = F.array_contains(tags, "indoor"), F.array_contains(tags, "outdoor")
    return F.when(inside & ~outside, "indoor").when(outside & ~inside, "outdoor").when(F.array_contains(tags, "virtual"), "online/virtual")


def activity_phrase(tags: Column, title: Column) -> Column:
    sports = F.array_contains(tags, "sports")
    phrase = F.when(sports & contains_any(title, ["skate", "skating", "ice", "rink"]), "skating session").when(sports & (F.array_contains(tags, "swim") | contains_any(title, ["swim", "pool", "aquatic"])), "swim session")
    return F.coalesce(phrase, *[F.when(F.array_contains(tags, t), F.lit(p)) for t, p in rules.ACTIVITY_PHRASES.items()])


def venue_phrase(place: Column, city: Column, county: Column) -> Column:
    named = blank(place).isNotNull() & ~F.lower(F.trim(place)).isin("virtual", "online") & (F.char_length(place) < 60)
    return F.when(named, F.concat(F.lit("at "), place)).when(blank(city).isNotNull(), F.concat(F.lit("in "), city)).when(blank(county).isNotNull(), F.concat(F.lit("in "), county, F.lit(" County")))


def age_phrase(tags: Column, low: Column, high: Column) -> Column:
    young = F.array_contains(tags, "toddler") & ~F.array_contains(tags, "preschool") & ~F.array_contains(tags, "elementary")
    return (
        F.when((low == 0) & (high <= 3), "for infants and toddlers").when(low.isNotNull() & high.isNotNull(), F.concat(F.lit("for ages "), low.cast("string"), F.lit("–"), high.cast("string")))
        .when(low.isNotNull(), F.concat(F.lit("for ages "), low.cast("string"), F.lit("+"))).when(high.isNotNull(), F.concat(F.lit("for ages up to "), high.cast("string"))).when(young, "for toddlers").when(F.array_contains(tags, "all_ages"), "for all ages")
    )


def direct(text: Column) -> Column:
    """The text as a note, where it is a clean sentence of at most 120 characters."""
    usable = (text != "") & (F.char_length(text) <= 120) & ~text.rlike(r"[.!?]\s+[A-Z]") & ~has(text, rules.NOTE_OPENERS)
    return F.when(usable, F.when(text.rlike("[.!?]$"), text).otherwise(F.concat(text, F.lit("."))))


def plain(summary: Column) -> Column:
    return squeeze(F.regexp_replace(summary, "<[^>]+>", " "))


def capital(t: Column) -> Column:
    return F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1_000_000))


def ended(t: Column) -> Column:
    return F.when(F.endswith(t, F.lit(".")), t).otherwise(F.concat(t, F.lit(".")))


def bounded(t: Column) -> Column:
    return F.when(F.char_length(t) > 200, F.concat(F.rtrim(F.substring(t, 1, 199)), F.lit("."))).otherwise(t)


def fact_words(activity: Column, venue: Column, tags: Column, cost: Column, price: Column, low: Column, high: Column) -> Column:
    return F.concat_ws(" ", cost_phrase(cost, price), setting_phrase(tags), F.coalesce(activity, F.lit("family-friendly event")), venue, age_phrase(tags, low, high))


def short_note(summary: Column, tags: Column, title: Column, cost: Column, price: Column, place: Column, city: Column, county: Column, low: Column, high: Column) -> Column:
    """A clean one-sentence summary of at most 120 characters, else a sentence from the facts; null without an activity or a venue."""
    def built(activity: Column, venue: Column) -> Column:
        short = let(let(let(fact_words(activity, venue, tags, cost, price, low, high), capital), ended), bounded)
        return F.when(activity.isNotNull() | venue.isNotNull(), short)

    facts = let(activity_phrase(tags, title), lambda a: let(venue_phrase(place, city, county), lambda v: built(a, v)))
    return F.coalesce(let(plain(summary), direct), facts)


def with_short_note(df: DataFrame) -> DataFrame:
    """short_note() of an event's own columns. Each step is a column, so it is compiled; inside let() it is interpreted."""
    c = F.col
    df = df.withColumns({"_said": plain(c("summary")), "_activity": activity_phrase(c("tags"), c("title")), "_venue": venue_phrase(c("location_name"), c("city"), c("county"))})
    df = df.withColumn("_facts", fact_words(c("_activity"), c("_venue"), c("tags"), c("cost_type"), c("price_text"), c("age_min"), c("age_max")))
    df = df.withColumn("_facts", capital(c("_facts"))).withColumn("_facts", ended(c("_facts")))
    facts = F.when(c("_activity").isNotNull() | c("_venue").isNotNull(), bounded(c("_facts")))
    return df.withColumn("short_note", F.coalesce(direct(c("_said")), facts)).drop("_said", "_activity", "_venue", "_facts")
