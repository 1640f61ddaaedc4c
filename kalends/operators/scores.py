"""Friendliness and relevance scores (SCO1-SCO5), in whole hundredths until the end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.text import contains_any, holds, named
from kalends.operators.tags import GATE, lower_text, rainy_day


def any_tag(tags: Column, some: list[str]) -> Column:
    return F.arrays_overlap(tags, F.array(*map(F.lit, some)))


def points(condition: Column, n: int) -> Column:
    return F.when(condition, n).otherwise(0)


def filled(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def clamp(hundredths: Column) -> Column:
    return F.least(F.greatest(hundredths, F.lit(0)), F.lit(100)) / 100.0


def friendliness(tags: Column, title: Column, place: Column, summary: Column, image: Column, registration: Column) -> Column:
    """SCO1."""
    age = any_tag(tags, rules.AGE_TAGS)
    total = (
        F.when(age, 30).when(F.array_contains(tags, "teen"), -10).otherwise(0)
        + points(any_tag(tags, rules.KID_VENUE_TAGS), 20) + points(F.array_contains(tags, "free"), 15) + points(F.array_contains(tags, "indoor"), 10)
        + points(any_tag(tags, rules.ENRICHING_TAGS), 10) + points(F.array_contains(tags, "weekend"), 10) + points(contains_any(title, rules.KID_TITLE_WORDS), 10)
        + points(contains_any(place, rules.KID_VENUE_WORDS), 10) + points(rainy_day(tags), 5) + points(filled(summary), 5) + points(filled(image), 5) + points(filled(registration), 5)
    )
    return clamp(total)


def first_rule(low: Column, table: dict[str, list[str]], kind: str, met: Column | None = None) -> Column:
    """JOIN-free first match: the name of the first rule found in the lower-case text."""
    return F.coalesce(*[F.when(GATE.may(met, f"{kind}:{name}") & holds(low, rules.pattern(some)), F.lit(name)) for name, some in table.items()])


def adult_hits(low: Column, met: Column | None = None) -> Column:
    return named([(name, GATE.may(met, f"adult:{name}") & holds(low, rules.pattern(some, rules.ADULT_NOT_BEFORE))) for name, some in rules.ADULT_RULES.items()])


def with_relevance(df: DataFrame, title: str = "title", summary: str = "summary", tags: str = "tags", source: str = "source_name", stance: dict[str, int] = rules.SOURCE_STANCE, out: str = "relevance", met: Column | None = None) -> DataFrame:
    """SCO2 with JOIN13: struct(score, label, reasons). met: GATE's bits, where they are known."""
    w = rules.RELEVANCE
    df = df.withColumn("_low", lower_text(F.col(title), F.col(summary)))
    low = F.col("_low")
    df = df.withColumns({"_family": first_rule(low, rules.FAMILY_RULES, "family", met), "_activity": first_rule(low, rules.ACTIVITY_RULES, "activity", met), "_adult": adult_hits(low, met), "_rescue": first_rule(low, rules.RESCUE_RULES, "rescue", met)})
    t = F.col(tags)
    age, teen = F.array_intersect(F.array(*map(F.lit, sorted(rules.AGE_TAGS))), t), F.array_contains(t, "teen")
    lean = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in stance.items() for x in kv]), F.coalesce(F.col(source), F.lit(""))), F.lit(0)) if stance else F.lit(0)
    adult = F.size("_adult")
    rescue = F.when(adult > 0, F.col("_rescue"))
    total = w["base"] + lean + F.when(F.size(age) > 0, w["age"]).when(teen, w["teen"]).otherwise(0) + points(F.col("_family").isNotNull(), w["family"]) + points(F.col("_activity").isNotNull(), w["activity"]) + adult * w["adult"] + points(rescue.isNotNull(), w["rescue"])
    kept = F.least(F.greatest(total, F.lit(0)), F.lit(100))
    label = F.lit("adult_service")
    for least, name in reversed(rules.RELEVANCE_LABELS):
        label = F.when(kept >= least, name).otherwise(label)
    reasons = F.concat(
        F.array_compact(F.array(F.when(F.size(age) > 0, F.concat(F.lit("age_tag:"), F.array_join(age, "+"))).when(teen, F.lit("age_tag:teen")), F.concat(F.lit("pos:"), F.col("_family")), F.concat(F.lit("activity:"), F.col("_activity")))),
        F.transform("_adult", lambda a: F.concat(F.lit("neg:"), a)), F.array_compact(F.array(F.concat(F.lit("rescue:"), rescue))),
    )
    return df.withColumn(out, F.struct((kept / 100.0).alias("score"), label.alias("label"), reasons.alias("reasons"))).drop("_low", "_family", "_activity", "_adult", "_rescue")


def discovery_confidence(url: Column, has_date: Column, has_place: Column) -> Column:
    """SCO3."""
    there = filled(url)
    return clamp(points(there, 50) + points(there & F.startswith(url, F.lit("https://")), 10) + points(has_date, 25) + points(has_place, 15))


def extraction_confidence(facts: Column, found: Column, redirected: Column, json_ld: Column) -> Column:
    """SCO4: completeness of extracted facts, with partial credit for discovered ones and two bonuses."""
    total = (
        F.when(filled(facts["title"]), 30).when(filled(found["title"]), 15).otherwise(0) + F.when(filled(facts["start_text"]), 30).when(filled(found["start_text"]), 20).otherwise(0)
        + F.when(filled(facts["location_name"]) | filled(facts["location_address"]), 20).when(filled(found["location_name"]), 10).otherwise(0)
        + points(facts["cost_text"].isNotNull(), 10) + points(filled(facts["description_snippet"]), 5) + points(filled(facts["registration_url"]), 5)
        + points(F.coalesce(redirected, F.lit(False)), 10) + points(F.coalesce(json_ld, F.lit(False)), 5)
    )
    return clamp(total)


def combined_confidence(discovery: Column, extraction: Column) -> Column:
    """SCO5: rounded to four places; below one half goes to review."""
    return F.round(0.3 * discovery + 0.7 * extraction, 4)
