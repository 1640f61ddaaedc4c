"""Tags, settings and weather flags (TAG1-TAG3, SET2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.dates import time_tags
from kalends.functions.gates import Gate
from kalends.functions.text import contains_any, has, holds, named


#: A bit for each rule of tags and relevance, and for each price rule that begins with a word.
GATE = Gate(rules.TAGS | {f"family:{n}": r for n, r in rules.FAMILY_RULES.items()} | {f"activity:{n}": r for n, r in rules.ACTIVITY_RULES.items()} | {f"adult:{n}": r for n, r in rules.ADULT_RULES.items()} | {f"rescue:{n}": r for n, r in rules.RESCUE_RULES.items()} | {"price:donation": rules.DONATION_PHRASES, "price:program": rules.PAID_PROGRAM_PHRASES})


def sorted_tags(c: Column) -> Column:
    return F.sort_array(F.array_distinct(c))  # compiled, with all that feeds it; array_sort is not


def text_tags(low: Column, met: Column | None = None) -> Column:
    """Of a lower-case text. One projection: each tag's alternatives are one pattern, tried where GATE's bits met, if given, allow it."""
    return named([(tag, GATE.may(met, tag) & holds(low, rules.pattern(some, rules.TAG_NOT_BEFORE))) for tag, some in rules.TAGS.items()])


def lower_text(*parts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *[F.nullif(c, F.lit("")) for c in parts]))


def derive_tags(title: Column, summary: Column, place: Column, start: Column, cost_type: Column, extra: Column | None = None, low: Column | None = None, met: Column | None = None) -> Column:
    """TAG1 with DT3: sorted tags from text, source, price and start, allowed ones only. low: lower_text() as a column; met: GATE's bits."""
    low = lower_text(title, summary, place) if low is None else low
    own = F.transform(F.coalesce(extra, F.array().cast("array<string>")), lambda t: F.lower(F.trim(t))) if extra is not None else F.array().cast("array<string>")
    free = named([("free", cost_type == "free")])
    every = F.concat(text_tags(low, met), own, free, F.coalesce(time_tags(start), F.array().cast("array<string>")))
    return sorted_tags(F.array_intersect(every, F.array(*map(F.lit, rules.ALLOWED_TAGS))))


def settle_setting(tags: Column, title: Column, summary: Column, place: Column, extra: Column | None = None, hint_rainy: Column | None = None) -> Column:
    """TAG2: keeps one of indoor and outdoor where source, venue hint, venue words or text decide."""
    own = F.transform(F.coalesce(extra, F.array().cast("array<string>")), lambda t: F.lower(F.trim(t))) if extra is not None else F.array().cast("array<string>")
    hint = hint_rainy if hint_rainy is not None else F.lit(None).cast("boolean")
    said_in, said_out = F.array_contains(own, "indoor"), F.array_contains(own, "outdoor")
    venue_in, venue_out = contains_any(place, rules.INDOOR_VENUE_WORDS), contains_any(place, rules.OUTDOOR_VENUE_WORDS)
    text = F.concat_ws(" ", title, summary)
    text_in, text_out = has(text, rules.pattern(rules.INDOOR_TEXT)), has(text, rules.pattern(rules.OUTDOOR_TEXT))
    both = F.array_contains(tags, "indoor") & F.array_contains(tags, "outdoor")
    loser = F.when(said_out & ~said_in, "indoor").when(said_in & ~said_out, "outdoor").when(hint, "outdoor").when(~hint, "indoor").when(venue_in & ~venue_out, "outdoor").when(venue_out & ~venue_in, "indoor").when(text_in & ~text_out, "outdoor").when(text_out & ~text_in, "indoor")
    return F.when(both & loser.isNotNull(), F.filter(tags, lambda t: t != loser)).otherwise(tags)


def rainy_day(tags: Column, hint: Column | None = None) -> Column:
    """TAG3: virtual, or indoor and not outdoor; a venue hint decides where there is one."""
    own = F.array_contains(tags, "virtual") | (F.array_contains(tags, "indoor") & ~F.array_contains(tags, "outdoor"))
    return F.coalesce(hint, own) if hint is not None else own
