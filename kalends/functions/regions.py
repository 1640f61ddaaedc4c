"""Places: service area, virtual events, geocoder queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.text import blank, geo_query, has, without_room

# Wording of online-only events.
VIRTUAL_PLACE = r"^(?:virtual|online|webinar|remote|zoom|livestream|live\s*stream|tbd|tba|n/?a|to\s+be\s+(?:announced|determined)|your\s+preferred\s+\w[\w\s]*|anywhere|various\s+locations?)$"
VIRTUAL_IN_PLACE = r"\b(?:virtual\s+event|online\s+(?:event|class|program|session|meeting)|zoom\s+meeting|live\s*stream|webinar)\b"
VIRTUAL_TITLE = r"\b(?:webinar|webex|livestream|virtual|zoom)\b|live\s+stream\b|\bonline\s+(?:class|course|event|program|session|storytime|workshop|camp|activity|activities|field\s*trip|meeting|seminar|registration)\b|\bteams\s+(?:call|link|meeting|class|session|event|webinar)\b"
VIRTUAL_TEXT = r"\b(?:join\s+(?:us\s+)?online|attend(?:ing)?\s+online|virtual\s+event|online\s+event|hosted\s+(?:virtually|online)|broadcast\s+(?:live\s+)?online|(?:zoom|teams)\s+(?:link|meeting|call)|webex\s+(?:link|meeting)|no\s+in[- ]person|not\s+(?:held\s+)?in[- ]person)\b"
COUNTY_REGIONS = {"fairfax": "Fairfax County, VA", "arlington": "Arlington, VA", "loudoun": "Loudoun County, VA", "prince william": "Prince William County, VA", "alexandria": "Alexandria, VA"}


def in_area(latitude: Column, longitude: Column, area: tuple = rules.SERVICE_AREA) -> Column:
    """GEO1: inside the service area, bounds included; false for missing coordinates."""
    low, high, west, east = area
    return F.coalesce(latitude.between(low, high) & longitude.between(west, east), F.lit(False))


def is_virtual(tags: Column, place: Column, title: Column, summary: Column, note: Column) -> Column:
    """GEO2."""
    spot = F.trim(place)
    return F.coalesce(F.array_contains(tags, "virtual"), F.lit(False)) | has(spot, VIRTUAL_PLACE) | has(spot, VIRTUAL_IN_PLACE) | has(title, VIRTUAL_TITLE) | has(summary, VIRTUAL_TEXT) | has(note, VIRTUAL_TEXT)


def county_region(county: Column) -> Column:
    """JOIN7."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in COUNTY_REGIONS.items() for x in kv]), F.lower(F.trim(county)))


def queries(address: Column, name: Column, city: Column, county: Column, hint: Column | None = None) -> Column:
    """GEO4 with DED7: distinct geocoder queries, the most specific first."""
    a, n, city, county = F.nullif(geo_query(address), F.lit("")), F.nullif(geo_query(without_room(name)), F.lit("")), blank(city), blank(county)
    built = [
        F.concat(n, F.lit(", "), hint if hint is not None else F.lit(None).cast("string")),
        F.concat(a, F.lit(", "), city), a,
        F.concat(n, F.lit(", "), city, F.lit(", "), county, F.lit(" County, VA")), F.concat(n, F.lit(", "), city, F.lit(", VA")),
        F.concat(n, F.lit(", "), county_region(county)), n,
    ]
    return F.array_distinct(F.array_compact(F.array(*built)))


def hit_confidence(map_id: Column) -> Column:
    """GEO8: 0.9 for a hit with a map id, else 0.5."""
    return F.when(map_id.isNotNull(), 0.9).otherwise(0.5)
