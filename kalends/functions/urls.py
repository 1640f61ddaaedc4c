"""URL and identity functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hosts that are never an event's own page, and link shorteners.
UTILITY_HOSTS = ["facebook.com", "twitter.com", "x.com", "instagram.com", "youtube.com", "linkedin.com", "pinterest.com", "tiktok.com", "google.com", "calendar.google.com", "maps.google.com", "apple.com", "outlook.live.com", "outlook.office.com", "outlook.office365.com", "addtocalendar.com", "addevent.com", "mailto", "gmail.com"]
SHORTENERS = ["bit.ly", "tinyurl.com", "t.co", "ow.ly", "buff.ly", "goo.gl", "short.io", "rb.gy", "cutt.ly", "is.gd", "lnkd.in", "dlvr.it", "rebrand.ly", "rebrandly.com"]
#: The seed aggregator's domain; a parameter of every function that needs one.
AGGREGATOR = "aggregator.example.org"


def valid_url(c: Column) -> Column:
    """URL1: an http or https URL with a host."""
    return F.coalesce(F.trim(c).rlike(r"(?i)^https?://[^\s/]+"), F.lit(False))


def url_or_null(c: Column) -> Column:
    return F.when(valid_url(c), F.trim(c))


def host(c: Column) -> Column:
    """URL2: lower-case host without a leading www."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(F.trim(c), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), r"^www\.", ""), F.lit(""))


def within(h: Column, domains: list[str]) -> Column:
    """Whether a host is one of the domains or below one."""
    hit = F.lit(False)
    for d in domains:
        hit = hit | (h == d) | F.endswith(h, F.lit("." + d))
    return F.coalesce(hit, F.lit(False))


def original_host(c: Column, aggregator: str = AGGREGATOR) -> Column:
    """URL3: could be an event's own page: absolute, not the aggregator's, not a social or calendar link."""
    h = host(c)
    return F.coalesce(c.rlike(r"^https?://") & ~F.contains(h, F.lit(aggregator)) & ~within(h, UTILITY_HOSTS), F.lit(False))


def shortener(c: Column) -> Column:
    """URL6: a link shortener's host."""
    return F.coalesce(host(c).isin(SHORTENERS), F.lit(False))


def outbound(anchors: Column, aggregator: str = AGGREGATOR) -> Column:
    """URL4: of anchors array<struct<text, href>> the first priority-worded link, else the first https one."""
    fit = F.filter(anchors, lambda a: original_host(a["href"], aggregator))
    worded = F.filter(fit, lambda a: F.coalesce(a["text"].rlike(r"(?i)\b(?:website|more info|details|learn more|register|tickets|official|event page)\b"), F.lit(False)))
    secure = F.filter(fit, lambda a: F.startswith(a["href"], F.lit("https://")))
    return F.coalesce(F.try_element_at(worded, F.lit(1))["href"], F.try_element_at(secure, F.lit(1))["href"])


def detail_url(href: Column, aggregator: str = AGGREGATOR) -> Column:
    """URL5: the absolute detail page; null for fragments, listing pages and other sites."""
    full = F.when(F.startswith(href, F.lit("/")), F.concat(F.lit(f"https://{aggregator}"), href)).otherwise(href)
    path = F.regexp_replace(F.regexp_extract(full, r"^https?://[^/?#]*([^?#]*)", 1), "^$", "/")
    listing = path.rlike(r"(?i)^/calendar/(?:list|month|day|week|today|upcoming)?/?$")
    return F.when(F.coalesce(href, F.lit("")).isin("", "#") | ~F.coalesce(F.contains(host(full), F.lit(aggregator)), F.lit(False)) | listing, None).otherwise(full)


def site_name(c: Column) -> Column:
    """STR18: a readable name from a host."""
    return F.initcap(F.translate(F.regexp_replace(host(c), r"\.\w+$", ""), "-_", "  "))


def event_id(title: Column, start: Column, place: Column, url: Column) -> Column:
    """HSH1: 16 hex digits over title, start, place and URL; missing parts count as empty."""
    part = lambda c: F.coalesce(c, F.lit(""))
    iso = F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss")
    return F.substring(F.sha2(F.concat_ws("|", part(F.lower(F.trim(title))), part(iso), part(F.lower(F.trim(place))), part(url)), 256), 1, 16)


def candidate_id(seed_url: Column, title: Column) -> Column:
    """HSH2: 16 hex digits over the seed URL and the title."""
    return F.substring(F.sha2(F.concat_ws("|", F.coalesce(seed_url, F.lit("")), F.coalesce(F.lower(title), F.lit(""))), 256), 1, 16)
