"""Lookups against rule tables and dimensions (JOIN1-JOIN8, JOIN12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends.functions.automaton import first_keyword
from kalends.functions.text import blank
from kalends.functions.urls import host

#: Above so many rules a lookup is joined instead of being held as a literal, with the same result.
LITERAL_RULES = 400
GRAM = 3
#: Keywords that are held in each task; more are joined by their first characters.
MOST_KEYWORD_BYTES = 32 << 20


def first_hint(text: Column, hints: list[tuple], keys: list[str]) -> Column:
    """JOIN1, JOIN6: the first hint, in table order, whose keyword (its first field) the text holds.

    hints is a small ordered rule table, at most LITERAL_RULES rows; it becomes a literal array. with_hint() takes any number.
    """
    if not hints or len(hints) > LITERAL_RULES:
        raise ValueError("a literal rule table has 1 to %d rows" % LITERAL_RULES)
    table = F.array(*[F.struct(*[(F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)).alias(k) for k, v in zip(keys, h)]) for h in hints])
    low = F.lower(text)
    return F.try_element_at(F.filter(table, lambda h: F.contains(low, h[keys[0]])), F.lit(1))


def venue_hint(texts: list[Column], hints: list[tuple], keys: list[str]) -> Column:
    """JOIN1: the first text with any hint decides."""
    return F.coalesce(*[first_hint(t, hints, keys) for t in texts])


def grams(text: Column, size: int) -> Column:
    """The distinct substrings of so many characters."""
    starts = F.sequence(F.lit(1), F.char_length(text) - (size - 1))
    return F.when(F.char_length(text) >= size, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))))


def hinted(df: DataFrame, rules: DataFrame, text: str, keyword: str = "keyword", rank: str = "rank", key: str = "ingest_seq") -> DataFrame:
    """JOIN1 for rule tables of any size: (key, rule columns) of the lowest rank whose keyword the text holds; equal ranks by keyword.

    Rules whose keywords come to at most MOST_KEYWORD_BYTES are one automaton that texts pass through where they lie; the rule's
    columns are then joined by its place. Larger tables meet the texts by substrings. Empty keywords are never found.
    """
    table = rules.withColumn("_key", F.lower(keyword)).filter("_key <> ''")
    if (table.agg(F.sum(F.octet_length("_key") + 16)).first()[0] or 0) > MOST_KEYWORD_BYTES:
        return _met_by_grams(df, table, rules.columns, text, rank, key)
    ordered = sorted((r[0], r[1]) for r in table.groupBy("_key").agg(F.min(rank)).select(F.col(f"min({rank})"), "_key").collect())  # MOST_KEYWORD_BYTES
    keys = [k for _, k in ordered]
    if not keys:
        return df.select(key, *[F.lit(None).cast(f.dataType).alias(f.name) for f in rules.schema]).limit(0)
    places = df.sparkSession.createDataFrame(list(enumerate(keys)), "_place int, _key string")
    best = table.groupBy("_key").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rules.columns]), F.col(rank)).alias("_rule")).join(places, "_key").select("_place", "_rule")
    met = df.select(key, first_keyword(F.lower(text), keys).alias("_place")).filter("_place is not null")
    return met.join(best, "_place").select(key, "_rule.*")


def _met_by_grams(df: DataFrame, table: DataFrame, columns: list[str], text: str, rank: str, key: str) -> DataFrame:
    """hinted() for more keywords than a task should hold: distinct texts' substrings meet the keywords' first GRAM characters by equality, and the keyword is then checked."""
    table = table.withColumn("_gram", F.substring("_key", 1, GRAM))
    asked = df.select(F.lower(text).alias("_text")).filter("_text is not null").distinct()
    sizes = sorted(r[0] for r in table.select(F.char_length("_gram")).distinct().collect())  # at most GRAM rows
    none = F.array().cast("array<string>")
    every = F.concat(none, *[F.coalesce(grams(F.col("_text"), n), none) for n in sizes])
    met = asked.select("_text", F.explode(every).alias("_gram")).join(table, "_gram").filter(F.contains("_text", F.col("_key")))
    best = met.groupBy("_text").agg(F.min_by(F.struct(*columns), F.struct(rank, "_key")).alias("hint"))
    return df.select(key, F.lower(text).alias("_text")).join(best, "_text").select(key, "hint.*")


def with_hint(df: DataFrame, texts: list[str], hints: list[tuple], keys: list[str], out: str = "hint") -> DataFrame:
    """JOIN1: adds the hint struct of the first text column with any hint, null without one; any number of hints."""
    if len(hints) <= LITERAL_RULES:
        return df.withColumn(out, venue_hint([F.col(t) for t in texts], hints, keys))
    whole = tuple(next((h[i] for h in hints if h[i] is not None), "") for i in range(len(keys)))  # for the fields' types
    fields = df.sparkSession.range(1).select(first_hint(F.lit(""), [whole], keys).alias("h")).schema["h"].dataType
    place = _free("_place", df.columns)
    table = df.sparkSession.createDataFrame([(i, tuple(h)) for i, h in enumerate(hints)], f"{place} int, `{out}` {fields.simpleString()}")
    at = F.coalesce(*[first_keyword(F.lower(F.col(t)), [h[0] for h in hints]) for t in texts])
    return df.drop(out).withColumn(place, at).join(table, place, "left").drop(place)


def _free(name: str, taken: list[str]) -> str:
    low = {c.lower() for c in taken}
    while name in low:
        name += "_"
    return name


def apply_hint(df: DataFrame, hint: str = "hint") -> DataFrame:
    """JOIN2: tags are united; the rainy flag is overridden; city and county are filled where missing."""
    h = F.col(hint)
    return df.withColumns({
        "tags": F.array_sort(F.array_distinct(F.concat("tags", F.coalesce(h["tags"], F.array().cast("array<string>"))))),
        "rainy_day_friendly": F.coalesce(h["rainy"], F.col("rainy_day_friendly")),
        "city": F.coalesce(blank(F.col("city")), h["city"]), "county": F.coalesce(blank(F.col("county")), h["county"]),
    })


def source_names(df: DataFrame, hosts: DataFrame, names: DataFrame, url: str = "source_url", raw: str = "source_name", out: str = "display_name") -> DataFrame:
    """JOIN3: a raw name of several words stands; else the host's, its parent host's or the name's display name.

    hosts(host, name) and names(name, display) are dimensions; of repeated keys one entry counts.
    """
    by_host = hosts.groupBy("host").agg(F.max("name").alias("_by_host"))
    parents = by_host.select(F.col("host").alias("_parent"), F.col("_by_host").alias("_by_parent"))
    by_name = names.groupBy(F.lower("name").alias("_lower")).agg(F.max("display").alias("_by_name"))
    df = df.withColumn("host", host(F.col(url))).withColumn("_parent", F.nullif(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), F.lit("")))
    df = df.withColumn("_lower", F.lower(F.trim(raw))).join(by_host, "host", "left").join(parents, "_parent", "left").join(by_name, "_lower", "left")
    worded = F.contains(F.trim(raw), F.lit(" "))
    return df.withColumn(out, F.when(worded, F.col(raw)).otherwise(F.coalesce("_by_host", "_by_parent", "_by_name", raw))).drop("host", "_parent", "_lower", "_by_host", "_by_parent", "_by_name")


def price_changes(after: DataFrame, before: DataFrame) -> DataFrame:
    """JOIN8: each repaired row beside its price class before; unknown if it was not there."""
    old = before.select("id", F.col("cost_type").alias("before"))
    return after.join(old, "id", "left").withColumn("before", F.coalesce("before", F.lit("unknown")))


def slug_venue(df: DataFrame, venues: DataFrame, url: str = "source_url") -> DataFrame:
    """JOIN12: the venue named by a URL's first path part; venues(slug, venue)."""
    return df.withColumn("slug", F.nullif(F.regexp_extract(url, r"^https?://[^/]+/([^/?#]+)", 1), F.lit(""))).join(venues, "slug", "left")
