"""Geocoding against a cache table (GEO3, GEO5-GEO7, JOIN5, AGG7, SNK8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.regions import hit_confidence, in_area, is_virtual, queries


def resolve(asked: DataFrame, cache: DataFrame, key: str = "id", area: tuple = rules.SERVICE_AREA, accept_lower: bool = False) -> DataFrame:
    """JOIN5: asked(key, queries array) -> (key, status, latitude, longitude, confidence, query, pending).

    A hit counts only if every earlier query is a known miss (negative or outside the area), unless
    accept_lower; else the row is pending and ``pending`` lists the queries that the cache lacks.
    """
    hits = cache.select("query", "latitude", "longitude", "confidence", F.lit(True).alias("_known"))
    rows = asked.select(key, F.posexplode_outer("queries").alias("pos", "query")).join(hits, "query", "left")
    good = in_area(F.col("latitude"), F.col("longitude"), area)
    known = F.coalesce("_known", F.lit(False))
    found = rows.groupBy(key).agg(
        F.min_by(F.struct("latitude", "longitude", "confidence", "query"), F.when(good, F.col("pos"))).alias("hit"), F.min(F.when(good, F.col("pos"))).alias("hit_pos"),
        F.min(F.when(~known & F.col("query").isNotNull(), F.col("pos"))).alias("gap"), F.count("query").alias("n"), F.array_sort(F.collect_set(F.when(~known, F.col("query")))).alias("pending"),
    )
    usable = F.col("hit_pos").isNotNull() & (F.lit(accept_lower) | F.col("gap").isNull() | (F.col("hit_pos") < F.col("gap")))
    status = F.when(F.col("n") == 0, "no_query").when(usable, "hit").when(F.col("gap").isNotNull(), "pending").otherwise("failed")
    return found.withColumn("status", status).select(key, "status", *[F.when(F.col("status") == "hit", F.col("hit")[c]).alias(c) for c in ("latitude", "longitude", "confidence", "query")], F.when(F.col("status") == "pending", F.col("pending")).alias("pending"))


def geocode(events: DataFrame, cache: DataFrame, policy: str = "retry", area: tuple = rules.SERVICE_AREA, accept_lower: bool = False) -> DataFrame:
    """GEO5 and GEO6: coordinates, flags and geo_outcome for every event.

    policy for coordinates outside the area: "retry" clears and asks again, "keep" leaves them,
    "report" is retry with suspicious() wanted as well. Virtual events lose their coordinates. The
    input's own coordinates are kept as given_latitude and given_longitude.
    """
    c = F.col
    df = events.withColumns({"given_latitude": c("latitude"), "given_longitude": c("longitude"), "_virtual": is_virtual(c("tags"), c("location_name"), c("title"), c("summary"), c("short_note"))})
    has_point, inside = c("latitude").isNotNull() & c("longitude").isNotNull(), in_area(c("latitude"), c("longitude"), area)
    keep = inside | (has_point & F.lit(policy == "keep"))
    df = df.withColumns({"_keep": keep, "queries": F.when(~c("_virtual") & ~keep, queries(c("location_address"), c("location_name"), c("city"), c("county")))})
    asked = df.filter("queries is not null").groupBy("id").agg(F.min("queries").alias("queries"))
    got = resolve(asked, cache, "id", area, accept_lower)
    got = got.select("id", F.col("status").alias("_status"), F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"), F.col("confidence").alias("_conf"), F.col("query").alias("geo_query"), F.col("pending").alias("geo_pending"))
    df = df.join(got, "id", "left")
    pick = lambda old, new: F.when(c("_virtual"), None).when(c("_keep"), old).otherwise(new)
    outcome = F.when(c("_virtual") & has_point, "virtual_cleared").when(c("_virtual"), "virtual_skipped").when(c("_keep"), "already_geocoded").when(c("_status") == "hit", "cache_hit").otherwise(F.coalesce("_status", F.lit("no_query")))
    df = df.withColumns({"geo_outcome": outcome, "latitude": pick(c("latitude"), c("_lat")), "longitude": pick(c("longitude"), c("_lon")), "geo_confidence": pick(c("geo_confidence"), c("_conf"))})
    within = in_area(c("latitude"), c("longitude"), area)
    return df.withColumns({"geo_within_service_region": within, "is_mappable": within & ~c("_virtual")}).drop("_virtual", "_keep", "_status", "_lat", "_lon", "_conf", "queries")


def stats(df: DataFrame) -> DataFrame:
    """AGG7: one row of counters."""
    o = F.col("geo_outcome")
    return df.agg(
        F.count("*").alias("total"), F.count_if(o.isin("virtual_skipped", "virtual_cleared")).alias("virtual"), F.count_if(o == "virtual_cleared").alias("virtual_cleared"), F.count_if(o == "already_geocoded").alias("already_geocoded"),
        F.count_if(o == "cache_hit").alias("cache_hit"), F.count_if(o == "failed").alias("failed"), F.count_if(o == "no_query").alias("no_query"), F.count_if(o == "pending").alias("pending"),
        F.count_if(F.col("latitude").isNotNull()).alias("with_point"), F.count_if("geo_within_service_region").alias("within_region"), F.count_if("is_mappable").alias("mappable"),
    )


def requests(df: DataFrame) -> DataFrame:
    """Queries that a fetcher should resolve upstream, each once."""
    return df.filter("geo_pending is not null").select(F.explode("geo_pending").alias("query")).distinct()


def cache_rows(found: DataFrame) -> DataFrame:
    """GEO8: a geocoder's answers (query, latitude, longitude, map_id, resolved_at) as cache rows; coordinates to six decimals."""
    hit = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    six = lambda n: F.when(hit, F.round(n, 6)).alias(n)
    return found.select("query", six("latitude"), six("longitude"), F.when(hit, hit_confidence(F.col("map_id"))).alias("confidence"), "resolved_at")


def suspicious(df: DataFrame, area: tuple = rules.SERVICE_AREA) -> DataFrame:
    """SNK8's rows: events that came with coordinates outside the area."""
    odd = F.col("given_latitude").isNotNull() & F.col("given_longitude").isNotNull() & ~in_area(F.col("given_latitude"), F.col("given_longitude"), area)
    return df.filter(odd).select("id", "title", "location_name", "given_latitude", "given_longitude", "geo_outcome")


def purge(cache: DataFrame, area: tuple = rules.SERVICE_AREA, keys: DataFrame | None = None) -> DataFrame:
    """GEO7: drops entries outside the area, and those of the given queries; negative entries stay."""
    kept = cache.filter(F.col("latitude").isNull() | in_area(F.col("latitude"), F.col("longitude"), area))
    return kept.join(keys, "query", "left_anti") if keys is not None else kept


def merge_cache(cache: DataFrame, resolved: DataFrame) -> DataFrame:
    """SNK10: positive and negative results by query, the newest one."""
    both = cache.unionByName(resolved)
    rest = [c for c in both.columns if c != "query"]
    return both.groupBy("query").agg(F.max_by(F.struct(*rest), F.struct("resolved_at", F.col("latitude").isNotNull())).alias("_n")).select("query", *[F.col("_n")[c].alias(c) for c in rest])
