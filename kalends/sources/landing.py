"""Readers of landed files and tables (SRC1, SRC2, SRC7, SRC8, SRC10-SRC14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kalends import schemas
from kalends.functions.text import blank


def raw_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SRC1, SRC10: JSON arrays of raw records, one file per source and run; unknown keys are dropped."""
    return spark.read.schema(schemas.RAW).json(path, multiLine=True)


def curated(spark: SparkSession, path: str) -> DataFrame:
    """SRC7's document: {"events": [...]}, or one entry per line."""
    whole = spark.read.schema(f"events array<struct<{_struct(schemas.CURATED)}>>").json(path, multiLine=True)
    return whole.select(F.inline("events"))


def _struct(ddl: str) -> str:
    """Top-level "name type" pairs as "name: type"."""
    out, depth, part = [], 0, ""
    for ch in ddl + ",":
        depth += ch in "<(" or -(ch in ">)")
        if ch == "," and not depth:
            name, kind = part.strip().split(" ", 1)
            out.append(f"{name}: {kind}")
            part = ""
        else:
            part += ch
    return ", ".join(out)


def enabled_sources(catalogue: DataFrame, ids: list[str] | None = None) -> DataFrame:
    """SRC8."""
    kept = catalogue.filter(F.coalesce("enabled", F.lit(False)))
    return kept.filter(F.col("id").isin(ids)) if ids else kept


def of_enabled(raw: DataFrame, catalogue: DataFrame, ids: list[str] | None = None) -> DataFrame:
    """Raw records of enabled sources."""
    return raw.join(enabled_sources(catalogue, ids).select(F.col("id").alias("source_id")).distinct(), "source_id", "left_semi")


API_EVENT = "id string, title string, start string, end string, allday boolean, location struct<name: string>, campus struct<name: string>, description string, url struct<public: string>, registration_cost string, cost string, price string, fee string, ticket_cost string"


def api_events(payloads: DataFrame, source_id: str, source_name: str, with_price: bool = True, column: str = "payload") -> DataFrame:
    """SRC2: calendar-API payloads {"results": [...]} as raw records; the first filled of five price keys."""
    parsed = payloads.select(F.from_json(F.col(column), f"results array<struct<{_struct(API_EVENT)}>>").alias("p"))
    e = parsed.select(F.explode("p.results").alias("e")).select("e.*")
    price = F.coalesce(*[blank(F.col(c)) for c in ("registration_cost", "cost", "price", "fee", "ticket_cost")]) if with_price else F.lit(None).cast("string")
    place = F.nullif(F.concat_ws(", ", blank(F.col("location")["name"]), blank(F.col("campus")["name"])), F.lit(""))
    return e.select(F.lit(source_id).alias("source_id"), F.lit(source_name).alias("source_name"), F.col("url")["public"].alias("source_url"), "title", F.col("start").alias("start_text"), F.col("end").alias("end_text"), F.col("allday").alias("all_day"), place.alias("location_text"), F.col("description").alias("summary_text"), price.alias("price_text"))


def published_week(spark: SparkSession, path: str) -> DataFrame:
    """SRC11: the events of published envelopes."""
    events = ", ".join(f"{f.split()[0]}: {f.split()[1]}" for f in schemas.EVENT.split(", "))
    return spark.read.schema(f"week_start string, events array<struct<{events}>>").json(path, multiLine=True).select("week_start", F.inline("events"))


def any_events(documents: DataFrame, column: str = "value") -> DataFrame:
    """SRC12: JSON texts that are an array of events or an envelope with ``events``; one variant per event.

    A text that is no JSON, or neither form, gives no row.
    """
    v = F.try_parse_json(F.col(column))
    inner = F.coalesce(F.try_variant_get(v, "$.events", "variant"), F.when(F.schema_of_variant(v).startswith("ARRAY"), v))
    rows = documents.select(inner.alias("v")).filter("v is not null")
    return rows.select(F.explode(F.try_variant_get("v", "$", "array<variant>")).alias("event"))


def geo_cache(spark: SparkSession, path: str) -> DataFrame:
    """SRC14."""
    return spark.read.schema(schemas.GEO_CACHE).parquet(path)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """SRC13's table."""
    return spark.read.schema(schemas.CANDIDATE).json(path)
