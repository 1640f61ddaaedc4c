"""Registered queries over the given tables, each with its DuckDB equivalent where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions import dates, regions, text, urls
from kalends.functions.store import stored
from kalends.operators import candidates as cand
from kalends.operators import dedupe, filters, geo, lookup, notes, quality, reports, schedule, scores
from kalends.operators.normalise import normalise, places
from kalends.plans import jobs
from kalends.plans import listing as fx
from kalends.plans import oracles as sql
from kalends.sources import landing, pages, publish, registry

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def events(spark: SparkSession, d: str) -> DataFrame:
    return normalise(fx.raw_listing(spark, d), fx.AS_OF)[0]


def upcoming(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).filter(filters.upcoming(fx.AS_OF))


def survivors(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """All columns, or those that the query reads."""
    return dedupe.deduplicate(upcoming(spark, d), list(columns) or None)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


tags_text = lambda c: F.array_join(c, ",")


# ---- sources, text, identity


@query(sql.raw("select * from raw_listing"))
def src1_raw_listing(spark, d):
    return fx.raw_listing(spark, d)


@query(sql.raw("""select ingest_seq, title as clean,
  list_aggregate(list_transform(string_split(lower(title), ' '), lambda w, i: case when i > 1 and w in ('a','an','the','and','but','or','for','nor','on','at','to','by','in','of','up','as','is','it') then w else upper(w[1]) || w[2:] end), 'string_agg', ' ') as cased
  from raw_listing"""))
def str1_str2_titles(spark, d):
    t = F.col("title")
    noisy = F.concat(F.lit("  "), F.replace(t, F.lit(" "), F.lit("   ")), F.when(F.col("ingest_seq") % 2 == 0, F.lit(" | Some Site")).otherwise(F.lit(".,")))
    return fx.raw_listing(spark, d).select("ingest_seq", text.clean_title(noisy).alias("clean"), text.title_case(F.upper(t)).alias("cased"))


@query(sql.raw("select ingest_seq, case when length(summary_text) >= 20 then summary_text || ' & more' end as summary from raw_listing"))
def str3_summaries(spark, d):
    html = F.concat(F.lit("[vc_row a=1]<p>"), F.col("summary_text"), F.lit("</p> &amp; <b>more</b>[/vc_row]"))
    return fx.raw_listing(spark, d).select("ingest_seq", text.clean_summary(html).alias("summary"))


@query(f"with {sql.RAW},{sql._PLACE} select ingest_seq, location_name, location_address, city, county from place")
def str9_locations(spark, d):
    return fx.raw_listing(spark, d).select("ingest_seq", text.location(F.col("location_text")).alias("l")).select("ingest_seq", "l.*")


@query(sql.raw("""select ingest_seq, price_text as cleaned, regexp_extract(s, '\\$\\s*\\d[\\d,.]*', 0) is not null and regexp_matches(s, '(?i)\\$\\s*\\d') as priced, case when regexp_matches(s, '(?i)(registration|class|course|program|entry|admission|materials?|ticket)\\s+fee')
  then regexp_extract(s, '(?i)(registration|class|course|program|entry|admission|materials?|ticket)\\s+fee[^.\\n]{0,80}', 0) end as fee from (select *, concat_ws(' ', price_text, title) as s from raw_listing)"""))
def str12_str14_prices(spark, d):
    both = F.concat_ws(" ", "price_text", "title")
    return fx.raw_listing(spark, d).select("ingest_seq", text.price_text(F.concat(F.lit("  "), F.col("price_text"), F.lit(" "))).alias("cleaned"), text.has(both, rules.DOLLAR).alias("priced"), text.snippet(both, rules.SNIPPETS[:1]).alias("fee"))


@query("select page_id, coalesce(regexp_matches(url, '(?i)^https?://[^\\s/]+'), false) as valid, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') as host from pages")
def url1_url2_hosts(spark, d):
    return table(spark, d, "pages").select("page_id", urls.valid_url(F.col("url")).alias("valid"), urls.host(F.col("url")).alias("host"))


@query(f"with {sql.CANDIDATES} select k, coalesce(url is not null and not contains(url, '{urls.AGGREGATOR}') and not contains(url, 'facebook.com'), false) as original, false as shortened, case when url is null then null when contains(url, 'facebook') then 'Facebook' when contains(url, '{urls.AGGREGATOR}') then 'Aggregator.example' when contains(url, 'hub.') then 'Hub.example' else 'Site' || (k % 50) || '.example' end as site from cand")
def url3_url6_outbound(spark, d):
    u = F.col("candidate_original_url")
    return fx.candidates(spark, d).select(F.regexp_extract("seed_url", r"(\d+)$", 1).cast("long").alias("k"), urls.original_host(u).alias("original"), urls.shortener(u).alias("shortened"), urls.site_name(u).alias("site"))


@query(sql.events("select ingest_seq, id from scored"))
def hsh1_event_ids(spark, d):
    return events(spark, d).select("ingest_seq", "id")


@query(f"with {sql.CANDIDATES} select k, candidate_id from identified")
def hsh2_candidate_ids(spark, d):
    return fx.candidates(spark, d).select(F.regexp_extract("seed_url", r"(\d+)$", 1).cast("long").alias("k"), "candidate_id")


# ---- dates


@query(sql.raw("select ingest_seq, strftime(cast(start_text as timestamp), '%Y-%m-%dT%H:%M:%S') as starts, cast(date_trunc('week', cast(start_text as timestamp)) as date) as week from raw_listing"))
def dt1_dt2_dates(spark, d):
    """The start in one of four spellings, read back, with its week."""
    spelled = F.expr("case ingest_seq % 4 when 0 then start_text when 1 then date_format(to_timestamp(start_text), 'EEE, MMM d, h:mma') when 2 then date_format(to_timestamp(start_text), \"yyyy-MM-dd'T'HH:mm:ss\") || 'Z' else date_format(to_timestamp(start_text), \"MMM d yyyy 'at' h:mm a\") end")
    return fx.raw_listing(spark, d).select("ingest_seq", dates.parse_datetime(spelled, 2024).alias("s")).select("ingest_seq", dates.iso(F.col("s")).alias("starts"), dates.week_monday(F.col("s")).alias("week"))


#: Spellings of a time, as patterns of both engines: Spark's and DuckDB's name for the moment that is left when the text is read.
SPELLED = [
    ("EEEE, MMMM d, yyyy '@' h:mm a", "minute"), ("d MMMM yyyy HH:mm:ss", "second"), ("h:mma 'on' MMM d", "minute"), ("ha 'on the' d'th of' MMMM yyyy", "hour"), ("'Opens' yyyy/MM/dd HH:mm", "minute"), ("M.d.yy h a", "hour"),
    ("d-MMM-yyyy", "day"), ("yyyyMMdd'T'HHmm", "minute"), ("M/d", "day"), ("MMM d, yyyy HH:mm '+0200'", "minute"), ("MMMM yyyy", None), ("MMM d yyyy h:mm a '- 11:30 PM'", None), ("EEEE HH:mm", None),
]
SPELLED_SQL = " ".join(f"when {i} then " + (f"date_trunc('{unit}', ts)" if unit else "null") + (" - interval 2 hour" if "+0200" in form else "") for i, (form, unit) in enumerate(SPELLED))


@query(f"""with s as (select event_id, date_trunc('second', ts::timestamp) as ts from events), r as (select event_id, case event_id % {len(SPELLED)} {SPELLED_SQL} end as t from s)
  select event_id, strftime(t, '%Y-%m-%dT%H:%M:%S') as starts from r""")
def dt1_spelled_dates(spark, d):
    """Starts in free wording, read by the grammar; three of the spellings have no date or two times."""
    turn = F.expr(f"event_id % {len(SPELLED)}")
    text = F.coalesce(*[F.when(turn == i, F.date_format("ts", form)) for i, (form, _) in enumerate(SPELLED)])
    return table(spark, d, "events").select("event_id", dates.iso(dates.parse_datetime(text, 2024)).alias("starts"))


@query("select event_id, case when isodow(ts) >= 6 then 'weekend' else 'weekday' end || case when hour(ts) between 5 and 11 then ',morning' when hour(ts) between 12 and 16 then ',afternoon' when hour(ts) between 17 and 21 then ',evening' else '' end as tags from events")
def dt3_time_tags(spark, d):
    return table(spark, d, "events").select("event_id", tags_text(dates.time_tags(F.col("ts"))).alias("tags"))


@query("select event_id, strftime(ts, '%b %-d') || ', ' || strftime(ts, '%-I:%M%p') as start_text, case when event_id % 3 = 0 then strftime(ts, '%b %-d') || ', ' || '9:00PM' end as end_text, false as all_day from events where event_id % 5 <> 0 union all select event_id, strftime(ts, '%b %-d'), null, true from events where event_id % 5 = 0")
def dt6_listing_times(spark, d):
    tail = F.expr("case when event_id % 5 = 0 then 'All day' when event_id % 3 = 0 then date_format(ts, 'h:mma') || ' - 9:00PM' else date_format(ts, 'h:mma') end")
    line = F.concat(F.date_format("ts", "EEEE, MMM d, "), tail)
    return table(spark, d, "events").select("event_id", dates.listing_times(line).alias("l")).select("event_id", "l.*")


# ---- classifiers


@query(sql.events("select ingest_seq, reason, price_type, cost_type, is_free from priced"))
def prc1_pricing(spark, d):
    return events(spark, d).select("ingest_seq", F.col("pricing_reason").alias("reason"), "price_type", "cost_type", "is_free")


@query(sql.events("select ingest_seq, array_to_string(tags, ',') as tags, rainy from rained"))
def tag1_tags(spark, d):
    return events(spark, d).select("ingest_seq", tags_text(F.col("tags")).alias("tags"), F.col("rainy_day_friendly").alias("rainy"))


@query(sql.events("select ingest_seq, family_friendly_score from scored"))
def sco1_friendliness(spark, d):
    return events(spark, d).select("ingest_seq", "family_friendly_score")


@query(sql.events("select ingest_seq, family_relevance_score, family_relevance_label, array_to_string(list_concat(list_filter([case when len(ages) > 0 then 'age_tag:' || array_to_string(ages, '+') when list_contains(tags, 'teen') then 'age_tag:teen' end, 'pos:' || family, 'activity:' || activity], lambda x: x is not null), list_concat(list_transform(adult, lambda x: 'neg:' || x), list_filter([case when len(adult) > 0 then 'rescue:' || rescue end], lambda x: x is not null))), ',') as reasons from scored"))
def sco2_relevance(spark, d):
    e = events(spark, d).select("ingest_seq", "title", "summary", "tags", "source_name")
    return scores.with_relevance(e).select("ingest_seq", F.col("relevance.score").alias("family_relevance_score"), F.col("relevance.label").alias("family_relevance_label"), tags_text(F.col("relevance.reasons")).alias("reasons"))


_ACT = "case " + " ".join(f"when list_contains(tags, '{t}') then '{p}'" for t, p in rules.ACTIVITY_PHRASES.items()) + " end"
_NOTE = f"""select ingest_seq, case when activity2 is null and venue is null then null else upper(s[1]) || s[2:] || '.' end as short_note from (select *, concat_ws(' ', case cost_type when 'free' then 'Free' when 'paid' then coalesce(price_text, 'Paid') when 'suggested_donation' then 'Suggested donation' end,
  case when list_contains(tags, 'indoor') and not list_contains(tags, 'outdoor') then 'indoor' when list_contains(tags, 'outdoor') and not list_contains(tags, 'indoor') then 'outdoor' when list_contains(tags, 'virtual') then 'online/virtual' end,
  coalesce(activity2, 'family-friendly event'), venue, case when list_contains(tags, 'toddler') and not list_contains(tags, 'preschool') and not list_contains(tags, 'elementary') then 'for toddlers' when list_contains(tags, 'all_ages') then 'for all ages' end) as s
  from (select *, case when list_contains(tags, 'sports') and list_contains(tags, 'swim') then 'swim session' else {_ACT} end as activity2, case when location_name is not null and lower(location_name) not in ('virtual', 'online') then 'at ' || location_name when city is not null then 'in ' || city end as venue from scored))"""


@query(sql.events(_NOTE))
def note1_short_notes(spark, d):
    """Notes from facts alone: the summary is left out, so that the template speaks."""
    c, none = F.col, F.lit(None)
    cost_text = fx.raw_listing(spark, d).select("ingest_seq", F.col("price_text").alias("given"))
    e = events(spark, d).drop("price_text").join(cost_text, "ingest_seq").withColumn("summary", none.cast("string"))
    return e.select("ingest_seq", notes.short_note(c("summary"), c("tags"), c("title"), c("cost_type"), c("given"), c("location_name"), c("city"), c("county"), none.cast("int"), none.cast("int")).alias("short_note"))


# ---- filters, survivors


@query(sql.events(f"select ingest_seq, cast(start as date) >= date '{fx.AS_OF}' as kept, cast(start as date) between date '{fx.WEEK}' and date '{fx.WEEK}' + 6 as in_week from scored"))
def flt1_flt2_dates(spark, d):
    return events(spark, d).select("ingest_seq", filters.upcoming(fx.AS_OF).alias("kept"), filters.in_week(fx.WEEK).alias("in_week"))


@query(sql.survivors("select family_relevance_score >= 0.30 or (select count(*) filter (family_relevance_score < 0.30) > 0.5 * count(*) from survivors) as kept, id from survivors"))
def flt4_relevance_filter(spark, d):
    kept, gone = filters.relevance_split(survivors(spark, d))
    return kept.select(F.lit(True).alias("kept"), "id").unionByName(gone.select(F.lit(False).alias("kept"), "id"))


@query(sql.raw("""select ingest_seq, regexp_matches(title, '(?i)\\b(famil(y|ies)|child(ren)?|kids?|toddlers?|bab(y|ies)|preschool|story\\s*time|teens?|tweens?|youth|all\\s+ages)\\b') as family from raw_listing"""))
def flt6_audience(spark, d):
    return fx.raw_listing(spark, d).select("ingest_seq", filters.for_families(F.col("title")).alias("family"))


@query(sql.survivors("select id, ingest_seq, title, start, cost_type, price_type, array_to_string(tags, ',') as tags, family_friendly_score from survivors"))
def ded4_survivors(spark, d):
    return survivors(spark, d).select("id", "ingest_seq", "title", "start", "cost_type", "price_type", tags_text(F.col("tags")).alias("tags"), "family_friendly_score")


@query(sql.events("select id, ingest_seq, title as first_title from (select *, row_number() over (partition by id order by ingest_seq) as n from scored) where n > 1"))
def ded6_repeated_ids(spark, d):
    return dedupe.duplicate_flags(stored(events(spark, d).select("id", "ingest_seq", "title"), "ids")).select("id", "ingest_seq", "first_title")


@query(sql.raw("select source_id, source_url, min(ingest_seq) as ingest_seq from raw_listing group by 1, 2"))
def ded5_first_seen(spark, d):
    return dedupe.first_seen(fx.raw_listing(spark, d)).select("source_id", "source_url", "ingest_seq")


_WEEKS = "weeks as (select distinct cast(date_trunc('week', o_orderdate) as date)::varchar as week from orders)"


def weeks(spark, d):
    return table(spark, d, "orders").select(dates.week_monday(F.col("o_orderdate")).cast("string").alias("week"))


@query(f"with {_WEEKS}, a as (select week from weeks union select '1990-01-01') select week, row_number() over (order by (week = '1990-01-01') desc, week desc) <= 5 as kept from a")
def ret1_retention(spark, d):
    return dedupe.retained_weeks(weeks(spark, d), 5, "1990-01-01")


@query(f"with {_WEEKS}, a as (select week from weeks union select '1990-01-01'), kept as (select week from a order by (week = '1990-01-01') desc, week desc limit 5) select 1 as version, 'now' as generated_at, array_to_string(list(week order by week), ',') as available_weeks, max(week) as latest_week from kept")
def snk2_manifest(spark, d):
    return publish.manifest(weeks(spark, d), "1990-01-01", "now").withColumn("available_weeks", tags_text(F.col("available_weeks")))


@query(f"with {_WEEKS}, s as (select week from weeks where week[9:10] < '20'), t as (select week from weeks where week[9:10] > '10') select week, 'copy' as action from s union all select week, 'delete' from t where week not in (select week from s)")
def set4_mirror_plan(spark, d):
    w = weeks(spark, d).distinct()
    return dedupe.mirror_plan(w.filter(F.substring("week", 9, 2) < "20"), w.filter(F.substring("week", 9, 2) > "10"))


# ---- reports


@query(sql.survivors("select source_name, count(*) as n from survivors group by 1"))
def agg1_by_source(spark, d):
    return reports.by_source(survivors(spark, d, "source_name"))


@query(sql.survivors("select count(*) as total, count(*) filter (cost_type = 'free') as free, count(*) filter (cost_type = 'paid') as paid, count(*) filter (cost_type = 'suggested_donation') as donation, count(*) filter (cost_type = 'unknown') as unknown, round(100 * (count(*) filter (cost_type = 'free') / count(*)), 1) as free_share from survivors"))
def agg2_costs(spark, d):
    return reports.costs(survivors(spark, d, "cost_type"))


@query(sql.survivors("select reason, count(*) as n from survivors group by 1"))
def agg3_reasons(spark, d):
    return reports.reasons(survivors(spark, d, "pricing_reason"), "pricing_reason")


@query(sql.survivors("select reason, count(*) as n from survivors group by 1 order by n desc, reason limit 6"))
def top2_reasons(spark, d):
    return reports.top_reasons(survivors(spark, d, "pricing_reason"), 6, "pricing_reason")


@query(sql.survivors("select family_relevance_label, count(*) as n from survivors group by 1"))
def agg4_labels(spark, d):
    return reports.exclusions(survivors(spark, d, "family_relevance_label"))


@query(sql.survivors("select id, title, family_relevance_score, family_relevance_label from survivors order by family_relevance_score, id limit 8"))
def top1_least_relevant(spark, d):
    return reports.lowest(survivors(spark, d, "id", "title", "family_relevance_score", "family_relevance_label"))


@query(sql.survivors("select count(*) as total, count(location_address) as with_address, count(city) as with_city, 0::bigint as with_point, 0::bigint as mappable, count(*) filter (list_contains(tags, 'virtual')) as virtual from survivors"))
def agg6_addresses(spark, d):
    return reports.addresses(survivors(spark, d))


@query(sql.survivors("select count(distinct regexp_extract(source_url, '://([^/]*)', 1)) as source_count from survivors"))
def agg8_source_count(spark, d):
    return reports.source_count(survivors(spark, d, "source_url", "source_name"))


@query(sql.survivors("select min(start) as first_start, cast(date_trunc('week', min(start)) as date) as week_start from survivors"))
def agg11_first_day(spark, d):
    return reports.first_day(survivors(spark, d, "start"))


@query(sql.survivors("select (select count(*) from up) as rows_before, count(*) as rows_after, (select count(*) from up) - count(*) as removed from survivors"))
def agg14_removed(spark, d):
    read = ["id", "ingest_seq", "title", "start", "end", "location_name", "summary", "image_url", "registration_url", "tags", "family_friendly_score"]
    before = stored(upcoming(spark, d).select(*read), "upcoming")
    return reports.removed(before, dedupe.deduplicate(before, ["id"]))


_OLD = "old as (select id, case when ingest_seq % 2 = 0 then 'unknown' else cost_type end as before from survivors where ingest_seq % 5 <> 0), both_sides as (select s.*, coalesce(o.before, 'unknown') as b from survivors s left join old o using (id))"
_KINDS = ["free", "paid", "suggested_donation", "unknown"]


@query(sql.survivors(f", {_OLD} select count(*) as total, {', '.join(f'count(*) filter (b = {chr(39)}{k}{chr(39)}) as before_{k}' for k in _KINDS)}, {', '.join(f'count(*) filter (cost_type = {chr(39)}{k}{chr(39)}) as after_{k}' for k in _KINDS)}, count(*) filter (cost_type = 'free' and b <> 'free') as newly_free, count(*) filter (cost_type = 'paid' and b <> 'paid') as newly_paid from both_sides"))
def agg5_price_repair(spark, d):
    now = stored(survivors(spark, d, "id", "ingest_seq", "cost_type", "pricing_reason"), "survivors")
    old = now.filter("ingest_seq % 5 <> 0").select("id", F.when(F.col("ingest_seq") % 2 == 0, "unknown").otherwise(F.col("cost_type")).alias("cost_type"))
    return reports.price_repair(now, old)


# ---- lookups

_HINT = "case " + " ".join(f"when contains(lower(t), {sql.q(h[0])}) then {i}" for i, h in enumerate(fx.HINTS)) + " end"


@query(sql.raw("select ingest_seq, " + ", ".join(f"{c} as {c}" for c in ("keyword", "city", "rainy")) + " from (select ingest_seq, coalesce(" + _HINT.replace("lower(t)", "lower(location_text)") + ", " + _HINT.replace("lower(t)", "lower(title)") + ") as i from raw_listing) left join (values " + ", ".join(f"({i}, {sql.q(h[0])}, {sql.literal(h[3])}, {sql.literal(h[2])})" for i, h in enumerate(fx.HINTS)) + ") h(i, keyword, city, rainy) using (i)"))
def join1_venue_hints(spark, d):
    hint = lookup.venue_hint([F.col("location_text"), F.col("title")], fx.HINTS, ["keyword", "tags", "rainy", "city", "county"])
    return fx.raw_listing(spark, d).select("ingest_seq", hint.alias("h")).select("ingest_seq", "h.keyword", "h.city", "h.rainy")


@query(sql.raw("select ingest_seq, case when ingest_seq % 2 = 0 then source_name when source_id = 'src0' then 'Zero Calendar' else 'Example Events' end as display_name from raw_listing"))
def join3_source_names(spark, d):
    hosts = spark.sql("select * from values ('src0.example.org', 'Zero Calendar'), ('example.org', 'Example Events') t(host, name)")
    names = spark.sql("select * from values ('src1', 'One') t(name, display)")
    raw = fx.raw_listing(spark, d).withColumn("source_name", F.when(F.col("ingest_seq") % 2 == 0, F.col("source_name")).otherwise(F.col("source_id")))
    return lookup.source_names(raw, hosts, names).select("ingest_seq", "display_name")


# ---- quality


@query(sql.events("""select rule, count(*) as n from (select id, unnest(list_filter([case when lower(title) = lower(location_name) then 'TITLE_MATCHES_VENUE' end, case when regexp_matches(source_name, '^[A-Z][a-z]+(\\.[A-Z][a-z]+)?$') and length(source_name) > 6 then 'MACHINE_SOURCE_NAME' end,
  case when contains(source_url, 'src1.') then 'BANNED_SOURCE_HOST' end, case when list_contains(tags, 'outdoor') and not list_contains(tags, 'indoor') and rainy then 'OUTDOOR_RAINY_DAY_FRIENDLY' end, case when length(price_text) > 80 then 'PRICE_TEXT_TOO_LONG' end], lambda x: x is not null)) as rule from scored union all select id, 'DUPLICATE_ID' from (select id, row_number() over (partition by id order by ingest_seq) as n from scored) where n > 1) group by 1"""))
def dq1_issues(spark, d):
    return quality.issues(events(spark, d), ["src1."]).groupBy("rule").agg(F.count("*").alias("n"))


@query(sql.events("select count(*) as total, count(*) filter (not contains(source_url, 'src1.')) as passed, count(*) filter (contains(source_url, 'src1.')) as failed, count(*) filter (contains(source_url, 'src1.')) + count(*) - count(distinct id) as errors, count(*) filter (list_contains(tags, 'outdoor') and not list_contains(tags, 'indoor') and rainy) as warnings, false as is_clean from scored"))
def agg9_totals(spark, d):
    return quality.totals(events(spark, d), ["src1."])


@query(sql.raw("select coalesce(case when ingest_seq % 10 = 0 then 'EMPTY_TITLE' when ingest_seq % 10 = 1 then 'GENERIC_TITLE' when ingest_seq % 10 = 2 then 'BAD_START' when ingest_seq % 10 = 3 then 'SCHEMA:ages' end, 'ok') as reason, count(*) as n from raw_listing group by 1"))
def nrm_rejects(spark, d):
    k = F.col("ingest_seq") % 10
    raw = fx.raw_listing(spark, d).withColumns({"title": F.when(k == 0, " ").when(k == 1, "Page Not Found").otherwise(F.col("title")), "start_text": F.when(k == 2, "whenever").otherwise(F.col("start_text")), "age_min": F.when(k == 3, 12), "age_max": F.when(k == 3, 3)})
    good, bad = normalise(raw, fx.AS_OF)
    return bad.select("reason").unionByName(good.select(F.lit("ok").alias("reason"))).groupBy("reason").agg(F.count("*").alias("n"))


# ---- schedules


@query(f"with {sql.SCHEDULES} select k, day, from_time, to_time, from_time is null as all_day, case when note is null then 'A show for everyone.' else 'A show for everyone. ' || note end as summary_text from days")
def exp1_occurrences(spark, d):
    good, _ = schedule.checked(fx.schedules(spark, d))
    return schedule.occurrences(good).select(F.substring("slug", 2, 20).cast("long").alias("k"), "day", "from_time", "to_time", "all_day", "summary_text")


@query(f"with {sql.SCHEDULES} select code, count(*) as n from coded where code is not null group by 1")
def flt10_malformed(spark, d):
    return schedule.checked(fx.schedules(spark, d))[1].groupBy("code").agg(F.count("*").alias("n"))


@query(f"with {sql.SCHEDULES} select case when day < date '{fx.AS_OF}' then 'past' when day > date '{fx.AS_OF}' + 60 then 'beyond' else 'kept' end as bucket, count(*) as count from days group by 1")
def agg13_horizon(spark, d):
    good, _ = schedule.checked(fx.schedules(spark, d))
    return schedule.bucket_counts(schedule.occurrences(good), fx.AS_OF, 60)


@query("select p_partkey as k, p_partkey % 7 = 0 or p_partkey % 400 > 180 as stale from part")
def flt9_stale(spark, d):
    return fx.schedules(spark, d).select(F.substring("slug", 2, 20).cast("long").alias("k"), schedule.stale(fx.AS_OF).alias("stale"))


# ---- places


def asked(spark, d):
    """From the place columns alone: queries hang on nothing else, and no listing row is rejected."""
    c = F.col
    return places(fx.raw_listing(spark, d)).select("ingest_seq", regions.queries(c("location_address"), c("location_name"), c("city"), c("county")).alias("queries"))


@query(sql.events(f", {sql.ASKED} select ingest_seq, array_to_string(queries, ';') as queries from listed"))
def geo4_queries(spark, d):
    return asked(spark, d).select("ingest_seq", F.array_join("queries", ";").alias("queries"))


@query(sql.events(f", {sql.ASKED}, {sql.RESOLVED} select ingest_seq, status, case when status = 'hit' then lat end as latitude, case when status = 'hit' then lon end as longitude from resolved"))
def join5_resolution(spark, d):
    return geo.resolve(asked(spark, d), fx.cache_table(spark), "ingest_seq").select("ingest_seq", "status", "latitude", "longitude")


@query(sql.survivors(f", {sql.ASKED}, {sql.RESOLVED}, out as (select s.*, case when list_contains(s.tags, 'virtual') or lower(s.location_name) = 'virtual' or contains(lower(s.title), 'virtual') then 'virtual' else r.status end as outcome from survivors s join resolved r using (ingest_seq)) select count(*) as total, count(*) filter (outcome = 'virtual') as virtual, 0::bigint as virtual_cleared, 0::bigint as already_geocoded, count(*) filter (outcome = 'hit') as cache_hit, count(*) filter (outcome = 'failed') as failed, count(*) filter (outcome = 'no_query') as no_query, count(*) filter (outcome = 'pending') as pending, count(*) filter (outcome = 'hit') as with_point, count(*) filter (outcome = 'hit') as within_region, count(*) filter (outcome = 'hit') as mappable from out"))
def agg7_geo_stats(spark, d):
    return geo.stats(geo.geocode(stored(survivors(spark, d), "survivors"), fx.cache_table(spark)))


_CUSTOMER_CACHE = "cc as (select c_name as query, case when c_custkey % 3 = 0 then null else 37.0 + (c_custkey % 40) / 10.0 end as latitude, case when c_custkey % 3 = 0 then null else -80.0 + (c_custkey % 50) / 10.0 end as longitude from customer)"


@query(f"with {_CUSTOMER_CACHE} select query from cc where latitude is null or ({sql.AREA})")
def geo7_purge(spark, d):
    c = table(spark, d, "customer").select(F.col("c_name").alias("query"), F.expr("case when c_custkey % 3 = 0 then null else 37.0D + (c_custkey % 40) / 10.0D end").alias("latitude"), F.expr("case when c_custkey % 3 = 0 then null else -80.0D + (c_custkey % 50) / 10.0D end").alias("longitude"))
    return geo.purge(c).select("query")


# ---- candidates


@query(f"with {sql.CANDIDATES} select k, ((case when url is not null and url <> '' then 50 else 0 end) + (case when url like 'https://%' then 10 else 0 end) + (case when discovered_date_text is not null then 25 else 0 end) + (case when discovered_location_text is not null then 15 else 0 end)) / 100.0 as confidence from cand")
def sco3_discovery(spark, d):
    return fx.candidates(spark, d).select(F.regexp_extract("seed_url", r"(\d+)$", 1).cast("long").alias("k"), scores.discovery_confidence(F.col("candidate_original_url"), F.col("discovered_date_text").isNotNull(), F.col("discovered_location_text").isNotNull()).alias("confidence"))


@query(f"with {sql.CANDIDATES}, n as (select count(*) as n from cand) select url, count(*) as hits from cand, n where url is not null group by url, n having count(*) >= greatest(20, ceil(0.15::double * n))")
def agg10_shared_links(spark, d):
    return cand.outlier_urls(fx.candidates(spark, d))


@query(f"with {sql.CANDIDATES} select k, url = 'https://hub.example.com/all' as shared from cand where url is not null")
def join11_split_shared(spark, d):
    c = fx.candidates(spark, d).filter("candidate_original_url is not null").withColumn("k", F.regexp_extract("seed_url", r"(\d+)$", 1).cast("long"))
    own, shared = cand.split_shared(c)
    return own.select("k", F.lit(False).alias("shared")).unionByName(shared.select("k", F.lit(True).alias("shared")))


@query(f"with {sql.CANDIDATES} select candidate_id from identified where status not in ('published', 'rejected') and (discovered_date_text is null or discovered_date_text = 'soon' or cast(discovered_date_text as date) between date '{fx.WEEK}' and date '{fx.WEEK}' + 6)".replace("cast(discovered_date_text as date)", "try_cast(discovered_date_text as date)"))
def src13_review_queue(spark, d):
    return cand.review_queue(fx.candidates(spark, d), fx.WEEK, 2024).select("candidate_id")


@query(f"with {sql.CANDIDATES} select candidate_id, case when k % 2 = 1 then status when status = 'rejected' then 'rejected' else 'needs_review' end as status, case when k % 2 = 1 then case when k % 23 = 0 then 'seen' end when k % 23 = 0 then 'seen' else 'new' end as notes from identified where k % 4 <> 2 union all select candidate_id, 'needs_review', 'new' from identified where k % 4 = 2")
def snk4_merge_queue(spark, d):
    c = fx.candidates(spark, d).withColumn("k", F.regexp_extract("seed_url", r"(\d+)$", 1).cast("long"))
    old = c.filter("k % 4 <> 2").drop("k")
    new = c.filter("k % 2 = 0").drop("k").withColumns({"status": F.lit("needs_review"), "notes": F.lit("new")})
    return cand.merge_queue(old, new).select("candidate_id", "status", "notes")


@query(f"with {sql.CANDIDATES} select candidate_id, case when status = 'rejected' then 'rejected' else 'needs_review' end as status, discovered_title, case when status = 'rejected' then case when k % 23 = 0 then 'seen' end else 'new' end as notes from identified")
def snk5_merge_light(spark, d):
    c = fx.candidates(spark, d)
    new = c.withColumns({"status": F.lit("needs_review"), "notes": F.lit("new"), "discovered_title": F.lit("changed")})
    return cand.merge_queue(c, new, "light").select("candidate_id", "status", "discovered_title", "notes")


# ---- pages


@query("select page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script\\s*>', ' ', 'g'), '(?is)<style\\b.*?</style\\s*>', ' ', 'g'), '(?is)<noscript\\b.*?</noscript\\s*>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) as body from pages")
def htm5_body_text(spark, d):
    return table(spark, d, "pages").select("page_id", pages.body_text(F.col("html")).alias("body"))


_TITLED = f"nullif(trim(regexp_replace({sql.unescaped('title')}, {sql.q(sql.SPACE)}, ' ', 'g')), '')"


@query(f"select url, {_TITLED} as page_title, anchors from (select url, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) as title, len(regexp_extract_all(html, '(?i)<a[\\s>]')) as anchors from pages)")
def htm1_page_facts(spark, d):
    return pages.page_facts(table(spark, d, "pages"), want=["page_title", "anchors"]).select("url", "page_title", F.size("anchors").cast("long").alias("anchors"))


@query(sql.raw("select source_url, title, start_text, location_text, price_text from raw_listing"))
def src2_api_events(spark, d):
    """Listings as calendar-API payloads and read back."""
    r = fx.raw_listing(spark, d)
    e = F.struct("title", F.col("start_text").alias("start"), F.struct(F.col("location_text").alias("name")).alias("location"), F.struct(F.col("source_url").alias("public")).alias("url"), F.when(F.col("ingest_seq") % 2 == 0, F.col("price_text")).alias("cost"), F.when(F.col("ingest_seq") % 2 == 1, F.col("price_text")).alias("fee"))
    payloads = r.groupBy(F.expr("ingest_seq div 50").alias("page")).agg(F.to_json(F.struct(F.collect_list(e).alias("results"))).alias("payload"))
    return landing.api_events(payloads, "api", "Api").select("source_url", "title", "start_text", "location_text", "price_text")


@query(sql.raw("select title, source_url, location_text from raw_listing"))
def src3_listing_cards(spark, d):
    """Listings as library-widget cards on listing pages and read back."""
    r = fx.raw_listing(spark, d)
    place = F.when(F.col("location_text").isNotNull(), F.concat(F.lit('<div class="event-location">'), F.col("location_text"), F.lit("</div>"))).otherwise("")
    card = F.concat(F.lit('<div class="event-card"><h3><a href="'), F.col("source_url"), F.lit('">'), F.col("title"), F.lit('</a></h3><span class="event-time">Monday, Jan 1, 9:00AM - 10:00AM</span>'), place, F.lit("</div>"))
    listing = r.groupBy(F.expr("ingest_seq div 20").alias("page")).agg(F.array_join(F.collect_list(card), "").alias("html")).select(F.concat(F.lit("https://x.example.org/"), F.col("page").cast("string")).alias("url"), "html")
    return pages.cards(listing, "library_widget", "lib", "Lib").select("title", "source_url", "location_text")


# ---- whole jobs


@query(sql.survivors("select count(*) as events, count(*) filter (cost_type = 'free') as free, round(sum(family_friendly_score), 2) as friendliness, min(start) as first_start from survivors"))
def pipe1_daily(spark, d):
    build = jobs.daily(fx.raw_listing(spark, d), fx.AS_OF)
    return build.events.agg(F.count("*").alias("events"), F.count_if(F.col("cost_type") == "free").alias("free"), F.round(F.sum("family_friendly_score"), 2).alias("friendliness"), F.min("start").alias("first_start"))


def number_of(url: str, of: str) -> Column:
    """A URL's number below ``of``, from the first 32 bits of its MD5."""
    return F.expr(f"cast(conv(substring(md5({url}), 1, 8), 16, 10) as bigint) % {of}")


def stand_ins(links: DataFrame, given: DataFrame, parts: int = 4096) -> DataFrame:
    """(url, page_url): each link's page, by the link's hash modulo the number of pages.

    Pages are numbered from 0 by hash part and URL, part by part, so that no task numbers them all.
    """
    p = given.filter("url is not null").select(F.col("url").alias("page_url")).distinct().withColumn("part", number_of("page_url", str(parts)))
    sizes = p.groupBy("part").agg(F.count("*").alias("size"))
    starts = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))  # a row per part
    in_part = F.row_number().over(Window.partitionBy("part").orderBy("page_url"))
    numbered = p.join(starts, "part").select("page_url", (F.col("before") + in_part - 1).alias("n"))
    total = sizes.agg(F.sum("size").alias("total"))
    asked = links.join(F.broadcast(total), F.lit(True)).withColumn("n", number_of("url", "total"))
    return asked.join(numbered, "n").select("url", "page_url")


_MD5 = "(('0x' || substr(md5({0}), 1, 8))::bigint % {1})"
_BODY = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<title\\b.*?</title\\s*>', '', 'g'), '(?is)<(script)\\b.*?</script\\s*>', '', 'g'), '(?is)<style\\b.*?</style\\s*>', '', 'g'), '(?s)<[^>]+>', ' ', 'g')"
_PRICE_IN = f"(regexp_matches(body, {sql.q('(?i)' + pages.LABELLED)}) or regexp_matches(body, {sql.q('(?i)' + pages.PRICED)}))"
_DISCOVERY = f"""with {sql.CANDIDATES},
numbered as (select url as page_url, html, row_number() over (order by {_MD5.format('url', 4096)}, url) - 1 as n, count(*) over () as total
  from (select url, case when count(*) = count(html) then min(html) end as html from pages where url is not null group by url)),
bodies as (select *, trim(regexp_replace({_BODY}, '\\s+', ' ', 'g')) as body, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) <> '' as titled from numbered),
facts as (select n, total, titled, {_PRICE_IN} as priced from bodies),
opened as (select candidate_id, case when contains(url, '{urls.AGGREGATOR}') then null else url end as url, discovered_date_text is not null as dated, discovered_location_text is not null as placed,
    ((case when url is not null then 50 else 0 end) + (case when url like 'https://%' then 10 else 0 end) + (case when discovered_date_text is not null then 25 else 0 end) + (case when discovered_location_text is not null then 15 else 0 end)) / 100.0 as confidence
  from identified where status not in ('published', 'rejected') and (discovered_date_text is null or discovered_date_text = 'soon' or try_cast(discovered_date_text as date) between date '{fx.WEEK}' and date '{fx.WEEK}' + 6)),
linked as (select *, count(*) over () as rows_linked, count(*) over (partition by url) as hits from opened where url is not null),
judged as (select candidate_id, case when hits >= greatest(20, ceil(0.15::double * rows_linked)) then 'shared_site_link' when {_MD5.format('url', 10)} = 3 then 'original_url_dead'
    when round(0.3 * confidence + 0.7 * ((case when titled then 30 else 15 end) + (case when dated then 20 else 0 end) + (case when placed then 10 else 0 end) + (case when priced then 10 else 0 end)) / 100.0, 4) < 0.5 then 'low_confidence' else 'resolved' end as outcome
  from linked join (select distinct total from facts) on true join facts on facts.n = {_MD5.format('linked.url', 'facts.total')})
select candidate_id, 'no_original_url_found' as outcome from opened where url is null union all select candidate_id, outcome from judged"""


@query(_DISCOVERY)
def pipe2_discovery(spark, d):
    """Candidates of the week against pages that the given pages table stands in for; one link in ten has no page."""
    url = F.col("candidate_original_url")
    has_date, has_place = F.col("discovered_date_text").isNotNull(), F.col("discovered_location_text").isNotNull()
    c = fx.candidates(spark, d).withColumn("confidence", scores.discovery_confidence(url, has_date, has_place))
    given = table(spark, d, "pages")
    got = pages.fetched(given).withColumnRenamed("url", "page_url").drop("final_url")
    web = c.filter("candidate_original_url is not null").select(F.col("candidate_original_url").alias("url")).distinct().filter(number_of("url", "10") != 3)
    fetched = stand_ins(web, given).join(got, "page_url").select("url", F.col("url").alias("final_url"), "anchors", "facts", "json_ld")
    raw, review = jobs.discover(c, fetched, fx.WEEK, 2024)
    return raw.select("candidate_id", F.lit("resolved").alias("outcome")).unionByName(review.select("candidate_id", F.col("review_reason").alias("outcome")))


@query(sql.survivors("select id, title, start, cost_type, ingest_seq from survivors"))
def pipe3_repair(spark, d):
    """A published week rebuilt from itself: by the same rules nothing changes."""
    again, _ = jobs.repair(stored(survivors(spark, d), "survivors"), fx.AS_OF)
    return again.select("id", "title", "start", "cost_type", "ingest_seq")


_PURGED = sql.RESOLVED.replace("cache as (select * from (", "cache as (select * from (select * from (").replace(") t(query, latitude, longitude, confidence, resolved_at))", f") t(query, latitude, longitude, confidence, resolved_at)) where latitude is null or {sql.AREA})")
_VIRTUAL = "list_contains(s.tags, 'virtual') or lower(s.location_name) = 'virtual' or contains(lower(s.title), 'virtual')"
_OUTCOME = f"case when coalesce({_VIRTUAL}, false) then 'virtual_skipped' when r.status = 'hit' then 'cache_hit' else r.status end"


@query(sql.survivors(f", {sql.ASKED}, {_PURGED}, out as (select s.id, r.lat, r.lon, {_OUTCOME} as geo_outcome from survivors s join resolved r using (ingest_seq)) select id, case when geo_outcome = 'cache_hit' then lat end as latitude, case when geo_outcome = 'cache_hit' then lon end as longitude, geo_outcome, geo_outcome = 'cache_hit' as is_mappable from out"))
def pipe4_geo_patch(spark, d):
    """Coordinates from the purged cache, where a place outside the area is unknown again."""
    done, _ = jobs.geo_patch(survivors(spark, d), fx.cache_table(spark))
    return done.select("id", "latitude", "longitude", "geo_outcome", "is_mappable")


@query(sql.survivors("select count(*) as total, count(*) as passed, 0::bigint as failed, 0::bigint as errors, count(*) filter (list_contains(tags, 'outdoor') and not list_contains(tags, 'indoor') and rainy) as warnings, true as is_clean, 0::bigint as unreadable from survivors"))
def pipe5_validate(spark, d):
    return jobs.validate(survivors(spark, d))


@query(sql.survivors("select id from survivors"))
def pipe6_dedupe_file(spark, d):
    return jobs.dedupe_file(upcoming(spark, d), ["id"])


# ---- the rest of the inventory, on derived rows


@query(sql.raw("select ingest_seq, source_id from raw_listing where source_id = 'src0'"))
def src8_enabled_sources(spark, d):
    catalogue = spark.sql("select * from values ('src0', 'Zero', true), ('src1', 'One', false), ('src2', 'Two', true) t(id, name, enabled)")
    return landing.of_enabled(fx.raw_listing(spark, d), catalogue).select("ingest_seq", "source_id")


@query(sql.raw("select ingest_seq, coalesce(price_text, case when ingest_seq % 2 = 0 then 'Fee: $' || (ingest_seq % 9 + 1) end) as price_text from raw_listing"))
def src15_detail_prices(spark, d):
    """Missing prices come from the record's own detail page, where there is one."""
    r = fx.raw_listing(spark, d).withColumn("source_url", F.concat("source_url", F.lit("/"), F.col("ingest_seq").cast("string")))
    web = r.filter("price_text is null and ingest_seq % 2 = 0").select(F.col("source_url").alias("url"), F.concat(F.lit('<html><p>About</p><div class="event-price">Fee: $'), (F.col("ingest_seq") % 9 + 1).cast("string"), F.lit("</div></html>")).alias("html"))
    return pages.with_detail_price(r, web).select("ingest_seq", "price_text")


@query(sql.raw("select source_url || '/' || ingest_seq as url, title, start_text, location_text as location_name, price_text as cost_text from raw_listing"))
def jsn1_json_ld(spark, d):
    """All listings, each with a URL of its own, as JSON-LD blocks (object, array or @graph by turns) and read back."""
    r = fx.raw_listing(spark, d).withColumn("source_url", F.concat("source_url", F.lit("/"), F.col("ingest_seq").cast("string")))
    one = F.to_json(F.struct(F.lit("Event").alias("@type"), F.col("title").alias("name"), F.col("start_text").alias("startDate"), F.struct(F.col("location_text").alias("name")).alias("location"), F.struct(F.col("price_text").alias("price")).alias("offers")))
    g = F.expr("ingest_seq % 3")
    block = F.when(g == 0, one).when(g == 1, F.concat(F.lit("[{\"@type\":\"Place\"},"), one, F.lit("]"))).otherwise(F.concat(F.lit("{\"@graph\":["), one, F.lit("]}")))
    got = pages.json_ld_events(r.select(F.col("source_url").alias("url"), F.array(F.lit("no json"), block).alias("json_ld")))
    return got.select("url", "ld.title", "ld.start_text", "ld.location_name", "ld.cost_text")


@query(sql.raw("select ingest_seq, title from raw_listing"))
def src12_any_documents(spark, d):
    """All listings in groups of ten as an array or an envelope by turns, read back, with broken texts beside them."""
    r = fx.raw_listing(spark, d)
    one = r.groupBy(F.expr("ingest_seq div 10").alias("g")).agg(F.to_json(F.collect_list(F.struct("ingest_seq", "title"))).alias("a"))
    docs = one.select(F.when(F.col("g") % 2 == 0, F.col("a")).otherwise(F.concat(F.lit('{"week_start":"x","events":'), F.col("a"), F.lit("}"))).alias("value")).unionByName(r.filter("ingest_seq % 10 = 9").select(F.lit("{broken").alias("value")))
    return landing.any_events(docs).selectExpr("try_variant_get(event, '$.ingest_seq', 'bigint') as ingest_seq", "try_variant_get(event, '$.title', 'string') as title")


@query(f"with {sql.CANDIDATES} select k, discovered_title, discovered_location_text from cand")
def src9_seed_candidates(spark, d):
    """All candidates as aggregator cards and read back."""
    c = fx.candidates(spark, d).withColumn("k", F.regexp_extract("seed_url", r"(\d+)$", 1).cast("long"))
    place = F.when(F.col("discovered_location_text").isNotNull(), F.concat(F.lit('<span class="venue">'), F.col("discovered_location_text"), F.lit("</span>"))).otherwise("")
    card = F.concat(F.lit('<article><h3><a href="'), F.col("seed_url"), F.lit('">'), F.col("discovered_title"), F.lit('</a></h3><time datetime="2024-01-01">January 1</time>'), place, F.lit("</article>"))
    listing_pages = c.groupBy(F.expr("k div 100").alias("g")).agg(F.array_join(F.collect_list(card), "").alias("html")).select(F.concat(F.lit("https://list.example.org/"), F.col("g").cast("string")).alias("url"), "html")
    registry.seed("aggregator", lambda listing: pages.seed_candidates(listing, "aggregator"))  # EXT2
    return registry.SEEDS["aggregator"](listing_pages).select(F.regexp_extract("seed_url", r"(\d+)$", 1).cast("long").alias("k"), "discovered_title", "discovered_location_text")


@query(f"with {sql.CANDIDATES} select candidate_id, coalesce(url, case when k % 2 = 0 then 'https://found.example.net/' || k end) as url, case when url is null and k % 2 = 0 then 0.7 else 0.2 end as confidence, case when url is null and k % 2 = 1 then 'no_original_url_found' end as review_reason from identified")
def cand2_chosen_urls(spark, d):
    """All candidates, those with the aggregator's own and Facebook links too; half of the candidates without a link find one on their detail page."""
    k = F.regexp_extract("seed_url", r"(\d+)$", 1).cast("long")
    c = fx.candidates(spark, d).withColumn("confidence", F.lit(0.2))
    web = c.filter(k % 2 == 0).select(F.col("seed_url").alias("url"), F.array(F.struct(F.lit("Home").alias("text"), F.lit("/").alias("href")), F.struct(F.lit("share").alias("text"), F.lit("https://x.com/s").alias("href")), F.struct(F.lit("Event website").alias("text"), F.concat(F.lit("https://found.example.net/"), k.cast("string")).alias("href"))).alias("anchors"))
    return cand.chosen_urls(c, web).select("candidate_id", F.col("candidate_original_url").alias("url"), F.round("confidence", 4).alias("confidence"), "review_reason")


def small_events(spark, d):
    """Events of the given events table: one venue in three is virtual, points lie in and out of the area."""
    e = table(spark, d, "events")
    return e.select(
        F.col("event_id").cast("string").alias("id"), F.concat(F.lit("Event "), F.col("event_type")).alias("title"), F.col("ts").cast("timestamp_ntz").alias("start"), F.expr("case when event_id % 3 = 0 then 'Online' else 'Hall' end").alias("location_name"), F.lit(None).cast("string").alias("location_address"),
        F.array(F.lit("arts")).alias("tags"), F.lit(None).cast("string").alias("summary"), F.lit(None).cast("string").alias("short_note"), F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("county"), F.lit(None).cast("double").alias("geo_confidence"),
        F.expr("case when event_id % 4 = 0 then null else 38.0D + (event_id % 20) / 10.0D end").alias("latitude"), F.lit(-77.0).alias("longitude"), F.concat(F.lit("https://h"), (F.col("event_id") % 5).cast("string"), F.lit(".org/x")).alias("source_url"), F.col("event_type").alias("source_name"),
    )


_LAT = "case when event_id % 4 = 0 then null else 38.0 + (event_id % 20) / 10.0 end"
_IN = "coalesce(round(" + _LAT + ", 1) between 38.3 and 39.6, false)"


@query(f"select event_id::varchar as id, case when event_id % 3 = 0 then case when event_id % 4 = 0 then 'virtual_skipped' else 'virtual_cleared' end when {_IN} then 'already_geocoded' else 'pending' end as geo_outcome, event_id % 3 <> 0 and {_IN} as is_mappable from events")
def geo5_geo6_flow(spark, d):
    done = geo.geocode(small_events(spark, d).withColumn("latitude", F.round("latitude", 1)), fx.cache_table(spark))
    return done.select("id", "geo_outcome", "is_mappable")


@query(f"select event_id::varchar as id, round({_LAT}, 1) as given_latitude from events where event_id % 4 <> 0 and not {_IN}")
def snk8_suspicious(spark, d):
    done = geo.geocode(small_events(spark, d).withColumn("latitude", F.round("latitude", 1)), fx.cache_table(spark), "report")
    return geo.suspicious(done).select("id", "given_latitude")


@query("select strftime(date_trunc('week', ts), '%Y-%m-%d') as week_start, count(*) as event_count, count(distinct event_id % 5) as source_count, strftime(min(ts), '%Y-%m-%dT%H:%M:%S') as first_start from events group by 1")
def snk1_envelope(spark, d):
    """All events, each in the envelope of its week."""
    dated = small_events(spark, d).withColumn("start", F.date_trunc("SECOND", "start").cast("timestamp_ntz"))
    parts = publish.envelopes(dated, "now").select("week_start", "source_count", F.size("events").alias("n"), F.col("events")[0]["start"].alias("first"))
    return parts.groupBy("week_start").agg(F.sum("n").alias("event_count"), F.max("source_count").alias("source_count"), F.min("first").alias("first_start"))


@query("select query, latitude from (select c_name as query, case when c_custkey % 2 = 0 then 38.5 else case when c_custkey % 3 = 0 then null else 39.0 end end as latitude from customer)")
def snk10_cache_merge(spark, d):
    """Newer answers replace older ones, positive or negative."""
    c = table(spark, d, "customer").select(F.col("c_name").alias("query"), F.col("c_custkey").alias("k"))
    row = lambda lat, when: [F.expr(lat).cast("double").alias("latitude"), F.lit(-77.0).alias("longitude"), F.lit(0.9).alias("confidence"), F.lit(when).cast("timestamp").alias("resolved_at")]
    old = c.select("query", *row("case when k % 3 = 0 then null else 39.0D end", "2024-01-01 00:00:00"))
    return geo.merge_cache(old, c.filter("k % 2 = 0").select("query", *row("38.5D", "2024-02-01 00:00:00"))).select("query", "latitude")


@query(f"with {sql.CANDIDATES} select candidate_id, 1 as resolution_attempts from identified where status not in ('rejected', 'published')")
def flt8_open_candidates(spark, d):
    return filters.open_candidates(fx.candidates(spark, d)).select("candidate_id", "resolution_attempts")


@query(f"with {sql.CANDIDATES} select candidate_id, case when contains(url, '{urls.AGGREGATOR}') then null else url end as url, k % 2 = 0 as review from identified")
def cand1_self_checks(spark, d):
    c = fx.candidates(spark, d).withColumn("confidence", F.when(F.regexp_extract("seed_url", r"(\d+)$", 1).cast("long") % 2 == 0, 0.3).otherwise(0.8))
    return cand.self_checks(c).select("candidate_id", F.col("candidate_original_url").alias("url"), F.col("requires_manual_review").alias("review"))


@query(f"with {sql.CANDIDATES} select count(*) as found, count(*) filter (k % 3 = 0) as need_review, count(*) filter (status = 'published') as resolved, count(*) filter (status = 'rejected') as queued from identified")
def agg12_discovery(spark, d):
    c = fx.candidates(spark, d).withColumns({"requires_manual_review": F.regexp_extract("seed_url", r"(\d+)$", 1).cast("long") % 3 == 0, "status": F.when(F.col("status") == "published", "resolved").when(F.col("status") == "rejected", "needs_review").otherwise(F.col("status"))})
    return reports.discovery(c)


@query("select k, least(100, (case when k % 2 = 0 then 30 else 15 end) + (case when k % 3 = 0 then 30 else 20 end) + (case when k % 5 = 0 then 20 else 10 end) + (case when k % 7 = 0 then 10 else 0 end) + (case when k % 2 = 1 then 10 else 0 end)) / 100.0 as extraction, round(0.3 * 0.5 + 0.7 * (least(100, (case when k % 2 = 0 then 30 else 15 end) + (case when k % 3 = 0 then 30 else 20 end) + (case when k % 5 = 0 then 20 else 10 end) + (case when k % 7 = 0 then 10 else 0 end) + (case when k % 2 = 1 then 10 else 0 end)) / 100.0), 4) as combined from (select o_orderkey as k from orders)")
def sco4_sco5_confidence(spark, d):
    k = F.col("k")
    on = lambda n: F.when(k % n == 0, F.lit("x"))
    none = F.lit(None).cast("string")
    facts = F.struct(on(2).alias("title"), on(3).alias("start_text"), on(5).alias("location_name"), none.alias("location_address"), on(7).alias("cost_text"), none.alias("description_snippet"), none.alias("registration_url"))
    found = F.struct(F.lit("t").alias("title"), F.lit("s").alias("start_text"), F.lit("l").alias("location_name"))
    e = scores.extraction_confidence(facts, found, k % 2 == 1, F.lit(False))
    return fx.orders(spark, d).select("k", e.alias("extraction")).withColumn("combined", scores.combined_confidence(F.lit(0.5), F.col("extraction")))


@query("select k, case when k % 4 <> 0 then 'Long Page Title ' || k when k % 3 <> 0 then 'Found ' || k else 'Home' end as title, case when k % 3 = 0 then 'ld' when k % 2 = 0 then 'og' else 'html' end as start_text from (select o_orderkey as k from orders)")
def fct1_fct2_facts(spark, d):
    """Facts merged by trust; a generic page title gives way to the discovered one."""
    k = F.col("k")
    side = lambda start: F.struct(*[(start if f == "start_text" else F.lit(None)).cast("string").alias(f) for f in cand.FACTS])
    merged = cand.merge_facts(side(F.when(k % 3 == 0, "ld").otherwise("")), side(F.when(k % 2 == 0, "og")), side(F.lit("html")))
    title = cand.arbitrate_title(F.when(k % 4 != 0, F.concat(F.lit("Long Page Title "), k.cast("string"))).otherwise("Home"), F.when(k % 3 != 0, F.concat(F.lit("Found "), k.cast("string"))))
    return fx.orders(spark, d).select("k", title.alias("title"), merged["start_text"].alias("start_text"))


@query(sql.raw("select ingest_seq, list_sort(list_distinct(list_concat(['zz'], case i when 0 then ['indoor'] when 1 then ['outdoor', 'farm'] when 2 then ['indoor', 'storytime'] when 3 then ['outdoor'] else [] end)))::varchar as tags, coalesce(case i when 0 then true when 1 then false when 2 then true when 3 then false end, false) as rainy_day_friendly, coalesce(case when ingest_seq % 2 = 0 then 'Own' end, case i when 0 then 'Springfield' when 1 then 'Aldie' when 3 then 'Oakton' end) as city from (select *, " + _HINT.replace("lower(t)", "lower(location_text)") + " as i from raw_listing)"))
def join2_apply_hint(spark, d):
    hint = lookup.first_hint(F.col("location_text"), fx.HINTS, ["keyword", "tags", "rainy", "city", "county"])
    r = fx.raw_listing(spark, d).withColumns({"hint": hint, "tags": F.array(F.lit("zz")), "rainy_day_friendly": F.lit(False), "city": F.when(F.col("ingest_seq") % 2 == 0, "Own"), "county": F.lit(None).cast("string")})
    return lookup.apply_hint(r).select("ingest_seq", F.concat(F.lit("["), F.array_join("tags", ", "), F.lit("]")).alias("tags"), "rainy_day_friendly", "city")


@query("select page_id, case when regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) = 'en' then 'English Hall' end as venue from pages")
def join12_slug_venues(spark, d):
    venues = spark.sql("select * from values ('en', 'English Hall') t(slug, venue)")
    return lookup.slug_venue(table(spark, d, "pages").select("page_id", F.col("url").alias("source_url")), venues).select("page_id", "venue")


@query(sql.raw("select ingest_seq, keyword from (select ingest_seq, keyword, row_number() over (partition by ingest_seq order by rank) as n from raw_listing join (values (1, 'elm street'), (2, 'oak community'), (3, 'community center'), (4, 'farm')) h(rank, keyword) on contains(lower(location_text), keyword)) where n = 1"))
def join1_large_hints(spark, d):
    """The join form for rule tables that are too large for a literal."""
    rows = spark.sql("select * from values (1, 'elm street'), (2, 'oak community'), (3, 'community center'), (4, 'farm') t(rank, keyword)")
    return lookup.hinted(fx.raw_listing(spark, d), rows, "location_text").select("ingest_seq", "keyword")


@query("select event_id, case when event_id % 2 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S') else strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.500000' end as iso from events")
def dt7_iso(spark, d):
    t = F.date_trunc("SECOND", "ts")
    return table(spark, d, "events").select("event_id", dates.iso(F.when(F.col("event_id") % 2 == 0, t).otherwise(t + F.expr("interval 500 milliseconds"))).alias("iso"))


@query("select c_custkey, c_custkey % 3 = 0 as several, c_custkey % 2 = 0 as machine, c_custkey % 5 = 0 as generic from customer")
def str16_str17_str19_tests(spark, d):
    k = F.col("c_custkey")
    note = F.when(k % 3 == 0, F.lit("It rains. Bring boots.")).otherwise(F.lit("Dr. Jones reads on St. Mary St. today."))
    name = F.when(k % 2 == 0, F.lit("Airandspace.Si")).otherwise(F.lit("Public Library"))
    title = F.when(k % 5 == 0, F.lit("Page not found")).otherwise(F.concat(F.lit("Evening "), k.cast("string")))
    return table(spark, d, "customer").select("c_custkey", text.several_sentences(note).alias("several"), text.machine_name(name).alias("machine"), text.generic_page_title(title).alias("generic"))


@query("select c_custkey, case when c_custkey % 2 = 0 then 'Registration fee: $' || c_custkey else 'Fee $' || c_custkey end as price, nullif(concat_ws(', ', case when c_custkey % 3 = 0 then null else c_name end, case when c_custkey % 5 = 0 then null else c_mktsegment end), '') as place from customer")
def str13_str20_texts(spark, d):
    k = F.col("c_custkey").cast("string")
    verbose = F.concat(F.repeat(F.lit("Come and see. "), 20), F.lit("Registration fee: $"), k, F.lit(". Then more."))
    price = text.salvaged_price(F.when(F.col("c_custkey") % 2 == 0, verbose).otherwise(F.concat(F.lit("  Fee  $"), k)))
    place = text.place_text(F.when(F.col("c_custkey") % 3 == 0, F.lit("  ")).otherwise(F.col("c_name")), F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit(" "), F.col("c_mktsegment"))))
    return table(spark, d, "customer").select("c_custkey", price.alias("price"), place.alias("place"))
