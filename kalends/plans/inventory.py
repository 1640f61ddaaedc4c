"""More registered queries: layouts, page prices, round trips through files, streams, whole tables of planted cases."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kalends import rules, schemas
from kalends.functions import regions, text, urls
from kalends.functions.store import scratch, stored
from kalends.operators import candidates as cand
from kalends.operators import dedupe, geo, lookup, quality, reports, scans
from kalends.operators.normalise import places, published_to_raw, union_all
from kalends.operators.pricing import legacy_cost, with_pricing
from kalends.plans import listing as fx
from kalends.plans import oracles as sql
from kalends.plans.queries import query, small_events, survivors, table
from kalends.sources import landing, layouts, ledger, pages, publish, registry
from kalends.streaming import first_seen, increments, weeks

L, C = F.lit, F.col


def html(*parts: Column | str) -> Column:
    """Texts and columns joined; a null column counts as empty."""
    return F.concat(*[L(p) if isinstance(p, str) else F.coalesce(p.cast("string"), L("")) for p in parts])


def by_turns(index: str, *choices: Column | str | None) -> Column:
    """The choice that the index, taken modulo their number, points to."""
    at = F.expr(f"({index}) % {len(choices)}")
    pick = lambda c: L(c).cast("string") if c is None or isinstance(c, str) else c
    return reduce(lambda other, ic: F.when(at == ic[0], pick(ic[1])).otherwise(other), enumerate(choices), L(None).cast("string"))


def listing_pages(rows: DataFrame, card: Column, host: str, per_page: int = 20) -> DataFrame:
    """Cards gathered into pages (url, html) of so many rows."""
    body = F.array_join(F.collect_list(card), "").alias("html")
    number = F.expr(f"ingest_seq div {per_page}").alias("page")
    return rows.groupBy(number).agg(body).select(html(f"https://{host}/", C("page")).alias("url"), "html")


def seq_of(url: str) -> Column:
    return F.regexp_extract(url, r"e(\d+)$", 1).cast("long").alias("ingest_seq")


# ---- listing layouts


@query(sql.raw("""select ingest_seq, title, case ingest_seq % 3 when 0 then 'Riverside Park' when 1 then 'Oak Hall' end as venue,
  case ingest_seq % 4 when 0 then '$' || (ingest_seq % 90 + 1) || ' per child' when 1 then 'free' when 2 then '$' || (ingest_seq % 80 + 2) end as price_text
  from raw_listing"""))
def src4_county_parks(spark, d):
    """SRC4: county-parks cards; the venue from the URL's slug, the price from the description, else from the detail page."""
    r = fx.raw_listing(spark, d)
    slug = by_turns("ingest_seq", "riverside", "oak-hall", "elsewhere")
    said = by_turns("ingest_seq", html("Costs $", F.expr("ingest_seq % 90 + 1"), " per child."), "This is free.", "Come.", None)
    card = html(
        '<div class="views-row"><h3 class="event-title"><a href="/', slug, "/e", C("ingest_seq"), '">', C("title"),
        '</a></h3><span class="event-date">Monday, Jan 1, 9:00AM - 10:00AM</span><div class="description">', said, "</div></div>",
    )
    got = pages.cards(listing_pages(r, card, "parks.example.org"), "county_parks", "parks", "Parks")
    detail = r.filter("ingest_seq % 4 = 2").select(
        html("https://parks.example.org/", slug, "/e", C("ingest_seq")).alias("url"),
        html("<p>A day out.</p><div class='event-price'>$", F.expr("ingest_seq % 80 + 2"), "</div>").alias("html"),
    )
    venues = spark.sql("select * from values ('riverside', 'Riverside Park'), ('oak-hall', 'Oak Hall') t(slug, venue)")
    priced = lookup.slug_venue(pages.with_detail_price(got, detail), venues)
    return priced.select(seq_of("source_url"), "title", "venue", "price_text")


@query(sql.raw("""select ingest_seq, title, strftime(cast(start_text as timestamp), '%b') || ' ' || day(cast(start_text as timestamp)) || ' ' || year(cast(start_text as timestamp)) as start_text,
  location_text, summary_text from raw_listing"""))
def src5_date_spans(spark, d):
    """SRC5: cards whose date stands in three spans."""
    r = fx.raw_listing(spark, d)
    part = lambda name, form: html(f'<span class="{name}">', F.date_format(F.to_timestamp("start_text"), form), "</span>")
    place = F.coalesce(html('<div class="location">', C("location_text"), "</div>"), L(""))
    place = F.when(C("location_text").isNotNull(), place).otherwise("")
    summary = F.when(C("summary_text").isNotNull(), html('<p class="summary">', C("summary_text"), "</p>")).otherwise("")
    card = html(
        '<div class="event-listing"><a class="title" href="/e', C("ingest_seq"), '">', C("title"), "</a>",
        part("month", "MMM"), part("day", "d"), part("year", "yyyy"), place, summary, "</div>",
    )
    got = pages.cards(listing_pages(r, card, "spans.example.org"), "date_spans", "spans", "Spans")
    return got.select(seq_of("source_url"), "title", "start_text", "location_text", "summary_text")


@query(sql.raw("""select ingest_seq, title, case when ingest_seq % 5 = 0 then left(repeat('Long talk. ', 60), 400) else 'Short talk.' end as summary_text,
  'https://nova.example.org/i/' || ingest_seq || '.png' as image_url, case when ingest_seq % 2 = 0 then '$5' end as price_text from raw_listing where ingest_seq % 7 <> 3"""))
def src6_park_cards(spark, d):
    """SRC6 and EXT1: a source registered by its layout; class names by preference, a summary cap, cards without a link left out."""
    r = fx.raw_listing(spark, d)
    title = F.when(F.expr("ingest_seq % 2 = 0"), html('<h5 class="card-title">', C("title"), "</h5><h3>Not this</h3>")).otherwise(html("<h3>", C("title"), "</h3>"))
    link = F.when(F.expr("ingest_seq % 7 <> 3"), html('<a href="/e', C("ingest_seq"), '">more</a>')).otherwise("")
    talk = F.when(F.expr("ingest_seq % 5 = 0"), F.repeat(L("Long talk. "), L(60))).otherwise("Short talk.")
    summary = F.when(F.expr("ingest_seq % 3 = 0"), html('<div class="card-text">', talk, "</div><p>Not this</p>")).otherwise(html("<p>", talk, "</p>"))
    price = F.when(F.expr("ingest_seq % 2 = 0"), L('<span class="price">$5</span>')).otherwise("")
    card = html('<div class="card"><img src="/i/', C("ingest_seq"), '.png">', title, link, summary, price, "</div>")
    registry.listing_source("nova", "Nova", "park_cards")
    got = registry.SOURCES["nova"](listing_pages(r, card, "nova.example.org"))
    return got.select(seq_of("source_url"), "title", F.trim("summary_text").alias("summary_text"), "image_url", "price_text")


# ---- facts of single pages



@query(sql.raw("""select ingest_seq, (ingest_seq % 20)::int as position, title, case when ingest_seq % 2 = 0 then location_text end as place, case when ingest_seq % 5 = 0 then '$' || (ingest_seq % 30 + 1) end as price
  from raw_listing"""))
def ext4_lateral_cards(spark, d):
    """EXT4: cards of listing pages from SQL alone, by the registered table function; pages that are null or have no card add nothing."""
    r = fx.raw_listing(spark, d).repartition(F.expr("ingest_seq div 20"))
    place = F.when(F.expr("ingest_seq % 2 = 0 and location_text is not null"), html('<p class="card-location">', C("location_text"), "</p>"))
    price = F.when(F.expr("ingest_seq % 5 = 0"), html('<b class="price">$', F.expr("ingest_seq % 30 + 1"), "</b>"))
    card = html('<div class="card"><h3 class="card-title">', C("title"), '</h3><a href="/e', C("ingest_seq"), '">More</a>', place, price, "</div>")
    one = F.struct("ingest_seq", card.alias("card"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["card"]), "")
    listing = r.groupBy(F.expr("ingest_seq div 20").alias("page")).agg(body.alias("html"))
    odd = r.filter("ingest_seq % 20 = 0").select(F.expr("-ingest_seq").alias("page"), by_turns("ingest_seq div 20", "<p>No cards</p>", None).alias("html"))
    layouts.register(spark)
    return spark.sql("select c.position, c.title, c.place, c.price, bigint(regexp_extract(c.href, '(\\\\d+)$')) as ingest_seq from {pages} p, lateral layout_cards(p.html, 'park_cards') c", pages=listing.unionByName(odd))


@query(sql.raw("""select ingest_seq, case when ingest_seq % 2 = 0 then title else 'Page ' || ingest_seq end as title,
  case ingest_seq % 3 when 0 then left(repeat('All about it. ', 30), 280) when 1 then 'From the description tag' end as description_snippet,
  case when ingest_seq % 5 = 0 then 'https://i.example.org/' || ingest_seq end as image_url from raw_listing"""))
def htm1_open_graph(spark, d):
    """HTM1: Open Graph fields, with the page's title and description where they are missing."""
    meta = lambda name, value: html('<meta property="', name, '" content="', value, '">')
    page = html(
        "<html><head><title>Page ", C("ingest_seq"), "</title>", F.when(F.expr("ingest_seq % 2 = 0"), meta("og:title", C("title"))),
        by_turns("ingest_seq", meta("og:description", F.repeat(L("All about it. "), L(30))), '<meta name="description" content="From the description tag">', None),
        F.when(F.expr("ingest_seq % 5 = 0"), meta("og:image", html("https://i.example.org/", C("ingest_seq")))), "</head><body></body></html>",
    )
    facts = pages.page_facts(fx.raw_listing(spark, d).select(html("https://og.example.org/e", C("ingest_seq")).alias("url"), page.alias("html")))
    og = facts.select("url", pages.open_graph(C("meta"), C("page_title")).alias("og"))
    return og.select(seq_of("url"), "og.title", "og.description_snippet", "og.image_url")


_N = "(ingest_seq % 90 + 1)"


@query(sql.raw(f"""select ingest_seq, case when ingest_seq % 2 = 0 then start_text end as start_text, case when ingest_seq % 4 = 0 then start_text || ' end' end as end_text,
  case ingest_seq % 7 when 0 then '$' || {_N} || ' per child' when 1 then 'See website' when 2 then '$' || {_N} || ' per team' when 3 then 'free event' when 4 then '$' || {_N} when 5 then 'twelve coins' end as page_price,
  case ingest_seq % 7 when 0 then '$' || {_N} || ' per child' when 1 then '$' || {_N} || ' at the door' when 2 then '$' || {_N} when 3 then 'free event' when 4 then '$' || {_N} end as detail_price
  from raw_listing"""))
def htm2_htm4_page_prices(spark, d):
    """HTM2-HTM4: times, and prices by both strategies: containers, labelled tails, registration, free and bare dollar texts, none."""
    n = F.expr("ingest_seq % 90 + 1")
    times = html(
        F.when(F.expr("ingest_seq % 2 = 0"), html('<time datetime="', C("start_text"), '">then</time>')),
        F.when(F.expr("ingest_seq % 4 = 0"), html('<time datetime="', C("start_text"), ' end">until</time>')),
    )
    price = by_turns(
        "ingest_seq", html('<div class="event-price">$', n, " per child</div>"), html('<div class="ticket-box">See website</div><p>Admission: $', n, " at the door. Park after.</p>"),
        html("<p>Registration is $", n, " per team</p>"), "<p>This is a free event for all.</p>", html("<p>Bring $", n, " cash</p>"), "<p>Cost: twelve coins. More</p>", "<p>Come along.</p>",
    )
    rows = fx.raw_listing(spark, d).select(html("https://p.example.org/e", C("ingest_seq")).alias("url"), html("<html><body>", times, price, "</body></html>").alias("html"))
    f = pages.page_facts(rows)
    own = pages.html_facts(C("times"), pages.page_price(C("price_texts"), C("body")))
    got = f.select("url", own.alias("h"), pages.detail_price(C("price_texts"), C("body")).alias("detail_price"))
    return got.select(seq_of("url"), "h.start_text", "h.end_text", C("h")["cost_text"].alias("page_price"), "detail_price")


_HREF = f"""case k % 7 when 0 then '/event/' || k when 1 then '#' when 2 then '' when 3 then '/calendar/month/' when 4 then 'https://elsewhere.example.net/' || k
  when 5 then 'https://{urls.AGGREGATOR}/event/' || k end"""


@query(f"""select k, case k % 7 when 0 then 'https://{urls.AGGREGATOR}/event/' || k when 5 then 'https://{urls.AGGREGATOR}/event/' || k end as detail
  from (select o_orderkey as k from orders)""")
def url5_detail_urls(spark, d):
    """URL5: relative and absolute detail pages; null for fragments, empty links, listing pages and other sites."""
    return fx.orders(spark, d).select("k", urls.detail_url(F.expr(_HREF)).alias("detail"))


@query("""select k, case k % 4 when 0 then '$' || (k % 50 + 1) || ' per child' when 1 then 'Free' when 2 then '$' || (k % 50 + 1) || '/family' end as price
  from (select o_orderkey as k from orders)""")
def str15_card_prices(spark, d):
    """STR15: a price in a card's description."""
    amount = html("$", F.expr("k % 50 + 1"))
    said = by_turns("k", html("It is ", amount, " per child today."), "Free for all.", html("Only ", amount, "/family now"), "Bring a friend.")
    return fx.orders(spark, d).select("k", text.card_price(said).alias("price"))


# ---- prices in full

_TIDY = "nullif(left(regexp_replace(regexp_replace(trim({0}), '^[,.;:]+|[,.;:]+$', '', 'g'), '\\s+', ' ', 'g'), 200), '')"
_FOUND = lambda p: f"nullif(regexp_extract(text, {sql.q('(?i)' + p)}, 0), '')"
_SNIPPET = _TIDY.format("coalesce(" + ", ".join(map(_FOUND, rules.SNIPPETS)) + ")")
_CLEAN = "nullif(left(trim(regexp_replace({0}, '\\s+', ' ', 'g')), 200), '')"
_MARKS = {
    "mixed_pricing": ("mixed", rules.MIXED), "donation_language": ("donation", rules.DONATION), "strong_paid_signal": ("strong_paid", rules.STRONG_PAID),
    "dollar_amount": ("dollar_amount", rules.DOLLAR), "explicit_free_text": ("explicit_free", rules.EXPLICIT_FREE), "conflicting_free_and_paid": ("explicit_free", rules.EXPLICIT_FREE),
    "weak_paid_signal": ("weak_paid", rules.WEAK_PAID), "paid_program_format_no_price": ("paid_program_keyword", rules.PAID_PROGRAM),
}
_MARK = "case reason " + " ".join(f"when {sql.q(r)} then {sql.q(n + ':')} || {_FOUND(p)}" for r, (n, p) in _MARKS.items())
_MARK += " when 'zero_cost_value' then 'zero_value:' || price_text when 'library_default_free' then 'library_default' when 'public_source_default_free' then 'public_default' when 'free_word_only' then 'free_word' end"
DETAILED = f"""
snipped as (select *, {_SNIPPET} as short, {_CLEAN.format('price_text')} as clean, {_TIDY.format(_FOUND(rules.SNIPPETS[0]))} as fee, {_MARK} as mark from priced),
detailed as (select *, case when reason = 'zero_cost_value' then 'Free' else coalesce(short, clean) end as pricing_summary,
  case when reason = 'zero_cost_value' then 'Free' else coalesce(clean, case when cost_type in ('paid', 'suggested_donation') then short end) end as published_price,
  reason <> 'zero_cost_value' and {sql.rx('text', rules.REGISTRATION)} as registration_required,
  case when (reason = 'mixed_pricing' and contains(lower(text), 'registration') and {sql.rx('text', rules.DOLLAR)})
    or (reason = 'strong_paid_signal' and contains(lower({_FOUND(rules.STRONG_PAID)}), 'registration')) then fee end as registration_fee_text,
  case when reason = 'zero_cost_value' then trim(price_text) else coalesce(clean, short) end as extracted_price_text,
  concat_ws(';', mark, case when reason = 'conflicting_free_and_paid' then 'conflicting_weak_paid' end) as patterns from snipped)"""


@query(f"""with {sql.RAW}, {sql._PLACE}, {sql.PRICED}, {DETAILED} select ingest_seq, reason, pricing_summary, published_price as price_text, registration_required, registration_fee_text,
  extracted_price_text, patterns, cost_type as legacy_type, case when cost_type = 'free' and published_price is null then 'Free' else published_price end as legacy_text from detailed""")
def prc4_prc6_price_details(spark, d):
    """PRC4-PRC6: every field of a classified price, and the legacy triple."""
    r = fx.raw_listing(spark, d).drop("location_text")
    where = places(fx.raw_listing(spark, d)).select(C("ingest_seq").alias("_seq"), "location_name")
    df = with_pricing(r.join(where, C("ingest_seq") == C("_seq")).withColumnRenamed("summary_text", "summary"))
    p = C("pricing")
    got = legacy_cost(df.withColumn("given", C("price_text")))
    return got.select(
        "ingest_seq", p["reason"].alias("reason"), p["pricing_summary"].alias("pricing_summary"), p["price_text"].alias("price_text"),
        p["registration_required"].alias("registration_required"), p["registration_fee_text"].alias("registration_fee_text"),
        p["extracted_price_text"].alias("extracted_price_text"), F.array_join(p["matched_patterns"], ";").alias("patterns"),
        C("cost_type").alias("legacy_type"), C("cost_text").alias("legacy_text"),
    )


# ---- round trips through files


@query(sql.raw("select ingest_seq, source_id, title, 'landed' as via from raw_listing where ingest_seq % 3 <> 0 union all select ingest_seq, 'seed', title, 'seed' from raw_listing where ingest_seq % 3 = 0"))
def src10_landed_and_seeds(spark, d):
    """SRC1, SRC10, SET1: JSON arrays of records written as files, two producers read and united."""
    r = fx.raw_listing(spark, d)
    one = F.to_json(F.struct("ingest_seq", "source_id", "title", L("x").alias("unknown_key")))

    def landed(rows: DataFrame, name: str) -> DataFrame:
        path = scratch(spark, name)
        array = html("[", F.array_join(F.collect_list(one), ","), "]").alias("value")
        rows.groupBy(F.expr("ingest_seq div 5000").alias("file")).agg(array).write.partitionBy("file").text(path)
        return landing.raw_records(spark, path)

    own = landed(r.filter("ingest_seq % 3 <> 0"), "landed").withColumn("via", L("landed"))
    seeds = landed(r.filter("ingest_seq % 3 = 0").withColumn("source_id", L("seed")), "seeds").select("ingest_seq", "source_id", "title", L("seed").alias("via"))
    return union_all([own, seeds]).select("ingest_seq", "source_id", "title", "via")


@query(sql.survivors("select strftime(date_trunc('week', start), '%Y-%m-%d') as week_start, id, title, start, cost_type, array_to_string(tags, ',') as tags from survivors"))
def src11_published_weeks(spark, d):
    """SNK1 and SRC11: a document per week written, and its events read back."""
    path = scratch(spark, "weeks")
    publish.write_envelopes(stored(survivors(spark, d), "survivors"), path, "now")  # documents hold all columns
    return landing.published_week(spark, path).select(C("week_start").cast("string").alias("week_start"), "id", "title", "start", "cost_type", F.array_join("tags", ",").alias("tags"))


@query(sql.survivors("select id, ingest_seq, title from survivors"))
def snk3_snapshot(spark, d):
    """SNK3: the normalised snapshot written and read back."""
    path = scratch(spark, "snapshot")
    publish.write_snapshot(survivors(spark, d), path)
    return spark.read.parquet(path).select("id", "ingest_seq", "title")


@query("""select c_name as query, case when c_custkey % 5 <> 0 then round(38 + c_custkey / 7.0, 6) end as latitude, case when c_custkey % 5 <> 0 then round(-77 - c_custkey / 11.0, 6) end as longitude,
  case when c_custkey % 5 <> 0 then case when c_custkey % 2 = 0 then 0.9 else 0.5 end end as confidence from customer""")
def src14_geo8_cache(spark, d):
    """GEO8 and SRC14: a geocoder's answers as cache rows, written and scanned."""
    k, path = C("c_custkey"), scratch(spark, "cache")
    hit = k % 5 != 0
    found = table(spark, d, "customer").select(
        C("c_name").alias("query"), F.when(hit, 38 + k / 7.0).alias("latitude"), F.when(hit, -77 - k / 11.0).alias("longitude"),
        F.when(k % 2 == 0, html("osm", k)).alias("map_id"), L("2024-01-01 00:00:00").cast("timestamp").alias("resolved_at"),
    )
    geo.cache_rows(found).write.parquet(path)
    return landing.geo_cache(spark, path).select("query", "latitude", "longitude", "confidence")


# ---- reports and order


@query(sql.survivors("select id, title, source_name, start, family_relevance_score, family_relevance_label from survivors where family_relevance_score < 0.45"))
def snk6_exclusion_report(spark, d):
    """SNK6: the report of excluded rows, written and read back."""
    path = scratch(spark, "excluded")
    publish.write_json(reports.exclusion_report(survivors(spark, d).filter("family_relevance_score < 0.45")), path)
    return spark.read.schema("id string, title string, source_name string, start timestamp_ntz, family_relevance_score double, family_relevance_label string").json(path)


@query(sql.survivors("""select id, title, case when ingest_seq % 5 = 0 or ingest_seq % 2 = 0 then 'unknown' else cost_type end as before, cost_type from survivors
  where cost_type = 'free' and (ingest_seq % 5 = 0 or ingest_seq % 2 = 0) order by id limit 20"""))
def snk7_repair_examples(spark, d):
    """SNK7: the first rows by id that newly are free; a top-k report."""
    now = stored(survivors(spark, d), "survivors")
    old = now.filter("ingest_seq % 5 <> 0").select("id", F.when(C("ingest_seq") % 2 == 0, "unknown").otherwise(C("cost_type")).alias("cost_type"))
    return reports.repair_examples(now, old).select("id", "title", "before", "cost_type")


@query(sql.survivors("select start, title, id from survivors"))
def srt1_chronological(spark, d):
    """SRT1: by start and title."""
    return dedupe.chronological(survivors(spark, d, "start", "title", "id"))


@query(sql.survivors(f""", {DETAILED.strip()} select s.ingest_seq, s.title, strftime(s.start, '%Y-%m-%dT%H:%M:%S') as start_text, nullif(concat_ws(', ', s.location_name, s.location_address), '') as location_text,
  s.summary as summary_text, d.published_price as price_text from survivors s join detailed d using (ingest_seq)"""))
def prj1_published_to_raw(spark, d):
    """PRJ1: published rows as raw records."""
    return published_to_raw(survivors(spark, d)).select("ingest_seq", "title", "start_text", "location_text", "summary_text", "price_text")


@query(f"""with {sql.CANDIDATES} select candidate_id, case when k % 2 = 0 then 'Given' else case when contains(url, 'facebook') then 'Facebook' when contains(url, '{urls.AGGREGATOR}') then 'Aggregator.example' when contains(url, 'hub.') then 'Hub.example' else 'Site' || (k % 50) || '.example' end end as source_name,
  url as source_url, case when k % 3 = 0 then 'A Long Extracted Title' else discovered_title end as title, coalesce(case when k % 4 = 0 then '2024-02-03' end, discovered_date_text) as start_text,
  coalesce(case when k % 5 = 0 then 'Hall' end, discovered_location_text) as location_text, case when k % 7 = 0 then '$' || k end as price_text from identified where url is not null""")
def prj2_candidate_records(spark, d):
    """PRJ2: candidate facts as raw records; discovered values where the page has none."""
    c = fx.candidates(spark, d).filter("candidate_original_url is not null").withColumn("k", F.regexp_extract("seed_url", r"(\d+)$", 1).cast("long"))
    given = {
        "title": F.when(C("k") % 3 == 0, "A Long Extracted Title").otherwise("Home"), "start_text": F.when(C("k") % 4 == 0, "2024-02-03"),
        "location_name": F.when(C("k") % 5 == 0, "Hall"), "cost_text": F.when(C("k") % 7 == 0, html("  $", C("k"), " ")),
    }
    facts = F.struct(*[given.get(f, L(None)).cast("string").alias(f) for f in cand.FACTS])
    live = c.withColumns({"facts": facts, "final_url": L(None).cast("string"), "combined": L(0.7), "original_source_name": F.when(C("k") % 2 == 0, "Given")})
    return cand.candidate_records(live).select("candidate_id", "source_name", "source_url", "title", "start_text", "location_text", "price_text")


# ---- lookups


@query(sql.raw("select ingest_seq, keyword from (select ingest_seq, keyword, row_number() over (partition by ingest_seq order by rank) as n from raw_listing join (values (1, 'brary, 101'), (2, 'k community'), (3, 'arm')) h(rank, keyword) on contains(lower(location_text), keyword)) where n = 1"))
def join1_any_size(spark, d):
    """JOIN1: over a thousand hints, found anywhere in a text, as a literal table finds them."""
    some = ["brary, 101", "k community", "arm"]
    hints = [(f"zz {i} zz", ["indoor"], True, None, None) for i in range(500)] + [(w, ["indoor"], True, "C", None) for w in some] + [(f"zz {i} qq", ["farm"], False, None, None) for i in range(600)]
    got = lookup.with_hint(fx.raw_listing(spark, d), ["location_text"], hints, ["keyword", "tags", "rainy", "city", "county"])
    return got.filter("hint is not null").select("ingest_seq", "hint.keyword")


_MANY = 10_000


@query(sql.raw(f"""
, hints as (select i as rank, case i % 4 when 0 then 'family ' || i when 1 then 'item ' || (i // 4) || '.' when 2 then 'ies. item ' || (i // 8) else 'none ' || i end as keyword from range({_MANY}) t(i)),
  exact as (select 'item ' || (i // 4) || '.' as k, min(i) as rank from range({_MANY}) t(i) where i % 4 = 1 group by 1),
  starts as (select 'ies. item ' || (i // 8) as k, min(i) as rank from range({_MANY}) t(i) where i % 4 = 2 group by 1),
  texts as (select ingest_seq, lower(summary_text) as s, regexp_extract(summary_text, '(\\d+)\\.$', 1) as number from raw_listing where summary_text is not null),
  met as (
    select ingest_seq, rank, k from texts join exact on k = 'item ' || number || '.'
    union all
    select ingest_seq, rank, k from (select ingest_seq, number, unnest(range(1, length(number) + 1)) as n from texts) join starts on k = 'ies. item ' || substr(number, 1, n::integer))
  select ingest_seq, min(rank)::integer as rank, arg_min(k, rank) as keyword from met group by ingest_seq"""))
def join1_automaton(spark, d):
    """JOIN1, JOIN6: ten thousand keywords, of which some begin others, end others or lie inside them, in one pass over each text."""
    i = C("id")
    keyword = F.expr("case id % 4 when 0 then concat('family ', id) when 1 then concat('Item ', id div 4, '.') when 2 then concat('ies. item ', id div 8) else concat('none ', id) end")
    hints = spark.range(_MANY).select(i.cast("int").alias("rank"), keyword.alias("keyword"))
    found = lookup.hinted(fx.raw_listing(spark, d), hints, "summary_text")
    return found.select("ingest_seq", "rank", F.lower("keyword").alias("keyword"))


_QUALIFIED = "case " + " ".join(f"when contains(lower(location_name), {sql.q(w)}) then {sql.q(t)}" for w, t in (("main library", "Springfield Campus"), ("library", "Branch"), ("farm", "Aldie, VA"))) + " end"


@query(f"""with {sql.RAW}, {sql._PLACE}, hinted as (select *, location_name || ', ' || {_QUALIFIED} as hinted from place),
scored as (select * from hinted), {sql.ASKED.strip()} select ingest_seq, array_to_string(case when hinted is null or list_contains(queries, hinted) then queries else list_concat([hinted], queries) end, ';') as queries from listed join hinted using (ingest_seq)""")
def join6_geo_hints(spark, d):
    """JOIN6: a venue's qualifier makes the most specific geocoder query."""
    qualifiers = [("main library", "Springfield Campus"), ("library", "Branch"), ("farm", "Aldie, VA")]
    hint = lookup.first_hint(C("location_name"), qualifiers, ["keyword", "qualifier"])["qualifier"]
    asked = regions.queries(C("location_address"), C("location_name"), C("city"), C("county"), hint)
    return places(fx.raw_listing(spark, d)).select("ingest_seq", F.array_join(asked, ";").alias("queries"))


# ---- rules found by scans

_SCANNED = "concat_ws(' ', price_text, summary_text, title, location_text)"


def _scan_sql(kind: str) -> str:
    table, not_before = scans.TABLES[kind]
    met = [f"case when {sql._held('t', some, not_before)} then {sql.q(name)} end" for name, some in table.items()]
    return f"array_to_string(list_filter([{', '.join(met)}], lambda x: x is not null), ',')"


@query(sql.raw(f", texts as (select ingest_seq, {_SCANNED} as t from raw_listing) select ingest_seq, {_scan_sql('tags')} as tags, {_scan_sql('relevance')} as relevance, {_scan_sql('prices')} as prices from texts"))
def tag1_phrase_scan(spark, d):
    """TAG1, SCO2, PRC1: the rules of all three kinds that a listing's whole text meets, each kind in one scan for phrases."""
    t = fx.raw_listing(spark, d).select("ingest_seq", F.expr(_SCANNED).alias("t"))
    return t.select("ingest_seq", *[F.array_join(scans.rules_met(C("t"), kind), ",").alias(kind) for kind in scans.TABLES])


# ---- planted tables for checks and counters

_SOUND = {
    "title": "'A Fine Day'", "start": "timestamp_ntz'2024-01-20 10:00:00'", "source_url": "'https://a.example.org/x'", "registration_url": "string(null)", "image_url": "string(null)",
    "tags": "array('arts')", "family_friendly_score": "0.5D", "summary": "'Fine.'", "age_min": "int(null)", "age_max": "int(null)", "short_note": "'A note.'", "location_name": "'Hall'",
    "source_name": "'The Source'", "rainy_day_friendly": "false", "price_text": "'$5'", "extracted_from": "'curated'", "extraction_confidence": "1.0D",
}
#: code -> what makes a sound row break it
_BROKEN = {
    "EMPTY_TITLE": {"title": "'  '"}, "TITLE_TOO_LONG": {"title": "repeat('long ', 70)"}, "INVALID_START_DATETIME": {"start": "cast(null as timestamp_ntz)"},
    "INVALID_SOURCE_URL": {"source_url": "'ftp://x'", "registration_url": "'https://r.example.org'"}, "INVALID_REGISTRATION_URL": {"registration_url": "'call us'"}, "INVALID_IMAGE_URL": {"image_url": "'none.png'"},
    "DISALLOWED_TAGS": {"tags": "array('arts', 'made_up')"}, "SCORE_OUT_OF_RANGE": {"family_friendly_score": "1.5D"}, "SUMMARY_TOO_LONG": {"summary": "repeat('word ', 101)"},
    "INVALID_AGE_RANGE": {"age_min": "9", "age_max": "5"}, "BANNED_SOURCE_HOST": {"source_url": "'https://banned.example/x'"}, "BANNED_REGISTRATION_HOST": {"registration_url": "'https://banned.example/r'"},
    "NO_ACTIONABLE_URL": {"source_url": "''", "registration_url": "''"}, "INVALID_SHORT_NOTE": {"short_note": "'It rains. Bring boots.'"}, "LOCATION_NAME_HAS_ADDRESS": {"location_name": "'Hall 1234 Elm'"},
    "SUMMARY_HAS_SHORTCODES": {"summary": "'[vc_row] Hello'"}, "MACHINE_SOURCE_NAME": {"source_name": "'Airandspace.Si'"}, "TITLE_MATCHES_VENUE": {"location_name": "'a fine day'"},
    "SHORTENER_SOURCE_URL": {"source_url": "'https://bit.ly/x'"}, "PRICE_TEXT_TOO_LONG": {"price_text": "repeat('price ', 14)"}, "INDOOR_NOT_RAINY_DAY": {"tags": "array('indoor')"},
    "OUTDOOR_RAINY_DAY_FRIENDLY": {"tags": "array('outdoor')", "rainy_day_friendly": "true"}, "LOW_EXTRACTION_CONFIDENCE": {"extracted_from": "'seed_resolved'", "extraction_confidence": "0.5D"},
}


def planted(spark, d) -> DataFrame:
    """Events that break each rule by turns, one kind of row sound and one that repeats an id."""
    n = len(_BROKEN) + 2

    def value(name: str) -> str:
        cases = " ".join(f"when {i} then {broken[name]}" for i, broken in enumerate(_BROKEN.values()) if name in broken)
        return f"case k % {n} {cases} else {_SOUND[name]} end" if cases else _SOUND[name]

    same = f"case when k % {n} = {n - 1} then string(k - 1) else string(k) end as id"
    return fx.orders(spark, d).selectExpr("k", "k as ingest_seq", same, *[f"{value(c)} as {c}" for c in _SOUND])


_CODES = len(_BROKEN) + 2
_TWICE = f"select k from o where k % {_CODES} = {_CODES - 1} and k - 1 in (select k from o)"


@query(f"""with o as (select o_orderkey as k from orders), c as (select case k % {_CODES} {' '.join(f"when {i} then {sql.q(code)}" for i, code in enumerate(_BROKEN))} end as rule from o
  union all select 'NO_ACTIONABLE_URL' from o where false union all select 'INVALID_SOURCE_URL' from o where k % {_CODES} = {list(_BROKEN).index('NO_ACTIONABLE_URL')} union all select 'DUPLICATE_ID' from ({_TWICE}))
  select rule, count(*) as n from c where rule is not null group by 1""")
def dq1_all_codes(spark, d):
    """DQ1: each of the rules broken by rows of its own, and repeated ids."""
    return quality.issues(planted(spark, d), ["banned.example"]).groupBy("rule").agg(F.count("*").alias("n"))


_ERRORS = ["EMPTY_TITLE", "INVALID_START_DATETIME", "INVALID_SOURCE_URL", "DISALLOWED_TAGS", "SCORE_OUT_OF_RANGE", "INVALID_AGE_RANGE", "BANNED_SOURCE_HOST", "NO_ACTIONABLE_URL", "SUMMARY_HAS_SHORTCODES"]
_BAD = ", ".join(str(list(_BROKEN).index(c)) for c in _ERRORS)
_WARN = ", ".join(str(i) for i, c in enumerate(_BROKEN) if c not in _ERRORS)


@query(f"""with o as (select o_orderkey as k from orders), t as (select count(*) as n from ({_TWICE})) select count(*) as total, count(*) filter (k % {_CODES} not in ({_BAD})) as passed, count(*) filter (k % {_CODES} in ({_BAD})) as failed,
  count(*) filter (k % {_CODES} in ({_BAD})) + count(*) filter (k % {_CODES} = {list(_BROKEN).index('NO_ACTIONABLE_URL')}) + any_value(t.n) as errors, count(*) filter (k % {_CODES} in ({_WARN})) as warnings, false as is_clean from o, t""")
def agg9_planted_totals(spark, d):
    """AGG9: totals over rows that break each rule; repeated ids are errors but not failed rows."""
    return quality.totals(planted(spark, d), ["banned.example"])


@query("select 'NO_PRICE' as rule, count(*) as n from (select o_orderkey as k from orders) where k % 3 = 0")
def ext3_added_rule(spark, d):
    """EXT3: a rule appended to the table."""
    own = ("NO_PRICE", "warning", "there is no price", C("price_text").isNull())
    rows = planted(spark, d).withColumn("price_text", F.when(C("k") % 3 != 0, "$5"))
    judged = quality.with_issues(rows, table=[*quality.rule_table([]), own])
    return judged.select(F.inline("issues")).filter("rule = 'NO_PRICE'").groupBy("rule").agg(F.count("*").alias("n"))


_LAT = "case when event_id % 4 = 0 then null else round(38.0 + (event_id % 20) / 10.0, 1) end"
_IN = f"coalesce({_LAT} between 38.3 and 39.6, false)"
_KEPT = f"event_id % 3 <> 0 and {_IN}"


@query(f"""select count(*) as total, count(*) filter (event_id % 3 = 0) as virtual, count(*) filter (event_id % 3 = 0 and event_id % 4 <> 0) as virtual_cleared, count(*) filter ({_KEPT}) as already_geocoded,
  0::bigint as cache_hit, 0::bigint as failed, 0::bigint as no_query, count(*) filter (event_id % 3 <> 0 and not {_IN}) as pending, count(*) filter ({_KEPT}) as with_point, count(*) filter ({_KEPT}) as within_region, count(*) filter ({_KEPT}) as mappable from events""")
def agg7_given_points(spark, d):
    """AGG7 with GEO2: counters over events that come with coordinates in and out of the area, or are virtual."""
    return geo.stats(geo.geocode(small_events(spark, d).withColumn("latitude", F.round("latitude", 1)), fx.cache_table(spark)))


@query(f"""select count(*) as total, count(*) filter (event_id % 5 = 0) as with_address, count(*) filter (event_id % 2 = 0) as with_city, count(*) filter ({_KEPT}) as with_point, count(*) filter ({_KEPT}) as mappable,
  count(*) filter (event_id % 3 = 0) as virtual from events""")
def agg6_given_addresses(spark, d):
    """AGG6: address counters with points, cities and virtual events."""
    k = C("id").cast("long")
    rows = small_events(spark, d).withColumns({
        "latitude": F.round("latitude", 1), "city": F.when(k % 2 == 0, "Reston"), "location_address": F.when(k % 5 == 0, "1 Elm St"), "tags": F.when(k % 3 == 0, F.array(L("virtual"))).otherwise(F.array(L("arts"))),
    })
    return reports.addresses(geo.geocode(rows, fx.cache_table(spark)))


# ---- streams, run to their end


def landed_files(rows: DataFrame, path: str) -> None:
    """Records as JSON files of one array each, by thousands."""
    one = F.to_json(F.struct(*[c for c in rows.columns]))
    array = html("[", F.array_join(F.collect_list(one), ","), "]").alias("value")
    rows.groupBy(F.expr("ingest_seq div 5000").alias("file")).agg(array).write.mode("append").partitionBy("file").text(path)


@query(sql.raw("select ingest_seq, title, source_url from raw_listing"))
def st1_landing_stream(spark, d):
    """ST1: two runs over a growing folder; each record lands once."""
    r, base = fx.raw_listing(spark, d), scratch(spark, "landing")
    for part in ("ingest_seq % 2 = 0", "ingest_seq % 2 = 1"):
        landed_files(r.filter(part), f"{base}/in")
        increments.land(increments.landing_stream(spark, f"{base}/in"), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("ingest_seq", "title", "source_url")


_ARRIVAL = "case ingest_seq % 3 when 2 then 0 when 0 then 1 else 2 end"


@query(sql.raw(f"""
  select source_id, source_url, min(ingest_seq) as ingest_seq, arg_min(ingest_seq, ({_ARRIVAL}) * 1000000000000 + ingest_seq) as first_told,
    case when arg_min(ingest_seq, ({_ARRIVAL}) * 1000000000000 + ingest_seq) > min(ingest_seq) then 1 else 0 end as corrections
  from raw_listing group by source_id, source_url"""))
def st2_first_seen_stream(spark, d):
    """ST2: each source's URL once over three runs of one stream; the smallest ingest_seq of a URL comes after a larger one and corrects it."""
    own, base = first_seen.stateful(spark), scratch(spark, "first-seen")
    rows = fx.raw_listing(spark, d).select("ingest_seq", "source_id", "source_url", L("2024-01-15 00:00:00").cast("timestamp").alias("seen_at"))
    for part in range(3):
        rows.filter(F.expr(_ARRIVAL) == part).write.mode("append").parquet(f"{base}/in")
        told = first_seen.first_by_arrival(own.readStream.schema(rows.schema).parquet(f"{base}/in"), "seen_at")
        increments.land(told, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return first_seen.settled(spark.read.schema(first_seen.OUT).parquet(f"{base}/out"))


def moving_events(spark, d) -> DataFrame:
    """Events of the derived listing, some of which start a week later as one source tells it."""
    later = F.when(F.expr("ingest_seq % 3 = 2 and (ingest_seq div 3) % 5 = 0"), F.expr("interval 7 days")).otherwise(F.expr("interval 0 days"))
    none = [L(None).cast("string").alias(c) for c in ("image_url", "registration_url")]
    return fx.raw_listing(spark, d).select(
        "ingest_seq", F.md5("source_url").alias("id"), "title", (F.col("start_text").cast("timestamp_ntz") + later).alias("start"), L(None).cast("timestamp_ntz").alias("end"),
        F.col("location_text").alias("location_name"), F.col("summary_text").alias("summary"), *none, "source_url", "source_name", F.array(L("arts")).alias("tags"), L(0.0).alias("family_friendly_score"),
    )


class GateClosed(Exception):
    pass


@query(sql.raw("""
, rows as (
    select ingest_seq, md5(source_url) as id, lower(trim(title)) as title, start_text::timestamp + to_days(case when ingest_seq % 3 = 2 and (ingest_seq // 3) % 5 = 0 then 7 else 0 end) as start, coalesce(lower(trim(location_text)), '') as place,
      case when summary_text is not null then 25 else 0 end + case when location_text is not null then 10 else 0 end as q
    from raw_listing),
  ids as (select *, min(ingest_seq) over (partition by id) as group_seq, row_number() over (partition by id order by q desc, ingest_seq) as n from rows),
  prints as (select *, row_number() over (partition by title, start::date, place order by q desc, group_seq) as m from ids where n = 1)
  select id, ingest_seq, strftime(date_trunc('week', start), '%Y-%m-%d') as week_start from prints where m = 1"""))
def st3_weeks_stream(spark, d):
    """ST3, the week: three micro-batches; the second dies before its weeks count and starts over, the third is read twice."""
    base, rows, closed = scratch(spark, "weeks"), moving_events(spark, d), [False, True, False, False, False]

    def gate(_: DataFrame) -> None:
        if closed.pop(0):
            raise GateClosed("the week is not published")

    def run() -> None:
        weeks.publish_weeks(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), f"{base}/weeks", f"{base}/checkpoint", gate=gate).awaitTermination()

    for part in (0, 1, 2):
        rows.filter(F.col("ingest_seq") % 3 == part).write.mode("append").parquet(f"{base}/in")
        try:
            run()
        except StreamingQueryException:
            run()
    # as if the stream had died after the ledger's entry: its checkpoint does not know that the last batch is done
    last = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/checkpoint/commits/2")
    last.getFileSystem(spark._jsc.hadoopConfiguration()).delete(last, False)
    run()
    return weeks.current_weeks(spark, f"{base}/weeks").select("id", "ingest_seq", "week_start")


@query(f"with {sql.CANDIDATES} select candidate_id, case when k % 2 = 1 then status when status = 'rejected' then 'rejected' else 'needs_review' end as status, case when k % 2 = 1 then case when k % 23 = 0 then 'seen' end when k % 23 = 0 then 'seen' else 'new' end as notes from identified where k % 4 <> 2 union all select candidate_id, 'needs_review', 'new' from identified where k % 4 = 2")
def st3_queue_stream(spark, d):
    """ST3: two micro-batches merged into the review queue, the first one twice."""
    c = fx.candidates(spark, d).withColumn("k", F.regexp_extract("seed_url", r"(\d+)$", 1).cast("long"))
    old, base = c.filter("k % 4 <> 2").drop("k"), scratch(spark, "queue")
    new = c.filter("k % 2 = 0").drop("k").withColumns({"status": L("needs_review"), "notes": L("new")})
    for number, (rows, checkpoint) in enumerate([(old, "a"), (old, "b"), (new, "c")]):
        rows.write.parquet(f"{base}/in{number}")
        stream = spark.readStream.schema(schemas.CANDIDATE).parquet(f"{base}/in{number}")
        increments.merge_review_queue(stream, f"{base}/queue", f"{base}/{checkpoint}").awaitTermination()
    return ledger.current(spark, f"{base}/queue").select("candidate_id", "status", "notes")
