"""Invariants and edge cases of the listing operators."""

import json

import pytest
from pyspark.sql import functions as F

from kalends import schemas
from kalends.functions.text import location
from kalends.operators import candidates, dedupe, filters, geo, pricing, quality, schedule, tags
from kalends.plans import listing
from kalends.sources import landing, pages, publish, registry
from kalends.streaming import increments


def priced(spark, rows):
    df = spark.createDataFrame(rows, "price_text string, summary string, title string, source_name string, location_name string")
    return [r["pricing"] for r in pricing.with_pricing(df).collect()]


def test_price_ladder(spark):
    got = priced(spark, [
        ("$0", None, "x", None, None), (None, None, None, "City Public Library", None), (None, None, None, None, None), ("Members free, non-members $10", None, "x", None, None), ("Suggested donation $5", None, "x", None, None),
        ("Registration fee: $15", None, "x", None, None), ("$12", None, "x", None, None), ("Free admission", None, "x", None, None), ("Free admission, fee applies", None, "x", None, None), (None, "no fee today", "x", None, None),
        (None, None, "Pottery Workshop", "County Park Authority", None), (None, None, "Story", None, "Oak Library"), (None, None, "free fun", None, None), (None, None, "fun", None, None), (None, "tickets at the door", "fun", "City Library", None),
    ])
    assert [g["reason"] for g in got] == ["zero_cost_value", "library_default_free_no_context", "no_context", "mixed_pricing", "donation_language", "strong_paid_signal", "dollar_amount", "explicit_free_text", "conflicting_free_and_paid", "explicit_free_text", "paid_program_format_no_price", "library_default_free", "free_word_only", "unknown_no_signals", "weak_paid_signal"]
    assert got[5]["registration_fee_text"] == "Registration fee: $15 x" and got[5]["registration_required"] and got[0]["price_text"] == "Free" and got[13]["is_free"] is None


def test_tag_exceptions(spark):
    df = spark.createDataFrame([("Nature Walk",), ("Walk-ins welcome",), ("Fair Oaks Mall",), ("County Fair",), ("Food drive",), ("Register online",), ("Online class",), (None,)], "t string")
    none = F.lit(None).cast("string")
    got = [set(r["x"]) for r in df.select(tags.derive_tags(F.col("t"), none, none, none.cast("timestamp_ntz"), none).alias("x")).collect()]
    assert "hiking" in got[0] and "hiking" not in got[1] and "festival" not in got[2] and {"festival", "fair"} <= got[3] and not got[4] and "virtual" not in got[5] and "virtual" in got[6] and not got[7]


def test_pass_two_ties_follow_the_group(spark):
    """A group's first arrival decides ties between fingerprints, not the winner's own arrival."""
    rows = [(0, "a", None), (1, "b", "text of b"), (2, "a", "text of a")]
    df = spark.createDataFrame([(s, i, "T", "2024-01-01 10:00:00", "L", m) for s, i, m in rows], "ingest_seq long, id string, title string, s string, location_name string, summary string")
    df = df.selectExpr("*", "cast(s as timestamp_ntz) as start", "cast(null as timestamp_ntz) as end", "cast(null as string) as image_url", "cast(null as string) as registration_url", "array('x') as tags", "0.5D as family_friendly_score").drop("s")
    assert [(r["id"], r["ingest_seq"]) for r in dedupe.deduplicate(df).collect()] == [("a", 2)]
    assert dedupe.deduplicate(df.limit(0)).count() == 0


def test_retention(spark):
    weeks = spark.createDataFrame([("2024-01-01",), ("2024-01-08",), ("2024-01-15",), ("2024-01-15",), (None,)], "week string")
    kept = lambda n, p: sorted(r["week"] for r in dedupe.retained_weeks(weeks, n, p).filter("kept").collect())
    assert kept(2, None) == ["2024-01-08", "2024-01-15"] and kept(2, "2023-01-02") == ["2023-01-02", "2024-01-15"] and kept(0, None) == ["2024-01-01", "2024-01-08", "2024-01-15"]


def test_relevance_guard(spark):
    df = spark.createDataFrame([(i, 0.1 if i < 6 else 0.9) for i in range(10)], "id int, family_relevance_score double")
    kept, gone = filters.relevance_split(df)
    assert (kept.count(), gone.count()) == (10, 0)
    kept, gone = filters.relevance_split(df.filter("id >= 2"))
    assert (kept.count(), gone.count()) == (4, 4)


def test_malformed_schedules(spark):
    run = {"start_date": "2024-01-01", "end_date": "2024-01-03", "start_time": "10:00", "end_time": None, "days_of_week": None}
    day = {"date": "2024-01-01", "start_time": None, "end_time": None, "note": "n"}
    base = {"slug": "s", "title": "T", "source_url": "u"}
    entries = [base | {"run": run}, base | {"dates": [day]}, base | {"run": run, "dates": [day]}, base, base | {"run": run | {"end_date": "2023-01-01"}}, base | {"run": run | {"days_of_week": ["Funday"]}}, base | {"run": run, "title": " "}, base | {"run": run | {"start_time": "noonish"}}, base | {"run": run, "enabled": False}]
    df = spark.read.schema(schemas.CURATED).json(spark.sparkContext.parallelize([json.dumps(e) for e in entries]))
    good, bad = schedule.checked(df)
    assert sorted(r["code"] for r in bad.collect()) == ["bad_time", "both_forms", "missing_title", "no_form", "reversed_run", "unknown_weekday"]
    assert sorted((str(r["day"]), r["all_day"]) for r in schedule.occurrences(good).collect()) == [("2024-01-01", False), ("2024-01-01", True), ("2024-01-02", False), ("2024-01-03", False)]
    with pytest.raises(Exception, match="malformed schedule"):
        schedule.strict(df).collect()


def test_geocode_resolution_waits_for_unknown_queries(spark):
    cache = listing.cache_table(spark)
    asked = spark.createDataFrame([(1, ["nowhere known", "Oak Community Center"]), (2, ["City Museum", "Oak Community Center"]), (3, ["Riverside Park"]), (4, [])], "id int, queries array<string>")
    got = {r["id"]: r for r in geo.resolve(asked, cache).collect()}
    assert [got[i]["status"] for i in (1, 2, 3, 4)] == ["pending", "hit", "failed", "no_query"] and got[1]["pending"] == ["nowhere known"]
    assert {r["id"]: r["status"] for r in geo.resolve(asked, cache, accept_lower=True).collect()}[1] == "hit"
    merged = geo.merge_cache(cache, cache.filter("query = 'City Museum'").selectExpr("query", "38.9D latitude", "-77.0D longitude", "0.9D confidence", "timestamp'2025-01-01' resolved_at"))
    assert merged.count() == cache.count() and merged.filter("query = 'City Museum' and latitude = 38.9").count() == 1


def test_queue_keeps_human_decisions(spark):
    fields = [f.split()[0] for f in schemas.CANDIDATE.split(", ")]
    row = lambda **k: tuple(k.get(f) for f in fields)
    old = spark.createDataFrame([row(candidate_id="a", status="rejected", notes="no", confidence=0.2), row(candidate_id="b", status="discovered", confidence=0.2)], schemas.CANDIDATE)
    new = spark.createDataFrame([row(candidate_id="a", status="needs_review", notes="x", confidence=0.9), row(candidate_id="b", status="needs_review", notes="x", confidence=0.9), row(candidate_id="c", status="discovered")], schemas.CANDIDATE)
    for policy in ("full", "light"):
        got = {r["candidate_id"]: r for r in candidates.merge_queue(old, new, policy).collect()}
        assert (got["a"]["status"], got["a"]["notes"], got["a"]["confidence"]) == ("rejected", "no", 0.9) and got["b"]["status"] == "needs_review" and len(got) == 3


def test_pages(spark):
    html = '<html><head><title>T</title><meta property="og:title" content="OG"><script type="application/ld+json">{"@type":"Event","name":"N","offers":[{"price":"5"}]}</script></head><body><div class="event-price">Fee: $7</div><p>Text<a href="/x">Register</a><style>no</style></body>'
    df = spark.createDataFrame([("https://a.org/1", html), ("https://a.org/2", None), ("https://a.org/3", "<div <p>>broken</")], "url string, html string")
    got = {r["url"][-1]: r for r in pages.fetched(df).collect()}
    assert got["1"]["facts"]["title"] == "N" and got["1"]["facts"]["cost_text"] == "5" and got["1"]["json_ld"] and got["2"]["facts"]["title"] is None
    records = spark.createDataFrame([(1, "s", "https://a.org/1", None), (2, "s", "https://a.org/2", "$3")], "ingest_seq long, source_id string, source_url string, price_text string")
    assert {r["ingest_seq"]: r["price_text"] for r in pages.with_detail_price(records, df).collect()} == {1: "Fee: $7", 2: "$3"}


def test_landing_publish_and_streams(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "one.json").write_text(json.dumps([{"ingest_seq": 1, "source_id": "s", "source_url": "u", "title": "A", "unknown": 1}, {"ingest_seq": 2, "source_id": "s", "source_url": "u", "title": "B"}]))
    assert landing.raw_records(spark, str(raw)).count() == 2
    for _ in range(2):  # a second run finds nothing new
        increments.land(increments.landing_stream(spark, str(raw)), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    assert dedupe.first_seen(landing.raw_records(spark, str(raw))).count() == 1
    weeks = spark.createDataFrame([("a", "2024-01-01 00:00:00", "h")], "id string, s string, source_url string").selectExpr("id", "cast(s as timestamp_ntz) as start", "'T' as title", "'https://h/x' as source_url", "'n' as source_name")
    publish.write_week(weeks, str(tmp_path / "weeks"), "2024-01-01")
    publish.write_week(weeks, str(tmp_path / "weeks"), "2024-01-08")
    publish.write_week(weeks, str(tmp_path / "weeks"), "2024-01-08")
    assert spark.read.parquet(str(tmp_path / "weeks")).count() == 2 and publish.week_table(spark, str(tmp_path / "weeks")).count() == 2
    one = publish.envelope(weeks, "2024-01-01", "now").first()
    assert (one["event_count"], one["source_count"], one["events"][0]["start"]) == (1, 1, "2024-01-01T00:00:00")


def test_documents_of_either_form(spark):
    df = spark.createDataFrame([('[{"id":"a"},{"id":"b"}]',), ('{"events":[{"id":"c"}]}',), ("nonsense",), (None,)], "value string")
    assert sorted(r["id"] for r in landing.any_events(df).selectExpr("try_variant_get(event, '$.id', 'string') id").collect()) == ["a", "b", "c"]


def test_registry_and_rejects(spark):
    registry.listing_source("lib", "Lib", "library_widget")
    page = spark.createDataFrame([("https://a.org/l", '<div class="event-card"><h3><a href="/e/1">One</a></h3></div>')], "url string, html string")
    assert [(r["title"], r["source_url"]) for r in registry.SOURCES["lib"](page).collect()] == [("One", "https://a.org/e/1")]
    with pytest.raises(KeyError):
        registry.listing_source("x", "X", "no_layout")
    assert quality.rule_table([])[0][0] == "EMPTY_TITLE"
    assert spark.range(1).select(location(F.lit(None).cast("string")).alias("l")).first()["l"]["location_name"] is None


def test_a_crash_between_writes_leaves_the_table_in_force(spark, tmp_path):
    """A version without its commit marker is no version; the next write starts it over; old versions go."""
    from kalends.sources import publish

    path = str(tmp_path / "queue")
    frame = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    ids = lambda: sorted(r["id"] for r in publish.current_table(spark, path).collect())
    assert publish.current_table(spark, path) is None
    publish.replace_table(frame(1), path)
    publish.replace_table(publish.current_table(spark, path).unionByName(frame(2)), path)
    assert ids() == [1, 2]
    broken = tmp_path / "queue" / "v0000000003"
    frame(9).write.parquet(str(broken))
    (broken / "_SUCCESS").unlink()  # the writer died before its commit
    assert ids() == [1, 2]
    bad = frame(3).selectExpr("if(id > 0, raise_error('lost'), id) as id")
    with pytest.raises(Exception, match="lost"):
        publish.replace_table(bad, path)
    assert ids() == [1, 2]
    publish.replace_table(publish.current_table(spark, path).unionByName(frame(3)), path)
    assert ids() == [1, 2, 3] and len(list((tmp_path / "queue").glob("v*"))) == 2


def test_hints_of_any_size_agree(spark):
    """The joined form finds what a literal table finds: inside words, short keywords, ties by order, several texts, nulls."""
    from kalends.operators import lookup

    hints = [("ark", ["a"], True, None), ("x", ["b"], False, "Xville"), ("park hall", ["c"], None, "P"), ("é b", ["d"], True, None)]
    rows = [(1, "City Park Hall", None), (2, None, "Box"), (3, "nothing", "none"), (4, "Café Bar", "ark"), (5, "", "X"), (6, "Park Hall", "x"), (6, "Park Hall", "x")]
    df = spark.createDataFrame(rows, "ingest_seq long, place string, title string")
    keys = ["keyword", "tags", "rainy", "city"]
    small = lookup.with_hint(df, ["place", "title"], hints, keys)
    filler = [(f"zz{i}zz", ["z"], True, None) for i in range(lookup.LITERAL_RULES)]
    large = lookup.with_hint(df, ["place", "title"], hints + filler, keys)
    plain = lambda d: sorted((r["ingest_seq"], r["hint"] and r["hint"]["keyword"], r["hint"] and r["hint"]["city"]) for r in d.collect())
    assert plain(small) == plain(large) and [k for _, k, _ in plain(small)] == ["ark", "x", None, "é b", "x", "ark", "ark"]


def test_chronological_order(spark):
    from kalends.operators import dedupe

    rows = [("2024-01-02 10:00:00", "b"), ("2024-01-01 10:00:00", "z"), ("2024-01-02 10:00:00", "B"), ("2024-01-02 10:00:00", "a")]
    df = spark.createDataFrame(rows, "start string, title string").selectExpr("cast(start as timestamp_ntz) as start", "title").repartition(3)
    assert [r["title"] for r in dedupe.chronological(df).collect()] == ["z", "B", "a", "b"]


def test_a_dry_run_publishes_nothing(spark, tmp_path):
    """SNK9: a build writes no week; an error stops the writer."""
    from kalends.plans import jobs
    from kalends.plans import listing as fx

    raw = fx.raw_listing(spark, "/root/testdata/sf0.001").limit(60)
    build = jobs.daily(raw, fx.AS_OF)
    assert build.events.count() > 0 and not (tmp_path / "weeks").exists()
    assert not jobs.publish(build, str(tmp_path / "weeks"), fx.WEEK, ["example.org"]) and not (tmp_path / "weeks").exists()
    assert jobs.publish(build, str(tmp_path / "weeks"), fx.WEEK) and (tmp_path / "weeks").exists()


def test_layouts_in_sql(spark):
    """The table function gives the cards that the DataFrame form gives, and refuses unknown layouts when a query is analysed."""
    from pyspark.errors import AnalysisException

    from kalends.sources import layouts, pages

    card = '<div class="card"><h3 class="card-title">%s</h3><span class="date">Mon, Jan 1, 9AM</span><a href="/e/%d">More</a></div>'
    rows = [("https://a.org/1", card % ("One", 1) + card % ("", 2) + card % ("Three & <i>more</i>", 3)), ("https://a.org/2", None), ("https://a.org/3", "<p>none"), ("https://a.org/1", card % ("One", 1))]
    web = spark.createDataFrame(rows, "url string, html string")
    layouts.register(spark)
    got = spark.sql("select p.url as page_url, c.* from {web} p, lateral layout_cards(html, 'park_cards') c", web=web)
    assert got.columns == ["page_url", "position", "title", "time", "place", "summary", "price", "href", "image"]
    plain = lambda df: sorted(map(str, df.collect()))
    assert plain(pages.records(got, "s", "S")) == plain(pages.cards(web, "park_cards", "s", "S")) and pages.records(got, "s", "S").count() == 3
    assert sorted(r["position"] for r in got.collect()) == [0, 0, 1, 2]
    for call in ("layout_cards(html, 'unknown')", "layout_cards(html, url)", "layout_cards(1, 'park_cards')"):
        try:
            spark.sql("select c.* from {web} p, lateral " + call + " c", web=web)
            raise AssertionError(call)
        except AnalysisException as error:
            assert "layout_cards" in str(error)
