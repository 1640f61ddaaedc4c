"""What larger and odder tables brought to light: each test failed before its cause was mended."""

import html
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from kalends.functions import dates, gates, sieve, text
from kalends.functions.store import stored
from kalends.operators import dedupe, notes, pricing, quality, scores, tags
from kalends.plans import delta, listing, oracles, queries
from kalends.plans.queries import ORACLES, QUERIES
from kalends.sources import landing, pages, publish
from kalends.streaming import first_seen
from tests.test_queries import DIR, plain


def duck(path, *names):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for n in names:
        con.execute(f"create view {n} as select * from read_parquet('{path}/{n}.parquet{'/*.parquet' if (path / f'{n}.parquet').is_dir() else ''}')")
    return con


TEXTS = ["des&amp;&amp les&amp", "token = &quot;0b&quot;", "&notit; &notin; &#233;&#xE9 &#128; &#0; &#xD800; &zzz; &; & &#1114112; &#5;", "&nbsp;a&nbsp;&nbsp;b &lt;i&gt", "&#99999999999999999999;", "plain", ""]


@pytest.mark.parametrize("text", TEXTS)
def test_character_references_in_sql(text):
    assert duckdb.connect().execute(f"select {oracles.unescaped('t')} from (select ? as t)", [text]).fetchone()[0] == html.unescape(text)


def test_titles_with_character_references(spark, tmp_path):
    rows = [(i, f"https://p{i}.example.org/", f"<html><head><title>{t}</title></head><body><a href='/x'>x</a></body></html>") for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert plain(QUERIES["htm1_page_facts"](spark, str(tmp_path)).toPandas()) == plain(duck(tmp_path, "pages").execute(ORACLES["htm1_page_facts"]).df())


def test_discovery_where_pages_repeat_urls(spark, tmp_path):
    """A URL with several pages counts once and has its least text, as the query takes it; pages without a URL do not count."""
    (tmp_path / "orders.parquet").symlink_to(f"{DIR}/orders.parquet")
    own = lambda i: f"https://p{i % 40}.example.org/"
    rows = [(i, own(i) if i % 11 else None, f"<html><title>Gathering</title><p>{'Cost: $5' if i % 3 else 'Come'}</p></html>" if i % 13 else None) for i in range(120)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = plain(QUERIES["pipe2_discovery"](spark, str(tmp_path)).toPandas())
    assert got == plain(duck(tmp_path, "orders", "pages").execute(ORACLES["pipe2_discovery"]).df())
    assert {r[1] for r in got} >= {"resolved", "shared_site_link", "no_original_url_found"}


def test_facts_leave_a_task_in_portions(spark):
    """No frame holds facts of more html than the bound, whatever the batch; a longer page is alone and no page is lost."""
    assert [(s.start, s.stop) for s in pages.portions(["aaaa", "bb", None, "c", "dddddddd", "e"], 6)] == [(0, 3), (3, 4), (4, 5), (5, 6)] and not list(pages.portions([]))
    rows = spark.range(0, 60, 1, 1).selectExpr("string(id) as url", "concat('<a href=\"/', id, '\">', repeat('x', 100000), '</a>') as html")
    got = pages.page_facts(rows, want=["anchors"])
    assert got.columns == ["url", "anchors"] and got.selectExpr("url", "anchors[0].href").distinct().count() == 60


def test_first_arrivals_share_buckets(spark, tmp_path, monkeypatch):
    """Keys of one bucket are told and forgotten each for itself, and the bucket is one state."""
    monkeypatch.setattr(first_seen, "BUCKETS", 1)
    own, base, told = first_seen.stateful(spark), f"file://{tmp_path}", []
    batches = [[(5, "u", 1), (7, "v", 1), (9, "w", 3)], [(8, "v", 4), (4, "u", 4)], [(10, "x", 40)], [(3, "x", 41)], [(11, "u", 41), (2, "x", 41)]]
    for rows in batches:
        df = spark.createDataFrame(rows, "ingest_seq long, source_url string, day int")
        df.selectExpr("ingest_seq", "'a' as source_id", "source_url", "timestamp'2024-01-01' + make_dt_interval(day) as at").coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = own.readStream.schema("ingest_seq long, source_id string, source_url string, at timestamp").parquet(f"{base}/in")
        first_seen.first_by_arrival(stream, "at").writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start().awaitTermination()
        now = [tuple(r)[1:] for r in spark.read.schema(first_seen.OUT).parquet(f"{base}/out").collect()]
        told.append(sorted(set(now) - {r for t in told for r in t}, key=str))
    assert told[0] == [("u", 5, "first", None), ("v", 7, "first", None), ("w", 9, "first", None)] and told[1] == [("u", 4, "correction", 5)]
    assert told[2] == [("x", 10, "first", None)] and told[3] == [("x", 3, "correction", 10)]
    assert told[4] == [("u", 11, "first", None), ("x", 2, "correction", 3)]
    states = own.read.format("statestore").option("path", f"{base}/c").option("stateVarName", "rows").load()
    assert states.count() == 1


def test_weeks_are_published_in_portions(spark, tmp_path, monkeypatch):
    """No document holds more events than a portion, none is lost, and parts in order are the week in order."""
    monkeypatch.setattr(publish, "PORTION_BITS", 3)
    rows = spark.range(0, 100).selectExpr("string(id) as id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(int(id * 7 % 14)) as start", "'T' || (id * 31 % 10) as title", "'S' as source_name", "'https://h' || (id % 5) || '.org/x' as source_url")
    got = publish.envelopes(rows, "now").orderBy("week_start", "part").collect()
    assert {(r["week_start"], r["event_count"], r["source_count"]) for r in got} == {("2024-01-01", 50, 5), ("2024-01-08", 50, 5)} and max(len(r["events"]) for r in got) <= 8
    told = [(e["start"], e["title"], e["id"]) for r in got for e in r["events"]]
    assert told == sorted(told) and len({t[2] for t in told}) == 100
    publish.write_envelopes(rows, str(tmp_path / "weeks"), "now")
    files = list((tmp_path / "weeks").glob("week_start=*/*.json"))
    assert len(files) == len(got) and landing.published_week(spark, str(tmp_path / "weeks")).select("week_start", "id").distinct().count() == 100


def examples(alternative):
    """Some texts that an alternative of a rule matches: each choice of its groups, with and without what is optional."""
    found = {alternative}
    while any("(?:" in a for a in found):
        found = {a.replace(m.group(), c + ("@" + m.group(2) if m.group(2) else ""), 1) for a in found for m in [re.search(r"\(\?:([^()]*)\)(\??)", a)] if m for c in [*m.group(1).split("|"), *([""] if m.group(2) else [])]} | {a for a in found if "(?:" not in a}
    plain = lambda a: re.sub(r"\\w[*+]", "x", re.sub(r"\\s[*+]", " ", re.sub(r"\[(.)[^\]]*\]", r"\1", a.replace("@?", ""))))
    texts = {t for a in found for t in (plain(a).replace("?", ""), re.sub(r".\?", "", plain(a)))}
    return [t.replace(".", " ") for t in texts if re.fullmatch(alternative, t.replace(".", " "))]


def test_no_gate_hides_a_rule():
    """Every text that a rule matches has the rule's bit, whatever stands around it; few texts have many bits."""
    import zlib

    from kalends import rules
    from kalends.operators.tags import GATE

    tables = {"": rules.TAGS, "family:": rules.FAMILY_RULES, "activity:": rules.ACTIVITY_RULES, "adult:": rules.ADULT_RULES, "rescue:": rules.RESCUE_RULES, "price:": {"donation": rules.DONATION_PHRASES, "program": rules.PAID_PROGRAM_PHRASES}}
    tried = 0
    for kind, table in tables.items():
        for name, some in table.items():
            for text in (t for a in some for t in examples(a)):
                bits = 0
                for w in re.findall(GATE.pattern, f"so, ({text}) zz {text}-{text}"):
                    bits |= GATE.slots[zlib.crc32(w.encode()) % len(GATE.slots)]
                assert bits >> GATE.bit[kind + name] & 1, (kind, name, text)
                tried += 1
    assert tried > 500
    with pytest.raises(ValueError):
        gates.Gate({"x": [r"(?:very\s+)?good"]})
    assert [gates.trie_pattern([]), re.findall(gates.trie_pattern(["kid", "kids", "a+b"]), "kids a+b kid")] == ["", ["kids", "a+b", "kid"]]


def test_gated_rules_are_the_rules(spark):
    texts = ["Farm animal fair oaks walk-in nature walk", "Career fair for teens, tax help", "Support group for parent", "Baby lap sit ages 3 pre-k", "4-H fair u-pick matinée", "Pay what you can class", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("low", F.lower("t")).withColumn("met", tags.GATE.met(F.col("low")))
    got = df.select(tags.text_tags(F.col("low")).alias("a"), tags.text_tags(F.col("low"), F.col("met")).alias("b"), scores.adult_hits(F.col("low")).alias("c"), scores.adult_hits(F.col("low"), F.col("met")).alias("d")).collect()
    assert all(r["a"] == r["b"] and r["c"] == r["d"] for r in got) and sum(map(len, (r["a"] for r in got))) > 10


def test_no_date_is_parsed_in_the_tasks_of_a_scan(spark):
    """A filter on the start stays above the shuffle that spreads the keys, and what is not read is not derived."""
    plan = QUERIES["agg3_reasons"](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("REPARTITION_BY_NUM")
    assert "gettimestamp" in above and "gettimestamp" not in below and "Filter (" not in below
    assert "short_note" not in above.split("max_by", 1)[1] and "matched_patterns" not in above


def test_tasks_become_more_with_the_rows(spark, monkeypatch):
    """A task holds a bounded number of keys, however few cores there are."""
    few = listing.orders(spark, DIR).rdd.getNumPartitions()
    monkeypatch.setattr(listing, "TASK_ROWS", 20, raising=False)
    keys = listing.orders(spark, DIR)
    assert keys.rdd.getNumPartitions() >= keys.count() / 20 > few


def test_notes_by_columns_are_the_notes(spark):
    """with_short_note() gives what short_note() gives, without lambdas, which are interpreted row by row."""
    texts = [None, "", "Fun for all.", "Two parts. Both long", "Join us", "<p>Songs and</p> crafts", "x" * 130]
    rows = [(s, t, title, cost, price, place, "Vienna" if i % 3 else None, "Fairfax" if i % 2 else " ", low, None if i % 4 else 9)
            for i, (s, t) in enumerate((s, t) for s in texts for t in (None, [], ["swim", "sports", "indoor"], ["toddler", "virtual"], ["all_ages", "outdoor", "storytime"]))
            for title, cost, price, place, low in (("Swim", "paid", "$5 - " + "long " * 12, "Pool " * 50, None), (None, "free", None, "Virtual", 0), ("ice", None, "", None, 3))]
    df = spark.createDataFrame(rows, "summary string, tags array<string>, title string, cost_type string, price_text string, location_name string, city string, county string, age_min int, age_max int")
    c = F.col
    want = notes.short_note(c("summary"), c("tags"), c("title"), c("cost_type"), c("price_text"), c("location_name"), c("city"), c("county"), c("age_min"), c("age_max"))
    both = notes.with_short_note(df.withColumn("want", want))
    assert both.columns == [*df.columns, "want", "short_note"]
    assert both.filter("not (want <=> short_note)").count() == 0 and both.select("want").distinct().count() > 20
    assert "lambda" not in notes.with_short_note(df).select("short_note")._jdf.queryExecution().optimizedPlan().toString()


def test_issues_without_a_filter_over_structs(spark):
    df = stored(queries.events(spark, DIR), "events")
    found = quality.with_issues(df, ["src1.", "x.org"])
    assert "filter(array(" not in found.select("issues")._jdf.queryExecution().optimizedPlan().toString()
    table = quality.rule_table(["src1.", "x.org"])
    plain_form = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(code).alias("rule"), F.lit(severity).alias("severity"), F.lit(message).alias("message"))) for code, severity, message, cond in table]))
    assert found.withColumn("want", plain_form).filter("not (issues <=> want)").count() == 0
    told = spark.createDataFrame([("Fun at St. Mary. Bring Dr. Smith.",), ("One.  Two",), ("One. two",), ("A",), ("",), (None,), ("Dr. Smith",)], "t string")
    assert [r[0] for r in told.select(text.several_sentences(F.col("t"))).collect()] == [True, True, False, False, False, False, False]


def test_survivors_with_some_columns(spark):
    rows = queries.upcoming(spark, DIR).filter("ingest_seq < 300")
    some = dedupe.deduplicate(rows, ["id", "price_text"])
    assert some.columns == ["id", "price_text"] and sorted(map(tuple, some.collect()), key=str) == sorted(map(tuple, dedupe.deduplicate(rows).select("id", "price_text").collect()), key=str)


def test_fenced_values_are_compiled(spark):
    """A generator interprets its own expressions, so it is given a column; a filter still stays above it."""
    plan = QUERIES["agg3_reasons"](spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    inside = [line for line in plan.splitlines() if "Generate explode" in line]
    assert len(inside) >= 3 and not any("gettimestamp" in line or "CASE WHEN" in line for line in inside)


def test_ready_dates_are_read_as_all_others(spark):
    """Texts in the first format skip the steps of other wordings, with the same result: a space before them takes the long way."""
    texts = ["2024-01-05 10:00:00", "2024-02-29 23:59:59", "2025-02-29 10:00:00", "2024-13-01 10:00:00", "2024-01-05 24:00:00", "2023-05-01 10:00:00", "2023-02-29 10:00:00", "0000-01-01 00:00:00", "9999-12-31 00:00:00", "2024-01-05 10:00:00\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(map(str, r)) for r in df.select(dates.parse_datetime(F.col("t"), 2024), dates.parse_datetime(F.concat(F.lit("at "), "t"), 2024)).collect()]
    assert all(a == b for a, b in got) and got[0][0] == "2024-01-05 10:00:00" and got[5][0] == "2024-05-01 10:00:00"
    early = df.select(dates.parse_datetime(F.col("t"), 2024).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert dates.READY in early


def test_gates_of_places_hide_nothing(spark):
    parts = ["12 Elm St", "StReston", "Ave.Vienna", "SW", "NE.Fairfax", "NWOak", "VA", "22150", "VA22150", "22150Burke", "PkwyTown", "mount vernon", "Arlington", ".", " "]
    texts = [a + s + b for a in parts for b in parts for s in ("", " ")]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    plain_form = F.col("t")
    for pattern, by in text.rules.ADDRESS_SPACING:
        plain_form = F.regexp_replace(plain_form, pattern, by)
    assert df.filter(~text.address_spacing(F.col("t")).eqNullSafe(text.squeeze(plain_form))).count() == 0
    assert df.filter(F.col("t").rlike(text.RUN_TOGETHER)).count() > 50
    named = {t: next(((n, w.title()) for n, some in text.rules.COUNTIES.items() for w in some if w in t.lower()), (None, None)) for t in texts}
    assert all(tuple(r["c"]) == named[r["t"]] for r in df.filter("t is not null").select("t", text.county_of(F.col("t")).alias("c")).collect())


def test_no_price_rule_is_tried_twice(spark):
    df = spark.createDataFrame([], "t string, p string, l boolean, q boolean")
    plan = df.select(pricing.reason(*map(F.col, "tplq")).alias("why"))._jdf.queryExecution().analyzed().toString()
    assert plan.count(gates.trie_pattern(pricing.SURE["explicit"])) == 1


def shuffled(spark):
    """Bytes that all stages of the session have written for shuffles."""
    lists = spark._jvm.java.util
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(lists.ArrayList(), False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), lists.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_increments_move_digests_alone(spark, tmp_path):
    """A second run over few changes shuffles digests, not rows: raw rows, segments and best rows stay where they lie."""
    raw = queries.fx.raw_listing(spark, "/root/testdata/sf0.01")
    delta.refresh(raw.filter("ingest_seq % 100 <> 7"), "2024-01-15", f"file://{tmp_path}/d")
    before = shuffled(spark)
    assert delta.refresh(raw, "2024-01-15", f"file://{tmp_path}/d") == {"rows": 15_000, "classified": 150}
    assert 0 < shuffled(spark) - before < 15_000 * 120


def test_a_row_moves_once_at_most_to_be_classified(spark, tmp_path):
    """A first run over rows of which some are repeated: each is classified once, and rejects are met but not kept."""
    raw = queries.fx.raw_listing(spark, DIR).filter("ingest_seq < 300")
    some = raw.filter("ingest_seq < 20").withColumn("title", F.when(F.col("ingest_seq") > 3, F.col("title")))
    rows, path = raw.filter("ingest_seq >= 20").unionByName(some).unionByName(some).unionByName(some), f"file://{tmp_path}/d"
    assert delta.refresh(rows, "2024-01-15", path) == {"rows": 300, "classified": 300}
    assert delta.refresh(raw.filter("ingest_seq >= 20").unionByName(some), "2024-01-15", path) == {"rows": 300, "classified": 0}
    assert spark.read.parquet(f"{path}/data/*/rows").count() == 296


def test_increments_with_some_columns(spark, tmp_path):
    """The state holds what the caller reads, the survivors are the same, and other columns start over."""
    raw, path = queries.fx.raw_listing(spark, DIR).filter("ingest_seq < 300"), f"file://{tmp_path}/d"
    for n in (200, 300):
        delta.refresh(raw.filter(f"ingest_seq < {n}"), "2024-01-15", path, columns=["price_text"])
    some = delta.survivors(spark, path, "2024-01-15")
    assert set(some.columns) == {*delta.READ, "price_text"}
    want = dedupe.deduplicate(queries.upcoming(spark, DIR).filter("ingest_seq < 300"), some.columns)
    assert sorted(map(tuple, some.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert delta.refresh(raw, "2024-01-15", path, columns=["tags"])["classified"] == 300


def test_no_digest_is_derived_twice(spark):
    rows = delta.keyed(queries.fx.raw_listing(spark, DIR))
    plan = sieve.among(rows, rows.select("digest").limit(3), "digest")._jdf.queryExecution().executedPlan().toString()
    assert not any("sha2" in line for line in plan.splitlines() if "Filter" in line)


def test_digests_tell_rows_apart(spark):
    rows = [("1:a", None, ["x", None]), ("1", "a", ["x"]), (None, "1:a", []), ("-", None, None), (None, "-", None), (None, None, None), ("", None, None), (None, "", None), ("é", "a", ["null"]), ("a", "b", ["x,y"]), ("a", "b", ["x", "y"])]
    df = delta.keyed(spark.createDataFrame(rows + rows, "title string, city string, extra_tags array<string>"))
    assert df.select("digest").distinct().count() == len(rows) and {len(r["digest"]) for r in df.collect()} == {16}


@pytest.mark.parametrize("bits", [15, 26])
def test_sieves_are_joins(spark, monkeypatch, bits):
    """Whatever the keys: none, null, repeated, and more than a bitmap of that size tells apart."""
    monkeypatch.setattr(sieve, "BITS", bits)
    df = spark.range(0, 40_000, 1, 3).selectExpr("if(id % 5000 = 3, null, string(id div 2)) as k", "id")
    told = lambda rows: sorted(r["id"] for r in rows.collect())
    for keys in ("id < 0", "id % 1000 < 3", "id % 3 > 0"):
        some = df.filter(keys).select("k")
        among, without = told(sieve.among(df, some, "k")), told(sieve.without(df, some, "k"))
        assert among == told(df.join(some, "k", "left_semi")) and without == told(df.join(some, "k", "left_anti"))
        assert len(among) + len(without) == 40_000
    passed = sieve.sifted(df, df.filter("id % 1000 < 3").select("k"), "k")[0].count()
    assert passed < 40_000 / (10 if bits == 26 else 5)
