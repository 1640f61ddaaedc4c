"""Registered queries of what grows: a data source, counters while writing, increments, links in a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from kalends.functions.store import scratch
from kalends.plans import counted, delta
from kalends.plans import listing as fx
from kalends.plans import oracles as sql
from kalends.plans.queries import query
from kalends.sources import records
from kalends.streaming import increments, shared_links

L = F.lit


def landed_documents(rows):
    """Listings in groups of ten as an array or an envelope by turns, with broken texts beside them."""
    one = rows.groupBy(F.expr("ingest_seq div 10").alias("g")).agg(F.to_json(F.collect_list(F.struct("ingest_seq", "title"))).alias("a"))
    either = F.when(F.col("g") % 2 == 0, F.col("a")).otherwise(F.concat(L('{"week_start":"x","events":'), F.col("a"), L("}")))
    return one.select(either.alias("value")).unionByName(rows.filter("ingest_seq % 10 = 9").select(L("{broken").alias("value")))


@query(sql.raw("""
, told as (select ingest_seq, title, ingest_seq % 10 = 9 as ends from raw_listing), ways as (select unnest(['batch', 'stream']) as via)
  select via, ingest_seq, title, null as bad from told, ways union all select via, null, null, '{broken' from told, ways where ends"""))
def src12_event_records(spark, d):
    """SRC1, SRC12 as a data source: all documents by spark.read, and by two runs of a stream, the second over new files alone."""
    records.register(spark)
    rows, base = fx.raw_listing(spark, d), scratch(spark, "records")
    for part in (0, 1):
        landed_documents(rows.filter(F.expr("(ingest_seq div 10) % 2") == part)).write.mode("append").text(f"{base}/in")
        stream = spark.readStream.format("event_records").option("log", f"{base}/log").load(f"{base}/in")
        increments.land(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    ways = {"batch": spark.read.format("event_records").option("splitBytes", 1 << 20).load(f"{base}/in"), "stream": spark.read.schema(records.SCHEMA).parquet(f"{base}/out")}
    of = lambda via: ways[via].select(L(via).alias("via"), F.get_json_object("event", "$.ingest_seq").cast("long").alias("ingest_seq"), F.get_json_object("event", "$.title").alias("title"), "bad")
    return of("batch").unionByName(of("stream"))


_KEPT = """count(*)::bigint as kept, count(*) filter (cost_type = 'free') as free, count(*) filter (cost_type = 'paid') as paid, count(*) filter (cost_type = 'suggested_donation') as donation, count(*) filter (cost_type = 'unknown') as unknown,
  count(*) filter (list_contains(tags, 'outdoor') and not list_contains(tags, 'indoor') and rainy) as warnings"""
_COUNTERS = ["before_dedupe", "donation", "errors", "excluded", "free", "kept", "other_week", "paid", "past", "rejected", "rows", "survivors", "unknown", "warnings"]


@query(sql.survivors(f"""
, low as (select *, coalesce(family_relevance_score < 0.30, false) as low from survivors),
  cut as (select count(*) filter (low) as n, count(*) filter (low) <= 0.5 * count(*) as drops from low),
  kept as (select low.* from low, cut where not (low and drops)),
  counts as (select {_KEPT}, (select count(*) from scored) as rows, 0::bigint as rejected, (select count(*) from scored) - (select count(*) from up) as past, 0::bigint as other_week, (select count(*) from up) as before_dedupe,
    (select count(*) from survivors) as survivors, (select case when drops then n else 0 end from cut) as excluded from kept),
  runs as (select * from (values ('closed', (select count(*) from kept where contains(source_url, 'src1.'))), ('dry', 0), ('open', 0)) r(run, errors))
  select run, case when run = 'open' or (run = 'closed' and errors = 0) then kept else 0 end as published, {', '.join(c if c == 'errors' else f'counts.{c} as {c}' for c in _COUNTERS)} from runs, counts"""))
def snk9_counted_publish(spark, d):
    """SNK9, AGG9, AGG14: a dry run, a run whose gate stays closed while a source is banned, and one that publishes; counters and rows in force after each."""
    classified, base, out = counted.classify(fx.raw_listing(spark, d), fx.AS_OF), scratch(spark, "counted"), None
    for name, path, banned in [("dry", None, []), ("closed", f"{base}/closed", ["src1."]), ("open", f"{base}/open", [])]:
        told = counted.finish(classified, path=path, banned_hosts=banned, family_only=True)
        there = counted.published(spark, path) if path else None
        held = spark.range(1).select(L(0).cast("long").alias("published")) if there is None else there.agg(F.count("*").alias("published"))
        row = held.select(L(name).alias("run"), "published", *[L(told.counts[c]).cast("long").alias(c) for c in _COUNTERS])
        out = row if out is None else out.unionByName(row)
    return out


_DELTA = "ingest_seq % 100 = 7"


@query(sql.survivors(f"""select id, ingest_seq, title, start, cost_type, (select count(*) from raw_listing where {_DELTA}) as classified, (select count(*) from raw_listing) as row_count from survivors"""))
def ded4_incremental(spark, d):
    """DED4, PIPE3 by increments: a first run over other titles for one row in a hundred, and rows that go; the second classifies only what changed."""
    raw, path = fx.raw_listing(spark, d), scratch(spark, "delta")
    gone = raw.filter("ingest_seq % 100 = 50").withColumn("ingest_seq", -F.col("ingest_seq")).withColumn("title", F.concat("title", L(" and more")))
    columns = ["id", "ingest_seq", "title", "start", "cost_type"]
    delta.refresh(raw.withColumn("title", F.when(F.expr(_DELTA), "Another Storytime").otherwise(F.col("title"))).unionByName(gone), fx.AS_OF, path, columns=columns)
    told = delta.refresh(raw, fx.AS_OF, path, columns=columns)
    return delta.survivors(spark, path, fx.AS_OF).select(*columns, L(told["classified"]).cast("long").alias("classified"), L(told["rows"]).cast("long").alias("row_count"))


@query(f"with {sql.CANDIDATES}, n as (select count(*) as n from cand) select url, count(*) as hits from cand, n where url is not null group by url, n having count(*) >= greatest(20, ceil(0.15::double * n))")
def agg10_links_stream(spark, d):
    """AGG10 in a stream: four batches; the shared links are rare in the first ones and come in the last."""
    c, base = fx.candidates(spark, d), scratch(spark, "links")
    k = F.regexp_extract("seed_url", r"(\d+)$", 1).cast("long")
    hub = F.expr("coalesce(candidate_original_url = 'https://hub.example.com/all', false)")
    part = F.when(hub & (k % 5 > 0), 3).otherwise(k % 4)
    rows = c.select("candidate_original_url", part.alias("part"))
    for n in range(4):
        rows.filter(F.col("part") == n).drop("part").write.mode("append").parquet(f"{base}/in")
        shared_links.keep_links(spark.readStream.schema("candidate_original_url string").parquet(f"{base}/in"), f"{base}/links", f"{base}/checkpoint").awaitTermination()
    return shared_links.shared_links(spark, f"{base}/links")
