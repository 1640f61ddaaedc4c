"""Registered queries against DuckDB on the smallest tables."""

import glob
import hashlib
import os

import duckdb
import pandas as pd
import pytest

from kalends.plans import growing, inventory, queries
from kalends.plans.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"
QUICK = ["src1_raw_listing", "str1_str2_titles", "str3_summaries", "str9_locations", "str12_str14_prices", "url3_url6_outbound", "dt1_dt2_dates", "dt1_spelled_dates", "dt6_listing_times", "ded4_survivors", "ded5_first_seen", "ret1_retention", "snk2_manifest", "set4_mirror_plan", "join1_venue_hints", "exp1_occurrences", "flt10_malformed", "agg13_horizon", "geo7_purge", "agg10_shared_links", "snk4_merge_queue", "snk5_merge_light", "htm1_page_facts", "jsn1_json_ld", "src2_api_events", "src3_listing_cards", "snk1_envelope", "src12_any_documents", "src9_seed_candidates", "cand2_chosen_urls", "pipe2_discovery", "pipe3_repair", "pipe4_geo_patch", "agg14_removed", "ded6_repeated_ids"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


def plain(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        if isinstance(v, bool) or type(v).__name__ == "bool":
            return str(bool(v))
        try:
            return round(float(v), 6)
        except (TypeError, ValueError):
            return str(v).removesuffix(" 00:00:00")

    return sorted((tuple(one(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False)), key=str)


MORE = [n for n, q in QUERIES.items() if q.__module__ in (inventory.__name__, growing.__name__)]


@pytest.mark.parametrize("name", QUICK + MORE)
def test_against_sql(spark, duck, name):
    assert plain(QUERIES[name](spark, DIR).toPandas()) == plain(duck.execute(ORACLES[name]).df())


def test_discovery_meets_every_page(spark, tmp_path, monkeypatch):
    """Each link's page is the one that its hash points to among all pages, numbered by hash part and URL."""
    own = [f"https://p{i}.example.org/" for i in range(200)]
    (tmp_path / "orders.parquet").symlink_to(f"{DIR}/orders.parquet")
    spark.createDataFrame([(i, u, f"<html><title>Gathering number {i}</title></html>") for i, u in enumerate(own)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    met, discover = [], queries.jobs.discover
    monkeypatch.setattr(queries.jobs, "discover", lambda c, fetched, *a: (met.append(fetched), discover(c, fetched, *a))[1])
    assert QUERIES["pipe2_discovery"](spark, str(tmp_path)).count() > 0
    hashed = lambda u: int(hashlib.md5(u.encode()).hexdigest()[:8], 16)
    order = sorted(range(200), key=lambda i: (hashed(own[i]) % 4096, own[i]))
    links = {r[0] for r in queries.fx.candidates(spark, str(tmp_path)).select("candidate_original_url").distinct().collect()} - {None}
    got = {r["url"]: r["title"] for r in met[0].select("url", "facts.title").collect()}
    assert got == {u: f"Gathering number {order[hashed(u) % 200]}" for u in links if hashed(u) % 10 != 3} and len(set(got.values())) > 150


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
