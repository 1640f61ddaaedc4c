"""A deterministic listing derived from the orders table: three arrivals of each event, one of them from another source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kalends.functions.fence import fenced

# Vocabularies of the derived listing.
TITLES = ["Saturday Storytime", "County Fair Day", "Pottery Workshop", "Nature Walk", "Free Tax Help", "Movie Night", "Lego Club", "Job Fair", "Holiday Lights", "Toddler Music", "Board Meeting", "Virtual Coding Class", "Farm Harvest Day", "Swim Lesson", "Family Night", "Book Sale"]
PRICES = ["Free", "$12 per child", "Suggested donation $5", "Members free, non-members $10", "Registration fee: $15", "", "Ticketed", "No charge", "$0", "Free admission, tickets required", "Materials fee applies", "Pay what you can"]
PLACES = ["Main Library, 101 Elm Street, Springfield, VA 22150", "Oak Community Center", "Virtual", "Riverside Park", "Arts Studio, 20 Main St, Ashburn, VA 20147", "City Museum", "Hillside Farm", ""]
SOURCES = ["Central Public Library", "County Park Authority", "Arts Studio"]
#: Ordered venue hints: keyword, tags, rainy, city, county.
HINTS = [("main library", ["indoor"], True, "Springfield", "Fairfax"), ("farm", ["outdoor", "farm"], False, "Aldie", "Loudoun"), ("library", ["indoor", "storytime"], True, None, None), ("park", ["outdoor"], False, "Oakton", "Fairfax")]
#: A geocode cache: query, latitude, longitude, confidence, resolved_at; null coordinates are known misses.
CACHE = [
    ("101 Elm Street, Springfield, VA 22150, Springfield", None, None, None, "2024-01-01 00:00:00"),
    ("101 Elm Street, Springfield, VA 22150", 38.78, -77.18, 0.9, "2024-01-01 00:00:00"),
    ("20 Main St, Ashburn, VA 20147, Ashburn", 39.04, -77.48, 0.9, "2024-01-02 00:00:00"),
    ("Oak Community Center", 38.9, -77.3, 0.5, "2024-01-03 00:00:00"),
    ("Riverside Park", 45.5, -122.6, 0.5, "2024-01-03 00:00:00"),
    ("City Museum", None, None, None, "2024-01-04 00:00:00"),
]
AS_OF = "2024-01-15"
WEEK = "2024-01-15"
TASK_ROWS = 200_000


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys alone, spread over the cluster: a file's splits say little, for one without a row group's middle is empty.

    Tasks become more with the rows, not longer: a number that hangs on the cluster alone gave each its share of any table.
    The fence keeps predicates on what is derived of them above the shuffle; pushed below it, they ran in the scan's few tasks.
    """
    keys = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").cast("long").alias("k"))
    tasks = max(2 * spark.sparkContext.defaultParallelism, keys.rdd.getNumPartitions(), -(-keys.count() // TASK_ROWS))  # counted from footers
    keys = keys.repartition(tasks, "k")
    return fenced(keys, "k", F.col("k")).withColumns({"g": F.expr("k div 3"), "v": F.expr("k % 3")})


def pick(words: list[str], index: str):
    return F.element_at(F.array(*map(F.lit, words)), (F.expr(f"int(({index}) % {len(words)})") + 1))


def raw_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw record per order."""
    o = orders(spark, sf_dir)
    return o.select(
        F.col("k").alias("ingest_seq"), F.concat(F.lit("src"), F.expr("case when v = 1 then '1' else '0' end")).alias("source_id"),
        pick(SOURCES, "g + case when v = 1 then 1 else 0 end").alias("source_name"),
        F.concat(F.lit("https://src"), F.expr("case when v = 1 then '1' else '0' end"), F.lit(".example.org/e/"), F.col("g").cast("string")).alias("source_url"),
        F.concat(pick(TITLES, "g"), F.lit(" "), F.expr("string(g div 16)")).alias("title"),
        F.date_format(F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(int(g % 60), int(g % 24), 0, 0)"), "yyyy-MM-dd HH:mm:ss").alias("start_text"),
        F.nullif(pick(PLACES, "g"), F.lit("")).alias("location_text"),
        F.when(F.expr("(v + g) % 4 <> 0"), F.concat(F.lit("Songs, crafts and stories for families. Item "), F.col("g").cast("string"), F.lit("."))).alias("summary_text"),
        F.nullif(pick(PRICES, "g div 16"), F.lit("")).alias("price_text"),
    )


def cache_table(spark: SparkSession) -> DataFrame:
    rows = ", ".join("(" + ", ".join("null" if x is None else f"'{x}'" if isinstance(x, str) else f"{x}D" for x in r) + ")" for r in CACHE)
    return spark.sql(f"select query, double(latitude) latitude, double(longitude) longitude, double(confidence) confidence, timestamp(resolved_at) resolved_at from values {rows} as t(query, latitude, longitude, confidence, resolved_at)")


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated schedules derived from parts: runs over weekdays, explicit dates, and some malformed entries."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").cast("long").alias("k"), F.col("p_size").cast("int").alias("size"))
    start = F.expr("date_add(date'2024-01-01', int(k % 90))")
    days = F.when(F.expr("k % 5 = 0"), F.array(F.lit("Saturday"), F.lit("Sunday"))).when(F.expr("k % 5 = 1"), F.array(F.lit("monday"), F.lit("Wed"))).when(F.expr("k % 50 = 3"), F.array(F.lit("someday")))
    run = F.struct(start.cast("string").alias("start_date"), F.expr("date_add(date_add(date'2024-01-01', int(k % 90)), case when k % 41 = 7 then -2 else size % 14 end)").cast("string").alias("end_date"), F.when(F.expr("k % 3 = 0"), F.lit("10:00")).alias("start_time"), F.when(F.expr("k % 6 = 0"), F.lit("2:30 PM")).alias("end_time"), days.alias("days_of_week"))
    one = F.array(F.struct(start.cast("string").alias("date"), F.lit("9 AM").alias("start_time"), F.lit(None).cast("string").alias("end_time"), F.lit("Opening day.").alias("note")), F.struct(F.date_add(start, 7).cast("string").alias("date"), F.lit(None).cast("string").alias("start_time"), F.lit(None).cast("string").alias("end_time"), F.lit(None).cast("string").alias("note")))
    dated = F.expr("k % 4 = 1")
    return p.select(
        F.concat(F.lit("s"), F.col("k").cast("string")).alias("slug"), F.when(F.expr("k % 61 <> 5"), F.concat(F.lit("Show "), F.col("k").cast("string"))).alias("title"), F.concat(F.lit("https://shows.example.org/"), F.col("k").cast("string")).alias("source_url"),
        F.lit("Hall").alias("venue"), F.lit("1 High St").alias("address"), F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("county"), F.lit("A show for everyone.").alias("summary"), F.lit(None).cast("string").alias("price_text"), F.array(F.lit("live_show")).alias("tags"),
        F.when(~dated, run).alias("run"), F.when(dated, one).alias("dates"), F.when(F.expr("k % 7 <> 0"), F.date_sub(F.lit(AS_OF).cast("date"), F.expr("int(k % 400)")).cast("string")).alias("verified_on"), F.when(F.expr("k % 29 = 0"), F.lit(False)).alias("enabled"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates derived from orders: every third shares one link, some lack one, some are the aggregator's own."""
    from kalends import schemas
    from kalends.functions.urls import AGGREGATOR, candidate_id

    o = orders(spark, sf_dir)
    url = F.expr("case when k % 3 = 0 then 'https://hub.example.com/all' when k % 7 = 1 then null when k % 11 = 2 then 'https://" + AGGREGATOR + "/x' when k % 13 = 3 then 'https://www.facebook.com/' || k else 'http' || case when k % 2 = 0 then 's' else '' end || '://site' || k % 50 || '.example.net/' || k end")
    base = o.select(
        F.lit("aggregator").alias("seed_source_name"), F.concat(F.lit(f"https://{AGGREGATOR}/event/"), F.col("k").cast("string")).alias("seed_url"), F.concat(pick(TITLES, "k"), F.lit(" "), F.col("k").cast("string")).alias("discovered_title"),
        F.expr("case when k % 5 = 0 then null when k % 5 = 1 then 'soon' else cast(date_add(date'2024-01-01', int(k % 60)) as string) end").alias("discovered_date_text"), F.nullif(pick(PLACES, "k"), F.lit("")).alias("discovered_location_text"), url.alias("candidate_original_url"),
        F.expr("case when k % 17 = 0 then 'rejected' when k % 19 = 0 then 'published' else 'discovered' end").alias("status"), F.when(F.expr("k % 23 = 0"), F.lit("seen")).alias("notes"),
    )
    base = base.withColumn("candidate_id", candidate_id(F.col("seed_url"), F.col("discovered_title")))
    declared = spark.createDataFrame([], schemas.CANDIDATE).schema
    return base.select(*[(F.col(f.name) if f.name in base.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in declared])
