"""Writers: weeks, envelopes, manifest, queue, cache, reports (SNK1-SNK10, SET3, RET1).

Every writer has a builder that returns the rows; a dry run calls the builder only (SNK9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kalends import rules
from kalends.functions.dates import iso
from kalends.functions.urls import host
from kalends.operators.dedupe import retained_weeks
from kalends.operators.reports import source_count


def published_rows(events: DataFrame, week: str) -> DataFrame:
    """Rows of the week's partition."""
    return events.withColumn("week_start", F.to_date(F.lit(week)))


def write_week(events: DataFrame, path: str, week: str) -> None:
    """SNK1, the table that scales: a partition per week, only the written week is replaced."""
    published_rows(events, week).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week_start").parquet(path)


def envelope(events: DataFrame, week: str, generated_at: str) -> DataFrame:
    """SNK1, the document: one row for one week, events sorted by start and title.

    A week's feed is one document by definition, so it is gathered in one row; the partitioned table is for volumes.
    """
    fields = [iso(F.col(n)).alias(n) if t.startswith("timestamp") else F.col(n) for n, t in events.dtypes]
    first = ["start", "title", *[c for c in events.columns if c not in ("start", "title")]]
    row = F.struct(*[next(f for f, n in zip(fields, events.columns) if n == c) for c in first])
    body = events.agg(F.array_sort(F.collect_list(row)).alias("events"), F.count("*").alias("event_count"))
    return body.join(F.broadcast(source_count(events)), F.lit(True)).select(F.lit(week).alias("week_start"), F.lit(generated_at).alias("generated_at"), "source_count", "event_count", "events")


#: log2 of how many neighbours in a week's order share one document at most; an aggregation holds 128 of them before it sorts.
PORTION_BITS = 10


def envelopes(events: DataFrame, generated_at: str) -> DataFrame:
    """SNK1 for every week that events start in, in portions: documents as envelope() makes them, of at most 1,024 events each.

    The counts are those of the whole week. A week's documents in ascending order of part hold its events sorted by all
    fields, start and title first; no task, row or file holds a week.
    """
    week = F.date_format(F.date_trunc("WEEK", "start"), "yyyy-MM-dd").alias("week_start")
    fields = {n: iso(F.col(n)).alias(n) if t.startswith("timestamp") else F.col(n) for n, t in events.dtypes}
    names = ["start", "title", *[c for c in events.columns if c not in ("start", "title")]]
    rows = events.select(week, F.struct(*[fields[c] for c in names]).alias("row"))
    order = ["week_start", *[F.col("row")[c] for c in names]]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.shiftright(F.monotonically_increasing_id(), PORTION_BITS))
    body = placed.groupBy("week_start", "part").agg(F.array_sort(F.collect_list("row")).alias("events"))
    hosts, names = F.count_distinct(host(F.col("source_url"))), F.count_distinct("source_name")
    counts = events.groupBy(week).agg(F.when(hosts == 0, names).otherwise(hosts).alias("source_count"), F.count("*").alias("event_count"))
    return body.join(counts, body["week_start"].eqNullSafe(counts["week_start"])).select(body["week_start"], "part", F.lit(generated_at).alias("generated_at"), "source_count", "event_count", "events")


def write_envelopes(events: DataFrame, path: str, generated_at: str) -> None:
    """SNK1: the JSON documents of each week, a file each, in a folder named by the week."""
    envelopes(events, generated_at).write.mode("overwrite").option("maxRecordsPerFile", 1).partitionBy("week_start").json(path)


def manifest(known: DataFrame, week: str, generated_at: str, keep: int = rules.KEEP_WEEKS) -> DataFrame:
    """SNK2 with SET3: one row; known(week) are the weeks of the old index and of the files on disk."""
    weeks = retained_weeks(known, keep, week).filter("kept")
    return weeks.agg(F.array_sort(F.collect_set("week")).alias("available_weeks"), F.max("week").alias("latest_week")).select(F.lit(1).alias("version"), F.lit(generated_at).alias("generated_at"), "available_weeks", "latest_week")


def dropped_weeks(known: DataFrame, week: str, keep: int = rules.KEEP_WEEKS) -> DataFrame:
    """RET1's complement: partitions to drop."""
    return retained_weeks(known, keep, week).filter(~F.col("kept")).select("week")


def week_table(spark: SparkSession, path: str) -> DataFrame:
    """Weeks on disk, from the partitions alone."""
    return spark.read.parquet(path).select(F.col("week_start").cast("string").alias("week")).distinct()


def write_json(df: DataFrame, path: str) -> None:
    """SNK3, SNK6-SNK8: a report or snapshot as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """SNK3."""
    df.write.mode("overwrite").parquet(path)


def _versions(spark: SparkSession, path: str) -> tuple[object, list[tuple[int, object, bool]]]:
    """The file system and (number, folder, whether its write was committed) of a replaced table, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    if store.exists(folder):
        for entry in store.listStatus(folder):
            name = entry.getPath().getName()
            if name.startswith("v") and name[1:].isdigit():
                done = store.exists(spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS"))
                found.append((int(name[1:]), entry.getPath(), done))
    return store, sorted(found, key=lambda v: v[0])


def current_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest committed version of a table that replace_table() writes; null before the first."""
    done = [folder for _, folder, committed in _versions(spark, path)[1] if committed]
    return spark.read.parquet(done[-1].toString()) if done else None


def replace_table(df: DataFrame, path: str, keep: int = 2) -> None:
    """SNK4, SNK5, SNK10: writes a merged table as the next version and drops all but the newest.

    The merge may read the version before. A version counts once its write is committed, so a crash at any point
    leaves the one before in force, and a repeated write starts over.
    """
    spark = df.sparkSession
    _, found = _versions(spark, path)
    number = max((n for n, _, done in found if done), default=0) + 1
    df.write.mode("overwrite").parquet(f"{path}/v{number:010d}")
    store, found = _versions(spark, path)
    for _, folder, _ in [v for v in found if v[0] <= number][:-keep]:
        store.delete(folder, True)
