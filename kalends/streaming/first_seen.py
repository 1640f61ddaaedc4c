"""ST2: each source's URL once, told when it is first met and corrected when an earlier arrival comes late.

State is kept by buckets of keys' hashes: of each source and URL the least ingest_seq so far and when it is forgotten, and a
timer a bucket for the first of these. A bucket is read and written once per batch, so a key costs no call of its own; its share
of the keys is one in BUCKETS, and a batch writes the buckets that it touches anew. A row is put out
when a key is new ("first"), and again when a later batch brings a smaller ingest_seq ("correction", which names the one
that it replaces). Readers take the least ingest_seq of a key; those that cannot wait take the first rows and undo what a correction names.

Each task keeps one row of a key out of what it reads before rows are dealt by key, so a hot key sends a row per
batch of a task. A key that was not met for the delay is forgotten, and is new when it comes again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, StructField, StructType

#: Fixed for the life of a checkpoint.
BUCKETS = 256
KEY = ["source_id", "source_url"]
OUT = "source_id string, source_url string, ingest_seq long, kind string, replaces long"


def local_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The row with the least ingest_seq of each key in a batch, its time the latest of them."""
    for batch in batches:
        if batch.num_rows:
            rows = pa.Table.from_batches([batch]).group_by(KEY).aggregate([("ingest_seq", "min"), ("seen_at", "max")])
            rows = rows.select([*KEY, "ingest_seq_min", "seen_at_max"]).rename_columns([*KEY, "ingest_seq", "seen_at"])
            yield from rows.cast(pa.schema([batch.schema.field(n) for n in rows.column_names])).combine_chunks().to_batches()


HELD = pa.schema([("source_id", pa.string()), ("source_url", pa.string()), ("least", pa.int64()), ("until", pa.int64())])


class FirstSeen(StatefulProcessor):
    def __init__(self, delay_ms: int) -> None:
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getValueState("rows", StructType([StructField("rows", BinaryType())]))

    def held(self) -> dict[tuple, tuple[int, int]]:
        """Least ingest_seq and the time to forget it, by key."""
        if not self.rows.exists():
            return {}
        c = pa.ipc.open_stream(bytes(self.rows.get()[0])).read_all().to_pydict()
        return dict(zip(zip(c["source_id"], c["source_url"]), zip(c["least"], c["until"])))

    def keep(self, held: dict[tuple, tuple[int, int]]) -> None:
        if not held:
            self.rows.clear()
            return
        table = pa.table([*map(list, zip(*held)), *map(list, zip(*held.values()))], schema=HELD)
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, HELD) as stream:
            stream.write_table(table)
        self.rows.update((out.getvalue().to_pybytes(),))
        self.handle.registerTimer(min(until for _, until in held.values()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        met: dict[tuple, tuple[int, int]] = {}
        for part in rows:
            at = part["seen_at"].astype("datetime64[ns]").astype("int64") // 1_000_000
            for source, url, seq, seen in zip(part["source_id"], part["source_url"], part["ingest_seq"].tolist(), at.tolist()):
                low, latest = met.get((source, url), (seq, seen))
                met[source, url] = min(low, seq), max(latest, seen)
        held, now, told = self.held(), timerValues.getCurrentWatermarkInMs(), []
        for k, (low, latest) in met.items():
            before = held[k][0] if k in held else None
            held[k] = low if before is None else min(before, low), max(latest, now) + self.delay_ms
            if before is None or low < before:
                told.append((*k, low, "first" if before is None else "correction", before))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.keep(held)
        if told:
            yield pd.DataFrame(told, columns=["source_id", "source_url", "ingest_seq", "kind", "replaces"]).astype({"replaces": "Int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        self.keep({k: v for k, v in self.held().items() if v[1] > now})
        yield from ()

    def close(self) -> None:
        pass


def stateful(spark: SparkSession) -> SparkSession:
    """A session whose streams keep keyed state and timers; the caller's settings stay as they are."""
    own = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return own


def first_by_arrival(stream: DataFrame, time_column: str, delay: str = "7 days") -> DataFrame:
    """(source_id, source_url, ingest_seq, kind, replaces) of a stream from a stateful() session; rows without a URL are not followed."""
    rows = stream.select(*KEY, F.col("ingest_seq").cast("long").alias("ingest_seq"), F.col(time_column).cast("timestamp").alias("seen_at")).filter("source_url <> '' and ingest_seq is not null")
    once = rows.mapInArrow(local_first, rows.schema).withWatermark("seen_at", delay)
    dealt = once.withColumn("bucket", F.pmod(F.xxhash64(*KEY), F.lit(BUCKETS)))
    return dealt.groupBy("bucket").transformWithStateInPandas(FirstSeen(delay_ms(delay)), outputStructType=OUT, outputMode="Append", timeMode="EventTime")


def delay_ms(delay: str) -> int:
    n, unit = delay.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1000


def settled(told: DataFrame) -> DataFrame:
    """Per key the first arrival, the one told first, and how often it was corrected."""
    return told.groupBy(*KEY).agg(F.min("ingest_seq").alias("ingest_seq"), F.max(F.when(F.col("kind") == "first", F.col("ingest_seq"))).alias("first_told"), F.count_if(F.col("kind") == "correction").alias("corrections"))
