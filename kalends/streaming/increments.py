"""Incremental forms of the batch operators: landing and the review queue (ST1, ST3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from kalends import schemas
from kalends.operators.candidates import merge_queue
from kalends.sources.ledger import merge_table


def landing_stream(spark: SparkSession, path: str) -> DataFrame:
    """ST1: raw records from files that have not been read before."""
    return spark.readStream.schema(schemas.RAW).option("multiLine", True).json(path)


def land(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """ST1: appends what is new and stops."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_review_queue(stream: DataFrame, queue_path: str, checkpoint: str, policy: str = "full") -> StreamingQuery:
    """ST3, the queue: merges each micro-batch into the queue that current() reads; a repeated batch changes nothing, other writers' rows stay."""

    def merge(batch: DataFrame, number: int) -> None:
        def merged(old: DataFrame | None) -> DataFrame:
            old = batch.limit(0) if old is None else old  # the first batch makes the queue
            return merge_queue(old, batch.select(*old.columns), policy)

        merge_table(batch.sparkSession, queue_path, merged, (checkpoint, number))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
