"""Tables in the shared folder, for frames that several steps read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster names in spark.checkpoint.dir.

    Only a local session without that setting, as in tests, gets a temporary folder; on a cluster an
    executor's own disk would lose what others need, so there the setting must be made.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        base = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once and read back: later steps prune its columns and never compute it again."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
