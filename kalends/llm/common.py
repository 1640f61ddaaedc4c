"""What the operators share: scratch tables in the cluster's shared folder and Arrow plumbing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the cluster names in spark.checkpoint.dir.

    Only a local session without that setting, as in tests, gets a temporary folder; on a cluster the
    setting must be made, for an executor's own disk would lose what others need.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ids_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with the text as UTF-8 bytes, null as empty; other columns are not read."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def ids_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def filtered(docs: DataFrame, keep: Callable, more: dict[str, str], rest: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """docs, names and types unchanged, through keep() as mapInArrow() calls it and then rest().

    Inside, columns are named by their positions, so that no name of the caller's, dotted or not, can clash; keep()
    may add the columns of more (name to type), which rest() uses.
    """
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    schema = StructType(list(plain.schema.fields))
    for name, kind in more.items():
        schema = schema.add(name, kind)
    return rest(plain.mapInArrow(keep, schema)).select(plain.columns).toDF(*docs.columns)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, so that Python holds few texts at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def per_row(df: DataFrame, make: Callable[[], Callable], fields: list[tuple[str, pa.DataType]], schema: str) -> DataFrame:
    """Rows (doc_id, text) -> (doc_id, *fields). make() is called once per task and gives text -> tuple."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in slices(batches):
            found = [one(t) for t in batch.column("text").to_pylist()]
            cols = list(zip(*found)) if found else [[] for _ in fields]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, kind) for c, (_, kind) in zip(cols, fields))],
                names=["doc_id", *(n for n, _ in fields)],
            )

    return df.mapInArrow(run, schema)
