"""AGG10 in a stream: the links that a share of all rows has in common, kept up batch by batch.

A link with a share of all rows has that share of at least one batch, and one that loses it can only win it back in a batch where
it has it again. So each batch names fewer than 1 / share + 1 candidates, and only links that have the share so far are held. A held
link adds its hits in the batch; a new candidate is counted in the batches before, which are kept as (url, hits), sorted, so that
its few row groups are read. The result after any split into batches is that of counting all rows at once.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from kalends import rules
from kalends.sources.ledger import Ledger

COUNTED = "url string, hits bigint"
#: So many parts of one level become one part of the next, so a row is rewritten once a level.
FAN_IN = 16


def _parts(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    return spark.read.schema(COUNTED).parquet(*[f"{path}/{n}" for n in names])


def _summed(parts: DataFrame, some: list[str]) -> dict[str, int]:
    """Hits of some links, of which there are fewer than 1 / share + 1."""
    found = parts.filter(F.col("url").isin(some)).groupBy("url").agg(F.sum("hits").alias("hits")) if some else parts.limit(0)
    return {r["url"]: r["hits"] for r in found.collect()}


def merge_links(batch: DataFrame, stream: str, number: int, path: str, url: str = "candidate_original_url", share: float = rules.CHROME_SHARE, attempts: int = 10) -> bool:
    """Counts a batch; False if it was counted before. Rows without a link count as rows, their null or empty link does not.

    The share is the table's from its first batch on; another one is refused, for held links depend on it.
    """
    spark, ledger = batch.sparkSession, Ledger(batch.sparkSession, path)
    for _ in range(attempts):
        at, entry = ledger.newest()
        done, parts, before = entry.get("batches", {}), entry.get("parts", []), entry.get("held", {})
        if entry.get("share", share) != share:
            raise ValueError(f"these links are held by a share of {entry['share']}")
        if done.get(stream, -1) >= number:
            return False
        data = ledger.fresh(at + 1)
        link = F.nullif(F.col(f"`{url}`"), F.lit("")).alias("url")
        batch.groupBy(link).agg(F.count("*").alias("hits")).sortWithinPartitions("url").write.parquet(f"{path}/{data}")
        new = _parts(spark, path, [data])
        rows = new.agg(F.sum("hits").alias("n")).first()["n"] or 0
        # a little below the share, so that rounding names a candidate too many and never one too few
        named = new.filter(F.col("url").isNotNull() & (F.col("hits") >= share * rows * (1 - 1e-9)))
        heavy = {r["url"]: r["hits"] for r in named.collect()}
        here = _summed(new, list(before))
        unknown = [u for u in heavy if u not in before]
        earlier = _summed(_parts(spark, path, [n for n, _ in parts]), unknown) if parts else {}
        held = {u: n + here.get(u, 0) for u, n in before.items()} | {u: heavy[u] + earlier.get(u, 0) for u in unknown}
        total = entry.get("rows", 0) + rows
        held = {u: n for u, n in held.items() if n >= share * total * (1 - 1e-9)}
        parts = [*parts, [data, 0]]
        while len(parts) >= FAN_IN and len({level for _, level in parts[-FAN_IN:]}) == 1:
            whole = ledger.fresh(at + 1)
            merged = _parts(spark, path, [n for n, _ in parts[-FAN_IN:]]).groupBy("url").agg(F.sum("hits").alias("hits"))
            merged.sortWithinPartitions("url").write.parquet(f"{path}/{whole}")
            parts = [*parts[:-FAN_IN], [whole, parts[-1][1] + 1]]
        if ledger.commit(at + 1, {"share": share, "rows": total, "held": held, "parts": parts, "batches": done | {stream: number}}):
            ledger.tidy(lambda e: {n for n, _ in e["parts"]})
            return True
    raise RuntimeError(f"other writers were first {attempts} times")


def shared_links(spark: SparkSession, path: str, least: int = rules.CHROME_LEAST) -> DataFrame:
    """(url, hits) of what outlier_urls() finds in all rows so far; no row before the first batch."""
    _, entry = Ledger(spark, path).newest()
    bound = max(least, math.ceil(entry["share"] * entry["rows"])) if entry else 0
    return spark.createDataFrame([(u, n) for u, n in entry.get("held", {}).items() if n >= bound], COUNTED)


def keep_links(candidates: DataFrame, path: str, checkpoint: str, url: str = "candidate_original_url", share: float = rules.CHROME_SHARE) -> StreamingQuery:
    """Counts a stream's batches and stops when all that is there has been read; the checkpoint is the stream's name."""
    return candidates.writeStream.foreachBatch(lambda batch, n: merge_links(batch, checkpoint, n, path, url, share) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
