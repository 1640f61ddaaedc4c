"""Connected components of a link table, as alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import stored


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.sum(F.col("b").cast("decimal(20,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of the node and its neighbours."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the least node that each linked node reaches. Links are pairs (a, b).

    Self links and repeated links do nothing; nodes without links are not returned. Every step is written to the
    shared folder: a plan of several steps reads its links once for each way through them, 144 times for two rounds,
    and the driver held all of it.
    """
    links = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _mark(links)
    for _ in range(most_rounds):
        if not before[0]:
            break
        links = stored(_small_star(stored(_large_star(links), "links")), "links")
        now = _mark(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
