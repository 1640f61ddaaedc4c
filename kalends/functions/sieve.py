"""Semi and anti joins of a large table with few keys, in which rows that surely have no such key are not moved.

The keys' hashes are set in a bitmap of at most 2**BITS bits (8 MB), which all tasks get. Only rows whose bit is set are shuffled
for the exact join that follows, so the result is that of the join whatever the keys. More keys than bits let more rows through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26
#: Bits of a bitmap for each key, while there are so many.
ROOM = 32
#: A row of the bitmap holds 2**ROW bits.
ROW = 15


def _place(on: str, bits: int) -> str:
    return f"(xxhash64(`{on}`) & {(1 << bits) - 1}L)"


def _bitmap(keys: DataFrame, on: str, bits: int) -> DataFrame:
    """(_row, _words): all rows of the bitmap, each an array of whole numbers of 64 bits."""
    place = _place(on, bits)
    none = keys.sparkSession.range(0, 1 << bits - 6, 1, 1).selectExpr("id as slot", "0L as bits")
    some = keys.selectExpr(f"shiftright({place}, 6) as slot", f"shiftleft(1L, int({place} & 63)) as bits")
    slots = some.unionByName(none).groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    rows = slots.groupBy(F.expr(f"int(shiftright(slot, {ROW - 6}))").alias("_row")).agg(F.array_sort(F.collect_list(F.struct("slot", "bits"))).alias("_all"))
    return rows.select("_row", F.col("_all")["bits"].alias("_words"))


def sifted(df: DataFrame, keys: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """Rows that may have one of the keys, and rows that have none. Nothing but the bitmap is shuffled; df is read for each."""
    bits = min(BITS, max(ROW, (ROOM * keys.count()).bit_length()))
    place = _place(on, bits)
    there = F.expr(f"int(shiftright({place}, {ROW})) = _row and getbit(get(_words, int(shiftright({place}, 6) & {(1 << ROW - 6) - 1})), int({place} & 63)) = 1")
    bitmap = F.broadcast(_bitmap(keys, on, bits))
    return df.join(bitmap, there, "left_semi"), df.join(bitmap, there, "left_anti")


def among(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The left semi join."""
    return sifted(df, keys, on)[0].join(keys.select(on), on, "left_semi")


def without(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The left anti join."""
    some, none = sifted(df, keys, on)
    return none.unionByName(some.join(keys.select(on), on, "left_anti"))
