"""Sharding by bytes: contiguous shards of near equal size from global prefix sums.

Documents are ordered by a hash of their text, then by id, so copies stand together. Totals per
range of hashes give each range its offset, a window inside the range gives each unit its own,
and the middle of a unit's byte interval, scaled to the total, names its shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litloom.llm.storage import settle

SHARDS = 40
OVERHEAD = 16
WHOLE_GROUP = 0.05
LEAST_RANGES = 1024
LEAST_SALTS = 256
ROWS_A_RANGE = 1 << 18
ROWS_A_SALT = 1 << 18


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus a fixed overhead for each record; a null text has none of its own."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def _before(df: DataFrame, by: list[str], order: list[str], *sums: str) -> DataFrame:
    """Adds, for each column in `sums`, its total over the rows before this one as `<column>_before`."""
    over = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(over), F.lit(0)) for c in sums})


def shard_by_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, whole_group: float = WHOLE_GROUP) -> DataFrame:
    """Every row with its shard and its gapless place in it.

    Copies of a text share a shard while together they hold at most `whole_group` of a shard's even share;
    a larger group is contiguous, and cut where an even share ends. Columns doc_id, size, text_crc32, law,
    shard, slot, grown_shard (null: shards of this law are cut anew when their number changes). A null text
    counts as an empty one of no bytes; rows that repeat an id stand side by side; an empty table gives no rows.

    No row holds its text after the scan. A group of copies of any size is counted per (text, salt of
    the id), with partial sums before the shuffle, so it spreads over the salts. Ranges and salts grow with the number
    of rows, which decides on tasks only: the result is the same for any number of them, but for the order within a group.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        size_of(F.col(text_col)).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("hash"),
    )
    rows = settle(rows)
    count = rows.count()
    ranges_, salts = (1 << max(least.bit_length() - 1, (count // each).bit_length()) for least, each in ((LEAST_RANGES, ROWS_A_RANGE), (LEAST_SALTS, ROWS_A_SALT)))
    rows = rows.withColumns({"range": F.shiftright(F.shiftright("hash", 32) + (1 << 31), 33 - ranges_.bit_length()), "salt": F.pmod(F.xxhash64("doc_id"), F.lit(salts))})
    same = ["hash", "text_crc32", "size"]
    units = rows.groupBy("range", *same, "salt").agg(F.count(F.lit(1)).alias("n")).withColumn("bytes", F.col("n") * F.col("size"))
    units = settle(units)

    # One row for each range: the totals of the ranges and what stands before each.
    ranges = units.groupBy("range").agg(F.sum("bytes").alias("r_bytes"), F.sum("n").alias("r_n"))
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = _before(ranges, [], ["range"], "r_bytes", "r_n").withColumn("all_bytes", F.sum("r_bytes").over(everything))

    units = _before(units, ["range"], [*same, "salt"], "bytes", "n")
    group = Window.partitionBy("range", *same)
    units = units.withColumns({"g_bytes": F.sum("bytes").over(group), "g_before": F.min("bytes_before").over(group)})
    units = units.join(F.broadcast(ranges), "range").withColumns(
        {
            "at": F.col("bytes_before") + F.col("r_bytes_before"),
            "g_at": F.col("g_before") + F.col("r_bytes_before"),
            "rank_at": F.col("n_before") + F.col("r_n_before"),
            "whole": F.col("g_bytes") * shards <= F.col("all_bytes") * whole_group,
        }
    )
    units = units.select(*same, "salt", "at", "rank_at", "g_at", "g_bytes", "whole", "all_bytes")

    nth = F.row_number().over(Window.partitionBy(*same, "salt").orderBy("doc_id")).cast("long") - 1
    placed = rows.drop("range").withColumn("nth", nth).join(units, [*same, "salt"])
    twice_middle = F.when(F.col("whole"), 2 * F.col("g_at") + F.col("g_bytes")).otherwise(2 * (F.col("at") + F.col("nth") * F.col("size")) + F.col("size"))
    scaled = (twice_middle.cast("decimal(38,0)") * shards / (2 * F.col("all_bytes"))).cast("long")
    placed = placed.select("doc_id", "size", "text_crc32", F.least(scaled, F.lit(shards - 1)).cast("int").alias("shard"), (F.col("rank_at") + F.col("nth")).alias("rank"))
    placed = settle(placed)

    firsts = placed.groupBy("shard").agg(F.min("rank").alias("first"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
