"""Joins, set operations, ranking and sampling that the enrichment steps share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_widen(*parts: DataFrame) -> DataFrame:
    """All rows of all parts; a column that a part lacks is null in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def coalesced_lookup(rows: DataFrame, dims: DataFrame, keys: list[Column], dim_key: str, value: str) -> DataFrame:
    """`rows` with the value of the first of several keys that the dimension knows."""
    out, names = rows, []
    for i, key in enumerate(keys):
        side = dims.select(F.col(dim_key).alias(f"key_{i}"), F.col(value).alias(f"value_{i}")).dropDuplicates([f"key_{i}"])
        out = out.withColumn(f"own_{i}", key).join(side, F.col(f"own_{i}") == F.col(f"key_{i}"), "left").drop(f"own_{i}", f"key_{i}")
        names.append(f"value_{i}")
    return out.withColumn(value, F.coalesce(*names)).drop(*names)


def keep_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first by a stated order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__place", place).where("__place = 1").drop("__place")


def draw(id_: Column, seed: str) -> Column:
    """Twelve hex digits that order ids at random, alike on every engine with MD5."""
    return F.substring(F.md5(F.concat(F.lit(seed + ":"), id_.cast("string"))), 1, 12)


def quota(rows: DataFrame, keys: list[str], most: int, id_col: str, seed: str = "quota") -> DataFrame:
    """At most `most` rows of each key, by a seeded draw: a sampling operator."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(draw(F.col(id_col), seed), id_col))
    return rows.withColumn("__place", place).where(F.col("__place") <= most).drop("__place")


def modes(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Columns key, `modes`: the most frequent values of each key, all that tie, sorted."""
    counts = rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(key).agg(F.max("n").alias("best"))
    return counts.join(best, key).where("n = best").groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("modes"))


def assign_ids(rows: DataFrame, id_col: str, order: list[Column]) -> DataFrame:
    """Ids for rows that lack one, after the largest there is, without a gap, in a stated order.

    Rows are numbered within ranges of the order, whose counts give each range its offset, so
    no task orders all of them.
    """
    spark = rows.sparkSession
    top = rows.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top")).first()["top"]
    lacking = rows.where(F.col(id_col).isNull()).drop(id_col)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = lacking.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    numbered = sorted_.withColumn("__nth", F.monotonically_increasing_id() - F.shiftleft(F.col("__part").cast("long"), 33))
    counts = {r["__part"]: r["n"] for r in sorted_.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = top, []
    for p in range(parts):
        offsets.append(before)
        before += counts.get(p, 0)
    offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("__part") + 1)
    return rows.where(F.col(id_col).isNotNull()).unionByName(numbered.withColumn(id_col, offset + F.col("__nth") + 1).drop("__part", "__nth"))
