"""Column expressions over long arrays, in linear time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 512


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _running(lengths: Column, first: Column) -> Column:
    """first, first + lengths[0], ...: as many as there are lengths. Copies its result at each step, so for short arrays."""
    start = F.struct(first.cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(lengths, start, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])


def sums_before(lengths: Column, first: Column | int = 0) -> Column:
    """For each element of an array of bigint the sum of `first` and all elements before it; by blocks, so that long arrays take linear time."""
    first = F.lit(first) if isinstance(first, int) else first

    def of_blocks(all_: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")), lambda b: F.slice(all_, b * BLOCK + 1, BLOCK))
        return let(blocks, summed)

    def summed(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0).cast("bigint"), lambda a, x: a + x))
        return F.flatten(F.zip_with(blocks, _running(totals, first), lambda block, at: _running(block, at)))

    return let(lengths, lambda all_: F.when(F.size(all_) <= BLOCK, _running(all_, first)).otherwise(of_blocks(all_)))
