"""Mixing sources to target weights, in words, by repetition rates.

Each source's target share of all words follows its weight, capped at MOST_REPEATS times its words
with the excess reshared by weight. target / words is the source's rate; a document is taken
floor(rate) times plus once more if its hash, seen as a uniform number, lies below the fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litloom.llm.storage import settle, tabled

WEIGHTS = (1.0, 2.0, 3.0)
MOST_REPEATS = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(id_: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from an id (null: its own), the same in every run and on every engine with MD5."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Columns source, source_size, target, rate for a table of (source, size) rows.

    Sources by code point, null last, get the weights in turn. With level L, a source's target is
    min(weight * L, most * its size), and L is such that targets sum to all words: a running sum over the sources
    by the level at which each is capped finds it. Sources without words have target and rate 0.
    The table of sources is aggregated from per-task partial sums and is the only one ordered as a whole.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth % len(weights) + 1).cast("int"))
    totals = settle(totals.withColumn("weight", weight))
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy("capped_from", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    steps = totals.withColumn("capped_from", most * F.col("source_size") / F.col("weight"))
    steps = steps.withColumns(
        {
            "full": F.coalesce(F.sum(most * F.col("source_size")).over(by_cap), F.lit(0)),
            "open": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by_cap), F.lit(0.0)),
            "words": F.sum("source_size").over(every),
        }
    ).withColumn("level", (F.col("words") - F.col("full")) / F.col("open"))
    # The first source that its level does not cap sets the level of all; if none, every source is at its cap.
    level = steps.agg(F.min_by("level", F.when(F.col("level") <= F.col("capped_from"), F.struct("capped_from", F.col("source").isNull(), F.coalesce("source", F.lit(""))))).alias("level"))
    target = F.least(F.col("weight") * F.coalesce("level", F.lit(float("inf"))), most * F.col("source_size").cast("double"))
    rate = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))
    return totals.crossJoin(F.broadcast(level)).select("source", "source_size", target.alias("target"), rate.alias("rate"))


def _taken(rate: Column, id_: Column, seed: str) -> Column:
    floor = F.floor(rate).cast("long")
    return floor + (uniform(id_, seed) < rate - floor).cast("long")


def _sizes(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), words_in(F.col(text_col)).alias("size"))


def copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """Columns source, doc_id, size, source_size, target, rate, copies: one row per input row.

    A null text has no words. Null is a source of its own. Rows that repeat an id decide alike. An empty
    table gives no rows. The sources join as a written table of known size: Spark broadcasts it below its
    threshold, so the rows stay where they are, and else splits hot sources as skewed partitions.
    """
    rows = settle(_sizes(df, id_col, text_col, source_col))
    targets = tabled(source_targets(rows, weights, most).withColumnRenamed("source", "of"))
    joined = rows.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    return joined.withColumn("copies", _taken(F.col("rate"), F.col("doc_id"), seed))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """The mixture itself: every input row, with all its columns, as many times as `copies` says."""
    sizes = settle(_sizes(df, id_col, text_col, source_col).groupBy("source").agg(F.sum("size").alias("size")))
    of, rate = (next(n for i in range(len(df.columns) + 1) if (n := f"{name}_{i}") not in df.columns) for name in ("of", "rate"))
    targets = tabled(source_targets(sizes, weights, most).select(F.col("source").alias(of), F.col("rate").alias(rate)))
    joined = df.join(targets, F.col(source_col).eqNullSafe(F.col(of)))
    times = _taken(F.col(rate), F.col(id_col).cast("long"), seed).cast("int")
    return joined.withColumn(of, F.explode(F.array_repeat(F.lit(""), times))).select(*df.columns)
