"""Report aggregations: matrices, overlaps, trends, bins and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket_matrix(rows: DataFrame, row: str, bucket: Column) -> DataFrame:
    """Columns row, bucket, n, share: counts and each count's share of its bucket."""
    counts = rows.groupBy(row, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("bucket").agg(F.sum("n").alias("total"))
    return counts.join(totals, "bucket").select(row, "bucket", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def overlap_codes(rows: DataFrame, key: str, flags: dict[str, Column]) -> DataFrame:
    """Columns code, n: keys by which of the flags any of their rows has, as bits."""
    bits = [F.max(flag.cast("int")) * (1 << i) for i, flag in enumerate(flags.values())]
    codes = rows.groupBy(key).agg(sum(bits[1:], bits[0]).alias("code"))
    return codes.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def cooccurrence(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Columns a, b, n: keys that hold both values (a < b). Values of a key are distinct before they pair."""
    sets = rows.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("v"))
    pairs = F.flatten(F.transform("v", lambda x, i: F.transform(F.slice("v", i + 2, F.size("v")), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    return sets.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))


def bins(value: Column, edges: list[int]) -> Column:
    """The right edge of the right-closed bin of a value; null beyond the last."""
    out = None
    for edge in edges:
        out = F.when(value <= edge, F.lit(edge)) if out is None else out.when(value <= edge, F.lit(edge))
    return out


def list_metrics(predicted: Column, true: Column) -> dict[str, Column]:
    """Precision, recall, F1 and intersection over union of two lists as sets; two empty ones agree."""
    both = F.size(F.array_intersect(predicted, true))
    p = F.when(F.size(predicted) > 0, both / F.size(F.array_distinct(predicted))).otherwise(F.lit(0.0))
    r = F.when(F.size(true) > 0, both / F.size(F.array_distinct(true))).otherwise(F.lit(0.0))
    union = F.size(F.array_union(predicted, true))
    return {"precision": p, "recall": r, "f1": F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)), "iou": F.when(union == 0, F.lit(1.0)).otherwise(both / union)}


def confusion(rows: DataFrame, predicted: Column, true: Column) -> DataFrame:
    """One row: tp, fp, fn, tn."""
    of = lambda p, t: F.count_if((predicted == p) & (true == t))
    return rows.agg(of(1, 1).alias("tp"), of(1, 0).alias("fp"), of(0, 1).alias("fn"), of(0, 0).alias("tn"))


def windows(words: Column, size: int = 256, stride: int = 128) -> Column:
    """Starts of the windows that cover a list: every `stride` words until the end is covered."""
    n = F.size(words)
    last = F.greatest(F.ceil((n - size) / stride), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last.cast("int")), lambda k: k * stride)
