"""Nearest vectors by cosine, centroids, representatives and coherence."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 32 << 20
#: Scores that a task holds at once.
CELLS = 1 << 21


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def _ranked(query: np.ndarray, score: np.ndarray, id_: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query, ties by the smaller id."""
    order = np.lexsort((id_, -score, query))
    query, score, id_ = query[order], score[order], id_[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(query)), bool), query[1:] != query[:-1])))
    nth = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    return query[nth < k], score[nth < k], id_[nth < k]


def _best(ids: np.ndarray, lo: int, score: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of queries (from `lo` on), cosines and ids: of each query's row of scores the k best and what ties with the last of them."""
    score[own[None, :] == ids[:, None]] = -np.inf
    last = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] > k else np.full(len(ids), -np.inf)
    query, at = np.nonzero((score >= last[:, None]) & (score > -np.inf))
    return _ranked(query + lo, score[query, at], own[at], k)


def nearest(queries: DataFrame, base: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Columns query_id, id, cosine, place: the k most similar base vectors of each query, itself left out.

    Queries go to the tasks in blocks of at most BLOCK_BYTES; each task keeps its own k best for each query
    of a block, so only those are shuffled and ranked, and holds CELLS scores at once, however many rows a batch has. Ties go to the smaller id. Null vectors match nothing.
    """
    spark = base.sparkSession
    rows = queries.where(F.col(vector_col).isNotNull()).select(F.col(id_col).alias("query_id"), F.col(vector_col).alias("v"))
    first = rows.first()
    width = len(first["v"]) if first else 1
    total = rows.count()
    blocks = max(1, -(-total * width * 8 // BLOCK_BYTES))
    out = None
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b).collect()
        ids = np.array([r["query_id"] for r in part], np.int64)
        matrix = np.array([r["v"] for r in part], float).reshape(len(part), width)
        matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)
        shared = spark.sparkContext.broadcast((ids, matrix))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            ids, q = shared.value
            best = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
            for batch in batches:
                if not len(batch) or not len(ids):
                    continue
                v = np.array(batch["v"].tolist(), float)
                v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
                own = batch["id"].to_numpy()
                step = max(1, CELLS // len(own))
                found = [_best(ids[lo : lo + step], lo, np.round(q[lo : lo + step] @ v.T, 12), own, k) for lo in range(0, len(ids), step)]
                best = _ranked(*(np.concatenate(c) for c in zip(best, *found, strict=True)), k)
            if len(best[0]):
                yield pd.DataFrame({"query_id": ids[best[0]], "id": best[2], "cosine": best[1]})

        found = base.where(F.col(vector_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).mapInPandas(run, "query_id long, id long, cosine double")
        out = found if out is None else out.unionByName(found)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("cosine"), "id"))
    return out.withColumn("place", place).where(F.col("place") <= k)


def majority(neighbours: DataFrame, labels: DataFrame) -> DataFrame:
    """Columns query_id, label, votes: the most frequent label among each query's neighbours, the smaller on a tie."""
    votes = neighbours.join(labels, "id").groupBy("query_id", "label").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("query_id").agg(F.max(F.struct("votes", (-F.col("label")).alias("l"))).alias("b"))
    return best.select("query_id", (-F.col("b.l")).alias("label"), F.col("b.votes").alias("votes"))


def centroids(rows: DataFrame, key: str, vector_col: str) -> DataFrame:
    """Columns key, at, mean: the mean vector of each key, a row for each dimension, summed before the shuffle."""
    parts = rows.select(key, F.posexplode(vector_col).alias("at", "x"))
    return parts.groupBy(key, "at").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def coherence(rows: DataFrame, key: str, vector_col: str) -> DataFrame:
    """Columns key, n, coherence: the mean cosine of all pairs of a key's vectors.

    With unit vectors the sum over pairs is (|sum|^2 - n) / 2, so no pair is formed.
    """
    norm = F.sqrt(F.aggregate(vector_col, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    unit = rows.select(key, F.transform(vector_col, lambda x: x.cast("double") / norm).alias("u"))
    sums = unit.select(key, F.posexplode("u").alias("at", "x")).groupBy(key, "at").agg(F.sum("x").alias("s"), F.count(F.lit(1)).alias("n"))
    whole = sums.groupBy(key).agg(F.max("n").alias("n"), F.sum(F.col("s") * F.col("s")).alias("square"))
    return whole.select(key, "n", F.when(F.col("n") > 1, (F.col("square") - F.col("n")) / (F.col("n") * (F.col("n") - 1))).alias("coherence"))
