"""Queries of vector similarity over embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.operators import vectors as V
from litloom.queries.registry import query, table

_TOP = """WITH p AS (SELECT q.vec_id AS query_id, b.vec_id AS id, b.label, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS cosine
FROM embeddings q JOIN embeddings b ON q.vec_id % 100 = 0 AND q.vec_id <> b.vec_id), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 12) DESC, id) AS place FROM p)"""


def neighbours(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """Queries are the rows whose id is divisible by 100, against all rows."""
    rows = table(spark, sf_dir, "embeddings")
    return V.nearest(rows.where("vec_id % 100 = 0"), rows, k)


@query(f"{_TOP} SELECT query_id, id, round(cosine, 6) AS cosine, place FROM r WHERE place <= 10")
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(spark, sf_dir, 10).select("query_id", "id", F.round("cosine", 6).alias("cosine"), F.col("place").cast("long").alias("place"))


@query(f"""{_TOP}, v AS (SELECT query_id, label, count(*) AS votes FROM r WHERE place <= 5 GROUP BY query_id, label)
SELECT query_id, label, votes FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, label) AS n FROM v) WHERE n = 1""")
def knn_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label")
    return V.majority(neighbours(spark, sf_dir, 5), labels)


@query("""WITH u AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS i, embedding FROM embeddings)
SELECT label, CAST(i - 1 AS INTEGER) AS dimension, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS mean FROM u GROUP BY label, i""")
def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.centroids(table(spark, sf_dir, "embeddings"), "label", "embedding").select("label", F.col("at").alias("dimension"), F.round("mean", 6).alias("mean"))


@query("""SELECT a.label, CAST(max(n.n) AS BIGINT) AS n, round(avg(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))), 5) AS coherence
FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY label) n ON n.label = a.label GROUP BY a.label""")
def coherence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = V.coherence(table(spark, sf_dir, "embeddings"), "label", "embedding")
    return found.select("label", "n", F.round("coherence", 5).alias("coherence"))
