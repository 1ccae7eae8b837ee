"""Queries of pattern mining, phrases, concepts and learned models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.operators import index, mining, phrases
from litloom.queries.parts import abbreviation, postings_ctes, token_ctes
from litloom.queries.registry import query, table, values, values_sql

@query(f"""WITH {token_ctes("documents")}, p AS (SELECT term AS a, lead(term) OVER (PARTITION BY id ORDER BY i) AS b FROM tok), c AS (SELECT term, count(*) AS c FROM tok GROUP BY term),
t AS (SELECT a, b, count(*) AS n FROM p WHERE b IS NOT NULL GROUP BY a, b HAVING count(*) >= 5)
SELECT a, b, n, round((n - 5) * (SELECT count(*) FROM c) / (CAST(x.c AS DOUBLE) * y.c), 6) AS score FROM t JOIN c x ON a = x.term JOIN c y ON b = y.term WHERE (n - 5) * (SELECT count(*) FROM c) / (CAST(x.c AS DOUBLE) * y.c) > 10""")
def phrase_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = index.with_terms(index.spread(table(spark, sf_dir, "documents").select("doc_id", "text")), [], F.col("text"))
    return phrases.pair_scores(words).select("a", "b", "n", F.round("score", 6).alias("score"))


@query(f"""WITH {postings_ctes()} SELECT string_split(term, ' ')[1] AS word, term AS expression, df FROM vocab WHERE n_tokens = 2 AND df >= 5""")
def popular_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = index.build_postings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return index.build_vocabulary(posts).where("n_tokens = 2 and df >= 5").select(F.split("term", " ")[0].alias("word"), F.col("term").alias("expression"), "df")


CONCEPTS = [("organisation", 5), ("organization", 9), ("organizations", 9), ("fertilizer", 4), ("fertiliser", 4), ("fertilizers", 2), ("maize", 7), ("maizes", 1), ("rice", 3), ("a", 9), ("UN", 2), ("ab", 5)]


def _merged_sql(rows: str) -> str:
    swap = f"(length(x.concept) > 5 AND length(x.concept) = length(y.concept) AND NOT contains(x.concept, ' ') AND levenshtein(x.concept, y.concept) = 1 AND list_contains(list_transform(range(3, length(x.concept)), lambda i: CASE WHEN substr(x.concept, i, 1) = 's' THEN substr(x.concept, 1, i - 1) || 'z' || substr(x.concept, i + 1) WHEN substr(x.concept, i, 1) = 'z' THEN substr(x.concept, 1, i - 1) || 's' || substr(x.concept, i + 1) END), y.concept))"
    return f"""WITH RECURSIVE {rows}, k AS (SELECT concept, df FROM r WHERE length(concept) > 2 OR (length(concept) = 2 AND {abbreviation('concept')})),
p AS (SELECT x.concept AS source, max_by(y.concept, (-y.df, y.concept)) AS target FROM k x JOIN k y ON substr(x.concept, 1, 5) = substr(y.concept, 1, 5) AND (y.df > x.df OR (y.df = x.df AND y.concept < x.concept))
  WHERE length(x.concept) >= 5 AND length(y.concept) >= 5 AND (1 - CAST(levenshtein(x.concept, y.concept) AS DOUBLE) / greatest(length(x.concept), length(y.concept)) >= 0.92 OR {swap}) GROUP BY x.concept),
f AS (SELECT concept AS source, concept AS target FROM k UNION SELECT f.source, p.target FROM f JOIN p ON f.target = p.source)
SELECT source AS concept, target AS canonical FROM f WHERE target NOT IN (SELECT source FROM p)"""


@query(_merged_sql(f"r(concept, df) AS (VALUES {values_sql(CONCEPTS)})"))
def merge_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining.merge_concepts(values(spark, "concept string, df long", CONCEPTS))


@query(_merged_sql(postings_ctes() + ", r AS (SELECT term AS concept, df FROM vocab WHERE n_tokens = 1)"))
def merge_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Single terms only, so pairs of neighbours are not made.
    words = index.with_terms(index.spread(table(spark, sf_dir, "documents").select("doc_id", "text")), ["doc_id"], F.col("text"))
    posts = words.select("doc_id", F.explode(F.array_distinct("words")).alias("term")).distinct()
    return mining.merge_concepts(index.build_vocabulary(posts).select(F.col("term").alias("concept"), "df"))


AUTHORS = [(1, "Smith, J.; Doe, A."), (2, "J. Smith and A. Doe"), (3, "Smith J, Doe A, Lee K"), (4, "Smith, J., Doe, A. et al."), (5, None)]


AUTHOR_NAMES = [(1, "Smith J; Doe A"), (2, "Smith J; Doe A"), (3, "Smith J; Doe A; Lee K"), (4, "Smith J; Doe A"), (5, "")]


@query(f"WITH a(id, authors) AS (VALUES {values_sql(AUTHOR_NAMES)}) SELECT id, authors FROM a")
def parse_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = values(spark, "id long, raw string", AUTHORS)
    return rows.select("id", F.array_join(mining.authors(F.col("raw")), "; ").alias("authors"))
