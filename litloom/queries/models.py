"""Queries of factor topics, stacked classifiers, splits, translations and lines for a search server."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.functions.text import normalize_text, tokens
from litloom.operators import index, learned, models
from litloom.operators import vectors as V
from litloom.queries.registry import query, table, values, values_sql
from litloom.sources import sinks
from litloom.storage import settle


@query()
def factor_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = settle(index.spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.coalesce(tokens(normalize_text(F.col("text"))), F.array().cast("array<string>")).alias("words")))
    weights, names = models.term_weights(docs, 500)
    _, terms = models.factor_topics(settle(weights), 8, 5)
    return models.top_terms(terms, names, 10)


NAMED = [(0, 1, "maize", [1.0, 0.0]), (0, 2, "rice", [0.9, 0.2]), (0, 3, "wheat", [0.95, 0.1]), (0, 4, "loan", [0.0, 1.0]), (1, 1, "loan", [0.0, 1.0]), (1, 2, "credit", [0.1, 1.0])]


@query("SELECT * FROM (VALUES (0, 'maize, rice, wheat'), (1, 'credit, loan')) t(topic, names)")
def topic_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The central words of two small topics, in order of letters."""
    rows = values(spark, "topic int, place int, word string, vector array<double>", NAMED)
    found = models.topic_names(rows.drop("vector"), rows.select("word", "vector").dropDuplicates(["word"]))
    return found.select("topic", F.array_join(F.array_sort(F.split("name", ", ")), ", ").alias("names"))


@query("""WITH v AS (SELECT * FROM (VALUES (0, 'maize', [1.0, 0.0]), (0, 'rice', [0.9, 0.2]), (0, 'wheat', [0.95, 0.1]), (0, 'loan', [0.0, 1.0]), (1, 'loan', [0.0, 1.0]), (1, 'credit', [0.1, 1.0])) t(topic, word, e)), m AS (SELECT topic, [avg(e[1]), avg(e[2])] AS m FROM v GROUP BY topic)
SELECT topic, word FROM v JOIN m USING (topic) WHERE list_cosine_similarity(CAST(e AS DOUBLE[]), CAST(m AS DOUBLE[])) >= 0.6""")
def topic_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = values(spark, "topic int, place int, word string, vector array<double>", NAMED)
    return models.topic_keywords(rows.drop("vector"), rows.select("word", "vector").dropDuplicates(["word"]), 0.6).select("topic", "word")


@query()
def stacked_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro-F1 and accuracy of the stacked classifier on one of five folds of the embeddings, learned from the others."""
    rows = table(spark, sf_dir, "embeddings").withColumn("fold", models.folds(F.col("vec_id"), 5))
    base = settle(rows.where("fold <> 0"))
    near = V.nearest(rows, base, 5).join(base.select(F.col("vec_id").alias("id"), "label"), "id").select("query_id", "label")
    features = settle(models.stacked_features(rows, base, near).join(rows.select(F.col("vec_id").alias("id"), "fold"), "id"))
    model = models.fit_stacked(features.where("fold <> 0"))
    return learned.macro_f1(model.transform(features.where("fold = 0")))


@query("""WITH k AS (SELECT doc_id, CASE WHEN quality = 1 THEN CASE WHEN toxic = 1 THEN 'q|t' ELSE 'q' END ELSE CASE WHEN toxic = 1 THEN 't' ELSE '' END END AS key FROM labels),
n AS (SELECT doc_id, key, row_number() OVER (PARTITION BY key ORDER BY substr(md5('split:' || CAST(doc_id AS VARCHAR)), 1, 12), doc_id) AS nth, count(*) OVER (PARTITION BY key) AS n FROM k)
SELECT doc_id, nth <= greatest(floor(n * 0.1), CASE WHEN n > 1 THEN 1 ELSE 0 END) AS test FROM n""")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = F.filter(F.array(F.when(F.col("quality") == 1, F.lit("q")), F.when(F.col("toxic") == 1, F.lit("t"))), lambda x: x.isNotNull())
    rows = table(spark, sf_dir, "labels").select("doc_id", marks.alias("labels"))
    return models.stratified_split(rows, "labels", "doc_id").select("doc_id", "test")


WORDS = [("maize", "fr", "mais"), ("maize storage", "fr", "stockage du mais"), ("bag", "fr", "sac"), ("maize", "es", "maiz")]
KEYWORDS = [("maize storage",), ("maize bag",), ("other",)]
TRANSLATED = [("maize storage", "fr", "stockage du mais"), ("maize storage", "es", "maiz storage"), ("maize bag", "fr", "mais sac"), ("maize bag", "es", "maiz bag"), ("other", "fr", "other"), ("other", "es", "other")]


@query(f"SELECT * FROM (VALUES {values_sql(TRANSLATED)}) t(keyword, lang, translation)")
def translated_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.translate_keywords(values(spark, "keyword string", KEYWORDS), values(spark, "word string, lang string, translation string", WORDS))


@query("""SELECT doc_id AS id, '{"index":{"_index":"docs","_id":"' || doc_id || '"}}' || chr(10) || '{' || coalesce('"lang":"' || lang || '",', '') || coalesce('"source":"' || source || '"', '') || '}' AS line FROM documents""")
def bulk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.bulk_lines(table(spark, sf_dir, "documents"), "docs", ["lang", "source", "other"], "doc_id")


@query("""SELECT doc_id, quality, CAST(NULL AS VARCHAR) AS lang FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars > 500) UNION ALL SELECT doc_id, CAST(NULL AS INTEGER), lang FROM documents WHERE n_chars > 500""")
def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.upsert(table(spark, sf_dir, "labels").select("doc_id", "quality"), table(spark, sf_dir, "documents").where("n_chars > 500").select("doc_id", "lang"), "doc_id")
