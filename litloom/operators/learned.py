"""Learned models on MLlib: topics, word vectors and classifiers."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.operators import index
from litloom.storage import settle

SEED = 7


def with_words(df: DataFrame, text_col: str = "text") -> DataFrame:
    return index.with_terms(df, df.columns, F.coalesce(text_col, F.lit("")))


def fit_topics(df: DataFrame, k: int = 15, vocabulary: int = 5000, iterations: int = 20) -> PipelineModel:
    """Topics over documents with a `words` column; terms in fewer than two or over 95 % of documents are left out."""
    count = CountVectorizer(inputCol="words", outputCol="counts", vocabSize=vocabulary, minDF=2, maxDF=0.95)
    return Pipeline(stages=[count, LDA(featuresCol="counts", topicDistributionCol="topics", k=k, maxIter=iterations, seed=SEED)]).fit(df)


def topic_words(model: PipelineModel, top: int = 10) -> DataFrame:
    """Columns topic, place, word, weight."""
    names = F.array(*[F.lit(w) for w in model.stages[0].vocabulary])
    rows = model.stages[1].describeTopics(top).select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("place", "z"))
    return rows.select("topic", "place", F.element_at(names, F.col("z.termIndices") + 1).alias("word"), F.col("z.termWeights").alias("weight"))


def document_topics(model: PipelineModel, df: DataFrame, id_col: str = "doc_id", top: int = 3, share: float = 0.3) -> DataFrame:
    """Columns doc_id, topic, weight: a document's top topics, and those with at least `share` of the topic's largest weight."""
    from pyspark.sql import Window

    rows = model.transform(df).select(F.col(id_col).alias("doc_id"), F.posexplode(vector_to_array("topics")).alias("topic", "weight"))
    peak = rows.groupBy("topic").agg(F.max("weight").alias("peak"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("weight"), "topic"))
    rows = rows.join(peak, "topic").withColumn("place", place)
    return rows.where((F.col("place") <= top) | (F.col("weight") >= share * F.col("peak"))).select("doc_id", "topic", "weight")


#: Words that one task learns vectors from.
TASK_WORDS = 4_000_000


def fit_vectors(df: DataFrame, size: int = 100, least: int = 7):
    """Vectors of the words of a `words` column. Texts are dealt out to tasks of about TASK_WORDS words, each of which learns from all of its own; a word's vectors are averaged."""
    df = settle(df.select("words"))
    total = df.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = max(1, -(-total // TASK_WORDS))
    return Word2Vec(vectorSize=size, minCount=least, windowSize=6, maxIter=1, numPartitions=parts, seed=SEED, inputCol="words", outputCol="vector").fit(df)


def fit_classifier(df: DataFrame, label_col: str = "label", features: int = 1 << 14) -> PipelineModel:
    stages = [HashingTF(inputCol="words", outputCol="tf", numFeatures=features), IDF(inputCol="tf", outputCol="tfidf"), LogisticRegression(featuresCol="tfidf", labelCol=label_col, maxIter=20, regParam=0.01)]
    return Pipeline(stages=stages).fit(df)


def macro_f1(rows: DataFrame, label_col: str = "label", predicted_col: str = "prediction") -> DataFrame:
    """One row: macro_f1 over the labels, accuracy."""
    t, p = F.col(label_col).cast("int"), F.col(predicted_col).cast("int")
    both = rows.select(F.explode(F.array(F.struct(t.alias("k"), (t == p).cast("int").alias("tp"), F.lit(1).alias("t"), F.lit(0).alias("p")), F.struct(p.alias("k"), F.lit(0).alias("tp"), F.lit(0).alias("t"), F.lit(1).alias("p")))).alias("z")).select("z.*")
    per = both.groupBy("k").agg(F.sum("tp").alias("tp"), F.sum("t").alias("t"), F.sum("p").alias("p"))
    return per.agg(F.avg(2 * F.col("tp") / (F.col("t") + F.col("p"))).alias("macro_f1"), (F.sum("tp") / F.sum("t")).alias("accuracy"))
