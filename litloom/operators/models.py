"""Topics by factors, stacked classifiers, meta models and seams for models that come from outside."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import CountVectorizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litloom.functions.text import is_abbreviation
from litloom.operators.phrases import cosine
from litloom.operators.relations import assign_ids, draw
from litloom.storage import settle

SEED = 7
SMALL_SCALE = ["smallholder", "smallscale", "small_scale", "small_holder", "subsistence"]


def term_weights(docs: DataFrame, vocabulary: int = 5000, small_scale: list[str] = SMALL_SCALE) -> tuple[DataFrame, list[str]]:  # noqa: B006
    """Columns doc_id, term (its number), w of documents (doc_id, words), and the terms by number.

    TF-IDF over terms in at least two and at most 95 % of the documents; phrases (with an underscore) count four times,
    abbreviations twice, words of small scale half.
    """
    model = CountVectorizer(inputCol="words", outputCol="counts", vocabSize=vocabulary, minDF=2, maxDF=0.95).fit(docs)
    names = model.vocabulary
    known = docs.sparkSession.createDataFrame(list(enumerate(names)) or [(0, "")], "term int, word string")
    counts = docs.select("doc_id", F.explode("words").alias("word")).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("tf")).join(known, "word")
    n = docs.count()
    idf = counts.groupBy("term").agg((F.log(F.lit(1 + n) / (1 + F.count(F.lit(1)))) + 1).alias("idf"))
    extra = F.when(F.contains("word", F.lit("_")), F.lit(4.0)).when(is_abbreviation(F.col("word")), F.lit(2.0)).when(F.col("word").isin(small_scale), F.lit(0.5)).otherwise(F.lit(1.0))
    return counts.join(idf, "term").select("doc_id", "term", (F.col("tf") * F.col("idf") * extra).alias("w")), names


def factor_topics(weights: DataFrame, k: int = 15, iterations: int = 10) -> tuple[DataFrame, DataFrame]:
    """Topics as non-negative factors: documents (doc_id, topic, weight) and terms (term, topic, weight).

    Alternating least squares with non-negative factors over all cells; cells that are zero count with a lower confidence, so
    this is a weighted form of the usual factorisation, and it is distributed by documents and terms.
    """
    ids = settle(assign_ids(weights.select("doc_id").distinct().withColumn("row", F.lit(None).cast("long")), "row", [F.col("doc_id")]))
    cells = weights.join(ids, "doc_id").select(F.col("row").cast("int").alias("row"), "term", F.col("w").cast("float").alias("w"))
    model = ALS(rank=k, maxIter=iterations, regParam=0.05, implicitPrefs=True, alpha=1.0, nonnegative=True, seed=SEED, userCol="row", itemCol="term", ratingCol="w").fit(cells)
    spread = lambda df, name: df.select(F.col("id").alias(name), F.posexplode("features").alias("topic", "weight"))
    documents = spread(model.userFactors, "row").join(ids, "row").select("doc_id", "topic", F.col("weight").cast("double").alias("weight"))
    return documents, spread(model.itemFactors, "term").select("term", "topic", F.col("weight").cast("double").alias("weight"))


def top_terms(terms: DataFrame, names: list[str], top: int = 10) -> DataFrame:
    """Columns topic, place, word, weight: the words with the largest weight of each topic."""
    known = terms.sparkSession.createDataFrame(list(enumerate(names)) or [(0, "")], "term int, word string")
    place = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("weight"), "word"))
    return terms.join(known, "term").withColumn("place", place).where(F.col("place") <= top).select("topic", "place", "word", "weight")


def topic_keywords(words: DataFrame, vectors: DataFrame, least: float = 0.35) -> DataFrame:
    """Rows of `words` (topic, place, word) that are near the topic: with a cosine of at least `least` to the mean vector of its words (vectors: word, vector)."""
    placed = words.join(vectors, "word")
    cells = placed.select("topic", F.posexplode("vector").alias("dim", "x")).groupBy("topic", "dim").agg(F.avg("x").alias("x"))
    means = cells.groupBy("topic").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("mean"))
    return placed.join(means, "topic").where(cosine(F.col("vector"), F.col("mean")) >= least).select("topic", "place", "word")


def topic_names(words: DataFrame, vectors: DataFrame, least: float = 0.35, named: int = 3, damping: float = 0.85, rounds: int = 30) -> DataFrame:
    """Columns topic, name: the `named` most central words of each topic, by PageRank on the graph of its words (a few for each topic).

    Words are linked with their cosine from `least` on; words without a vector or a link keep the base rank. Ties by letters.
    """

    def central(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("word")
        v = np.array(rows["vector"].tolist(), float)
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
        links = v @ v.T
        links[links < least] = 0
        np.fill_diagonal(links, 0)
        out = links.sum(axis=1, keepdims=True)
        step = np.where(out > 0, links / np.maximum(out, 1e-300), 1 / len(rows))
        rank = np.full(len(rows), 1 / len(rows))
        for _ in range(rounds):
            rank = (1 - damping) / len(rows) + damping * rank @ step
        order = np.argsort(-np.round(rank, 9), kind="stable")[:named]
        return pd.DataFrame({"topic": [rows["topic"].iloc[0]], "name": [", ".join(rows["word"].iloc[i] for i in order)]})

    return words.join(vectors, "word").select("topic", "word", F.col("vector").cast("array<double>").alias("vector")).groupBy("topic").applyInPandas(central, "topic int, name string")


def stacked_features(rows: DataFrame, base: DataFrame, neighbours: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", label_col: str = "label") -> DataFrame:
    """Columns id, label, features: the vector, its cosine to the mean of each class of `base`, and the votes of its neighbours (query_id, label).

    Classes come from `base` alone, so a held-out row adds nothing to what it is compared with.
    """
    classes = sorted(r["label"] for r in base.select(F.col(label_col).alias("label")).distinct().collect())  # one row for each class
    cells = base.select(F.col(label_col).alias("label"), F.posexplode(vector_col).alias("dim", "x")).groupBy("label", "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    means = cells.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("mean"))
    table = means.agg(F.map_from_entries(F.collect_list(F.struct("label", "mean"))).alias("means"))
    votes = neighbours.groupBy("query_id").agg(*[F.count_if(F.col("label") == c).cast("double").alias(f"v{i}") for i, c in enumerate(classes)])
    joined = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v")).crossJoin(F.broadcast(table)).join(votes.withColumnRenamed("query_id", "id"), "id", "left")
    near = F.array(*[F.coalesce(cosine(F.col("v"), F.element_at("means", F.lit(c))), F.lit(0.0)) for c in classes])
    counted = F.array(*[F.coalesce(f"v{i}", F.lit(0.0)) for i in range(len(classes))])
    return joined.select("id", "label", array_to_vector(F.concat("v", near, counted)).alias("features"))


def fit_stacked(features: DataFrame, trees: int = 40) -> PipelineModel:
    """A forest over stacked features (any number of classes from 0 on)."""
    return Pipeline(stages=[RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=8, seed=SEED)]).fit(features.withColumn("label", F.col("label").cast("double")))


def folds(id_: Column, n: int = 10, seed: str = "folds") -> Column:
    """A fold for each id, the same in every run."""
    return F.pmod(F.conv(draw(id_, seed), 16, 10).cast("decimal(20,0)"), F.lit(n)).cast("int")


def fit_meta(df: DataFrame, columns: list[str], label_col: str = "label", kind: str = "boosting") -> PipelineModel:
    """A meta model over the outputs of others (numeric or vector columns): `boosting`, `dense` (one hidden layer) or `linear`; several classes by one against the rest."""
    assembled = VectorAssembler(inputCols=columns, outputCol="features")
    classes = df.select(label_col).distinct().count()
    if kind == "dense":
        width = assembled.transform(df.limit(1)).select(F.size(vector_to_array("features")).alias("n")).first()["n"]
        last = MultilayerPerceptronClassifier(featuresCol="features", labelCol=label_col, layers=[width, max(4, width // 2), max(2, classes)], seed=SEED)
    else:
        one = GBTClassifier(featuresCol="features", labelCol=label_col, maxIter=20, seed=SEED) if kind == "boosting" else LogisticRegression(featuresCol="features", labelCol=label_col, regParam=0.01)
        last = one if classes <= 2 else OneVsRest(classifier=one, featuresCol="features", labelCol=label_col)
    return Pipeline(stages=[assembled, last]).fit(df)


def apply_model(df: DataFrame, columns: list[str], make: Callable[[], Callable[[pd.DataFrame], np.ndarray]], labels: list[str], threshold: float = 0.5, default: str | None = None, batch: int = 1000) -> DataFrame:
    """`df` with `labels_given` and `scores`: labels whose score reaches the threshold, by any model.

    `make` builds the model once in each Python worker and gives a function from rows (the columns) to scores (rows by labels); rows come
    `batch` at a time. Without a label that reaches the threshold the default is given, if there is one. Nulls arrive as empty texts.
    """

    @F.pandas_udf("array<double>")
    def scored(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = make()
        for part in parts:
            rows = pd.DataFrame({c: s.fillna("") for c, s in zip(columns, part, strict=True)})
            found = [model(rows.iloc[lo : lo + batch]) for lo in range(0, len(rows), batch)]
            yield pd.Series([list(map(float, r)) for f in found for r in f])

    out = df.withColumn("scores", scored(*columns))
    named = F.array(*[F.lit(x) for x in labels])
    given = F.filter(F.zip_with(named, "scores", lambda name, s: F.when(s >= threshold, name)), lambda x: x.isNotNull())
    return out.withColumn("labels_given", F.when(F.size(given) > 0, given).otherwise(F.array(F.lit(default)) if default is not None else F.array().cast("array<string>")))


def stratified_split(rows: DataFrame, labels_col: str, id_col: str, share: float = 0.1, seed: str = "split") -> DataFrame:
    """`rows` with `test`: of each combination of labels the share with the smallest draws, at least one where there are two rows or more."""
    key = F.array_join(F.array_sort(labels_col), "|")
    order = Window.partitionBy("__key").orderBy(draw(F.col(id_col), seed), id_col)
    placed = rows.withColumn("__key", key).withColumns({"__nth": F.row_number().over(order), "__n": F.count(F.lit(1)).over(Window.partitionBy("__key"))})
    wanted = F.greatest(F.floor(F.col("__n") * share), (F.col("__n") > 1).cast("long"))
    return placed.withColumn("test", F.col("__nth") <= wanted).drop("__key", "__nth", "__n")


def translate_keywords(keywords: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Columns keyword, lang, translation from a dictionary (word, lang, translation): a whole phrase if it is known, else word by word, unknown words as they are."""
    langs = dictionary.select("lang").distinct()
    rows = keywords.select("keyword").distinct().crossJoin(F.broadcast(langs))
    whole = rows.join(dictionary.withColumnRenamed("word", "keyword"), ["keyword", "lang"], "left")
    parts = whole.where("translation is null").select("keyword", "lang", F.posexplode(F.split("keyword", " ")).alias("at", "word")).join(dictionary, ["word", "lang"], "left")
    joined = parts.groupBy("keyword", "lang").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", F.coalesce("translation", "word").alias("t")))), lambda s: s["t"]), " ").alias("translation"))
    return whole.where("translation is not null").select("keyword", "lang", "translation").unionByName(joined)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def read_scans(spark: SparkSession, path: str, recognise: Callable[[bytes], list[str]]) -> DataFrame:
    """Columns file, page, text of scanned documents under a path; `recognise` gives the texts of a file's pages. Lines cut by a hyphen are joined."""
    from litloom.functions.text import clean_ocr

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for file, content in zip(part["path"], part["content"], strict=True):
                texts = recognise(content)
                yield pd.DataFrame({"file": [file] * len(texts), "page": range(len(texts)), "text": texts})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInPandas(pages, "file string, page int, text string").withColumn("text", clean_ocr(F.col("text")))
