"""Learned models on data with a known answer, and seams for models from outside."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from litloom.operators import learned, models, vectors
from litloom.queries import QUERIES
from litloom.sources import sinks
from litloom.streaming import incremental


@pytest.fixture(scope="module")
def themes(spark):
    groups = ["maize rice wheat crop soil", "loan credit bank market price", "water pump well river rain"]
    rows = [(i, (groups[i % 3] + " " + groups[i % 3]).split()[i % 4 : i % 4 + 6]) for i in range(90)]
    return spark.createDataFrame(rows, "doc_id long, words array<string>")


def test_factor_topics_find_themes(spark, themes):
    weights, names = models.term_weights(themes, 100)
    documents, terms = models.factor_topics(weights, 3, 10)
    best = {r["doc_id"]: r["topic"] for r in documents.groupBy("doc_id").agg(F.max_by("topic", "weight").alias("topic")).collect()}
    assert len(best) == 90 and all(best[i] == best[i % 3] for i in range(90)) and len({best[i] for i in range(3)}) == 3
    words = {}
    for r in models.top_terms(terms, names, 5).collect():
        words.setdefault(r["topic"], set()).add(r["word"])
    assert sorted(map(sorted, words.values())) == sorted(sorted(g.split()) for g in ("maize rice wheat crop soil", "loan credit bank market price", "water pump well river rain"))


def test_topics_find_themes(spark, themes):
    model = learned.fit_topics(themes, 3, iterations=30)
    found = learned.document_topics(model, themes, top=1, share=2.0).collect()
    best = {r["doc_id"]: r["topic"] for r in found}
    assert len(best) == 90 and sum(best[i] == best[i % 3] for i in range(90)) > 80


def test_stacked_classifier(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=4) + 3 * np.eye(4)[i % 3]).tolist(), i % 3) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    base = df.where("vec_id < 100")
    near = vectors.nearest(df, base, 5).join(base.select(F.col("vec_id").alias("id"), "label"), "id").select("query_id", "label")
    features = models.stacked_features(df, base, near)
    model = models.fit_stacked(features.where("id < 100"))
    assert learned.macro_f1(model.transform(features.where("id >= 100"))).first()["accuracy"] > 0.85
    assert 0 <= QUERIES["stacked_scores"](spark, "/root/testdata/sf0.001").first()["macro_f1"] <= 1  # the labels there follow no vector
    assert QUERIES["classifier_scores"](spark, "/root/testdata/sf0.001").first()["accuracy"] > 0.5
    assert QUERIES["word_synonyms"](spark, "/root/testdata/sf0.001").count() == 10


def test_vectors_learn_in_tasks(spark, monkeypatch):
    """Words that stand in equal places are synonyms, with one task and with several, each of which has part of the texts; terms are computed once."""
    rng = np.random.default_rng(4)
    groups = [["maize", "wheat", "millet"], ["loan", "credit", "grant"]]
    around = [[f"{c}{i}" for i in range(6)] for c in "xy"]
    texts = [[w for _ in range(30) for w in (*rng.choice(around[k], 3).tolist(), str(rng.choice(groups[k])))] for k in rng.integers(0, 2, 400)]
    read = spark.sparkContext.accumulator(0)

    def counted(words):
        read.add(1)
        return words

    docs = spark.createDataFrame([(t,) for t in texts], "words array<string>").select(F.udf(counted, "array<string>")("words").alias("words"))
    for words, parts in ((4_000_000, 1), (12_000, 4)):
        monkeypatch.setattr(learned, "TASK_WORDS", words)
        before = read.value
        model = learned.fit_vectors(docs, 16)
        assert model.getNumPartitions() == parts and read.value - before == len(texts)
        for group, other in (groups, groups[::-1]):
            near = [r["word"] for r in model.findSynonyms(group[0], 8).collect()]
            assert set(group[1:]) <= set(near) and not set(other) & set(near)


@pytest.mark.parametrize("kind", ["boosting", "dense", "linear"])
def test_meta_models(spark, kind):
    rng = np.random.default_rng(1)
    rows = [(float(a > b), [float(a), float(b)], float(a)) for a, b in rng.random((120, 2))]
    df = spark.createDataFrame(rows, "label double, outputs array<double>, other double").withColumn("outputs", array_to_vector("outputs"))
    model = models.fit_meta(df, ["outputs", "other"], kind=kind)
    assert model.transform(df).where("label = prediction").count() > 90


def test_outside_model(spark, tmp_path):
    df = spark.createDataFrame([(1, "long text here", "t"), (2, None, "x"), (3, "", "")], "id long, text string, title string")

    def make():
        return lambda rows: np.stack([rows["text"].str.len() / 10, rows["title"].str.len() / 2], axis=1)

    found = {r["id"]: (r["labels_given"], r["scores"]) for r in models.apply_model(df, ["text", "title"], make, ["long", "titled"], default="none").collect()}
    assert found[1][0] == ["long", "titled"] and found[2] == (["titled"], [0.0, 0.5]) and found[3][0] == ["none"]
    assert models.apply_model(df.limit(0), ["text", "title"], make, ["long", "titled"]).count() == 0
    (tmp_path / "a.bin").write_bytes(b"one hy-\nphen|two")
    pages = models.read_scans(spark, str(tmp_path), lambda content: content.decode().split("|")).collect()
    assert [(r["page"], r["text"]) for r in pages] == [(0, "one hyphen"), (1, "two")]


def test_search_server(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (2, "b", "x")], "id long, name string, tag string")
    out = str(tmp_path / "sent")

    def send(text):
        import os
        import uuid

        os.makedirs(out, exist_ok=True)
        with open(f"{out}/{uuid.uuid4().hex}", "w") as f:
            f.write(text)

    sinks.send_bulk(df, "i", ["name", "tag"], "id", send, chunk=1)
    sent = sorted(p.read_text() for p in (tmp_path / "sent").iterdir())
    assert sent == ['{"index":{"_index":"i","_id":"1"}}\n{"name":"a"}\n', '{"index":{"_index":"i","_id":"2"}}\n{"name":"b","tag":"x"}\n']
    objects = sinks.saved_objects(df.limit(1), "search", "id", "name")
    assert [tuple(r) for r in sinks.read_objects(objects.unionByName(spark.createDataFrame([("no json",)], "line string")), "title string").collect()] == [("1", "search", "a")]
    df.write.parquet(str(tmp_path / "in"))
    for p in (tmp_path / "sent").iterdir():
        p.unlink()
    incremental.index_stream(spark, str(tmp_path / "in"), "id long, name string, tag string", str(tmp_path / "check"), "i", ["name"], "id", send)
    assert len(list((tmp_path / "sent").iterdir())) >= 1
    sinks.clear_folder(spark, str(tmp_path / "in"))
    assert not list((tmp_path / "in").iterdir())


def test_save_and_load(spark, tmp_path, themes):
    model = learned.fit_topics(themes, 2, iterations=2)
    models.save(model, str(tmp_path / "m"))
    assert models.load(str(tmp_path / "m")).stages[1].getK() == 2
