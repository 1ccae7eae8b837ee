import random
import zlib

import numpy as np
import pytest

from litloom.llm import langid, quality

from .conftest import EXTRA, frame, sentence

WORDS = {"aa": "the and of house water green", "bb": "der und das haus wasser gruen", "cc": "le et une maison eau verte"}


def languages(spark, n=150):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(30)), lang) for i in range(n) for lang in [sorted(WORDS)[i % 3]]]
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !!", None), (1003, "wasser haus", None), (None, "house", None), (1003, "wasser haus", None), (1004, "wasserhausen", None)]
    return rows, spark.createDataFrame([(*r, *["z"] * len(EXTRA)) for r in rows], "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in EXTRA))


def test_language(spark):
    rows, df = languages(spark)
    found = langid.identify(df, langid.train(df)).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r for r in found}
    wrong = [i for i, _, lang in rows[:150] if by[i]["lang_pred"] != lang]
    assert not wrong
    assert all(by[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(150))
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, 1004)] == ["und", "und", "und", "bb", "bb"]
    assert all(0 <= r["score"] <= 1 for r in found)
    kept = langid.accept(df, langid.train(df))
    assert kept.columns == df.columns and not kept.where("doc_id in (1000, 1001, 1002)").count()


def test_language_without_labels(spark):
    _, df = languages(spark, 0)
    model = langid.train(df.limit(0))
    assert {r["lang_pred"] for r in langid.identify(df, model).collect()} == {"und"}
    assert langid.identify(df.limit(0), model).count() == 0


def test_memo_overflow():
    model = langid.LanguageModel(["aa", "bb"], ([], np.zeros((0, 2), np.float32)), (["a"], np.array([[-1.0, -2.0]], np.float32)))
    before, langid.MEMO = langid.MEMO, 8
    try:
        model._forget()
        assert model.predict(" ".join(f"a{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)))[0] == "aa"
    finally:
        langid.MEMO = before


def test_isotonic():
    counts, totals, centres = np.array([2, 0, 2, 2.0]), np.array([1, 0, 0, 2.0]), np.array([0.1, 0.2, 0.3, 0.4])
    x, y = quality.isotonic(counts, totals, centres)
    assert y.tolist() == [0.25, 1.0] and x.tolist() == pytest.approx([0.2, 0.4])


def test_statistics_count_whole_texts():
    texts = ["a b c\nA B\na b c", "", "zz " * 400_000]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    x = quality.statistics(data, offsets)
    col = quality.STATISTICS.index
    assert x[0, col("distinct_words")] == pytest.approx(3 / 8) and x[0, col("distinct_lines")] == pytest.approx(2 / 3)
    assert np.isfinite(x).all() and x[2, col("distinct_words")] == pytest.approx(1 / 400_000)


def test_quality(spark):
    rows, marks = [], []
    for i in range(300):
        good = i % 3 > 0
        text = sentence(i, 60) if good else " ".join(w.upper() + "!!" for w in sentence(i, 60).split())
        rows.append((i, text))
        if i < 200:
            marks.append((i, int(good), "z"))
    rows += [(500, None), (501, ""), (None, "x"), (1, rows[1][1])]
    marks += [(None, 1, "z"), (3, None, "z"), (4, 1, "z")]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, text string")
    found = quality.classify(frame(spark, rows), labels).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    fresh = [r for r in found if r["doc_id"] is not None and (r["held_out"] or 200 <= r["doc_id"] < 300) and r["doc_id"] < 300]
    right = [r["predicted"] == int(r["doc_id"] % 3 > 0) for r in fresh]
    assert sum(right) / len(right) > 0.95


def test_quality_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.classify(frame(spark, [(1, "a"), (2, None)]), labels).count() == 2
    assert quality.classify(frame(spark, []), labels).count() == 0


def test_rare_language_is_learned(spark):
    """A language with few of many labelled rows, which one draw over all languages would leave out."""
    rows = [(i, "alpha beta gamma", "aa") for i in range(2000)] + [(5000 + i, "жук лес дом", "bb") for i in range(10)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_docs=10)
    assert model.languages == ["aa", "bb"] and model.predict("лес")[0] == "bb"


def test_numerals_are_no_letters(spark):
    rows = [(i, "alpha beta x", "aa") for i in range(8)] + [(100, "½ ² ³ ①", None), (101, "x²", None), (102, "١٢٣", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(df, langid.train(df)).collect()}
    assert [found[i] for i in (100, 101, 102)] == ["und", "aa", "und"]
    assert dict(langid.counted_words("a² b½c a été")) == {"a": 2, "b": 1, "c": 1, "été": 1}


def test_words_met_once_are_learned(spark):
    df = spark.createDataFrame([(i, f"word{chr(97 + i)}", "aa") for i in range(19)], "doc_id long, text string, lang string")
    assert len(langid.train(df).words) == df.where(~langid.held_out(df.doc_id)).count()


def test_ties_at_the_bound(spark):
    """Among words as frequent as that of the cut, about as many are kept as there is room for."""
    rows = [(i, f"often w{chr(97 + i % 26)}{chr(97 + i // 26)}", "aa") for i in range(600)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_words=200)
    assert 150 < len(model.words) < 250 and "often" in model.words


def test_long_text(spark):
    text = "haus wasser der und " * 300_000 + "½" * 100_000
    df = spark.createDataFrame([(i, "haus wasser der und", "bb") for i in range(9)] + [(50, text, None)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in langid.identify(df, langid.train(df)).collect()} == {"bb"}


def test_cosines_approximate_a_gaussian_kernel():
    rng = np.random.default_rng(3)
    model = quality.QualityModel(np.zeros(12), np.ones(12))
    before, quality.COSINES = quality.COSINES, 20_000
    try:
        model = quality.QualityModel(np.zeros(12), np.ones(12))
        x = rng.normal(size=(40, 12))
        z = model.features(x)[:, :20_000]
        wanted = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(2) * quality.BANDWIDTH**2 / 12)
        assert np.abs(z @ z.T - wanted).max() < 0.06
    finally:
        quality.COSINES = before


def test_sums_give_the_ridge_of_all_rows(spark):
    """Normal equations summed over tasks against a direct solution, and out-of-fold scores against models without the fold."""
    texts = [(i, sentence(i, 30 + i % 50) if i % 3 else " ".join(w.upper() + "!!" for w in sentence(i, 40).split())) for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in texts], "doc_id long, quality int")
    found = quality.document_statistics(frame(spark, texts))
    model = quality.train(found.repartition(7), labels)
    taught = {i for i in range(240) if zlib.crc32(str(i).encode()) % 5}
    rows = sorted((r["doc_id"], r["x"]) for r in found.collect() if r["doc_id"] in taught)
    x, y = np.array([r[1] for r in rows]), np.array([float(r[0] % 3 > 0) for r in rows])
    assert model.mean == pytest.approx(x.mean(0)) and model.spread == pytest.approx(x.std(0) + 1e-6, abs=1e-5)  # the sum of squares loses digits of a constant
    z = model.features(x)
    assert model.weights == pytest.approx(np.linalg.solve(z.T @ z + quality.RIDGE * np.eye(z.shape[1]), z.T @ y), abs=1e-6)
    raw = z @ model.weights
    order = np.argsort(raw)
    assert (np.diff(model.scores(x)[order]) >= -1e-12).all()


def test_language_scores_by_definition(spark):
    """Smoothed log frequencies of words and n-grams, and the total of a text, against a direct computation."""
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("haus baum", "bb"), ("house tree", "aa"), ("haus wald", "bb"), ("house house", "aa"), ("wald", "bb"), ("tree", "aa")] * 3)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    taught = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 5]
    count = {lang: {} for lang in ("aa", "bb")}
    for t, lang in taught:
        for w in t.split():
            count[lang][w] = count[lang].get(w, 0) + 1
    words = sorted({w for c in count.values() for w in c})
    log = lambda w: [np.log((count[x].get(w, 0) + 0.5) / (sum(count[x].values()) + 0.5 * len(words))) for x in ("aa", "bb")]
    assert model.words == words and np.allclose(model.word_scores, [log(w) for w in words], atol=1e-5)
    trigrams = {lang: {} for lang in count}
    for lang, c in count.items():
        for w, n in c.items():
            for i in range(len(w)):
                g = f"^{w}$"[i : i + 3]
                trigrams[lang][g] = trigrams[lang].get(g, 0) + n
    kinds = sorted({g for c in trigrams.values() for g in c})
    g = "^ha"
    assert np.allclose(model.gram_scores[model.grams.index(g)], [np.log((trigrams[x].get(g, 0) + 0.5) / (sum(trigrams[x].values()) + 0.5 * len(kinds))) for x in ("aa", "bb")], atol=1e-5)
    total = np.array(log("haus")) * 2 + np.array(log("tree"))
    assert model.predict("Haus tree haus") == (["aa", "bb"][int(np.argmax(total))], pytest.approx(float(1 / np.exp(total - total.max()).sum()), abs=1e-5))
