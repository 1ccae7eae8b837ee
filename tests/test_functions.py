"""Text functions and operators on hand-written cases."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from litloom.functions import text as T
from litloom.operators import abbreviations, dedup, index, labels, mining, relations, reports, search, taxonomies, vectors
from litloom.plans import registry
from litloom.sources import readers, sinks
from litloom.streaming import incremental


def one(spark, function, value):
    return spark.createDataFrame([(value,)], "t string").select(function(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("function", "value", "wanted"),
    [
        (T.fold_accents, "é ß ñ", "e  n"), (T.normalize_text, "NGOs in 2nd ÉTÉ_x", "NGO in ETE x"), (T.remove_html_tags, "<b>a</b> &amp; (  )", "a & "),
        (T.trim_marks, ".,; Trim me?! ", "Trim me?"), (T.normalize_keywords, "full text; maize,Rice", "maize ; Rice"), (T.camel_case, "the role of x", "the Role of X"),
        (T.replace_braces, "{a}cid {ab}{%}", "acid %"), (T.country_name, "Korea, Republic", "Korea"), (T.remove_copyright, "Text (c) 2020", "Text"),
        (T.normalize_text, None, None), (T.normalize_text, "", ""), (T.drop_stopwords, "the role of farms", "role farms"),
    ],
)
def test_scalar(spark, function, value, wanted):
    assert one(spark, function, value) == wanted


def test_tokens(spark):
    assert one(spark, lambda c: T.tokens(T.normalize_text(c)), "The cities and boxes of UN 12ab women assesses") == ["city", "box", "UN", "woman", "assess"]
    assert one(spark, T.tokens, "") == []


def corpus(spark):
    rows = [(1, "Maize storage programme for organisations"), (2, "Maize storage program of the organization"), (3, "Rice only, no maize"), (4, None), (5, "maize storage storage program")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def find(spark, queries, threshold):
    posts = index.build_postings(corpus(spark))
    frame = spark.createDataFrame(queries, "query_id long, query string")
    return {(r["query_id"], r["doc_id"]) for r in search.search(frame, posts, index.build_vocabulary(posts), threshold).collect()}


def test_search(spark):
    queries = [(1, "maize"), (2, "maize storage"), (3, "maize storage program"), (4, "organization"), (5, "of the"), (6, "programs")]
    exact, fuzzy = find(spark, queries, 1.0), find(spark, queries, 0.85)
    assert {d for q, d in exact if q == 1} == {1, 2, 3, 5}
    assert {d for q, d in exact if q == 2} == {1, 2, 5}
    assert {d for q, d in exact if q == 4} == {1, 2}
    assert not [d for q, d in exact if q == 5]
    assert exact <= fuzzy


def test_wildcard(spark):
    vocabulary = index.build_vocabulary(index.build_postings(corpus(spark)))
    found = search.wildcard(spark.createDataFrame([(1, "sto*"), (2, "*x")], "id long, pattern string"), vocabulary)
    assert {r["term"] for r in found.collect()} == {"storage"}


def test_proximity(spark):
    near = lambda t: one(spark, lambda c: labels.proximity(c, ["farm"], ["small"], 2), t)
    assert near("small green farm") and not near("small big tall red farm") and not near("")


def test_dedup(spark):
    body = "Maize yields rose in dry soils. Farmers stored grain in metal silos for months."
    rows = [(1, body), (2, body), (3, body + " Indeed"), (4, "Other words here. Nothing alike."), (5, None), (6, "")]
    found = {r["doc_id"]: r["kept"] for r in dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: False, 2: False, 3: True, 4: True, 5: True, 6: True}


def test_concepts(spark):
    rows = [("organisation", 5), ("organization", 9), ("organizations", 2), ("rice", 1)]
    found = {r["concept"]: r["canonical"] for r in mining.merge_concepts(spark.createDataFrame(rows, "concept string, df long")).collect()}
    assert found == {"organisation": "organization", "organization": "organization", "organizations": "organization", "rice": "rice"}


def test_abbreviations(spark):
    found = one(spark, abbreviations.bracketed, "the World Health Organization (WHO) and Food and Agriculture Organization (FAO) no such thing (XYZ)")
    assert [(r["abbr"], r["meaning"]) for r in found] == [("WHO", "World Health Organization"), ("FAO", "Food and Agriculture Organization")]


def test_authors():
    import pandas as pd

    found = mining.parse_authors(pd.Series(["Smith, J.; Doe, A.", "J. Smith and A. Doe", None, ""])).tolist()
    assert found == [["Smith J", "Doe A"], ["Smith J", "Doe A"], [], []]


def test_assign_ids(spark):
    rows = spark.createDataFrame([("a", 7), ("c", None), ("b", None)], "name string, id long")
    found = {r["name"]: r["id"] for r in relations.assign_ids(rows, "id", [F.col("name")]).collect()}
    assert found == {"a": 7, "b": 8, "c": 9}


def test_nearest(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [0.0, 1.0]), (3, None)], "vec_id long, embedding array<double>")
    found = vectors.nearest(rows.where("vec_id = 0"), rows, 2).orderBy("place").collect()
    assert [r["id"] for r in found] == [1, 2]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.sampled_from("abc")), st.lists(st.sampled_from("abc")))
def test_list_metrics(spark, a, b):
    frame = spark.createDataFrame([(a, b)], "p array<string>, t array<string>")
    row = frame.select(*[c.alias(k) for k, c in reports.list_metrics(F.col("p"), F.col("t")).items()]).first()
    p, t = set(a), set(b)
    assert row["iou"] == pytest.approx(len(p & t) / len(p | t) if p | t else 1.0)
    assert row["f1"] == pytest.approx(2 * len(p & t) / (len(p) + len(t)) if p & t else 0.0)


def test_pipeline(spark):
    context = registry.Context(dictionaries={"d": spark.createDataFrame([(1, "maize storage", "Storage")], "query_id long, query string, label string")})
    config = '{"columns": [{"step": "dictionary", "dictionary": "d", "output": "labels", "default": "None"}, {"step": "missing"}, {"step": "rename", "column": "labels", "mapping": {"Storage": "S"}}]}'
    with pytest.raises(KeyError):
        registry.run(corpus(spark), config, context)
    found = {r["doc_id"]: r["labels"] for r in registry.run(corpus(spark), config, context, on_error="skip").collect()}
    assert found == {1: ["S"], 2: ["S"], 3: ["None"], 4: ["None"], 5: ["S"]}


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "id long, tags array<string>")
    sinks.write_separated(rows, str(tmp_path / "s"))
    back = readers.read_csv(spark, str(tmp_path / "s"), sep=";").select("id", readers.parse_list(F.col("tags")).alias("t"))
    assert {(r["id"], tuple(r["t"])) for r in back.collect()} == {("1", ("a", "b")), ("2", ())}
    sinks.write_chunks(spark.range(10), str(tmp_path / "c"), 3)
    assert readers.read_folder(spark, [str(tmp_path / "c")]).count() == 10
    assert sinks.index_documents(rows, ["tags", "other"], "id").columns == ["id", "tags"]


def test_xml(spark, tmp_path):
    xml = "<articles><article><front><article-meta><title-group><article-title> T </article-title></title-group><abstract><p>A</p><p>B</p></abstract><kwd-group><kwd>k</kwd></kwd-group><pub-date><year>2001</year></pub-date><contrib-group><contrib><name><surname>Doe</surname><given-names>Ann</given-names></name></contrib></contrib-group></article-meta></front></article></articles>"
    (tmp_path / "a.xml").write_text(xml)
    row = readers.read_xml_articles(spark, str(tmp_path / "a.xml")).first()
    assert (row["title"], row["abstract"], row["keywords"], row["year"], row["authors"]) == ("T", "A B", "k", 2001, ["Doe Ann"])


def test_incremental(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(2):
        spark.createDataFrame([(i, "maize rice")], "doc_id long, text string").write.mode("append").parquet(folder)
        incremental.index_new_files(spark, folder, "doc_id long, text string", out, str(tmp_path / "check"))
    assert spark.read.parquet(out).where("term = 'maize'").count() == 2


def test_windowed_counts(spark, tmp_path):
    events = spark.sql("select timestamp'2024-01-01 00:10:00' as ts, 'a' as event_type")
    assert incremental.windowed_counts(events).first()["n"] == 1


def test_terms_are_those_of_the_column_form(spark):
    texts = ["The cities and boxes of UN 12ab women assesses NGOs", "É_1a _12ab 1_abc x9_ Us As AS s S", "kg\x0bies sses　menmen xes yes", "A" * 40 + "s", "", None, "ﬁn ǅa maize maize maize"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = df.select("doc_id", T.tokens(T.normalize_text(F.col("text"))).alias("words"))
    assert sorted(index.with_terms(df, ["doc_id"], F.col("text")).collect()) == sorted(words.collect())
    pairs = words.select("doc_id", F.explode(F.array_distinct(F.concat("words", index.neighbours(F.col("words"))))).alias("term"))
    assert sorted(index.build_terms(df).select("doc_id", "term").collect()) == sorted(pairs.collect())


def counted_postings(spark):
    """Postings of a small corpus, and a counter of the rows that were computed."""
    seen = spark.sparkContext.accumulator(0)

    def see(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(1, "maize"), (1, "token"), (2, "rice"), (2, "FAO"), (3, "rice"), (3, "maize"), (3, "food agriculture"), (3, "FAO"), (4, "franc")]
    posts = spark.createDataFrame(rows, "doc_id long, term string").select("term", "doc_id")
    return posts.mapInArrow(see, "term string, doc_id long"), seen, len(rows)


def test_an_exact_search_reads_the_index_once(spark):
    def names(*rows):
        return spark.createDataFrame(rows, "name string, code string")

    posts, seen, n = counted_postings(spark)
    vocabulary = index.build_vocabulary(posts)
    found = taxonomies.place_phases(posts, vocabulary, names(("Maize", "AA")), names(("rice", "BB")), names(("franc", "CC")), names(("maize", "GG")), ["token"], 1.0)
    assert sorted(map(tuple, found.collect())) == [(1, "AA", 0), (1, "GG", 3), (2, "BB", 1), (3, "AA", 0), (4, "CC", 2)]
    assert seen.value == n
    posts, seen, n = counted_postings(spark)
    meanings = spark.createDataFrame([("FAO", "rice", 1), ("FAO", "food agriculture", 2)], "abbr string, meaning string, place long")
    found = abbreviations.used_meanings(posts, index.build_vocabulary(posts), meanings, 1.0)
    assert sorted(map(tuple, found.collect())) == [(2, "FAO", "rice"), (3, "FAO", "rice")]
    assert seen.value == n


def test_populations_read_the_index_once(spark):
    posts, seen, n = counted_postings(spark)
    docs = spark.createDataFrame([(1, "maize token"), (3, "rice maize"), (4, "franc")], "doc_id long, text string")
    found = taxonomies.populations(docs, posts, index.build_vocabulary(posts), 1.0, farm_markers=["maize"], dictionaries={"Named": ["franc"]}, scales={"Scaled": ["token"]}, farms=("rice",))
    assert sorted(map(tuple, found.collect())) == [(1, "Scaled"), (2, "Farmers"), (3, "Farmers"), (4, "Named")]
    assert seen.value == n


def test_nearest_holds_few_scores_at_once(spark, monkeypatch):
    """A task's memory doesn't grow with a block of queries times a batch; ties at the last place go to the smaller id."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-1, 2, 3)]) for i in range(60)] + [(60, [0.0, 0.0, 0.0]), (61, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    unit = np.array([v for _, v in rows[:61]])
    unit = unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-300)
    score = np.round(unit @ unit.T, 12)
    wanted = {q: [i for _, i in sorted((-score[q, i], i) for i in range(61) if i != q)[:4]] for q in range(61)}
    sizes, best = [], vectors._best
    monkeypatch.setattr(vectors, "CELLS", 64)
    for lo in range(0, 61, 5):  # the scores of some queries at once
        sizes.append(best(np.arange(lo, min(61, lo + 5)), lo, score[lo : lo + 5].copy(), np.arange(61), 4))
    assert {q: [int(i) for qq, i in zip(np.concatenate([s[0] for s in sizes]), np.concatenate([s[2] for s in sizes]), strict=True) if qq == q] for q in range(61)} == wanted
    found = vectors.nearest(df, df, 4).orderBy("query_id", "place").collect()
    assert {q: [r["id"] for r in found if r["query_id"] == q] for q in range(61)} == wanted


@pytest.mark.parametrize("threshold", [0.92, 0.85, 0.6])
def test_similar_concepts_share_a_key(threshold):
    """Pairs within the threshold meet by a key, others with the same prefix seldom do."""
    rng = np.random.default_rng(5)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    similar = 0
    for _ in range(600):
        a = "prefi" + "".join(rng.choice(list("abc"), rng.integers(0, 45)))
        b = list(a)
        for _ in range(rng.integers(1, 5)):
            at = int(rng.integers(5, len(b) + 1))
            b[at : at + int(rng.integers(0, 2))] = "abc"[int(rng.integers(3))] * int(rng.integers(0, 2))
        b = "".join(b)
        if a != b and 1 - distance(a, b) / max(len(a), len(b)) >= threshold:
            similar += 1
            assert set(mining.probe_keys(a, threshold, 5)) & set(mining.own_keys(b, threshold, 5)), (a, b)
    assert similar > 20
    assert not set(mining.probe_keys("internationally", 0.92, 5)) & set(mining.own_keys("interdependence", 0.92, 5))
