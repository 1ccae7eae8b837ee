"""Readers and writers of files: workbooks, text tables, exports and journal XML; configured steps."""

import pytest
from pyspark.sql import functions as F

from litloom.operators import repairs
from litloom.plans import registry
from litloom.sources import articles, workbook


def test_workbooks(spark, tmp_path):
    book = workbook.workbook({"Crops": (["name", "level"], [("maize & rice", 1), ("<wheat>", 2.5), (None, 3)]), "Empty": (["name"], []), "Other": (["level", "x"], [(7, "q")])})
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.xlsx").write_bytes(book)
    rows = {(r["sheet"], r["name"], r["level"]) for r in workbook.read_workbooks(spark, str(tmp_path), ["name", "level"]).collect()}
    assert rows == {("Crops", "maize & rice", "1"), ("Crops", "<wheat>", "2.5"), ("Crops", "", "3"), ("Other", "", "7")}
    report = workbook.report({"t": spark.createDataFrame([(1, ["a", "b"])], "id long, tags array<string>")})
    assert workbook.sheets(report) == {"t": [["id", "tags"], ["1", "a; b"]]} and workbook.as_base64(b"ab") == "YWI="
    with pytest.raises(ValueError):
        workbook.report({"t": spark.range(5)}, most=3)
    lists = workbook.list_columns(spark.createDataFrame([("a; b;;c",), ("",)], "tags string"), ["tags"]).collect()
    assert [r["tags"] for r in lists] == [["a", "b", "c"], []]


def test_text_tables(spark, tmp_path):
    (tmp_path / "u.csv").write_text("name,x\ncafé,\n", encoding="utf-8")
    (tmp_path / "l.csv").write_bytes("name,x\ncafé,1\n".encode("latin-1"))
    (tmp_path / "e.csv").write_text("name,x\n")
    for file, x in (("u.csv", ""), ("l.csv", "1")):
        assert [tuple(r) for r in articles.read_text_table(spark, str(tmp_path / file)).collect()] == [("café", x)]
    with pytest.raises(ValueError):
        articles.read_text_table(spark, str(tmp_path / "e.csv"))


def test_exports(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "deep" / "a.csv").write_bytes("AU\tTI\tPY\tSO\tAB\tGA\tDI\nDoe\tTitle é\t2015\tJ\tText\tRome\t10.1/2\n".encode("utf-16"))
    row = articles.read_exports(spark, str(tmp_path / "in")).first()
    assert (row["AU"], row["title"], row["year"], row["url"], row["raw_affiliation"], row["dataset"]) == ("Doe", "Title é", 2015, "https://doi.org/10.1/2", "Rome", "Science journals")


def test_journal_xml(spark, tmp_path):
    xml = """<set><article><front><journal-meta><journal-title-group><journal-title>J</journal-title></journal-title-group><publisher><publisher-name>P</publisher-name><publisher-loc>Rome</publisher-loc></publisher></journal-meta>
    <article-meta><article-id pub-id-type="doi">10.1/2</article-id><article-id pub-id-type="pmid">77</article-id><title-group><article-title> T </article-title></title-group>
    <abstract><p>A text.</p><p>KEYWORDS: maize; rice.</p></abstract><article-categories><subj-group subj-group-type="language"><subject>English</subject></subj-group><subj-group subj-group-type="heading"><subject>Soil</subject></subj-group></article-categories>
    <kwd-group><kwd>k</kwd></kwd-group><pub-date><year>2001</year></pub-date><contrib-group><contrib contrib-type="author"><name><surname>Doe</surname><given-names>Ann</given-names></name><email>d@x.y</email><aff>FAO</aff></contrib>
    <contrib contrib-type="editor"><name><surname>Ed</surname><given-names>It</given-names></name></contrib><contrib contrib-type="author"><collab>World Bank</collab></contrib></contrib-group><aff>WFP</aff><author-notes><corresp><email>c@x.y</email></corresp></author-notes></article-meta></front></article>
    <article><front><article-meta><title-group><article-title>Bare</article-title></title-group></article-meta></front></article></set>"""
    (tmp_path / "a.xml").write_text(xml)
    rows = {r["title"]: r for r in articles.read_journal_xml(spark, str(tmp_path / "a.xml")).collect()}
    r = rows["T"]
    assert (r["abstract"], r["keywords"], r["authors"], r["corporate_author"]) == ("A text.", ["k", "maize", "rice"], ["Doe Ann"], "World Bank")
    assert (r["affiliation"], r["first_author_affiliation"], r["email"]) == (["FAO", "WFP"], "FAO", ["d@x.y", "c@x.y"])
    assert (r["doi"], r["article_id"], r["subjects"], r["language"], r["journal"], r["publisher"], r["publisher_location"], r["year"]) == ("10.1/2", "10.1/2", ["Soil"], "English", "J", "P", "Rome", 2001)
    assert rows["Bare"]["authors"] == [] and rows["Bare"]["abstract"] == "" and rows["Bare"]["year"] is None


def test_cleaning_chain(spark):
    rows = [(1, "Report; The yield of maize [in French]"), (2, None), (3, "")]
    found = {r["doc_id"]: r["text"] for r in registry.run(spark.createDataFrame(rows, "doc_id long, text string"), [{"step": "normalize_text"}]).collect()}
    assert found == {1: "The yield of maize", 2: None, 3: ""}


def test_full_chain(spark):
    rows = [(i, "maize storage is good") for i in range(80)] + [(100, "MAIZE and thatmaize were FOR sale")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in registry.run(df, [{"step": "normalize_text", "full": True}]).collect()}
    assert found[100] == "maize and that maize were for sale" and found[3] == "maize storage is good"
    assert repairs.apply_fixes(df.limit(0), df.limit(0).select(F.col("text").alias("word"), F.col("text").alias("fixed"))).count() == 0


def test_steps(spark):
    df = spark.createDataFrame([(1, "Crops such as maize. The World Health Organization (WHO) met.", 0.5), (2, None, 0.05)], "doc_id long, text string, p double")
    crops = spark.createDataFrame([("Plant", "Cereal", "maize")], "level_3 string, broad string, narrow string")
    steps = [{"step": "crops", "dictionary": "c", "output": "crops", "threshold": 1.0}, {"step": "hyponyms"}, {"step": "abbreviations"}, {"step": "priority", "probability": "p"}, {"step": "entities"}, {"step": "population", "threshold": 1.0}]
    found = {r["doc_id"]: r for r in registry.run(df, steps, registry.Context(dictionaries={"c": crops})).collect()}
    assert found[1]["crops"] == ["Plant/", "Plant/Cereal"] and found[1]["crops_details"] == ["maize"] and found[2]["crops"] == []
    assert [(p["narrow"], p["broad"]) for p in found[1]["hyponyms"]] == [("maize", "crop")] and found[2]["hyponyms"] == []
    assert [p["abbr"] for p in found[1]["abbreviations"]] == ["WHO"] and (found[1]["priority"], found[2]["priority"]) == ("More likely", "Unlikely")
    assert "The World Health Organization" in found[1]["entities"] and found[1]["population tags"] == []


def test_more_steps(spark):
    rows = [(1, "A comparison of maize and wheat. The yield rose by 12 tons of maize. Results improved income.", "Dept of Soil, University of Rome, Rome, Italy; FAO, Rome, Italy"), (2, None, None), (3, "loan credit", "Univ of Rome, Rome, Italy")]
    df = spark.createDataFrame(rows, "doc_id long, text string, raw_affiliation string")
    examples = spark.createDataFrame([("maize wheat yield tons", 0), ("loan credit bank", 1)] * 4, "text string, label int")
    steps = [
        {"step": "affiliations"}, {"step": "measurements", "concepts": ["maize", "income"]}, {"step": "comparisons"}, {"step": "outcomes", "patterns": {"Income": "(?i)income"}},
        {"step": "classify", "examples": "e"}, {"step": "topics", "k": 2, "iterations": 2}, {"step": "missing", "apply": False},
    ]
    found = {r["doc_id"]: r for r in registry.run(df, steps, registry.Context(dictionaries={"e": examples})).collect()}
    assert found[1]["affiliations"] == ["FAO", "University of Rome"] and found[2]["affiliations"] == []
    assert found[1]["measurements"] == ["maize"] and found[1]["compared_terms"] == ["maize | wheat"] and found[2]["compared_terms"] == []
    assert found[1]["outcomes"] == ["Income"] and found[1]["outcomes_details"] == ["[Income] Results improved income."]
    assert (found[1]["class"], found[3]["class"]) == (0, 1) and isinstance(found[2]["topics"], list)
