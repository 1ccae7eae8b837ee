"""Numbers and the concepts they measure; sentences by label; comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.functions.text import sentences


def closest_concepts(df: DataFrame, concepts: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, place, number, concept, distance: for each number of a sentence the nearest one-word concept in words.

    Ties go to the concept that stands first.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.posexplode(sentences(F.col(text_col))).alias("place", "s"))
    words = F.filter(F.split(F.lower("s"), "[^a-z0-9]+"), lambda w: w != "")
    rows = rows.select("doc_id", "place", words.alias("w")).where(F.exists("w", lambda w: w.isin(concepts)))
    marked = F.transform("w", lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    rows = rows.select("doc_id", "place", F.filter(marked, lambda x: x["w"].rlike("^[0-9]")).alias("numbers"), F.filter(marked, lambda x: x["w"].isin(concepts)).alias("found"))
    rows = rows.select("doc_id", "place", "found", F.explode("numbers").alias("n"))
    nearest = F.array_min(F.transform("found", lambda c: F.struct(F.abs(c["i"] - F.col("n.i")).alias("distance"), c["i"].alias("i"), c["w"].alias("concept"))))
    return rows.select("doc_id", "place", F.col("n.w").alias("number"), nearest.alias("b")).select("doc_id", "place", "number", "b.concept", "b.distance")


def label_sentences(df: DataFrame, scores: dict[str, Column], threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, label, details: labels whose score reaches the threshold in a sentence, with those sentences.

    scores: label to a score of the column `sentence`; any model that gives a column fits in.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.posexplode(sentences(F.col(text_col))).alias("place", "sentence"))
    given = F.filter(F.array(*[F.when(score >= threshold, F.lit(label)) for label, score in scores.items()]), lambda x: x.isNotNull())
    rows = rows.select("doc_id", "place", "sentence", F.explode(given).alias("label"))
    return rows.groupBy("doc_id", "label").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "sentence"))), lambda s: s["sentence"]).alias("details"))


def priority(probability: Column) -> Column:
    return F.when(probability < 0.1, F.lit("Unlikely")).when(probability < 0.4, F.lit("Less likely")).otherwise(F.lit("More likely"))


def comparisons(sentence: Column) -> Column:
    """Array of (a, b): what a sentence compares."""
    noun = r"([A-Za-z-]+(?: [A-Za-z-]+)?)"
    found = []
    for pattern in (rf"comparison (?:of|between) {noun} (?:and|with) {noun}", rf"compared? {noun} (?:with|to|and) {noun}", rf"difference between {noun} and {noun}"):
        a, b = (F.regexp_extract_all(sentence, F.lit(pattern), F.lit(g)) for g in (1, 2))
        found.append(F.zip_with(a, b, lambda x, y: F.struct(F.lower(x).alias("a"), F.lower(y).alias("b"))))
    return F.concat(*found)
