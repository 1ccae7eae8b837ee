"""Labelling documents by dictionaries, hierarchies, rules and proximity, on top of search hits.

Dictionaries are tables the user brings; they join as tables, so Spark broadcasts them only below its
size threshold. Outputs are long (one row per document and label); `as_lists` folds them into sorted lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.functions.text import normalize_text, tokens


def dictionary_labels(hits: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Columns doc_id, label from hits (query_id, doc_id) and dictionary (query_id, label)."""
    return hits.join(dictionary.select("query_id", "label"), "query_id").select("doc_id", "label").distinct()


def hierarchy_paths(hits: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Columns doc_id, path: class/middle/name and class/middle/ from dictionary (query_id, class, middle, name).

    Middles that are empty or "other" have no path of their own.
    """
    found = hits.join(dictionary, "query_id")
    full = F.concat_ws("/", "class", "middle", "name")
    parent = F.when(~F.col("middle").isin("", "other"), F.concat(F.concat_ws("/", "class", "middle"), F.lit("/")))
    paths = found.select("doc_id", F.explode(F.array(full, parent)).alias("path"))
    return paths.where(F.col("path").isNotNull()).distinct()


def merge_siblings(names: DataFrame, generic: list[str]) -> DataFrame:
    """Columns name, searched: names whose siblings (same words before the last) all end in generic words are
    searched together as "<stem> intervention"; others as themselves."""
    words = F.split("name", " ")
    stem = F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), " ")
    rows = names.select("name", stem.alias("stem"), F.element_at(words, -1).isin(generic).alias("generic"))
    together = rows.groupBy("stem").agg(F.bool_and("generic").alias("every"), F.count(F.lit(1)).alias("n")).withColumn("merged", F.col("every") & (F.col("n") > 1) & (F.col("stem") != ""))
    return rows.join(together, "stem").select("name", F.when(F.col("merged"), F.concat("stem", F.lit(" intervention"))).otherwise(F.col("name")).alias("searched"))


def rename_values(lists: Column, mapping: dict[str, str]) -> Column:
    """A list with values renamed and without repeats; unknown ones stay."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.array_sort(F.array_distinct(F.transform(lists, lambda v: F.coalesce(F.element_at(table, v), v))))


def rule_labels(hits: DataFrame, labels: DataFrame, rules: DataFrame) -> DataFrame:
    """Columns doc_id, label: all keywords of a rule match, and the document has a label that the rule wants.

    rules: rule_id, query_id, wanted, label, a row for each keyword.
    """
    sizes = rules.groupBy("rule_id", "wanted", "label").agg(F.countDistinct("query_id").alias("n"))
    matched = hits.join(rules.select("rule_id", "query_id").distinct(), "query_id").groupBy("rule_id", "doc_id").agg(F.countDistinct("query_id").alias("got"))
    full = matched.join(sizes, "rule_id").where("got = n")
    have = labels.select("doc_id", F.col("label").alias("has"))
    return full.join(have, (full["doc_id"] == have["doc_id"]) & (full["wanted"] == have["has"])).select(full["doc_id"], full["label"]).distinct()


def with_default(docs: DataFrame, labels: DataFrame, default: str) -> DataFrame:
    """Columns doc_id, label: every document's labels, or the default where it has none."""
    return docs.select("doc_id").join(labels, "doc_id", "left").select("doc_id", F.coalesce("label", F.lit(default)).alias("label"))


def phased(docs: DataFrame, phases: list[DataFrame]) -> DataFrame:
    """Columns doc_id, value, phase: the values of the first phase that gives a document any."""
    tagged = None
    for i, part in enumerate(phases):
        rows = part.select("doc_id", "value", F.lit(i).alias("phase"))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    best = tagged.groupBy("doc_id").agg(F.min("phase").alias("best"))
    found = tagged.join(best, "doc_id").where("phase = best").select("doc_id", "value", "phase").distinct()
    return docs.select("doc_id").join(found, "doc_id", "inner")


def proximity(text: Column, markers: list[str], modifiers: list[str], reach: int = 5) -> Column:
    """Whether a modifier term stands within `reach` terms of a marker term."""
    words = tokens(normalize_text(text))
    places = lambda wanted: F.filter(F.transform(words, lambda w, i: F.when(w.isin(wanted), i)), lambda i: i.isNotNull())
    return F.exists(places(markers), lambda m: F.exists(places(modifiers), lambda d: F.abs(m - d) <= reach))


def as_lists(labels: DataFrame, column: str = "label") -> DataFrame:
    return labels.groupBy("doc_id").agg(F.array_sort(F.collect_set(column)).alias(column))
