"""Set-at-a-time search: all queries against the index in one plan.

A query is a phrase; its grams are the phrase itself up to two terms, else its pairs of neighbours. A document
matches when every gram has a spelling in it. Spellings come from the query itself, from s/z swaps that
the index knows, and from index terms with the same first three letters within an edit similarity, unless
they are too frequent beside the query's own term.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.functions.text import normalize_text, similarity, spelling_swaps, tokens

EXACT = 0.99
FREQUENT = 4


def query_grams(queries: DataFrame, id_col: str = "query_id", text_col: str = "query") -> DataFrame:
    """Columns query_id, n_grams, place, gram. Queries without a term have none and match nothing."""
    words = tokens(normalize_text(F.col(text_col)))
    rows = queries.select(F.col(id_col).alias("query_id"), words.alias("w"))
    pairs = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    grams = F.when(F.size("w") > 2, pairs).when(F.size("w") > 0, F.array(F.array_join("w", " ")))
    return rows.withColumn("g", grams).select("query_id", F.size("g").alias("n_grams"), F.posexplode("g").alias("place", "gram"))


def expand(grams: DataFrame, vocabulary: DataFrame | None, threshold: float = 0.85, frequent: int = FREQUENT) -> DataFrame:
    """Spellings of each gram in the index: grams' columns and term. Without a vocabulary an exact search gives all seeds, known or not.

    An equi-join on the first three letters and on each admissible length bounds the edit distances to compute; frequency
    is tested first.
    """
    gram = F.col("gram")
    program = F.array(F.replace(gram, F.lit("programme"), F.lit("program")), F.regexp_replace(gram, r"program(?!me)", "programme"), F.replace(gram, F.lit(" "), F.lit("")))
    seeds = grams.withColumn("seed", F.explode(F.array_distinct(F.concat(F.array(gram), program, spelling_swaps(gram)))))
    if threshold >= EXACT and vocabulary is None:
        return seeds.select(*grams.columns, F.col("seed").alias("term")).distinct()
    known = vocabulary.select("term", "prefix3", "df")
    exact = seeds.join(known, F.col("seed") == F.col("term")).select(*grams.columns, "term")
    if threshold >= EXACT:
        return exact.distinct()
    own = grams.join(known.select(F.col("term").alias("gram"), F.col("df").alias("own_df")), "gram", "left").where(F.length("gram") >= 3)
    n = F.length("gram")
    lengths = F.sequence(F.ceil(n * threshold - 1e-9).cast("int"), F.floor(n / threshold + 1e-9).cast("int"))
    keyed = own.withColumn("prefix3", F.substr("gram", F.lit(1), F.lit(3))).withColumn("size", F.explode(lengths))
    near = keyed.join(known.withColumn("size", F.length("term")), ["prefix3", "size"])
    near = near.where(F.coalesce(F.col("df") < frequent * F.col("own_df"), F.lit(True)) | (F.col("term") == F.col("gram")))
    near = near.where(similarity(F.col("gram"), F.col("term")) >= threshold)
    return exact.unionByName(near.select(*grams.columns, "term")).distinct()


def search(queries: DataFrame, postings: DataFrame, vocabulary: DataFrame | None, threshold: float = 0.85, id_col: str = "query_id", text_col: str = "query") -> DataFrame:
    """Columns query_id, doc_id: documents in which every gram of the query has a spelling.

    An exact search needs no vocabulary, and takes rows (term, doc_id) that repeat.
    """
    spelled = expand(query_grams(queries, id_col, text_col), None if threshold >= EXACT else vocabulary, threshold)
    return matched(spelled, postings)


def matched(spelled: DataFrame, postings: DataFrame) -> DataFrame:
    """Columns query_id, doc_id: documents with a spelling of every gram. spelled: query_id, n_grams, place, term."""
    hits = spelled.join(postings, "term").select("query_id", "n_grams", "place", "doc_id").distinct()
    return hits.groupBy("query_id", "n_grams", "doc_id").agg(F.count(F.lit(1)).alias("found")).where("found = n_grams").select("query_id", "doc_id")


def search_all(hits: DataFrame, groups: DataFrame) -> DataFrame:
    """AND: groups (group_id, query_id); documents that match all queries of a group."""
    sizes = groups.groupBy("group_id").agg(F.countDistinct("query_id").alias("wanted"))
    found = hits.join(groups, "query_id").groupBy("group_id", "doc_id").agg(F.countDistinct("query_id").alias("got"))
    return found.join(sizes, "group_id").where("got = wanted").select("group_id", "doc_id")


def search_any(hits: DataFrame, groups: DataFrame) -> DataFrame:
    return hits.join(groups, "query_id").select("group_id", "doc_id").distinct()


def search_without(hits: DataFrame, wanted: int, unwanted: int) -> DataFrame:
    """Documents of one query that another does not match."""
    gone = hits.where(F.col("query_id") == unwanted).select("doc_id")
    return hits.where(F.col("query_id") == wanted).select("doc_id").join(gone, "doc_id", "left_anti")


def wildcard(patterns: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Single terms that match a pattern such as `stor*` (a star stands for letters): columns of patterns and term.

    Patterns start with a letter, so a join on their first letter narrows the terms to be tested.
    """
    rule = F.concat(F.lit("^"), F.regexp_replace("pattern", r"\*", "[A-Za-z0-9]*"), F.lit("$"))
    keyed = patterns.withColumns({"rule": rule, "letter": F.substr("pattern", F.lit(1), F.lit(1))})
    single = vocabulary.where("n_tokens = 1").select("term", "df", F.substr("term", F.lit(1), F.lit(1)).alias("letter"))
    return keyed.join(single, "letter").where("term rlike rule").drop("letter", "rule")
