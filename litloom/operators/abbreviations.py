"""Abbreviations of a corpus: their meanings, which of them a document uses, and queries and texts rewritten by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litloom.functions.text import is_abbreviation, similarity, subexpressions
from litloom.operators import search
from litloom.storage import follow, settle, tabled

#: A bracketed abbreviation and the words before it.
BRACKETED = r"((?:[A-Za-z-]+ ){1,12})\(([A-Z]{2,10})s?\)"


def _formed(window: Column, abbr: Column) -> Column:
    """Whether the first letters of the words, one or two of each, spell the abbreviation."""
    first = lambda n: F.transform(window, lambda w: F.when(is_abbreviation(w), F.lower(w)).otherwise(F.lower(F.substr(w, F.lit(1), F.lit(n)))))
    letter = lambda w: F.concat(F.lower(F.substr(w, F.lit(1), F.lit(1))), F.when(F.length(w) > 1, F.concat(F.lit("(?:"), F.lower(F.substr(w, F.lit(2), F.lit(1))), F.lit(")?"))).otherwise(F.lit("")))
    spelled = F.array_join(F.transform(window, lambda w: F.when(is_abbreviation(w), F.lower(w)).otherwise(letter(w))), r"\w?")
    loose = F.concat(F.lit("^"), F.regexp_replace(F.lower(abbr), "([a-z])", r"$1\\w?"))
    return F.rlike(F.lower(abbr), F.concat(F.lit("^"), spelled, F.lit("$"))) | F.rlike(F.array_join(first(1), ""), loose) | F.rlike(F.array_join(first(2), ""), loose)


def meaning_of(words: Column, abbr: Column) -> Column:
    """The words before a bracket that the abbreviation in it stands for, null if there are none.

    Windows of as many words as letters come first, then of one and two more, then of fewer; each ends at the bracket or
    up to two words before it. A meaning does not hold the abbreviation itself.
    """
    n = F.length(abbr)
    sizes = F.concat(F.array(n, n + 1, n + 2), F.when(n > 2, F.sequence(n - 1, F.lit(2), F.lit(-1))).otherwise(F.array().cast("array<int>")))

    def windows(size: Column) -> Column:
        return F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda offset: F.slice(words, F.greatest(F.size(words) - offset - size + 1, F.lit(1)), F.greatest(F.least(size, F.size(words) - offset), F.lit(0))))

    fits = F.filter(F.flatten(F.transform(sizes, windows)), lambda w: (F.size(w) > 1) & _formed(w, abbr))
    text = F.array_join(F.get(fits, F.lit(0)), " ")
    return F.when(~F.contains(text, abbr) & ~F.contains(text, F.lower(abbr)), text)


def bracketed(text: Column) -> Column:
    """Array of (abbr, meaning) of a text: the bracketed abbreviations that the words before them spell."""
    before, short = (F.regexp_extract_all(text, F.lit(BRACKETED), F.lit(g)) for g in (1, 2))
    words = lambda b: F.filter(F.split(F.trim(b), " "), lambda w: w != "")
    pairs = F.zip_with(before, short, lambda b, a: F.struct(a.alias("abbr"), meaning_of(words(b), a).alias("meaning")))
    return F.filter(pairs, lambda p: p["meaning"].isNotNull())


def discover(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Columns abbr, meaning, n: how often each bracketed abbreviation stands for what before it. Null texts hold none."""
    found = df.where(F.col(text_col).rlike(BRACKETED)).select(F.explode(bracketed(F.col(text_col))).alias("p")).select("p.abbr", "p.meaning")
    return found.groupBy("abbr", "meaning").agg(F.count(F.lit(1)).alias("n"))


def resolve(found: DataFrame) -> DataFrame:
    """Columns abbr, meaning, n, place: similar meanings of an abbreviation merged into the most frequent one.

    Meanings stand by n, length and letters; each follows the first similar one before it (edits, case, or a longer form
    of it). A meaning with "program" is listed with "programme" too, and the other way round.
    """
    order = Window.partitionBy("abbr").orderBy(F.desc("n"), F.length("meaning"), "meaning")
    rows = found.withColumn("place", F.row_number().over(order))
    x, y = rows.alias("x"), rows.alias("y")
    alike = (similarity(F.col("y.meaning"), F.col("x.meaning")) > 0.85) | (F.lower("y.meaning") == F.lower("x.meaning")) | F.startswith(F.col("x.meaning"), F.col("y.meaning"))
    pairs = x.join(y, (F.col("x.abbr") == F.col("y.abbr")) & (F.col("y.place") < F.col("x.place")) & alike)
    key = lambda r: F.struct(F.col(f"{r}.abbr").alias("abbr"), F.col(f"{r}.meaning").alias("meaning"))
    best = pairs.groupBy(key("x").alias("source")).agg(F.min_by(key("y"), F.col("y.place")).alias("target"))
    own = rows.select(F.struct("abbr", "meaning").alias("source"), "n")
    links = follow(own.join(best, "source", "left").select("source", F.coalesce("target", "source").alias("target")))
    merged = links.join(own, "source").groupBy("target").agg(F.sum("n").alias("n"))
    text = F.col("target.meaning")
    forms = F.array_distinct(F.array(F.regexp_replace(text, r"\bprogramme\b", "program"), F.regexp_replace(text, r"\bprogram\b", "programme")))
    listed = merged.select(F.col("target.abbr").alias("abbr"), F.explode(forms).alias("meaning"), "n").groupBy("abbr", "meaning").agg(F.max("n").alias("n"))
    return listed.withColumn("place", F.row_number().over(order).cast("long"))


def abbreviations_of(meanings: DataFrame) -> DataFrame:
    """Columns meaning, abbr, n, place: the inverse, by n, then letters."""
    return meanings.select("meaning", "abbr", "n").withColumn("place", F.row_number().over(Window.partitionBy("meaning").orderBy(F.desc("n"), "abbr")).cast("long"))


def used_meanings(postings: DataFrame, vocabulary: DataFrame, meanings: DataFrame, threshold: float = 0.92) -> DataFrame:
    """Columns doc_id, abbr, meaning: what an abbreviation means in each document that holds it.

    That is the most frequent of its meanings that the document holds too; with none of them, the first of the corpus.
    """
    queries = meanings.select(F.xxhash64("meaning").alias("query_id"), F.col("meaning").alias("query")).distinct()
    vocabulary = None if threshold >= search.EXACT else vocabulary
    # The index is read once, for the terms of the meanings and the abbreviations.
    spelled = tabled(search.expand(search.query_grams(queries), vocabulary, threshold))
    wanted = tabled(spelled.select("term").unionByName(meanings.select(F.col("abbr").alias("term"))))
    postings = settle(postings.join(wanted, "term", "left_semi"))
    held = search.matched(spelled, postings)
    holders = postings.join(meanings.select(F.col("abbr").alias("term")).distinct(), "term").select("doc_id", F.col("term").alias("abbr"))
    offered = holders.join(meanings.select("abbr", "meaning", "place"), "abbr").withColumn("query_id", F.xxhash64("meaning"))
    offered = offered.join(held.withColumn("here", F.lit(0)), ["query_id", "doc_id"], "left")
    best = F.min_by("meaning", F.struct(F.coalesce("here", F.lit(1)).alias("here"), "place"))
    return offered.groupBy("doc_id", "abbr").agg(best.alias("meaning"))


def rewrite_queries(queries: DataFrame, meanings: DataFrame, least: int = 15, depth: int = 2) -> DataFrame:
    """Columns query_id, query: each query and its variants, with abbreviations in full and meanings abbreviated.

    Every run of words that is an abbreviation or a meaning is replaced, and the results again, up to `depth` times. Of an
    ambiguous abbreviation, meanings with less than `least` mentions are passed over.
    """
    many = meanings.groupBy("abbr").agg(F.count(F.lit(1)).alias("many"))
    used = meanings.join(many, "abbr").where((F.col("many") == 1) | (F.col("n") >= least))
    swaps = used.select(F.col("abbr").alias("old"), F.col("meaning").alias("new")).unionByName(used.select(F.col("meaning").alias("old"), F.col("abbr").alias("new"))).distinct()
    padded = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    found = last = queries.select("query_id", "query")
    for _ in range(depth):
        runs = last.select("query_id", "query", F.explode(F.array_distinct(subexpressions(F.col("query")))).alias("old"))
        new = F.trim(F.replace(padded(F.col("query")), padded(F.col("old")), padded(F.col("new"))))
        last = runs.join(swaps, "old").select("query_id", new.alias("query")).distinct()
        found = found.unionByName(last)
    return found.distinct()


def spell_out(text: Column, pairs: Column) -> Column:
    """A text with each abbreviation of `pairs` (array of abbr, meaning) shown as "meaning (ABBR)", the longest first."""
    ordered = F.array_sort(F.transform(pairs, lambda p: F.struct((-F.length(p["abbr"])).alias("order"), p["abbr"].alias("abbr"), p["meaning"].alias("meaning"))))
    marked = F.transform(ordered, lambda p, i: F.struct(p["abbr"].alias("abbr"), p["meaning"].alias("meaning"), F.char(57344 + i).alias("mark")))
    masked = F.aggregate(marked, text, lambda t, p: F.regexp_replace(t, F.concat(F.lit(r"\b"), p["abbr"], F.lit(r"\b")), p["mark"]))
    return F.aggregate(marked, masked, lambda t, p: F.replace(t, p["mark"], F.concat(p["meaning"], F.lit(" ("), p["abbr"], F.lit(")"))))
