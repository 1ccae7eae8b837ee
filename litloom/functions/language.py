"""English text by its function words, numbered forms, verb forms and topic scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.functions.lexicon import DROPPED, STOPWORDS, lemma
from litloom.functions.text import normalize_text, squeeze, tokens

#: Function words that other languages of the corpus do not share.
ENGLISH = sorted({*STOPWORDS, "to"} - {"a", "an", "as", "am", "in", "me", "on", "no", "so", "he", "i", "or", "do", "be", "will", "most", "his", "her", "same", "its", "all", "by"})


def is_english(text: Column, least: float = 0.12) -> Column:
    """Whether at least that share of the words are English function words; texts without a word are not."""
    words = F.filter(F.split(F.lower(text), r"[^a-z]+"), lambda w: w != "")
    share = F.transform(F.array(words), lambda ws: F.size(F.filter(ws, lambda w: w.isin(ENGLISH))) >= least * F.size(ws))
    return F.get(share, F.lit(0)) & text.rlike("[A-Za-z]")


def english_parts(text: Column, separator: str) -> Column:
    """The English parts between separators, put together again; the whole text if none is English."""
    parts = F.filter(F.split(text, f"\\Q{separator}\\E", -1), lambda p: is_english(p))
    kept = F.trim(F.array_join(parts, separator))
    return F.when(kept != "", kept).otherwise(text)


def only_english(text: Column, separator: str = ";") -> Column:
    """Of a text with the separator that is not English as a whole, its English parts."""
    return F.when(F.contains(text, F.lit(separator)) & ~is_english(text), english_parts(text, separator)).otherwise(text)


def stem(word: Column) -> Column:
    """A word without a common ending, by rule: the first that fits and leaves three letters."""
    out = None
    for ending, put in (("ational", "ate"), ("ization", "ize"), ("fulness", "ful"), ("iveness", "ive"), ("ing", ""), ("edly", ""), ("ed", ""), ("ly", ""), ("ment", ""), ("ness", "")):
        fits = F.endswith(word, F.lit(ending)) & (F.length(word) >= len(ending) + 3)
        cut = F.concat(F.substr(word, F.lit(1), F.length(word) - len(ending)), F.lit(put))
        out = F.when(fits, cut) if out is None else out.when(fits, cut)
    return out.otherwise(word)


def numbered_terms(text: Column) -> Column:
    """Words and numbers in lower case, without dropped words and single letters, in the singular and stemmed."""
    words = F.filter(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " "), lambda w: (w != "") & ~w.isin(DROPPED) & ((F.length(w) > 1) | w.rlike("^[0-9]$")))
    singular = F.transform(words, lemma)
    return F.transform(singular, stem)


def sorted_terms(text: Column) -> Column:
    return F.array_join(F.array_sort(tokens(normalize_text(text))), " ")


def has_verb_form(text: Column, verbs: list[str]) -> Column:
    """Any of the verbs, whole, as it is or in -s, -d, -ed, -ing, with or without a final e."""
    roots = "|".join(v.removesuffix("e") for v in verbs)
    return text.rlike(rf"\b(?:{roots})(?:e|es|s|ed|d|ing)?\b")


def common_score(phrases: DataFrame, ranks: DataFrame) -> DataFrame:
    """Columns phrase, score: the mean rank of a phrase's words (ranks: word, rank; unknown: 1), 0 without a word."""
    words = phrases.select("phrase").distinct().select("phrase", F.explode_outer(F.filter(F.split(squeeze(F.col("phrase")), " "), lambda w: w != "")).alias("word"))
    rank = F.when(F.col("word").isNotNull(), F.coalesce("rank", F.lit(1.0)))
    return words.join(ranks, "word", "left").groupBy("phrase").agg(F.coalesce(F.avg(rank), F.lit(0.0)).alias("score"))


def known_swaps(words: DataFrame, vocabulary: DataFrame, old: str = "s", new: str = "z") -> DataFrame:
    """Columns word, spelling: a long word with one letter swapped, where the index knows the result; of several the one swapped furthest right."""
    places = F.filter(F.sequence(F.lit(3), F.greatest(F.length("word") - 1, F.lit(3))), lambda i: F.substr(F.col("word"), i, F.lit(1)) == old)
    rows = words.select("word").distinct().where((F.length("word") > 5) & ~F.contains("word", F.lit(" "))).select("word", F.explode(places).alias("at"))
    made = rows.withColumn("term", F.concat(F.substr("word", F.lit(1), F.col("at") - 1), F.lit(new), F.substr("word", F.col("at") + 1)))
    return made.join(vocabulary.select("term"), "term", "left_semi").groupBy("word").agg(F.max_by("term", "at").alias("spelling"))


def phrased(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """Columns doc_id, phrased: terms of a text with neighbours that are a phrase (a, b) joined by an underscore, from the left.

    A term that has been joined to the one before does not start another phrase. docs: doc_id, text. The phrases of a text travel
    with it as a list, so the table of phrases joins by shuffle or broadcast as Spark sees fit.
    """
    words = docs.select("doc_id", tokens(normalize_text(F.col("text"))).alias("w"))
    pairs = words.select("doc_id", F.explode(F.array_distinct(F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), lambda a, b: F.struct(a.alias("a"), b.alias("b"))))).alias("p"))
    known = pairs.select("doc_id", "p.a", "p.b").join(phrases.select("a", "b").distinct(), ["a", "b"]).groupBy("doc_id").agg(F.collect_set(F.concat_ws("_", "a", "b")).alias("known"))
    start = F.struct(F.lit("").alias("out"), F.lit("").alias("last"))

    def add(acc: Column, word: Column) -> Column:
        joined = (acc["last"] != "") & F.array_contains("known", F.concat_ws("_", acc["last"], word))
        return F.struct(F.concat(acc["out"], F.when(joined, F.lit("_")).when(acc["out"] == "", F.lit("")).otherwise(F.lit(" ")), word).alias("out"), F.when(joined, F.lit("")).otherwise(word).alias("last"))

    rows = words.join(known, "doc_id", "left").withColumn("known", F.coalesce("known", F.array().cast("array<string>")))
    return rows.select("doc_id", F.when(F.size("known") > 0, F.aggregate("w", start, add, lambda acc: acc["out"])).otherwise(F.array_join("w", " ")).alias("phrased"))
