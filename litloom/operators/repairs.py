"""Texts cleaned as a whole: the chain of cleaning steps, and words of a corpus that shout or are glued together put right."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.functions import repair
from litloom.functions import text as T
from litloom.functions.lexicon import DROPPED, STOPWORDS

#: The order in which titles and abstracts are cleaned.
CHAIN = (
    T.remove_unicode_symbols, repair.drop_leading_fragments, repair.drop_trailing_fragments, T.replace_braces, repair.drop_last_brackets, T.remove_html_tags, T.trim_marks, T.remove_copyright, T.trim_marks,
)
# Function words that are too often part of other words to be split off, and words that only look glued.
INNER_WORDS = "me he she her it am be do an or as at by up in out un on off over under all any no nor so don re ll ve ain ma shan down for".split()
EXCEPTIONS = ["beforehand", "profits", "hereinafter", "wholesome", "topics", "discours", "meanwhile", "goodwill", "forages", "foresters", "forage", "forester", "wellbeing"]
HEADS = [w for w in STOPWORDS if w not in INNER_WORDS and len(w) > 1]


def clean_text(text: Column) -> Column:
    """The whole chain. The input of each step is bound to a name of its own, since steps use it several times."""

    def bound(step):
        return lambda t: step(t)

    return reduce(lambda c, step: F.get(F.transform(F.array(c), bound(step)), F.lit(0)), CHAIN, text)


def word_fixes(vocabulary: DataFrame, heads: list[str] = HEADS, ratio: float = 3.0) -> DataFrame:
    """Columns word, fixed: shouted words in lower case, glued ones as two words."""
    loud = repair.shouted_words(vocabulary, ratio).select("word", F.lower("word").alias("fixed"))
    glued = repair.glued_words(vocabulary, heads).where(~F.col("word").isin(EXCEPTIONS))
    apart = F.when(F.startswith("word", F.col("head")), F.concat_ws(" ", "head", "rest")).otherwise(F.concat_ws(" ", "rest", "head"))
    return loud.unionByName(glued.groupBy("word").agg(F.min(apart).alias("fixed")))


def apply_fixes(df: DataFrame, fixes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`df` with the words of `fixes` (word, fixed) replaced in the text, and function words in capitals lower-cased.

    Only the fixes whose words a text holds travel to it, as a list; they are applied in order of letters.
    """
    words = df.select(F.col(id_col).alias("__id"), F.explode(F.array_distinct(F.split(T.fold_accents(F.col(text_col)), "[^A-Za-z0-9]+"))).alias("word"))
    loud = df.sparkSession.createDataFrame([(w.upper(), w.lower()) for w in DROPPED if len(w) > 1], "word string, fixed string")
    own = words.join(fixes.unionByName(loud).groupBy("word").agg(F.min("fixed").alias("fixed")), "word").groupBy("__id").agg(F.array_sort(F.collect_set(F.struct("word", "fixed"))).alias("__fixes"))
    whole = lambda w: F.concat(F.lit("(?<![A-Za-z0-9_])"), w, F.lit("(?![A-Za-z0-9_])"))
    fixed = F.aggregate("__fixes", F.col(text_col), lambda t, f: F.regexp_replace(t, whole(f["word"]), f["fixed"]))
    return df.join(own, F.col(id_col) == F.col("__id"), "left").withColumn(text_col, F.when(F.col("__fixes").isNotNull(), fixed).otherwise(F.col(text_col))).select(*df.columns)
