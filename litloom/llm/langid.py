"""Language identification by word-first backoff.

Known words score by their smoothed log frequency in each language. An unseen word backs off to its
longest character n-grams that the model knows (4, 3, 2, then 1, with word boundaries marked), whose log
frequencies it averages. A text's language is the one with the largest total over its words.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litloom.llm.storage import settle, small_batches

SAMPLE_DOCS = 20_000
LEAST_DOCS = 2_000
MOST_WORDS = 20_000
MOST_GRAMS = 10_000
SIZES = (4, 3, 2, 1)
SMOOTHING = 0.5
EVIDENCE = 24.0
UNKNOWN = "und"
WORDS = re.compile(r"[^\W\d_]+")
LETTERS = regex.compile(r"\p{L}+")
MEMO = 100_000


def held_out(id_: Column) -> Column:
    """True where crc32 of the id as text leaves no remainder by 5; null ids are not held out."""
    return F.coalesce(F.pmod(F.crc32(F.encode(id_.cast("string"), "UTF-8")), F.lit(5)) == 0, F.lit(False))


def counted_words(text: str | None) -> Counter[str]:
    """The runs of letters (\\p{L}) of a text in lower case; numerals such as a half or a superscript are no letters."""
    counts = Counter(WORDS.findall((text or "").lower()))
    for mixed in [w for w in counts if not w.isalpha()]:
        times = counts.pop(mixed)
        for word in LETTERS.findall(mixed):
            counts[word] += times
    return counts


Scores = tuple[list[str], np.ndarray]


class LanguageModel:
    """Per-language log frequencies of words and character n-grams: items, and a matrix with a row for each and a column for each language."""

    def __init__(self, languages: list[str], words: Scores, grams: Scores):
        self.languages = languages
        self.words, self.word_scores = words
        self.grams, self.gram_scores = grams
        self._gram_row = {g: i for i, g in enumerate(self.grams)}
        self._forget()

    def __getstate__(self):
        return self.languages, (self.words, self.word_scores), (self.grams, self.gram_scores)

    def __setstate__(self, state):
        self.__init__(*state)

    def _forget(self) -> None:
        self._row = {w: i for i, w in enumerate(self.words)}
        self._scores = np.zeros((len(self.words) + MEMO, len(self.languages)), np.float32)
        if self.words:
            self._scores[: len(self.words)] = self.word_scores

    def backoff(self, word: str) -> np.ndarray:
        marked, rows = f"^{word}$", self._gram_row
        for n in SIZES:
            found = [rows[g] for i in range(len(marked) - n + 1) if (g := marked[i : i + n]) in rows]
            if found:
                return self.gram_scores[found].mean(axis=0)
        return np.zeros(len(self.languages), np.float32)

    def _index(self, word: str) -> int:
        i = self._row.get(word)
        if i is None:
            if len(self._row) == len(self._scores):
                self._forget()
            i = self._row[word] = len(self._row)
            self._scores[i] = self.backoff(word)
        return i

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score (its share of the posterior, tempered for long texts); und, 0 without a letter."""
        counts = counted_words(text)
        if not counts or not self.languages:
            return UNKNOWN, 0.0
        total, n = np.zeros(len(self.languages)), 0
        words = list(counts)
        for lo in range(0, len(words), MEMO // 2):
            part = words[lo : lo + MEMO // 2]
            rows = self._rows(part)
            times = np.fromiter((counts[w] for w in part), np.float64, len(part))
            total += times @ self._scores[rows]
            n += times.sum()
        best = int(np.argmax(total))
        x = (total - total[best]) * min(1.0, EVIDENCE / n)
        return self.languages[best], float(1 / np.exp(x).sum())

    def _rows(self, words: list[str]) -> list[int]:
        if len(self._row) + len(words) > len(self._scores):
            self._forget()
        get = self._row.get
        return [i if (i := get(w)) is not None else self._index(w) for w in words]


def _table(counts: pd.DataFrame, languages: list[str]) -> Scores:
    """Smoothed log frequencies from rows (item, lang, n)."""
    row, items = pd.factorize(counts["item"], sort=True)
    wide = np.zeros((len(items), len(languages)))
    np.add.at(wide, (row, pd.Index(languages).get_indexer(counts["lang"])), counts["n"].to_numpy(float))
    totals = np.maximum(wide.sum(axis=0), 1.0)
    return list(items), np.log((wide + SMOOTHING) / (totals + SMOOTHING * len(wide))).astype(np.float32)


def _most_frequent(counts: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Of the rows (keys, item, n) of each key the `most` with the largest n, within chance of a draw.

    The cut follows from how many items have each n, so no task holds all items of a key. Of the items whose n is
    that of the cut, a hash of the item draws the share that there is room for.
    """
    down = Window.partitionBy(*keys).orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    steps = counts.groupBy(*keys, "n").agg(F.count(F.lit(1)).alias("items")).withColumn("before", F.coalesce(F.sum("items").over(down), F.lit(0)))
    cuts = steps.where(F.col("before") < most).groupBy(*keys).agg(F.min(F.struct("n", "items", "before")).alias("cut"))
    cuts = cuts.select(*keys, F.col("cut.n").alias("cut"), ((most - F.col("cut.before")) / F.col("cut.items")).alias("room"))
    draw = F.pmod(F.xxhash64(F.lit(9), "item"), F.lit(1 << 20)) / float(1 << 20)
    # One row for each language of the bounded sample, and size.
    return counts.join(F.broadcast(cuts), keys).where((F.col("n") > F.col("cut")) | ((F.col("n") == F.col("cut")) & (draw < F.col("room")))).drop("cut", "room")


def _cut(text: Column, size: int):
    """A function of one argument, as transform gives a second one the index."""
    return lambda start: F.substr(text, start, F.lit(size))


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, most_words: int = MOST_WORDS, most_grams: int = MOST_GRAMS) -> LanguageModel:
    """A model from the rows that are labelled and not held out.

    Fitted on about `sample_docs` of them (all, if there are fewer), drawn by a hash of the id, but on about LEAST_DOCS
    (`sample_docs`, if that is less) of each language or all that it has, so every labelled language is learned. It keeps
    about the `most_words` most frequent words and `most_grams` n-grams of each size and language, so model
    and driver memory are bounded; of those with the frequency at the bound a hash draws as many as there is room for.
    Null texts or languages teach nothing; without any labelled row the model has no language and predicts und.
    Rows that repeat an id are drawn together and each counts. The texts are read once.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & ~held_out(F.col("id")))
    least = F.lit(float(min(LEAST_DOCS, sample_docs)))
    # One row for each language; only ids and languages are read for it.
    by_lang = settle(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")))
    n = by_lang.agg(F.sum("docs").alias("n")).first()["n"] or 0
    if n > sample_docs:
        rates = by_lang.select("lang", F.greatest(F.lit(sample_docs / n), least / F.col("docs")).alias("rate"))
        draw = F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1 << 20)) / float(1 << 20)
        rows = rows.join(F.broadcast(rates), "lang").where(draw < F.col("rate")).drop("rate")
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != "")
    counts = settle(rows.where(F.col("text").isNotNull()).select("lang", F.explode(words).alias("item")).groupBy("lang", "item").agg(F.count(F.lit(1)).alias("n")))
    top = _most_frequent(counts, ["lang"], most_words)
    marked = F.concat(F.lit("^"), "item", F.lit("$"))
    grams = None
    for size in SIZES:
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - (size - 1), F.lit(1)))
        part = counts.select("lang", F.lit(size).alias("size"), "n", F.explode(F.transform(starts, _cut(marked, size))).alias("item"))
        grams = part if grams is None else grams.unionByName(part)
    grams = settle(grams.where(F.length("item") == F.col("size")).groupBy("lang", "size", "item").agg(F.sum("n").alias("n")))
    grams = _most_frequent(grams, ["lang", "size"], most_grams)
    top_words, top_grams = top.toPandas(), grams.select("lang", "size", "item", "n").toPandas()
    languages = sorted(set(top_grams["lang"]))
    tables = [_table(of_size, languages) for _, of_size in top_grams.groupby("size")]
    grams_ = [g for items, _ in tables for g in items], np.concatenate([np.zeros((0, len(languages)), np.float32), *(scores for _, scores in tables)])
    return LanguageModel(languages, _table(top_words, languages), grams_)


def predictor(spark, model: LanguageModel):
    """A function from a text column to struct(lang, score)."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.predict(t) for t in texts]
        return pd.DataFrame({"lang": [f[0] for f in found], "score": np.array([f[1] for f in found], float)})

    return run


def identify(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, held_out, lang_pred, score: one row per input row, whole texts; an empty table gives no rows."""
    guess = predictor(df.sparkSession, model)
    rows = df.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), guess(F.col(text_col)).alias("guess"))
    return rows.select("doc_id", "held_out", F.col("guess.lang").alias("lang_pred"), F.col("guess.score").alias("score"))


def accept(df: DataFrame, model: LanguageModel, text_col: str = "text", least_score: float = 0.5) -> DataFrame:
    """The rows, unchanged, whose text has a language with at least that score."""
    guess = predictor(df.sparkSession, model)(F.col(text_col))
    return df.where((guess["lang"] != UNKNOWN) & (guess["score"] >= least_score))
