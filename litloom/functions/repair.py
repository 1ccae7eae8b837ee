"""Repairs of titles, abstracts, names and affiliations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.functions.lexicon import DROPPED
from litloom.functions.text import squeeze

# Sources whose articles count as science journals.
SCIENCE = ["Scopus", "CAB", "Econlit", "Proquest", "Web of Science", "Agricola", "ISI", "CABI", "African", "CLRTB_PHL"]
RANK_CAP = 5000


# What Java and RE2 read alike: white space and the borders of ASCII words. The end of a text is \z, since $ also stands before a last line break.
SPACES, BEFORE, AFTER = r"[\t\n\f\r ]+", "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
ONE_WORD = r"^[A-Za-z0-9_ -]*\z"


def _trimmed(text: Column) -> Column:
    """Without spaces of any width at the ends; line breaks and tabs stay."""
    return F.regexp_replace(text, r"^\p{Zs}+|\p{Zs}+\z", "")


def _words(text: Column) -> Column:
    return F.size(F.filter(F.split(_trimmed(squeeze(text)), " "), lambda w: w != ""))


def drop_leading_fragments(text: Column) -> Column:
    """Leading one-word parts between semicolons go, until a longer part or one that the next continues in lower case."""
    parts = F.split(text, ";")
    follows = F.concat(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")))
    kept = F.transform(F.arrays_zip(parts.alias("p"), follows.alias("n")), lambda z: ~(z["p"].rlike(ONE_WORD) & (_words(z["p"]) < 2)) | _trimmed(z["n"]).rlike("^[a-z]"))
    first = F.array_position(kept, True).cast("int")
    rest = F.when(first > 0, F.array_join(F.slice(parts, first, F.size(parts)), ";")).otherwise(F.lit(""))
    short = F.element_at(parts, 1).rlike(ONE_WORD) & (_words(F.element_at(parts, 1)) < 2)
    return F.when(F.contains(text, F.lit(";")) & short, _trimmed(rest)).otherwise(text)


def drop_trailing_fragments(text: Column) -> Column:
    """After a part that ends a sentence and is followed by a very short one, nothing is kept; before it, longer parts."""
    parts = F.split(text, ";")
    follows = F.concat(F.slice(parts, 2, F.size(parts)), F.array(F.lit("a b c")))
    ends = F.transform(F.arrays_zip(parts.alias("p"), follows.alias("n")), lambda z: _trimmed(z["p"]).rlike(r"[.]\z") & (_words(z["n"]) < 3))
    last = F.array_position(ends, True).cast("int")
    kept = F.filter(F.slice(parts, 1, last), lambda p: _words(p) > 3)
    return F.when(last > 0, F.array_join(kept, ";")).otherwise(text)


def _terms(text: Column) -> Column:
    """How many words of a text are index terms, roughly: no dropped ones, numbers or single letters."""
    return F.size(F.filter(F.split(text, "[^A-Za-z0-9_]+"), lambda w: (F.length(w) > 1) & ~w.rlike("^[0-9]") & ~F.lower(w).isin(DROPPED)))


def drop_last_brackets(text: Column) -> Column:
    """Square brackets at the end go with what they hold, from the last one back.

    Where less than two terms would be left the brackets are opened instead; more than two terms after a bracket keep it.
    """
    bracket = r"\[[^\n]*?\]"
    gaps, held = F.split(text, bracket, -1), F.regexp_extract_all(text, F.lit(bracket), F.lit(0))
    backwards = F.reverse(F.arrays_zip(F.slice(gaps, 1, F.size(held)).alias("gap"), held.alias("held")))
    # upto: length of the part not looked at yet; after: what is kept of the rest.
    start = F.struct((F.length(text) - F.length(F.element_at(gaps, -1))).alias("upto"), F.element_at(gaps, -1).alias("after"), F.lit(False).alias("opened"), F.lit(False).alias("done"))

    def step(acc: Column, part: Column) -> Column:
        before = F.substr(text, F.lit(1), acc["upto"] - F.length(part["held"]))
        bare = _terms(F.concat(before, acc["after"])) < 2
        kept = ~bare & (_terms(acc["after"]) > 2)
        further = F.struct((F.length(before) - F.length(part["gap"])).alias("upto"), F.concat(part["gap"], acc["after"]).alias("after"), F.lit(False).alias("opened"), F.lit(False).alias("done"))
        stopped = F.struct(acc["upto"].alias("upto"), acc["after"].alias("after"), bare.alias("opened"), F.lit(True).alias("done"))
        return F.when(acc["done"], acc).when(bare | kept, stopped).otherwise(further)

    def put(acc: Column) -> Column:
        whole = F.concat(F.substr(text, F.lit(1), acc["upto"]), acc["after"])
        return F.when(acc["opened"], _trimmed(F.translate(whole, "[]", "  "))).when(acc["upto"] + F.length(acc["after"]) == F.length(text), text).otherwise(_trimmed(whole))

    return F.when(F.size(held) > 0, F.aggregate(backwards, start, step, put)).otherwise(text)


def first_words(text: Column) -> Column:
    """Each word once, where it stands first."""
    return F.array_join(F.array_distinct(F.split(squeeze(text), " ")), " ")


def last_words(text: Column) -> Column:
    """Each word once, where it stands last."""
    return F.array_join(F.reverse(F.array_distinct(F.reverse(F.split(squeeze(text), " ")))), " ")


def dataset_type(dataset: Column) -> Column:
    return F.when(dataset.isin(SCIENCE), F.lit("Science Journals")).otherwise(F.lit("Grey Literature"))


def join_initials(text: Column, rounds: int | None = None) -> Column:
    """Runs of capitals between spaces as one abbreviation; with `rounds`, neighbours are joined two by two so many times."""
    if rounds is None:
        return F.regexp_replace(text, f"{BEFORE}([A-Z]+){SPACES}(?=[A-Z]+{AFTER})", "$1")
    for _ in range(rounds):
        text = F.regexp_replace(text, f"{BEFORE}([A-Z]+){SPACES}([A-Z]+){AFTER}", "$1$2")
    return text


def drop_brackets(text: Column) -> Column:
    """Round brackets go with what they hold, unless nothing else is left."""
    rest = F.trim(F.regexp_replace(text, r"\(.*?\)", ""))
    return squeeze(F.translate(F.when(rest != "", rest).otherwise(text), "()", ""))


def drop_articles(text: Column) -> Column:
    plain = F.regexp_replace(text, r"(?i)\b(a|the)\b", " ")
    return squeeze(F.regexp_replace(plain, r"""[-.!"#$%'()*+,/:;<>=?@\[\]\\^_`{}|~]+""", " "))


def word_ranks(words: DataFrame, ranks: DataFrame) -> DataFrame:
    """Columns word, rank (0 to 1): the least rank of the word's forms without endings, and for long words without prefixes."""
    w = F.col("word")
    forms = [w, F.regexp_replace(w, "ing$", ""), F.regexp_replace(w, "ing$", "e"), *[F.regexp_replace(w, f"{e}$", "") for e in ("s", "es", "ed", "d")]]
    prefixed = [F.when(F.length(w) >= 7, F.regexp_replace(w, f"^{p}", "")) for p in ("in", "un", "im", "ir", "sub")]
    known = words.select("word", F.explode(F.array_distinct(F.array(*forms, *prefixed))).alias("form")).join(ranks.select(F.col("word").alias("form"), "rank"), "form")
    best = known.groupBy("word").agg(F.min("rank").alias("rank"))
    return words.select("word").distinct().join(best, "word", "left").select("word", (F.least(F.coalesce("rank", F.lit(RANK_CAP)), F.lit(RANK_CAP)) / RANK_CAP).alias("rank"))


def shouted_words(vocabulary: DataFrame, ratio: float = 3.0) -> DataFrame:
    """Columns word: upper-case words whose lower-case form is more than `ratio` times as frequent."""
    single = vocabulary.where("n_tokens = 1")
    upper = single.where("upper(term) = term and lower(term) <> term and length(term) > 1 and not term rlike '[0-9]'").select(F.col("term").alias("word"), F.lower("term").alias("form"), F.col("df").alias("up"))
    lower = single.select(F.col("term").alias("form"), F.col("df").alias("low"))
    return upper.join(lower, "form").where(F.col("low") > ratio * F.col("up")).select("word")


def glued_words(vocabulary: DataFrame, heads: list[str], rare: int = 5, frequent: int = 70) -> DataFrame:
    """Columns word, head, rest: rare words that are a function word and a frequent one written together."""
    single = vocabulary.where("n_tokens = 1").select(F.col("term").alias("word"), "df")
    parts = single.where(F.col("df") <= rare).select("word", F.explode(F.array(*[F.lit(h) for h in heads])).alias("head"))
    rest = F.when(F.startswith("word", F.col("head")), F.substr("word", F.length("head") + 1)).when(F.endswith("word", F.col("head")), F.substr("word", F.lit(1), F.length("word") - F.length("head")))
    parts = parts.withColumn("rest", rest).where(F.length("rest") >= 4)
    return parts.join(single.where(F.col("df") > frequent).select(F.col("word").alias("rest")), "rest").select("word", "head", "rest")
