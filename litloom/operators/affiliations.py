"""Clusters of affiliations and their canonical names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.functions.affiliation import comparing_form, is_acronym, same_institution, same_place
from litloom.storage import follow


def _canonical(rows: DataFrame, block: list[str], alike: Column, rare: int | None = None) -> DataFrame:
    """Columns name, canonical: within a block each name follows the most frequent similar one before it (by n, then letters).

    Blocks keep similar names together and are bounded by the first letters of names; the join is skew-safe, since only pairs
    that pass `alike` go on.
    """
    x, y = rows.alias("x"), rows.alias("y")
    before = (F.col("y.n") > F.col("x.n")) | ((F.col("y.n") == F.col("x.n")) & (F.col("y.name") < F.col("x.name")))
    same = before & alike if rare is None else before & alike & (F.col("x.n") < rare)
    for c in block:
        same = same & F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    pairs = x.join(y, same).select(F.col("x.name").alias("source"), F.col("y.n").alias("n"), F.col("y.name").alias("target"))
    best = pairs.groupBy("source").agg(F.min_by("target", F.struct((-F.col("n")).alias("n"), "target")).alias("target"))
    links = rows.select(F.col("name").alias("source")).join(best, "source", "left").select("source", F.coalesce("target", "source").alias("target"))
    return follow(links).select(F.col("source").alias("name"), F.col("target").alias("canonical"))


def cluster(affiliations: DataFrame, rare: int = 100) -> DataFrame:
    """Columns name, canonical from (name, country, n): names of fewer than `rare` mentions follow similar ones of their country.

    Names meet within a country and the first letter of their comparing form; acronyms only follow equal ones. A canonical
    name without the word that a member ends in "... Foundation" with gets that word.
    """
    form = comparing_form(F.col("name"))
    rows = affiliations.select("name", "country", F.col("n").cast("long").alias("n"), form.alias("form"), is_acronym(F.col("name")).alias("acronym"))
    rows = rows.withColumn("letter", F.substr(F.col("form"), F.lit(1), F.lit(1)))
    both = F.col("x.acronym") & F.col("y.acronym")
    alike = F.when(both, F.replace(F.col("x.name"), F.lit(" "), F.lit("")) == F.replace(F.col("y.name"), F.lit(" "), F.lit(""))).otherwise(same_institution(F.col("x.form"), F.col("y.form")))
    found = _canonical(rows, ["country", "letter"], alike, rare)
    has = lambda c: F.contains(F.lower(c), F.lit("foundation"))
    renamed = found.groupBy("canonical").agg(F.max(has(F.col("name")) & F.contains(F.lower("name"), F.lower("canonical"))).alias("member"))
    shown = F.when(F.col("member") & ~has(F.col("canonical")), F.concat("canonical", F.lit(" Foundation"))).otherwise(F.col("canonical"))
    return found.join(renamed, "canonical").select("name", shown.alias("canonical"))


def merge_in_city(affiliations: DataFrame, threshold: float = 0.88) -> DataFrame:
    """Columns name, canonical from (name, city, n): names of a city that are close, by the looser comparison."""
    rows = affiliations.where("coalesce(city, '') <> ''").select("name", "city", F.col("n").cast("long").alias("n"))
    return _canonical(rows, ["city"], same_place(F.col("x.name"), F.col("y.name"), threshold))


def institution_words(names: DataFrame, stems: list[str]) -> DataFrame:
    """Columns stem, word, n: the most frequent word that starts with each stem (ties by letters)."""
    words = names.select(F.explode(F.split(comparing_form(F.col("name")), " ")).alias("word"))
    stem = F.coalesce(*[F.when(F.startswith(F.col("word"), F.lit(s)), F.lit(s)) for s in stems])
    counts = words.withColumn("stem", stem).where("stem is not null").groupBy("stem", "word").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.struct("word", "n"), F.struct((-F.col("n")).alias("n"), "word"))
    return counts.groupBy("stem").agg(best.alias("b")).select("stem", "b.word", "b.n")
