"""Places in documents: gazetteer look-up, roll-up to countries and regions, affiliations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.functions.text import normalize_text, tokens


def mentions(postings: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Columns doc_id, kind, name, country of places whose names are index terms.

    gazetteer: name, kind (country, province or district), country. A district or province adds its country.
    """
    named = gazetteer.withColumn("term", F.array_join(tokens(normalize_text(F.col("name"))), " ")).where("term <> ''")
    found = postings.join(named, "term").select("doc_id", "kind", "name", "country")
    above = found.where("kind <> 'country'").select("doc_id", F.lit("country").alias("kind"), F.col("country").alias("name"), "country")
    return found.unionByName(above).distinct()


def paths(found: DataFrame) -> DataFrame:
    """Columns doc_id, path: Country/Province for everything below a country."""
    return found.where("kind <> 'country'").select("doc_id", F.concat_ws("/", "country", "name").alias("path")).distinct()


def regions(found: DataFrame, mapping: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Columns doc_id, region: of all countries (mapping: country, region), and of group names found (groups: doc_id, region)."""
    out = found.where("kind = 'country'").join(mapping, "country").select("doc_id", "region")
    return (out if groups is None else out.unionByName(groups)).distinct()


def affiliations(raw: DataFrame, institution: list[str]) -> DataFrame:
    """Columns id, name, city, country from (id, affiliation): parts between commas.

    The name is the last part with an institution word; the country is the last part, the city the one before.
    """
    parts = F.filter(F.transform(F.split("affiliation", ","), lambda p: F.trim(p)), lambda p: p != "")
    rows = raw.select("id", F.explode(F.split("affiliation", ";")).alias("affiliation")).where("trim(affiliation) <> ''").select("id", parts.alias("p"))
    named = F.filter("p", lambda x: x.rlike("(?i)\\b(" + "|".join(institution) + ")"))
    return rows.select("id", F.coalesce(F.get(F.reverse(named), F.lit(0)), F.get("p", F.lit(0))).alias("name"), F.when(F.size("p") > 2, F.element_at("p", -2)).alias("city"), F.when(F.size("p") > 1, F.element_at("p", -1)).alias("country"))


def major_country(rows: DataFrame) -> DataFrame:
    """`rows` with a missing country filled by the most frequent one of its city."""
    counts = rows.where("country is not null and city is not null").groupBy("city", "country").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("city").agg(F.max_by("country", F.struct("n", "country")).alias("major"))
    return rows.join(best, "city", "left").withColumn("country", F.coalesce("country", "major")).drop("major")
