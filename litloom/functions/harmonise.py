"""Cleaning that depends on the source of an article, as one expression for each column.

Columns are strings as read, null or absent ones empty. What a source has no rule for stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.functions.language import only_english
from litloom.functions.repair import dataset_type
from litloom.functions.text import article_link, find_year, trim_marks

# Sources that share a rule.
WHOLE_ENGLISH = ["CABI", "African", "Web of Science", "WorldBank"]
REFERENCE_MANAGERS = ["Cochrane", "ICAR", "Greenwich"]
CRAWLED = [
    "IDS", "Mastercard", "ACET of Africa", "CGSPACE", "AFDB", "IDRC", "ABTAssociates", "ACDIVOCA", "ACIAR", "FANRPAN", "Global Knowledge initiative", "World VEG", "GIZ", "CDC", "WorldWatch", "FAO",
    "Horticulture", "Postharvest Center", "Rockfeller Foundation", "TechnoServe",
]
INPUTS = "AU title year journal abstract url raw_affiliation keywords email identificators dataset publisher MH DE ID BT CP citation file_urls article_link".split()


def _lines(c: Column) -> Column:
    return F.replace(c, F.lit("\n"), F.lit(";"))


def _listed(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(";"))


def _each(keywords: Column, change, kept=None) -> Column:
    parts = F.transform(F.split(keywords, ";"), change)
    return F.array_join(F.filter(parts, kept) if kept else parts, ";")


def _surnames(authors: Column) -> Column:
    """Of "surname, given, surname, given ..." the surnames."""
    parts = F.split(authors, ",")
    return F.array_join(F.filter(parts, lambda _, i: i % 2 == 0), ";")


def harmonise(df: DataFrame) -> DataFrame:
    """The article schema (13 columns) of rows from any source, named in `dataset`."""
    c = {name: F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("") for name in INPUTS}
    source = c["dataset"]
    of = lambda *names: source.isin(list(names))
    ovid = of("CAB")
    agricola = of("Agricola")

    authors = F.when(of("Scopus", "IZA"), _listed(c["AU"])).when(agricola | ovid, _lines(c["AU"])).when(of(*REFERENCE_MANAGERS) & c["AU"].rlike("[0-9]"), F.lit(""))
    authors = authors.when(of("Wider"), _listed(F.split(c["AU"], "-")[0])).when(of("CGSPACE"), _surnames(c["AU"])).otherwise(c["AU"])

    title = F.when(of("Scopus"), only_english(c["title"], "[")).when(of("ISI", "Gardian"), only_english(c["title"], ".")).when(of(*WHOLE_ENGLISH), only_english(c["title"]))
    title = title.when(of("IZA") & F.contains(c["title"], F.lit(":")), F.regexp_replace(c["title"], "^[^:]*:", "")).otherwise(c["title"])

    abstract = F.when(of("Scopus", "Gardian"), only_english(c["abstract"], ".")).when(of("ISI"), only_english(only_english(c["abstract"], "RESUME"), ".")).when(of(*WHOLE_ENGLISH), only_english(c["abstract"]))
    abstract = abstract.when(of("IZA", "Wider", *CRAWLED), trim_marks(F.trim(c["abstract"]))).otherwise(c["abstract"])

    joined = F.concat_ws(";", _lines(c["MH"]), F.concat(_lines(c["DE"]), _lines(c["ID"])))
    proquest = _each(c["keywords"], lambda k: F.trim(F.when(F.contains(k, F.lit(":")), F.split(k, ":")[1]).otherwise(k)), lambda k: ~k.rlike(r"^(\(UMI\)|http|No |//)"))
    keywords = F.when(of("Econlit"), _each(c["keywords"], lambda k: F.trim(F.regexp_replace(k, r"\b[A-Z][0-9]{2}\b", "")))).when(of("Proquest"), proquest).when(agricola, joined)
    keywords = keywords.when(ovid, F.concat_ws(";", _lines(c["MH"]), _lines(c["BT"]), _lines(c["ID"]), _lines(c["CP"]))).when(of("IZA", "Wider", *CRAWLED), _listed(c["keywords"]))
    keywords = keywords.when(of(*REFERENCE_MANAGERS), F.replace(c["keywords"], F.lit("*"), F.lit(""))).otherwise(c["keywords"])

    clrtb = of("CLRTB_PHL") & F.contains(c["raw_affiliation"], F.lit("Author Affiliation:")) & F.contains(c["raw_affiliation"], F.lit("Author Email:"))
    email = F.when(of("Scopus"), F.trim(F.coalesce(F.get(F.split(c["email"], "email:"), F.lit(1)), F.lit("")))).when(clrtb, F.split(c["raw_affiliation"], "Author Email:")[1]).otherwise(c["email"])
    affiliation = F.when(clrtb, F.split(F.split(c["raw_affiliation"], "Author Email:")[0], "Author Affiliation:")[1]).when(agricola, _lines(c["raw_affiliation"]))
    affiliation = affiliation.when(of("Wider"), F.regexp_replace(c["AU"], "^[^-]*-?", "")).otherwise(c["raw_affiliation"])

    journal = F.when(agricola, F.regexp_replace(F.split(c["journal"], r"\.")[0], r"\[\w.?\]", "")).when(ovid, F.split(c["journal"], ";")[0])
    journal = journal.when(of(*REFERENCE_MANAGERS) & F.startswith(F.lower(c["journal"]), F.lit("http")), F.lit("")).otherwise(c["journal"])

    year = F.when(agricola & (c["year"] == ""), F.regexp_extract(c["journal"], r"\b([0-9]{4})\b", 1)).when(of("Gardian"), F.regexp_extract(c["citation"], "([0-9]{4})", 1)).otherwise(c["year"])
    crawled = F.when(c["file_urls"] != "", c["file_urls"]).otherwise(c["article_link"])
    url = F.when(agricola | ovid, F.split(c["url"], "Available")[0]).when(of("Wider", *CRAWLED), crawled).otherwise(c["url"])
    doi = F.when(url.rlike("^https?://"), F.lit("")).otherwise(F.trim(url))
    identificators = F.when(of(*REFERENCE_MANAGERS), F.replace(c["identificators"], F.lit("*"), F.lit(""))).otherwise(c["identificators"])
    return df.select(
        F.trim(authors).alias("AU"), F.trim(title).alias("title"), find_year(year).alias("year"), F.trim(journal).alias("journal"), F.trim(abstract).alias("abstract"), article_link(F.trim(url), doi).alias("url"),
        F.trim(affiliation).alias("raw_affiliation"), F.trim(keywords).alias("keywords"), F.trim(email).alias("email"), identificators.alias("identificators"), source.alias("dataset"), c["publisher"].alias("publisher"),
        dataset_type(source).alias("dataset_type"),
    )
