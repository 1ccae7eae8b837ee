"""Reading article tables from files: CSV, TSV, tagged records, pages and folders of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ARTICLE = "AU string, title string, year int, journal string, abstract string, url string, raw_affiliation string, keywords string, email string, identificators string, dataset string, publisher string, dataset_type string"


def read_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", recursive: bool = False) -> DataFrame:
    """All columns as strings, nulls as empty strings."""
    rows = spark.read.csv(path, header=True, sep=sep, encoding=encoding, multiLine=True, escape='"', recursiveFileLookup=recursive)
    return rows.fillna("")


def parse_list(cell: Column) -> Column:
    """A cell that holds a list literal as an array; other cells give an empty one. Nothing is evaluated."""
    json = F.regexp_replace(F.regexp_replace(cell, r"^\['|'\]$|', '", "\u0001"), "\u0001", '"')
    quoted = F.when(cell.rlike(r"^\['.*'\]$"), F.split(F.regexp_replace(F.regexp_replace(cell, r"^\['", ""), r"'\]$", ""), "', '"))
    del json
    return F.coalesce(F.when(cell.rlike(r"^\["), F.coalesce(quoted, F.from_json(cell, "array<string>"))), F.array().cast("array<string>"))


def read_folder(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The union of Parquet tables whose columns may differ."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (spark.read.parquet(p) for p in paths))


def parse_tagged(lines: DataFrame) -> DataFrame:
    """Records from tagged lines (file, line_no, line): columns file, record, title, abstract, doi, keywords, year, url.

    A blank line ends a record; keywords go on until the next tag. Lines of a file are ordered within the file.
    """
    order = Window.partitionBy("file").orderBy("line_no")
    tag = F.regexp_extract("line", "^([A-Z][A-Z0-9])  - ", 1)
    rows = lines.withColumns({"record": F.sum((F.trim("line") == "").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)), "tag": F.when(tag != "", tag)})
    rows = rows.where("trim(line) <> ''")
    within = Window.partitionBy("file", "record").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"tag": F.last("tag", ignorenulls=True).over(within), "value": F.trim(F.regexp_replace("line", "^[A-Z][A-Z0-9]  - ", ""))})
    joined = lambda t, by: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("tag") == t, F.struct("line_no", "value")))), lambda s: s["value"]), by)
    return rows.groupBy("file", "record").agg(
        joined("T1", " ").alias("title"), joined("AB", " ").alias("abstract"), joined("DO", " ").alias("doi"), joined("KW", ";").alias("keywords"),
        F.min(F.when(F.col("tag") == "PY", F.substr("value", F.lit(1), F.lit(4)).cast("int"))).alias("year"), joined("UR", " ").alias("url"),
    )


def html_record(html: Column) -> dict[str, Column]:
    """Title, plain paragraphs and links of a page."""
    body = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), r"<!--.*?-->", " ")
    text = F.trim(F.regexp_replace(F.regexp_replace(body, r"<[^>]*>", " "), r"\s+", " "))
    return {
        "title": F.trim(F.regexp_extract(html, r"(?i)<title>([^<]*)</title>", 1)),
        "text": text,
        "links": F.regexp_extract_all(html, F.lit(r"(?i)href=[\"']([^\"']+)[\"']"), F.lit(1)),
    }


def read_xml_articles(spark: SparkSession, path: str, row_tag: str = "article") -> DataFrame:
    """Articles of journal XML: title, abstract, keywords, year, authors (Surname Given), as far as they are there."""
    schema = "front struct<`article-meta`: struct<`title-group`: struct<`article-title`: string>, abstract: struct<p: array<string>>, `kwd-group`: struct<kwd: array<string>>, `pub-date`: struct<year: int>, `contrib-group`: struct<contrib: array<struct<name: struct<surname: string, `given-names`: string>>>>>>"
    rows = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    meta = F.col("front.article-meta")
    names = F.transform(meta["contrib-group"]["contrib"], lambda c: F.concat_ws(" ", c["name"]["surname"], c["name"]["given-names"]))
    return rows.select(
        F.trim(meta["title-group"]["article-title"]).alias("title"), F.array_join(meta["abstract"]["p"], " ").alias("abstract"),
        F.array_join(meta["kwd-group"]["kwd"], ";").alias("keywords"), meta["pub-date"]["year"].alias("year"), names.alias("authors"),
    )


def crawl_status(log: DataFrame) -> DataFrame:
    """Columns url, pages, errors, status of a crawl log (url, ok): finished if every page was read, failed if none was."""
    counts = log.groupBy("url").agg(F.count(F.lit(1)).alias("pages"), F.count_if(~F.col("ok")).alias("errors"))
    return counts.withColumn("status", F.when(F.col("errors") == 0, "finished").when(F.col("errors") == F.col("pages"), "failed").otherwise("partial"))


def choose_columns(mapping: DataFrame) -> DataFrame:
    """Columns dataset, ours, external: for each of our columns the external one that comes first by name, then priority."""
    return mapping.groupBy("dataset", "ours").agg(F.min(F.struct("external", "priority"))["external"].alias("external"))
