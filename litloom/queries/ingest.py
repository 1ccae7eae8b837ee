"""Queries of ingestion: pages, tagged records, list cells, years and crawl logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.functions.text import years_in
from litloom.queries.registry import query, table, values, values_sql
from litloom.sources import readers


@query(r"""SELECT page_id, trim(regexp_extract(html, '(?i)<title>([^<]*)</title>', 1)) AS title,
md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))) AS text,
CAST(len(regexp_extract_all(html, '(?i)href=["'']([^"'']+)["'']', 1)) AS BIGINT) AS links FROM pages""")
def html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = readers.html_record(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", parts["title"].alias("title"), F.md5(parts["text"]).alias("text"), F.size(parts["links"]).cast("long").alias("links"))


@query(r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)href=["'']([^"'']+)["'']', 1)) AS link FROM pages) SELECT link, count(*) AS n, count(DISTINCT page_id) AS pages FROM l GROUP BY link""")
def link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(readers.html_record(F.col("html"))["links"]).alias("link"))
    return links.groupBy("link").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("page_id").alias("pages"))


@query(r"""WITH y AS (SELECT page_id, unnest(regexp_extract_all(html, '\b([0-9]{4})\b', 1)) AS y FROM pages) SELECT p.page_id, min(CASE WHEN CAST(y AS INTEGER) > 1800 AND CAST(y AS INTEGER) <= 2026 THEN CAST(y AS INTEGER) END) AS year
FROM pages p LEFT JOIN y ON p.page_id = y.page_id GROUP BY p.page_id""")
def year_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", years_in(F.col("html"), 2026).alias("year"))


@query(r"""SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, count(*) AS pages, count(DISTINCT url) AS urls FROM pages GROUP BY 1""")
def host_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    return table(spark, sf_dir, "pages").groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("pages"), F.countDistinct("url").alias("urls"))


CELLS = [(1, "['a', 'b c']"), (2, '["x", "y"]'), (3, "plain"), (4, "[]"), (5, None)]
CELL_ITEMS = [(1, "a"), (1, "b c"), (2, "x"), (2, "y")]


@query(f"WITH c(id, item) AS (VALUES {values_sql(CELL_ITEMS)}) SELECT id, item FROM c")
def list_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values(spark, "id long, cell string", CELLS).select("id", F.explode(readers.parse_list(F.col("cell"))).alias("item"))


RIS = """T1  - Maize storage
A1  - Doe, A.
KW  - maize
silo
PY  - 2015/03
UR  - http://x.org/1

T1  - No year
AB  - Short
text
KW  - rice""".split("\n")
RIS_ROWS = [(0, "Maize storage", "", "maize;silo", 2015, "http://x.org/1"), (1, "No year", "Short text", "rice", None, "")]


@query(f"WITH r(record, title, abstract, keywords, year, url) AS (VALUES {values_sql(RIS_ROWS)}) SELECT CAST(record AS BIGINT) AS record, title, abstract, keywords, CAST(year AS INTEGER) AS year, url FROM r")
def ris_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = values(spark, "file string, line_no int, line string", [("a.ris", i, line) for i, line in enumerate(RIS)])
    return readers.parse_tagged(lines).select("record", "title", "abstract", "keywords", "year", "url")


LOG = [("a", True), ("a", True), ("b", False), ("c", True), ("c", False)]


@query(f"""WITH l(url, ok) AS (VALUES {values_sql([(u, int(o)) for u, o in LOG])}) SELECT url, count(*) AS pages, count(*) FILTER (WHERE ok = 0) AS errors,
CASE WHEN min(ok) = 1 THEN 'finished' WHEN max(ok) = 0 THEN 'failed' ELSE 'partial' END AS status FROM l GROUP BY url""")
def crawl_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.crawl_status(values(spark, "url string, ok boolean", LOG))


MAPPING = [("d1", "title", "TI", 2), ("d1", "title", "Name", 1), ("d1", "year", "PY", 1), ("d2", "title", "T", 1)]


@query(f"WITH m(dataset, ours, external, priority) AS (VALUES {values_sql(MAPPING)}) SELECT dataset, ours, min(external) AS external FROM m GROUP BY dataset, ours")
def column_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.choose_columns(values(spark, "dataset string, ours string, external string, priority int", MAPPING))
