"""Queries of article sources that are given as text: API answers, label tables, thesauri, gazetteers and dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.queries.parts import token_ctes
from litloom.queries.registry import query, table, values, values_sql
from litloom.sources import articles as A

ANSWERS = [(1, '{"results": [{"title": " Maize ", "year": "2015-03", "authors": ["A", "B"], "keywords": ["x"], "doi": "10.1/2"}, {"title": "", "year": "2011"}]}'), (2, "not json"), (3, '{"results": []}'), (4, '{"results": [{"title": "Rice", "url": "http://r"}]}')]
RECORDS = [("Maize", "", 2015, "A;B", "x", "https://doi.org/10.1/2"), ("Rice", "", 2018, "", "", "http://r")]


@query(f"SELECT * FROM (VALUES {values_sql(RECORDS)}) t(title, abstract, year, AU, keywords, url)")
def api_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.api_articles(values(spark, "id long, json string", ANSWERS))


AUTHORS = [(1, "Smith J (FAO; Rome); Doe A (Univ of X)"), (2, "Roe K"), (3, "")]
AUTHOR_ROWS = [(1, "Smith J", "FAO; Rome"), (1, "Doe A", "Univ of X"), (2, "Roe K", "")]


@query(f"SELECT * FROM (VALUES {values_sql(AUTHOR_ROWS)}) t(id, author, affiliation)")
def affiliated_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values(spark, "id long, raw string", AUTHORS).select("id", F.explode(A.split_affiliated_authors(F.col("raw"))).alias("p")).select("id", "p.*")


@query(r"""WITH r AS (SELECT page_id, regexp_extract_all(html, '(?is)<tr[^>]*>\s*<t[hd][^>]*>(.*?)</t[hd]>\s*<td[^>]*>(.*?)</td>\s*</tr>', 1) AS a, regexp_extract_all(html, '(?is)<tr[^>]*>\s*<t[hd][^>]*>(.*?)</t[hd]>\s*<td[^>]*>(.*?)</td>\s*</tr>', 2) AS b FROM pages),
u AS (SELECT page_id, unnest(a) AS a, unnest(b) AS b FROM r), n AS (SELECT page_id, trim(regexp_replace(regexp_replace(a, '<[^>]*>', ' ', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS a, trim(regexp_replace(regexp_replace(b, '<[^>]*>', ' ', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS b FROM u)
SELECT page_id, regexp_replace(a, '\s*:$', '') AS label, b AS value, count(*) AS n FROM n GROUP BY ALL""")
def label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(A.label_rows(F.col("html"))).alias("r")).select("page_id", "r.label", "r.value")
    return rows.groupBy("page_id", "label", "value").agg(F.count(F.lit(1)).alias("n"))


PAGES = [(1, "<table><tr><th>Author:</th><td><b>Smith</b> J</td></tr><tr><td>Author :</td><td>Doe A</td></tr><tr><td>Year</td><td>2011</td></tr></table>"), (2, "<p>none</p>")]


@query("SELECT 1 AS id, 'Smith J;Doe A' AS author, '2011' AS year")
def label_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.label_table(values(spark, "page_id int, html string", PAGES), {"Author": "author", "Year": "year"})


@query("""SELECT url, min(page_id) AS page FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0) GROUP BY url""")
def fresh_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("url", F.col("page_id").alias("page"), F.lit(0).alias("place"))
    return A.fresh_records(pages, pages.where("page % 3 = 0"), "url").select("url", "page")


@query("""WITH n AS (SELECT DISTINCT trim(s_name) AS name, 'province' AS kind, s_nationkey AS country FROM supplier UNION SELECT DISTINCT trim(c_mktsegment), 'district', c_nationkey FROM customer)
SELECT kind, count(*) AS names FROM n WHERE name IN (SELECT name FROM n GROUP BY name HAVING count(DISTINCT country) = 1) GROUP BY kind""")
def place_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("country"), F.col("s_name").alias("province"), F.lit("").alias("district"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("country"), F.lit("").alias("province"), F.col("c_mktsegment").alias("district"))
    return A.place_dictionary(suppliers.unionByName(customers)).groupBy("kind").agg(F.count(F.lit(1)).alias("names"))


OFFICIAL = [("KE", "Nairobi Area"), ("KE", "Mombassa"), ("NG", "Lagos")]
KNOWN = [("KE", "Mombasa"), ("KE", "Nairobi"), ("NG", "Kano")]


@query(f"""WITH o(country, name) AS (VALUES {values_sql(OFFICIAL)}), k(country, known) AS (VALUES {values_sql(KNOWN)}), n AS (SELECT country, name, known, 1 - CAST(levenshtein(lower(name), lower(known)) AS DOUBLE) / greatest(length(name), length(known)) AS s FROM o JOIN k USING (country)),
b AS (SELECT country, name, known FROM n WHERE s > 0.7 QUALIFY row_number() OVER (PARTITION BY country, name ORDER BY s DESC, known) = 1) SELECT o.country, o.name, b.known FROM o LEFT JOIN b ON b.country = o.country AND b.name = o.name""")
def enriched_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.enrich_places(values(spark, "country string, name string", KNOWN), values(spark, "country string, name string", OFFICIAL))


_W = lambda x: f"list_filter(string_split(lower({x}), ' '), lambda w: w <> '')"


@query(f"""WITH RECURSIVE n AS (SELECT DISTINCT p_type AS name FROM part), p AS (SELECT x.name AS a, y.name AS b FROM n x JOIN n y ON x.name <> y.name WHERE (list_has_any({_W("x.name")}, {_W("y.name")}) OR substr(lower(x.name), 1, 3) = substr(lower(y.name), 1, 3))
  AND (len(list_distinct(list_intersect({_W("x.name")}, {_W("y.name")}))) / CAST(len(list_distinct({_W("x.name")} || {_W("y.name")})) AS DOUBLE) >= 0.51 OR 1 - CAST(levenshtein(lower(x.name), lower(y.name)) AS DOUBLE) / greatest(length(x.name), length(y.name)) >= 0.8)),
r AS (SELECT name AS v, name AS r FROM n UNION SELECT r.v, p.b FROM r JOIN p ON p.a = r.r) SELECT v AS name, min(r) AS product FROM r GROUP BY v""")
def merged_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.merge_products(table(spark, sf_dir, "part").select(F.col("p_type").alias("name")), 0.51)


PATHS = [("Top/Plants/Cereals/Maize",), ("Top/ Plants",), ("Top/A/B/C/D/E",), ("",)]
FLAT = [("Maize", "Cereals", "Plants", "Top"), ("Plants", "Plants", "Plants", "Top"), ("E", "D", "C", "B")]


@query(f"SELECT * FROM (VALUES {values_sql(FLAT)}) t(narrow, broad, level_3, top)")
def flattened_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.flatten_paths(values(spark, "path string", PATHS))


@query(f"""WITH c AS (SELECT n_nationkey * 10 AS id, n_name AS cell FROM nation UNION ALL SELECT r_regionkey * 10 + 1, r_name FROM region), {token_ctes("c", "id", "cell")}, n AS (SELECT id, string_agg(term, ' ' ORDER BY i) AS word FROM tok GROUP BY id)
SELECT DISTINCT word FROM (SELECT lower(trim(cell)) AS word FROM c UNION SELECT word FROM n) WHERE word <> ''""")
def filter_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "nation").select(F.col("n_name").alias("a"), F.lit(None).cast("string").alias("b")).unionByName(table(spark, sf_dir, "region").select(F.lit("").alias("a"), F.col("r_name").alias("b")))
    return A.filter_words(cells, ["a", "b"])


@query("""SELECT lower(trim(p_brand)) AS word, min(p_size) AS rank, string_agg(DISTINCT p_type, ';' ORDER BY p_type) AS kinds FROM part GROUP BY 1""")
def rank_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("word"), F.col("p_size").alias("rank"), F.col("p_type").alias("kind"))
    return A.rank_dictionary(rows).select("word", "rank", F.array_join("kinds", ";").alias("kinds"))
