"""Queries of affiliations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.functions import affiliation as A
from litloom.operators import affiliations, geo
from litloom.queries.parts import folded, squeezed
from litloom.queries.registry import query, values, values_sql

AFFILIATIONS = [
    (1, "Univ. of Rome & FAO", 4), (2, "Dept ofSoil Science, the 3rd A. Institute", 2), (3, "A & M University", 9), (4, "The Natl Inst. of Health", 1), (5, "", 0), (6, "12", 3),
    (7, "International Food Policy Research Institute I F P R I", 5), (8, "World Bank", 8), (9, "University of Ibadan", 200), (10, "Universidad de São Paulo", 7),
]
CASES_SQL = f"cases(id, t, n) AS (VALUES {values_sql(AFFILIATIONS)})"
SIGNS_SQL = A.SIGNS.replace("'", "''")


def cases(spark: SparkSession) -> DataFrame:
    return values(spark, "id long, t string, n long", AFFILIATIONS)


def _spelled(x: str) -> str:
    for short, word in A.CLIPPED.items():
        x = rf"regexp_replace({x}, '(?i)\b{short}(?:\.|\b)', '{word}', 'g')"
    return rf"regexp_replace(regexp_replace({x}, '\s*&\s*', ' & ', 'g'), '\s*of([A-Z]\w)', ' of \1', 'g')"


def _articles(x: str) -> str:
    for i, word in enumerate(("a", "A", "the", "The", "THE")):
        x = rf"regexp_replace({x}, '\b{word}(\s*&|\.)', chr({i + 1}) || '\1', 'g')"
    x = rf"regexp_replace({x}, '(?i)\b(?:a|the)\b', ' ', 'g')"
    for i, word in enumerate(("a", "A", "the", "The", "THE")):
        x = f"replace({x}, chr({i + 1}), '{word}')"
    return squeezed(f"regexp_replace({x}, '{SIGNS_SQL}', ' ', 'g')")


def _numbers(x: str) -> str:
    signs = r"""[-.!"#$%''()*+,/:;<>=?@\[\]\\^_`{}|~0-9]+"""
    return f"CASE WHEN length(trim(regexp_replace({x}, '{signs}', '', 'g'))) < 2 THEN '' ELSE trim(regexp_replace({x}, '[0-9]+', '', 'g')) END"


def _form(x: str) -> str:
    return f"lower({folded(squeezed(rf"regexp_replace({x}, '(?i)\b(?:and|of|&|de|for|do)\b', '', 'g')"))})"


def _words(x: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split({squeezed(x)}, ' '), lambda w: w <> '')), ' ')"


def _generic(x: str) -> str:
    return squeezed(rf"regexp_replace({x}, '(?i)\b(?:{'|'.join([*A.INSTITUTIONS, *A.COMPANIES])})\w*\b', ' ', 'g')")


@query(f"""WITH {CASES_SQL} SELECT id, {_spelled('t')} AS spelled, {_articles('t')} AS articles, {_numbers('t')} AS numbers, {_form('t')} AS form, {_words('t')} AS words, {_generic('t')} AS generic FROM cases""")
def affiliation_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {"spelled": A.spell_out, "articles": A.without_articles, "numbers": A.without_numbers, "form": A.comparing_form, "words": A.sorted_words, "generic": lambda c: A.without_generic(c, [*A.INSTITUTIONS, *A.COMPANIES])}
    return cases(spark).select("id", *[f(F.col("t")).alias(k) for k, f in parts.items()])


@query(f"""WITH {CASES_SQL}, w AS (SELECT id, unnest(string_split({_form('t')}, ' ')) AS word FROM cases), s(stem) AS (VALUES ('univ'), ('inst'), ('bank')),
c AS (SELECT stem, word, count(*) AS n FROM w JOIN s ON starts_with(word, stem) GROUP BY stem, word) SELECT stem, word, n FROM c QUALIFY row_number() OVER (PARTITION BY stem ORDER BY n DESC, word) = 1""")
def institution_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return affiliations.institution_words(cases(spark).select(F.col("t").alias("name")), ["univ", "inst", "bank"])


AUTHORS = [(1, "Italy, Ministry of Health; World Bank"), (2, "FAO, Rome, Italy"), (3, "Italy"), (4, ""), (5, "Unit 3, Kenya 2; Kenya, Council, Italy")]
AUTHOR_ROWS = [(1, "Ministry of Health, Italy"), (1, "World Bank"), (2, "FAO,Rome, Italy"), (3, ", Italy"), (5, "Unit 3, Kenya"), (5, "Council, Italy")]


@query(f"WITH c(id, author) AS (VALUES {values_sql(AUTHOR_ROWS)}) SELECT id, author FROM c")
def corporate_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = values(spark, "id long, t string", AUTHORS)
    return rows.select("id", F.explode(A.corporate_authors(F.col("t"), ["italy", "kenya"])).alias("author"))


NAMES = [
    ("University of Ibadan", "Nigeria", 200), ("University Ibadan", "Nigeria", 12), ("Universitty of Ibadan", "Nigeria", 3), ("University of North Ibadan", "Nigeria", 4), ("University of South Ibadan", "Nigeria", 2),
    ("Gates", "USA", 30), ("Gates Foundation", "USA", 120), ("Bill and Melinda Gates", "USA", 50), ("Bill Melinda Gates Foundation", "USA", 9), ("WHO", "Italy", 7), ("W H O", "Italy", 2), ("Institute of Rome", "Italy", 5),
    ("Rome Institute", "Italy", 4), ("University of Ibadan at Nairobi", "Kenya", 1),
]


def _similar(a: str, b: str) -> str:
    return f"(CASE WHEN greatest(length({a}), length({b})) = 0 THEN 1.0 ELSE 1 - CAST(levenshtein({a}, {b}) AS DOUBLE) / greatest(length({a}), length({b})) END)"


def _only(a: str, b: str) -> str:
    return "(" + " OR ".join(f"(contains({a}, '{w}') AND NOT contains({b}, '{w}'))" for w in A.COMPASS) + ")"


def _own(a: str, b: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list_filter(string_split({_generic(a)}, ' '), lambda w: w <> '' AND NOT list_contains(string_split({_generic(b)}, ' '), w)))), ' ')"


@query(f"""WITH RECURSIVE a(name, country, n) AS (VALUES {values_sql(NAMES)}), r AS (SELECT *, {_form('name')} AS form, (upper(name) = name AND NOT contains(name, ' ')) AS acronym FROM a),
p AS (SELECT x.name AS source, y.name AS target, y.n FROM r x JOIN r y ON x.country = y.country AND substr(x.form, 1, 1) = substr(y.form, 1, 1) AND (y.n > x.n OR (y.n = x.n AND y.name < x.name)) AND x.n < 100
  WHERE CASE WHEN x.acronym AND y.acronym THEN replace(x.name, ' ', '') = replace(y.name, ' ', '') ELSE
    NOT ({_only('x.form', 'y.form')} AND {_only('y.form', 'x.form')}) AND ({_own('x.form', 'y.form')} = '' OR {_own('y.form', 'x.form')} = '' OR {_similar(_own('x.form', 'y.form'), _own('y.form', 'x.form'))} > 0.4)
    AND ({_similar('x.form', 'y.form')} >= 0.92 OR {_similar(_words('x.form'), _words('y.form'))} >= 0.92) AND {_similar(_generic('x.form'), _generic('y.form'))} >= 0.85 END),
l AS (SELECT source, target FROM p QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, target) = 1),
f AS (SELECT name AS source, name AS target FROM a UNION SELECT f.source, l.target FROM f JOIN l ON f.target = l.source),
e AS (SELECT source AS name, target AS canonical FROM f WHERE target NOT IN (SELECT source FROM l)),
m AS (SELECT canonical, max(contains(lower(name), 'foundation') AND contains(lower(name), lower(canonical))) AS member FROM e GROUP BY canonical)
SELECT e.name, CASE WHEN m.member AND NOT contains(lower(e.canonical), 'foundation') THEN e.canonical || ' Foundation' ELSE e.canonical END AS canonical FROM e JOIN m USING (canonical)""")
def affiliation_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return affiliations.cluster(values(spark, "name string, country string, n long", NAMES))


RAW = [(1, "Dept of Soil, University of Rome, Rome, Italy; FAO, Rome, Italy"), (2, "Institute of Crops, Rome, "), (3, "Lab"), (4, "")]


@query(f"""WITH c(id, affiliation) AS (VALUES {values_sql(RAW)}), s AS (SELECT id, unnest(string_split(affiliation, ';')) AS a FROM c), p AS (SELECT id, list_filter(list_transform(string_split(a, ','), lambda x: trim(x)), lambda x: x <> '') AS p FROM s WHERE trim(a) <> ''),
n AS (SELECT id, coalesce(list_filter(p, lambda x: regexp_matches(x, '(?i)\\b(univ|institut|college)'))[-1], p[1]) AS name, CASE WHEN len(p) > 2 THEN p[-2] END AS city, CASE WHEN len(p) > 1 THEN p[-1] END AS country FROM p),
m AS (SELECT city, country AS major FROM (SELECT city, country, count(*) AS k FROM n WHERE city IS NOT NULL AND country IS NOT NULL GROUP BY city, country) QUALIFY row_number() OVER (PARTITION BY city ORDER BY k DESC, country DESC) = 1)
SELECT n.city, id, name, coalesce(country, major) AS country FROM n LEFT JOIN m ON n.city = m.city""")
def affiliation_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.major_country(geo.affiliations(values(spark, "id long, affiliation string", RAW), ["univ", "institut", "college"]))
