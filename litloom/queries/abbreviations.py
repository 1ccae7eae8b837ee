"""Queries of abbreviations, over all documents and hand-written sentences beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.operators import abbreviations, index
from litloom.queries.parts import abbreviation, postings_ctes
from litloom.queries.registry import query, table, values, values_sql

SENTENCES = [
    (-1, "The World Health Organization (WHO) met farmers."), (-2, "Funds of the Food and Agriculture Organization (FAO) grew."), (-3, "food and agriculture organisation (FAO) and Food and Agriculture Organization (FAO)"),
    (-4, "World health organization (WHO) and national seed banks (NSBs) agree."), (-5, "the world food programme (WFP) and work for pay (WFP)"), (-6, "Of the (ABC) nothing; an ABC abc book (ABC)"), (-7, "water user association groups here (WUA)"),
    (-8, "WFP staff of the world food programme"), (-9, "WHO says WFP and FAO"), (-10, "work for pay is WFP"),
]
ALL_SQL = f"alltexts(doc_id, text) AS (SELECT doc_id, text FROM documents UNION ALL VALUES {values_sql(SENTENCES)})"


def all_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(values(spark, "doc_id long, text string", SENTENCES))


_LETTERS = f"list_transform(win, lambda w: CASE WHEN {abbreviation('w')} THEN lower(w) ELSE lower(substr(w, 1, {{n}})) END)"
_SPELLED = f"list_transform(win, lambda w: CASE WHEN {abbreviation('w')} THEN lower(w) ELSE lower(substr(w, 1, 1)) || CASE WHEN length(w) > 1 THEN '(?:' || lower(substr(w, 2, 1)) || ')?' ELSE '' END END)"
DISCOVER = rf"""{ALL_SQL},
br AS (SELECT doc_id, unnest(regexp_extract_all(text, '{abbreviations.BRACKETED}', 1)) AS b, unnest(regexp_extract_all(text, '{abbreviations.BRACKETED}', 2)) AS abbr,
  unnest(range(len(regexp_extract_all(text, '{abbreviations.BRACKETED}', 2)))) AS k FROM alltexts),
cand AS (SELECT doc_id, k, abbr, length(abbr) AS n, list_filter(string_split(trim(b), ' '), lambda w: w <> '') AS words FROM br),
sized AS (SELECT *, unnest([n, n + 1, n + 2] || range(n - 1, 1, -1)) AS size, unnest(range(3 + greatest(n - 2, 0))) AS s FROM cand),
win AS (SELECT *, list_slice(words, greatest(len(words) - o - size + 1, 1), len(words) - o) AS win FROM (SELECT *, unnest(range(0, 3)) AS o FROM sized)),
formed AS (SELECT doc_id, k, abbr, s, o, array_to_string(win, ' ') AS meaning FROM win WHERE len(win) > 1 AND (
  regexp_matches(lower(abbr), '^' || array_to_string({_SPELLED}, '\w?') || '$')
  OR regexp_matches(array_to_string({_LETTERS.format(n=1)}, ''), '^' || regexp_replace(lower(abbr), '([a-z])', '\1\\w?', 'g'))
  OR regexp_matches(array_to_string({_LETTERS.format(n=2)}, ''), '^' || regexp_replace(lower(abbr), '([a-z])', '\1\\w?', 'g')))),
best AS (SELECT abbr, meaning FROM (SELECT * FROM formed QUALIFY row_number() OVER (PARTITION BY doc_id, k ORDER BY s, o) = 1) WHERE NOT contains(meaning, abbr) AND NOT contains(meaning, lower(abbr))),
found AS (SELECT abbr, meaning, count(*) AS n FROM best GROUP BY abbr, meaning)"""
RESOLVE = f"""WITH RECURSIVE {DISCOVER},
r AS (SELECT *, row_number() OVER (PARTITION BY abbr ORDER BY n DESC, length(meaning), meaning) AS place FROM found),
p AS (SELECT x.abbr, x.meaning AS source, min_by(y.meaning, y.place) AS target FROM r x JOIN r y ON x.abbr = y.abbr AND y.place < x.place
  WHERE 1 - CAST(levenshtein(x.meaning, y.meaning) AS DOUBLE) / greatest(length(x.meaning), length(y.meaning)) > 0.85 OR lower(x.meaning) = lower(y.meaning) OR starts_with(x.meaning, y.meaning) GROUP BY x.abbr, x.meaning),
f AS (SELECT abbr, meaning AS source, meaning AS target FROM r UNION SELECT f.abbr, f.source, p.target FROM f JOIN p ON f.abbr = p.abbr AND f.target = p.source),
m AS (SELECT f.abbr, f.target, sum(r.n) AS n FROM f JOIN r ON r.abbr = f.abbr AND r.meaning = f.source WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.abbr = f.abbr AND p.source = f.target) GROUP BY f.abbr, f.target),
l AS (SELECT abbr, meaning, max(n) AS n FROM (SELECT abbr, regexp_replace(target, '\\bprogramme\\b', 'program', 'g') AS meaning, n FROM m UNION SELECT abbr, regexp_replace(target, '\\bprogram\\b', 'programme', 'g'), n FROM m) GROUP BY abbr, meaning),
meanings AS (SELECT abbr, meaning, CAST(n AS BIGINT) AS n, row_number() OVER (PARTITION BY abbr ORDER BY n DESC, length(meaning), meaning) AS place FROM l)"""


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abbreviations.resolve(abbreviations.discover(all_texts(spark, sf_dir)))


@query(f"WITH {DISCOVER} SELECT abbr, meaning, n FROM found")
def abbreviation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abbreviations.discover(all_texts(spark, sf_dir))


@query(f"{RESOLVE} SELECT abbr, meaning, n, place FROM meanings")
def abbreviation_meanings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved(spark, sf_dir)


@query(f"{RESOLVE} SELECT meaning, abbr, n, row_number() OVER (PARTITION BY meaning ORDER BY n DESC, abbr) AS place FROM meanings")
def abbreviations_by_meaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abbreviations.abbreviations_of(resolved(spark, sf_dir))


MEANINGS = [("WFP", "world food programme", 20, 1), ("WFP", "work pay", 16, 2), ("FAO", "food agriculture organization", 9, 1), ("WHO", "world health organization", 30, 1), ("ABC", "onanshat thion", 3, 1), ("ABC", "erthe wh", 2, 2)]
QUERIES = [(1, "WFP aid"), (2, "world food programme of FAO"), (3, "ABC tests"), (4, "nothing here"), (5, "")]


@query(f"""WITH RECURSIVE m(abbr, meaning, n, place) AS (VALUES {values_sql(MEANINGS)}), q(query_id, query) AS (VALUES {values_sql(QUERIES)}), k AS (SELECT abbr, count(*) AS k FROM m GROUP BY abbr),
u AS (SELECT m.* FROM m JOIN k USING (abbr) WHERE k = 1 OR n >= 15), s AS (SELECT abbr AS old, meaning AS new FROM u UNION SELECT meaning, abbr FROM u),
v AS (SELECT query_id, query, 0 AS d FROM q UNION SELECT v.query_id, trim(replace(' ' || v.query || ' ', ' ' || s.old || ' ', ' ' || s.new || ' ')), d + 1 FROM v JOIN s ON contains(' ' || v.query || ' ', ' ' || s.old || ' ') WHERE d < 2)
SELECT DISTINCT query_id, query FROM v""")
def rewritten_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = values(spark, "abbr string, meaning string, n long, place long", MEANINGS)
    return abbreviations.rewrite_queries(values(spark, "query_id long, query string", QUERIES), rows)




@query(f"""WITH {ALL_SQL}, {postings_ctes("alltexts")}, m(abbr, meaning, n, place, g1, g2) AS (VALUES ('WFP', 'world food programme', 20, 1, 'world food', 'food programme'), ('WFP', 'work pay', 16, 2, 'work pay', 'work pay'),
  ('FAO', 'food agriculture organization', 9, 1, 'food agriculture', 'agriculture organization'), ('WHO', 'world health organization', 30, 1, 'world health', 'health organization'), ('ABC', 'onanshat thion', 3, 1, 'onanshat thion', 'onanshat thion'), ('ABC', 'erthe wh', 2, 2, 'erthe wh', 'erthe wh')),
h AS (SELECT m.abbr, m.meaning, m.place, a.id FROM m JOIN post a ON a.term = m.abbr), i AS (SELECT h.*, (EXISTS (SELECT 1 FROM post p JOIN m ON m.meaning = h.meaning AND p.term = m.g1 WHERE p.id = h.id) AND EXISTS (SELECT 1 FROM post p JOIN m ON m.meaning = h.meaning AND p.term = m.g2 WHERE p.id = h.id)) AS here FROM h)
SELECT id AS doc_id, abbr, meaning FROM i QUALIFY row_number() OVER (PARTITION BY id, abbr ORDER BY CASE WHEN here THEN 0 ELSE 1 END, place) = 1""")
def used_meanings(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = index.build_postings(all_texts(spark, sf_dir))
    return abbreviations.used_meanings(posts, index.build_vocabulary(posts), values(spark, "abbr string, meaning string, n long, place long", MEANINGS), 1.0)


SHOWN = [(1, "WFP and WFPX by FAO", "world food programme (WFP) and WFPX by food agriculture organization (FAO)"), (2, "no short words", "no short words"), (3, "", "")]


@query(f"WITH s(id, t, shown) AS (VALUES {values_sql(SHOWN)}) SELECT id, shown FROM s")
def spelled_abbreviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(a).alias("abbr"), F.lit(m).alias("meaning")) for a, m in (("FAO", "food agriculture organization"), ("WFP", "world food programme"))])
    return values(spark, "id long, t string, shown string", SHOWN).select("id", abbreviations.spell_out(F.col("t"), pairs).alias("shown"))
