"""Pieces of SQL that several oracles share."""

from __future__ import annotations

from litloom.functions.lexicon import DROPPED_SQL, lemma_sql

WS = r"[\x20\x09-\x0D]+"


def folded(x: str) -> str:
    return rf"regexp_replace(strip_accents({x}), '[^\x00-\x7F]', '', 'g')"


def squeezed(x: str) -> str:
    return rf"trim(regexp_replace({x}, '{WS}', ' ', 'g'))"


def separated(x: str) -> str:
    return squeezed(rf"regexp_replace({folded(x)}, '[^A-Za-z0-9_]|\b[0-9]\w*\b|_', ' ', 'g')")


def abbreviation(w: str) -> str:
    root = f"regexp_replace({w}, 's$', '')"
    return f"((upper({w}) = {w} AND regexp_matches({w}, '[A-Z]')) OR (regexp_matches({w}, 's$') AND length({w}) > 1 AND upper({root}) = {root} AND regexp_matches({root}, '[A-Z]')))"


def token_ctes(source: str, id_: str = "doc_id", text: str = "text", name: str = "tok") -> str:
    """CTEs that end in `name`(id, i, term): index terms in order, numbered without gaps."""
    noun = f"lower({lemma_sql('w')})"
    noun = f"(CASE WHEN length({noun}) <= 1 THEN w ELSE {noun} END)"
    short = "regexp_replace(w, 's$', '')"
    return f"""
{name}_clean AS (SELECT {id_} AS id, {separated(text)} AS c FROM {source}),
{name}_split AS (SELECT id, unnest(string_split(c, ' ')) AS w, generate_subscripts(string_split(c, ' '), 1) AS i FROM {name}_clean),
{name}_words AS (SELECT id, i, CASE WHEN {abbreviation('w')} THEN {short} ELSE lower(w) END AS w FROM {name}_split WHERE w <> ''),
{name}_judged AS (
  SELECT id, i, CASE WHEN {abbreviation('w')} THEN {short} ELSE {noun} END AS term,
    CASE WHEN {abbreviation('w')} THEN {short} NOT IN ({DROPPED_SQL})
         ELSE length(w) > 1 AND lower(w) NOT IN ({DROPPED_SQL}) AND {noun} NOT IN ({DROPPED_SQL}) END AS ok
  FROM {name}_words WHERE w <> '' AND NOT regexp_matches(w, '^[0-9]') AND w NOT IN ({DROPPED_SQL})
),
{name} AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY i) AS i, term FROM {name}_judged WHERE ok)"""


def postings_ctes(source: str = "documents", id_: str = "doc_id", text: str = "text") -> str:
    """CTEs that end in post(term, id) and vocab(term, df)."""
    return f"""{token_ctes(source, id_, text)},
grams AS (
  SELECT id, term FROM tok
  UNION ALL SELECT id, term || ' ' || following FROM (SELECT id, term, lead(term) OVER (PARTITION BY id ORDER BY i) AS following FROM tok) WHERE following IS NOT NULL
),
post AS (SELECT DISTINCT term, id FROM grams),
vocab AS (SELECT term, substr(term, 1, 3) AS prefix3, len(string_split(term, ' ')) AS n_tokens, count(*) AS df FROM post GROUP BY term)"""


def stem_sql(w: str) -> str:
    rules = (("ational", "ate"), ("ization", "ize"), ("fulness", "ful"), ("iveness", "ive"), ("ing", ""), ("edly", ""), ("ed", ""), ("ly", ""), ("ment", ""), ("ness", ""))
    return "CASE " + " ".join(f"WHEN ends_with({w}, '{e}') AND length({w}) >= {len(e) + 3} THEN substr({w}, 1, length({w}) - {len(e)}) || '{p}'" for e, p in rules) + f" ELSE {w} END"
