"""Queries of text cleaning, over whole documents and pages and over hand-written cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.functions import text as T
from litloom.queries.parts import abbreviation, folded, separated, squeezed
from litloom.queries.registry import query, table, values, values_sql

CASES = [
    (1, "Café <U+00E9> crème; brûlée"), (2, "NGOs and the A-team, 12ab 3rd snake_case 42"), (3, "Soil {a}cid {ab} {%} test"), (4, "<b>Bold</b> &amp; (  ) [ ] text &copy; x &lt;y&gt;"),
    (5, "Study (c) 2020 Copyright. Elsevier"), (6, "No abstract available"), (7, ".,; Trim me?! "), (8, "full text; maize; Wheat, RICE ;; Full Text available"), (9, "AAA; BBB; CCC; DDD; eee; fff"),
    (10, "men and women or children (UN) [ab1]; farms: small"), (11, ""), (12, "the role of IT in farming"), (13, "Korea, Republic of (South)"), (14, "J. of Tests; vol. 3; issue 2"),
    (15, "Annals, B; Soil Letters, part 2"), (16, "mmmmmmmmmmmmmmmmmm ocr hy-\nphen (cid:12)\nline"), (17, "women's cities, boxes & churches"), (18, "organisation"), (19, "realize"), (20, "one two three"),
]
CASES_SQL = f"WITH cases(id, t) AS (VALUES {values_sql(CASES)})"


def cases(spark: SparkSession) -> DataFrame:
    return values(spark, "id long, t string", CASES)


@query(f"SELECT doc_id, {folded('text')} AS folded FROM documents")
def fold_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.fold_accents(F.col("text")).alias("folded"))


_NORMAL = f"""
SELECT {{id}}, coalesce(string_agg(CASE WHEN {abbreviation('w')} THEN regexp_replace(w, 's$', '') ELSE lower(w) END, ' ' ORDER BY i) FILTER (WHERE w <> ''), '') AS normal
FROM (SELECT {{id}}, unnest(string_split(c, ' ')) AS w, generate_subscripts(string_split(c, ' '), 1) AS i FROM (SELECT {{id}}, {{c}} AS c FROM {{source}}))
GROUP BY {{id}}
"""


@query(_NORMAL.format(id="doc_id", c=separated("text"), source="documents"))
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize_text(F.col("text")).alias("normal"))


@query(CASES_SQL + _NORMAL.format(id="id", c=separated("t"), source="cases"))
def normalize_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark).select("id", T.normalize_text(F.col("t")).alias("normal"))


@query(
    CASES_SQL
    + r"""
SELECT id, CASE WHEN regexp_matches(t, '<\s*U\s*\+[A-Za-z0-9_]{4}\s*>') THEN
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '<\s*U\s*\+[A-Za-z0-9_]{4}\s*>', ' ; ', 'g'), '([.:;!?])\s*;', '\1', 'g'), '^\s*;\s*', '', 'g'), '\s*;\s*', ' ; ', 'g')
  ELSE t END AS cleaned FROM cases"""
)
def unicode_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark).select("id", T.remove_unicode_symbols(F.col("t")).alias("cleaned"))


_HTML = "{x}"
for _a, _b in ((r"<.+?>", ""), (r"\(\s*\)", ""), (r"\[\s*\]", "")):
    _HTML = f"regexp_replace({_HTML}, '{_a}', '{_b}', 'g')"
for _a, _b in (("&amp;", "&"), ("&gt;", ">"), ("&lt;", "<"), ("&quot;", '"'), ("&nbsp;", " ")):
    _HTML = f"replace({_HTML}, '{_a}', '{_b}')"
_HTML = rf"regexp_replace(regexp_replace({_HTML}, '&\w+;', ' ', 'g'), '\s+', ' ', 'g')"


@query(f"SELECT page_id, {_HTML.format(x='html')} AS plain FROM pages")
def strip_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.remove_html_tags(F.col("html")).alias("plain"))


@query(f"{CASES_SQL} SELECT id, {_HTML.format(x='t')} AS plain FROM cases")
def strip_html_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark).select("id", T.remove_html_tags(F.col("t")).alias("plain"))


@query(
    CASES_SQL
    + r"""
SELECT id, CASE WHEN lower(translate(t, '[]', '')) = 'no abstract available' THEN ''
  ELSE regexp_replace(trim(regexp_replace(trim(string_split_regex(t, '©|\(c\)|\(C\)')[1]), '[Cc]opyright ?\.?', '', 'g')), '\s+', ' ', 'g') END AS kept FROM cases"""
)
def remove_copyright(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark).select("id", T.remove_copyright(F.col("t")).alias("kept"))


@query(
    CASES_SQL
    + r"""
SELECT id, regexp_replace(regexp_replace(t, '^[,.;?!\s]+', ''), '[,.;?!\s]+$', '')
  || substr(regexp_replace(regexp_extract(t, '[^,.;?!\s]([,.;?!\s]+)$', 1), '[^.?!]', '', 'g'), 1, 1) AS trimmed FROM cases"""
)
def trim_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark).select("id", T.trim_marks(F.col("t")).alias("trimmed"))


_KEYWORDS = f"""{CASES_SQL}, parts AS (
  SELECT id, trim(unnest(string_split(replace(t, ',', ';'), ';'))) AS w, generate_subscripts(string_split(replace(t, ',', ';'), ';'), 1) AS i FROM cases
), kept AS (SELECT * FROM parts WHERE w <> '' AND NOT contains(lower(w), 'full text'))"""


@query(f"""{_KEYWORDS}, normal AS (SELECT id, i, {separated('w')} AS w FROM kept)
SELECT c.id, coalesce(string_agg(w, ' ; ' ORDER BY i), '') AS keywords FROM cases c LEFT JOIN normal n ON c.id = n.id AND n.w <> '' GROUP BY c.id""")
def keyword_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark).select("id", T.normalize_keywords(F.col("t")).alias("keywords"))


@query(f"""{_KEYWORDS}, loud AS (SELECT *, (upper(w) = w AND regexp_matches(w, '[A-Z]')) AS l FROM kept),
shares AS (SELECT id, count(*) > 5 AND 2 * count(*) FILTER (WHERE l) >= count(*) AS calm FROM loud GROUP BY id)
SELECT c.id, coalesce(string_agg({separated("CASE WHEN s.calm AND l.l THEN lower(l.w) ELSE l.w END")}, ';' ORDER BY i), '') AS keywords
FROM cases c LEFT JOIN loud l ON c.id = l.id LEFT JOIN shares s ON c.id = s.id GROUP BY c.id""")
def keyword_calm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark).select("id", T.calm_keywords(F.col("t")).alias("keywords"))


@query(
    CASES_SQL
    + r""", parts AS (
  SELECT id, trim(unnest(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '\b(and|or)\b', ',', 'g'), '\(\s*\w{1,4}\s*\)', ',', 'g'),
    '\[\s*\w{1,4}\s*\]', ',', 'g'), '[()\[\];:]', ',', 'g'), ','))) AS part FROM cases)
SELECT id, part, count(*) AS n FROM parts WHERE part <> '' GROUP BY id, part"""
)
def split_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark).select("id", F.explode(T.split_parts(F.col("t"))).alias("part")).groupBy("id", "part").agg(F.count(F.lit(1)).alias("n"))


@query(rf"""SELECT doc_id, len(list_filter(string_split_regex(text, '[,;.!?:()]+|\band\b|\bor\b'), lambda p: p <> '')) AS phrases FROM documents""")
def split_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.size(T.split_phrases(F.col("text"))).cast("long").alias("phrases"))


@query(f"""{CASES_SQL} SELECT id, {folded(squeezed("regexp_replace(trim(string_split(t, ',')[1]), '" + r"\(.*?\)|\[.*?\]" + "', ' ', 'g')"))} AS country FROM cases""")
def country_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark).select("id", T.country_name(F.col("t")).alias("country"))


_BRACES = r"regexp_replace(regexp_replace({x}, '\{{[^A-Za-z0-9_%&#}}]*([A-Za-z0-9%&#])(?:[^A-Za-z0-9_}}][^}}]*)?\}}', '\1', 'g'), '\{{[^}}]*\}}', '', 'g')"


@query(f"{CASES_SQL} SELECT id, {_BRACES.format(x='t')} AS cleaned FROM cases")
def replace_braces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark).select("id", T.replace_braces(F.col("t")).alias("cleaned"))


@query(f"""{CASES_SQL}, plain AS (SELECT id, {_BRACES.format(x=_HTML.format(x='t'))} AS p FROM cases),
parts AS (SELECT id, p, string_split(p, ';') AS s FROM plain)
SELECT id, trim(CASE WHEN NOT contains(p, ';') THEN p WHEN len(list_filter(s, lambda v: starts_with(lower(trim(v)), 'vol.'))) > 0 THEN s[1]
  ELSE string_split(s[len(s)], ',')[1] END) AS journal FROM parts""")
def journal_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark).select("id", T.journal_name(F.col("t")).alias("journal"))


@query(rf"""{CASES_SQL}, w AS (SELECT id, list_filter(string_split({squeezed('t')}, ' '), lambda x: x <> '') AS w FROM cases),
starts AS (SELECT id, w, unnest(range(1, len(w) + 1)) AS i FROM w), runs AS (SELECT id, w, i, unnest(range(1, len(w) - i + 2)) AS k FROM starts)
SELECT id, i AS first_word, k AS words, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM runs""")
def subexpressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cases(spark).select("id", F.explode(T.subexpressions(F.col("t"))).alias("phrase"), F.size(F.filter(F.split(T.squeeze(F.col("t")), " "), lambda w: w != "")).alias("n"))
    # Runs come in order of start, then length, so their places follow from the number of words.
    numbered = cases(spark).select("id", F.posexplode(T.subexpressions(F.col("t"))).alias("at", "phrase"), F.size(F.filter(F.split(T.squeeze(F.col("t")), " "), lambda w: w != "")).alias("n"))
    del rows
    starts = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: (i - 1) * F.col("n") - ((i - 1) * (i - 2) / 2).cast("int"))
    first = F.size(F.filter(starts, lambda s: s <= F.col("at")))
    return numbered.withColumn("first_word", first.cast("long")).select("id", "first_word", F.size(F.split("phrase", " ")).cast("long").alias("words"), "phrase")


@query(
    CASES_SQL
    + rf""" SELECT id, {squeezed("regexp_replace(regexp_replace(regexp_replace(t, '[sencmaruotv]{15,}', '', 'g'), '-" + chr(92) + "n', '', 'g'), '" + r"\(cid:\d+\)|\n" + "', ' ', 'g')")} AS cleaned FROM cases"""
)
def clean_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark).select("id", T.clean_ocr(F.col("t")).alias("cleaned"))


PAIRS = [(1, "organisation", "organization"), (2, "realise", "realize"), (3, "wheat", "wheats"), (4, "", ""), (5, "maize", "rice"), (6, "size", "sise"), (7, "abcdefghij", "abcdefghix")]


@query(f"""WITH p(id, a, b) AS (VALUES {values_sql(PAIRS)})
SELECT id, CASE WHEN greatest(length(a), length(b)) = 0 THEN 1.0 ELSE round(1 - CAST(levenshtein(a, b) AS DOUBLE) / greatest(length(a), length(b)), 6) END AS similarity FROM p""")
def edit_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values(spark, "id long, a string, b string", PAIRS).select("id", F.round(T.similarity(F.col("a"), F.col("b")), 6).alias("similarity"))


@query(f"""WITH p(id, a, b) AS (VALUES {values_sql(PAIRS)}), spots AS (SELECT id, a, unnest(range(3, length(a))) AS i FROM p WHERE length(a) > 5)
SELECT DISTINCT id, substr(a, 1, i - 1) || CASE substr(a, i, 1) WHEN 's' THEN 'z' ELSE 's' END || substr(a, i + 1) AS spelling FROM spots WHERE substr(a, i, 1) IN ('s', 'z')""")
def zs_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values(spark, "id long, a string, b string", PAIRS).select("id", F.explode(T.spelling_swaps(F.col("a"))).alias("spelling"))


@query(r"""SELECT doc_id, CAST(len(list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[\x20\x09-\x0D]+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '')) AS BIGINT) AS sentences FROM documents""")
def sentence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.size(T.sentences(F.col("text"))).cast("long").alias("sentences"))


YEARS = [(1, '="2015"'), (2, "201506"), (3, ""), (4, "0"), (5, "12 May 1999"), (6, "n.d."), (7, None)]


@query(f"""WITH y(id, v) AS (VALUES {values_sql(YEARS)}), p AS (SELECT id, trim(regexp_replace(v, '[="]', '', 'g')) AS v FROM y)
SELECT id, CASE WHEN v IS NULL OR v IN ('', '0') OR regexp_extract(v, '([0-9]{{4}})', 1) = '' THEN 2018 ELSE CAST(regexp_extract(v, '([0-9]{{4}})', 1) AS INTEGER) END AS year FROM p""")
def find_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values(spark, "id long, v string", YEARS).select("id", T.find_year(F.col("v")).alias("year"))


LINKS = [(1, "http://a.org/x", "10.1/2"), (2, "", "10.1/2"), (3, "ftp://b", None), (4, None, "10.3/4")]


@query(f"""WITH l(id, url, doi) AS (VALUES {values_sql(LINKS)})
SELECT id, CASE WHEN regexp_matches(url, '^https?://') THEN url WHEN doi IS NOT NULL AND doi <> '' THEN 'https://doi.org/' || doi ELSE '' END AS link FROM l""")
def article_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values(spark, "id long, url string, doi string", LINKS).select("id", T.article_link(F.col("url"), F.col("doi")).alias("link"))


@query(r"""SELECT doc_id, regexp_matches(text, '\b(idiot|clown|moron)s?s?\b') AS mentions FROM documents""")
def mentions_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.mentions_any(F.col("text"), ["idiot", "clown", "moron"]).alias("mentions"))


@query(f"""SELECT doc_id, len(list_filter(string_split({squeezed('text')}, ' '), lambda w: regexp_matches(w, '[0-9]') AND length(regexp_replace(w, '[0-9]', '', 'g')) < 2)) > 0 AS lone FROM documents""")
def lone_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.has_lone_symbol(F.col("text")).alias("lone"))
