"""Queries of phrases, vectors of phrases, synonyms, derived taxonomies and contexts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.functions.text import sentences
from litloom.operators import index, phrases
from litloom.queries.parts import postings_ctes, token_ctes
from litloom.queries.registry import query, table, values, values_sql


def worded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.with_terms(index.spread(table(spark, sf_dir, "documents").select("doc_id", "text")), ["doc_id"], F.col("text"))


def _scores(tok: str, name: str) -> str:
    return f"""{name}p AS (SELECT term AS a, lead(term) OVER (PARTITION BY id ORDER BY i) AS b FROM {tok}), {name}c AS (SELECT term, count(*) AS c FROM {tok} GROUP BY term),
{name}t AS (SELECT a, b, count(*) AS n FROM {name}p WHERE b IS NOT NULL GROUP BY a, b HAVING count(*) >= 5),
{name} AS (SELECT a, b, n, (n - 5) * (SELECT count(*) FROM {name}c) / (CAST(x.c AS DOUBLE) * y.c) AS score FROM {name}t JOIN {name}c x ON a = x.term JOIN {name}c y ON b = y.term WHERE (n - 5) * (SELECT count(*) FROM {name}c) / (CAST(x.c AS DOUBLE) * y.c) > 10)"""


@query(f"""WITH {token_ctes("documents")}, {_scores("tok", "one")}, h AS (SELECT x.id, x.i FROM tok x JOIN tok y ON y.id = x.id AND y.i = x.i + 1 JOIN one k ON k.a = x.term AND k.b = y.term),
g AS (SELECT id, i, i - row_number() OVER (PARTITION BY id ORDER BY i) AS run FROM h), t AS (SELECT id, i FROM (SELECT id, i, row_number() OVER (PARTITION BY id, run ORDER BY i) AS nth FROM g) WHERE nth % 2 = 1),
j AS (SELECT x.id, x.i, CASE WHEN t.i IS NULL THEN x.term ELSE x.term || '_' || y.term END AS term FROM tok x LEFT JOIN t ON t.id = x.id AND t.i = x.i LEFT JOIN tok y ON y.id = x.id AND y.i = x.i + 1 WHERE NOT EXISTS (SELECT 1 FROM t u WHERE u.id = x.id AND u.i = x.i - 1)),
{_scores("j", "two")} SELECT a, b, n, round(score, 6) AS score FROM two""")
def trigram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.trigrams(worded(spark, sf_dir)).select("a", "b", "n", F.round("score", 6).alias("score"))


EXPRESSIONS = [("maize storage",), ("storage bags",), ("unknown",), ("silos",)]
VECTORS = [("maize", [1.0, 0.0, 2.0]), ("storage", [0.0, 1.0, 0.0]), ("bag", [2.0, 2.0, 2.0]), ("silo", [1.0, 1.0, 1.0])]
LEMMAS = [("bags", "bag"), ("silos", "silo")]
VECTOR_ROWS = [(w, i, x) for w, v in VECTORS for i, x in enumerate(v)]


@query(f"""WITH e(phrase) AS (VALUES {values_sql(EXPRESSIONS)}), v(word, dim, x) AS (VALUES {values_sql(VECTOR_ROWS)}), l(word, lemma) AS (VALUES {values_sql(LEMMAS)}), w AS (SELECT phrase, unnest(string_split(phrase, ' ')) AS word FROM e),
r AS (SELECT phrase, CASE WHEN w.word IN (SELECT word FROM v) THEN w.word ELSE coalesce(lemma, w.word) END AS word FROM w LEFT JOIN l ON l.word = w.word) SELECT phrase, CAST(dim AS INTEGER) AS dim, avg(x) AS x FROM r JOIN v USING (word) GROUP BY phrase, dim""")
def phrase_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.phrase_vectors(values(spark, "phrase string", EXPRESSIONS), values(spark, "word string, vector array<double>", VECTORS), values(spark, "word string, lemma string", LEMMAS))
    return found.select("phrase", F.posexplode("vector").alias("dim", "x"))


KEYWORDS = [(1, "maize storage"), (2, "rice"), (3, "grain storage program")]
SYNONYMS = [("maize", "corn"), ("storage", "silo"), ("storage", "store"), ("program", "project")]


@query(f"""WITH RECURSIVE k(id, keyword) AS (VALUES {values_sql(KEYWORDS)}), s(word, synonym) AS (VALUES {values_sql(SYNONYMS)}), w AS (SELECT id, unnest(string_split(keyword, ' ')) AS word, generate_subscripts(string_split(keyword, ' '), 1) AS i FROM k),
o AS (SELECT id, i, word AS option FROM w UNION SELECT id, i, synonym FROM w JOIN s USING (word)), v AS (SELECT id, i, option AS variant FROM o WHERE i = 1 UNION ALL SELECT v.id, o.i, v.variant || ' ' || o.option FROM v JOIN o ON o.id = v.id AND o.i = v.i + 1)
SELECT id AS keyword_id, variant FROM v WHERE i = (SELECT max(i) FROM w WHERE w.id = v.id)""")
def synonym_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.expand_by_synonyms(values(spark, "keyword_id long, keyword string", KEYWORDS), values(spark, "word string, synonym string", SYNONYMS))


_COS = "list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e)))"


@query(f"""WITH RECURSIVE v AS (SELECT CAST(vec_id AS VARCHAR) AS name, label, CAST(embedding AS DOUBLE[]) AS e, vec_id % 5 AS n FROM embeddings), p AS (SELECT x.name AS a, y.name AS b FROM v x JOIN v y ON x.label = y.label AND x.name <> y.name WHERE {_COS} >= 0.6),
r AS (SELECT name AS v, name AS r FROM v UNION SELECT r.v, p.b FROM r JOIN p ON p.a = r.r), l AS (SELECT v AS name, min(r) AS label FROM r GROUP BY v), s AS (SELECT label, count(*) AS size FROM l GROUP BY label),
m AS (SELECT l.label, l.name, v.e, v.n FROM l JOIN v ON v.name = l.name), c AS (SELECT label, dim, avg(x) AS x FROM (SELECT label, unnest(e) AS x, generate_subscripts(e, 1) AS dim FROM m) GROUP BY label, dim), mean AS (SELECT label, list(x ORDER BY dim) AS e FROM c GROUP BY label),
j AS (SELECT x.label, x.name, x.n, round({_COS}, 2) AS s FROM m x JOIN mean y ON y.label = x.label), b AS (SELECT label, name AS best FROM j QUALIFY row_number() OVER (PARTITION BY label ORDER BY n DESC, s DESC, name) = 1)
SELECT count(*) AS names, count(DISTINCT CASE WHEN size >= 3 THEN best ELSE l.name END) AS representatives FROM l JOIN b USING (label) JOIN s USING (label)""")
def vector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("name"), "label", F.col("embedding").cast("array<double>").alias("vector"), (F.col("vec_id") % 5).alias("n")).withColumnRenamed("label", "kind")
    found = phrases.cluster_vectors(rows, "kind", 0.6)
    return found.agg(F.count(F.lit(1)).alias("names"), F.count_distinct("representative").alias("representatives"))


CONCEPTS = [("adoption maize storage", "Technology", 3), ("maize storage", "Technology", 5), ("maize storage program", "Technology", 2), ("project", "Social", 9), ("silo bag", "Technology", 1), ("rice", None, 4), ("loan scheme", "Social", 2)]
LAYERS = [("Technology", "silo"), ("Technology", "maize"), ("Social", "storage")]
DERIVED = [("maize storage", "Technology", "silo"), ("silo bag", "Technology", "silo"), ("loan scheme", "Social", "other")]


@query(f"SELECT * FROM (VALUES {values_sql(DERIVED)}) t(concept, class, middle)")
def derived_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.derive_taxonomy(values(spark, "concept string, class string, df long", CONCEPTS), values(spark, "word string, vector array<double>", VECTORS), values(spark, "class string, middle string", LAYERS))


FORMS = [("small holder",), ("the thing",), ("onanshat in",), ("er thion",)]


@query(f"""WITH {postings_ctes()}, f(concept) AS (VALUES {values_sql(FORMS)}) SELECT concept, CASE WHEN contains(concept, ' ') AND coalesce(b.df, 0) > 2 * coalesce(a.df, 0) THEN replace(concept, ' ', '') ELSE concept END AS form
FROM f LEFT JOIN vocab a ON a.term = concept LEFT JOIN vocab b ON b.term = replace(concept, ' ', '')""")
def frequent_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = index.build_vocabulary(index.build_postings(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return phrases.frequent_form(values(spark, "concept string", FORMS), vocab)


TERMS = [("license",), ("mit license",), ("password",)]


@query(f"""WITH s AS (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) - 1 AS place FROM (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[\\x20\\x09-\\x0D]+', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '') AS l FROM documents)),
t(term) AS (VALUES {values_sql(TERMS)}), c AS (SELECT doc_id, place, s, string_agg(s, ' ') OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS context FROM s)
SELECT doc_id, CAST(place AS INTEGER) AS place, term, md5(context) AS context FROM c JOIN t ON contains(' ' || regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g') || ' ', ' ' || term || ' ')""")
def term_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(sentences(F.col("text"))).alias("place", "sentence"))
    return phrases.contexts(rows, values(spark, "term string", TERMS)).select("doc_id", "place", "term", F.md5("context").alias("context"))


CONTEXTS = [(1, "Grow maize and rice in wet soils"), (2, "No crop here"), (3, "useful maize only"), (4, "")]
PARTS = [(1, "Grow maize and in wet soils"), (1, "Grow and rice in wet soils"), (2, "No crop here"), (3, "maize only")]


@query(f"SELECT * FROM (VALUES {values_sql(PARTS)}) t(id, part)")
def split_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.split_contexts(values(spark, "id long, context string", CONTEXTS), ["maize", "rice"], ["useful"])


@query(r"""WITH w AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(text, '[\x20\x09-\x0D]+', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM documents)
SELECT doc_id, CAST(CASE WHEN len(w) > 0 THEN (len(w) - 1) // 256 + 1 ELSE 0 END AS BIGINT) AS chunks, md5(CASE WHEN len(w) <= 64 THEN array_to_string(w, ' ') ELSE array_to_string(w[1:32] || w[len(w) - 31:], ' ') END) AS cut FROM w""")
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.filter(F.split(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")), " "), lambda w: w != "")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.size(phrases.token_chunks(F.col("text"), 256)).cast("long").alias("chunks"), words.alias("w"))
    return rows.select("doc_id", "chunks", F.md5(F.array_join(phrases.head_and_tail(F.col("w"), 64), " ")).alias("cut"))


THANKS = [(1, "This work was funded by the Bill and Melinda Gates Foundation."), (2, "Supported by grants from USAID, and financed by the World Bank."), (3, "No thanks")]
FUNDERS = [(1, "Bill and Melinda Gates Foundation"), (2, "USAID"), (2, "World Bank")]


@query(f"SELECT * FROM (VALUES {values_sql(FUNDERS)}) t(id, funder)")
def funders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values(spark, "id long, t string", THANKS).select("id", F.explode(phrases.funders(F.col("t"))).alias("funder"))
