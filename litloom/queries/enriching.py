"""Queries of repairs, places, measurements and learned models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.functions import repair
from litloom.operators import geo, index, learned, measurements
from litloom.queries.parts import postings_ctes, squeezed
from litloom.queries.registry import query, table, values, values_sql
from litloom.queries.searching import postings
from litloom.storage import settle

TEXTS = [
    (1, "Report; Soil; The yield of maize; rose"), (2, "Soil; continued here; more"), (3, "no semicolon"), (4, "A longer part of text here.; x; and more words that follow"), (5, "Title of work [in French] [summary]"), (6, "[Whole title in brackets]"),
    (7, "Univ of of Rome Univ"), (8, "I F A D office (Rome)"), (9, ""), (10, "The Institute, a (small) one"),
]
TEXTS_SQL = f"WITH cases(id, t) AS (VALUES {values_sql(TEXTS)})"


def texts(spark: SparkSession) -> DataFrame:
    return values(spark, "id long, t string", TEXTS)


@query(f"""{TEXTS_SQL}, w AS (SELECT id, unnest(string_split({squeezed('t')}, ' ')) AS w, generate_subscripts(string_split({squeezed('t')}, ' '), 1) AS i FROM cases),
f AS (SELECT id, w, min(i) AS a, max(i) AS b FROM w GROUP BY id, w) SELECT id, string_agg(w, ' ' ORDER BY a) AS first, string_agg(w, ' ' ORDER BY b) AS last FROM f GROUP BY id""")
def distinct_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark).select("id", repair.first_words(F.col("t")).alias("first"), repair.last_words(F.col("t")).alias("last"))


@query(f"""{TEXTS_SQL} SELECT id, {squeezed("translate(CASE WHEN trim(regexp_replace(t, '" + r"\(.*?\)" + "', '', 'g')) <> '' THEN trim(regexp_replace(t, '" + r"\(.*?\)" + "', '', 'g')) ELSE t END, '()', '')")} AS plain FROM cases""")
def round_brackets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark).select("id", repair.drop_brackets(F.col("t")).alias("plain"))


SOURCE_NAMES = ["Scopus", "CAB", "Econlit", "Proquest", "Web of Science", "Agricola", "ISI", "CABI", "African", "CLRTB_PHL"]


@query(f"""WITH n AS (SELECT CASE WHEN length(source) < 5 THEN ({values_sql([tuple(SOURCE_NAMES)])[1:-1].join(["[", "]"])})[CAST(substr(source, 4) AS INTEGER) + 1] ELSE source END AS source FROM documents)
SELECT source, CASE WHEN source IN ({values_sql([tuple(SOURCE_NAMES)])[1:-1]}) THEN 'Science Journals' ELSE 'Grey Literature' END AS kind, count(*) AS n FROM n GROUP BY 1, 2""")
def dataset_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-digit sources of the documents under the names of science sources, the others under their own."""
    names = F.array(*[F.lit(n) for n in SOURCE_NAMES])
    named = F.when(F.length("source") < 5, F.element_at(names, F.substr("source", F.lit(4)).try_cast("int") + 1)).otherwise(F.col("source"))
    rows = table(spark, sf_dir, "documents").select(named.alias("source"))
    return rows.groupBy("source", repair.dataset_type(F.col("source")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


RANKS = [("thon", 120), ("ering", 900), ("er", 40), ("nd", 4000)]


@query(f"""WITH {postings_ctes()}, r(word, rank) AS (VALUES {values_sql(RANKS)}), w AS (SELECT term AS word FROM vocab WHERE n_tokens = 1),
f AS (SELECT word, unnest([word, regexp_replace(word, 'ing$', ''), regexp_replace(word, 'ing$', 'e'), regexp_replace(word, 's$', ''), regexp_replace(word, 'es$', ''), regexp_replace(word, 'ed$', ''), regexp_replace(word, 'd$', ''),
  CASE WHEN length(word) >= 7 THEN regexp_replace(word, '^in', '') END, CASE WHEN length(word) >= 7 THEN regexp_replace(word, '^un', '') END, CASE WHEN length(word) >= 7 THEN regexp_replace(word, '^im', '') END,
  CASE WHEN length(word) >= 7 THEN regexp_replace(word, '^ir', '') END, CASE WHEN length(word) >= 7 THEN regexp_replace(word, '^sub', '') END]) AS form FROM w)
SELECT w.word, least(coalesce(min(r.rank), 5000), 5000) / 5000.0 AS rank FROM w LEFT JOIN f ON f.word = w.word LEFT JOIN r ON r.word = f.form GROUP BY w.word""")
def word_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = index.build_vocabulary(postings(spark, sf_dir)).where("n_tokens = 1")
    return repair.word_ranks(vocab.select(F.col("term").alias("word")), values(spark, "word string, rank int", RANKS))


HEADS = ["the", "was", "that", "with"]


@query(f"""WITH {postings_ctes()}, h(head) AS (VALUES {", ".join(f"('{x}')" for x in HEADS)}), p AS (
  SELECT v.term AS word, head, CASE WHEN starts_with(v.term, head) THEN substr(v.term, length(head) + 1) WHEN ends_with(v.term, head) THEN substr(v.term, 1, length(v.term) - length(head)) END AS rest
  FROM vocab v, h WHERE v.n_tokens = 1 AND v.df <= 5)
SELECT word, head, rest FROM p JOIN vocab f ON f.term = rest AND f.n_tokens = 1 WHERE length(rest) >= 4 AND f.df > 70""")
def glued_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.glued_words(index.build_vocabulary(postings(spark, sf_dir)), HEADS)


GAZETTEER = [("Thon", "country", "Thon"), ("Eron", "province", "Atland"), ("Onanshat in", "district", "Beland"), ("Nowhere", "country", "Nowhere")]
REGIONS = [("Thon", "North"), ("Atland", "North"), ("Atland", "Coast"), ("Beland", "South")]


@query(f"""WITH {postings_ctes()}, g(name, kind, country, term) AS (VALUES ('Thon', 'country', 'Thon', 'thon'), ('Eron', 'province', 'Atland', 'eron'), ('Onanshat in', 'district', 'Beland', 'onanshat'), ('Nowhere', 'country', 'Nowhere', 'nowhere')),
m AS (SELECT DISTINCT id, country FROM post JOIN g USING (term)), r(country, region) AS (VALUES {values_sql(REGIONS)})
SELECT region, count(DISTINCT id) AS docs FROM m JOIN r USING (country) GROUP BY region""")
def geo_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = geo.mentions(postings(spark, sf_dir), values(spark, "name string, kind string, country string", GAZETTEER))
    places = geo.regions(found, values(spark, "country string, region string", REGIONS))
    return places.groupBy("region").agg(F.count(F.lit(1)).alias("docs"))


@query(r"""WITH s AS (SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) - 1 AS place FROM (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[\x20\x09-\x0D]+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '') AS l FROM documents)),
w AS (SELECT doc_id, place, list_filter(string_split_regex(lower(s), '[^a-z0-9]+'), lambda w: w <> '') AS w FROM s), u AS (SELECT doc_id, place, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
n AS (SELECT * FROM u WHERE regexp_matches(word, '^[0-9]')), c AS (SELECT * FROM u WHERE word IN ('license', 'token', 'version', 'licensed'))
SELECT n.doc_id, CAST(n.place AS INTEGER) AS place, n.word AS number, c.word AS concept, CAST(abs(c.i - n.i) AS INTEGER) AS distance FROM n JOIN c ON c.doc_id = n.doc_id AND c.place = n.place
QUALIFY row_number() OVER (PARTITION BY n.doc_id, n.place, n.i ORDER BY abs(c.i - n.i), c.i) = 1""")
def closest_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measurements.closest_concepts(table(spark, sf_dir, "documents"), ["license", "token", "version", "licensed"])


@query(r"""WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])[\x20\x09-\x0D]+', '\1' || chr(1), 'g'), chr(1))) AS s FROM documents),
l AS (SELECT doc_id, CASE WHEN regexp_matches(s, '(?i)licensed|released under') THEN 'Licence' END AS a, CASE WHEN regexp_matches(s, 'password|token') THEN 'Secret' END AS b FROM s)
SELECT label, count(DISTINCT doc_id) AS docs, count(*) AS sentences FROM (SELECT doc_id, a AS label FROM l UNION ALL SELECT doc_id, b FROM l) WHERE label IS NOT NULL GROUP BY label""")
def sentence_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = {"Licence": F.col("sentence").rlike("(?i)licensed|released under").cast("double"), "Secret": F.col("sentence").rlike("password|token").cast("double")}
    found = measurements.label_sentences(table(spark, sf_dir, "documents"), scores)
    return found.groupBy("label").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size("details")).alias("sentences"))


@query("SELECT CASE WHEN (doc_id % 100) / 100.0 < 0.1 THEN 'Unlikely' WHEN (doc_id % 100) / 100.0 < 0.4 THEN 'Less likely' ELSE 'More likely' END AS priority, count(*) AS n FROM documents GROUP BY 1")
def priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(measurements.priority((F.col("doc_id") % 100) / 100).alias("priority")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT * FROM (VALUES (1, 'maize', 'wheat'), (2, 'drip irrigation', 'flooding'), (3, 'rice', 'oats')) t(id, a, b)")
def comparisons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = values(spark, "id long, s string", [(1, "A comparison of maize and wheat."), (2, "We compared drip irrigation with flooding"), (3, "the difference between rice and oats"), (4, "")])
    return rows.select("id", F.explode(measurements.comparisons(F.col("s"))).alias("p")).select("id", "p.*")


@query()
def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = settle(learned.with_words(index.spread(table(spark, sf_dir, "documents").select("doc_id", "text"))).select("doc_id", "words"))
    model = learned.fit_topics(docs, 8, iterations=5)
    return learned.document_topics(model, docs)


@query()
def word_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = index.with_terms(index.spread(table(spark, sf_dir, "documents").select("doc_id", "text")), [], F.coalesce("text", F.lit("")))
    return learned.fit_vectors(docs, 32).findSynonyms("thon", 10)


@query()
def classifier_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("double").alias("label"))
    docs = settle(learned.with_words(index.spread(table(spark, sf_dir, "documents").select("doc_id", "text"))).join(labels, "doc_id").select("doc_id", "words", "label"))
    model = learned.fit_classifier(docs.where("doc_id % 4 <> 0"))
    return learned.macro_f1(model.transform(docs.where("doc_id % 4 = 0")))
