"""Queries of the index, of search, and of the labelling steps that rest on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.functions.lexicon import DROPPED_SQL, lemma_sql
from litloom.functions.text import normalize_text, sentences, tokens
from litloom.operators import dedup, index, labels, search
from litloom.queries.parts import folded, postings_ctes, stem_sql, token_ctes
from litloom.queries.registry import query, table, values, values_sql
from litloom.storage import settle, tabled

DICTIONARY = [
    (1, "general public licenses", "GPL", "Licence", "Copyleft"), (2, "Apache License", "Apache", "Licence", "Permissive"), (3, "MIT License", "MIT", "Licence", "Permissive"),
    (4, "worthless", "Insult", "Tone", "other"), (5, "disgusting", "Insult", "Tone", "other"), (6, "pathetic", "Insult", "Tone", ""), (7, "password", "Credential", "Security", "Secret"),
    (8, "token", "Credential", "Security", "Secret"), (9, "the thtion", "Syllable", "Text", "Part"), (10, "thanedble anea", "Boilerplate", "Text", "Whole"), (11, "onanshat in", "Boilerplate", "Text", "Whole"),
]
# Texts are shuffled to spread them only in tables of a few files, since each of several scans would shuffle them again.
FEW_BYTES = 2 << 20
DICT_SCHEMA = "query_id long, query string, label string, class string, middle string"
QUERY_CTES = f"""
dict(query_id, query, label, class, middle) AS (VALUES {values_sql(DICTIONARY)}),
{token_ctes("dict", "query_id", "query", "qtok")},
qsize AS (SELECT id, count(*) AS n FROM qtok GROUP BY id),
qgrams AS (
  SELECT t.id AS query_id, t.i AS place, CASE WHEN s.n = 1 THEN 1 ELSE s.n - 1 END AS n_grams, CASE WHEN s.n = 1 THEN t.term ELSE t.term || ' ' || u.term END AS gram
  FROM qtok t JOIN qsize s ON t.id = s.id LEFT JOIN qtok u ON u.id = t.id AND u.i = t.i + 1 WHERE s.n = 1 OR u.term IS NOT NULL
),
seeds AS (
  SELECT query_id, place, n_grams, gram, gram AS seed FROM qgrams UNION SELECT query_id, place, n_grams, gram, replace(gram, ' ', '') FROM qgrams
  UNION SELECT query_id, place, n_grams, gram, substr(gram, 1, k - 1) || CASE substr(gram, k, 1) WHEN 's' THEN 'z' ELSE 's' END || substr(gram, k + 1)
  FROM (SELECT *, unnest(range(3, length(gram))) AS k FROM qgrams WHERE length(gram) > 5 AND NOT contains(gram, ' ')) WHERE substr(gram, k, 1) IN ('s', 'z')
)"""
EXACT_CTES = f"""WITH {postings_ctes()}, {QUERY_CTES},
hits AS (
  SELECT query_id, id AS doc_id FROM (SELECT DISTINCT s.query_id, s.n_grams, s.place, p.id FROM seeds s JOIN post p ON s.seed = p.term) GROUP BY query_id, n_grams, id HAVING count(*) = n_grams
)"""


def dictionary(spark: SparkSession) -> DataFrame:
    return values(spark, DICT_SCHEMA, DICTIONARY)


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.build_postings(table(spark, sf_dir, "documents").select("doc_id", "text"))


def hits(spark: SparkSession, sf_dir: str, threshold: float = 1.0) -> DataFrame:
    if threshold >= search.EXACT:
        return search.search(dictionary(spark), index.build_terms(table(spark, sf_dir, "documents").select("doc_id", "text")), None, threshold)
    posts = settle(postings(spark, sf_dir))
    return search.search(dictionary(spark), posts, index.build_vocabulary(posts), threshold)


@query(f"{EXACT_CTES} SELECT label, count(DISTINCT doc_id) AS docs FROM hits JOIN dict USING (query_id) GROUP BY label")
def dict_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = labels.dictionary_labels(hits(spark, sf_dir), dictionary(spark))
    return found.groupBy("label").agg(F.count(F.lit(1)).alias("docs"))


@query(f"{EXACT_CTES} SELECT query_id, doc_id FROM hits")
def search_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits(spark, sf_dir)


@query(f"WITH {postings_ctes()} SELECT term, prefix3, n_tokens, df FROM vocab")
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.build_vocabulary(postings(spark, sf_dir)).withColumn("n_tokens", F.col("n_tokens").cast("long"))


@query(f"WITH {postings_ctes()} SELECT prefix3, count(*) AS terms, CAST(sum(df) AS BIGINT) AS postings FROM vocab WHERE n_tokens = 1 GROUP BY prefix3")
def prefix_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = index.build_vocabulary(postings(spark, sf_dir)).where("n_tokens = 1")
    return vocab.groupBy("prefix3").agg(F.count(F.lit(1)).alias("terms"), F.sum("df").alias("postings"))


@query(f"WITH {postings_ctes()} SELECT term, df FROM vocab WHERE df >= 2 AND n_tokens = 2")
def bigram_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.trimmed_vocabulary(index.build_vocabulary(postings(spark, sf_dir))).where("n_tokens = 2").select("term", "df")


GROUPS = [(1, 7), (1, 9), (2, 1), (2, 2), (2, 3), (3, 4), (3, 5)]
_GROUPS_SQL = f"groups(group_id, query_id) AS (VALUES {values_sql(GROUPS)})"


def groups(spark: SparkSession) -> DataFrame:
    return values(spark, "group_id long, query_id long", GROUPS)


@query(f"""{EXACT_CTES}, {_GROUPS_SQL}, sizes AS (SELECT group_id, count(*) AS n FROM groups GROUP BY group_id)
SELECT group_id, doc_id FROM hits JOIN groups USING (query_id) JOIN sizes USING (group_id) GROUP BY group_id, doc_id, n HAVING count(DISTINCT query_id) = n""")
def search_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_all(hits(spark, sf_dir), groups(spark))


@query(f"{EXACT_CTES}, {_GROUPS_SQL} SELECT DISTINCT group_id, doc_id FROM hits JOIN groups USING (query_id)")
def search_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_any(hits(spark, sf_dir), groups(spark))


@query(f"{EXACT_CTES} SELECT doc_id FROM hits WHERE query_id = 9 AND doc_id NOT IN (SELECT doc_id FROM hits WHERE query_id = 4)")
def search_not(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_without(hits(spark, sf_dir), 9, 4)


_FUZZY = f"""WITH {postings_ctes()}, {QUERY_CTES},
near AS (
  SELECT q.query_id, q.place, q.n_grams, q.gram, v.term FROM qgrams q JOIN vocab v ON substr(q.gram, 1, 3) = v.prefix3 LEFT JOIN vocab o ON o.term = q.gram
  WHERE length(q.gram) >= 3 AND 1 - CAST(levenshtein(q.gram, v.term) AS DOUBLE) / greatest(length(q.gram), length(v.term)) >= 0.85
    AND (o.df IS NULL OR v.df < 4 * o.df OR v.term = q.gram)
),
spelled AS (SELECT query_id, place, n_grams, gram, term FROM near UNION SELECT s.query_id, s.place, s.n_grams, s.gram, v.term FROM seeds s JOIN vocab v ON s.seed = v.term)"""


@query(f"{_FUZZY} SELECT query_id, place - 1 AS place, gram, term FROM spelled")
def fuzzy_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = index.build_vocabulary(postings(spark, sf_dir))
    return search.expand(search.query_grams(dictionary(spark)), vocab, 0.85).select("query_id", F.col("place").cast("long").alias("place"), "gram", "term")


@query(f"""{_FUZZY} SELECT query_id, id AS doc_id FROM (SELECT DISTINCT s.query_id, s.n_grams, s.place, p.id FROM spelled s JOIN post p ON s.term = p.term)
GROUP BY query_id, n_grams, id HAVING count(*) = n_grams""")
def search_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits(spark, sf_dir, 0.85)


PATTERNS = [(1, "licen*"), (2, "pa*s*word"), (3, "thon*tion"), (4, "z*")]


@query(f"""WITH {postings_ctes()}, pats(id, pattern) AS (VALUES {values_sql(PATTERNS)})
SELECT p.id, p.pattern, v.term, v.df FROM pats p JOIN vocab v ON v.n_tokens = 1 AND regexp_matches(v.term, '^' || replace(p.pattern, '*', '[A-Za-z0-9]*') || '$')""")
def wildcard_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.wildcard(values(spark, "id long, pattern string", PATTERNS), index.build_vocabulary(postings(spark, sf_dir)))


@query(f"""{EXACT_CTES}, paths AS (
  SELECT doc_id, class || '/' || middle || '/' || label AS path FROM hits JOIN dict USING (query_id)
  UNION SELECT doc_id, class || '/' || middle || '/' FROM hits JOIN dict USING (query_id) WHERE middle NOT IN ('', 'other'))
SELECT path, count(*) AS docs FROM paths GROUP BY path""")
def hierarchy_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = labels.hierarchy_paths(hits(spark, sf_dir), dictionary(spark).withColumnRenamed("label", "name"))
    return found.groupBy("path").agg(F.count(F.lit(1)).alias("docs"))


RULES = [(1, 7, "Syllable", "Leak"), (1, 9, "Syllable", "Leak"), (2, 1, "GPL", "Free"), (3, 5, "MIT", "Never")]


@query(f"""{EXACT_CTES}, rules(rule_id, query_id, wanted, label) AS (VALUES {values_sql(RULES)}),
full_hits AS (SELECT r.rule_id, h.doc_id, r.wanted, r.label FROM hits h JOIN rules r USING (query_id)
  GROUP BY r.rule_id, h.doc_id, r.wanted, r.label HAVING count(DISTINCT r.query_id) = (SELECT count(*) FROM rules s WHERE s.rule_id = r.rule_id)),
have AS (SELECT DISTINCT doc_id, d.label AS has FROM hits JOIN dict d USING (query_id))
SELECT DISTINCT f.doc_id, f.label FROM full_hits f JOIN have ON f.doc_id = have.doc_id AND f.wanted = have.has""")
def rule_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hits(spark, sf_dir)
    return labels.rule_labels(found, labels.dictionary_labels(found, dictionary(spark)), values(spark, "rule_id long, query_id long, wanted string, label string", RULES))


@query(f"""{EXACT_CTES}, l AS (SELECT DISTINCT doc_id, label FROM hits JOIN dict USING (query_id) WHERE class = 'Licence')
SELECT d.doc_id, coalesce(l.label, 'No category') AS label FROM documents d LEFT JOIN l ON d.doc_id = l.doc_id""")
def label_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = labels.dictionary_labels(hits(spark, sf_dir), dictionary(spark).where("class = 'Licence'"))
    return labels.with_default(table(spark, sf_dir, "documents"), found, "No category")


@query(f"""{EXACT_CTES}, p AS (SELECT DISTINCT doc_id, label AS value, CASE WHEN class = 'Licence' THEN 0 WHEN class = 'Security' THEN 1 ELSE 2 END AS phase FROM hits JOIN dict USING (query_id))
SELECT doc_id, value, phase FROM p WHERE phase = (SELECT min(phase) FROM p q WHERE q.doc_id = p.doc_id)""")
def phased_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hits(spark, sf_dir).join(dictionary(spark), "query_id").select("doc_id", F.col("label").alias("value"), "class")
    phases = [found.where("class = 'Licence'"), found.where("class = 'Security'"), found.where("class not in ('Licence', 'Security')")]
    return labels.phased(table(spark, sf_dir, "documents"), phases)


RENAMES = {"GPL": "Copyleft", "MIT": "Permissive", "Apache": "Permissive"}


@query(f"""{EXACT_CTES}, l AS (SELECT DISTINCT doc_id, CASE label WHEN 'GPL' THEN 'Copyleft' WHEN 'MIT' THEN 'Permissive' WHEN 'Apache' THEN 'Permissive' ELSE label END AS label FROM hits JOIN dict USING (query_id))
SELECT doc_id, string_agg(label, ';' ORDER BY label) AS labels FROM l GROUP BY doc_id""")
def rename_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = labels.as_lists(labels.dictionary_labels(hits(spark, sf_dir), dictionary(spark)))
    return lists.select("doc_id", F.array_join(labels.rename_values(F.col("label"), RENAMES), ";").alias("labels"))


NAMES = [("maize storage intervention",), ("maize storage technology",), ("crop credit",), ("crop credit program",), ("irrigation practice",), ("irrigation",), ("cash transfer method",)]
GENERIC = ["intervention", "technology", "practice", "program", "method"]


@query(f"""WITH n(name) AS (VALUES {values_sql(NAMES)}), s AS (SELECT name, CASE WHEN contains(name, ' ') THEN regexp_replace(name, ' [^ ]+$', '') ELSE '' END AS stem, regexp_extract(name, '[^ ]+$') AS last_word FROM n),
t AS (SELECT stem, bool_and(last_word IN ({", ".join(f"'{g}'" for g in GENERIC)})) AND count(*) > 1 AND stem <> '' AS merged FROM s GROUP BY stem)
SELECT name, CASE WHEN merged THEN stem || ' intervention' ELSE name END AS searched FROM s JOIN t USING (stem)""")
def sibling_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.merge_siblings(values(spark, "name string", NAMES), GENERIC)


MARKERS, MODIFIERS = ["thon", "thor", "eron"], ["ther", "tion", "thing"]
_LIST = lambda ws: ", ".join(f"'{w}'" for w in ws)


@query(f"""WITH {token_ctes("documents")}, near AS (SELECT DISTINCT m.id FROM tok m JOIN tok d ON m.id = d.id AND abs(m.i - d.i) <= 5 WHERE m.term IN ({_LIST(MARKERS)}) AND d.term IN ({_LIST(MODIFIERS)}))
SELECT doc_id, doc_id IN (SELECT id FROM near) AS tagged FROM documents""")
def proximity_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", labels.proximity(F.col("text"), MARKERS, MODIFIERS).alias("tagged"))


_SENTENCE = f"""coalesce({folded("list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[" + chr(92) + "x20" + chr(92) + "x09-" + chr(92) + "x0D]+', '" + chr(92) + "1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '')[1]")}, '')"""


def numbered_sql(x: str) -> str:
    words = f"list_filter(string_split(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '' AND w NOT IN ({DROPPED_SQL}) AND (length(w) > 1 OR regexp_matches(w, '^[0-9]$')))"
    return f"list_transform(list_transform({words}, lambda x: {lemma_sql('x')}), lambda y: {stem_sql('y')})"


def _weights(source: str, name: str, total: str) -> str:
    return f"""{name}_tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(w) AS term FROM {source}) GROUP BY id, term),
{name}_idf AS (SELECT term, ln((1 + (SELECT count(*) FROM {total})) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf FROM {name}_tf GROUP BY term),
{name}_raw AS (SELECT id, term, tf * idf AS r FROM {name}_tf JOIN {name}_idf USING (term)), {name}_norm AS (SELECT id, sqrt(sum(r * r)) AS norm FROM {name}_raw GROUP BY id),
{name} AS (SELECT r.id, term, r / norm AS w FROM {name}_raw r JOIN {name}_norm n ON r.id = n.id)"""


def duplicates_sql(source: str, who: str, order: str) -> str:
    """CTEs that end in dups(a, b, title_similarity, title_cosine, text_cosine) among uniq(doc_id, text, title, kind)."""
    return f"""WITH arts AS (SELECT *, len({numbered_sql("title")}) = 0 AS bare FROM ({source})), {who},
ttl AS (SELECT doc_id AS id, {numbered_sql("title")} AS w FROM uniq), body AS (SELECT doc_id AS id, {numbered_sql("text")} AS w FROM uniq),
{_weights("ttl", "tw", "uniq")}, {_weights("body", "bw", "uniq")},
blocks AS (SELECT u.doc_id, u.title, u.kind, trim(u.text) = '' AS blank, array_to_string(t.w[1:2], ' ') AS block FROM uniq u JOIN ttl t ON t.id = u.doc_id WHERE len(t.w) > 0),
met AS (SELECT x.doc_id AS a, y.doc_id AS b, x.blank OR y.blank AS spared, CASE WHEN greatest(length(x.title), length(y.title)) = 0 THEN 1.0 ELSE 1 - CAST(levenshtein(x.title, y.title) AS DOUBLE) / greatest(length(x.title), length(y.title)) END AS s FROM blocks x JOIN blocks y ON x.block = y.block AND {order}),
tc AS (SELECT a, b, sum(x.w * y.w) AS c FROM met JOIN tw x ON x.id = a JOIN tw y ON y.id = b AND y.term = x.term GROUP BY a, b), near AS (SELECT m.a, m.b, m.spared, CASE WHEN s >= 0.9 THEN s ELSE 0.0 END AS ts, coalesce(c, 0) AS tc FROM met m LEFT JOIN tc ON tc.a = m.a AND tc.b = m.b WHERE s >= 0.9 OR c > 0.8),
bc AS (SELECT a, b, sum(x.w * y.w) AS c FROM near JOIN bw x ON x.id = a JOIN bw y ON y.id = b AND y.term = x.term GROUP BY a, b),
dups AS (SELECT n.a, n.b, ts, tc, coalesce(c, 0) AS cosine FROM near n LEFT JOIN bc ON bc.a = n.a AND bc.b = n.b WHERE ((ts >= 0.9 OR tc >= 0.95) AND (coalesce(c, 0) >= 0.85 OR spared)) OR (tc > 0.8 AND coalesce(c, 0) >= 0.94))"""


_LAST = "uniq AS (SELECT * FROM arts WHERE bare OR doc_id IN (SELECT max(doc_id) FROM arts WHERE NOT bare GROUP BY text))"
_DUP = duplicates_sql(f"SELECT doc_id, coalesce(text, '') AS text, {_SENTENCE} AS title, 0 AS kind FROM documents", _LAST, "x.doc_id < y.doc_id")


@query(f"{_DUP} SELECT a, b, round(ts, 6) AS title_similarity, round(tc, 5) AS title_cosine, round(cosine, 5) AS text_cosine FROM dups")
def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tabled(dedup.distinct_articles(dedup.articles(index.spread(table(spark, sf_dir, "documents")))))
    return dedup.duplicate_pairs(rows).select("a", "b", F.round("title_similarity", 6).alias("title_similarity"), F.round("title_cosine", 5).alias("title_cosine"), F.round("text_cosine", 5).alias("text_cosine"))


@query(f"{_DUP} SELECT doc_id, doc_id IN (SELECT doc_id FROM uniq) AND doc_id NOT IN (SELECT a FROM dups) AS kept FROM documents")
def dedup_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.deduplicate(index.spread(table(spark, sf_dir, "documents"), FEW_BYTES))


_RANKED = "coalesce(list_position(['Scopus', 'ISI', 'CABI'], CASE source WHEN 'src0' THEN 'Scopus' WHEN 'src1' THEN 'ISI' WHEN 'src2' THEN 'CABI' END), 9)"
_FIRST = "uniq AS (SELECT * FROM arts QUALIFY row_number() OVER (PARTITION BY text, CASE WHEN bare THEN doc_id END ORDER BY kind, doc_id) = 1)"
_BY_SOURCE = duplicates_sql(f"SELECT doc_id, coalesce(text, '') AS text, {_SENTENCE} AS title, {_RANKED} AS kind FROM documents", _FIRST, "x.doc_id < y.doc_id")


@query(f"""{_BY_SOURCE}, g AS (SELECT CASE WHEN (trim(x.text) = '') <> (trim(y.text) = '') THEN CASE WHEN trim(x.text) = '' THEN a ELSE b END WHEN x.kind > y.kind THEN a ELSE b END AS doc_id FROM dups JOIN uniq x ON x.doc_id = a JOIN uniq y ON y.doc_id = b)
SELECT doc_id, doc_id IN (SELECT doc_id FROM uniq) AND doc_id NOT IN (SELECT doc_id FROM g) AS kept FROM documents""")
def dedup_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.when(F.col("source") == "src0", "Scopus").when(F.col("source") == "src1", "ISI").when(F.col("source") == "src2", "CABI").otherwise("Other")
    return dedup.deduplicate(index.spread(table(spark, sf_dir, "documents").withColumn("dataset", names), FEW_BYTES), source_col="dataset")


_TWO = duplicates_sql(f"SELECT doc_id, coalesce(text, '') AS text, {_SENTENCE} AS title, CASE WHEN doc_id % 2 = 0 THEN 0 ELSE 1 END AS kind FROM documents", "uniq AS (SELECT * FROM arts)", "x.kind = 0 AND y.kind = 1")


@query(f"{_TWO} SELECT doc_id FROM documents WHERE doc_id % 2 = 0 AND doc_id NOT IN (SELECT a FROM dups)")
def new_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with even ids as the new set, those with odd ids as the old one."""
    docs = index.spread(table(spark, sf_dir, "documents").select("doc_id", "text"), FEW_BYTES)
    return dedup.new_articles(docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 <> 0")).select("doc_id")


@query("""WITH u AS (SELECT text, max(doc_id) AS doc_id, count(*) AS copies, string_agg(DISTINCT source, ';' ORDER BY source) AS sources FROM documents GROUP BY text) SELECT doc_id, copies, sources FROM u""")
def dedup_list_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").groupBy(F.md5("text"), F.xxhash64("text")).agg(F.max("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.array_join(F.array_sort(F.collect_set("source")), ";").alias("sources"))
    return rows.select("doc_id", "copies", "sources")


@query(f"""WITH {token_ctes("documents")}, {token_ctes("benchmark", "item_id", "text", "items")},
d AS (SELECT DISTINCT id, term FROM tok), b AS (SELECT DISTINCT id, term FROM items), n AS (SELECT id, count(*) AS n FROM b GROUP BY id)
SELECT b.id AS item_id, d.id AS doc_id, count(*) AS shared FROM b JOIN d USING (term) JOIN n ON n.id = b.id GROUP BY b.id, d.id, n.n HAVING 10 * count(*) >= 9 * n.n""")
def benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    def words(name: str, id_: str) -> DataFrame:
        return table(spark, sf_dir, name).select(F.col(id_), F.explode(F.array_distinct(tokens(normalize_text(F.col("text"))))).alias("term"))

    docs, items = words("documents", "doc_id"), words("benchmark", "item_id")
    sizes = items.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    shared = items.join(docs, "term").groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("shared"))
    return shared.join(sizes, "item_id").where("10 * shared >= 9 * n").select("item_id", "doc_id", "shared")


@query(f"""WITH s AS (SELECT doc_id, unnest(list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[\\x20\\x09-\\x0D]+', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '')) AS sentence FROM documents),
n AS (SELECT doc_id, sentence, unnest(regexp_extract_all(sentence, '\\b[0-9]\\w*')) AS number FROM s), c(concept) AS (VALUES ('license'), ('token'), ('version'))
SELECT doc_id, number, concept, count(*) AS n FROM n JOIN c ON contains(lower(sentence), concept) GROUP BY doc_id, number, concept""")
def number_concept_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(sentences(F.col("text"))).alias("sentence"))
    concepts = F.filter(F.array(*[F.lit(c) for c in ("license", "token", "version")]), lambda c: F.contains(F.lower(F.col("sentence")), c))
    numbers = F.regexp_extract_all("sentence", F.lit(r"\b[0-9]\w*"), F.lit(0))
    rows = rows.select("doc_id", concepts.alias("concepts"), F.explode(numbers).alias("number"))
    return rows.select("doc_id", "number", F.explode("concepts").alias("concept")).groupBy("doc_id", "number", "concept").agg(F.count(F.lit(1)).alias("n"))
