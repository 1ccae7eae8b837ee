"""Queries of evaluation and cross-tabs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.operators import evaluation as E
from litloom.operators import index
from litloom.queries.parts import token_ctes
from litloom.queries.registry import query, table, values, values_sql
from litloom.queries.searching import EXACT_CTES, hits


@query("""WITH l AS (SELECT e.user_id, list(DISTINCT event_type) AS t FROM events e GROUP BY user_id), c AS (SELECT user_id % 7 AS region, CASE WHEN list_contains(t, 'purchase') THEN 'purchase' WHEN list_contains(t, 'signup') THEN 'signup' ELSE 'Undefined' END AS class FROM l)
SELECT region, class, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY region), 6) AS share FROM c GROUP BY region, class""")
def exclusive_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("types")).withColumn("region", F.col("user_id") % 7)
    return E.exclusive_classes(rows, "region", "types", ["purchase", "signup"])


@query("""SELECT source, count(*) FILTER (WHERE quality = 1) AS quality, count(*) FILTER (WHERE toxic = 1) AS toxic, count(*) FILTER (WHERE quality = 1 OR toxic = 1) AS "any" FROM documents JOIN labels USING (doc_id) GROUP BY source""")
def classes_and_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    return E.classes_and_any(rows, "source", {"quality": F.col("quality") == 1, "toxic": F.col("toxic") == 1})


_KEYWORDS = f"""WITH {token_ctes("documents")}, f AS (SELECT DISTINCT id AS doc_id, lower(term) AS k FROM tok WHERE i <= 3), g AS (SELECT DISTINCT id AS doc_id, lower(term) AS k FROM tok WHERE i IN (2, 3, 4, 5)),
m AS (SELECT f.doc_id, count(DISTINCT f.k) AS hf, count(DISTINCT g.k) AS hg FROM f JOIN g USING (doc_id) WHERE (CASE WHEN f.k = g.k THEN 1.0 ELSE 1 - CAST(levenshtein(f.k, g.k) AS DOUBLE) / greatest(length(f.k), length(g.k)) END) >= 0.77 GROUP BY f.doc_id),
n AS (SELECT doc_id, nf, ng FROM (SELECT doc_id, count(*) AS nf FROM f GROUP BY doc_id) JOIN (SELECT doc_id, count(*) AS ng FROM g GROUP BY doc_id) USING (doc_id)),
s AS (SELECT n.doc_id, coalesce(hf, 0) / CAST(nf AS DOUBLE) AS p, coalesce(hg, 0) / CAST(ng AS DOUBLE) AS r FROM n LEFT JOIN m ON m.doc_id = n.doc_id)"""


@query(f"""{_KEYWORDS} SELECT lang AS kind, count(*) AS docs, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, count(*) FILTER (WHERE r >= 0.5) AS above_50, count(*) FILTER (WHERE r >= 0.7) AS above_70, count(*) FILTER (WHERE r = 0 OR p = 0) AS zero
FROM s JOIN documents d USING (doc_id) GROUP BY lang""")
def keyword_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    from litloom.functions.text import normalize_text, tokens

    docs = table(spark, sf_dir, "documents")
    words = index.spread(docs.select("doc_id", "text")).select("doc_id", tokens(normalize_text(F.col("text"))).alias("w"))
    part = lambda at, n: words.select("doc_id", F.explode(F.slice("w", at, n)).alias("keyword"))
    return E.recall_report(E.keyword_recall(part(1, 3), part(2, 4)), docs.select("doc_id", F.col("lang").alias("kind")))


@query("""WITH c AS (SELECT lang AS label, source AS model, sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN quality = 0 AND toxic = 1 THEN 1 ELSE 0 END) AS fn FROM documents JOIN labels USING (doc_id) GROUP BY lang, source),
f AS (SELECT label, model, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0.0 END AS f1 FROM c) SELECT label, model, round(f1, 6) AS f1 FROM f QUALIFY row_number() OVER (PARTITION BY label ORDER BY f1 DESC, model) = 1""")
def best_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"), F.col("source").alias("model")).join(table(spark, sf_dir, "labels"), "doc_id")
    of = lambda p, t: F.count_if((F.col("quality") == p) & (F.col("toxic") == t))
    return E.best_models(rows.groupBy("label", "model").agg(of(1, 1).alias("tp"), of(1, 0).alias("fp"), of(0, 1).alias("fn")))


@query("SELECT DISTINCT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS label FROM labels WHERE toxic = 1 OR doc_id % 2 = 0")
def any_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("label"), (F.col("toxic") == 1).alias("a"), (F.col("doc_id") % 2 == 0).alias("b"))
    return E.any_part(rows, ["a", "b"])


@query("""SELECT doc_id, length(text) - strpos(reverse(lower(text)), reverse('ion')) - 2 AS start, length(text) - strpos(reverse(lower(text)), reverse('ion')) + 1 AS "end" FROM documents WHERE contains(lower(text), 'ion')""")
def last_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", E.last_span(F.col("text"), F.lit("iOn")).alias("s")).where("s is not null").select("doc_id", F.col("s.start").cast("long").alias("start"), F.col("s.end").cast("long").alias("end"))


CODES = [("SRC1", "Soil"), ("EN", "English"), ("SRC2", "Water")]
SECTORS = [("Land", "Soil", None), ("Land", "Water", None), ("Secret", "English", 7), ("Secret", "English", 8), ("None", "Nothing", None)]


@query(f"""{EXACT_CTES}, c(code, name) AS (VALUES {values_sql(CODES)}), r(sector, name, query_id) AS (VALUES {values_sql(SECTORS)}), d AS (SELECT doc_id, upper(source) AS code FROM documents UNION SELECT doc_id, upper(lang) FROM documents),
k AS (SELECT DISTINCT doc_id, sector FROM d JOIN c USING (code) JOIN r USING (name)), f AS (SELECT * FROM k WHERE sector = 'Land' UNION SELECT k.* FROM k JOIN r USING (sector) JOIN hits h ON h.query_id = r.query_id AND h.doc_id = k.doc_id) SELECT sector, count(*) AS docs FROM f GROUP BY sector""")
def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.array("source", "lang").alias("codes"))
    found = E.sectors(docs, values(spark, "code string, name string", CODES), values(spark, "sector string, name string, query_id long", SECTORS), hits(spark, sf_dir))
    return found.groupBy("sector").agg(F.count(F.lit(1)).alias("docs"))


@query("""WITH f AS (SELECT doc_id AS id, source AS l FROM documents UNION ALL SELECT doc_id, CASE WHEN toxic = 1 THEN 'toxic' END FROM labels UNION ALL SELECT item_id - 1000, NULL FROM benchmark) SELECT id, coalesce(string_agg(DISTINCT l, ';' ORDER BY l), '') AS labels FROM f GROUP BY id""")
def merged_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.array("source").alias("labels"))
    marks = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.filter(F.array(F.when(F.col("toxic") == 1, F.lit("toxic"))), lambda x: x.isNotNull()).alias("labels"))
    items = table(spark, sf_dir, "benchmark").select((F.col("item_id") - 1000).alias("id"), F.array().cast("array<string>").alias("labels"))
    return E.merge_label_files([docs, marks, items], "id", "labels").select("id", F.array_join("labels", ";").alias("labels"))


@query("""WITH n AS (SELECT quality, toxic, count(*) AS n FROM labels GROUP BY quality, toxic), c AS (SELECT quality * 2 + toxic AS class, n FROM n) SELECT class, n AS rows, (SELECT max(n) FROM c) AS balanced, CAST(least(n, (SELECT max(n) FROM c)) AS BIGINT) AS kinds FROM c""")
def balanced_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") * 2 + F.col("toxic")).alias("class"))
    counts = rows.groupBy("class").agg(F.count(F.lit(1)).alias("rows"))
    made = E.balanced(rows, "class", "doc_id").groupBy("class").agg(F.count(F.lit(1)).alias("balanced"), F.count_distinct("doc_id").alias("kinds"))
    return counts.join(made, "class")


ASSIGNED = [(1, "a", "g", "f"), (2, "a", "g", "f"), (3, "a", "g", "f"), (4, "b", "g", None), (5, "c", "g", "f"), (6, "c", "g", "f"), (7, "d", "h", None), (8, "e", "h", None)]
CLUSTER_VECTORS = [("a", [1.0, 0.0]), ("b", [0.9, 0.1]), ("c", [0.0, 1.0]), ("d", [1.0, 1.0]), ("e", [0.0, 0.0])]
PRUNED = [(1, "a"), (2, "a"), (3, "a"), (4, "a"), (5, "c"), (6, "c"), (7, "d"), (8, "e")]


@query(f"SELECT * FROM (VALUES {values_sql(PRUNED)}) t(doc_id, cluster)")
def pruned_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = values(spark, "doc_id long, cluster string, group string, focus string", ASSIGNED)
    return E.prune_clusters(rows, values(spark, "cluster string, vector array<double>", CLUSTER_VECTORS), 2, 0.2)
