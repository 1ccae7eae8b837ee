"""Queries of joins, set operations, ranking and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.operators import relations as R
from litloom.queries.registry import query, table, values, values_sql


@query("""SELECT r.r_name AS region, count(*) AS customers, count(DISTINCT n.n_nationkey) AS nations, round(sum(c.c_acctbal), 2) AS balance
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name""")
def geo_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    joined = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return joined.groupBy(F.col("r_name").alias("region")).agg(F.count(F.lit(1)).alias("customers"), F.countDistinct("n_nationkey").alias("nations"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


PLACES = [(1, "Nation_3"), (2, "nation 4 province"), (3, " NATION_5 "), (4, "Atlantis")]


@query(f"""WITH p(id, raw) AS (VALUES {values_sql(PLACES)})
SELECT id, raw, coalesce(a.n_nationkey, b.n_nationkey, c.n_nationkey) AS n_nationkey FROM p
LEFT JOIN nation a ON p.raw = a.n_name LEFT JOIN nation b ON upper(trim(p.raw)) = b.n_name
LEFT JOIN nation c ON upper(replace(replace(trim(p.raw), ' province', ''), ' ', '_')) = c.n_name""")
def coalesced_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = values(spark, "id long, raw string", PLACES)
    plain = F.trim("raw")
    keys = [F.col("raw"), F.upper(plain), F.upper(F.replace(F.replace(plain, F.lit(" province"), F.lit("")), F.lit(" "), F.lit("_")))]
    return R.coalesced_lookup(rows, table(spark, sf_dir, "nation"), keys, "n_name", "n_nationkey")


@query("SELECT count(*) AS docs FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def unlabelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")
    return left.agg(F.count(F.lit(1)).alias("docs"))


@query("SELECT d.doc_id, d.lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)")
def labelled_toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    toxic = table(spark, sf_dir, "labels").where("toxic = 1")
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(toxic, "doc_id", "left_semi")


@query("""SELECT 'document' AS kind, doc_id AS id, lang, NULL AS role, length(text) AS chars FROM documents
UNION ALL SELECT 'turn', conv_id, NULL, role, length(text) FROM conversations""")
def union_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "lang", F.length("text").cast("long").alias("chars"))
    turns = table(spark, sf_dir, "conversations").select(F.lit("turn").alias("kind"), F.col("conv_id").alias("id"), "role", F.length("text").cast("long").alias("chars"))
    return R.union_widen(docs, turns)


@query("""WITH a AS (SELECT doc_id FROM labels WHERE quality = 1), b AS (SELECT doc_id FROM labels WHERE toxic = 1)
SELECT 'both' AS part, doc_id FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'only', doc_id FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'either', doc_id FROM (SELECT * FROM a UNION SELECT * FROM b)""")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (table(spark, sf_dir, "labels").where(c).select("doc_id") for c in ("quality = 1", "toxic = 1"))
    named = lambda df, part: df.select(F.lit(part).alias("part"), "doc_id")
    return named(a.intersect(b), "both").unionByName(named(a.subtract(b), "only")).unionByName(named(a.union(b).distinct(), "either"))


@query("SELECT source, lang, min(doc_id) AS doc_id, arg_min(n_chars, doc_id) AS n_chars FROM documents GROUP BY source, lang")
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.keep_first(table(spark, sf_dir, "documents").select("source", "lang", "doc_id", "n_chars"), ["source", "lang"], [F.col("doc_id")])


@query("""SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY substr(md5('quota:' || CAST(doc_id AS VARCHAR)), 1, 12), doc_id) AS place FROM documents) WHERE place <= 50""")
def quota_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.quota(table(spark, sf_dir, "documents").select("lang", "doc_id"), ["lang"], 50, "doc_id")


@query("""SELECT doc_id, quality FROM labels WHERE substr(md5('balance:' || CAST(doc_id AS VARCHAR)), 1, 12) < CASE WHEN quality = 1 THEN '333333333333' ELSE 'ffffffffffff' END""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    limit = F.when(F.col("quality") == 1, F.lit("333333333333")).otherwise(F.lit("ffffffffffff"))
    return table(spark, sf_dir, "labels").select("doc_id", "quality").where(R.draw(F.col("doc_id"), "balance") < limit)


@query("""SELECT o_orderpriority, o_orderkey, o_totalprice FROM (SELECT o_orderpriority, o_orderkey, o_totalprice,
row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders) WHERE place <= 10""")
def topk_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return rows.withColumn("place", place).where("place <= 10").drop("place")


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type)
SELECT user_id, string_agg(event_type, ';' ORDER BY event_type) AS modes FROM c WHERE n = (SELECT max(n) FROM c d WHERE d.user_id = c.user_id) GROUP BY user_id""")
def modes_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = R.modes(table(spark, sf_dir, "events").select("user_id", "event_type"), "user_id", "event_type")
    return found.select("user_id", F.array_join("modes", ";").alias("modes"))


@query("""SELECT doc_id, coalesce(id, (SELECT count(*) FROM labels WHERE quality = 1) + row_number() OVER (PARTITION BY id IS NULL ORDER BY doc_id)) AS id
FROM (SELECT doc_id, CASE WHEN quality = 1 THEN row_number() OVER (PARTITION BY quality ORDER BY doc_id) END AS id FROM labels)""")
def assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    own = F.when(F.col("quality") == 1, F.row_number().over(Window.partitionBy("quality").orderBy("doc_id")).cast("long"))
    rows = table(spark, sf_dir, "labels").select("doc_id", own.alias("id"))
    return R.assign_ids(rows, "id", [F.col("doc_id")])


@query("""WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY substr(md5('review:' || CAST(doc_id AS VARCHAR)), 1, 12), doc_id) - 1 AS i, count(*) OVER () AS n FROM labels WHERE toxic = 1)
SELECT doc_id, CAST(least(i // greatest(n // 4, 1), 3) AS INTEGER) AS reviewer FROM n""")
def assign_reviewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id", F.lit(None).cast("long").alias("id"))
    numbered = R.assign_ids(rows, "id", [R.draw(F.col("doc_id"), "review"), F.col("doc_id")])
    total = rows.count()
    return numbered.select("doc_id", F.least(F.floor((F.col("id") - 1) / max(total // 4, 1)), F.lit(3)).cast("int").alias("reviewer"))


@query("""WITH t AS (SELECT text, doc_id % 5 = 0 AS test FROM documents), x AS (SELECT DISTINCT text FROM t WHERE test)
SELECT count(*) AS train_rows, count(*) FILTER (WHERE text IN (SELECT text FROM x)) AS collisions FROM t WHERE NOT test""")
def split_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text", (F.col("doc_id") % 5 == 0).alias("test"))
    test = docs.where("test").select("text").distinct().withColumn("hit", F.lit(1))
    return docs.where("not test").join(test, "text", "left").agg(F.count(F.lit(1)).alias("train_rows"), F.count("hit").alias("collisions"))


@query("""SELECT text, count(*) AS rows, string_agg(DISTINCT source, ';' ORDER BY source) AS sources FROM documents GROUP BY text HAVING count(*) > 1""")
def merge_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").groupBy(F.md5("text"), F.xxhash64("text")).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("rows"), F.array_join(F.array_sort(F.collect_set("source")), ";").alias("sources"))
    return rows.where("rows > 1").select("text", "rows", "sources")


FILES = [("report.pdf", "A"), ("plan", "B"), ("notes.txt", "C")]
PAGE_ROWS = [(1, "report.pdf"), (2, "plan.pdf"), (3, "notes"), (4, "other.pdf")]


@query(f"""WITH f(name, title) AS (VALUES {values_sql(FILES)}), p(id, file) AS (VALUES {values_sql(PAGE_ROWS)})
SELECT id, file, coalesce(a.title, b.title) AS title FROM p LEFT JOIN f a ON p.file = a.name LEFT JOIN f b ON regexp_replace(p.file, '\\.[a-z]+$', '') = b.name""")
def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = values(spark, "id long, file string", PAGE_ROWS)
    return R.coalesced_lookup(rows, values(spark, "name string, title string", FILES), [F.col("file"), F.regexp_replace("file", r"\.[a-z]+$", "")], "name", "title")
