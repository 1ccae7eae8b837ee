"""Queries of report aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.functions.text import sentences, squeeze
from litloom.operators import reports as R
from litloom.queries.parts import squeezed
from litloom.queries.registry import query, table


@query("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY quality, toxic")
def label_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"))


@query(r"""WITH t AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '\b(?:licensed|released|password|token)\b')) AS tags FROM documents),
e AS (SELECT doc_id, unnest(CASE WHEN len(tags) = 0 THEN ['Unspecified'] ELSE tags END) AS tag FROM t) SELECT tag, count(*) AS docs FROM e GROUP BY tag""")
def explode_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\b(?:licensed|released|password|token)\b"), F.lit(0)))
    rows = table(spark, sf_dir, "documents").select(F.explode_outer(tags).alias("tag"))
    return rows.groupBy(F.coalesce("tag", F.lit("Unspecified")).alias("tag")).agg(F.count(F.lit(1)).alias("docs"))


@query("SELECT source, count(DISTINCT lang) AS langs, count(DISTINCT doc_id) AS docs FROM documents GROUP BY source")
def distinct_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.countDistinct("lang").alias("langs"), F.countDistinct("doc_id").alias("docs"))


_BUCKET = "CASE WHEN year(o_orderdate) < 1994 THEN '<1994' WHEN year(o_orderdate) < 1997 THEN '1994-1996' ELSE '1997+' END"


@query(f"""WITH c AS (SELECT o_orderpriority, {_BUCKET} AS bucket, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, bucket, n, round(n / CAST(sum(n) OVER (PARTITION BY bucket) AS DOUBLE), 6) AS share FROM c""")
def year_bucket_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate")
    bucket = F.when(year < 1994, F.lit("<1994")).when(year < 1997, F.lit("1994-1996")).otherwise(F.lit("1997+"))
    return R.bucket_matrix(table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate"), "o_orderpriority", bucket)


@query("""SELECT n_name, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS building, count(*) FILTER (WHERE c_acctbal < 0) AS in_debt,
count(*) FILTER (WHERE c_mktsegment = 'BUILDING' OR c_acctbal < 0) AS either FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def cross_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    building, debt = F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") < 0
    return c.join(n, c.c_nationkey == n.n_nationkey).groupBy("n_name").agg(F.count_if(building).alias("building"), F.count_if(debt).alias("in_debt"), F.count_if(building | debt).alias("either"))


@query("""WITH c AS (SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) + 2 * max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)
+ 4 * max(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS code FROM lineitem GROUP BY l_orderkey) SELECT CAST(code AS INTEGER) AS code, count(*) AS n FROM c GROUP BY code""")
def overlap_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = {"returned": F.col("l_returnflag") == "R", "open": F.col("l_linestatus") == "O", "discounted": F.col("l_discount") > 0.05}
    return R.overlap_codes(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_discount"), "l_orderkey", flags)


@query("""WITH s AS (SELECT DISTINCT user_id, event_type FROM events) SELECT x.event_type AS a, y.event_type AS b, count(*) AS n
FROM s x JOIN s y ON x.user_id = y.user_id AND x.event_type < y.event_type GROUP BY 1, 2""")
def cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.cooccurrence(table(spark, sf_dir, "events").select("user_id", "event_type"), "user_id", "event_type")


@query("SELECT event_type, date_trunc('month', ts) AS month, count(*) AS n FROM events WHERE value > 50 GROUP BY 1, 2")
def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where("value > 50")
    return rows.groupBy("event_type", F.date_trunc("month", "ts").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang, max(n_chars) AS longest, arg_max(doc_id, n_chars * 1000000 - doc_id) AS doc_id FROM documents GROUP BY lang")
def top_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.max("n_chars").alias("longest"), F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("doc_id"))


_EDGES = [0, 10, 25, 50, 100, 200, 500, 5000, 50000]


@query(f"""WITH b AS (SELECT CASE {" ".join(f"WHEN n_chars <= {e} THEN {e}" for e in _EDGES)} END AS bin FROM documents) SELECT bin, count(*) AS n FROM b GROUP BY bin""")
def length_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(R.bins(F.col("n_chars"), _EDGES).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH w AS (SELECT unnest(string_split({squeezed('text')}, ' ')) AS w FROM documents), c AS (SELECT lower(w) AS stem, w, count(*) AS n FROM w WHERE w <> '' AND NOT regexp_matches(w, '[^A-Za-z]') GROUP BY 1, 2)
SELECT stem, w AS spelling, n FROM (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY n DESC, w) AS place FROM c) WHERE place = 1 AND n >= 5""")
def dominant_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select(F.explode(F.split(squeeze(F.col("text")), " ")).alias("w")).where("w <> '' and not w rlike '[^A-Za-z]'")
    counts = words.groupBy(F.lower("w").alias("stem"), "w").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("stem").agg(F.min(F.struct((-F.col("n")).alias("m"), "w")).alias("b"))
    return best.select("stem", F.col("b.w").alias("spelling"), (-F.col("b.m")).alias("n")).where("n >= 5")


_TAGS = r"list_distinct(regexp_extract_all(lower({}), '\b(?:licensed|released|password|token|idiot|worthless)\b'))"


@query(f"""WITH t AS (SELECT doc_id, {_TAGS.format('text')} AS truth, {_TAGS.format('substr(text, 1, CAST(length(text) / 2 AS INTEGER))')} AS pred FROM documents),
m AS (SELECT len(list_intersect(pred, truth)) AS k, len(pred) AS p, len(truth) AS t FROM t)
SELECT round(avg(CASE WHEN p > 0 THEN k / CAST(p AS DOUBLE) ELSE 0 END), 6) AS precision, round(avg(CASE WHEN t > 0 THEN k / CAST(t AS DOUBLE) ELSE 0 END), 6) AS recall,
round(avg(CASE WHEN p + t > 0 AND k > 0 THEN 2.0 * k / (p + t) ELSE 0 END), 6) AS f1, round(avg(CASE WHEN p + t - k = 0 THEN 1.0 ELSE k / CAST(p + t - k AS DOUBLE) END), 6) AS iou FROM m""")
def list_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"\b(?:licensed|released|password|token|idiot|worthless)\b"), F.lit(0)))
    half = F.substr("text", F.lit(1), F.round(F.length("text") / 2).cast("int"))
    rows = table(spark, sf_dir, "documents").select(tags(F.col("text")).alias("truth"), tags(half).alias("pred"))
    measures = R.list_metrics(F.col("pred"), F.col("truth"))
    return rows.agg(*[F.round(F.avg(c), 6).alias(k) for k, c in measures.items()])


@query(r"""WITH p AS (SELECT l.quality, CASE WHEN regexp_matches(d.text, '[%&*#$]{3}|!!| \| ') THEN 0 ELSE 1 END AS guess FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
SELECT count(*) FILTER (WHERE guess = 1 AND quality = 1) AS tp, count(*) FILTER (WHERE guess = 1 AND quality = 0) AS fp, count(*) FILTER (WHERE guess = 0 AND quality = 1) AS fn, count(*) FILTER (WHERE guess = 0 AND quality = 0) AS tn FROM p""")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    guess = F.when(F.col("text").rlike(r"[%&*#$]{3}|!!| \| "), 0).otherwise(1)
    rows = table(spark, sf_dir, "documents").select("doc_id", guess.alias("guess")).join(table(spark, sf_dir, "labels"), "doc_id")
    return R.confusion(rows, F.col("guess"), F.col("quality"))


@query("SELECT count(*) AS docs, count(lang) AS with_lang, count(*) FILTER (WHERE regexp_matches(text, '[a-z]+@[a-z]+')) AS with_email, count(*) FILTER (WHERE lang IS NOT NULL OR regexp_matches(text, '[a-z]+@[a-z]+')) AS either FROM documents")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = F.col("text").rlike("[a-z]+@[a-z]+")
    return table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("docs"), F.count("lang").alias("with_lang"), F.count_if(mail).alias("with_email"), F.count_if(mail | F.col("lang").isNotNull()).alias("either"))


@query(f"""WITH w AS (SELECT doc_id, string_split({squeezed('text')}, ' ') AS w FROM documents), s AS (SELECT doc_id, w, unnest(range(0, CAST(greatest(ceil((len(w) - 256) / 128.0), 0) AS INTEGER) + 1)) * 128 AS start FROM w)
SELECT doc_id, start, len(w[start + 1:start + 256]) AS words, md5(array_to_string(w[start + 1:start + 256], ' ')) AS chunk FROM s""")
def window_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.split(squeeze(F.col("text")), " ").alias("w"))
    rows = rows.select("doc_id", "w", F.explode(R.windows(F.col("w"))).alias("start"))
    part = F.slice("w", F.col("start") + 1, 256)
    return rows.select("doc_id", F.col("start").cast("long").alias("start"), F.size(part).cast("long").alias("words"), F.md5(F.array_join(part, " ")).alias("chunk"))


@query("""WITH c AS (SELECT conv_id, turn, text, string_agg(text, ' | ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS context FROM conversations) SELECT conv_id, turn, md5(context) AS context FROM c""")
def context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    near = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(-2, 2)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(F.array_join(F.collect_list("text").over(near), " | ")).alias("context"))


@query("""WITH p AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) SELECT p_type, count(*) AS parts, CAST(sum(n) AS BIGINT) AS lines FROM part JOIN p ON p_partkey = l_partkey GROUP BY p_type HAVING sum(n) >= 0.02 * (SELECT count(*) FROM lineitem)""")
def prune_rare(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    counts = lines.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    types = part.join(counts, part.p_partkey == counts.l_partkey).groupBy("p_type").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("lines"))
    return types.crossJoin(F.broadcast(total)).where("lines >= 0.02 * total").drop("total")


@query(r"""WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])[\x20\x09-\x0D]+', '\1' || chr(1), 'g'), chr(1))) AS s FROM documents)
SELECT doc_id, CAST(count(*) AS BIGINT) AS found, CAST(round(avg(CASE WHEN length(s) > 200 THEN 90 WHEN length(s) > 100 THEN 70 ELSE 55 END) * count(*)) AS BIGINT) AS hundredths FROM s WHERE trim(s) <> '' GROUP BY doc_id""")
def scores_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.split(F.regexp_replace("text", r"([.!?])[\x20\x09-\x0D]+", "$1\u0001"), "\u0001")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(marked).alias("s")).where("trim(s) <> ''")
    score = F.when(F.length("s") > 200, 90).when(F.length("s") > 100, 70).otherwise(55)
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("found"), F.sum(score).alias("hundredths"))


def sentence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(sentences(F.col("text"))).alias("place", "sentence"))
