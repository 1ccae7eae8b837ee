"""Queries of the training-data operators, and the SQL that some of them can be held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.llm import decontam, fingerprints, langid, licenses, mixing, ngram_join, quality, secrets, sharding, substring
from litloom.llm.storage import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edit with the next, with likenesses."""
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document, by bytes."""
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's set of shingles, and its component of links."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text, learned from the labels that are not held out."""
    return quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from the languages that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs.select("doc_id", "text"), langid.train(docs))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that texts share, and texts that are copies."""
    return substring.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every whole text, and the known sentences it holds."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    ids = F.transform("sentences", lambda s: s["id"])
    return found.select("doc_id", F.array_join("licenses", ",").alias("licenses"), F.size("sentences").cast("long").alias("n_known"), F.array_join(ids, ",").alias("sentence_ids"))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every whole text."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[of(i).alias(f"n_{k}") for i, k in enumerate(secrets.KINDS[:3])],
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_random"),
    )


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of documents that benchmark items contaminate."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontam.find_contamination(docs.select("doc_id", "text"), items.select("item_id", "text"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often every document is taken, by its source's target."""
    rows = mixing.copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "rate", "copies")


OP10_SQL = r"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
), weighted AS (
  SELECT source, source_size,
         CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM totals
), steps AS (
  SELECT *, 3 * source_size / weight AS capped_from,
         coalesce(sum(3 * source_size) OVER below, 0) AS filled,
         sum(weight) OVER () - coalesce(sum(weight) OVER below, 0) AS unfilled,
         sum(source_size) OVER () AS words
  FROM weighted
  WINDOW below AS (ORDER BY 3 * source_size / weight, source ASC NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), solved AS (
  SELECT (words - filled) / unfilled AS level FROM steps
  WHERE (words - filled) / unfilled <= capped_from
  ORDER BY capped_from, source ASC NULLS LAST LIMIT 1
), rates AS (
  SELECT source, source_size, least(weight * level, CAST(3 * source_size AS DOUBLE)) AS target,
         CASE WHEN source_size > 0
              THEN least(least(weight * level, CAST(3 * source_size AS DOUBLE)) / source_size, 3.0)
              ELSE 0.0 END AS rate
  FROM weighted, solved
), drawn AS (
  SELECT s.doc_id, s.size, r.source_size, r.target, s.source, r.rate,
         CAST(floor(r.rate) AS BIGINT) + CASE
           WHEN CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT) AS DOUBLE)
                / 281474976710656.0 < r.rate - floor(r.rate) THEN 1 ELSE 0 END AS copies
  FROM sizes s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target, size * copies AS taken, source, rate, copies FROM drawn
"""

# Brute force over all pairs of documents that share a shingle, then reachability.
OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), sets AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END)) AS s
  FROM words
), sizes AS (
  SELECT w.doc_id, count(s.s) AS n FROM words w LEFT JOIN sets s ON w.doc_id = s.doc_id GROUP BY w.doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * k >= 80 * (x.n + y.n - k)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT a AS v, b AS r FROM both_ways
  UNION
  SELECT reached.v, e.b FROM reached JOIN both_ways e ON reached.r = e.a
)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(min(r.r), s.doc_id)) AS component_id
FROM sizes s LEFT JOIN reached r ON s.doc_id = r.v GROUP BY s.doc_id, s.n
"""

def edited_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op1 that SQL can express."""
    return op1_document_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


EDITED_SQL = """
WITH o AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lead(text) OVER d, '') AS next_text, row_number() OVER d AS i, count(*) OVER () AS n FROM documents WINDOW d AS (ORDER BY doc_id DESC)),
f AS (SELECT text AS first FROM o WHERE i = 1), e AS (SELECT doc_id, text, CASE WHEN i = n THEN first ELSE next_text END AS other, length(text) AS len FROM o, f)
SELECT doc_id, len AS n_chars, sha256(substr(text, 1, len - len // 3) || substr(other, 1, len // 3)) AS edited_sha256 FROM e
"""


def base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op8 that SQL can express: spans of the fixed patterns."""
    return op8_secret_scans(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def _located_sql(pattern: str, kind: int, kept: str) -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, {kind} AS kind, hit, start FROM (SELECT doc_id, unnest(hits) AS hit, unnest(groups) AS grp, unnest(list_transform(range(1, len(hits) + 1), lambda i: length(array_to_string(list_slice(gaps, 1, i), '')) + length(array_to_string(list_slice(hits, 1, i - 1), '')))) AS start
  FROM (SELECT doc_id, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}') AS hits, regexp_extract_all(t, '{p}', {2 if kind == 0 else 0}) AS groups FROM texts WHERE regexp_matches(t, '{p}'))) WHERE {kept}"""


BASE_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), s AS ({_located_sql(secrets.ASSIGN, 0, "length(grp) >= 8")} UNION ALL {_located_sql(secrets.ACCESS, 1, "true")} UNION ALL {_located_sql(secrets.HEX, 2, "true")}),
l AS (SELECT doc_id, string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || start || ':' || (start + length(hit)), ',' ORDER BY start, kind) AS spans, count(*) FILTER (WHERE kind = 0) AS a, count(*) FILTER (WHERE kind = 1) AS b, count(*) FILTER (WHERE kind = 2) AS c FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256 FROM documents d LEFT JOIN l ON l.doc_id = d.doc_id
"""

QUERIES: dict[str, Query] = {q.__name__: q for q in (
        op1_document_fingerprints, op2_ngram_jaccard_join, op3_quality_classifier, op4_sharding, op5_language_id,
        op6_substring_dedup, op7_license_scans, op8_secret_scans,
        op9_benchmark_decontamination, op10_mixing, edited_digests, base_spans,
    )}
ORACLE_SQL: dict[str, str] = {"op2_ngram_jaccard_join": OP2_SQL, "op7_license_scans": licenses.scan_sql(), "op10_mixing": OP10_SQL, "edited_digests": EDITED_SQL, "base_spans": BASE_SQL}
