"""Evaluation and cross-tabs beyond plain counts: exclusive classes, keyword recall, model choice, spans, sectors and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litloom.functions.text import similarity


def exclusive_classes(rows: DataFrame, key: str, lists: str, order: list[str], default: str = "Undefined") -> DataFrame:
    """Columns key, class, n, share: each row counts once, under the first of `order` that its list holds, else under the default."""
    first = F.coalesce(*[F.when(F.array_contains(lists, c), F.lit(c)) for c in order], F.lit(default))
    counts = rows.groupBy(key, first.alias("class")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(key).agg(F.sum("n").alias("total"))
    return counts.join(totals, key).select(key, "class", "n", F.round(100 * F.col("n") / F.col("total"), 6).alias("share"))


def classes_and_any(rows: DataFrame, key: str, flags: dict[str, Column]) -> DataFrame:
    """Columns key, a count for each flag, and `any`: rows with at least one of them."""
    some = F.lit(False)
    for flag in flags.values():
        some = some | flag
    return rows.groupBy(key).agg(*[F.count_if(flag).alias(name) for name, flag in flags.items()], F.count_if(some).alias("any"))


def keyword_recall(found: DataFrame, given: DataFrame, close: float = 0.77) -> DataFrame:
    """Columns doc_id, precision, recall of found against given keywords (doc_id, keyword): alike in edits counts as the same.

    Documents without given or without found keywords have no row.
    """
    f = found.select("doc_id", F.lower("keyword").alias("f")).distinct()
    g = given.select("doc_id", F.lower("keyword").alias("g")).distinct()
    met = f.join(g, "doc_id").where(similarity(F.col("f"), F.col("g")) >= close).groupBy("doc_id").agg(F.count_distinct("f").alias("hits_f"), F.count_distinct("g").alias("hits_g"))
    sizes = f.groupBy("doc_id").agg(F.count(F.lit(1)).alias("nf")).join(g.groupBy("doc_id").agg(F.count(F.lit(1)).alias("ng")), "doc_id")
    return sizes.join(met, "doc_id", "left").select("doc_id", (F.coalesce("hits_f", F.lit(0)) / F.col("nf")).alias("precision"), (F.coalesce("hits_g", F.lit(0)) / F.col("ng")).alias("recall"))


def recall_report(scores: DataFrame, kinds: DataFrame) -> DataFrame:
    """Columns kind, docs, precision, recall, above_50, above_70, zero: of scores (doc_id, precision, recall) by kinds (doc_id, kind)."""
    return scores.join(kinds, "doc_id").groupBy("kind").agg(
        F.count(F.lit(1)).alias("docs"), F.round(F.avg("precision"), 6).alias("precision"), F.round(F.avg("recall"), 6).alias("recall"),
        F.count_if(F.col("recall") >= 0.5).alias("above_50"), F.count_if(F.col("recall") >= 0.7).alias("above_70"), F.count_if((F.col("recall") == 0) | (F.col("precision") == 0)).alias("zero"),
    )


def best_models(scores: DataFrame) -> DataFrame:
    """Columns label, model, f1: the model with the best F1 of each label (ties: the first by letters) from (label, model, tp, fp, fn)."""
    f1 = F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") > 0, 2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(F.lit(0.0))
    rows = scores.withColumn("f1", f1)
    best = F.min_by(F.struct("model", "f1"), F.struct((-F.col("f1")).alias("f1"), "model"))
    return rows.groupBy("label").agg(best.alias("b")).select("label", "b.model", F.round("b.f1", 6).alias("f1"))


def any_part(predictions: DataFrame, parts: list[str]) -> DataFrame:
    """Columns doc_id, label: labels that any of the boolean columns gives, over all rows of a document (doc_id, label, parts)."""
    some = F.lit(False)
    for p in parts:
        some = some | F.coalesce(F.col(p), F.lit(False))
    return predictions.groupBy("doc_id", "label").agg(F.bool_or(some).alias("given")).where("given").select("doc_id", "label")


def last_span(text: Column, part: Column) -> Column:
    """struct(start, end) of the last occurrence of a part, whatever its case; null where there is none."""
    at = F.length(text) - F.instr(F.reverse(F.lower(text)), F.reverse(F.lower(part))) - F.length(part) + 1
    return F.when((F.length(part) > 0) & F.contains(F.lower(text), F.lower(part)), F.struct(at.alias("start"), (at + F.length(part)).alias("end")))


def sectors(docs: DataFrame, codes: DataFrame, rules: DataFrame, hits: DataFrame) -> DataFrame:
    """Columns doc_id, sector: documents (doc_id, codes: a list) with a code of the sector and, where it has keywords, a hit of one.

    codes: code, name. rules: sector, name (a row for each name, or null), query_id (a row for each keyword, or null). hits: query_id, doc_id.
    """
    named = docs.select("doc_id", F.explode("codes").alias("code")).select("doc_id", F.upper(F.trim("code")).alias("code")).join(codes.select(F.upper("code").alias("code"), "name"), "code")
    coded = named.join(rules.where("name is not null").select("sector", "name").distinct(), "name").select("doc_id", "sector").distinct()
    keyed = rules.where("query_id is not null").select("sector", "query_id").distinct()
    free = coded.join(keyed.select("sector").distinct(), "sector", "left_anti")
    return free.unionByName(coded.join(keyed.join(hits, "query_id").select("doc_id", "sector").distinct(), ["doc_id", "sector"], "left_semi"))


def merge_label_files(files: list[DataFrame], key: str, labels: str) -> DataFrame:
    """Columns key, labels (sorted list): every key of any file with the labels that any file gives it; a key without labels keeps an empty list."""
    rows = None
    for f in files:
        part = f.select(key, F.explode_outer(labels).alias("label"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy(key).agg(F.array_sort(F.collect_set("label")).alias(labels))


def balanced(rows: DataFrame, label: str, id_col: str, seed: int = 1237, most: int | None = None) -> DataFrame:
    """`rows` with `copy`: rows of smaller classes repeated until each class has as many rows as the largest (or `most`).

    A class larger than `most` keeps those that a hash puts first. Whole copies come first, then a part drawn by the hash.
    """
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    target = F.lit(most) if most is not None else F.max("__n").over(Window.partitionBy())
    wanted = sizes.withColumn("__target", target)
    nth = F.row_number().over(Window.partitionBy(label).orderBy(F.xxhash64(F.lit(seed), id_col), id_col))
    placed = rows.withColumn("__nth", nth).join(wanted, label)
    times = F.floor(F.col("__target") / F.col("__n")) + (F.col("__nth") <= F.col("__target") % F.col("__n")).cast("long")
    return placed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest(times, F.lit(0)).cast("int")))).where(times > 0).drop("__n", "__target", "__nth")


def write_by_year(rows: DataFrame, path: str, year_col: str = "year") -> None:
    """A folder of Parquet files for each year."""
    rows.write.mode("overwrite").partitionBy(year_col).parquet(path)


def sweep(fit, ks: list[int]) -> list[tuple[int, float]]:
    """(k, coherence) for each number of topics; fit(k) gives a DataFrame of one row, coherence."""
    return [(k, fit(k).first()["coherence"]) for k in ks]


def prune_clusters(assigned: DataFrame, vectors: DataFrame, least: int = 10, share: float = 0.02) -> DataFrame:
    """Columns doc_id, cluster from (doc_id, cluster, group, focus): clusters with too few documents give way to the nearest that has enough.

    Enough is `least`, or `share` of the smallest focus that the cluster occurs in, if that is less. Nearest by cosine of
    vectors (cluster, vector) within the group; ties go to the larger cluster, then by letters. Without a candidate the cluster stays.
    """
    docs = assigned.groupBy("cluster").agg(F.count_distinct("doc_id").alias("docs"))
    focus = assigned.where("focus is not null").groupBy("focus").agg(F.floor(F.count_distinct("doc_id") * share).alias("floor"))
    bound = assigned.join(focus, "focus").groupBy("cluster").agg(F.least(F.min("floor"), F.lit(least)).alias("bound"))
    judged = docs.join(bound, "cluster", "left").withColumn("ok", F.col("docs") >= F.coalesce("bound", F.lit(least)))
    groups = assigned.select("cluster", "group").distinct().join(judged, "cluster").join(vectors, "cluster")
    x, y = groups.where("not ok").alias("x"), groups.where("ok").alias("y")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    norm = lambda a: F.sqrt(dot(a, a))
    cosine = F.round(dot(F.col("x.vector"), F.col("y.vector")) / (norm(F.col("x.vector")) * norm(F.col("y.vector"))), 2)
    near = x.join(y, F.col("x.group") == F.col("y.group")).select(F.col("x.cluster").alias("cluster"), F.col("y.cluster").alias("to"), F.col("y.docs").alias("docs"), cosine.alias("s")).where("s is not null")
    best = near.groupBy("cluster").agg(F.min_by("to", F.struct((-F.col("s")).alias("s"), (-F.col("docs")).alias("d"), "to")).alias("to"))
    return assigned.join(best, "cluster", "left").select("doc_id", F.coalesce("to", "cluster").alias("cluster")).distinct()
