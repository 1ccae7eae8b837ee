"""Phrases, synonyms and derived dictionaries: trigram phrases, phrase vectors, synonym expansion, vector clusters, taxonomies and contexts."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litloom.functions.text import squeeze
from litloom.operators import mining
from litloom.storage import follow, settle, tabled


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, null where one is zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms)


def follow_ups(docs: DataFrame) -> DataFrame:
    """Columns a, b: each term of a text with the one after it (null after the last). docs: words."""
    last = F.slice(F.concat("words", F.array(F.lit(None).cast("string"))), 2, F.size("words"))
    return docs.where(F.size("words") > 0).select(F.explode(F.arrays_zip(F.col("words").alias("a"), last.alias("b"))).alias("p")).select("p.a", "p.b")


def pair_scores(docs: DataFrame, least: int = 5, score: float = 10.0) -> DataFrame:
    """Columns a, b, n, score as mining.phrases. Pairs are first counted by a hash, so only those that can be frequent enough are counted by their words."""
    docs = tabled(docs.select("words"))
    words = tabled(docs.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("c")))
    kinds = words.agg(F.count(F.lit(1)).alias("kinds"))
    met = follow_ups(docs).where("b is not null").select("a", "b", F.xxhash64("a", "b").alias("key"))
    often = tabled(met.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("key"))
    together = met.join(often, "key", "left_semi").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    left, right = (words.select(F.col("word").alias(x), F.col("c").alias(f"c_{x}")) for x in "ab")
    joined = together.join(left, "a").join(right, "b").crossJoin(F.broadcast(kinds))
    value = (F.col("n") - least) * F.col("kinds") / (F.col("c_a").cast("double") * F.col("c_b"))
    return joined.select("a", "b", "n", value.alias("score")).where(F.col("score") > score)


def joined_words(docs: DataFrame, pairs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`docs` (id, words) with neighbours that are a pair joined by an underscore, from the left; of overlapping pairs the first counts."""
    runs = docs.select(id_col, F.posexplode(F.zip_with(F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))), F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("at", "p"))
    hits = runs.select(id_col, "at", "p.a", "p.b").join(pairs.select("a", "b").distinct(), ["a", "b"]).groupBy(id_col).agg(F.array_sort(F.collect_set("at")).alias("hits"))

    # In built-in functions each step would copy the list, so long texts would take quadratic time.
    @F.pandas_udf("array<string>")
    def joined(words: pd.Series, hits: pd.Series) -> pd.Series:
        out = []
        for w, h in zip(words, hits, strict=True):
            if h is None:
                out.append(w)
                continue
            text, last = [], 0
            for at in h:
                if at >= last:  # else its first word belongs to the phrase before
                    text += [*w[last:at], f"{w[at]}_{w[at + 1]}"]
                    last = at + 2
            out.append([*text, *w[last:]])
        return pd.Series(out, dtype=object)

    return docs.join(hits, id_col, "left").select(id_col, joined("words", "hits").alias("words"))


def trigrams(docs: DataFrame, least: int = 5, score: float = 10.0, id_col: str = "doc_id") -> DataFrame:
    """Columns a, b, n, score of phrases over texts in which pairs are already joined, so of two to four words."""
    docs = tabled(docs.select(id_col, "words"))
    first = tabled(pair_scores(docs.select("words"), least, score))  # of a known size: where it is small, places of words are not shuffled to find it
    return pair_scores(joined_words(docs, first, id_col).select("words"), least, score)


def popular_expressions(docs: DataFrame, longest: int = 4, least: int = 5) -> DataFrame:
    """Columns expression, longer, docs: phrases of up to `longest` words in at least `least` documents, with those that extend them by a word.

    docs: doc_id, words.
    """
    runs, parts = F.col("words"), [F.col("words")]
    for k in range(2, longest + 1):  # each run with the word after it
        kept = F.greatest(F.size("words") - k + 1, F.lit(0))
        runs = F.zip_with(F.slice(runs, 1, kept), F.slice("words", k, kept), lambda a, b: F.concat_ws(" ", a, b))
        parts.append(runs)
    runs = F.concat(*parts)
    counts = settle(docs.select(F.explode(F.array_distinct(runs)).alias("expression")).groupBy("expression").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= least))
    words = F.split("expression", " ")
    longer = counts.where(F.size(words) > 1)
    heads = longer.select(F.array_join(F.slice(words, 1, F.size(words) - 1), " ").alias("expression"), F.col("expression").alias("longer"), "docs")
    tails = longer.select(F.array_join(F.slice(words, 2, F.size(words) - 1), " ").alias("expression"), F.col("expression").alias("longer"), "docs")
    return heads.unionByName(tails).distinct()


def phrase_vectors(phrases: DataFrame, vectors: DataFrame, lemmas: DataFrame | None = None) -> DataFrame:
    """Columns phrase, vector: the mean of the vectors of a phrase's words; a word without one counts by its lemma (lemmas: word, lemma), else not at all.

    vectors: word, vector. A phrase of no known word has no row.
    """
    words = phrases.select("phrase").distinct().select("phrase", F.posexplode(F.filter(F.split(squeeze(F.col("phrase")), " "), lambda w: w != "")).alias("at", "word"))
    if lemmas is not None:
        words = words.join(lemmas, "word", "left").join(vectors.select(F.col("word"), F.lit(1).alias("known")), "word", "left")
        words = words.select("phrase", "at", F.when(F.col("known").isNull(), F.coalesce("lemma", "word")).otherwise(F.col("word")).alias("word"))
    cells = words.join(vectors, "word").select("phrase", F.posexplode("vector").alias("dim", "x"))
    means = cells.groupBy("phrase", "dim").agg(F.avg("x").alias("x"))
    return means.groupBy("phrase").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("vector"))


def expand_by_synonyms(keywords: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Columns keyword_id, variant: every way to put synonyms (word, synonym) in place of the words of a keyword (keyword_id, keyword).

    Variants are built word by word, so they are as many as the product of the numbers of synonyms.
    """
    choice = synonyms.select("word", "synonym").distinct().groupBy("word").agg(F.collect_set("synonym").alias("synonyms"))
    words = keywords.select("keyword_id", F.posexplode(F.filter(F.split(squeeze(F.col("keyword")), " "), lambda w: w != "")).alias("at", "word")).join(choice, "word", "left")
    options = F.array_sort(F.array_distinct(F.concat(F.array("word"), F.coalesce("synonyms", F.array().cast("array<string>")))))
    lists = words.groupBy("keyword_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", options.alias("o")))), lambda s: s["o"]).alias("lists"))
    product = F.aggregate(F.slice("lists", 2, F.size("lists")), F.get("lists", F.lit(0)), lambda acc, part: F.flatten(F.transform(acc, lambda a: F.transform(part, lambda b: F.concat_ws(" ", a, b)))))
    return lists.select("keyword_id", F.explode(product).alias("variant")).distinct()


#: Vectors of a group that meet as one matrix, and cosines that a task holds at once.
BLOCK = 4096
CELLS = 1 << 21


def components(v: np.ndarray, side: np.ndarray, least: float) -> np.ndarray:
    """A number for each vector, equal for those connected by cosines of at least `least`. side: 0 and 1 meet each other; where all are 0, all meet.

    As in `cosine`, a norm of zero gives none and what is not a number is above all.
    """
    norm = np.sqrt(np.cumsum(v * v, axis=1)[:, -1])
    label = np.arange(len(v))
    second = np.flatnonzero(side == 1) if side.any() else label.copy()
    first = np.flatnonzero(side == 0)
    step = max(1, CELLS // len(second))
    for at in range(0, len(first), step):
        rows = first[at : at + step]
        norms = norm[rows, None] * norm[None, second]
        score = (v[rows] @ v[second].T) / norms
        close = np.argwhere(np.abs(score - least) <= 1e-9)
        for lo in range(0, len(close), BLOCK):  # summed in order, as built-in expressions do
            x, y = close[lo : lo + BLOCK].T
            score[x, y] = np.cumsum(v[rows[x]] * v[second[y]], axis=1)[:, -1] / norms[x, y]
        passes = (norms != 0) & ~(score < least)
        for i, u in enumerate(rows.tolist()):
            met = label[second[passes[i]]]
            met = met[met != label[u]]
            if len(met):
                merged = np.zeros(len(v), bool)
                merged[met] = True
                label[merged[label]] = label[u]
    return label


def vector_links(rows: DataFrame, group: str, least_cosine: float) -> DataFrame:
    """Columns a, b: names connected as they are by all pairs of a group (name, group, vector) with a cosine of at least `least_cosine`.

    The vectors of a group come in blocks dealt out by hash, and blocks meet as matrices. Of two blocks each name is linked with one of
    those it is connected with there, so there are at most as many links as names, however many pairs are close.
    """
    sound = F.col(group).isNotNull() & F.col("name").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull())
    known = rows.where(sound).select(F.col(group).alias("kind"), "name", F.col("vector").cast("array<double>").alias("vector"), F.size("vector").alias("width"))
    blocks = known.groupBy("kind", "width").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = known.join(blocks, ["kind", "width"]).withColumn("own", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("kind", "width", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).cast("int").alias("side"), "name", "vector")

    def linked(table: pa.Table) -> pa.Table:
        names = table.column("name").combine_chunks()
        v = np.asarray(table.column("vector").combine_chunks().flatten()).reshape(len(names), -1)
        side = np.asarray(table.column("side"))
        # A pair of blocks whose second one is empty has nothing to compare.
        alone = not side.any() and table.column("lo")[0] != table.column("hi")[0]
        with np.errstate(all="ignore"):
            label = np.arange(len(v)) if alone or side.all() else components(v, side, least_cosine)
        far = np.flatnonzero(label != np.arange(len(v)))
        return pa.table({"a": names.take(pa.array(far)), "b": names.take(pa.array(label[far]))})

    return dealt.groupBy("kind", "width", "lo", "hi").applyInArrow(linked, "a string, b string").distinct()


def cluster_vectors(rows: DataFrame, group: str, least_cosine: float = 0.9, least_size: int = 3) -> DataFrame:
    """Columns name, representative from (name, group, vector, n): connected groups of names with a cosine of at least `least_cosine`.

    Names meet within their group. Of a group of `least_size` names or more the one with the largest n is the representative (ties:
    nearest to the group's mean vector, fewest words, letters); names of smaller groups stand for themselves.
    """
    pairs = settle(vector_links(rows, group, least_cosine))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = settle(rows.select("name", F.col("name").alias("label")))
    while True:
        near = both.join(labels.select(F.col("name").alias("b"), "label"), "b").groupBy(F.col("a").alias("name")).agg(F.min("label").alias("near"))
        step = settle(labels.join(near, "name", "left").select("name", F.least("label", "near").alias("label"), F.coalesce(F.col("near") < F.col("label"), F.lit(False)).alias("changed")))
        labels = step.select("name", "label")
        if not step.where("changed").limit(1).count():
            break
    placed = rows.join(labels, "name")
    cells = placed.select("label", F.posexplode("vector").alias("dim", "x")).groupBy("label", "dim").agg(F.avg("x").alias("x"))
    means = cells.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda s: s["x"]).alias("mean"))
    sizes = placed.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    judged = placed.join(means, "label").withColumn("s", F.round(cosine(F.col("vector"), F.col("mean")), 2))
    best = judged.groupBy("label").agg(F.min_by("name", F.struct((-F.col("n")).alias("n"), (-F.col("s")).alias("s"), F.size(F.split("name", " ")).alias("w"), "name")).alias("best"))
    return placed.join(best, "label").join(sizes, "label").select("name", F.when(F.col("size") >= least_size, F.col("best")).otherwise(F.col("name")).alias("representative"))


# Words that are an intervention by themselves, and leading words that say nothing.
INTERVENTION_WORDS = "practice approach intervention input strategy policy program programme initiative technology science technique innovation biotechnology machine mechanism equipment device project".split()
ABSTRACT_WORDS = ["adoption", "level", "hectare", "exterior"]


def derive_taxonomy(concepts: DataFrame, vectors: DataFrame, layers: DataFrame, renamed: dict[str, str] | None = None, least: float = 0.3) -> DataFrame:
    """Columns concept, class, middle from concepts (concept, class, df; class null: not an intervention) and layers (class, middle).

    Similar concepts are merged (mining.merge_concepts); leading abstract words go, as do concepts that are one intervention word, and
    those that are another concept plus an intervention word. The middle layer of a concept is the keyword of its class with
    the largest cosine (vectors: word, vector), "other" under `least`.
    """
    wanted = concepts.where("class is not null")
    gone = concepts.where("class is null").select("concept").distinct()
    links = mining.merge_concepts(wanted.groupBy("concept").agg(F.max("df").alias("df")))
    merged = wanted.join(links, "concept").select(F.col("canonical").alias("concept"), "class").distinct()
    bare = F.regexp_replace("concept", "^(?:(?:" + "|".join(ABSTRACT_WORDS) + r")(?: |$))+", "")
    kept = merged.withColumn("concept", bare).where((F.col("concept") != "") & ~F.col("concept").isin(INTERVENTION_WORDS)).distinct().join(gone, "concept", "left_anti")
    words = F.split("concept", " ")
    head, tail = F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), " "), F.element_at(words, -1)
    longer = kept.where(tail.isin(INTERVENTION_WORDS)).select("concept", "class", head.alias("head"))
    doubled = longer.join(kept.select(F.col("concept").alias("head"), "class"), ["head", "class"], "left_semi").select("concept", "class")
    kept = settle(kept.join(doubled, ["concept", "class"], "left_anti"))
    of = phrase_vectors(kept.select(F.col("concept").alias("phrase")), vectors).withColumnRenamed("phrase", "concept")
    middles = phrase_vectors(layers.select(F.col("middle").alias("phrase")), vectors).select(F.col("phrase").alias("middle"), F.col("vector").alias("m"))
    near = kept.join(of, "concept").join(layers.join(middles, "middle"), "class").withColumn("s", F.round(cosine(F.col("vector"), F.col("m")), 2)).where(F.col("s") >= least)
    best = near.groupBy("concept", "class").agg(F.min_by("middle", F.struct((-F.col("s")).alias("s"), "middle")).alias("middle"))
    for old, new in (renamed or {}).items():
        best = best.withColumn("middle", F.when(F.col("middle") == old, F.lit(new)).otherwise(F.col("middle")))
    return kept.join(best, ["concept", "class"], "left").select("concept", "class", F.coalesce("middle", F.lit("other")).alias("middle"))


def frequent_form(concepts: DataFrame, vocabulary: DataFrame, ratio: float = 2.0) -> DataFrame:
    """Columns concept, form: a concept of several words written together where that is `ratio` times as frequent as apart."""
    joined = concepts.select("concept").distinct().withColumn("glued", F.replace("concept", F.lit(" "), F.lit("")))
    apart, glued = (vocabulary.select(F.col("term").alias(c), F.col("df").alias(f"df_{c}")) for c in ("concept", "glued"))
    rows = joined.join(apart, "concept", "left").join(glued, "glued", "left")
    together = F.contains("concept", F.lit(" ")) & (F.coalesce("df_glued", F.lit(0)) > ratio * F.coalesce("df_concept", F.lit(0)))
    return rows.select("concept", F.when(together, F.col("glued")).otherwise(F.col("concept")).alias("form"))


def contexts(sentences: DataFrame, terms: DataFrame, reach: int = 2) -> DataFrame:
    """Columns doc_id, place, term, context: sentences that hold a term, with up to `reach` sentences on either side.

    sentences: doc_id, place, sentence; terms: term (lower case, whole words).
    """
    around = Window.partitionBy("doc_id").orderBy("place").rowsBetween(-reach, reach)
    rows = sentences.withColumn("context", F.array_join(F.collect_list("sentence").over(around), " "))
    words = rows.select("doc_id", "place", "context", F.concat(F.lit(" "), F.regexp_replace(F.lower("sentence"), "[^a-z0-9]+", " "), F.lit(" ")).alias("s"))
    first = words.select("*", F.explode(F.array_distinct(F.split("s", " "))).alias("first")).where("first <> ''")
    keyed = terms.select("term").distinct().withColumn("first", F.split("term", " ")[0])
    return first.join(keyed, "first").where(F.contains("s", F.concat(F.lit(" "), "term", F.lit(" ")))).select("doc_id", "place", "term", "context")


def split_contexts(rows: DataFrame, crops: list[str], filtered: list[str]) -> DataFrame:
    """Columns id, part: the context of a row (id, context) once for each crop it names, with the other crops taken out, and without filtered words.

    A context that names no crop, or one, is one part. Parts that clean to nothing go; equal ones of a row are given once.
    """
    words = F.filter(F.split(squeeze(F.col("context")), " "), lambda w: ~F.lower(w).isin(filtered))
    named = F.array_distinct(F.filter(F.transform(words, lambda w: F.lower(F.regexp_replace(w, "[^A-Za-z]", ""))), lambda w: w.isin(crops)))
    base = rows.select("id", words.alias("w"), named.alias("named"))
    chosen = base.select("id", "w", F.explode(F.when(F.size("named") > 1, F.col("named")).otherwise(F.array(F.lit("")))).alias("crop"))
    kept = F.filter("w", lambda w: (F.col("crop") == "") | (F.lower(F.regexp_replace(w, "[^A-Za-z]", "")) == F.col("crop")) | ~F.lower(F.regexp_replace(w, "[^A-Za-z]", "")).isin(crops))
    text = F.trim(F.regexp_replace(F.array_join(kept, " "), r"(?:\s*,\s*(?:and\s+)?)+(?=\s|$|[.;])|^\s*(?:and|or)\s+", " "))
    return chosen.select("id", squeeze(text).alias("part")).where("part <> ''").distinct()


def token_chunks(text: Column, size: int = 1024) -> Column:
    """A text in pieces of at most `size` words, as a summariser takes them."""
    words = F.filter(F.split(squeeze(text), " "), lambda w: w != "")
    return F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(words) - 1) / size).cast("int")), lambda k: F.array_join(F.slice(words, k * size + 1, size), " "))).otherwise(F.array().cast("array<string>"))


def head_and_tail(words: Column, size: int, head: float = 0.5) -> Column:
    """The first and last words of a text too long for a model: `size` words in all, a share `head` of them from the start."""
    first = int(size * head)
    return F.when(F.size(words) <= size, words).otherwise(F.concat(F.slice(words, 1, first), F.slice(words, F.size(words) - (size - first) + 1, size - first)))


def funders(text: Column) -> Column:
    """Organisations that an acknowledgement names after "funded by", "supported by" or "grant from": runs of capitalised words."""
    rule = r"(?:[Ff]unded|[Ss]upported|[Ff]inanced) by (?:the )?((?:[A-Z][A-Za-z&-]+(?: (?:of|for|and|the) )?\s?){1,8})|[Gg]rants? from (?:the )?((?:[A-Z][A-Za-z&-]+(?: (?:of|for|and|the) )?\s?){1,8})"
    found = F.concat(*[F.regexp_extract_all(text, F.lit(rule), F.lit(g)) for g in (1, 2)])
    return F.array_sort(F.array_distinct(F.filter(F.transform(found, lambda f: F.trim(f)), lambda f: F.length(f) > 2)))


def chains_end(links: DataFrame) -> DataFrame:
    """Columns concept, canonical with every chain followed to its end, from (concept, canonical)."""
    return follow(links.select(F.col("concept").alias("source"), F.col("canonical").alias("target"))).select(F.col("source").alias("concept"), F.col("target").alias("canonical"))
