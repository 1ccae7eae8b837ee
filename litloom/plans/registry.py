"""Registered steps and the configured pipeline that runs them in order."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litloom.functions import affiliation
from litloom.functions import text as T
from litloom.operators import abbreviations as abbr
from litloom.operators import affiliations as affil
from litloom.operators import dedup, geo, hearst, index, labels, learned, measurements, mining, repairs, search, taxonomies

Step = Callable[[DataFrame, "Context", dict], DataFrame]
STEPS: dict[str, Step] = {}
log = logging.getLogger(__name__)


def register(name: str) -> Callable[[Step], Step]:
    def add(step: Step) -> Step:
        STEPS[name] = step
        return step

    return add


@dataclass
class Context:
    """What steps share: the id and text columns, dictionaries by name, and the index, built once."""

    id_col: str = "doc_id"
    text_col: str = "text"
    dictionaries: dict[str, DataFrame] = field(default_factory=dict)
    postings: DataFrame | None = None
    vocabulary: DataFrame | None = None

    def index(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        if self.postings is None:
            self.postings = index.build_postings(df, self.id_col, [self.text_col])
            self.vocabulary = index.build_vocabulary(self.postings)
        return self.postings, self.vocabulary


def run(df: DataFrame, config: str | list[dict], context: Context | None = None, on_error: str = "raise") -> DataFrame:
    """Apply configured steps in order: a JSON text {"columns": [{"step": name, ...options}]} or its list.

    A step with "apply": false is passed over. on_error "skip" logs a failing step and goes on with the table
    it was given; plans are analysed step by step, so mistakes show before any job runs.
    """
    steps = json.loads(config)["columns"] if isinstance(config, str) else config
    context = context or Context()
    for options in steps:
        if not options.get("apply", True):
            continue
        try:
            step = STEPS[options["step"]]
            df = step(df, context, options)
            df.schema  # noqa: B018
        except Exception:
            if on_error != "skip":
                raise
            log.exception("step %s failed and is skipped", options.get("step"))
    return df


def _joined(df: DataFrame, found: DataFrame, context: Context, column: str) -> DataFrame:
    """`found` (doc_id, label) as a list column of `df`; empty where there is none."""
    lists = labels.as_lists(found).select(F.col("doc_id").alias("__id"), F.col("label").alias(column))
    joined = df.drop(column).join(lists, F.col(context.id_col) == F.col("__id"), "left").drop("__id")
    return joined.withColumn(column, F.coalesce(column, F.array().cast("array<string>")))


@register("normalize_text")
def normalize(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """Titles and texts cleaned in a fixed order; with `full`, shouted and glued words of the table are put right first, and all is cleaned again."""
    column = options.get("column", context.text_col)
    output = options.get("output", column)
    out = df.withColumn(output, repairs.clean_text(F.col(column)))
    if options.get("full"):
        posts = index.build_postings(out, context.id_col, [output])
        fixes = repairs.word_fixes(index.build_vocabulary(posts), options.get("heads", repairs.HEADS))
        out = repairs.apply_fixes(out, fixes, context.id_col, output).withColumn(output, repairs.clean_text(F.col(output)))
    return out


@register("keywords")
def keywords(df: DataFrame, context: Context, options: dict) -> DataFrame:
    lists = [T.index_keywords(F.coalesce(F.col(c), F.lit(""))) for c in options["columns"]]
    return df.withColumn(options.get("output", "normalized_key_words"), F.array_distinct(F.concat(*lists)))


@register("journal")
def journal(df: DataFrame, context: Context, options: dict) -> DataFrame:
    return df.withColumn(options.get("column", "journal"), T.journal_name(F.col(options.get("column", "journal"))))


@register("deduplicate")
def deduplicate(df: DataFrame, context: Context, options: dict) -> DataFrame:
    kept = dedup.deduplicate(df, context.id_col, context.text_col).where("kept").select(F.col("doc_id").alias("__id"))
    return df.join(kept, F.col(context.id_col) == F.col("__id"), "left_semi")


@register("dictionary")
def dictionary(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """Labels of a dictionary (query_id, query, label), found by search at a threshold."""
    entries = context.dictionaries[options["dictionary"]]
    found = labels.dictionary_labels(search.search(entries, *context.index(df), options.get("threshold", 0.92)), entries)
    if "default" in options:
        found = labels.with_default(df.select(F.col(context.id_col).alias("doc_id")), found, options["default"])
    return _joined(df, found, context, options["output"])


@register("hierarchy")
def hierarchy(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """Paths of a dictionary (query_id, query, class, middle, name)."""
    entries = context.dictionaries[options["dictionary"]]
    paths = labels.hierarchy_paths(search.search(entries, *context.index(df), options.get("threshold", 0.92)), entries)
    return _joined(df, paths.withColumnRenamed("path", "label"), context, options["output"])


@register("proximity")
def proximity(df: DataFrame, context: Context, options: dict) -> DataFrame:
    near = labels.proximity(F.col(context.text_col), options["markers"], options["modifiers"], options.get("reach", 5))
    return df.withColumn(options["output"], near)


@register("rename")
def rename(df: DataFrame, context: Context, options: dict) -> DataFrame:
    return df.withColumn(options["column"], labels.rename_values(F.col(options["column"]), options["mapping"]))


@register("abbreviations")
def abbreviations(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """Bracketed abbreviations of each text, with what they stand for."""
    return df.withColumn(options.get("output", "abbreviations"), abbr.bracketed(F.col(context.text_col)))


@register("hyponyms")
def hyponyms(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """Pairs (narrow, broad, pattern) of each text."""
    rows = df.select(F.col(context.id_col).alias("__id"), F.explode(T.sentences(F.col(context.text_col))).alias("sentence"))
    found = hearst.pairs(rows, ["__id"]).groupBy("__id").agg(F.array_sort(F.collect_set(F.struct("narrow", "broad", "pattern"))).alias("__pairs"))
    output = options.get("output", "hyponyms")
    joined = df.drop(output).join(found, F.col(context.id_col) == F.col("__id"), "left").drop("__id")
    return joined.withColumn(output, F.coalesce("__pairs", F.array().cast("array<struct<narrow:string,broad:string,pattern:int>>"))).drop("__pairs")


@register("authors")
def authors(df: DataFrame, context: Context, options: dict) -> DataFrame:
    return df.withColumn(options.get("output", "authors"), mining.authors(F.col(options.get("column", "authors"))))


@register("year")
def year(df: DataFrame, context: Context, options: dict) -> DataFrame:
    return df.withColumn(options.get("column", "year"), T.find_year(F.col(options.get("column", "year"))))


def _listed(df: DataFrame, found: DataFrame, context: Context, kind: str, column: str) -> DataFrame:
    """Values of one kind (doc_id, kind, value) as a list column."""
    return _joined(df, found.where(F.col("kind") == kind).select("doc_id", F.col("value").alias("label")), context, column)


@register("crops")
def crops(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """Three columns from a dictionary (level_3, broad, narrow): paths, names found, and terms of the third level."""
    found = taxonomies.three_levels(context.dictionaries[options["dictionary"]], *context.index(df), options.get("threshold", 0.92))
    output = options["output"]
    for kind, column in (("path", output), ("details", f"{output}_details"), ("broad", f"{output}_broad")):
        df = _listed(df, found, context, kind, column)
    return df


@register("interventions")
def interventions(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """Classes, names, paths and a column for each class from a dictionary (query_id, query, class, middle, name)."""
    entries = context.dictionaries[options["dictionary"]]
    found = taxonomies.intervention_columns(search.search(entries, *context.index(df), options.get("threshold", 0.92)), entries)
    for kind, column in (("class", "intervention_labels"), ("raw", "interventions_found_raw"), ("path", "interventions_found")):
        df = _listed(df, found, context, kind, column)
    for name in options.get("classes", []):
        df = _listed(df, found, context, f"class:{name}", name)
    return df


@register("population")
def population(df: DataFrame, context: Context, options: dict) -> DataFrame:
    docs = df.select(F.col(context.id_col).alias("doc_id"), F.col(context.text_col).alias("text"))
    found = taxonomies.populations(docs, *context.index(df), options.get("threshold", 0.9))
    return _joined(df, found.withColumnRenamed("tag", "label"), context, options.get("output", "population tags"))


@register("places")
def places(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """Country codes by name, adjective, currency and group, from four dictionaries (name, code)."""
    tables = [context.dictionaries[options[k]] for k in ("countries", "adjectives", "currencies", "groups")]
    found = taxonomies.place_phases(*context.index(df), *tables, options.get("indicators", []), options.get("threshold", 0.92))
    return _joined(df, found.where("phase < 3").select("doc_id", F.col("code").alias("label")), context, options.get("output", "country_codes"))


@register("programs")
def programs(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """Programmes of a dictionary (program), with the meanings that abbreviations have in each document (doc_id, abbr, meaning)."""
    used = context.dictionaries[options["meanings"]]
    found = taxonomies.programme_labels(context.dictionaries[options["dictionary"]], *context.index(df), used, options.get("threshold", 0.92))
    return _joined(df, found.withColumnRenamed("program", "label"), context, options.get("output", "programs_found"))


@register("strategies")
def strategies(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """Labels of rules (rule_id, query_id, query, wanted, label): all keywords of a rule hit, and the document has the wanted label."""
    rules = context.dictionaries[options["dictionary"]]
    hits = search.search(rules.select("query_id", "query").distinct(), *context.index(df), options.get("threshold", 0.92))
    have = df.select(F.col(context.id_col).alias("doc_id"), F.explode(options["labels"]).alias("label"))
    return _joined(df, labels.rule_labels(hits, have, rules), context, options["output"])


@register("priority")
def priority(df: DataFrame, context: Context, options: dict) -> DataFrame:
    return df.withColumn(options.get("output", "priority"), measurements.priority(F.col(options["probability"])))


@register("entities")
def entities(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """Entities by any model: `extractor` names a function of a text column in options that gives an array of strings; without one, runs of capitalised words."""
    extractor = options.get("extractor") or taxonomies.text_mentions
    return df.withColumn(options.get("output", "entities"), extractor(F.col(context.text_col)))


@register("affiliations")
def affiliations(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """Institutions of a column of affiliations between semicolons, under the canonical name of their country's cluster."""
    column = options.get("column", "raw_affiliation")
    rows = df.select(F.col(context.id_col).alias("id"), F.coalesce(F.col(column), F.lit("")).alias("affiliation"))
    parts = geo.major_country(geo.affiliations(rows, options.get("markers", ["univ", "institut", "college"])))
    named = parts.withColumn("name", affiliation.processed(F.col("name"))).where("name <> ''")
    counts = named.groupBy("name", "country").agg(F.count(F.lit(1)).alias("n"))
    clusters = affil.cluster(counts.groupBy("name").agg(F.max_by("country", F.struct("n", "country")).alias("country"), F.sum("n").alias("n")))
    found = named.join(clusters, "name").select(F.col("id").alias("doc_id"), F.col("canonical").alias("label")).distinct()
    return _joined(df, found, context, options.get("output", "affiliations"))


@register("topics")
def topics(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """The topics of each text, by number: its top ones and those with a good share of a topic's largest weight."""
    docs = learned.with_words(df.select(context.id_col, context.text_col), context.text_col)
    model = learned.fit_topics(docs, options.get("k", 15), iterations=options.get("iterations", 20))
    found = learned.document_topics(model, docs, context.id_col, options.get("top", 3), options.get("share", 0.3))
    return _joined(df, found.select("doc_id", F.col("topic").cast("string").alias("label")), context, options.get("output", "topics"))


@register("measurements")
def measurement(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """Concepts (one word each) that a number of a sentence is nearest to."""
    found = measurements.closest_concepts(df, options["concepts"], context.id_col, context.text_col)
    return _joined(df, found.select("doc_id", F.col("concept").alias("label")).distinct(), context, options.get("output", "measurements"))


@register("comparisons")
def comparisons(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """What sentences compare, as "a | b"."""
    pairs = F.flatten(F.transform(T.sentences(F.coalesce(F.col(context.text_col), F.lit(""))), measurements.comparisons))
    return df.withColumn(options.get("output", "compared_terms"), F.array_sort(F.array_distinct(F.transform(pairs, lambda p: F.concat_ws(" | ", p["a"], p["b"])))))


@register("outcomes")
def outcomes(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """Labels of sentences by patterns (label to regular expression), with the sentences as "[label] sentence"; a model's scores fit in by label_sentences."""
    scores = {label: F.col("sentence").rlike(rule).cast("double") for label, rule in options["patterns"].items()}
    found = measurements.label_sentences(df, scores, id_col=context.id_col, text_col=context.text_col)
    output = options.get("output", "outcomes")
    df = _joined(df, found.select("doc_id", "label"), context, output)
    details = found.select("doc_id", F.explode("details").alias("s"), "label").select("doc_id", F.concat(F.lit("["), "label", F.lit("] "), "s").alias("label"))
    return _joined(df, details, context, f"{output}_details")


@register("classify")
def classify(df: DataFrame, context: Context, options: dict) -> DataFrame:
    """The class that a model learns from a dictionary (text, label: a number from 0 on)."""
    words = lambda rows, column: learned.with_words(rows, column)
    model = learned.fit_classifier(words(context.dictionaries[options["examples"]].withColumn("label", F.col("label").cast("double")), "text"))
    rows = words(df.withColumn("__text", F.coalesce(F.col(context.text_col), F.lit(""))), "__text")
    return model.transform(rows).select(*df.columns, F.col("prediction").cast("int").alias(options.get("output", "class")))
