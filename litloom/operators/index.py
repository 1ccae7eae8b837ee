"""The inverted index: postings and vocabulary as tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from litloom.functions.text import Terms, normalize_keywords, normalize_text, term_lists, tokens


def index_text(df: DataFrame, text_cols: list[str], keyword_cols: list[str] = ()) -> Column:
    """The searched text of a row: its columns, cleaned, with a full stop between."""
    cleaned = [normalize_keywords(F.col(c)) if c in keyword_cols else normalize_text(F.col(c)) for c in text_cols]
    return F.concat_ws(" . ", *cleaned)


def neighbours(words: Column) -> Column:
    """Pairs of neighbouring terms, also across sentences. Give a column: it is used more than once."""
    n = F.size(words)
    return F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n, F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))


SMALL_BYTES = 16 << 20


def spread(df: DataFrame, small: int = SMALL_BYTES) -> DataFrame:
    """Rows dealt out over all cores where the planner expects less than `small` bytes for each; larger tables stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * small else df


MOST_KNOWN = 200_000
ROWS = 1000


def with_terms(df: DataFrame, columns: list[str], text: Column, name: str = "words", pairs: bool = False) -> DataFrame:
    """`columns` of `df` and the terms of a text, as `tokens(normalize_text(text))` gives them; with `pairs` its distinct terms and
    distinct pairs of neighbours, in no order.

    Built-in functions would judge each word of each text in the interpreter; here a task judges each distinct word once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Terms()
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], term_lists(part.columns[-1], known, pairs)], names=[*columns, name])
                if len(known) > MOST_KNOWN:
                    known = Terms()

    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    given = next(n for i in range(len(columns) + 1) if (n := f"text_{i}") not in columns)
    rows = df.select(*columns, text.alias(given))
    return rows.mapInArrow(run, df.select(*columns).schema.add(name, ArrayType(StringType())))


def build_terms(df: DataFrame, id_col: str = "doc_id", text_cols: list[str] = ("text",), keyword_cols: list[str] = ()) -> DataFrame:
    """Columns term, doc_id, distinct within a row: what exact searches need, without a shuffle. Null texts have no terms."""
    df = spread(df.select(id_col, *text_cols))
    if not keyword_cols:
        rows = with_terms(df.withColumnRenamed(id_col, "doc_id"), ["doc_id"], F.concat_ws(" . ", *text_cols), "terms", pairs=True)
        return rows.select("doc_id", F.explode("terms").alias("term")).select("term", "doc_id")
    # The tokens are a column of their own, so that they are computed once for each row.
    words = df.select(F.col(id_col).alias("doc_id"), tokens(index_text(df, list(text_cols), list(keyword_cols))).alias("w"))
    return words.select("doc_id", F.explode(F.array_distinct(F.concat("w", neighbours(F.col("w"))))).alias("term")).select("term", "doc_id")


def build_postings(df: DataFrame, id_col: str = "doc_id", text_cols: list[str] = ("text",), keyword_cols: list[str] = ()) -> DataFrame:
    """Columns term, doc_id, without repeats. Rows that share an id are one document.

    Terms are made distinct within a row before anything is shuffled.
    """
    return build_terms(df, id_col, text_cols, keyword_cols).distinct()


def build_vocabulary(postings: DataFrame) -> DataFrame:
    """Columns term, prefix3, n_tokens, df (documents that hold the term)."""
    counted = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counted.select("term", F.substr(F.col("term"), F.lit(1), F.lit(3)).alias("prefix3"), F.size(F.split("term", " ")).alias("n_tokens"), "df")


def trimmed_vocabulary(vocabulary: DataFrame, least: int = 2) -> DataFrame:
    return vocabulary.where(F.col("df") >= least)


def save_index(postings: DataFrame, path: str) -> None:
    postings.write.mode("overwrite").parquet(f"{path}/postings")
    build_vocabulary(postings).write.mode("overwrite").parquet(f"{path}/vocabulary")


def load_index(spark, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/vocabulary")
