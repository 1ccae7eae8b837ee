"""Writing results: chunked files, separated text, index projections and the lines that a search server takes in bulk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_A_FILE = 100_000


def write_chunks(df: DataFrame, path: str, rows: int = ROWS_A_FILE) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path)


def write_separated(df: DataFrame, path: str, sep: str = ";") -> None:
    """Text files; lists become JSON, which parse_list reads back."""
    columns = [F.to_json(c).alias(c) if kind.startswith("array") else F.col(c) for c, kind in df.dtypes]
    df.select(*columns).write.mode("overwrite").csv(path, header=True, sep=sep, quoteAll=True, escape='"')


def index_documents(df: DataFrame, properties: list[str], id_col: str) -> DataFrame:
    """The declared properties that the table has, one row for each id, as a search server takes them."""
    kept = [p for p in properties if p in df.columns]
    return df.select(id_col, *[p for p in kept if p != id_col]).dropDuplicates([id_col])


def upsert(existing: DataFrame, new: DataFrame, id_col: str) -> DataFrame:
    """All rows by id: those of `new` in place of existing ones with the same id; columns that one side lacks are null."""
    return existing.join(new.select(id_col).distinct(), id_col, "left_anti").unionByName(new.dropDuplicates([id_col]), allowMissingColumns=True)


def bulk_lines(df: DataFrame, index: str, properties: list[str], id_col: str) -> DataFrame:
    """Columns id, line: for each document an action line and the document itself as JSON, in one text of two lines."""
    rows = index_documents(df, properties, id_col)
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), F.col(id_col).cast("string").alias("_id")).alias("index")))
    document = F.to_json(F.struct(*[c for c in rows.columns if c != id_col]))
    return rows.select(F.col(id_col).alias("id"), F.concat_ws("\n", action, document).alias("line"))


def send_bulk(df: DataFrame, index: str, properties: list[str], id_col: str, send, chunk: int = 1000) -> None:
    """Documents to a search server, `chunk` at a time from each partition: send(text) is called on the executors and must be safe to repeat, since lost tasks run again."""
    lines = bulk_lines(df, index, properties, id_col).select("line")

    def run(rows) -> None:
        held = []
        for row in rows:
            held.append(row["line"])
            if len(held) == chunk:
                send("\n".join(held) + "\n")
                held = []
        if held:
            send("\n".join(held) + "\n")

    lines.foreachPartition(run)


def saved_objects(df: DataFrame, kind: str, id_col: str, title_col: str) -> DataFrame:
    """Column line: dashboard objects as JSON lines, as a dashboard exports and imports them."""
    attributes = F.struct(F.col(title_col).alias("title"), *[c for c in df.columns if c not in (id_col, title_col)])
    return df.select(F.to_json(F.struct(F.col(id_col).cast("string").alias("id"), F.lit(kind).alias("type"), attributes.alias("attributes"))).alias("line"))


def read_objects(lines: DataFrame, schema: str) -> DataFrame:
    """Columns id, type and the attributes of exported objects (line); lines that are none go."""
    parsed = lines.select(F.from_json("line", f"id string, type string, attributes struct<{schema}>").alias("o"))
    return parsed.select("o.id", "o.type", "o.attributes.*").where("id is not null")


def clear_folder(spark, path: str) -> None:
    """Delete all that stands in a folder, wherever it is, and leave the folder empty."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(at, True)
    files.mkdirs(at)
