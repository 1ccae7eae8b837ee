"""Incremental ingestion: new files only, the same operators, a checkpoint instead of a list of files done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litloom.operators.index import build_postings


def index_new_files(spark: SparkSession, folder: str, schema: str, out: str, checkpoint: str, text_col: str = "text", id_col: str = "doc_id"):
    """Append postings of files that have not been read before, then stop. Returns the finished query."""

    def append(batch: DataFrame, epoch: int) -> None:
        # A batch that is run again after a failure replaces its own folder.
        build_postings(batch, id_col, [text_col]).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    rows = spark.readStream.schema(schema).parquet(folder)
    query = rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def windowed_counts(events: DataFrame, time_col: str = "ts", key: str = "event_type", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by time window and key; rows later than `late` are left out. An extension for event streams."""
    return events.withWatermark(time_col, late).groupBy(F.window(time_col, window), key).agg(F.count(F.lit(1)).alias("n"))


def index_stream(spark: SparkSession, folder: str, schema: str, checkpoint: str, index: str, properties: list[str], id_col: str, send):
    """Documents of new files to a search server, batch by batch, then stop; a batch that is run again sends the same ids."""
    from litloom.sources.sinks import send_bulk

    rows = spark.readStream.schema(schema).parquet(folder)
    query = rows.writeStream.foreachBatch(lambda batch, epoch: send_bulk(batch, index, properties, id_col, send)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
