"""Cutting lineage in the folder that executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local session without that setting gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Checkpoint `df` in the shared folder, so a lost executor costs no upstream work."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def tabled(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read again: compressed, by columns, and of a size that the planner knows."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def follow(links: DataFrame) -> DataFrame:
    """Columns source, target with every target replaced by the end of its chain, by doubling, until nothing changes.

    Each source has one row, and the end of a chain is a source that is its own target. Chains have no other cycles.
    """
    links = settle(links.select("source", "target"))
    while True:
        further = links.select(F.col("source").alias("target"), F.col("target").alias("further"))
        step = settle(links.join(further, "target").select("source", F.col("further").alias("target"), (F.col("further") != F.col("target")).alias("changed")))
        links = step.select("source", "target")
        if not step.where("changed").limit(1).count():
            return links
