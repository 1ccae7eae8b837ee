"""Reading tables and cutting lineage."""

from __future__ import annotations

import gc
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_ROWS = 1000
MOST_BITS = 26


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local session without that setting gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that is no longer read, wherever it is."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def settle(df: DataFrame) -> DataFrame:
    """Checkpoint `df` in the shared folder, so a lost executor costs no upstream work. The driver's heap is kept small, see `relieve`."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    relieve(df.sparkSession)
    return df.checkpoint(eager=True)


def sweep(spark: SparkSession) -> None:
    """Let Spark delete the shuffles, broadcasts and checkpoints of tables that nothing refers to any more.

    Spark does so when the driver's JVM collects their handles. A large heap is collected seldom, so that rounds of joins would leave
    their files and broadcasts behind until the end.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def relieve(spark: SparkSession) -> None:
    """Sweep, once the driver's JVM has taken half of the heap that it may have.

    Plans, events and tables for broadcasts of past rounds are garbage, of which a few tens of MB live. Uncollected they
    make the JVM take its whole heap, and a collection gives most of that back to the system.
    """
    runtime = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    if 2 * runtime.totalMemory() > runtime.maxMemory():
        sweep(spark)


def tabled(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read again, so that the planner knows its size."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python ARROW_ROWS at a time, where the session has set no other number, so that long ones fit in memory."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def id_bit(id_: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(1 << bits)).cast("int")


def id_bitmap(ids: DataFrame, column: str, count: int) -> tuple[int, np.ndarray]:
    """A bitmap over hashes of ids, 16 bits for each up to 2 ** MOST_BITS (8 MB) in all, as (log2 of its size, 64-bit words).

    It can only say yes where it should say no, more often where there are more ids than it has room for.
    """
    bits = min(MOST_BITS, max(16, (16 * count).bit_length()))
    bit = id_bit(F.col(column), bits)
    words = ids.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("bits"))
    found = words.toArrow()  # at most the bitmap
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    bitmap[np.asarray(found["word"])] = np.asarray(found["bits"])
    return bits, bitmap


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
