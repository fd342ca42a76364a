"""Incremental ingest: new files are picked up, keyed and merged; failures give way to later successes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from casegrain.functions.keys import case_uid


def patient_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """Patient rows of new Parquet files, with normalised uids; rows without one are left out."""
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return s.withColumn("uid", case_uid(F.col("patient_uid"))).where(F.col("uid").isNotNull())


def monthly_arrivals(stream: DataFrame, stamp: str) -> DataFrame:
    """Rows per calendar month of ``stamp``, however late they arrive; for output modes complete and update.

    Without a watermark no row is dropped; the state is one count per month.
    """
    t = stream.select(F.date_trunc("month", F.col(stamp).cast("timestamp")).alias("start")).where("start IS NOT NULL")
    return t.groupBy("start").agg(F.count(F.lit(1)).alias("rows")).select("start", (F.col("start") + F.expr("INTERVAL 1 MONTH")).alias("end"), "rows")


def merge_latest(stream: DataFrame, target: str, key: str, stamp: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Keeps the latest row per key at ``target`` (Parquet, one folder per batch number, the last complete one counts).

    A batch is merged with the last result and written beside it; as its folder is named by the batch, a repeated batch
    overwrites its own result and changes nothing else.
    """

    def merge(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        old = latest(spark, target, before=n)
        rows = batch.select(*batch.columns) if old is None else old.unionByName(batch.select(*old.columns))
        best = rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), stamp).alias("r")).select(key, "r.*")
        best.select(*batch.columns).write.mode("overwrite").parquet(f"{target}/batch={n:010d}")

    w = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def latest(spark: SparkSession, target: str, before: int | None = None) -> DataFrame | None:
    """The newest complete result of ``merge_latest``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName().startswith("batch="))
    done = [n for n in names if (before is None or int(n[6:]) < before) and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{n}/_SUCCESS"))]
    return spark.read.parquet(f"{target}/{done[-1]}") if done else None


def outstanding(wanted: DataFrame, done: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """Keys still to do: not done yet. A failure is tried again until a success supersedes it."""
    todo = wanted.select(key).distinct().join(done.select(key), key, "left_anti")
    return todo.join(failed.select(key, F.lit(True).alias("again")).distinct(), key, "left").withColumn("again", F.coalesce("again", F.lit(False)))
