"""The candidate ledger as a stream: each micro-batch becomes one row a key, and versions are merged when read.

Batches are pre-aggregated before they are written, so a hot key costs a row a batch. A batch number is a partition that
is overwritten, so a batch that runs twice after a failure counts once. compact() folds old batches into a base.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fold(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status_id").agg(F.max(F.struct("last_seen", "text")).getField("text").alias("text"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.max("retweets").alias("retweets"), F.sum("observations").alias("observations"))


def maintain(stream: DataFrame, path: str, checkpoint: str):
    """stream: status_id, text, seen (timestamp), retweets."""

    def merge(batch: DataFrame, number: int) -> None:
        rows = batch.select("status_id", "text", F.col("seen").alias("first_seen"), F.col("seen").alias("last_seen"), F.col("retweets").cast("long").alias("retweets"), F.lit(1).cast("long").alias("observations"))
        _fold(rows).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).start()


def current(spark: SparkSession, path: str, now=None, days: int | None = None) -> DataFrame:
    """One row a key over all batches; with now and days only those seen since."""
    out = _fold(spark.read.parquet(path))
    return out if days is None else out.where(F.col("last_seen") >= now - F.expr(f"interval {days} days"))


def compact(spark: SparkSession, path: str, to: str) -> None:
    """The folded ledger as batch -1 of a new path."""
    current(spark, path).write.mode("overwrite").parquet(f"{to}/batch=-1")


def windowed_counts(stream: DataFrame, at: str, key: str, window: str, late: str) -> DataFrame:
    """Counts of each key in event-time windows, final once the watermark has passed."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window), key).agg(F.count("*").alias("n"))
