"""The log fed by a stream of landing files: each micro-batch is one commit (2.L, M-06).

The checkpoint of the stream is the resume ledger of the files: a second run over the same folder does nothing,
and a new file becomes one new batch.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schema
from tidemark.plans import run
from tidemark.plans.store import Store


def landing_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema.LANDING).option("maxFilesPerTrigger", max_files).parquet(folder)


def drain(store: Store, folder: str, checkpoint: str, now: datetime, holder: str = "stream", seconds: float = 300) -> StreamingQuery:
    """Absorb all files that weren't absorbed before, then stop. The lease keeps other writers out, and is renewed with each batch."""

    def absorb(batch: DataFrame, batch_id: int) -> None:
        run_id = f"stream-{batch_id:012d}"
        store.renew(holder, seconds)
        ended = run.runs(store).filter((F.col("id") == run_id) & (F.col("status") != "running"))
        if not ended.isEmpty():
            return  # committed by an earlier attempt at this batch
        if batch.isEmpty():
            return
        if run.tasks(store).filter(F.col("run_id") == run_id).isEmpty():
            run.start(store, batch.select("task_key", "source", "url").distinct(), now, run_id)
        run.absorb(store, run_id, batch, now)
        run.finish(store, run_id, now)

    with store.lease(holder, seconds):
        query = landing_stream(store.spark, folder).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(absorb).start()
        query.awaitTermination()
    return query


def daily_counts(postings: DataFrame, delay: str = "2 days") -> DataFrame:
    """F-25 over a stream: postings by source and day, each day once its watermark has passed."""
    return postings.withWatermark("seen_at", delay).groupBy(F.window("seen_at", "1 day").alias("day"), "source").agg(F.count("*").alias("n")).select(F.to_date("day.start").alias("day"), "source", "n")
