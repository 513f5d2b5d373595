"""What is sent to Python workers at once."""

from __future__ import annotations

from pyspark.sql import SparkSession

BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes: rows are whole texts here and a few numbers there, so a count of rows fits neither."""
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_KEY))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(BATCH_KEY, f"{BATCH_BYTES}b")
