"""Payments as a stream: duplicates rejected, closed days totalled."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_stream(spark: SparkSession, folder: str, schema: StructType, files: str = "*.parquet",
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a folder as they arrive. ``files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def daily_totals(payments: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Payments and value per day, each transaction id once, days emitted when they are closed.

    Copies that arrive within the delay of each other are dropped; state older than the
    watermark is released.
    """
    once = payments.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["transaction_id"])
    return (
        once.groupBy(F.window("timestamp", "1 day"))
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("payment_value_gbp"),
        )
        .select(F.col("window.start").cast("date").alias("calendar_date"), "transactions", "payment_value_gbp")
    )


def drain_to_parquet(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Process all that is available, append results to the target, stop."""
    (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )
