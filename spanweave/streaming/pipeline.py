"""The per-record operators on streams. The batch functions are stateless, so they run unchanged."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.functions.text import DEFAULT, CleanConfig
from spanweave.operators.clean import clean_records


def read_records(spark: SparkSession, folder: str, schema, files_per_trigger: int = 16) -> DataFrame:
    """A stream of the Parquet files that appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def clean_stream(records: DataFrame, config: CleanConfig = DEFAULT) -> DataFrame:
    return clean_records(records, config)


def daily_counts(events: DataFrame, ts: str, key: str, late: str = "7 days") -> DataFrame:
    """(day, key, n) of a stream with a watermark: the state of closed days is dropped."""
    days = events.withWatermark(ts, late).groupBy(F.window(ts, "1 day"), key).agg(F.count("*").alias("n"))
    return days.select(F.col("window.start").cast("date").alias("day"), key, "n")


def monthly_counts(days: DataFrame, key: str) -> DataFrame:
    """(month, key, n): calendar months, which are no windows of fixed length, added up from what daily_counts wrote."""
    return days.groupBy(F.date_trunc("month", "day").cast("date").alias("month"), key).agg(F.sum("n").alias("n"))


def run_available(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Work off what is there, with exactly-once files, and stop."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_until_idle(stream: DataFrame, out: str, checkpoint: str, seconds: float = 600.0) -> None:
    """Work off what is there and stop at the first batch without rows; for state that expires with the clock, whose queries do not end by themselves."""
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(processingTime="100 milliseconds").start()
    until = time.monotonic() + seconds
    try:
        while query.isActive and time.monotonic() < until:
            if any(p["numInputRows"] == 0 for p in query.recentProgress):
                return
            time.sleep(0.1)
        if error := query.exception():
            raise error
        raise TimeoutError(f"the stream was not idle after {seconds} s")
    finally:
        query.stop()
