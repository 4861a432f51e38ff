"""Streaming forms of the daily aggregates: late rows within the watermark still count. Sums are doubles of the finite values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alluvia.functions.scalars import finite


def daily_stream(stream: DataFrame, keys: list[str], ts: str, value: str, late: str = "2 days") -> DataFrame:
    """Count and sum by key and day of a stream; a day closes when the watermark has passed it."""
    days = stream.withWatermark(ts, late).groupBy(*keys, F.window(ts, "1 day"))
    v = finite(F.col(value).cast("double"))
    return days.agg(F.count(v).alias("n"), F.sum(v).alias("total")).select(*keys, F.to_date("window.start").alias("day"), "n", "total")


def load_available(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Append all rows that have arrived, once each, and stop."""
    stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
