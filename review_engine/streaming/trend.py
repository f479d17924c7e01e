"""Label counts per day or week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sentiment_trend(events: DataFrame, event_time: str, label: str, watermark: str, width: str = "1 day") -> DataFrame:
    """Mentions per window and label; works on a stream and on a table alike.

    Weeks (``"7 days"``) start on Thursdays, counted from 1970-01-01. Counts are
    partial in each task before they are shuffled.
    """
    timed = events.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, watermark)
    counted = timed.groupBy(F.window(event_time, width), label).agg(F.count(F.lit(1)).alias("mentions"))
    return counted.select(
        F.date_format("window.start", "yyyy-MM-dd").alias("period_start"), F.col(label).alias("label"), "mentions"
    )
