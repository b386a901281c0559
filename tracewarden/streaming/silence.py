"""Event-time view: stretches of activity between silent periods, in streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def activity_stream(parsed: DataFrame, threshold_seconds: float, watermark: str) -> DataFrame:
    """``source, first_ts, last_ts, line_count`` per stretch without a silence over the threshold.

    A session is final once the watermark passes it; lines later than the watermark are
    dropped. Unlike the line-order gaps this follows time order. Sessions at exactly the
    window gap still merge, as a silence of exactly the threshold should.
    ``operators.activity`` gives the same stretches for tables.
    """
    stamped = parsed.filter(F.col("ts_us").isNotNull()).select(
        "source", F.timestamp_micros("ts_us").alias("at")
    )
    gap_us = int(round(threshold_seconds * 1_000_000))
    window = F.session_window("at", f"{gap_us} microseconds")
    sessions = (
        stamped.withWatermark("at", watermark)
        .groupBy("source", window)
        .agg(
            F.min("at").alias("first_ts"),
            F.max("at").alias("last_ts"),
            F.count(F.lit(1)).alias("line_count"),
        )
    )
    return sessions.select("source", "first_ts", "last_ts", "line_count")
