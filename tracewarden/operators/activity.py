"""Stretches of activity in time order, for tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewarden.operators.blocks import block_offsets
from tracewarden.sources.staging import stage

BLOCK_BUCKETS = 50_000


def activity_periods(parsed: DataFrame, threshold_seconds: float) -> DataFrame:
    """``source, first_us, last_us, line_count`` per stretch without a silence over the threshold.

    Lines in one time bucket of half the threshold can never be split, so they are combined
    to one row before the shuffle. Buckets are ordered within blocks of ``BLOCK_BUCKETS``; what lies
    before a block and how many stretches begin before it come from one row per block, so not even
    a threshold that gives every line a bucket puts a source into one task.
    """
    threshold_us = int(round(threshold_seconds * 1_000_000))
    width = max(1, threshold_us // 2)
    buckets = (
        parsed.filter(F.col("ts_us").isNotNull())
        .groupBy("source", F.floor(F.col("ts_us") / F.lit(width)).alias("bucket"))
        .agg(
            F.min("ts_us").alias("first_us"),
            F.max("ts_us").alias("last_us"),
            F.count(F.lit(1)).alias("line_count"),
        )
    )
    buckets = stage(buckets.withColumn("block", F.expr(f"floor(bucket / {BLOCK_BUCKETS})")), "buckets")
    ends = buckets.groupBy("source", "block").agg(F.max("last_us").alias("__end"))
    before = F.lag("__end").over(Window.partitionBy("source").orderBy("block"))
    rows = buckets.join(ends.select("source", "block", before.alias("__before")), ["source", "block"])
    inside = Window.partitionBy("source", "block").orderBy("bucket")
    silence = F.col("first_us") - F.coalesce(F.lag("last_us").over(inside), F.col("__before"))
    rows = rows.withColumn("__opens", F.coalesce(silence > threshold_us, F.lit(True)).cast("int"))
    rows = stage(rows.withColumn("__nth", F.sum("__opens").over(inside)), "opened")
    shifts = block_offsets(rows, F.sum("__opens"), "__shift")
    periods = rows.join(shifts, ["source", "block"]).groupBy("source", (F.col("__nth") + F.col("__shift")).alias("__period"))
    return periods.agg(
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
        F.sum("line_count").alias("line_count"),
    ).drop("__period")
