"""Counters over groups of sources: every source, every group and the whole fleet in one table.

The rollup reads the per-source table of a scan, never the lines: grouping sets copy each input row once per
level, which lines could not afford, and a scan's counters are already combined per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewarden.config import SEVERITIES

LEVELS = {0: "source", 1: "group", 3: "fleet"}  # by grouping id
AT_RISK = ("HIGH RISK", "COMPROMISED")
SUMS = (
    "total_lines",
    "parsed_lines",
    "malformed_lines",
    "error_lines",
    "error_bursts",
    "gap_count",
    *[f"{name.lower()}_count" for name in SEVERITIES],
)


def fleet_rollup(per_source: DataFrame, group: Column) -> DataFrame:
    """Rows of the levels source, group and fleet with summed counters.

    ``per_source`` has the statistics and the verdict of each source once. ``group`` is worked out from its
    columns; sources whose group is NULL form a group of their own, told from the fleet's row by ``level``.
    ``worst_source`` has the most reported gaps of its level, the first by name on a tie, and is NULL without gaps;
    ``sources_at_risk`` counts the two highest risk levels. Without sources there is no row.
    """
    rows = per_source.withColumn("source_group", group.cast("string"))
    worst = F.min_by(F.when(F.col("gap_count") > 0, F.col("source")), F.struct(-F.col("gap_count"), F.col("source")))
    level = F.create_map(*[F.lit(part) for pair in LEVELS.items() for part in pair])
    rolled = rows.rollup("source_group", "source").agg(
        F.grouping_id().cast("int").alias("__level"),
        F.count("total_lines").alias("source_count"),
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in SUMS],
        F.coalesce(F.max("highest_confidence"), F.lit(0.0)).alias("highest_confidence"),
        F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"),
        F.count_if(F.col("risk_assessment").isin(*AT_RISK)).alias("sources_at_risk"),
        worst.alias("worst_source"),
    )
    names = [c for c in rolled.columns if c not in ("__level", "source_group", "source")]
    return rolled.select(level[F.col("__level")].alias("level"), "source_group", "source", *names)
