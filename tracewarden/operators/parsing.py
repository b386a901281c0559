"""Lines to parsed lines: timestamp, parser, error flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.config import ScanConfig
from tracewarden.functions.errors import is_error_line
from tracewarden.functions.timestamps import extract_timestamps, to_ntz


def parse_lines(lines: DataFrame, config: ScanConfig) -> DataFrame:
    """The columns of ``lines`` plus ``ts_us, ts, ts_raw, parser, is_error``.

    A pure projection: no shuffle, and columns a consumer does not read are pruned, down to
    the regular expressions behind them.
    """
    stamped = extract_timestamps(lines, config)
    return stamped.select(
        *lines.columns,
        "ts_us",
        F.expr(to_ntz("ts_us")).alias("ts"),
        "ts_raw",
        "parser",
        is_error_line(F.col("line"), config.error_words).alias("is_error"),
    )


def malformed_lines(parsed: DataFrame) -> DataFrame:
    """Lines without a timestamp, blank ones included."""
    return parsed.filter(F.col("ts_us").isNull()).select("source", "line_number", "line")


def parser_profile(parsed: DataFrame) -> DataFrame:
    """Lines per source and parser; malformed lines under ``parser = NULL``."""
    return parsed.groupBy("source", "parser").agg(F.count(F.lit(1)).alias("line_count"))
