"""Runs of consecutive error lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.config import ScanConfig
from tracewarden.operators.blocks import WITHIN_BLOCK, block_of, number_rows
from tracewarden.sources.staging import stage


def _error_lines(parsed: DataFrame, config: ScanConfig) -> DataFrame:
    """Only error lines are shuffled: line numbers are dense, so a neighbour is number - 1."""
    return parsed.filter("is_error").selectExpr(
        "source", f"{block_of('line_number', config.block_lines)} AS block", "line_number", "ts_us"
    )


def _block_runs(parsed: DataFrame, config: ScanConfig) -> DataFrame:
    """Runs as far as they go inside one block."""
    # line number minus rank is constant along a run of consecutive numbers
    islands = _error_lines(parsed, config).selectExpr(
        "*", f"line_number - row_number() OVER ({WITHIN_BLOCK}) AS __island"
    )
    stamped = F.expr("if(ts_us IS NULL, NULL, line_number)")
    return (
        islands.groupBy("source", "block", "__island")
        .agg(
            F.min("line_number").alias("line_number_start"),
            F.max("line_number").alias("line_number_end"),
            F.min_by("ts_us", stamped).alias("first_us"),
            F.max_by("ts_us", stamped).alias("last_us"),
        )
        .drop("__island")
    )


def error_bursts(parsed: DataFrame, config: ScanConfig) -> DataFrame:
    """One row per maximal run of error lines; a blank or ordinary line ends a run.

    Runs that touch a block edge (at most two per block) are merged across blocks on their
    own small table; all others are final inside their block. The runs are staged, so the
    lines are read once.
    """
    runs = stage(_block_runs(parsed, config), "runs")
    size = config.block_lines
    touches = f"(pmod(line_number_start - 1, {size}) = 0 OR pmod(line_number_end, {size}) = 0)"
    columns = ["source", "line_number_start", "line_number_end", "first_us", "last_us"]
    inner = runs.filter(f"NOT {touches}").select(*columns)

    by_source = "PARTITION BY source ORDER BY line_number_start"
    opened = runs.filter(touches).selectExpr(
        "*",
        f"if(line_number_start = lag(line_number_end) OVER ({by_source}) + 1, 0, 1) AS __opens",
    )
    merged = (
        opened.selectExpr("*", f"sum(__opens) OVER ({by_source} ROWS UNBOUNDED PRECEDING) AS __run")
        .groupBy("source", "__run")
        .agg(
            F.min("line_number_start").alias("line_number_start"),
            F.max("line_number_end").alias("line_number_end"),
            F.expr("min_by(first_us, if(first_us IS NULL, NULL, line_number_start))").alias("first_us"),
            F.expr("max_by(last_us, if(last_us IS NULL, NULL, line_number_start))").alias("last_us"),
        )
        .select(*columns)
    )
    every = inner.unionByName(merged)
    return every.selectExpr("*", "line_number_end - line_number_start + 1 AS line_count")


def numbered_bursts(parsed: DataFrame, config: ScanConfig) -> DataFrame:
    """``error_bursts`` with a dense ``burst_number`` per source in line order."""
    bursts = error_bursts(parsed, config).selectExpr(
        "*", f"{block_of('line_number_start', config.block_lines)} AS block"
    )
    return number_rows(bursts, "line_number_start", "burst_number").drop("block")


def burst_counts(parsed: DataFrame, config: ScanConfig) -> DataFrame:
    """Rising edges per source, from error lines only.

    Inside a block an edge is an error line whose predecessor is not number - 1. The first
    error line of a block counts too, unless it opens the block and the line just before the
    block is an error: those are subtracted from the table of one row per block.
    """
    size = config.block_lines
    edges = _error_lines(parsed, config).selectExpr(
        "source",
        "block",
        "line_number",
        f"if(lag(line_number) OVER ({WITHIN_BLOCK}) = line_number - 1, 0L, 1L) AS __edge",
    )
    per_block = edges.groupBy("source", "block").agg(
        F.sum("__edge").alias("edges"),
        F.expr(f"max(pmod(line_number - 1, {size}) = 0)").alias("opens"),
        F.expr(f"max(pmod(line_number, {size}) = 0)").alias("closes"),
    )
    by_block = "PARTITION BY source ORDER BY block"
    joined = f"opens AND lag(closes) OVER ({by_block}) AND lag(block) OVER ({by_block}) = block - 1"
    return (
        per_block.selectExpr("source", "edges", f"if({joined}, 1L, 0L) AS __joined")
        .groupBy("source")
        .agg(F.expr("sum(edges) - sum(__joined)").alias("error_bursts"))
    )
