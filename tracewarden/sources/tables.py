"""Log lines held in tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewarden.operators.blocks import number_rows

NO_ORDER = -(1 << 63)


def lines_from_table(
    rows: DataFrame,
    line: Column | str,
    source: Column | str,
    order_by: str,
    bucket_width: int = 50_000,
) -> DataFrame:
    """``source, line_number, line`` from a table with an integer order column.

    Numbers are dense per source in ``order_by`` order; they are found inside buckets of the
    order column and shifted by the buckets before, so a source may be larger than a task.
    ``bucket_width`` is in units of the order column. Rows that tie in it follow each other by their text, so the
    numbers do not depend on how the table is read; rows without an order come first.
    """
    line = F.col(line) if isinstance(line, str) else line
    source = F.col(source) if isinstance(source, str) else source
    picked = rows.select(
        source.alias("source"),
        F.col(order_by).alias("__order"),
        F.coalesce(F.floor(F.col(order_by) / F.lit(bucket_width)).cast("bigint"), F.lit(NO_ORDER)).alias("block"),
        line.alias("line"),
    )
    return number_rows(picked, ["__order", "line"], "line_number").select("source", "line_number", "line")
