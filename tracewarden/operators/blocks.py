"""Ordered work over sources of any size.

``Window.partitionBy("source")`` would put a whole source into one task. Every ordered
operator here works on ``(source, block)`` instead, where a block is a fixed run of line
numbers, and then repairs the seams between blocks on a table that holds a few narrow rows
per block. A source with a third of a trillion lines becomes ~1.7 million groups of 200,000
lines, and its seam table is a few million narrow rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def block_of(line_number: str, block_lines: int) -> str:
    return f"({line_number} - 1) div {block_lines}"


WITHIN_BLOCK = "PARTITION BY source, block ORDER BY line_number"


def block_offsets(rows: DataFrame, count: Column | None = None, name: str = "offset") -> DataFrame:
    """Per (source, block): how much the earlier blocks of that source add up to."""
    total = F.count(F.lit(1)) if count is None else count
    per_block = rows.groupBy("source", "block").agg(total.alias("__n"))
    earlier = (
        Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    return per_block.select(
        "source", "block", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).cast("bigint").alias(name)
    )


def number_rows(rows: DataFrame, order: str | list[str], name: str) -> DataFrame:
    """Dense 1..n per source in ``order``, a column or several; rows must carry ``block``, rising with ``order``.

    Ranks inside each block plus the block's offset: no task sorts more than one block.
    """
    within = Window.partitionBy("source", "block").orderBy(*([order] if isinstance(order, str) else order))
    ranked = rows.withColumn("__rank", F.row_number().over(within))
    numbered = ranked.join(block_offsets(rows, name="__offset"), ["source", "block"])
    return numbered.withColumn(name, (F.col("__offset") + F.col("__rank")).cast("bigint")).drop(
        "__offset", "__rank"
    )


def with_source_facts(rows: DataFrame, facts: DataFrame, spread_on: str, spread: int = 32) -> DataFrame:
    """Left-join one-row-per-source ``facts`` to ``rows`` without one task per source.

    The key is ``(source, spread)``: rows of a hot source go to ``spread`` partitions and each
    facts row is repeated that many times, a factor fixed here and not by the data. Adaptive
    execution still turns this into a broadcast when the measured facts are small enough.
    """
    salted = rows.withColumn("__salt", F.pmod(F.hash(spread_on), F.lit(spread)))
    copies = facts.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return salted.join(copies, ["source", "__salt"], "left").drop("__salt")
