"""Year-less stamps that stay in the next year after a New Year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.config import ScanConfig
from tracewarden.functions.timestamps import DAY_US, to_ntz
from tracewarden.operators.blocks import WITHIN_BLOCK, block_offsets
from tracewarden.operators.gaps import all_steps, line_steps
from tracewarden.sources.staging import stage

# a parser name that no later step lifts again
LIFTED = "SYSLOG+"


def year_lifts(parsed: DataFrame, config: ScanConfig) -> DataFrame:
    """``source, line_number, years`` of the year-less lines after at least one New Year of their source.

    A New Year is a January line below a December one, whatever the layout of the latter; those are the lines that the
    default rule lifts. They are counted within blocks and shifted by the blocks before, so that a source of
    any size has its running count without one task reading it.
    """
    steps = stage(all_steps(line_steps(parsed, config)), "steps")
    marked = steps.withColumn("passes", F.expr("CAST(effective_us <> raw_us AS BIGINT)"))
    within = marked.withColumn("inside", F.expr(f"sum(passes) OVER ({WITHIN_BLOCK})"))
    counted = within.join(block_offsets(marked, F.sum("passes"), "before"), ["source", "block"])
    years = counted.select("source", "line_number", "is_syslog", (F.col("inside") + F.col("before")).cast("int").alias("years"))
    return years.filter("is_syslog AND years > 0").drop("is_syslog")


def sticky_years(parsed: DataFrame, config: ScanConfig) -> DataFrame:
    """``parsed`` with year-less stamps moved on by the New Years before them; 29 February becomes the 28th in other years."""
    lifts = year_lifts(parsed, config)
    moved = (
        f"unix_date(add_months(CAST({to_ntz('ts_us')} AS DATE), 12 * years)) * {DAY_US} + pmod(ts_us, {DAY_US})"
    )
    joined = parsed.join(lifts, ["source", "line_number"], "left")
    lifted = joined.withColumn("ts_us", F.expr(f"if(years IS NULL, ts_us, {moved})"))
    lifted = lifted.withColumn("parser", F.expr(f"if(years IS NULL, parser, '{LIFTED}')"))
    if "ts" in parsed.columns:
        lifted = lifted.withColumn("ts", F.expr(to_ntz("ts_us")))
    return lifted.select(*parsed.columns)


def applied(parsed: DataFrame, config: ScanConfig) -> DataFrame:
    """``parsed`` under the rule of the configuration; staged if it changes."""
    return stage(sticky_years(parsed, config), "lifted") if config.rollover == "sticky" else parsed
