"""Further signs of tampering: backward jumps, repeated stamps, night activity, error rates, changes between runs.

All of them keep to ``(source, block)`` groups or to sums that are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.config import ScanConfig
from tracewarden.operators.activity import activity_periods
from tracewarden.operators.blocks import WITHIN_BLOCK, block_offsets
from tracewarden.operators.gaps import all_steps, line_steps, step_deltas
from tracewarden.sources.staging import stage

DENSITY_BLOCK = 256  # widths of a window in a time block

# Layout of a bracketed level and of name=value fields within a line.
LEVEL = r"\[([A-Za-z]+)\]"
SERVICE = r"\[[A-Za-z]+\] \[([^\]]+)\]"  # the second bracket, behind the level


def backward_jumps(parsed: DataFrame, config: ScanConfig) -> DataFrame:
    """Lines whose instant lies before that of the parsed line above: ``jump_us`` is how far, in microseconds."""
    steps = step_deltas(parsed, config).filter("delta_us < 0")
    return steps.selectExpr(
        "source", "previous_line_number", "line_number", "previous_us", "effective_us", "-delta_us AS jump_us"
    )


def duplicate_stamp_runs(parsed: DataFrame, config: ScanConfig, least: int = 3) -> DataFrame:
    """Runs of at least ``least`` parsed lines in a row that carry the same instant.

    A line that differs from the one above starts a run. Runs are numbered by the starts up to a line,
    counted within blocks and shifted by the starts of earlier blocks, so a run may span blocks.
    """
    steps = stage(all_steps(line_steps(parsed, config)), "steps")
    marked = steps.withColumn("start", F.coalesce(F.col("delta_us") != 0, F.lit(True)).cast("int"))
    within = marked.withColumn("nth", F.expr(f"sum(start) OVER ({WITHIN_BLOCK})"))
    shifts = block_offsets(marked, F.sum("start"), "shift")
    runs = within.join(shifts, ["source", "block"]).groupBy("source", (F.col("nth") + F.col("shift")).alias("run"))
    found = runs.agg(
        F.min("line_number").alias("first_line"),
        F.max("line_number").alias("last_line"),
        F.count(F.lit(1)).alias("line_count"),
        F.min("effective_us").alias("instant_us"),
    )
    return found.filter(F.col("line_count") >= least).drop("run")


def after_hours_activity(parsed: DataFrame, first_hour: int = 2, last_hour: int = 4) -> DataFrame:
    """Parsed lines per source and hour, for the hours of the day from ``first_hour`` to ``last_hour``."""
    hour = F.date_trunc("hour", F.col("ts"))
    night = parsed.filter(F.col("ts_us").isNotNull() & F.hour("ts").between(first_hour, last_hour))
    counted = night.groupBy("source", hour.cast("timestamp_ntz").alias("hour"))
    return counted.agg(F.count(F.lit(1)).alias("line_count"), F.sum(F.col("is_error").cast("bigint")).alias("error_lines"))


def dense_errors(parsed: DataFrame, seconds: int = 60, least: int = 3) -> DataFrame:
    """Stretches of ``seconds`` seconds, counted from the epoch, with at least ``least`` error lines of a source."""
    width = seconds * 1_000_000
    errors = parsed.filter("is_error AND ts_us IS NOT NULL").selectExpr("source", "line_number", f"ts_us div {width} AS slot")
    counted = errors.groupBy("source", "slot").agg(
        F.count(F.lit(1)).alias("error_lines"),
        F.min("line_number").alias("first_line"),
        F.max("line_number").alias("last_line"),
    )
    return counted.filter(F.col("error_lines") >= least).withColumn("start_us", F.col("slot") * width).drop("slot")


def error_density(parsed: DataFrame, seconds: int = 60, least: int = 3) -> DataFrame:
    """Moments up to which a source has had at least ``least`` error lines within ``seconds`` seconds, wherever these begin.

    ``source, end_us, error_lines, first_line, last_line`` of the window that ends at each such moment; its start is exclusive.
    Error lines of one instant are combined before the shuffle. Windows slide within time blocks of ``DENSITY_BLOCK``
    times their width; the last width of a block is repeated in the next one, so no window is cut.
    """
    width = seconds * 1_000_000
    block = width * DENSITY_BLOCK
    moments = (
        parsed.filter("is_error AND ts_us IS NOT NULL")
        .groupBy("source", "ts_us")
        .agg(F.count(F.lit(1)).alias("n"), F.min("line_number").alias("low"), F.max("line_number").alias("high"))
    )
    own = f"CAST(floor(ts_us / {block}D) AS BIGINT)"
    near_end = f"ts_us - {own} * {block} >= {block - width}"
    dealt = moments.selectExpr(
        "*", f"{own} AS own", f"explode(if({near_end}, array({own}, {own} + 1), array({own}))) AS block"
    )
    frame = f"(PARTITION BY source, block ORDER BY ts_us RANGE BETWEEN {width - 1} PRECEDING AND CURRENT ROW)"
    slid = dealt.selectExpr(
        "source",
        "ts_us AS end_us",
        f"sum(n) OVER {frame} AS error_lines",
        f"min(low) OVER {frame} AS first_line",
        f"max(high) OVER {frame} AS last_line",
        "own = block AS kept",
    )
    return slid.filter(f"kept AND error_lines >= {least}").drop("kept")


def dense_stretches(parsed: DataFrame, seconds: int = 60, least: int = 3) -> DataFrame:
    """``source, first_us, last_us, moments``: first and last end of dense windows that overlap one another."""
    ends = error_density(parsed, seconds, least).select("source", F.col("end_us").alias("ts_us"))
    # windows with exclusive starts overlap when their ends are less than a width apart
    return activity_periods(ends, seconds - 1e-6).withColumnRenamed("line_count", "moments")


def breakdown(parsed: DataFrame, field: str = LEVEL, name: str = "level") -> DataFrame:
    """Lines per source and what the first group of the pattern ``field`` finds in them; none: the empty text."""
    found = F.regexp_extract(F.coalesce("line", F.lit("")), field, 1).alias(name)
    return parsed.groupBy("source", found).agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(F.col("is_error").cast("bigint")).alias("error_lines"),
        F.sum(F.col("ts_us").isNull().cast("bigint")).alias("malformed_lines"),
    )


def compare_runs(before: DataFrame, after: DataFrame) -> DataFrame:
    """Gaps of two scans by ``source, fingerprint``: ``new``, ``vanished`` or ``persisting``.

    A gap is the same when its fingerprint is; a scan that lists one twice counts it once.
    """
    old = before.select("source", "fingerprint").distinct().withColumn("old", F.lit(True))
    new = after.select("source", "fingerprint").distinct().withColumn("new", F.lit(True))
    both = old.join(new, ["source", "fingerprint"], "full_outer")
    change = F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "vanished").otherwise("persisting")
    return both.select("source", "fingerprint", change.alias("change"))


def apply_policies(gaps: DataFrame, policies: DataFrame) -> DataFrame:
    """Severity and confidence of scored gaps under the policy of their source.

    ``policies`` holds one row per source: ``source, suspicious_seconds, critical_seconds, weight``. A
    gap is CRITICAL above the one and SUSPICIOUS from the other on; its confidence is multiplied by the
    weight, at most 100. Sources without a policy keep what they have. The join key is spread over
    32 values, so a source with most gaps is no hot key.
    """
    spread = F.pmod(F.hash("fingerprint"), F.lit(32)).alias("__spread")
    copies = policies.withColumn("__spread", F.explode(F.sequence(F.lit(0), F.lit(31))))
    joined = gaps.select("*", spread).join(copies, ["source", "__spread"], "left")
    seconds = F.col("delta_us") / 1e6
    severity = (
        F.when(F.col("critical_seconds").isNull(), F.col("severity"))
        .when(seconds > F.col("critical_seconds"), "CRITICAL")
        .when(seconds >= F.col("suspicious_seconds"), "SUSPICIOUS")
        .otherwise("WARNING")
    )
    confidence = F.least(F.lit(100.0), F.col("tamper_confidence") * F.coalesce("weight", F.lit(1.0)))
    return (
        joined.withColumn("severity", severity)
        .withColumn("tamper_confidence", confidence)
        .drop("__spread", "suspicious_seconds", "critical_seconds", "weight")
    )
