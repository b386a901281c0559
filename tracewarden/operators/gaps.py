"""Time gaps between neighbouring parsed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.config import SEVERITIES, ScanConfig
from tracewarden.functions import scoring
from tracewarden.functions.timestamps import iso_text, lift_year, to_ntz
from tracewarden.operators.blocks import WITHIN_BLOCK, block_of, number_rows
from tracewarden.sources.staging import stage

# Report columns in report order; "source" leads because many sources share one table.
REPORT_COLUMNS = (
    "gap_number",
    "severity",
    "gap_start",
    "gap_end",
    "duration_seconds",
    "duration_human",
    "line_before_gap",
    "line_after_gap",
    "line_number_start",
    "line_number_end",
    "tamper_confidence",
    "fingerprint",
)


def _with_predecessors(rows: DataFrame, window: str) -> DataFrame:
    """Previous parsed line and both effective instants (after the year lift).

    ``window`` is the SQL text of the window's definition.
    """
    before = rows.selectExpr(
        "*",
        f"lag(raw_us, 1) OVER ({window}) AS __p1",
        f"lag(raw_us, 2) OVER ({window}) AS __p2",
        f"lag(is_syslog, 1) OVER ({window}) AS __p1_syslog",
        f"lag(line_number, 1) OVER ({window}) AS previous_line_number",
        *([f"lag(line, 1) OVER ({window}) AS previous_line"] if "line" in rows.columns else []),
    )
    return before.selectExpr(
        "*",
        f"{lift_year('raw_us', 'is_syslog', '__p1')} AS effective_us",
        f"{lift_year('__p1', '__p1_syslog', '__p2')} AS previous_us",
        "effective_us - previous_us AS delta_us",
    ).drop("__p1", "__p2", "__p1_syslog")


def line_steps(parsed: DataFrame, config: ScanConfig, text: bool = False) -> DataFrame:
    """Every parsed line next to its predecessor inside its block.

    ``rank`` counts from the start of the block. ``seam`` marks the first two and last two
    lines of a block: two on each side, because lifting the year of a predecessor needs the
    line before it.
    """
    narrow = parsed.filter("ts_us IS NOT NULL").selectExpr(
        "source",
        f"{block_of('line_number', config.block_lines)} AS block",
        "line_number",
        "ts_us AS raw_us",
        "parser = 'SYSLOG' AS is_syslog",
        *(["line"] if text else []),
    )
    ranked = narrow.selectExpr(
        "*",
        f"row_number() OVER ({WITHIN_BLOCK}) AS rank",
        f"lead(line_number, 2) OVER ({WITHIN_BLOCK}) AS __after",
    )
    steps = _with_predecessors(ranked, WITHIN_BLOCK)
    return steps.withColumn("seam", F.expr("rank <= 2 OR __after IS NULL")).drop("__after")


def _over_threshold(config: ScanConfig) -> str:
    return f"{scoring.seconds_of('delta_us')} > {config.effective_threshold!r}D"


def gap_marks(parsed: DataFrame, config: ScanConfig, text: bool = False) -> DataFrame:
    """Gaps that lie inside a block plus all seam lines: what one ordered pass leaves over.

    This is the only step that moves every parsed line, once, as ~40-byte rows (without
    text). ``all_steps``, ``raw_gaps`` and ``source_spans`` finish from here; stage it when
    more than one of them is wanted.
    """
    steps = line_steps(parsed, config, text)
    return steps.filter(f"seam OR {_over_threshold(config)}")


def _repair_seams(marks: DataFrame) -> DataFrame:
    """Seam lines next to their true predecessors, however many blocks back those are."""
    text = "line" in marks.columns
    kept = ["source", "block", "line_number", "raw_us", "is_syslog", "rank", *(["line"] if text else [])]
    seams = marks.filter("seam").select(*kept)
    return _with_predecessors(seams, "PARTITION BY source ORDER BY line_number")


def all_steps(steps: DataFrame) -> DataFrame:
    """Complete ``line_steps`` (or marks): the first two lines of each block come from the seams."""
    inside = steps.filter(F.col("rank") > 2).drop("seam")
    across = _repair_seams(steps).filter(F.col("rank") <= 2)
    return inside.unionByName(across).drop("rank")


def step_deltas(parsed: DataFrame, config: ScanConfig, text: bool = False) -> DataFrame:
    """Signed microseconds from the previous parsed line, for every line that has one."""
    return all_steps(line_steps(parsed, config, text)).filter(F.col("delta_us").isNotNull())


def source_spans(marks: DataFrame) -> DataFrame:
    """First and last timestamp per source in line order (not in time order)."""
    return _repair_seams(marks).groupBy("source").agg(
        F.min_by("effective_us", "line_number").alias("first_us"),
        F.max_by("effective_us", "line_number").alias("last_us"),
    )


def raw_gaps(marks: DataFrame, config: ScanConfig) -> DataFrame:
    """Steps strictly above the threshold, not yet numbered or scored."""
    wide = all_steps(marks).filter(_over_threshold(config))
    names = {"previous_line": "line_before_gap", "line": "line_after_gap"}
    return wide.select(
        "source",
        "block",
        F.col("previous_line_number").alias("line_number_start"),
        F.col("line_number").alias("line_number_end"),
        F.col("previous_us").alias("start_us"),
        F.col("effective_us").alias("end_us"),
        "delta_us",
        *[F.col(old).alias(new) for old, new in names.items() if old in wide.columns],
    )


def score_gaps(gaps: DataFrame, config: ScanConfig) -> DataFrame:
    """Severity, duration, confidence and fingerprint; row-local, no shuffle."""
    confidence = scoring.tamper_confidence(
        "delta_us", "line_distance", "midpoint_hour", config.effective_threshold, config.context_lines
    )
    return gaps.selectExpr(
        "*",
        f"{scoring.severity('delta_us')} AS severity",
        f"{scoring.whole_seconds('delta_us')} AS duration_seconds",
        f"{scoring.midpoint_hour('start_us', 'delta_us')} AS midpoint_hour",
        "greatest(1L, line_number_end - line_number_start) AS line_distance",
    ).selectExpr(
        "*",
        f"{scoring.human_duration('duration_seconds')} AS duration_human",
        f"{confidence} AS tamper_confidence",
        scoring.fingerprint("start_us", "end_us", "line_number_start", "line_number_end", "duration_seconds")
        + " AS fingerprint",
    )


def detect_gaps(parsed: DataFrame, config: ScanConfig, text: bool = True) -> DataFrame:
    """All gaps, numbered per source in line order before any severity filter.

    The marks are staged first, so the lines are parsed, shuffled and sorted once however
    often the numbering and later results read the gaps. With ``text=False`` only narrow
    rows are shuffled and the edge lines are looked up later (``operators.context``); with
    ``text=True`` the lines travel along.
    """
    marks = stage(gap_marks(parsed, config, text), "marks")
    return number_gaps(raw_gaps(marks, config), config)


def number_gaps(found: DataFrame, config: ScanConfig) -> DataFrame:
    """Number and score what ``raw_gaps`` found."""
    return score_gaps(number_rows(found, "line_number_end", "gap_number"), config)


def with_timestamps(gaps: DataFrame) -> DataFrame:
    """Add ``gap_start``/``gap_end`` as TIMESTAMP_NTZ."""
    return gaps.selectExpr("*", f"{to_ntz('start_us')} AS gap_start", f"{to_ntz('end_us')} AS gap_end")


def with_iso_times(gaps: DataFrame) -> DataFrame:
    """``gap_start``/``gap_end`` as ISO text."""
    plain = gaps.drop("gap_start", "gap_end")
    return plain.selectExpr("*", f"{iso_text('start_us')} AS gap_start", f"{iso_text('end_us')} AS gap_end")


def filter_by_severity(gaps: DataFrame, minimum: str | None) -> DataFrame:
    """Keep gaps of at least this severity; numbers stay as they were."""
    if not minimum:
        return gaps
    return gaps.filter(F.col("severity").isin(*SEVERITIES[SEVERITIES.index(minimum) :]))


def report_rows(gaps: DataFrame) -> DataFrame:
    """Report columns in report order, instants as ISO text."""
    return with_iso_times(gaps).select("source", *REPORT_COLUMNS)
