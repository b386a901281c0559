"""Per-source counters, gap totals, placement score, timeline and the summary row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.config import SEVERITIES, ScanConfig
from tracewarden.functions import scoring
from tracewarden.operators.blocks import with_source_facts
from tracewarden.operators.chain import START
from tracewarden.operators.gaps import filter_by_severity, with_iso_times


def line_counts(parsed: DataFrame) -> DataFrame:
    """Map-side combined counters; the shuffle carries one row per source and task."""
    stamped = F.col("ts_us").isNotNull()
    return parsed.groupBy("source").agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(stamped).alias("parsed_lines"),
        F.count_if(~stamped).alias("malformed_lines"),
        F.count_if(F.col("is_error")).alias("error_lines"),
    )


def most_critical(gaps: DataFrame) -> DataFrame:
    """Per source the gap with the highest (severity, duration, confidence); the earliest on a tie."""
    rank = f"struct({scoring.severity_rank('severity')}, duration_seconds, tamper_confidence, -gap_number)"
    fields = (
        "gap_number, severity, gap_start, gap_end, duration_seconds, duration_human, fingerprint, "
        "tamper_confidence"
    )
    top = F.expr(f"max_by(struct({fields}), {rank})").alias("most_critical_gap")
    return with_iso_times(gaps).groupBy("source").agg(top)


def gap_totals(gaps: DataFrame, config: ScanConfig) -> DataFrame:
    """Counts per severity, highest confidence and the top gap of the reported gaps.

    ``gap_count_all`` counts every gap, reported or not.
    """
    kept = ", ".join(repr(name) for name in SEVERITIES[SEVERITIES.index(config.min_severity) :])
    reported = f"severity IN ({kept})"
    every = gaps.groupBy("source").agg(
        F.count(F.lit(1)).alias("gap_count_all"),
        F.expr(f"count_if({reported})").alias("gap_count"),
        *[
            F.expr(f"count_if({reported} AND severity = '{name}')").alias(f"{name.lower()}_count")
            for name in SEVERITIES
        ],
        F.expr(f"max(if({reported}, tamper_confidence, NULL))").alias("highest_confidence"),
    )
    # the struct maximum is not a fixed-width buffer, so it gets its own aggregate
    top = most_critical(filter_by_severity(gaps, config.min_severity))
    return every.join(top, "source", "left")


def placement_profile(gaps: DataFrame, spans: DataFrame, totals: DataFrame, config: ScanConfig) -> DataFrame:
    """How many reported gaps share a histogram bin and a stretch of the timeline.

    One skew-safe join gives each gap its source's span; what leaves the map-side combine is
    bounded per source by the bins and cells, not by the gaps.
    """
    facts = spans.join(totals.select("source", "gap_count"), "source").selectExpr(
        "source", "first_us", "last_us - first_us AS span_us", "gap_count"
    )
    reported = filter_by_severity(gaps, config.min_severity).select(
        "source", "line_number_end", "start_us", "end_us", "severity"
    )
    placed = with_source_facts(reported, facts.filter("span_us > 0"), "line_number_end")
    begin, end = "start_us - first_us", "end_us - first_us"
    return (
        placed.filter("span_us IS NOT NULL")
        .selectExpr(
            "source",
            f"{scoring.placement_bins('gap_count')} AS bins",
            f"{scoring.placement_bin(f'({begin})', 'span_us', 'bins')} AS bin",
            f"{scoring.timeline_cell(f'({begin})', 'span_us')} AS first_cell",
            f"greatest(first_cell, {scoring.timeline_cell(f'({end})', 'span_us')}) AS last_cell",
            f"if(severity = '{SEVERITIES[0]}', 1, 2) AS level",
        )
        .groupBy("source", "bins", "bin", "first_cell", "last_cell", "level")
        .agg(F.count(F.lit(1)).alias("gap_count"))
    )


def placement_bins(profile: DataFrame) -> DataFrame:
    return profile.groupBy("source", "bins", "bin").agg(F.sum("gap_count").alias("gap_count"))


def placement_scores(profile: DataFrame) -> DataFrame:
    """Clustered gaps score high, evenly spread ones low; 0 below two gaps."""
    histogram = placement_bins(profile)
    totals = profile.groupBy("source").agg(F.sum("gap_count").alias("__total"))
    scored = (
        histogram.join(totals, "source")
        .selectExpr("*", f"{scoring.divergence_term('(gap_count / __total)', 'bins')} AS __term")
        .groupBy("source", "bins")
        .agg(
            F.sum("__term").alias("__divergence"),
            F.count(F.lit(1)).alias("__occupied"),
            F.first("__total").alias("__total"),
        )
    )
    score = scoring.placement_score("__divergence", "__occupied", "bins")
    return scored.selectExpr("source", f"if(__total >= 2, {score}, 0D) AS entropy_score")


def timeline_cells(profile: DataFrame) -> DataFrame:
    """Painted cells ``source, cell, level`` (1 for WARNING, 2 above); the higher level wins."""
    stretches = profile.select("source", "first_cell", "last_cell", "level").distinct()
    cells = stretches.withColumn("cell", F.explode(F.sequence("first_cell", "last_cell")))
    return cells.groupBy("source", "cell").agg(F.max("level").alias("level"))


def timelines(profile: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """``source, timeline``: one character per cell, '#' where a gap lies.

    Only sources with a gap that has a place are in the profile; with ``sources`` (``source``, one row each) all of these
    have a row, dots alone where nothing is painted.
    """
    painted = timeline_cells(profile).groupBy("source").agg(F.collect_list("cell").alias("__cells"))
    marks = f"transform(sequence(0, {scoring.TIMELINE_WIDTH - 1}), i -> if(array_contains(__cells, i), '#', '.'))"
    drawn = painted.selectExpr("source", f"array_join({marks}, '') AS timeline")
    if sources is None:
        return drawn
    return sources.select("source").join(drawn, "source", "left").na.fill("." * scoring.TIMELINE_WIDTH, ["timeline"])


def scan_stats(
    counts: DataFrame,
    bursts: DataFrame,
    spans: DataFrame,
    totals: DataFrame,
    chain: DataFrame | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """One row per source; with ``files`` also for files that hold no line at all."""
    out = counts
    if files is not None:
        out = files.select("source", "file_name", "file_size").join(counts, "source", "left")
    out = out.join(bursts, "source", "left").join(spans, "source", "left")
    out = out.join(totals.select("source", "gap_count_all"), "source", "left")
    if chain is not None:
        out = out.join(chain, "source", "left")
    columns = ["source"]
    if files is not None:
        columns += ["file_name", "file_size"]
    numbers = ["total_lines", "parsed_lines", "malformed_lines", "error_lines", "error_bursts"]
    return out.selectExpr(
        *columns,
        *[f"coalesce({n}, 0L) AS {n}" for n in numbers],
        "first_us",
        "last_us",
        "coalesce(gap_count_all, 0L) AS gaps_detected",
        *([f"coalesce(final_hash, '{START}') AS final_hash"] if chain is not None else []),
    )


def with_verdict(stats: DataFrame, totals: DataFrame, profile: DataFrame) -> DataFrame:
    """Add gap totals, score, timeline and risk of the reported gaps to the line statistics."""
    rows = (
        stats.join(totals.drop("gap_count_all"), "source", "left")
        .join(placement_scores(profile), "source", "left")
        .join(timelines(profile), "source", "left")
    )
    counts = [f"{name.lower()}_count" for name in SEVERITIES]
    filled = rows.na.fill(0, ["gap_count", *counts]).na.fill(0.0, ["highest_confidence", "entropy_score"])
    filled = filled.na.fill("." * scoring.TIMELINE_WIDTH, ["timeline"])
    risk = scoring.risk_level(*counts, "entropy_score", "highest_confidence", "error_bursts")
    return filled.selectExpr(
        "*", f"{risk} AS risk_assessment", f"{scoring.status_code(*counts)} AS status_code"
    )


def stats_rows(per_source: DataFrame) -> DataFrame:
    names = ["source", "file_name", "file_size", "total_lines", "parsed_lines", "malformed_lines"]
    names += ["error_lines", "error_bursts", "first_us", "last_us", "gaps_detected", "final_hash"]
    return per_source.select(*[name for name in names if name in per_source.columns])


def summary_rows(per_source: DataFrame) -> DataFrame:
    """One summary row per source: reported gaps against unfiltered line statistics."""
    breakdown = ", ".join(f"'{name}', {name.lower()}_count" for name in SEVERITIES)
    return per_source.selectExpr(
        "source",
        "total_lines AS total_lines_scanned",
        "parsed_lines",
        "malformed_lines",
        "error_lines",
        "error_bursts",
        "gaps_detected AS gap_count_all",
        "gap_count AS total_gaps_found",
        f"named_struct({breakdown}) AS severity_breakdown",
        "most_critical_gap",
        "highest_confidence",
        "risk_assessment",
        "entropy_score",
        "timeline",
        *(["struct(final_hash) AS integrity_chain"] if "final_hash" in per_source.columns else []),
        "status_code",
    )


def scorecard(summary: DataFrame) -> DataFrame:
    """The four headline numbers per source."""
    return summary.select(
        "source",
        "parsed_lines",
        F.col("total_gaps_found").alias("time_gaps"),
        "error_bursts",
        F.col("risk_assessment").alias("risk_level"),
    )
