"""A whole integrity scan: one staged pass over the lines, all results derived from it."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewarden.config import ScanConfig
from tracewarden.operators import bursts, chain, context, fleet, gaps, rollover, signals, stats
from tracewarden.operators.parsing import parse_lines
from tracewarden.sources.staging import stage
from tracewarden.sources.text import file_facts, scan_parsed_text


class ScanResult:
    """Result tables of a scan, keyed by ``source``; each is worked out when first asked for.

    What several results share is staged once: the marks of the one ordered pass, the
    numbered gaps, and the per-source table behind ``stats`` and ``summary``.
    """

    def __init__(
        self,
        parsed: DataFrame,
        config: ScanConfig,
        files: DataFrame | None,
        exact_chain: bool,
        policies: DataFrame | None = None,
    ) -> None:
        self.parsed = parsed
        self.config = config
        self._files = files
        self._exact_chain = exact_chain
        self._policies = policies

    @cached_property
    def _marks(self) -> DataFrame:
        return stage(gaps.gap_marks(self.parsed, self.config), "marks")

    @cached_property
    def all_gaps(self) -> DataFrame:
        """Every gap, scored and judged by the policy of its source, without text."""
        scored = gaps.number_gaps(gaps.raw_gaps(self._marks, self.config), self.config)
        if self._policies is not None:
            scored = signals.apply_policies(scored, self._policies)
        return stage(scored, "gaps")

    @cached_property
    def gaps(self) -> DataFrame:
        """Reported gaps with edge lines and context."""
        reported = gaps.filter_by_severity(self.all_gaps, self.config.min_severity)
        return gaps.with_timestamps(context.with_context(reported, self.parsed, self.config))

    @cached_property
    def bursts(self) -> DataFrame:
        return bursts.numbered_bursts(self.parsed, self.config)

    @cached_property
    def segments(self) -> DataFrame:
        return chain.segment_digests(self.parsed, self.config)

    @cached_property
    def _spans(self) -> DataFrame:
        return gaps.source_spans(self._marks)

    @cached_property
    def _totals(self) -> DataFrame:
        return stats.gap_totals(self.all_gaps, self.config)

    @cached_property
    def _profile(self) -> DataFrame:
        return stats.placement_profile(self.all_gaps, self._spans, self._totals, self.config)

    @cached_property
    def timeline(self) -> DataFrame:
        return stats.timeline_cells(self._profile)

    @cached_property
    def _per_source(self) -> DataFrame:
        digests = None
        if self._exact_chain:
            digests = chain.sequential_chain(self.parsed, self.config, staged=True)
        counts = stats.line_counts(self.parsed)
        errors = bursts.burst_counts(self.parsed, self.config)
        scanned = stats.scan_stats(counts, errors, self._spans, self._totals, digests, self._files)
        return stage(stats.with_verdict(scanned, self._totals, self._profile), "per_source")

    @cached_property
    def stats(self) -> DataFrame:
        return stats.stats_rows(self._per_source)

    @cached_property
    def summary(self) -> DataFrame:
        return stats.summary_rows(self._per_source)

    def fleet(self, group: Column) -> DataFrame:
        """Counters per source, per group of sources and in all; see ``operators.fleet``."""
        return fleet.fleet_rollup(self._per_source, group)


def scan_parsed(
    parsed: DataFrame,
    config: ScanConfig,
    files: DataFrame | None = None,
    exact_chain: bool = True,
    policies: DataFrame | None = None,
) -> ScanResult:
    """Scan parsed lines that are cheap to re-read (staged, or a table of their own).

    ``exact_chain=False`` leaves out the serial per-source chain; the segment digests cover
    the same lines in parallel. ``policies`` (``signals.apply_policies``) decide on severity and
    confidence, and with them on the severity filter, the summary and the risk level.
    """
    return ScanResult(parsed, config, files, exact_chain, policies)


def scan_lines(
    lines: DataFrame,
    config: ScanConfig | None = None,
    exact_chain: bool = True,
    policies: DataFrame | None = None,
) -> ScanResult:
    """Scan a table of ``source, line_number, line``; numbers must be 1, 2, 3, ... within each source."""
    config = config or ScanConfig()
    parsed = stage(parse_lines(lines, config), "parsed")
    require_dense(parsed)
    return scan_parsed(rollover.applied(parsed, config), config, exact_chain=exact_chain, policies=policies)


def require_dense(lines: DataFrame) -> None:
    """Raise unless the line numbers of every source run from 1 without holes or repeats.

    Neighbouring lines are found by their numbers; ``sources.tables`` numbers any ordered table so. Each 64 numbers
    of a source become a bitmap and a count, combined before the shuffle: they agree unless a number is repeated,
    and without repeats as many numbers as the largest one are all numbers up to it.
    """
    bit = F.expr("shiftleft(1L, CAST(pmod(line_number - 1, 64) AS INT))")
    cells = lines.groupBy("source", F.expr("(line_number - 1) div 64").alias("cell")).agg(
        F.min("line_number").alias("low"),
        F.max("line_number").alias("high"),
        F.count(F.lit(1)).alias("n"),
        F.bit_or(bit).alias("bits"),
    )
    numbered = cells.groupBy("source").agg(
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("n").alias("n"),
        F.max(F.coalesce(F.expr("n <> bit_count(bits)"), F.lit(True))).alias("repeats"),
    )
    bad = numbered.filter("low <> 1 OR high <> n OR repeats OR low IS NULL").head()
    if bad:
        raise ValueError(
            f"source {bad['source']}: {bad['n']} lines are numbered {bad['low']} to {bad['high']}, not 1 to {bad['n']} once each"
        )


def scan_files(
    spark: SparkSession,
    paths: str | list[str],
    config: ScanConfig | None = None,
    exact_chain: bool = True,
    policies: DataFrame | None = None,
) -> ScanResult:
    """Scan text logs; every file is one source."""
    config = config or ScanConfig()
    parsed = rollover.applied(scan_parsed_text(spark, paths, config), config)
    return scan_parsed(parsed, config, file_facts(spark, paths), exact_chain, policies)
