"""Registered queries and their SQL twins.

Each query runs over all rows of its table. Instants leave as ISO text and numbers as BIGINT
or DOUBLE, so that both engines' results compare value by value.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tracewarden.config import ScanConfig
from tracewarden.functions import scoring
from tracewarden.functions.timestamps import iso_text
from tracewarden.operators import activity, bursts, chain, context, gaps, rollover, signals, stats
from tracewarden.operators.parsing import malformed_lines, parse_lines, parser_profile
from tracewarden.plans import progress, reports
from tracewarden.plans.report_store import ReportStore
from tracewarden.plans.scan import scan_files, scan_lines
from tracewarden.queries import inputs, oracle
from tracewarden.queries.inputs import CONFIG
from tracewarden.sources.staging import new_folder, stage
from tracewarden.sources.text import BYTE_ORDER_MARK, file_facts, scan_text
from tracewarden.streaming import carry, monitor, silence
from tracewarden.streaming.files import watch_folder
from tracewarden.streaming.metrics import StreamMetrics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, *parts: str, select: str) -> Callable[[Query], Query]:
    """Register a query with its SQL twin (``WITH parts select``)."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        ORACLE[name] = oracle.query(*parts, select=select)
        return function

    return add


def services(spark: SparkSession, folder: str, config: ScanConfig = CONFIG) -> DataFrame:
    return parse_lines(inputs.service_lines(spark, folder), config)


def single(spark: SparkSession, folder: str, config: ScanConfig = CONFIG) -> DataFrame:
    return parse_lines(inputs.single_source_lines(spark, folder), config)


def instant(column: str, name: str) -> Column:
    return F.expr(iso_text(column)).alias(name)


# What each statement builds on, in order.
LINES = (oracle.SERVICE_LINES, oracle.PARSED)
STEPS = (*LINES, oracle.STEPS)
GAPS = (*STEPS, oracle.GAPS)
SOURCES = (*GAPS, oracle.BURSTS, oracle.COUNTS, oracle.TOTALS)
PLACED = (*SOURCES, oracle.PLACEMENT)

# --- sources -------------------------------------------------------------------------------


@register(
    "text_log_lines",
    f"""
files AS (SELECT event_id // {inputs.FILE_EVENTS} AS part, event_id, {oracle.EVENT_LINE} AS line FROM events)""",
    select="SELECT 'part-' || part AS source, "
    "row_number() OVER (PARTITION BY part ORDER BY event_id) AS line_number, line FROM files",
)
def text_log_lines(spark, folder):
    """Text files written from the events, read back in splits and numbered."""
    path = inputs.event_files(spark, folder, new_folder(spark, "event_files"))
    lines = scan_text(spark, f"{path}/part=*")
    part = F.concat(F.lit("part-"), F.regexp_extract("source", "part=([0-9]+)", 1))
    return lines.select(part.alias("source"), "line_number", "line")


@register(
    "text_file_facts",
    f"""
files AS (SELECT event_id // {inputs.FILE_EVENTS} AS part, {oracle.EVENT_LINE} AS line FROM events)""",
    select="SELECT 'part-' || part AS source, CAST(sum(octet_length(encode(line)) + 1) AS BIGINT) AS file_size "
    "FROM files GROUP BY part",
)
def text_file_facts(spark, folder):
    """Byte size per file, from file listings only."""
    path = inputs.event_files(spark, folder, new_folder(spark, "event_files"))
    part = F.concat(F.lit("part-"), F.regexp_extract("source", "part=([0-9]+)", 1))
    return file_facts(spark, f"{path}/part=*").select(part.alias("source"), "file_size")


@register(
    "service_log_lines", oracle.SERVICE_LINES, select="SELECT source, line_number, line FROM lines"
)
def service_log_lines(spark, folder):
    return inputs.service_lines(spark, folder)


@register(
    "document_lines",
    """
lines AS (
  SELECT source || '/' || lang AS source, doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS spot FROM documents),
numbered AS (
  SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id, spot) AS line_number, line FROM lines)""",
    select="SELECT source, count(*) AS total_lines, CAST(sum(length(line)) AS BIGINT) AS characters, "
    "max(line_number) AS last_line, "
    "CAST(sum(line_number * length(line)) AS BIGINT) AS weighted FROM numbered GROUP BY source",
)
def document_lines(spark, folder):
    """Whole documents as logs without stamps: dense numbers over an uneven line count per row."""
    from tracewarden.operators.blocks import number_rows

    docs = inputs.table(spark, folder, "documents")
    source = F.concat("source", F.lit("/"), "lang").alias("source")
    lines = docs.select(source, "doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    keyed = lines.withColumn("block", F.floor(F.col("doc_id") / 1000).cast("bigint"))
    numbered = number_rows(keyed.withColumn("order", F.struct("doc_id", "at")), "order", "line_number")
    size = F.length("line").cast("bigint")
    return numbered.groupBy("source").agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.sum(size).alias("characters"),
        F.max("line_number").alias("last_line"),
        F.sum(F.col("line_number") * size).alias("weighted"),
    )


# --- timestamps ----------------------------------------------------------------------------


@register(
    "parsed_timestamps",
    *LINES,
    select=f"SELECT source, line_number, {oracle.iso('ts')} AS ts, ts_raw, parser FROM parsed",
)
def parsed_timestamps(spark, folder):
    return services(spark, folder).select("source", "line_number", instant("ts_us", "ts"), "ts_raw", "parser")


@register(
    "custom_format_timestamps",
    select="SELECT CAST(event_id + 1 AS BIGINT) AS line_number, "
    f"{oracle.iso('ts')} AS ts, strftime(ts, '%d.%m.%Y %H:%M:%S,%f') AS ts_raw, 'CUSTOM' AS parser FROM events",
)
def custom_format_timestamps(spark, folder):
    config = replace(CONFIG, custom_format="%d.%m.%Y %H:%M:%S,%f")
    parsed = parse_lines(inputs.custom_lines(spark, folder), config)
    return parsed.select("line_number", instant("ts_us", "ts"), "ts_raw", "parser")


ORACLE["custom_format_timestamps"] = ORACLE["custom_format_timestamps"].removeprefix("WITH \n")


@register(
    "syslog_year_rollover",
    oracle.ORDER_LINES,
    oracle.PARSED,
    oracle.STEPS,
    select=f"SELECT source, line_number, {oracle.iso('ts')} AS ts, delta_us FROM steps WHERE delta_us IS NOT NULL",
)
def syslog_year_rollover(spark, folder):
    """Year-less stamps: the lift of a January line after a December one, and its deltas."""
    parsed = parse_lines(inputs.order_lines(spark, folder), CONFIG)
    steps = gaps.step_deltas(parsed, CONFIG)
    return steps.select("source", "line_number", instant("effective_us", "ts"), "delta_us")


@register(
    "sticky_year_rollover",
    oracle.ORDER_LINES,
    oracle.PARSED,
    """
stepped AS (
  SELECT *, lag(ts) OVER (PARTITION BY source ORDER BY line_number) AS p1 FROM parsed WHERE ts IS NOT NULL),
counted AS (
  SELECT *, sum(CASE WHEN parser = 'SYSLOG' AND ts < p1 AND month(p1) = 12 AND month(ts) = 1 THEN 1 ELSE 0 END)
              OVER (PARTITION BY source ORDER BY line_number) AS years FROM stepped),
moved AS (SELECT source, line_number, ts + to_years(CAST(years AS INTEGER)) AS ts FROM counted),
steps AS (
  SELECT source, line_number, ts, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY source ORDER BY line_number)) AS delta_us
  FROM moved)""",
    select=f"SELECT source, line_number, {oracle.iso('ts')} AS ts, delta_us FROM steps WHERE delta_us IS NOT NULL",
)
def sticky_year_rollover(spark, folder):
    """Year-less stamps that stay in the new year; several New Years per source, over many blocks."""
    config = replace(CONFIG, rollover="sticky", block_lines=500)
    parsed = rollover.applied(parse_lines(inputs.order_lines(spark, folder), config), config)
    steps = gaps.step_deltas(parsed, config)
    return steps.select("source", "line_number", instant("effective_us", "ts"), "delta_us")


@register(
    "malformed_lines", *LINES, select="SELECT source, line_number, line FROM parsed WHERE ts IS NULL"
)
def malformed(spark, folder):
    return malformed_lines(services(spark, folder))


@register(
    "parser_profile",
    *LINES,
    select="SELECT source, parser, count(*) AS line_count FROM parsed GROUP BY source, parser",
)
def profile_of_parsers(spark, folder):
    return parser_profile(services(spark, folder))


# --- errors --------------------------------------------------------------------------------


@register(
    "error_lines", *LINES, select="SELECT source, line_number, line FROM parsed WHERE is_error"
)
def error_lines(spark, folder):
    return services(spark, folder).filter("is_error").select("source", "line_number", "line")


@register(
    "error_burst_counts",
    *LINES,
    oracle.BURSTS,
    select="SELECT source, count(*) AS error_bursts FROM bursts GROUP BY source",
)
def error_burst_counts(spark, folder):
    return bursts.burst_counts(services(spark, folder), CONFIG)


BURST_SELECT = (
    "SELECT source, burst_number, line_number_start, line_number_end, line_count, "
    f"{oracle.iso('first_ts')} AS first_ts, {oracle.iso('last_ts')} AS last_ts FROM bursts"
)


def _burst_rows(parsed: DataFrame, config: ScanConfig) -> DataFrame:
    return bursts.numbered_bursts(parsed, config).select(
        "source",
        "burst_number",
        "line_number_start",
        "line_number_end",
        "line_count",
        instant("first_us", "first_ts"),
        instant("last_us", "last_ts"),
    )


@register("error_bursts", *LINES, oracle.BURSTS, select=BURST_SELECT)
def error_bursts(spark, folder):
    return _burst_rows(services(spark, folder), CONFIG)


@register("error_bursts_small_blocks", *LINES, oracle.BURSTS, select=BURST_SELECT)
def error_bursts_small_blocks(spark, folder):
    """Same result with blocks small enough that runs cross their seams."""
    config = replace(CONFIG, block_lines=200)
    return _burst_rows(services(spark, folder, config), config)


# --- gaps ----------------------------------------------------------------------------------


@register(
    "step_deltas",
    *STEPS,
    select="SELECT source, line_number, prev_number AS previous_line_number, delta_us FROM steps "
    "WHERE prev_ts IS NOT NULL",
)
def step_deltas(spark, folder):
    steps = gaps.step_deltas(services(spark, folder), CONFIG)
    return steps.select("source", "line_number", "previous_line_number", "delta_us")


@register("gap_report", *GAPS, select=f"SELECT {oracle.REPORT} FROM gaps")
def gap_report(spark, folder):
    """Gaps found without text; edge lines are looked up for the gaps alone."""
    return gaps.report_rows(scan_lines(inputs.service_lines(spark, folder), CONFIG, exact_chain=False).gaps)


@register("gap_report_small_blocks", *GAPS, select=f"SELECT {oracle.REPORT} FROM gaps")
def gap_report_small_blocks(spark, folder):
    config = replace(CONFIG, block_lines=200)
    return gaps.report_rows(gaps.detect_gaps(services(spark, folder, config), config))


@register(
    "gap_report_one_source",
    oracle.SINGLE_LINES,
    oracle.PARSED,
    oracle.STEPS,
    oracle.GAPS,
    select=f"SELECT {oracle.REPORT} FROM gaps",
)
def gap_report_one_source(spark, folder):
    """All events as one source, spread over blocks."""
    config = replace(CONFIG, block_lines=2_000)
    return gaps.report_rows(scan_lines(inputs.single_source_lines(spark, folder), config, exact_chain=False).gaps)


@register(
    "gap_scores",
    *GAPS,
    select="SELECT source, gap_number, severity, CAST(line_distance AS BIGINT) AS line_distance, "
    "CAST(mid_hour AS INTEGER) AS midpoint_hour, tamper_confidence FROM gaps",
)
def gap_scores(spark, folder):
    found = gaps.detect_gaps(services(spark, folder), CONFIG, text=False)
    return found.select(
        "source",
        "gap_number",
        "severity",
        F.col("line_distance").cast("bigint").alias("line_distance"),
        "midpoint_hour",
        "tamper_confidence",
    )


@register(
    "suspicious_gaps",
    *GAPS,
    select="SELECT source, gap_number, severity, duration_human, fingerprint FROM gaps WHERE severity_rank >= 2",
)
def suspicious_gaps(spark, folder):
    found = gaps.detect_gaps(services(spark, folder), CONFIG, text=False)
    kept = gaps.filter_by_severity(found, "SUSPICIOUS")
    return kept.select("source", "gap_number", "severity", "duration_human", "fingerprint")


@register(
    "gap_edge_lines_shortened",
    *GAPS,
    select="SELECT source, gap_number, "
    "CASE WHEN length(line_before_gap) <= 40 THEN line_before_gap ELSE line_before_gap[1:37] || '...' END AS before, "
    "CASE WHEN length(line_after_gap) <= 40 THEN line_after_gap ELSE line_after_gap[1:37] || '...' END AS after "
    "FROM gaps",
)
def gap_edge_lines_shortened(spark, folder):
    found = gaps.detect_gaps(services(spark, folder), CONFIG)
    return found.select(
        "source",
        "gap_number",
        F.expr(scoring.truncate_text("line_before_gap", 40)).alias("before"),
        F.expr(scoring.truncate_text("line_after_gap", 40)).alias("after"),
    )


# --- context -------------------------------------------------------------------------------


@register(
    "gap_context_lines",
    *GAPS,
    select="SELECT g.source, g.gap_number, CASE WHEN l.line_number < g.line_number_end THEN 'before' "
    "ELSE 'after' END AS side, l.line_number, l.line FROM gaps g JOIN lines l ON l.source = g.source "
    "AND l.line_number BETWEEN g.line_number_end - 2 AND g.line_number_end + 1",
)
def gap_context_lines(spark, folder):
    result = scan_lines(inputs.service_lines(spark, folder), CONFIG, exact_chain=False)
    return context.context_lines(result.all_gaps, result.parsed, CONFIG)


CONTEXT = """
around AS (
  SELECT g.source, g.gap_number, g.line_before_gap, g.line_after_gap, g.line_number_end AS e, l.line_number AS n, l.line
  FROM gaps g JOIN lines l ON l.source = g.source
   AND l.line_number BETWEEN g.line_number_end - 2 AND g.line_number_end + 1)"""
CONTEXT_SELECT = (
    "SELECT source, gap_number, line_before_gap, line_after_gap, "
    "coalesce(string_agg(n || ':' || line, '|' ORDER BY n) FILTER (n < e), '') AS before, "
    "coalesce(string_agg(n || ':' || line, '|' ORDER BY n) FILTER (n >= e), '') AS after "
    "FROM around GROUP BY ALL"
)


def _context_texts(rich: DataFrame) -> DataFrame:
    def joined(side: str) -> Column:
        texts = F.transform(F.col(f"raw_context.{side}"), lambda x: F.concat_ws(":", x.line_number, x.line))
        return F.array_join(texts, "|").alias(side)

    return rich.select(
        "source", "gap_number", "line_before_gap", "line_after_gap", joined("before"), joined("after")
    )


@register("gap_context_arrays", *GAPS, CONTEXT, select=CONTEXT_SELECT)
def gap_context_arrays(spark, folder):
    return _context_texts(scan_lines(inputs.service_lines(spark, folder), CONFIG, exact_chain=False).gaps)


# --- chain ---------------------------------------------------------------------------------


@register("hash_chain", *LINES, oracle.CHAIN, select="SELECT source, final_hash FROM chains")
def hash_chain(spark, folder):
    return chain.sequential_chain(services(spark, folder), CONFIG)


SEGMENT = 500


@register(
    "segment_digests",
    *LINES,
    oracle.segments(SEGMENT),
    select="SELECT source, segment, digest FROM segments",
)
def segment_digests(spark, folder):
    return chain.segment_digests(services(spark, folder), replace(CONFIG, segment_lines=SEGMENT))


@register(
    "segmented_chain",
    *LINES,
    oracle.segments(SEGMENT),
    select=f"SELECT source, count(*) AS segment_count, {oracle.fold('digest', 'segment')} AS segmented_hash "
    "FROM segments GROUP BY source",
)
def segmented_chain(spark, folder):
    config = replace(CONFIG, segment_lines=SEGMENT)
    return chain.segmented_chain(chain.segment_digests(services(spark, folder), config))


@register(
    "chain_verification",
    *LINES,
    oracle.segments(SEGMENT),
    "touched AS (SELECT source, line_number, ts, "
    "CASE WHEN line_number % 1777 = 5 THEN line || '!' ELSE line END AS line FROM parsed)",
    oracle.segments(SEGMENT, "touched", "rescanned"),
    select="SELECT source, min(a.segment) AS first_changed_segment, count(*) AS changed_segments "
    "FROM segments a JOIN rescanned b USING (source, segment) WHERE a.digest <> b.digest GROUP BY source",
)
def chain_verification(spark, folder):
    """Stored digests against a rescan of lines of which some were altered."""
    config = replace(CONFIG, segment_lines=SEGMENT)
    parsed = services(spark, folder)
    line = F.col("line")
    touched = F.when(F.col("line_number") % 1777 == 5, F.concat(line, F.lit("!"))).otherwise(line)
    stored = chain.segment_digests(parsed, config)
    rescanned = chain.segment_digests(parsed.withColumn("line", touched), config)
    return chain.first_difference(chain.compare_digests(stored, rescanned))


# --- per-source results --------------------------------------------------------------------


@register(
    "scan_stats",
    *SOURCES,
    oracle.CHAIN,
    select="SELECT c.source, total_lines, parsed_lines, malformed_lines, error_lines, error_bursts, "
    f"{oracle.iso('first_ts')} AS first_timestamp, {oracle.iso('last_ts')} AS last_timestamp, "
    "gap_count AS gaps_detected, final_hash FROM counts c JOIN spans USING (source) JOIN totals USING (source) "
    "JOIN chains USING (source)",
)
def scan_stats(spark, folder):
    result = scan_lines(inputs.service_lines(spark, folder), CONFIG)
    return result.stats.select(
        "source",
        "total_lines",
        "parsed_lines",
        "malformed_lines",
        "error_lines",
        "error_bursts",
        instant("first_us", "first_timestamp"),
        instant("last_us", "last_timestamp"),
        "gaps_detected",
        "final_hash",
    )


FLEET_SUMS = "total_lines parsed_lines malformed_lines error_lines error_bursts gap_count".split()
FLEET_SUMS += "warning_count suspicious_count critical_count".split()


@register(
    "fleet_rollup",
    *PLACED,
    oracle.RISK,
    """
sources AS (
  SELECT 'pair-' || (CAST(substr(c.source, 5) AS BIGINT) // 2) AS source_group, c.source, c.total_lines, c.parsed_lines,
         c.malformed_lines, c.error_lines, c.error_bursts, r.gap_count, r.warning_count, r.suspicious_count,
         r.critical_count, t.highest_confidence, s.first_ts, s.last_ts, r.risk_assessment
  FROM counts c JOIN risks r USING (source) JOIN totals t USING (source) LEFT JOIN spans s USING (source))""",
    select="SELECT CASE grouping(source_group, source) WHEN 0 THEN 'source' WHEN 1 THEN 'group' ELSE 'fleet' END AS level, "
    "source_group, source, count(total_lines) AS source_count, "
    + ", ".join(f"CAST(sum({name}) AS BIGINT) AS {name}" for name in FLEET_SUMS)
    + f", max(highest_confidence) AS highest_confidence, {oracle.iso('min(first_ts)')} AS first_timestamp, "
    f"{oracle.iso('max(last_ts)')} AS last_timestamp, "
    "count(*) FILTER (risk_assessment IN ('HIGH RISK', 'COMPROMISED')) AS sources_at_risk, "
    "first(source ORDER BY gap_count DESC, source) FILTER (gap_count > 0) AS worst_source "
    "FROM sources GROUP BY ROLLUP (source_group, source)",
)
def fleet_rollup(spark, folder):
    """Eight services in pairs: counters per service, per pair and in all."""
    result = scan_lines(inputs.service_lines(spark, folder), CONFIG, exact_chain=False)
    pair = F.concat(F.lit("pair-"), F.floor(F.substr("source", F.lit(5)).cast("bigint") / 2).cast("bigint"))
    ends = instant("first_us", "first_timestamp"), instant("last_us", "last_timestamp")
    return result.fleet(pair).select("*", *ends).drop("first_us", "last_us")


@register(
    "severity_breakdown",
    *SOURCES,
    select="SELECT source, gap_count, warning_count, suspicious_count, critical_count, highest_confidence "
    "FROM totals WHERE gap_count > 0",
)
def severity_breakdown(spark, folder):
    found = gaps.detect_gaps(services(spark, folder), CONFIG, text=False)
    totals = stats.gap_totals(found, CONFIG)
    return totals.drop("gap_count_all", "most_critical_gap")


@register(
    "most_critical_gaps",
    *GAPS,
    oracle.TOP,
    select="SELECT source, gap_number, severity, gap_start, gap_end, duration_seconds, duration_human, "
    "fingerprint, tamper_confidence FROM top",
)
def most_critical_gaps(spark, folder):
    found = gaps.detect_gaps(services(spark, folder), CONFIG, text=False)
    return stats.most_critical(found).select("source", "most_critical_gap.*")


def _profile(spark, folder) -> DataFrame:
    return _profile_of(services(spark, folder))


def _profile_of(parsed: DataFrame) -> DataFrame:
    marks = stage(gaps.gap_marks(parsed, CONFIG), "marks")
    found = stage(gaps.number_gaps(gaps.raw_gaps(marks, CONFIG), CONFIG), "gaps")
    return stats.placement_profile(found, gaps.source_spans(marks), stats.gap_totals(found, CONFIG), CONFIG)


@register("placement_bins", *PLACED, select="SELECT source, bins, bin, gap_count FROM histogram")
def placement_bins(spark, folder):
    return stats.placement_bins(_profile(spark, folder))


@register("placement_scores", *PLACED, select="SELECT source, entropy_score FROM scores")
def placement_scores(spark, folder):
    return stats.placement_scores(_profile(spark, folder))


@register(
    "timeline_cells", *PLACED, oracle.TIMELINE, select="SELECT source, cell, level FROM cells"
)
def timeline_cells(spark, folder):
    return stats.timeline_cells(_profile(spark, folder))


@register("timelines", *PLACED, oracle.TIMELINE, select="SELECT source, timeline FROM timelines")
def timelines(spark, folder):
    """Quiet sources, and those whose gaps have no place since the last stamp is not after the first, have dots alone."""
    parsed = stage(services(spark, folder), "parsed")
    return stats.timelines(_profile_of(parsed), parsed.select("source").distinct())


@register(
    "risk_levels",
    *PLACED,
    oracle.RISK,
    select="SELECT source, risk_assessment, status_code, entropy_score, highest_confidence FROM risks",
)
def risk_levels(spark, folder):
    summary = scan_lines(inputs.service_lines(spark, folder), CONFIG, exact_chain=False).summary
    return summary.select("source", "risk_assessment", "status_code", "entropy_score", "highest_confidence")


@register(
    "scan_summary",
    *PLACED,
    oracle.TIMELINE,
    oracle.RISK,
    oracle.TOP,
    oracle.CHAIN,
    select="SELECT c.source, c.total_lines AS total_lines_scanned, c.parsed_lines, c.malformed_lines, "
    "c.error_lines, c.error_bursts, r.gap_count AS total_gaps_found, r.warning_count, r.suspicious_count, "
    "r.critical_count, t.gap_number AS top_gap_number, t.fingerprint AS top_fingerprint, r.risk_assessment, "
    "r.entropy_score, l.timeline, h.final_hash, r.status_code "
    "FROM counts c JOIN risks r USING (source) LEFT JOIN top t USING (source) "
    "JOIN timelines l USING (source) JOIN chains h USING (source)",
)
def scan_summary(spark, folder):
    summary = scan_lines(inputs.service_lines(spark, folder), CONFIG).summary
    return summary.select(
        "source",
        "total_lines_scanned",
        "parsed_lines",
        "malformed_lines",
        "error_lines",
        "error_bursts",
        "total_gaps_found",
        F.col("severity_breakdown.WARNING").alias("warning_count"),
        F.col("severity_breakdown.SUSPICIOUS").alias("suspicious_count"),
        F.col("severity_breakdown.CRITICAL").alias("critical_count"),
        F.col("most_critical_gap.gap_number").alias("top_gap_number"),
        F.col("most_critical_gap.fingerprint").alias("top_fingerprint"),
        "risk_assessment",
        "entropy_score",
        "timeline",
        F.col("integrity_chain.final_hash").alias("final_hash"),
        "status_code",
    )


@register(
    "scorecard",
    *PLACED,
    oracle.RISK,
    select="SELECT c.source, c.parsed_lines, r.gap_count AS time_gaps, c.error_bursts, "
    "r.risk_assessment AS risk_level FROM counts c JOIN risks r USING (source)",
)
def scorecard(spark, folder):
    return stats.scorecard(scan_lines(inputs.service_lines(spark, folder), CONFIG, exact_chain=False).summary)


# --- sinks ---------------------------------------------------------------------------------


@register("csv_report", *GAPS, select=f"SELECT {oracle.REPORT} FROM gaps")
def csv_report(spark, folder):
    """The CSV report written and read back."""
    target = new_folder(spark, "csv")
    reports.write_csv(scan_lines(inputs.service_lines(spark, folder), CONFIG, exact_chain=False).gaps, target)
    return reports.read_csv(spark, target)


@register(
    "json_report",
    *PLACED,
    oracle.RISK,
    select="SELECT g.source, g.gap_number, g.fingerprint, g.tamper_confidence, g.line_before_gap, "
    "c.total_lines, r.risk_assessment FROM gaps g JOIN counts c USING (source) JOIN risks r USING (source)",
)
def json_report(spark, folder):
    """The JSON pieces written, read back and taken apart again."""
    target = new_folder(spark, "json")
    result = scan_lines(inputs.service_lines(spark, folder), CONFIG, exact_chain=False)
    reports.write_json(reports.json_pieces(result, dt.datetime(2024, 1, 31), 1.5), target)
    pieces = spark.read.text(target)
    is_gap = F.ltrim(F.col("value"), F.lit(",")).startswith('{"gap_number"')
    gap = F.from_json(
        F.ltrim(F.col("value"), F.lit(",")),
        "gap_number bigint, fingerprint string, tamper_confidence double, line_before_gap string",
    )
    head = F.from_json(
        F.concat(F.regexp_replace("value", ',"gaps":\\[$', ""), F.lit("}")),
        "file_info struct<total_lines: bigint>",
    )
    tail = F.from_json(F.concat(F.lit("{"), F.substr("value", F.lit(3))), "summary struct<risk_assessment: string>")
    heads = pieces.filter(F.col("value").startswith('{"scan_metadata"')).select(
        "source", head["file_info"]["total_lines"].alias("total_lines")
    )
    tails = pieces.filter(F.col("value").startswith("],")).select(
        "source", tail["summary"]["risk_assessment"].alias("risk_assessment")
    )
    rows = pieces.filter(is_gap).select("source", gap.alias("g")).select("source", "g.*")
    return rows.join(heads, "source").join(tails, "source")


DOCUMENT = (
    "file_info struct<filename: string, total_lines: bigint, parsed_lines: bigint, malformed_lines: bigint, "
    "error_lines: bigint, error_bursts: bigint>, configuration struct<threshold_seconds: double, severity_filter: string, "
    "context_lines: bigint>"
)
DOCUMENT_GAP = reports.csv_ddl()
DOCUMENT_END = (
    "summary struct<total_gaps_found: bigint, severity_breakdown: struct<WARNING: bigint, SUSPICIOUS: bigint, "
    "CRITICAL: bigint>, most_critical_gap: struct<gap_number: bigint, fingerprint: string>, risk_assessment: string, "
    "scan_duration_seconds: double, entropy_score: double, timeline: string, total_lines_scanned: bigint>"
)


@register(
    "report_documents",
    *PLACED,
    oracle.TIMELINE,
    oracle.RISK,
    """
top AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'SUSPICIOUS' THEN 2
         ELSE 1 END DESC, duration_seconds DESC, tamper_confidence DESC, gap_number) AS nth FROM gaps)""",
    select="SELECT g.*, CAST(row_number() OVER (PARTITION BY g.source ORDER BY g.gap_number) + 1 AS BIGINT) AS place, "
    "c.total_lines, c.parsed_lines, c.malformed_lines, c.error_lines, c.error_bursts, 300.0::DOUBLE AS threshold_seconds, "
    "2::BIGINT AS context_lines, r.gap_count AS total_gaps_found, r.warning_count, r.suspicious_count, r.critical_count, "
    "t.gap_number AS top_gap, t.fingerprint AS top_fingerprint, r.risk_assessment, r.entropy_score, l.timeline, "
    "1.5::DOUBLE AS scan_duration_seconds "
    f"FROM (SELECT {oracle.REPORT} FROM gaps) g JOIN counts c USING (source) JOIN risks r USING (source) "
    "JOIN timelines l USING (source) JOIN top t ON t.source = g.source AND t.nth = 1",
)
def report_documents(spark, folder):
    """JSON documents in buckets and short parts: gaps, counters and verdict read back, pieces placed by the manifest."""
    store = ReportStore(spark, new_folder(spark, "store"), sources_per_bucket=3, rows_per_part=50)
    store.write(scan_lines(inputs.service_lines(spark, folder), CONFIG, exact_chain=False), dt.datetime(2024, 1, 31), scan_seconds=1.5)
    pieces = stage(store.json(), "pieces")
    opened = F.concat(F.regexp_replace("piece", ',"gaps":\\[$', ""), F.lit("}"))
    heads = pieces.filter(F.col("place") == 1).select("source", F.from_json(opened, DOCUMENT).alias("d"))
    tails = pieces.filter(F.col("piece").startswith("],")).select(
        "source", F.from_json(F.concat(F.lit("{"), F.substr("piece", F.lit(3))), DOCUMENT_END)["summary"].alias("s")
    )
    gap = F.from_json(F.ltrim("piece", F.lit(",")), DOCUMENT_GAP).alias("g")
    found = pieces.filter((F.col("place") > 1) & ~F.col("piece").startswith("],")).select("source", "place", gap)
    facts = heads.join(tails, "source").selectExpr(
        "source",
        *[f"d.file_info.{name}" for name in ("total_lines", "parsed_lines", "malformed_lines", "error_lines", "error_bursts")],
        "d.configuration.threshold_seconds",
        "d.configuration.context_lines",
        "s.total_gaps_found",
        *[f"s.severity_breakdown.{name.upper()} AS {name}_count" for name in ("warning", "suspicious", "critical")],
        "s.most_critical_gap.gap_number AS top_gap",
        "s.most_critical_gap.fingerprint AS top_fingerprint",
        "s.risk_assessment",
        "s.entropy_score",
        "s.timeline",
        "s.scan_duration_seconds",
    )
    return found.select("source", "place", "g.*").join(facts, "source")


@register(
    "result_tables",
    *PLACED,
    oracle.TIMELINE,
    oracle.segments(SEGMENT),
    select="SELECT 'lines' AS result, source, count(*) AS row_count FROM parsed GROUP BY source "
    "UNION ALL SELECT 'gaps', source, count(*) FROM gaps GROUP BY source "
    "UNION ALL SELECT 'bursts', source, count(*) FROM bursts GROUP BY source "
    "UNION ALL SELECT 'stats', source, 1 FROM counts UNION ALL SELECT 'summary', source, 1 FROM counts "
    "UNION ALL SELECT 'timeline', source, count(*) FROM cells GROUP BY source "
    "UNION ALL SELECT 'segments', source, count(*) FROM segments GROUP BY source",
)
def result_tables(spark, folder):
    """Result tables written as parquet and read back by scan date."""
    target = new_folder(spark, "tables")
    config = replace(CONFIG, segment_lines=SEGMENT)
    result = scan_lines(inputs.service_lines(spark, folder), config, exact_chain=False)
    reports.write_tables(result, target, dt.date(2024, 1, 31))

    def counted(name: str) -> DataFrame:
        rows = spark.read.parquet(f"{target}/{name}").filter(F.col("scan_date") == dt.date(2024, 1, 31))
        return rows.groupBy(F.lit(name).alias("result"), "source").agg(F.count(F.lit(1)).alias("row_count"))

    found = counted("lines")
    for name in ("gaps", "bursts", "stats", "summary", "timeline", "segments"):
        found = found.unionByName(counted(name))
    return found


FILE_SOURCES = (
    f"""
lines AS (
  SELECT 'part-' || (event_id // {inputs.FILE_EVENTS}) AS source,
         row_number() OVER (PARTITION BY event_id // {inputs.FILE_EVENTS} ORDER BY event_id) AS line_number,
         {oracle.EVENT_LINE} AS line
  FROM events)""",
    oracle.PARSED,
    oracle.STEPS,
    oracle.GAPS,
    oracle.BURSTS,
    oracle.COUNTS,
    oracle.TOTALS,
    oracle.PLACEMENT,
    oracle.TIMELINE,
    oracle.RISK,
    oracle.CHAIN,
)


def _file_summary(summary: DataFrame) -> DataFrame:
    part = F.concat(F.lit("part-"), F.regexp_extract("source", "part=([0-9]+)", 1))
    return summary.select(
        part.alias("source"),
        "total_lines_scanned",
        "parsed_lines",
        "error_bursts",
        "total_gaps_found",
        "risk_assessment",
        "entropy_score",
        "timeline",
        F.col("integrity_chain.final_hash").alias("final_hash"),
    )


@register(
    "file_scan_summary",
    *FILE_SOURCES,
    select="SELECT c.source, c.total_lines AS total_lines_scanned, c.parsed_lines, c.error_bursts, "
    "r.gap_count AS total_gaps_found, r.risk_assessment, r.entropy_score, l.timeline, h.final_hash "
    "FROM counts c JOIN risks r USING (source) JOIN timelines l USING (source) JOIN chains h USING (source)",
)
def file_scan_summary(spark, folder):
    """The whole scan from text files to the summary row."""
    path = inputs.event_files(spark, folder, new_folder(spark, "event_files"))
    return _file_summary(scan_files(spark, f"{path}/part=*", CONFIG).summary)


@register(
    "progress_metrics",
    *LINES,
    select="SELECT count(*) AS lines, count(ts) AS parsed, count(*) - count(ts) AS malformed, "
    "count(*) FILTER (is_error) AS errors FROM parsed",
)
def progress_metrics(spark, folder):
    """Counters observed while the parsed lines pass to a sink."""
    seen = Observation("lines")
    progress.observe_lines(services(spark, folder), seen).write.format("noop").mode("overwrite").save()
    found = seen.get
    row = tuple(found[name] for name in ("lines", "parsed", "malformed", "errors"))
    return spark.createDataFrame([row], "lines bigint, parsed bigint, malformed bigint, errors bigint")


# --- streams and event time ----------------------------------------------------------------


def _run_monitor(spark: SparkSession, folder: str, slices: int = 3) -> DataFrame:
    """Feed the service lines to the monitor in slices; each run picks up the kept state."""
    feed, sink, kept = (new_folder(spark, name) for name in ("feed", "monitor", "state"))
    lines = inputs.service_lines(spark, folder)
    longest = lines.agg(F.max("line_number")).first()[0] or 1
    size = -(-longest // slices)
    with monitor.rocksdb_state(spark):
        for part in range(slices):
            arriving = F.floor((F.col("line_number") - 1) / F.lit(size)) == part
            lines.filter(arriving).write.mode("append").parquet(feed)
            stream = spark.readStream.schema(lines.schema).parquet(feed)
            query = (
                monitor.monitor_stream(stream, CONFIG)
                .writeStream.format("parquet")
                .option("path", sink)
                .option("checkpointLocation", kept)
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
    return spark.read.parquet(sink)


@register("stream_gap_report", *GAPS, select=f"SELECT {oracle.REPORT} FROM gaps")
def stream_gap_report(spark, folder):
    return gaps.report_rows(monitor.monitor_gaps(_run_monitor(spark, folder), CONFIG))


@register(
    "stream_status",
    *SOURCES,
    oracle.CHAIN,
    select="SELECT c.source, total_lines, parsed_lines, malformed_lines, error_lines, error_bursts, "
    f"{oracle.iso('first_ts')} AS first_timestamp, {oracle.iso('last_ts')} AS last_timestamp, "
    "gap_count AS gaps_detected, final_hash FROM counts c JOIN spans USING (source) JOIN totals USING (source) "
    "JOIN chains USING (source)",
)
def stream_status(spark, folder):
    latest = monitor.monitor_status(_run_monitor(spark, folder))
    return latest.select(
        "source",
        "total_lines",
        "parsed_lines",
        "malformed_lines",
        "error_lines",
        "error_bursts",
        instant("first_us", "first_timestamp"),
        instant("last_us", "last_timestamp"),
        "gaps_detected",
        "final_hash",
    )


def _run_blocks(
    spark: SparkSession, folder: str, slices: int = 3, seen: StreamMetrics | None = None
) -> carry.CarryLog:
    """Feed the service lines to the block-wise monitor in slices, each by a query of its own."""
    feed, kept = new_folder(spark, "feed"), new_folder(spark, "state")
    log = carry.CarryLog(spark, new_folder(spark, "carry"), CONFIG, exact_chain=False)
    lines = stage(inputs.service_lines(spark, folder), "lines")
    longest = lines.agg(F.max("line_number")).first()[0] or 1
    size = -(-longest // slices)
    for part in range(slices):
        lines.filter(F.floor((F.col("line_number") - 1) / F.lit(size)) == part).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(lines.schema).parquet(feed)
        query = carry.monitor_blocks(stream, log, kept)
        query.awaitTermination()
        if seen:
            seen.wait_for(query.runId)
    return log


@register("stream_gap_context", *GAPS, CONTEXT, select=CONTEXT_SELECT)
def stream_gap_context(spark, folder):
    """Gaps with context from a stream whose slices cut contexts."""
    return _context_texts(_run_blocks(spark, folder).gaps())


@register("stream_bursts", *LINES, oracle.BURSTS, select=BURST_SELECT)
def stream_bursts(spark, folder):
    """Error bursts from a stream whose slices cut bursts."""
    found = _run_blocks(spark, folder).bursts()
    ends = instant("first_us", "first_ts"), instant("last_us", "last_ts")
    return found.select("source", "burst_number", "line_number_start", "line_number_end", "line_count", *ends)


@register(
    "stream_late_lines",
    *LINES,
    select="SELECT source, line_number, line, 'late' AS reason FROM lines WHERE line_number % 7 = 3",
)
def stream_late_lines(spark, folder):
    """All lines, and then every seventh once more: the second copies are late and change no counter."""
    feed, kept = new_folder(spark, "feed"), new_folder(spark, "state")
    log = carry.CarryLog(spark, new_folder(spark, "carry"), CONFIG, exact_chain=False)
    lines = stage(inputs.service_lines(spark, folder), "lines")
    for arriving in (lines, lines.filter("line_number % 7 = 3")):
        arriving.write.mode("append").parquet(feed)
        carry.monitor_blocks(spark.readStream.schema(lines.schema).parquet(feed), log, kept).awaitTermination()
    counted = log.status().agg(F.sum("total_lines")).first()[0]
    if counted != lines.count():
        raise AssertionError(f"{counted} lines were counted")
    return log.late()


@register(
    "stream_progress",
    *GAPS,
    """
sizes AS (SELECT CAST(ceil(max(line_number) / 3.0) AS BIGINT) AS size FROM lines),
per_source AS (
  SELECT (line_number - 1) // size AS batch, source, count(*) AS lines, count(ts) AS parsed,
         count(*) - count(ts) AS malformed, count(*) FILTER (is_error) AS errors, CAST(sum(octet_length(encode(line))) AS BIGINT) AS bytes
  FROM parsed CROSS JOIN sizes GROUP BY ALL),
gaps_by AS (
  SELECT (line_number_end - 1) // size AS batch, source, count(*) AS gaps FROM gaps CROSS JOIN sizes GROUP BY ALL)""",
    select="SELECT batch, source, lines, parsed, malformed, errors, coalesce(gaps, 0) AS gaps, "
    "CAST(sum(lines) OVER (PARTITION BY batch) AS BIGINT) AS batch_lines, "
    "CAST(sum(bytes) OVER (PARTITION BY batch) AS BIGINT) AS batch_bytes FROM per_source LEFT JOIN gaps_by USING (batch, source)",
)
def stream_progress(spark, folder):
    """Three micro-batches: counts per source from the carry, per batch as a listener heard them."""
    seen = StreamMetrics()
    spark.streams.addListener(seen)
    try:
        log = _run_blocks(spark, folder, seen=seen)
    finally:
        spark.streams.removeListener(seen)
    per_source = log.progress().withColumn("batch", F.col("batch").cast("bigint")).drop("late")
    heard = seen.table(spark).selectExpr("batch", "lines AS batch_lines", "bytes AS batch_bytes")
    return per_source.join(F.broadcast(heard), "batch")


@register(
    "folder_stream_summary",
    *FILE_SOURCES,
    select="SELECT c.source, c.total_lines AS total_lines_scanned, c.parsed_lines, c.error_bursts, "
    "r.gap_count AS total_gaps_found, r.risk_assessment, r.entropy_score, l.timeline, h.final_hash "
    "FROM counts c JOIN risks r USING (source) JOIN timelines l USING (source) JOIN chains h USING (source)",
)
def folder_stream_summary(spark, folder):
    """Arriving text files, scanned per micro-batch; each batch's rows are written once."""
    inbox = inputs.event_files(spark, folder, new_folder(spark, "inbox"))
    target = new_folder(spark, "folder_summary")

    def keep(result, batch_id: int) -> None:
        result.summary.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    watch_folder(spark, f"{inbox}/part=*", CONFIG, keep, new_folder(spark, "state")).awaitTermination()
    return _file_summary(spark.read.parquet(target))


@register(
    "activity_periods",
    *LINES,
    """
ordered AS (
  SELECT source, ts, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY source ORDER BY ts)) AS silence
  FROM parsed WHERE ts IS NOT NULL),
periods AS (
  SELECT source, ts, sum(CASE WHEN silence IS NULL OR silence > 300000000 THEN 1 ELSE 0 END)
                       OVER (PARTITION BY source ORDER BY ts ROWS UNBOUNDED PRECEDING) AS period
  FROM ordered)""",
    select=f"SELECT source, {oracle.iso('min(ts)')} AS first_ts, {oracle.iso('max(ts)')} AS last_ts, "
    "count(*) AS line_count FROM periods GROUP BY source, period",
)
def activity_periods(spark, folder):
    found = activity.activity_periods(services(spark, folder), CONFIG.threshold_seconds)
    return found.select(
        "source", instant("first_us", "first_ts"), instant("last_us", "last_ts"), "line_count"
    )


@register("activity_stream", "", select="")
def activity_stream(spark, folder):
    """The same stretches from a stream of four slices of time that arrive out of order, within the watermark.

    A last line far ahead lets the watermark pass every session.
    """
    feed, sink, kept = (new_folder(spark, name) for name in ("feed", "sessions", "state"))
    parsed = stage(services(spark, folder).select("source", "ts_us"), "parsed")
    low, high = parsed.agg(F.min("ts_us"), F.max("ts_us")).first()
    width = (high - low) // 4 + 1
    last = spark.createDataFrame([("", high + 4 * width + 86_400_000_000)], parsed.schema)
    slices = [parsed.filter(F.expr(f"(ts_us - {low}) div {width}") == part) for part in (1, 0, 3, 2)]
    for rows in (*slices, last):
        rows.write.mode("append").parquet(feed)
        stream = spark.readStream.schema(parsed.schema).parquet(feed)
        sessions = silence.activity_stream(stream, CONFIG.threshold_seconds, f"{2 * width // 1_000_000 + 1} seconds")
        writer = sessions.writeStream.format("parquet").option("path", sink).option("checkpointLocation", kept)
        writer.trigger(availableNow=True).start().awaitTermination()
    found = spark.read.schema(sessions.schema).parquet(sink).filter("source <> ''")
    ends = [F.unix_micros(name).alias(name.replace("_ts", "_us")) for name in ("first_ts", "last_ts")]
    exact = found.select("source", *ends, "line_count")
    return exact.select("source", instant("first_us", "first_ts"), instant("last_us", "last_ts"), "line_count")


ORACLE["activity_stream"] = ORACLE["activity_periods"]


# --- further signals -----------------------------------------------------------------------


@register(
    "backward_jumps",
    oracle.ORDER_LINES,
    oracle.PARSED,
    oracle.STEPS,
    select=f"SELECT source, prev_number AS previous_line_number, line_number, {oracle.iso('prev_ts')} AS before, "
    f"{oracle.iso('ts')} AS after, -delta_us AS jump_us FROM steps WHERE delta_us < 0",
)
def backward_jumps(spark, folder):
    config = replace(CONFIG, block_lines=500)
    found = signals.backward_jumps(parse_lines(inputs.order_lines(spark, folder), config), config)
    ends = instant("previous_us", "before"), instant("effective_us", "after")
    return found.select("source", "previous_line_number", "line_number", *ends, "jump_us")


@register(
    "duplicate_stamp_runs",
    oracle.ORDER_LINES,
    oracle.PARSED,
    oracle.STEPS,
    select="SELECT source, min(line_number) AS first_line, max(line_number) AS last_line, count(*) AS line_count "
    "FROM (SELECT *, sum(CASE WHEN delta_us = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY source ORDER BY line_number) AS run "
    "FROM steps) AS numbered GROUP BY source, run HAVING count(*) >= 2",
)
def duplicate_stamp_runs(spark, folder):
    """Blocks are short, so that runs cross them."""
    config = replace(CONFIG, block_lines=7)
    found = signals.duplicate_stamp_runs(parse_lines(inputs.order_lines(spark, folder), config), config, least=2)
    return found.select("source", "first_line", "last_line", "line_count")


@register(
    "after_hours_activity",
    *LINES,
    select="SELECT source, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') AS hour, count(*) AS line_count, "
    "CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_lines "
    "FROM parsed WHERE ts IS NOT NULL AND hour(ts) BETWEEN 2 AND 4 GROUP BY ALL",
)
def after_hours_activity(spark, folder):
    found = signals.after_hours_activity(services(spark, folder))
    return found.withColumn("hour", F.date_format("hour", "yyyy-MM-dd'T'HH:mm:ss"))


@register(
    "dense_errors",
    *LINES,
    select="SELECT source, epoch_us(ts) // 3600000000 * 3600000000 AS start_us, count(*) AS error_lines, "
    "min(line_number) AS first_line, max(line_number) AS last_line FROM parsed WHERE is_error AND ts IS NOT NULL "
    "GROUP BY source, epoch_us(ts) // 3600000000 HAVING count(*) >= 2",
)
def dense_errors(spark, folder):
    found = signals.dense_errors(services(spark, folder), seconds=3600, least=2)
    return found.select("source", "start_us", "error_lines", "first_line", "last_line")


DENSITY = """
moments AS (
  SELECT source, epoch_us(ts) AS end_us, count(*) AS n, min(line_number) AS low, max(line_number) AS high
  FROM parsed WHERE is_error AND ts IS NOT NULL GROUP BY ALL),
density AS (
  SELECT source, end_us, CAST(sum(n) OVER w AS BIGINT) AS error_lines, min(low) OVER w AS first_line, max(high) OVER w AS last_line
  FROM moments
  WINDOW w AS (PARTITION BY source ORDER BY end_us RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)
  QUALIFY error_lines >= 3)"""


@register("error_density", *LINES, DENSITY, select="SELECT source, end_us, error_lines, first_line, last_line FROM density")
def error_density(spark, folder):
    """Three errors within any hour, not only within clock hours."""
    return signals.error_density(services(spark, folder), seconds=3600, least=3)


@register(
    "dense_stretches",
    *LINES,
    DENSITY,
    """
opened AS (
  SELECT *, CASE WHEN end_us - lag(end_us) OVER w < 3600000000 THEN 0 ELSE 1 END AS opens FROM density
  WINDOW w AS (PARTITION BY source ORDER BY end_us)),
stretched AS (SELECT *, sum(opens) OVER (PARTITION BY source ORDER BY end_us) AS stretch FROM opened)""",
    select="SELECT source, min(end_us) AS first_us, max(end_us) AS last_us, count(*) AS moments FROM stretched GROUP BY source, stretch",
)
def dense_stretches(spark, folder):
    return signals.dense_stretches(services(spark, folder), seconds=3600, least=3)


@register(
    "level_breakdown",
    *LINES,
    select="SELECT source, regexp_extract(line, '\\[([A-Za-z]+)\\]', 1) AS level, count(*) AS line_count, "
    "CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_lines, "
    "CAST(sum(CASE WHEN ts IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS malformed_lines FROM parsed GROUP BY ALL",
)
def level_breakdown(spark, folder):
    return signals.breakdown(services(spark, folder))


@register(
    "service_breakdown",
    oracle.LABELLED_LINES,
    oracle.PARSED,
    select="SELECT source, regexp_extract(line, '\\[[A-Za-z]+\\] \\[([^\\]]+)\\]', 1) AS service, count(*) AS line_count, "
    "CAST(sum(CASE WHEN is_error THEN 1 ELSE 0 END) AS BIGINT) AS error_lines, "
    "CAST(sum(CASE WHEN ts IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS malformed_lines FROM parsed GROUP BY ALL",
)
def service_breakdown(spark, folder):
    """Lines, errors and malformed lines per source and service; lines without one under the empty text."""
    parsed = parse_lines(inputs.labelled_lines(spark, folder), CONFIG)
    return signals.breakdown(parsed, signals.SERVICE, "service")


@register(
    "tied_table_lines",
    """
texts AS (
  SELECT 'dock-' || (l_orderkey % 3) AS source, l_orderkey,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || ' ' || l_orderkey || ' ' || l_linenumber AS line FROM lineitem
)""",
    select="SELECT source, row_number() OVER (PARTITION BY source ORDER BY l_orderkey, line) AS line_number, line FROM texts",
)
def tied_table_lines(spark, folder):
    """A table whose order column has ties: equal numbers on every reading."""
    return inputs.shipment_lines(spark, folder)


@register(
    "run_comparison",
    *GAPS,
    select="SELECT source, fingerprint, CASE WHEN secs > 600 THEN 'persisting' ELSE 'vanished' END AS change "
    "FROM (SELECT gaps.source, fingerprint, secs FROM gaps JOIN scored USING (source, gap_number)) AS both_runs",
)
def run_comparison(spark, folder):
    """A scan at five minutes against one at ten: longer gaps persist, the others vanish."""
    parsed = services(spark, folder)
    strict = replace(CONFIG, threshold_seconds=600)
    return signals.compare_runs(
        gaps.detect_gaps(parsed, CONFIG, text=False), gaps.detect_gaps(parsed, strict, text=False)
    )


@register(
    "policy_gaps",
    *GAPS,
    select="SELECT source, gap_number, CASE WHEN source = 'svc-3' THEN severity WHEN secs > 1200 THEN 'CRITICAL' "
    "WHEN secs >= 600 THEN 'SUSPICIOUS' ELSE 'WARNING' END AS severity, "
    "CASE WHEN source = 'svc-3' THEN tamper_confidence ELSE least(100.0::DOUBLE, tamper_confidence * 1.25::DOUBLE) END "
    "AS tamper_confidence FROM (SELECT gaps.source, gap_number, gaps.severity, tamper_confidence, secs "
    "FROM gaps JOIN scored USING (source, gap_number)) AS judged",
)
def policy_gaps(spark, folder):
    """Every service but one under a stricter policy, taken from the sources found."""
    parsed = services(spark, folder)
    known = parsed.select("source").distinct().filter("source <> 'svc-3'")
    policies = known.selectExpr("source", "600D AS suspicious_seconds", "1200D AS critical_seconds", "1.25D AS weight")
    judged = signals.apply_policies(gaps.detect_gaps(parsed, CONFIG, text=False), policies)
    return judged.select("source", "gap_number", "severity", "tamper_confidence")


POLICY = (
    *[part.replace("\ngaps AS (", "\nplain_gaps AS (") for part in GAPS],
    """
gaps AS (
  SELECT p.* REPLACE (
      CASE WHEN p.source = 'svc-3' THEN p.severity WHEN secs > 600 * (k + 1) * (k + 1) THEN 'CRITICAL'
           WHEN secs >= 600 THEN 'SUSPICIOUS' ELSE 'WARNING' END AS severity,
      CASE WHEN p.source = 'svc-3' THEN tamper_confidence ELSE least(100.0::DOUBLE, tamper_confidence * (0.5::DOUBLE + k / 16.0::DOUBLE)) END
        AS tamper_confidence)
  FROM plain_gaps p JOIN (SELECT source, gap_number, secs, CAST(substr(source, 5) AS BIGINT) AS k FROM scored) USING (source, gap_number))""",
    oracle.BURSTS,
    oracle.COUNTS,
    oracle.TOTALS,
    oracle.PLACEMENT,
    oracle.RISK,
)


@register(
    "policy_summary",
    *POLICY,
    select="SELECT source, gap_count AS total_gaps_found, warning_count, suspicious_count, critical_count, "
    "highest_confidence, entropy_score, risk_assessment, status_code FROM risks",
)
def policy_summary(spark, folder):
    """Risk levels and status under a policy per service; one service keeps the rules of the scan."""
    lines = inputs.service_lines(spark, folder)
    number = F.substr("source", F.lit(5)).cast("bigint")
    known = lines.select("source").distinct().filter("source <> 'svc-3'").withColumn("k", number)
    policies = known.selectExpr(
        "source", "600D AS suspicious_seconds", "600D * (k + 1) * (k + 1) AS critical_seconds", "0.5D + k / 16D AS weight"
    )
    summary = scan_lines(lines, CONFIG, exact_chain=False, policies=policies).summary
    counts = [F.col(f"severity_breakdown.{name.upper()}").alias(f"{name}_count") for name in ("warning", "suspicious", "critical")]
    return summary.select(
        "source", "total_gaps_found", *counts, "highest_confidence", "entropy_score", "risk_assessment", "status_code"
    )


# --- rules that the usual lines do not reach ------------------------------------------------


@register(
    "offset_timestamps",
    "",
    select="SELECT CAST(event_id + 1 AS BIGINT) AS line_number, "
    f"{oracle.iso('ts')} AS ts, 'ISO8601' AS parser FROM events",
)
def offset_timestamps(spark, folder):
    """Stamps written in other zones, with their offsets, come back in UTC."""
    events = inputs.table(spark, folder, "events")
    turn = F.col("event_id") % 3
    minutes = F.when(turn == 0, 330).when(turn == 1, -330).otherwise(0)
    offset = F.when(turn == 0, "+05:30").when(turn == 1, "-0530").otherwise("Z")
    local = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + minutes.cast("bigint") * 60_000_000)
    stamp = F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), offset)
    lines = events.select(
        F.lit("zones").alias("source"),
        (F.col("event_id") + 1).alias("line_number"),
        F.concat(stamp, F.lit(" "), "event_type").alias("line"),
    )
    return parse_lines(lines, CONFIG).select("line_number", instant("ts_us", "ts"), "parser")


@register(
    "custom_zone_timestamps",
    "",
    select="SELECT CAST(event_id + 1 AS BIGINT) AS line_number, "
    f"{oracle.iso("date_trunc('second', ts)")} AS ts, 'CUSTOM' AS parser FROM events",
)
def custom_zone_timestamps(spark, folder):
    """A custom layout with a month's name, a twelve-hour clock and an offset."""
    events = inputs.table(spark, folder, "events")
    local = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + 7_200_000_000)
    stamp = F.concat(F.date_format(local, "dd-MMM-yyyy hh:mm:ss a"), F.lit(" +0200"))
    lines = events.select(
        F.lit("zones").alias("source"),
        (F.col("event_id") + 1).alias("line_number"),
        F.concat(stamp, F.lit(" "), "event_type").alias("line"),
    )
    config = replace(CONFIG, custom_format="%d-%b-%Y %I:%M:%S %p %z")
    return parse_lines(lines, config).select("line_number", instant("ts_us", "ts"), "parser")


WORDS = ("Panic", "all well", "access DENIED", "failures", "Traceback:", "no terror", "quiet", "alerted", "fatal", "okay")


@register(
    "error_words",
    f"""
words AS (SELECT event_id, [{", ".join(f"'{w}'" for w in WORDS)}][event_id % {len(WORDS)} + 1] AS word FROM events)""",
    select="SELECT word, count(*) AS line_count, "
    "regexp_matches(lower(word), 'error|exception|traceback|critical|fatal|fail|panic|alert|denied') AS is_error "
    "FROM words GROUP BY word",
)
def error_words(spark, folder):
    """Words in any case and within longer ones."""
    from tracewarden.functions.errors import is_error_line

    words = F.array(*[F.lit(w) for w in WORDS])
    lines = inputs.table(spark, folder, "events").select(words[(F.col("event_id") % len(WORDS)).cast("int")].alias("word"))
    return lines.groupBy("word", is_error_line(F.col("word")).alias("is_error")).agg(F.count(F.lit(1)).alias("line_count"))


@register(
    "gap_context_sizes",
    *GAPS,
    select="SELECT n, g.source, g.gap_number, CASE WHEN l.line_number < g.line_number_end THEN 'before' "
    "ELSE 'after' END AS side, l.line_number, l.line FROM (VALUES (0), (1), (5)) AS sizes(n), gaps g "
    "JOIN lines l ON l.source = g.source "
    "WHERE l.line_number BETWEEN g.line_number_end - n AND g.line_number_end + greatest(n, 1) - 1",
)
def gap_context_sizes(spark, folder):
    """Context of no, one and five lines."""
    found = stage(gaps.detect_gaps(services(spark, folder), CONFIG, text=False), "gaps")
    lines = stage(inputs.service_lines(spark, folder), "lines")
    sides = [
        context.context_lines(found, lines, replace(CONFIG, context_lines=n)).withColumn("n", F.lit(n)) for n in (0, 1, 5)
    ]
    return sides[0].unionByName(sides[1]).unionByName(sides[2])


@register("hash_chain_rounds", *LINES, oracle.CHAIN, select="SELECT source, final_hash FROM chains")
def hash_chain_rounds(spark, folder):
    """The exact chain handed on after 400 lines, 800 more and so on; sources end in different rounds."""
    config = replace(CONFIG, chain_chunk_lines=400)
    return chain.sequential_chain(services(spark, folder, config), config)


@register(
    "one_file_in_splits",
    f"""
files AS (SELECT event_id // {inputs.FILE_EVENTS} AS part, event_id, {oracle.EVENT_LINE} AS line FROM events)""",
    select="SELECT 'part-' || part AS source, "
    "row_number() OVER (PARTITION BY part ORDER BY event_id) AS line_number, line FROM files",
)
def one_file_in_splits(spark, folder):
    """Files that are each read in several splits, of 64 kB, and numbered."""
    path = inputs.event_files(spark, folder, new_folder(spark, "event_files"))
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64k")
    try:
        found = scan_text(spark, f"{path}/part=*")
    finally:
        spark.conf.set(name, before)
    part = F.concat(F.lit("part-"), F.regexp_extract("source", "part=([0-9]+)", 1))
    return found.select(part.alias("source"), "line_number", "line")


@register(
    "marked_text_lines",
    f"""
files AS (
  SELECT event_id // {inputs.FILE_EVENTS} AS part, event_id,
    CASE WHEN event_id % {2 * inputs.FILE_EVENTS} = 0 THEN chr(65279) ELSE '' END || {oracle.EVENT_LINE} AS line
  FROM events
)""",
    select="SELECT 'part-' || part AS source, "
    "row_number() OVER (PARTITION BY part ORDER BY event_id) AS line_number, line FROM files",
)
def marked_text_lines(spark, folder):
    """Text files of which every second starts with a byte-order mark, which is part of line 1."""
    path = inputs.event_files(spark, folder, new_folder(spark, "event_files"), BYTE_ORDER_MARK)
    part = F.concat(F.lit("part-"), F.regexp_extract("source", "part=([0-9]+)", 1))
    return scan_text(spark, f"{path}/part=*").select(part.alias("source"), "line_number", "line")


for _plain in ("offset_timestamps", "custom_zone_timestamps"):
    ORACLE[_plain] = ORACLE[_plain].removeprefix("WITH \n")
