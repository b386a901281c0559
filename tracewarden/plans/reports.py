"""Report sinks: CSV, JSON documents and result tables.

Everything is written by the executors in parts. A report is ordered by range partitioning,
so the part files of a source in name order are the report; nothing is gathered in a task.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tracewarden.config import ScanConfig
from tracewarden.operators.blocks import with_source_facts
from tracewarden.operators.gaps import REPORT_COLUMNS, report_rows, with_iso_times
from tracewarden.plans.scan import ScanResult

LINE_COLUMNS = ("source", "line_number", "line", "ts_us", "parser", "is_error")
LAST_PIECE = 9_223_372_036_854_775_807
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


@dataclass(frozen=True)
class Outputs:
    """Where to write; ``None`` switches an output off."""

    csv: str | None = None
    json: str | None = None
    tables: str | None = None


def write_csv(gaps: DataFrame, path: str, by_source: bool = True, mode: str = "errorifexists") -> None:
    """The gap report: the twelve report columns, one folder per source (or a source column)."""
    ordered = report_rows(gaps).orderBy("source", "gap_number")
    writer = ordered.write.mode(mode).options(**CSV_OPTIONS)
    (writer.partitionBy("source") if by_source else writer).csv(path)


def write_quiet_csv(sources: DataFrame, gaps: DataFrame, path: str) -> None:
    """The report of sources without gaps: a folder with the header line alone, next to those of ``write_csv``."""
    quiet = sources.select("source").distinct().join(gaps.select("source").distinct(), "source", "left_anti")
    header = quiet.withColumn("value", F.lit(",".join(REPORT_COLUMNS)))
    header.write.mode("append").partitionBy("source").text(path)


def csv_ddl() -> str:
    """Columns and types of the gap report."""
    kinds = {
        "gap_number": "bigint",
        "duration_seconds": "bigint",
        "line_number_start": "bigint",
        "line_number_end": "bigint",
        "tamper_confidence": "double",
    }
    return ", ".join(f"{c} {kinds.get(c, 'string')}" for c in REPORT_COLUMNS)


def read_csv(spark, path: str, source_first: bool = False) -> DataFrame:
    """A written gap report with its column types; the source is in the folders' names or the first column."""
    ddl = f"source string, {csv_ddl()}" if source_first else f"{csv_ddl()}, source string"
    return spark.read.options(**{**CSV_OPTIONS, "multiLine": True}).schema(ddl).csv(path)


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _open(document: Column) -> Column:
    """A JSON object text without its closing brace."""
    return F.substr(document, F.lit(1), F.length(document) - 1)


def json_pieces(
    result: ScanResult,
    scan_time: dt.datetime,
    scan_seconds: float | None = None,
) -> DataFrame:
    """One JSON document per source, as ordered pieces ``source, position, piece``.

    A head, one piece per gap and a tail: a source with any number of gaps is written in
    parallel, and joining its pieces in order gives the whole document.
    """
    config: ScanConfig = result.config
    stats, summary = result.stats, result.summary
    name = F.col("file_name") if "file_name" in stats.columns else F.col("source")
    size = F.col("file_size") if "file_size" in stats.columns else F.lit(None).cast("bigint")
    head = _json(
        F.struct(
            F.lit("tracewarden").alias("tool_name"),
            F.lit("1.0.0").alias("version"),
            F.lit(scan_time.isoformat()).alias("scan_time"),
        ).alias("scan_metadata"),
        F.struct(
            name.alias("filename"),
            size.alias("file_size"),
            *["total_lines", "parsed_lines", "malformed_lines", "error_lines", "error_bursts"],
        ).alias("file_info"),
        F.struct(
            F.lit(float(config.threshold_seconds)).alias("threshold_seconds"),
            F.lit(config.custom_format).cast("string").alias("custom_format"),
            F.lit(config.min_severity).alias("severity_filter"),
            F.lit(config.context_lines).alias("context_lines"),
        ).alias("configuration"),
    )
    heads = stats.select(
        "source",
        F.lit(0).cast("bigint").alias("position"),
        F.concat(_open(head), F.lit(',"gaps":[')).alias("piece"),
    )

    firsts = result.gaps.groupBy("source").agg(F.min("gap_number").alias("__first"))
    shown = with_iso_times(result.gaps)
    body = _json(*[F.col(c) for c in (*REPORT_COLUMNS, "raw_context")])
    comma = F.when(F.col("gap_number") > F.col("__first"), ",").otherwise("")
    pieces = with_source_facts(shown, firsts, "gap_number").select(
        "source", F.col("gap_number").alias("position"), F.concat(comma, body).alias("piece")
    )

    tail = _json(
        F.struct(
            "total_lines_scanned",
            "parsed_lines",
            "malformed_lines",
            "error_lines",
            "error_bursts",
            "total_gaps_found",
            "severity_breakdown",
            "most_critical_gap",
            "risk_assessment",
            F.lit(None if scan_seconds is None else round(scan_seconds, 3))
            .cast("double")
            .alias("scan_duration_seconds"),
            "entropy_score",
            "timeline",
            *(["integrity_chain"] if "integrity_chain" in summary.columns else []),
        ).alias("summary")
    )
    tails = summary.select(
        "source",
        F.lit(LAST_PIECE).alias("position"),
        F.concat(F.lit("],"), F.substr(tail, F.lit(2))).alias("piece"),
    )
    return heads.unionByName(pieces).unionByName(tails)


def write_json(pieces: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder per source; its part files in name order are the document."""
    ordered = pieces.orderBy("source", "position").select("source", "piece")
    ordered.write.mode(mode).partitionBy("source").text(path)


def write_tables(result: ScanResult, path: str, scan_date: dt.date, mode: str = "overwrite") -> None:
    """Result tables as parquet, partitioned by scan date and clustered by source.

    A second run of one date replaces that date's rows and leaves other dates alone. A table without rows, such as the
    gaps of dense logs, has a file without rows for its date: it can be read, and rows of an earlier run are gone.
    """
    tables = {
        "lines": result.parsed.select(*LINE_COLUMNS),
        "gaps": result.gaps.drop("block"),
        "bursts": result.bursts,
        "stats": result.stats,
        "summary": result.summary,
        "timeline": result.timeline,
        "segments": result.segments,
    }
    for name, table in tables.items():
        target, seen = f"{path.rstrip('/')}/{name}", Observation()
        dated = table.withColumn("scan_date", F.lit(scan_date)).observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = dated.sortWithinPartitions("source").write.mode(mode).option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("scan_date").parquet(target)
        if not seen.get["rows"]:  # without rows Spark makes no partition and touches none
            table.limit(0).write.mode(mode).parquet(f"{target}/scan_date={scan_date.isoformat()}")


def write_reports(
    result: ScanResult,
    outputs: Outputs,
    scan_time: dt.datetime,
    scan_seconds: float | None = None,
) -> None:
    """Write the outputs that are switched on."""
    if outputs.csv:
        write_csv(result.gaps, outputs.csv)
        write_quiet_csv(result.stats, result.gaps, outputs.csv)
    if outputs.json:
        write_json(json_pieces(result, scan_time, scan_seconds), outputs.json)
    if outputs.tables:
        write_tables(result, outputs.tables, scan_time.date())
