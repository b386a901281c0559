import csv
import datetime as dt
import glob
import json
import os

import duckdb
import pytest
from brute import random_log, scan
from pyspark.sql import Observation

from tracewarden import ScanConfig, scan_lines
from tracewarden.operators.gaps import REPORT_COLUMNS
from tracewarden.plans import progress, reports
from tracewarden.queries.catalog import ORACLE, QUERIES

SCHEMA = "source string, line_number bigint, line string"
LOGS = {
    "quotes": [
        '2024-01-01 00:00:00 say "hi", then; ',
        "2024-01-01 02:30:00  tab\there , \\ 'x'",
        "2024-01-01 02:50:00 é",
    ],
    "random": random_log(5, 90),
    "quiet": ["2024-01-01 00:00:00 a", "2024-01-01 00:00:01 b"],
}


@pytest.fixture(scope="module")
def result(spark):
    rows = [(name, n, text) for name, log in LOGS.items() for n, text in enumerate(log, 1)]
    return scan_lines(spark.createDataFrame(rows, SCHEMA), ScanConfig(reference_year=2024))


def _part_files(folder, source):
    return sorted(glob.glob(os.path.join(folder, f"source={source}", "part-*")))


def test_csv_reads_back_with_a_plain_reader(result, tmp_path):
    target = str(tmp_path / "csv")
    reports.write_csv(result.gaps, target)
    for name in ("quotes", "random"):
        rows = []
        for path in _part_files(target, name):
            with open(path, newline="", encoding="utf-8") as handle:
                reader = csv.DictReader(handle)
                rows += list(reader)
                assert tuple(reader.fieldnames) == REPORT_COLUMNS
        want = scan(LOGS[name])["gaps"]
        assert len(rows) == len(want)
        for row, gap in zip(rows, want):
            for column in REPORT_COLUMNS:
                if column in gap:
                    assert row[column] == str(gap[column]), column


def test_csv_of_nothing_still_has_a_header(spark, result, tmp_path):
    target = str(tmp_path / "none")
    reports.write_csv(result.gaps.filter("false"), target, by_source=False)
    text = "".join(open(p, encoding="utf-8").read() for p in glob.glob(target + "/part-*"))
    assert text.strip() == "source," + ",".join(REPORT_COLUMNS)


def test_json_pieces_join_to_documents(result, tmp_path):
    target = str(tmp_path / "json")
    when = dt.datetime(2024, 5, 1, 12)
    outputs = reports.Outputs(json=target)
    reports.write_reports(result, outputs, when, scan_seconds=1.23456)
    for name, log in LOGS.items():
        text = "".join(open(p, encoding="utf-8").read() for p in _part_files(target, name))
        document = json.loads(text)
        want = scan(log)
        assert list(document) == ["scan_metadata", "file_info", "configuration", "gaps", "summary"]
        assert document["scan_metadata"]["scan_time"] == when.isoformat()
        assert document["configuration"] == {
            "threshold_seconds": 300.0,
            "custom_format": None,
            "severity_filter": "WARNING",
            "context_lines": 2,
        }
        assert document["file_info"]["total_lines"] == want["total"]
        assert len(document["gaps"]) == len(want["gaps"])
        for got, gap in zip(document["gaps"], want["gaps"]):
            for column in REPORT_COLUMNS:
                if column in gap:
                    assert got[column] == gap[column]
            assert [(x["line_number"], x["line"]) for x in got["raw_context"]["before"]] == gap["before"]
            assert [(x["line_number"], x["line"]) for x in got["raw_context"]["after"]] == gap["after"]
        summary = document["summary"]
        assert summary["scan_duration_seconds"] == 1.235
        assert summary["integrity_chain"]["final_hash"] == want["chain"]
        assert set(summary["severity_breakdown"]) == {"WARNING", "SUSPICIOUS", "CRITICAL"}
        assert (summary["most_critical_gap"] is None) == (not want["gaps"])


def test_tables_are_partitioned_by_scan_date(spark, result, tmp_path):
    target = str(tmp_path / "tables")
    for day in (1, 2):
        reports.write_tables(result, target, dt.date(2024, 5, day))
    gaps = spark.read.parquet(target + "/gaps")
    assert gaps.filter("scan_date = '2024-05-02'").count() == result.gaps.count() == gaps.count() / 2
    assert spark.read.parquet(target + "/summary").count() == 2 * len(LOGS)


QUIET = [("calm", n, text) for n, text in enumerate(LOGS["quiet"], 1)]
TABLES = ("lines", "gaps", "bursts", "stats", "summary", "timeline", "segments")


def test_tables_without_rows_can_be_read(spark, tmp_path):
    target = str(tmp_path / "tables")
    quiet = scan_lines(spark.createDataFrame(QUIET, SCHEMA), ScanConfig(reference_year=2024))
    for mode, n in (("errorifexists", 1), ("append", 2), ("overwrite", 1)):
        reports.write_tables(quiet, target, dt.date(2024, 5, 1), mode)
        read = {name: spark.read.parquet(f"{target}/{name}") for name in TABLES}
        rows = {name: table.filter("scan_date = DATE '2024-05-01'").count() for name, table in read.items()}
        assert rows == {"lines": 2 * n, "gaps": 0, "bursts": 0, "stats": n, "summary": n, "timeline": 0, "segments": n}, mode
    assert [*read["gaps"].dtypes] == [*quiet.gaps.drop("block").dtypes, ("scan_date", "date")]


def test_a_second_run_without_gaps_replaces_the_first(spark, result, tmp_path):
    target = str(tmp_path / "tables")
    for day in (1, 2):
        reports.write_tables(result, target, dt.date(2024, 5, day))
    quiet = scan_lines(spark.createDataFrame(QUIET, SCHEMA), ScanConfig(reference_year=2024))
    reports.write_tables(quiet, target, dt.date(2024, 5, 2))
    wanted = {"gaps": result.gaps, "bursts": result.bursts, "timeline": result.timeline}
    for name, table in wanted.items():
        counts = {str(day): n for day, n in spark.read.parquet(f"{target}/{name}").groupBy("scan_date").count().collect()}
        assert counts == {"2024-05-01": table.count()}, name


@pytest.mark.parametrize("rows", [0, 1500])
def test_result_tables_of_dense_events_equal_sql(spark, tmp_path, rows):
    """Events a second apart: no source has a gap, so two of the tables have no rows (without events: all)."""
    start = dt.datetime(2024, 1, 1)
    events = [(n, start + dt.timedelta(seconds=n), n, "error" if n % 7 == 0 else "view", 1.5, '{"k": 1}') for n in range(rows)]
    kinds = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    folder = str(tmp_path / "events.parquet")
    spark.createDataFrame(events, kinds).coalesce(1).write.parquet(folder)
    found = sorted(tuple(row) for row in QUERIES["result_tables"](spark, str(tmp_path)).collect())
    database = duckdb.connect()
    database.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/*.parquet'")
    assert found == sorted(database.execute(ORACLE["result_tables"]).fetchall())
    assert {name for name, _, _ in found} == ({"lines", "bursts", "stats", "summary", "segments"} if rows else set())


def test_switched_off_outputs_write_nothing(result, tmp_path):
    reports.write_reports(result, reports.Outputs(), dt.datetime(2024, 5, 1))
    assert os.listdir(tmp_path) == []


def test_progress_counts_arrive_with_the_query(result):
    seen = Observation("scan")
    progress.observe_lines(result.parsed, seen).write.format("noop").mode("overwrite").save()
    total = sum(len(log) for log in LOGS.values())
    parsed = sum(scan(log)["parsed"] for log in LOGS.values())
    assert seen.get["lines"] == total and seen.get["parsed"] == parsed
    assert seen.get["malformed"] == total - parsed
    assert progress.lines_per_second(100, 0.0) == 100_000.0
