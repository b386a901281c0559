"""Bucketed reports: manifest, order, quiet sources and replacement of a run."""

import csv
import datetime as dt
import glob
import json
import os

import pytest
from brute import random_log, scan

from tracewarden import ScanConfig, scan_lines
from tracewarden.operators.gaps import REPORT_COLUMNS
from tracewarden.plans.report_store import ReportStore

SCHEMA = "source string, line_number bigint, line string"
LOGS = {f"log {n}": random_log(n, 40 + 30 * n) for n in range(1, 6)}
LOGS["quiet"] = ["2024-01-01 00:00:00 a", "2024-01-01 00:00:01 b"]
WHEN = dt.datetime(2024, 5, 1)


def scanned(spark, logs, **options):
    rows = [(name, n, text) for name, log in logs.items() for n, text in enumerate(log, 1)]
    config = ScanConfig(reference_year=2024, **options)
    return scan_lines(spark.createDataFrame(rows, SCHEMA), config, exact_chain=False)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    store = ReportStore(spark, str(tmp_path_factory.mktemp("store")), sources_per_bucket=2, rows_per_part=4)
    store.write(scanned(spark, LOGS), WHEN, "first")
    return store


def part_file(store, kind, row):
    (path,) = glob.glob(os.path.join(store.current(), kind, f"bucket={row.bucket}", f"part={row.part}", "part-*"))
    return path


def test_manifest_leads_to_the_rows_of_a_source(store):
    """Read by plain readers, without Spark: part by part, row by row, in the order of the report."""
    manifest = store.manifest("csv").collect()
    assert {r.source for r in manifest} == set(LOGS) and len({r.bucket for r in manifest}) > 1
    for name, log in LOGS.items():
        mine = sorted((r for r in manifest if r.source == name), key=lambda r: r.part or 0)
        numbers = []
        for row in mine:
            if row.part is None:
                continue
            with open(part_file(store, "csv", row), newline="", encoding="utf-8") as handle:
                reader = csv.DictReader(handle)
                part = list(reader)
                assert tuple(reader.fieldnames) == ("source", *REPORT_COLUMNS)
            assert len(part) <= 4
            chosen = part[row.first : row.last + 1]
            assert {r["source"] for r in chosen} == {name}
            numbers += [int(r["gap_number"]) for r in chosen]
        assert numbers == list(range(1, len(scan(log)["gaps"]) + 1))
    assert [(r.part, r.first, r.last) for r in manifest if r.source == "quiet"] == [(None, None, None)]


def test_csv_and_tables_read_back(store):
    wanted = {name: len(scan(log)["gaps"]) for name, log in LOGS.items()}
    found = store.csv().groupBy("source").count().collect()
    assert {r.source: r["count"] for r in found} == {name: n for name, n in wanted.items() if n}
    lines = store.table("lines")
    assert lines.count() == sum(map(len, LOGS.values())) and "line" in lines.columns


def test_documents_are_whole(store):
    pieces = {}
    for row in store.json().orderBy("source", "place").collect():
        pieces.setdefault(row.source, []).append(row)
    assert pieces.keys() == LOGS.keys()
    for name, rows in pieces.items():
        assert [r.place for r in rows] == list(range(1, len(rows) + 1))
        document = json.loads("".join(r.piece for r in rows))
        assert document["file_info"]["filename"] == name
        assert [g["gap_number"] for g in document["gaps"]] == list(range(1, len(scan(LOGS[name])["gaps"]) + 1))
        assert document["summary"]["total_gaps_found"] == len(document["gaps"])


def test_a_run_counts_once_committed(spark, tmp_path):
    store = ReportStore(spark, str(tmp_path), sources_per_bucket=1, rows_per_part=3)
    with pytest.raises(ValueError):
        store.csv()
    store.write(scanned(spark, LOGS, min_severity="SUSPICIOUS"), WHEN, "a")
    before = store.csv().collect()
    assert before and {r.severity for r in before} <= {"SUSPICIOUS", "CRITICAL"}
    store._commit, commit = (lambda *_: None), store._commit  # the run stops before it is committed
    quiet = scanned(spark, {"quiet": LOGS["quiet"]})
    store.write(quiet, WHEN, "b")
    assert sorted(store.csv().collect()) == sorted(before)
    store._commit = commit
    store.write(quiet, WHEN, "b")
    assert store.csv().collect() == [] and store.csv().columns == ["source", *REPORT_COLUMNS]
    assert store.json().count() == 2
