"""The rollup over groups of sources against plain sums."""

import pytest
from brute import random_log, scan
from pyspark.sql import functions as F

from tracewarden import ScanConfig, scan_lines

SCHEMA = "source string, line_number bigint, line string"
LOGS = {f"{place}-{n}": random_log(10 * n + len(place), 60) for place in ("north", "south") for n in (1, 2, 3)}
LOGS["stray"] = ["2024-01-01 00:00:00 a", "error"]
LOGS["other"] = ["nothing"]


@pytest.fixture(scope="module")
def rolled(spark):
    rows = [(name, n, text) for name, log in LOGS.items() for n, text in enumerate(log, 1)]
    result = scan_lines(spark.createDataFrame(rows, SCHEMA), ScanConfig(reference_year=2024), exact_chain=False)
    place = F.when(F.col("source").contains("-"), F.split("source", "-")[0])
    return result.fleet(place).collect(), {r.source: r for r in result.summary.collect()}


def test_every_level_is_the_sum_of_its_sources(rolled):
    rows, summary = rolled
    assert sorted((r.level, r.source_group or "", r.source or "") for r in rows) == sorted(
        [("source", name.split("-")[0] if "-" in name else "", name) for name in LOGS]
        + [("group", "north", ""), ("group", "south", ""), ("group", "", ""), ("fleet", "", "")]
    )
    for row in rows:
        group = row.source_group
        if row.level == "source":
            members = [row.source]
        elif row.level == "group":
            members = [n for n in LOGS if (n.split("-")[0] if "-" in n else None) == group]
        else:
            members = list(LOGS)
        wanted = [scan(LOGS[n]) for n in members]
        assert row.source_count == len(members)
        assert row.total_lines == sum(w["total"] for w in wanted)
        assert row.parsed_lines == sum(w["parsed"] for w in wanted)
        assert row.malformed_lines == row.total_lines - row.parsed_lines
        assert row.error_lines == sum(w["errors"] for w in wanted)
        assert row.error_bursts == sum(len(w["bursts"]) for w in wanted)
        assert row.gap_count == sum(len(w["gaps"]) for w in wanted)
        assert row.warning_count + row.suspicious_count + row.critical_count == row.gap_count
        assert row.first_us == min((w["first"] for w in wanted if w["first"] is not None), default=None)
        most = sorted((-len(w["gaps"]), n) for n, w in zip(members, wanted) if w["gaps"])
        assert row.worst_source == (most[0][1] if most else None)
        labels = [summary[n].risk_assessment for n in members]
        assert row.sources_at_risk == sum(label in ("HIGH RISK", "COMPROMISED") for label in labels)


def test_no_source(spark):
    result = scan_lines(spark.createDataFrame([], SCHEMA), ScanConfig(), exact_chain=False)
    assert result.fleet(F.lit("all")).collect() == []
