"""The line-number contract, lines found by bitmap, sliding density and sticky years, against plain readings."""

import random
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tracewarden import ScanConfig, scan_lines
from tracewarden.operators import context, rollover, signals
from tracewarden.operators.parsing import parse_lines
from tracewarden.plans.scan import require_dense

CONFIG = ScanConfig(reference_year=2024)
SCHEMA = "source string, line_number bigint, line string"


def numbered(spark, numbers):
    return spark.createDataFrame([("s", n, "x") for n in numbers], SCHEMA).repartition(3)


@pytest.mark.parametrize(
    "numbers", [[1, 1, 4, 4], [1, 1, 3], [2, 3], [1, 3], [0, 1], [1, 2, None], [None], [*range(1, 200), 64], [*range(1, 65), *range(66, 131)]]
)
def test_holes_and_repeats_are_refused(spark, numbers):
    with pytest.raises(ValueError, match="numbered"):
        require_dense(numbered(spark, numbers))


@pytest.mark.parametrize("numbers", [[], [1], [3, 1, 2], list(range(1, 300))])
def test_dense_numbers_pass(spark, numbers):
    require_dense(numbered(spark, numbers))


def test_only_lines_near_gaps_meet_an_exchange(spark):
    """The text side of the lookup is filtered by the bitmap below its exchange, and few other lines pass."""
    start = datetime(2024, 1, 1)
    rows = [("s", n + 1, f"{start + timedelta(seconds=n + 1_000 * (n // 2_000))} x") for n in range(20_000)]
    lines = spark.createDataFrame(rows, SCHEMA).repartition(4)
    result = scan_lines(lines, CONFIG, exact_chain=False)
    wanted = result.all_gaps.withColumn("line_number", F.explode(context._wanted(CONFIG)))
    assert result.all_gaps.count() == 9
    shown = context.marked_lines(result.parsed.select("source", "line_number", "line"), wanted)
    assert wanted.join(shown, ["source", "line_number"], "left_anti").isEmpty() and shown.count() < 150
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = shown.join(wanted, ["source", "line_number"])._jdf.queryExecution().executedPlan().toString()
        # below the exchange of the text side stands the join with the bitmap
        text_side = plan[plan.index("hashpartitioning(source") :]
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in text_side[: text_side.index("Scan parquet")]
        assert result.gaps.count() == 9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_windows_of_errors_slide(spark, monkeypatch):
    """Bursts across clock slots and across time blocks, which are of two widths here."""
    monkeypatch.setattr(signals, "DENSITY_BLOCK", 2)
    draw = random.Random(4)
    start, rows = datetime(1969, 12, 31, 23, 50), []
    for source in ("a", "b"):
        at = start
        for n in range(1, 400):
            at += timedelta(seconds=draw.choice([0, 1, 10, 29, 30, 60, 61, 400]), microseconds=draw.choice([0, 1]))
            rows.append((source, n, f"{at.isoformat(sep=' ', timespec='microseconds')} {draw.choice(['error', 'error', 'ok'])}"))
    parsed = parse_lines(spark.createDataFrame(rows, SCHEMA), CONFIG)
    errors = [tuple(r) for r in parsed.filter("is_error").select("source", "ts_us", "line_number").collect()]
    wanted = Counter()
    for source, end in {(s, t) for s, t, _ in errors}:
        inside = [n for s, t, n in errors if s == source and end - 60_000_000 < t <= end]
        if len(inside) >= 3:
            wanted[source, end, len(inside), min(inside), max(inside)] += 1
    found = signals.error_density(parsed, 60, 3)
    assert Counter(map(tuple, found.select("source", "end_us", "error_lines", "first_line", "last_line").collect())) == wanted
    ends = {s: sorted(t for x, t, *_ in wanted if x == s) for s in ("a", "b")}
    firsts = sum(1 + sum(b - a >= 60_000_000 for a, b in zip(own, own[1:])) for own in ends.values())
    stretches = signals.dense_stretches(parsed, 60, 3).collect()
    assert len(stretches) == firsts and sum(r["moments"] for r in stretches) == sum(wanted.values())


@pytest.mark.parametrize("block", [1, 3, 1_000])
def test_years_stay(spark, block):
    stamps = ["Dec 30 10:00:00", "Jan 2 10:00:00", "none", "Feb 29 10:00:00", "Dec 31 23:00:00", "2026-01-01 00:00:00", "Jan 1 00:00:05"]
    stamps += ["Jan 5 01:02:03", "Dec 1 00:00:00", "", "Jan 1 00:00:00"]
    config = replace(CONFIG, rollover="sticky", block_lines=block)
    lines = spark.createDataFrame([("s", n, t) for n, t in enumerate(stamps, 1)], SCHEMA)
    rows = rollover.applied(parse_lines(lines, config), config).orderBy("line_number").collect()
    years = [r["ts"].year if r["ts"] else None for r in rows]
    assert years == [2024, 2025, None, 2025, 2025, 2026, 2025, 2025, 2025, None, 2026]
    assert (rows[3]["ts"].month, rows[3]["ts"].day, rows[7]["ts"].hour) == (2, 28, 1)
    assert scan_lines(lines, config, exact_chain=False).stats.first()["parsed_lines"] == 9
    with pytest.raises(ValueError):
        replace(CONFIG, rollover="other")
