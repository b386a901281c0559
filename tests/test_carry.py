"""The block-wise stream monitor against a batch scan, over slices, replays and restarts."""

from dataclasses import replace

import pytest
from brute import random_log, scan

from tracewarden import ScanConfig, scan_lines
from tracewarden.operators import bursts, gaps
from tracewarden.streaming.carry import BURST_NAMES, CarryLog, monitor_blocks
from tracewarden.streaming.metrics import StreamMetrics

CONFIG = ScanConfig(reference_year=2024, block_lines=7)
SCHEMA = "source string, line_number bigint, line string"
LOGS = {f"log-{seed}": random_log(seed, 90) for seed in (1, 2)}
LOGS["junk"] = ["nothing", "error", ""]
LOGS["one"] = ["ERROR 2024-01-01 00:00:00 only"]
ROWS = [(name, n, text) for name, log in LOGS.items() for n, text in enumerate(log, 1)]


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def compare(spark, log, config):
    result = scan_lines(spark.createDataFrame(ROWS, SCHEMA), config)
    batch, streamed = result.gaps, gaps.with_timestamps(log.gaps())
    columns = sorted(set(batch.columns) & set(streamed.columns))
    assert "raw_context" in columns and "fingerprint" in columns
    assert same(batch.select(*columns), streamed.select(*columns))
    assert same(bursts.numbered_bursts(result.parsed, config).select(*BURST_NAMES), log.bursts().select(*BURST_NAMES))
    status = {r.source: r for r in log.status().collect()}
    for name, lines in LOGS.items():
        want, row = scan(lines), status[name]
        assert (row.total_lines, row.parsed_lines, row.error_lines) == (want["total"], want["parsed"], want["errors"])
        assert (row.error_bursts, row.gaps_detected) == (len(want["bursts"]), len(want["gaps"]))
        assert (row.first_us, row.last_us, row.final_hash) == (want["first"], want["last"], want["chain"])


@pytest.mark.parametrize("context_lines, cuts", [(2, (30, 31, 60)), (5, (11, 13, 14, 47)), (0, (40,))])
def test_slices_equal_batch(spark, tmp_path, context_lines, cuts):
    """Cuts within contexts, bursts and New Years; some sources are not in every slice."""
    config = replace(CONFIG, context_lines=context_lines)
    log = CarryLog(spark, str(tmp_path), config)
    for batch, (low, high) in enumerate(zip((0, *cuts), (*cuts, 1_000))):
        lines = spark.createDataFrame([r for r in ROWS if low < r[1] <= high], SCHEMA).repartition(3)
        log.run(lines, batch)
    compare(spark, log, config)
    assert log.late().count() == 0


def test_a_source_that_pauses_reports_no_gap_again(spark, tmp_path):
    """Gaps between the kept lines of a source that is not in a micro-batch, or has nothing but late lines there."""
    logs = {"on": 6, "pauses": 6, "ends": 3}
    texts = [(name, n, f"2024-01-{n:02d} 00:00:00 x") for name, count in logs.items() for n in range(1, count + 1)]
    slices = [
        [r for r in texts if r[1] <= 3],
        [r for r in texts if r[0] == "on" and r[1] == 4],
        [r for r in texts if r[0] == "on" and r[1] == 5] + [("ends", 2, "late")],
        [r for r in texts if r[1] == 6 or r[0] == "pauses" and r[1] in (4, 5)],
    ]
    log = CarryLog(spark, str(tmp_path), CONFIG)
    for batch, rows in enumerate(slices):
        log.run(spark.createDataFrame(rows, SCHEMA), batch)
    found = sorted((r.source, r.gap_number, r.line_number_end, len(r.raw_context.before)) for r in log.gaps().collect())
    assert found == sorted((name, n, n + 1, min(n, 2)) for name, count in logs.items() for n in range(1, count))
    assert {r.source: r.gaps_detected for r in log.status().collect()} == {"on": 5, "pauses": 5, "ends": 2}


def test_restart_after_a_failure_and_late_lines(spark, tmp_path):
    """The second micro-batch fails after it has written a part of its tables, and is run again."""
    feed, log = f"{tmp_path}/feed", CarryLog(spark, f"{tmp_path}/log", CONFIG)
    late = [("log-1", 5, "2024-01-01 00:00:00 too late"), ("log-1", 70, "again"), ("log-1", 70, "again")]
    slices = [[r for r in ROWS if r[1] <= 37], [r for r in ROWS if 37 < r[1] <= 60], [r for r in ROWS if r[1] > 60] + late]
    for n, rows in enumerate(slices):
        spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(SCHEMA).parquet(feed)
        if n == 1:
            broken = CarryLog(spark, f"{tmp_path}/log", CONFIG)
            original = broken.run
            broken.run = lambda lines, batch: (original(lines.limit(9), batch), 1 / 0)
            with pytest.raises(Exception):
                monitor_blocks(stream, broken, f"{tmp_path}/state").awaitTermination()
            stream = spark.readStream.schema(SCHEMA).parquet(feed)
        monitor_blocks(stream, log, f"{tmp_path}/state").awaitTermination()
    found = sorted((r.source, r.line_number) for r in log.late().collect())
    assert found == [("log-1", 5), ("log-1", 70), ("log-1", 70)]
    status = {r.source: r for r in log.status().collect()}
    assert status["log-2"].final_hash == scan(LOGS["log-2"])["chain"]
    assert status["log-1"].total_lines == len(LOGS["log-1"])
    progress = log.progress().collect()
    assert sum(r.lines for r in progress) == sum(map(len, LOGS.values()))
    assert {(r.batch, r.late) for r in progress if r.late} == {(2, 3)}


def test_listener_hears_every_batch(spark, tmp_path):
    """A batch that failed and was run again has one row; its sums are those of the input."""
    seen, log, feed = StreamMetrics(), CarryLog(spark, f"{tmp_path}/log", CONFIG, exact_chain=False), f"{tmp_path}/feed"
    spark.streams.addListener(seen)
    try:
        for n, (low, high) in enumerate(((0, 40), (40, 1_000))):
            rows = [r for r in ROWS if low < r[1] <= high]
            spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(feed)
            stream = spark.readStream.schema(SCHEMA).parquet(feed)
            if n:
                broken = CarryLog(spark, f"{tmp_path}/log", CONFIG, exact_chain=False)
                broken.run = lambda lines, batch: (lines.count(), 1 / 0)
                with pytest.raises(Exception):
                    monitor_blocks(stream, broken, f"{tmp_path}/state").awaitTermination()
            query = monitor_blocks(spark.readStream.schema(SCHEMA).parquet(feed), log, f"{tmp_path}/state")
            query.awaitTermination()
            seen.wait_for(query.runId)
    finally:
        spark.streams.removeListener(seen)
    heard = sorted(seen.table(spark).collect(), key=lambda r: r.batch)
    assert [r.batch for r in heard] == [0, 1] and len({r.query for r in heard}) == 1
    assert sum(r.lines for r in heard) == len(ROWS)
    assert sum(r.bytes for r in heard) == sum(len(text.encode()) for _, _, text in ROWS)
    assert all(r.seconds > 0 and r.lines_per_second > 0 for r in heard)
