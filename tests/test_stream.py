import os
import time

from brute import random_log, scan

from tracewarden import ScanConfig
from tracewarden.operators import gaps
from tracewarden.operators.parsing import parse_lines
from tracewarden.streaming import files, monitor, silence

CONFIG = ScanConfig(reference_year=2024)
SCHEMA = "source string, line_number bigint, line string"
LOGS = {f"log-{seed}": random_log(seed, 90) for seed in (1, 3)}
LOGS["junk"] = ["nothing", "error", ""]


def _feed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(2).write.mode("append").parquet(folder)


def _advance(spark, base):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/feed")
    query = (
        monitor.monitor_stream(stream, CONFIG)
        .writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def test_monitor_equals_batch_over_restarts(spark, tmp_path):
    base = str(tmp_path)
    rows = [(name, n, text) for name, log in LOGS.items() for n, text in enumerate(log, 1)]
    with monitor.rocksdb_state(spark):
        for low, high in ((0, 37), (37, 38), (38, 1000)):
            _feed(spark, f"{base}/feed", [r for r in rows if low < r[1] <= high])
            _advance(spark, base)
        _feed(spark, f"{base}/feed", [("log-1", 5, "2024-01-01 00:00:00 too late")])
        _advance(spark, base)
    out = spark.read.parquet(f"{base}/out")

    streamed = gaps.report_rows(monitor.monitor_gaps(out, CONFIG))
    batch = gaps.report_rows(gaps.detect_gaps(parse_lines(spark.createDataFrame(rows, SCHEMA), CONFIG), CONFIG))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0

    status = {r.source: r for r in monitor.monitor_status(out).collect()}
    for name, log in LOGS.items():
        want = scan(log)
        row = status[name]
        assert (row.total_lines, row.parsed_lines, row.error_lines, row.error_bursts) == (
            want["total"],
            want["parsed"],
            want["errors"],
            len(want["bursts"]),
        )
        assert (row.first_us, row.last_us, row.final_hash) == (want["first"], want["last"], want["chain"])
        assert row.gaps_detected == len(want["gaps"])
    late = monitor.monitor_late(out).collect()
    assert [(r.source, r.line_number, r.reason) for r in late] == [("log-1", 5, "late")]


def test_watched_folder_scans_each_file_once(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    found = {}

    def handle(result, batch_id):
        for row in result.summary.collect():
            name = os.path.basename(row.source)
            assert name not in found
            found[name] = (row.total_gaps_found, row.integrity_chain.final_hash)

    for names in (["log-1"], ["log-3", "junk"]):
        for name in names:
            (inbox / name).write_text("\n".join(LOGS[name]))
        files.watch_folder(spark, str(inbox), CONFIG, handle, str(tmp_path / "state")).awaitTermination()
    assert found == {name: (len(w["gaps"]), w["chain"]) for name, w in ((n, scan(x)) for n, x in LOGS.items())}


def test_folder_is_watched_until_stopped(spark, tmp_path):
    """Files that come while the query runs are scanned without a new start."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    found = {}

    def handle(result, batch_id):
        found.update({os.path.basename(r.source): r.total_gaps_found for r in result.summary.collect()})

    query = files.watch_folder(spark, str(inbox), CONFIG, handle, str(tmp_path / "state"), every="1 second")
    try:
        for name in ("log-1", "log-3"):
            (tmp_path / name).write_text("\n".join(LOGS[name]))
            os.rename(tmp_path / name, inbox / name)  # arrives whole
            end = time.monotonic() + 90
            while name not in found and time.monotonic() < end:
                time.sleep(0.2)
            assert query.isActive and found[name] == len(scan(LOGS[name])["gaps"])
    finally:
        query.stop()


def test_activity_stream_closes_sessions_behind_the_watermark(spark, tmp_path):
    base = str(tmp_path)
    texts = ["2024-01-01 00:00:00", "2024-01-01 00:05:00", "2024-01-01 00:10:00.000001", "2024-01-02 00:00:00"]
    _feed(spark, f"{base}/feed", [("s", n, t) for n, t in enumerate(texts, 1)])
    parsed = parse_lines(spark.readStream.schema(SCHEMA).parquet(f"{base}/feed"), CONFIG)
    query = (
        silence.activity_stream(parsed, 300.0, "10 minutes")
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rows = spark.read.parquet(f"{base}/out").orderBy("first_ts").collect()
    assert [r.line_count for r in rows] == [2, 1]
