import os

from brute import random_log, scan
from pyspark.sql import functions as F

from tracewarden import ScanConfig, scan_files
from tracewarden.sources.tables import lines_from_table
from tracewarden.sources.text import file_facts, scan_parsed_text, scan_text


def _write(folder, name, data: bytes):
    path = os.path.join(folder, name)
    with open(path, "wb") as out:
        out.write(data)
    return path


def _lines(df, path):
    rows = df.filter(F.col("source").endswith(os.path.basename(path))).orderBy("line_number").collect()
    assert [r.line_number for r in rows] == list(range(1, len(rows) + 1))
    return [r.line for r in rows]


def test_line_rules(spark, tmp_path):
    data = b"one\r\ntwo\rstill two\n\n  \nbad \x61\xff\xfe\xe2\x82\x62\nlast\r\r"
    path = _write(tmp_path, "a.log", data)
    want = [raw.decode("utf-8", errors="replace").rstrip("\r") for raw in data.split(b"\n")]
    assert _lines(scan_text(spark, path), path) == want
    ended = _write(tmp_path, "b.log", b"x\ny\n")
    assert _lines(scan_text(spark, ended), ended) == ["x", "y"]


def test_numbering_over_many_splits(spark, tmp_path):
    logs = {f"log{i}.txt": [f"{i} line {n} " + "x" * (n % 50) for n in range(700)] for i in range(3)}
    paths = [_write(tmp_path, name, "\n".join(log).encode()) for name, log in logs.items()]
    _write(tmp_path, "empty.txt", b"")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        lines = scan_text(spark, str(tmp_path))
        for path in paths:
            assert _lines(lines, path) == logs[os.path.basename(path)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_file_facts_list_empty_files(spark, tmp_path):
    _write(tmp_path, "empty.log", b"")
    _write(tmp_path, "full a+b.log", b"2024-01-01 00:00:00 x\n")
    facts = {r.file_name: r.file_size for r in file_facts(spark, str(tmp_path)).collect()}
    assert facts == {"empty.log": 0, "full a+b.log": 22}


def test_scan_files_end_to_end(spark, tmp_path):
    logs = {f"s{i}.log": random_log(10 + i, 120) for i in range(3)}
    for name, log in logs.items():
        _write(tmp_path, name, "\n".join(log).encode())
    _write(tmp_path, "empty.log", b"")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        result = scan_files(spark, str(tmp_path), ScanConfig(reference_year=2024, block_lines=11))
        stats = {r.file_name: r for r in result.stats.collect()}
        summary = {os.path.basename(r.source): r for r in result.summary.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert set(stats) == {*logs, "empty.log"}
    for name, log in logs.items():
        want = scan(log)
        row = stats[name]
        assert (row.total_lines, row.parsed_lines, row.error_bursts) == (
            want["total"],
            want["parsed"],
            len(want["bursts"]),
        )
        assert row.final_hash == want["chain"]
        assert row.file_size == len("\n".join(log).encode())
        assert summary[name].total_gaps_found == len(want["gaps"])
    empty = summary["empty.log"]
    assert (empty.total_lines_scanned, empty.risk_assessment, empty.status_code) == (0, "CLEAN", 0)
    assert empty.integrity_chain.final_hash == "0" * 64
    assert empty.timeline == "." * 78


def test_parsed_scan_equals_parse_of_scan(spark, tmp_path):
    path = _write(tmp_path, "p.log", "\n".join(random_log(3, 60)).encode())
    config = ScanConfig(reference_year=2024)
    from tracewarden.operators.parsing import parse_lines

    one = scan_parsed_text(spark, path, config)
    two = parse_lines(scan_text(spark, path), config).select(*one.columns)
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_table_source_numbers_across_buckets(spark):
    rows = [(n * 3, f"k{n % 3}", f"text {n}") for n in range(200)]
    table = spark.createDataFrame(rows, "id bigint, key string, text string").repartition(5)
    lines = lines_from_table(table, "text", "key", "id", bucket_width=25)
    for key in ("k0", "k1", "k2"):
        got = lines.filter(F.col("source") == key).orderBy("line_number").collect()
        assert [r.line_number for r in got] == list(range(1, len(got) + 1))
        assert [r.line for r in got] == [t for _, k, t in rows if k == key]


def test_table_source_with_ties_and_rows_without_order(spark):
    rows = [(n // 4 if n % 10 else None, f"text {n:03}") for n in range(200)]
    want = [t for _, t in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1]))]
    for parts in (1, 7):
        table = spark.createDataFrame(rows, "id bigint, text string").repartition(parts)
        got = lines_from_table(table, "text", F.lit("k"), "id", bucket_width=5).orderBy("line_number").collect()
        assert [(r.line_number, r.line) for r in got] == list(enumerate(want, 1))


def test_byte_order_marks_stay_in_line_one(spark, tmp_path):
    """With and without a last line end, over several splits, doubled, and files that only look as if."""
    mark = b"\xef\xbb\xbf"
    body = b"\r\n".join(b"2024-01-01 00:00:%02d ERROR x%d" % (n % 60, n) for n in range(300))
    logs = {
        "a.log": mark + body,
        "b.log": mark + body + b"\n",
        "c.log": body + b"\n",
        "d.log": mark + mark + body,
        "e.log": body + b"\n" + mark + b"tail\n\n\n",
        "f.log": mark + b"\n",
        "g.log": b"\n\n\n",
        "h.log": b"one \xff\xfe\xfd",
    }
    for name, data in logs.items():
        _write(tmp_path, name, data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = scan_text(spark, str(tmp_path))
        for name, data in logs.items():
            want = [raw.decode("utf-8", errors="replace").rstrip("\r") for raw in data.split(b"\n")]
            assert _lines(found, name) == (want[:-1] if data.endswith(b"\n") else want)
        parsed = scan_parsed_text(spark, str(tmp_path / "a.log"), ScanConfig()).orderBy("line_number").head()
        assert parsed.parser == "ISO_SPACE" and parsed.is_error and parsed.line.startswith("﻿2024")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
