"""Operators against the brute-force reading, over block sizes and partitionings."""

from dataclasses import replace

import pytest
from brute import placement, random_log, scan
from pyspark.sql import functions as F

from tracewarden import ScanConfig, scan_lines
from tracewarden.functions import scoring
from tracewarden.operators import activity, bursts, chain, context, gaps, stats
from tracewarden.operators.parsing import parse_lines

CONFIG = ScanConfig(reference_year=2024)
SCHEMA = "source string, line_number bigint, line string"
LOGS = {f"log-{seed}": random_log(seed, 160) for seed in range(4)}
LOGS["junk"] = ["nothing", "", "ERROR", "error", ""]
LOGS["one"] = ["2024-01-01 00:00:00 only"]


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(name, n, text) for name, log in LOGS.items() for n, text in enumerate(log, 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(7).cache()


@pytest.fixture(scope="module")
def expected():
    return {name: scan(log) for name, log in LOGS.items()}


def by_source(rows, *order):
    out = {}
    for row in sorted(rows, key=lambda r: (r.source, *[r[o] for o in order])):
        out.setdefault(row.source, []).append(row)
    return out


@pytest.mark.parametrize("block", [1, 2, 3, 7, 50, 100_000])
def test_gaps_for_all_block_sizes(spark, lines, expected, block):
    config = replace(CONFIG, block_lines=block)
    rows = gaps.report_rows(gaps.detect_gaps(parse_lines(lines, config), config)).collect()
    found = by_source(rows, "gap_number")
    for name, want in expected.items():
        got = found.get(name, [])
        assert len(got) == len(want["gaps"])
        for row, gap in zip(got, want["gaps"]):
            assert {k: row[k] for k in gap if k not in ("before", "after")} == {
                k: v for k, v in gap.items() if k not in ("before", "after")
            }


@pytest.mark.parametrize("block", [1, 3, 7, 100_000])
def test_bursts_for_all_block_sizes(spark, lines, expected, block):
    config = replace(CONFIG, block_lines=block)
    parsed = parse_lines(lines, config)
    counts = {r.source: r.error_bursts for r in bursts.burst_counts(parsed, config).collect()}
    table = by_source(bursts.numbered_bursts(parsed, config).collect(), "burst_number")
    for name, want in expected.items():
        assert counts.get(name, 0) == len(want["bursts"])
        got = table.get(name, [])
        assert [(r.line_number_start, r.line_number_end) for r in got] == want["bursts"]
        assert [r.burst_number for r in got] == list(range(1, len(got) + 1))


@pytest.mark.parametrize("size", [0, 1, 2, 5])
def test_context(spark, lines, size):
    config = replace(CONFIG, context_lines=size, block_lines=9)
    parsed = parse_lines(lines, config)
    found = gaps.detect_gaps(parsed, config, text=False)
    rows = by_source(context.with_context(found, lines, config).collect(), "gap_number")
    flat = context.context_lines(found, lines, config)
    sides = {(r.source, r.gap_number, r.side): r.n for r in flat.groupBy("source", "gap_number", "side").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    for name, log in LOGS.items():
        want = scan(log, context=size)["gaps"]
        for row, gap in zip(rows.get(name, []), want, strict=True):
            assert [tuple(x) for x in row.raw_context.before] == gap["before"]
            assert [tuple(x) for x in row.raw_context.after] == gap["after"]
            assert (row.line_before_gap, row.line_after_gap) == (gap["line_before_gap"], gap["line_after_gap"])
            assert row.tamper_confidence == gap["tamper_confidence"]
            assert sides.get((name, row.gap_number, "before"), 0) == len(gap["before"])
            assert sides[(name, row.gap_number, "after")] == len(gap["after"])


@pytest.mark.parametrize("chunk", [1_000, 64])
def test_sequential_chain_in_rounds(spark, lines, expected, chunk):
    config = replace(CONFIG, chain_chunk_lines=chunk)
    found = {r.source: r.final_hash for r in chain.sequential_chain(parse_lines(lines, config), config).collect()}
    assert found == {n: w["chain"] for n, w in expected.items() if w["parsed"]}


def test_segments_localise_a_change(spark, lines):
    config = replace(CONFIG, segment_lines=20)
    parsed = parse_lines(lines, config)
    stored = chain.segment_digests(parsed, config)
    stamped = [n for n, *_ in scan(LOGS["log-1"])["stamped"]]
    target = next(n for n in stamped if n > 60)
    edited = F.when(
        (F.col("source") == "log-1") & (F.col("line_number") == target), F.concat("line", F.lit("."))
    ).otherwise(F.col("line"))
    again = chain.segment_digests(parsed.withColumn("line", edited), config)
    changes = chain.compare_digests(stored, again).collect()
    assert [(r.source, r.segment, r.change) for r in changes] == [("log-1", (target - 1) // 20, "altered")]
    assert chain.compare_digests(stored, stored).count() == 0
    one, two = (chain.segmented_chain(d) for d in (stored, again))
    differing = one.join(two.withColumnRenamed("segmented_hash", "other"), "source").filter("segmented_hash <> other")
    assert [r.source for r in differing.collect()] == ["log-1"]


def test_whole_scan(spark, lines, expected):
    result = scan_lines(lines, replace(CONFIG, block_lines=13, segment_lines=40))
    stats_rows = {r.source: r for r in result.stats.collect()}
    summary = {r.source: r for r in result.summary.collect()}
    assert set(summary) == set(LOGS)
    for name, want in expected.items():
        row, top = stats_rows[name], summary[name]
        assert (row.total_lines, row.parsed_lines, row.error_lines) == (
            want["total"],
            want["parsed"],
            want["errors"],
        )
        assert row.malformed_lines == row.total_lines - row.parsed_lines
        assert (row.first_us, row.last_us, row.final_hash) == (want["first"], want["last"], want["chain"])
        assert row.gaps_detected == len(want["gaps"]) == top.total_gaps_found
        score = placement(want["gaps"], want["first"] or 0, want["last"] or 0)
        assert top.entropy_score == score
        assert top.entropy_score <= 26.27
        assert len(top.timeline) == 78
        assert ("#" in top.timeline) == bool(want["gaps"] and want["last"] > want["first"])
        if want["gaps"]:
            order = {"WARNING": 1, "SUSPICIOUS": 2, "CRITICAL": 3}
            best = max(
                want["gaps"],
                key=lambda g: (order[g["severity"]], g["duration_seconds"], g["tamper_confidence"]),
            )
            assert top.most_critical_gap.gap_number == best["gap_number"]
            assert top.highest_confidence == max(g["tamper_confidence"] for g in want["gaps"])
        else:
            assert top.most_critical_gap is None
            assert top.status_code == 0
    assert summary["junk"].risk_assessment == "LOW RISK"
    assert summary["one"].risk_assessment == "CLEAN"
    assert summary["junk"].integrity_chain.final_hash == "0" * 64


def test_severity_filter_keeps_numbers_and_lowers_risk(spark, lines, expected):
    result = scan_lines(lines, replace(CONFIG, min_severity="CRITICAL"), exact_chain=False)
    got = {(r.source, r.gap_number) for r in result.gaps.collect()}
    assert got == {
        (n, g["gap_number"]) for n, w in expected.items() for g in w["gaps"] if g["severity"] == "CRITICAL"
    }
    for row in result.summary.collect():
        assert row.gap_count_all == len(expected[row.source]["gaps"])
        assert row.severity_breakdown.WARNING == 0


def test_threshold_is_strict(spark):
    texts = ["2024-01-01 00:00:00", "2024-01-01 00:05:00", "2024-01-01 00:10:00.000001"]
    rows = spark.createDataFrame([("s", n, t) for n, t in enumerate(texts, 1)], SCHEMA)
    found = gaps.detect_gaps(parse_lines(rows, CONFIG), CONFIG).collect()
    assert [r.line_number_end for r in found] == [3]
    assert [found[0].duration_seconds, found[0].duration_human] == [300, "5m 0s"]


def test_scoring_edges(spark):
    def one(sql):
        return spark.range(1).selectExpr(f"{sql} AS v").first().v

    assert [one(scoring.severity(str(us))) for us in (1_799_999_999, 1_800_000_000, 7_200_000_000, 7_200_000_001)] == [
        "WARNING",
        "SUSPICIOUS",
        "SUSPICIOUS",
        "CRITICAL",
    ]
    assert [one(scoring.whole_seconds(f"{us}L")) for us in (500_000, 1_500_000, 2_500_001)] == [0, 2, 3]
    assert [one(scoring.human_duration(f"{s}L")) for s in (59, 60, 3600, 100_000)] == [
        "59s",
        "1m 0s",
        "1h 0m 0s",
        "27h 46m 40s",
    ]
    assert one(scoring.round2("62.845D")) == round(62.845, 2) == 62.84
    assert one(scoring.truncate_text("'abcdefgh'", 7)) == "abcd..."
    assert one(scoring.truncate_text("'abcdefg'", 7)) == "abcdefg"


@pytest.mark.parametrize(
    "warning, suspicious, critical, score, confidence, bursts_seen, label",
    [
        (0, 0, 0, 0.0, 0.0, 0, "CLEAN"),
        (0, 0, 0, 0.0, 0.0, 1, "LOW RISK"),
        (1, 0, 0, 0.0, 91.99, 9, "LOW RISK"),
        (1, 0, 0, 0.0, 92.0, 0, "COMPROMISED"),
        (0, 0, 2, 0.0, 10.0, 0, "COMPROMISED"),
        (0, 0, 1, 0.0, 10.0, 0, "HIGH RISK"),
        (0, 3, 0, 0.0, 10.0, 0, "HIGH RISK"),
        (1, 0, 0, 70.0, 10.0, 0, "HIGH RISK"),
        (0, 0, 0, 0.0, 0.0, 25, "HIGH RISK"),
        (0, 1, 0, 0.0, 10.0, 0, "MODERATE RISK"),
        (5, 0, 0, 45.0, 10.0, 0, "MODERATE RISK"),
        (4, 0, 0, 45.0, 10.0, 0, "LOW RISK"),
        (0, 0, 0, 0.0, 0.0, 10, "MODERATE RISK"),
    ],
)
def test_risk_levels(spark, warning, suspicious, critical, score, confidence, bursts_seen, label):
    sql = scoring.risk_level(
        str(warning), str(suspicious), str(critical), f"{score}D", f"{confidence}D", str(bursts_seen)
    )
    assert spark.range(1).selectExpr(f"{sql} AS v").first().v == label


def test_activity_periods(spark, lines, expected):
    found = by_source(activity.activity_periods(parse_lines(lines, CONFIG), 300.0).collect(), "first_us")
    from brute import find_stamp, us

    for name, log in LOGS.items():
        times = sorted(us(t) for t in (find_stamp(x, 2024)[0] for x in log) if t)
        periods = []
        for t in times:
            if periods and t - periods[-1][1] <= 300_000_000:
                periods[-1][1] = t
                periods[-1][2] += 1
            else:
                periods.append([t, t, 1])
        assert [[r.first_us, r.last_us, r.line_count] for r in found.get(name, [])] == periods


@pytest.mark.parametrize(
    "bad",
    [
        {"threshold_seconds": 0},
        {"threshold_seconds": -1.0},
        {"context_lines": -1},
        {"min_severity": "LOW"},
        {"block_lines": 0},
        {"error_words": ()},
    ],
)
def test_config_is_checked(bad):
    with pytest.raises(ValueError):
        ScanConfig(**bad)


@pytest.mark.parametrize("first_number", [0, 1])
@pytest.mark.parametrize("chunk", [1, 3, 7, 100])
def test_chain_rounds_with_sources_of_unlike_length(spark, first_number, chunk):
    """Short sources leave early, numbers may start at 0, and neither changes a digest."""
    import hashlib

    from tracewarden.operators.chain import sequential_chain

    lengths = {"a": 20, "b": 1, "c": 7, "d": 8}
    rows = [(s, n + first_number, f"{s} line {n}", 1) for s, size in lengths.items() for n in range(size)]
    parsed = spark.createDataFrame(rows, "source string, line_number bigint, line string, ts_us bigint")
    found = dict(map(tuple, sequential_chain(parsed, ScanConfig(chain_chunk_lines=chunk)).collect()))
    for source, size in lengths.items():
        digest = "0" * 64
        for n in range(size):
            digest = hashlib.sha256(f"{source} line {n}{digest}".encode()).hexdigest()
        assert found[source] == digest


@pytest.mark.parametrize("numbers", [(0, 1, 2), (1, 3, 7), (2, 3, 4)])
def test_line_numbers_with_holes_are_refused(spark, numbers):
    rows = [("a", n, "error") for n in numbers]
    with pytest.raises(ValueError, match="numbered"):
        scan_lines(spark.createDataFrame(rows, "source string, line_number bigint, line string"), CONFIG)


def test_rounds_of_the_chain_are_few(spark, monkeypatch):
    """Rounds of one line at first: a job for each line would be 300 of them."""
    import hashlib

    staged = []
    write = chain.stage
    monkeypatch.setattr(chain, "stage", lambda rows, name: staged.append(name) or write(rows, name))
    rows = [("a", n, f"line {n}", 1) for n in range(1, 301)] + [("b", 1, "one", 1)]
    parsed = spark.createDataFrame(rows, "source string, line_number bigint, line string, ts_us bigint")
    found = dict(map(tuple, chain.sequential_chain(parsed, ScanConfig(chain_chunk_lines=1)).collect()))
    digest = "0" * 64
    for n in range(1, 301):
        digest = hashlib.sha256(f"line {n}{digest}".encode()).hexdigest()
    assert found == {"a": digest, "b": hashlib.sha256(("one" + "0" * 64).encode()).hexdigest()}
    assert len(staged) < 15


def test_rounds_stop_growing(monkeypatch):
    monkeypatch.setattr(chain, "ROUND_LINES", 10)
    assert chain.round_ends(3, 40) == [3, 9, 19, 29, 39, 49]
    assert chain.round_ends(25, 60) == [25, 50, 75]
    assert chain.round_ends(4, 0) == [4]


def test_sources_without_a_placed_gap_have_dots(spark):
    """A quiet source, one that ends before it starts, one that ends as it starts, and one with a gap."""
    stamps = {
        "quiet": ["2024-01-01 00:00:00", "2024-01-01 00:00:10"],
        "back": ["2024-01-02 00:00:00", "2024-01-02 01:00:00", "2024-01-01 00:00:00"],
        "same": ["2024-01-01 00:00:00", "2024-01-01 01:00:00", "2024-01-01 00:00:00"],
        "gap": ["2024-01-01 00:00:00", "2024-01-01 01:00:00"],
        "none": ["x"],
    }
    rows = [(s, n, t) for s, own in stamps.items() for n, t in enumerate(own, 1)]
    lines = spark.createDataFrame(rows, "source string, line_number bigint, line string")
    result = scan_lines(lines, CONFIG, exact_chain=False)
    drawn = dict(map(tuple, stats.timelines(result._profile, lines.select("source").distinct()).collect()))
    assert drawn == {s: ("#" if s == "gap" else ".") * 78 for s in stamps}


def test_timelines_of_a_table_with_quiet_sources(spark, tmp_path):
    """The registered query: events of two users, of whom one has no gap."""
    from tracewarden.queries.catalog import QUERIES

    at = [("2024-01-01 00:00:00", 0), ("2024-01-01 00:00:01", 1), ("2024-01-01 00:00:02", 1), ("2024-01-01 02:00:00", 0)]
    rows = [(n + 1, t, user, "view", 1.0, "{}") for n, (t, user) in enumerate(at)]
    events = spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(str(tmp_path / "events.parquet"))
    drawn = dict(map(tuple, QUERIES["timelines"](spark, str(tmp_path)).collect()))
    assert drawn == {"svc-0": "#" * 78, "svc-1": "." * 78}
