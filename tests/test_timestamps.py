import datetime as dt
import warnings

import pytest
from brute import find_stamp, us
from pyspark.sql import functions as F

from tracewarden.config import ScanConfig
from tracewarden.functions.custom_format import compile_format
from tracewarden.operators.parsing import parse_lines

CASES = [
    ("2026-01-01T10:00:00.1+0530 x", "ISO8601", "2026-01-01T04:30:00.100000"),
    ("2026-01-01T10:00:00Z", "ISO8601", "2026-01-01T10:00:00"),
    ("2026-01-01T10:00:00.1234567Z", "ISO8601", "2026-01-01T10:00:00.123456"),
    ("2026-01-01T10:00:00+20:00", "ISO8601", "2025-12-31T14:00:00"),
    ("2026-01-01T10:00:00+05:99", "ISO8601", "2026-01-01T03:21:00"),
    ("2026-01-01T10:00:00+24:00", None, None),
    ("0001-01-01T00:00:00+01:00", None, None),
    ("9999-12-31T23:59:59-01:00", None, None),
    ("2026-01-01 10:00:00 at 2025-05-05T01:00:00Z", "ISO8601", "2025-05-05T01:00:00"),
    ("2026-01-01\t10:00:00", "ISO_SPACE", "2026-01-01T10:00:00"),
    ("2026-01-01 10:00:00.5 x", "ISO_SPACE", "2026-01-01T10:00:00.500000"),
    ("2026-01-01  10:00:00", None, None),
    ("2024-99-99 25:61:99 then 2026-01-01 10:00:00", None, None),
    ("2024-99-99 25:61:99 2026/01/01 10:00:00", "SLASH", "2026-01-01T10:00:00"),
    ("2026/01/01   10:00:00", "SLASH", "2026-01-01T10:00:00"),
    ("2026/02/30 10:00:00", None, None),
    ("1.2.3.4 [05/jan/2026:10:00:00 +0200]", "APACHE", "2026-01-05T10:00:00"),
    ("[5/Jan/2026:10:00:00]", "APACHE", "2026-01-05T10:00:00"),
    ("[05/Foo/2026:10:00:00]", None, None),
    ("[00/Jan/2026:10:00:00] Mar 5 10:00:00", "SYSLOG", "2026-03-05T10:00:00"),
    ("Mar  5 10:00:00 host x", "SYSLOG", "2026-03-05T10:00:00"),
    ("Mar\t5  10:00:00 host x", "SYSLOG", "2026-03-05T10:00:00"),
    ("Feb 29 10:00:00", None, None),
    ("Xyz 29 10:00:00", None, None),
    ("2026-01-01 23:59:60", None, None),
    ("2026-01-01T24:00:00", None, None),
    ("0000-01-01 00:00:00", None, None),
    ("0000-01-01T00:00:00", None, None),
    ("0000/01/01 00:00:00", None, None),
    ("[05/Jan/0000:10:00:00]", None, None),
    ("0001-01-01 00:00:00", "ISO_SPACE", "0001-01-01T00:00:00"),
    ("", None, None),
    ("   ", None, None),
]


def _parse(spark, texts, config):
    rows = [("s", n, text) for n, text in enumerate(texts, 1)]
    parsed = parse_lines(spark.createDataFrame(rows, "source string, line_number bigint, line string"), config)
    return parsed.orderBy("line_number").collect()


def test_layouts(spark):
    rows = _parse(spark, [c[0] for c in CASES], ScanConfig(reference_year=2026))
    for (text, parser, iso), row in zip(CASES, rows):
        want = dt.datetime.fromisoformat(iso) if iso else None
        assert (row.parser, row.ts) == (parser, want), text
        assert row.ts_us == (us(want) if want else None), text
        assert find_stamp(text, 2026)[::2] == (want, parser), text


def test_results_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = _parse(spark, ["2024-03-10 02:30:00.5 x"], ScanConfig())[0]
        assert row.ts == dt.datetime(2024, 3, 10, 2, 30, 0, 500000)
        assert row.ts_us == us(row.ts)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


CUSTOM = [
    ("%d.%m.%Y %H:%M:%S,%f", ["x 05.03.2024 10:00:00,5 y", "31.02.2024 10:00:00,1", "5.3.2024 1:2:3,123456"]),
    ("%Y %j", ["2025 366", "2024 060", "2024 000"]),
    ("%Y %U %w", ["2024 00 0", "2024 00 1", "2023 53 6", "2024 10 3"]),
    ("%Y %W %a", ["2024 53 Sun", "2024 01 mon", "2024 01 Xxx"]),
    ("%H %I %p", ["13 02 PM", "01 12 AM", "01 13 AM"]),
    ("%d %b %y", ["05 jan 68", "05 JAN 69", "05 Foo 69"]),
    ("%A %B %d %Y", ["Friday April 10 2026", "fryday April 10 2026"]),
    ("%Y-%m-%d %H:%M %z", ["2024-01-01 10:00 +0530", "2024-01-01 10:00 -05:30", "2024-01-01 10:00 +2400"]),
    ("%Y %Z", ["2024 UTC", "2024 XYZ"]),
    ("%Y-%m-%d%%%H", ["2024-01-01%10", "2024-01-01%25"]),
    ("%x %X end", ["04/10/26 10:00:00 end", "nothing here end"]),
    ("[%M:%S]", ["[59:59]", "[59:60]", "(59:59)"]),
    ("%m%d", ["123", "1300", "0230"]),
]


@pytest.mark.parametrize("fmt, texts", CUSTOM)
def test_custom_formats_agree_with_strptime(spark, fmt, texts):
    rows = _parse(spark, texts, ScanConfig(custom_format=fmt))
    for text, row in zip(texts, rows):
        raw = spark.range(1).select(F.regexp_extract(F.lit(text), compile_format(fmt).search_pattern, 0)).first()[0]
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                want = dt.datetime.strptime(raw, fmt) if raw else None
            if want and want.tzinfo:
                want = want.astimezone(dt.timezone.utc).replace(tzinfo=None)
        except ValueError:
            want = None
        got = row.ts if row.parser == "CUSTOM" else None
        assert got == want, (fmt, text)


def test_bad_formats_are_refused_before_any_job():
    for fmt in ("%Q", "abc %", "%"):
        with pytest.raises(ValueError):
            ScanConfig(custom_format=fmt)


def test_a_repeated_directive_never_matches(spark):
    row = _parse(spark, ["2024 2024 x 2026-01-01 10:00:00"], ScanConfig(custom_format="%Y %Y"))[0]
    assert row.parser == "ISO_SPACE"


def test_strict_pattern_runs_once_per_line(spark):
    """All directives come out of one match, and a private mark in the text is no field."""
    fmt = "%d-%b-%Y %I:%M:%S %p %z"
    texts = ["x 05-Mar-2024 01:02:03 PM +0100", "\ue000 05-Mar-2024 01:02:03 AM +0000"]
    rows = [("a", n, text) for n, text in enumerate(texts, 1)]
    lines = spark.createDataFrame(rows, "source string, line_number bigint, line string").repartition(1)
    found = parse_lines(lines, ScanConfig(custom_format=fmt))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    strict = compile_format(fmt).strict_pattern
    assert plan.count(strict) == 1
    assert [r.parser for r in found.collect()] == ["CUSTOM", "CUSTOM"]
    wild = compile_format("%x~")
    mark = wild.mark
    texts = [f"04/10/26{mark}~", "04/10/26~", "04/10/26~~", f"{mark}04{mark}10{mark}26{mark}", ""]
    raw = spark.createDataFrame([(text,) for text in texts], "raw string")
    got = [r.us is not None for r in raw.select(wild.micros(wild.fields(F.col("raw"))).alias("us")).collect()]
    assert got == [False, True, False, False, False]


def test_iso_text_of_any_year(spark):
    """Years of five digits, as sticky years may reach, keep them all and have no sign."""
    from tracewarden.functions.timestamps import iso_text

    stamps = {
        "0001-01-01 00:00:00": "0001-01-01T00:00:00",
        "1969-12-31 23:59:59.5": "1969-12-31T23:59:59.500000",
        "9999-12-31 23:59:59.999999": "9999-12-31T23:59:59.999999",
        "+10000-01-04 00:00:00": "10000-01-04T00:00:00",
        "+10932-02-29 01:02:03.000001": "10932-02-29T01:02:03.000001",
    }
    rows = spark.createDataFrame([(s,) for s in stamps], "s string").selectExpr("s", "unix_micros(CAST(s || 'Z' AS TIMESTAMP)) AS us")
    assert dict(map(tuple, rows.selectExpr("s", f"{iso_text('us')} AS text").collect())) == stamps
