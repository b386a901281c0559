"""Timestamp recognition as SQL expressions.

Functions here and in ``scoring`` take and return SQL text (use ``F.expr`` for a Column): one
expression reaches the JVM in one call, and a later expression of the same select may name
an earlier one.

Instants are carried as ``ts_us``: microseconds since 1970-01-01 of the naive (UTC for
zoned stamps) wall clock. Casting ``'<local>Z'`` makes that independent of the session
time zone, keeps every later comparison in 8-byte integer arithmetic and is what the
ordered operators shuffle; ``ts`` (TIMESTAMP_NTZ) is derived from it for output.

Rule for a line: the parsers are tried in order, each on its first match only; when that
match does not convert, the next parser is tried. Every step is guarded by the results
before it, so a line that the first parser accepts never reaches the other patterns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.config import ScanConfig
from tracewarden.functions.custom_format import compile_format

DAY_US = 86_400_000_000
MIN_US = -62_135_596_800_000_000  # 0001-01-01 00:00:00
MAX_US = 253_402_300_799_999_999  # 9999-12-31 23:59:59.999999

# The recognised layouts, in the order in which they are tried.
LAYOUTS = {
    "ISO8601": r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:?\d{2})?",
    "ISO_SPACE": r"\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?",
    "SLASH": r"\d{4}/\d{2}/\d{2}\s+\d{2}:\d{2}:\d{2}",
    "APACHE": r"\d{1,2}/[A-Za-z]{3}/\d{4}:\d{2}:\d{2}:\d{2}",
    "SYSLOG": r"[A-Z][a-z]{2}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2}",
}


def first_match(text: str, pattern: str) -> str:
    """First match of ``pattern``; empty string when there is none."""
    return f"regexp_extract({text}, r'{pattern}', 0)"


def civil_us(local: str) -> str:
    """Microseconds of ``yyyy-MM-dd HH:mm:ss[.ffffff]`` text (or with a T); NULL if not a real instant."""
    return (
        f"CASE WHEN NOT startswith({local}, '0000') "
        f"THEN unix_micros(try_cast(concat({local}, 'Z') AS TIMESTAMP)) END"
    )


def named_month_us(text: str, pattern: str) -> str:
    """Microseconds of text with an English month name in any case."""
    return f"unix_micros(try_to_timestamp(concat({text}, 'Z'), '{pattern}X'))"


def _iso8601(raw: str) -> dict[str, str]:
    minutes = "substring(__zone, 2, 2) * 60 + substring(__zone, -2, 2)"
    return {
        "__zone": f"CASE WHEN length({raw}) > 0 THEN regexp_extract({raw}, r'[+-]\\d{{2}}:?\\d{{2}}$', 0) END",
        "__local": f"rtrim('Z', substr({raw}, 1, length({raw}) - length(__zone)))",
        "__shift": f"CASE WHEN length(__zone) > 0 THEN CAST({minutes} AS INT) ELSE 0 END",
        "__instant": f"CASE WHEN length({raw}) > 0 AND __shift < 1440 THEN {civil_us('__local')} "
        "- if(startswith(__zone, '-'), -__shift, __shift) * 60000000L END",
        # a shifted instant can leave the years 1 to 9999
        "__us_ISO8601": f"CASE WHEN __instant BETWEEN {MIN_US} AND {MAX_US} THEN __instant END",
    }


def _iso_space(raw: str) -> str:
    # exactly one separator character: the first ':' then sits at position 14
    whole = civil_us(f"concat(substring({raw}, 1, 10), ' ', substr({raw}, 12))")
    return f"CASE WHEN substring({raw}, 14, 1) = ':' THEN {whole} END"


def _slash(raw: str) -> str:
    return civil_us(f"concat(replace(substring({raw}, 1, 10), '/', '-'), ' ', substring({raw}, -8, 8))")


def _apache(raw: str) -> str:
    instant = named_month_us(raw, "d/MMM/yyyy:HH:mm:ss")
    return f"CASE WHEN substring({raw}, -13, 4) <> '0000' THEN {instant} END"


def _syslog(raw: str, reference_year: int) -> str:
    day = f"regexp_extract({raw}, r'\\d+', 0)"
    parts = f"concat_ws(' ', '{reference_year:04d}', substring({raw}, 1, 3), {day}, substring({raw}, -8, 8))"
    return named_month_us(parts, "yyyy MMM d HH:mm:ss")


def to_ntz(us: str) -> str:
    """TIMESTAMP_NTZ of ``ts_us``."""
    return f"timestampadd(MICROSECOND, {us}, TIMESTAMP_NTZ'1970-01-01 00:00:00')"


def iso_text(us: str) -> str:
    """``yyyy-MM-ddTHH:mm:ss`` with six fraction digits only when they are not all zero; years above 9999 have all their digits."""
    text = f"CAST({to_ntz(us)} AS STRING)"
    fraction = f"if({us} % 1000000 = 0, '', concat('.', lpad(pmod({us}, 1000000), 6, '0')))"
    # the cast puts a plus sign before years of more than four digits
    return f"concat(replace(ltrim('+', substring_index({text}, '.', 1)), ' ', 'T'), {fraction})"


def hour_of(us: str) -> str:
    """Hour of day, integer arithmetic only."""
    return f"CAST(pmod({us}, {DAY_US}) div 3600000000 AS INT)"


def lift_year(us: str, is_syslog: str, previous_us: str) -> str:
    """Year-less stamps that step back from a December line to January get the next year.

    The condition looks at the unlifted predecessor: a lifted line is itself in January, so
    it can never be the December side of another lift, and ``lag`` of the raw value suffices.
    """
    here, before = to_ntz(us), to_ntz(previous_us)
    days = f"unix_date(make_date(year({before}) + 1, 1, 1)) - unix_date(make_date(year({here}), 1, 1))"
    return (
        f"CASE WHEN {is_syslog} AND {us} < {previous_us} AND month({before}) = 12 AND month({here}) = 1 "
        f"THEN {us} + ({days}) * {DAY_US} ELSE {us} END"
    )


def extract_timestamps(lines: DataFrame, config: ScanConfig, text: str = "line") -> DataFrame:
    """Add ``ts_us BIGINT, ts_raw STRING, parser STRING``; all NULL on a malformed line."""
    columns = lines.columns
    names = list(LAYOUTS)
    custom = compile_format(config.custom_format) if config.custom_format else None
    if custom and custom.convertible:
        names.insert(0, "CUSTOM")
        raw = F.regexp_extract(F.col(text), custom.search_pattern, 0)
        lines = lines.withColumn("__raw_CUSTOM", raw)
        lines = lines.withColumn("__fields", custom.fields(F.col("__raw_CUSTOM")))
        lines = lines.withColumn("__any", custom.micros(F.col("__fields")))
        lines = lines.withColumn("__us_CUSTOM", F.when(F.col("__any").between(MIN_US, MAX_US), F.col("__any")))

    convert = {
        "ISO_SPACE": _iso_space,
        "SLASH": _slash,
        "APACHE": _apache,
        "SYSLOG": lambda raw: _syslog(raw, config.reference_year),
    }
    steps: dict[str, str] = {}
    for at, name in enumerate(names):
        if name == "CUSTOM":
            continue
        raw = f"__raw_{name}"
        missed = " AND ".join(f"__us_{n} IS NULL" for n in names[:at]) or "true"
        steps[raw] = f"CASE WHEN {missed} THEN {first_match(text, LAYOUTS[name])} END"
        if name == "ISO8601":
            steps.update(_iso8601(raw))
        else:
            steps[f"__us_{name}"] = f"CASE WHEN length({raw}) > 0 THEN {convert[name](raw)} END"
    matched = lines.selectExpr("*", *[f"{sql} AS {name}" for name, sql in steps.items()])

    # one row in, one row out: the generator keeps filters on its columns above it, where a
    # plain projection would have every later filter repeat the regular expressions below
    def stamp(us: str, raw: str, parser: str) -> str:
        return f"named_struct('ts_us', {us}, 'ts_raw', {raw}, 'parser', {parser})"

    hits = " ".join(
        f"WHEN __us_{n} IS NOT NULL THEN {stamp(f'__us_{n}', f'__raw_{n}', repr(n))}" for n in names
    )
    none = stamp("CAST(NULL AS BIGINT)", "CAST(NULL AS STRING)", "CAST(NULL AS STRING)")
    return matched.selectExpr(*columns, f"inline(array(CASE {hits} ELSE {none} END))")
