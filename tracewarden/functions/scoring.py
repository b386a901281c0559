"""Per-gap and per-source scoring rules as SQL expressions (text in, text out)."""

from __future__ import annotations

from tracewarden.config import RISK_LABELS, SEVERITIES
from tracewarden.functions.timestamps import hour_of, iso_text

TIMELINE_WIDTH = 78


def seconds_of(us: str) -> str:
    return f"({us} / 1000000D)"


def round2(value: str) -> str:
    """Two decimals, half-even on the exact binary value."""
    return f"CAST(format_number({value}, '0.00') AS DOUBLE)"


def half_even_div(value: str, divisor: int) -> str:
    """Non-negative integer division rounded half to even, exact in BIGINT."""
    whole, twice = f"({value} div {divisor})", f"(pmod({value}, {divisor}) * 2)"
    up = f"{twice} > {divisor} OR ({twice} = {divisor} AND pmod({whole}, 2) = 1)"
    return f"({whole} + if({up}, 1L, 0L))"


def severity(delta_us: str) -> str:
    seconds = seconds_of(delta_us)
    return (
        f"CASE WHEN {seconds} > 7200 THEN '{SEVERITIES[2]}' "
        f"WHEN {seconds} >= 1800 THEN '{SEVERITIES[1]}' ELSE '{SEVERITIES[0]}' END"
    )


def severity_rank(name: str) -> str:
    return f"array_position(array({', '.join(repr(s) for s in SEVERITIES)}), {name})"


def whole_seconds(delta_us: str) -> str:
    return half_even_div(delta_us, 1_000_000)


def human_duration(total: str) -> str:
    """``2h 17m 39s``; hours do not wrap into days. ``total`` is whole seconds."""
    hours, minutes, seconds = f"{total} div 3600", f"pmod({total}, 3600) div 60", f"pmod({total}, 60)"
    return (
        f"concat(if({total} >= 3600, concat({hours}, 'h '), ''), "
        f"if({total} >= 60, concat({minutes}, 'm '), ''), {seconds}, 's')"
    )


def fingerprint(start_us: str, end_us: str, first: str, last: str, total: str) -> str:
    return f"md5(concat_ws('|', {iso_text(start_us)}, {iso_text(end_us)}, {first}, {last}, {total}))"


def midpoint_hour(start_us: str, delta_us: str) -> str:
    return hour_of(f"({start_us} + {half_even_div(delta_us, 2)})")


def tamper_confidence(
    delta_us: str, line_distance: str, mid_hour: str, threshold: float, context_lines: int
) -> str:
    """0..100, the sum of a duration, a density, an hour and a context part."""
    seconds = seconds_of(delta_us)
    base = f"least(58D, {seconds} / {max(1.0, threshold)!r}D * 10.5D)"
    duration = f"if({seconds} > 7200, least(65D, {base} + 8D), {base})"
    density = (
        f"CASE WHEN {line_distance} <= 2 THEN 16D WHEN {line_distance} <= 5 THEN 12D "
        f"WHEN {line_distance} <= 20 THEN 7D ELSE 3D END"
    )
    hour = f"CASE WHEN {mid_hour} <= 4 THEN 14D WHEN {mid_hour} IN (5, 22, 23) THEN 8D ELSE 3D END"
    # the closing line is always known; the opening side is missing only without context
    context = "6D" if context_lines > 0 else "2D"
    return round2(f"least(100D, {duration} + {density} + {hour} + {context})")


def placement_bins(gap_count: str) -> str:
    """Histogram width for a number of gaps: twice the count, kept within 5..20."""
    return f"CAST(greatest(5L, least(20L, {gap_count} * 2)) AS INT)"


def placement_bin(offset_us: str, span_us: str, bins: str) -> str:
    share = f"least(greatest({seconds_of(offset_us)} / {seconds_of(span_us)}, 0D), 1D)"
    return f"least({bins} - 1, CAST({share} * {bins} AS INT))"


def timeline_cell(offset_us: str, span_us: str, width: int = TIMELINE_WIDTH) -> str:
    place = f"{seconds_of(offset_us)} / {seconds_of(span_us)} * {width - 1}"
    # clamped before the cast, which truncates toward zero and must not overflow
    return f"CAST(greatest(0D, least({width - 1}D, {place})) AS INT)"


def divergence_term(share: str, bins: str) -> str:
    """One occupied bin's part of the Jensen-Shannon divergence against a uniform spread."""
    even, middle = f"(1D / {bins})", f"(({share} + 1D / {bins}) / 2D)"
    return f"0.5D * {share} * log2({share} / {middle}) + 0.5D * {even} * log2({even} / {middle})"


def placement_score(divergence: str, occupied: str, bins: str) -> str:
    """0 (even) .. 100 from the occupied bins' terms; an empty bin adds half its even share."""
    total = f"({divergence} + ({bins} - {occupied}) * (0.5D / {bins}))"
    return round2(f"least(1D, greatest(0D, {total} / log2({bins}))) * 100D")


def risk_level(
    warning: str, suspicious: str, critical: str, score: str, confidence: str, bursts: str
) -> str:
    clean, low, moderate, high, compromised = (f"'{label}'" for label in RISK_LABELS)
    return (
        f"CASE WHEN {warning} + {suspicious} + {critical} + {bursts} = 0 THEN {clean} "
        f"WHEN {critical} >= 2 OR {confidence} >= 92D THEN {compromised} "
        f"WHEN {critical} >= 1 OR {suspicious} >= 3 OR {score} >= 70D OR {bursts} >= 25 THEN {high} "
        f"WHEN {suspicious} >= 1 OR ({warning} >= 5 AND {score} >= 45D) OR {bursts} >= 10 THEN {moderate} "
        f"ELSE {low} END"
    )


def status_code(warning: str, suspicious: str, critical: str) -> str:
    return f"CASE WHEN {suspicious} + {critical} > 0 THEN 2 WHEN {warning} > 0 THEN 1 ELSE 0 END"


def truncate_text(value: str, limit: int = 140) -> str:
    return f"if(length({value}) <= {limit}, {value}, concat(substring({value}, 1, {limit - 3}), '...'))"
