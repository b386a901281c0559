"""Plain SQL statements of the same results over the same tables."""

from __future__ import annotations

ISO = "[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\\.[0-9]{1,6})?(Z|[+-][0-9]{2}:?[0-9]{2})?"
SPACE = "[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\\.[0-9]{1,6})?"
SLASH = "[0-9]{4}/[0-9]{2}/[0-9]{2}\\s+[0-9]{2}:[0-9]{2}:[0-9]{2}"
APACHE = "[0-9]{1,2}/[A-Za-z]{3}/[0-9]{4}:[0-9]{2}:[0-9]{2}:[0-9]{2}"
SYSLOG = "[A-Z][a-z]{2}\\s+[0-9]{1,2}\\s+[0-9]{2}:[0-9]{2}:[0-9]{2}"

EVENT_LINE = """
CASE WHEN event_id % 389 = 0 THEN ''
     WHEN event_id % 97 = 0 THEN 'corrupted entry'
     ELSE CASE event_id % 5
            WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
            WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
            WHEN 2 THEN strftime(ts, '%Y/%m/%d %H:%M:%S')
            WHEN 3 THEN strftime(ts, '%d/%b/%Y:%H:%M:%S')
            ELSE strftime(ts, '%b %d %H:%M:%S') END
          || ' [' || CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END || '] user='
          || user_id || ' ' || props END
"""

SERVICE_LINES = f"""
lines AS (
  SELECT 'svc-' || (user_id % 8) AS source,
         row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) AS line_number,
         {EVENT_LINE} AS line
  FROM events)"""

LABELLED_LINES = """
lines AS (
  SELECT 'host-' || (user_id % 5) AS source,
         row_number() OVER (PARTITION BY user_id % 5 ORDER BY event_id) AS line_number,
         CASE WHEN event_id % 97 = 0 THEN 'corrupted entry' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || ' [' ||
           CASE WHEN event_type = 'error' THEN 'ERROR' WHEN value > 10 THEN 'WARN' ELSE 'INFO' END
           || '] [' || event_type || '] ' || props END AS line
  FROM events)"""

SINGLE_LINES = f"""
lines AS (SELECT 'all' AS source, event_id + 1 AS line_number, {EVENT_LINE} AS line FROM events)"""

ORDER_LINES = """
lines AS (
  SELECT 'shop-' || (o_custkey % 7) AS source,
         row_number() OVER (PARTITION BY o_custkey % 7 ORDER BY o_orderkey) AS line_number,
         strftime(o_orderdate, '%b %-d %H:%M:%S') || ' order ' || o_orderkey || ' ' || o_orderpriority AS line
  FROM orders)"""

PARSED = f"""
raw AS (
  SELECT *, regexp_extract(line, '{ISO}') AS r1, regexp_extract(line, '{SPACE}') AS r2,
         regexp_extract(line, '{SLASH}') AS r3, regexp_extract(line, '{APACHE}') AS r4,
         regexp_extract(line, '{SYSLOG}') AS r5
  FROM lines),
converted AS (
  SELECT *, try_cast(regexp_replace(r1, 'Z$', '') AS TIMESTAMP) AS t1, try_cast(r2 AS TIMESTAMP) AS t2,
         try_strptime(r3, '%Y/%m/%d %H:%M:%S') AS t3, try_strptime(r4, '%d/%b/%Y:%H:%M:%S') AS t4,
         try_strptime('2024 ' || r5, '%Y %b %d %H:%M:%S') AS t5
  FROM raw),
parsed AS (
  SELECT source, line_number, line,
         CAST(coalesce(t1, t2, t3, t4, t5) AS TIMESTAMP) AS ts,
         CASE WHEN t1 IS NOT NULL THEN r1 WHEN t2 IS NOT NULL THEN r2 WHEN t3 IS NOT NULL THEN r3
              WHEN t4 IS NOT NULL THEN r4 WHEN t5 IS NOT NULL THEN r5 END AS ts_raw,
         CASE WHEN t1 IS NOT NULL THEN 'ISO8601' WHEN t2 IS NOT NULL THEN 'ISO_SPACE'
              WHEN t3 IS NOT NULL THEN 'SLASH' WHEN t4 IS NOT NULL THEN 'APACHE'
              WHEN t5 IS NOT NULL THEN 'SYSLOG' END AS parser,
         regexp_matches(lower(line), 'error|exception|traceback|critical|fatal|fail|panic|alert|denied') AS is_error
  FROM converted)"""

STEPS = """
raw_steps AS (
  SELECT *, lag(ts) OVER w AS p1 FROM parsed WHERE ts IS NOT NULL
  WINDOW w AS (PARTITION BY source ORDER BY line_number)),
lifted AS (
  SELECT source, line_number, line, parser,
         CASE WHEN parser = 'SYSLOG' AND ts < p1 AND month(p1) = 12 AND month(ts) = 1
              THEN make_timestamp(year(p1) + 1, 1, day(ts), hour(ts), minute(ts), second(ts)) ELSE ts END AS ts
  FROM raw_steps),
steps AS (
  SELECT source, line_number, line, ts,
         lag(ts) OVER w AS prev_ts, lag(line_number) OVER w AS prev_number, lag(line) OVER w AS prev_line,
         epoch_us(ts) - epoch_us(lag(ts) OVER w) AS delta_us
  FROM lifted WINDOW w AS (PARTITION BY source ORDER BY line_number))"""


def iso(column: str) -> str:
    return (
        f"CASE WHEN epoch_us({column}) % 1000000 = 0 THEN strftime({column}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') END"
    )


GAPS = f"""
edges AS (
  SELECT *, delta_us / 1000000.0::DOUBLE AS secs,
         CAST(round_even(delta_us / 1000000.0::DOUBLE, 0) AS BIGINT) AS total,
         greatest(1, line_number - prev_number) AS line_distance,
         hour(prev_ts + to_microseconds(CAST(round_even(delta_us / 2.0::DOUBLE, 0) AS BIGINT))) AS mid_hour,
         row_number() OVER (PARTITION BY source ORDER BY line_number) AS gap_number
  FROM steps WHERE delta_us > 300000000),
scored AS (
  SELECT *,
         CASE WHEN secs > 7200 THEN 'CRITICAL' WHEN secs >= 1800 THEN 'SUSPICIOUS' ELSE 'WARNING' END AS severity,
         CASE WHEN secs > 7200 THEN 3 WHEN secs >= 1800 THEN 2 ELSE 1 END AS severity_rank,
         least(58.0::DOUBLE, secs / 300.0::DOUBLE * 10.5::DOUBLE) AS base
  FROM edges),
gaps AS (
  SELECT source, gap_number, severity, severity_rank, prev_ts, ts, line_distance, mid_hour,
         {iso('prev_ts')} AS gap_start, {iso('ts')} AS gap_end,
         total AS duration_seconds,
         CASE WHEN total >= 3600
              THEN (total // 3600) || 'h ' || (total % 3600 // 60) || 'm ' || (total % 60) || 's'
              WHEN total >= 60 THEN (total // 60) || 'm ' || (total % 60) || 's'
              ELSE total || 's' END AS duration_human,
         prev_line AS line_before_gap, line AS line_after_gap,
         prev_number AS line_number_start, line_number AS line_number_end,
         printf('%.2f', least(100.0::DOUBLE,
           CASE WHEN secs > 7200 THEN least(65.0::DOUBLE, base + 8.0::DOUBLE) ELSE base END
           + CASE WHEN line_distance <= 2 THEN 16.0::DOUBLE WHEN line_distance <= 5 THEN 12.0::DOUBLE
                  WHEN line_distance <= 20 THEN 7.0::DOUBLE ELSE 3.0::DOUBLE END
           + CASE WHEN mid_hour <= 4 THEN 14.0::DOUBLE WHEN mid_hour IN (5, 22, 23) THEN 8.0::DOUBLE
                  ELSE 3.0::DOUBLE END
           + 6.0::DOUBLE))::DOUBLE AS tamper_confidence,
         md5({iso('prev_ts')} || '|' || {iso('ts')} || '|' || prev_number || '|' || line_number || '|' || total)
           AS fingerprint
  FROM scored)"""

BURSTS = """
flagged AS (
  SELECT *, coalesce(lag(is_error) OVER (PARTITION BY source ORDER BY line_number), false) AS before FROM parsed),
runs AS (
  SELECT *, sum(CASE WHEN is_error AND NOT before THEN 1 ELSE 0 END)
              OVER (PARTITION BY source ORDER BY line_number) AS run
  FROM flagged),
bursts AS (
  SELECT source, CAST(run AS BIGINT) AS burst_number, min(line_number) AS line_number_start,
         max(line_number) AS line_number_end, count(*) AS line_count,
         min_by(ts, line_number) FILTER (ts IS NOT NULL) AS first_ts,
         max_by(ts, line_number) FILTER (ts IS NOT NULL) AS last_ts
  FROM runs WHERE is_error GROUP BY source, run)"""

COUNTS = """
counts AS (
  SELECT p.source, count(*) AS total_lines, count(ts) AS parsed_lines, count(*) - count(ts) AS malformed_lines,
         count(*) FILTER (is_error) AS error_lines,
         (SELECT count(*) FROM bursts b WHERE b.source = p.source) AS error_bursts
  FROM parsed p GROUP BY p.source),
spans AS (
  SELECT source, min_by(ts, line_number) AS first_ts, max_by(ts, line_number) AS last_ts
  FROM lifted GROUP BY source)"""

TOTALS = """
totals AS (
  SELECT c.source,
         (SELECT count(*) FROM gaps g WHERE g.source = c.source) AS gap_count,
         (SELECT count(*) FROM gaps g WHERE g.source = c.source AND severity = 'WARNING') AS warning_count,
         (SELECT count(*) FROM gaps g WHERE g.source = c.source AND severity = 'SUSPICIOUS') AS suspicious_count,
         (SELECT count(*) FROM gaps g WHERE g.source = c.source AND severity = 'CRITICAL') AS critical_count,
         coalesce((SELECT max(tamper_confidence) FROM gaps g WHERE g.source = c.source), 0.0) AS highest_confidence
  FROM counts c)"""

PLACEMENT = """
placed AS (
  SELECT g.*, epoch_us(s.last_ts) - epoch_us(s.first_ts) AS span_us,
         epoch_us(g.prev_ts) - epoch_us(s.first_ts) AS start_offset,
         epoch_us(g.ts) - epoch_us(s.first_ts) AS end_offset,
         CAST(greatest(5, least(20, 2 * t.gap_count)) AS INTEGER) AS bins, t.gap_count AS n
  FROM gaps g JOIN spans s USING (source) JOIN totals t USING (source)
  WHERE s.last_ts > s.first_ts),
histogram AS (
  SELECT source, bins, n,
         CAST(least(bins - 1, floor(least(1.0::DOUBLE, greatest(0.0::DOUBLE,
           (start_offset / 1e6::DOUBLE) / (span_us / 1e6::DOUBLE))) * bins)) AS INTEGER) AS bin,
         count(*) AS gap_count
  FROM placed GROUP BY ALL),
every_bin AS (
  SELECT s.source, s.bins, s.n, b.bin, coalesce(h.gap_count, 0) / s.n::DOUBLE AS o, 1.0::DOUBLE / s.bins AS e
  FROM (SELECT DISTINCT source, bins, n FROM placed) s
  JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(20)) b ON b.bin < s.bins
  LEFT JOIN histogram h ON h.source = s.source AND h.bin = b.bin),
scores AS (
  SELECT source, CASE WHEN n < 2 THEN 0.0 ELSE
         printf('%.2f', 100.0::DOUBLE * least(1.0::DOUBLE, greatest(0.0::DOUBLE, (
           0.5::DOUBLE * sum(CASE WHEN o > 0 THEN o * log2(o / ((o + e) / 2)) ELSE 0 END)
           + 0.5::DOUBLE * sum(e * log2(e / ((o + e) / 2)))) / log2(bins))))::DOUBLE END AS entropy_score
  FROM every_bin GROUP BY source, bins, n)"""

TIMELINE = """
stretches AS (
  SELECT source, severity,
         least(77, greatest(0, CAST(trunc((start_offset / 1e6::DOUBLE) / (span_us / 1e6::DOUBLE) * 77) AS INTEGER)))
           AS a,
         least(77, greatest(0, CAST(trunc((end_offset / 1e6::DOUBLE) / (span_us / 1e6::DOUBLE) * 77) AS INTEGER)))
           AS b
  FROM placed),
cells AS (
  SELECT source, CAST(cell AS INTEGER) AS cell, CAST(max(CASE WHEN severity = 'WARNING' THEN 1 ELSE 2 END) AS INTEGER) AS level
  FROM (SELECT source, severity, unnest(range(a, greatest(a, b) + 1)) AS cell FROM stretches) GROUP BY 1, 2),
timelines AS (
  SELECT c.source, string_agg(CASE WHEN x.cell IS NULL THEN '.' ELSE '#' END, '' ORDER BY i.range) AS timeline
  FROM counts c CROSS JOIN range(78) i LEFT JOIN cells x ON x.source = c.source AND x.cell = i.range
  GROUP BY c.source)"""

RISK = """
risks AS (
  SELECT t.*, coalesce(s.entropy_score, 0.0) AS entropy_score, c.error_bursts,
         CASE WHEN warning_count + suspicious_count + critical_count + c.error_bursts = 0 THEN 'CLEAN'
              WHEN critical_count >= 2 OR highest_confidence >= 92 THEN 'COMPROMISED'
              WHEN critical_count >= 1 OR suspicious_count >= 3 OR coalesce(s.entropy_score, 0) >= 70
                   OR c.error_bursts >= 25 THEN 'HIGH RISK'
              WHEN suspicious_count >= 1 OR (warning_count >= 5 AND coalesce(s.entropy_score, 0) >= 45)
                   OR c.error_bursts >= 10 THEN 'MODERATE RISK'
              ELSE 'LOW RISK' END AS risk_assessment,
         CAST(CASE WHEN suspicious_count + critical_count > 0 THEN 2 WHEN warning_count > 0 THEN 1 ELSE 0 END
              AS INTEGER) AS status_code
  FROM totals t JOIN counts c USING (source) LEFT JOIN scores s USING (source))"""

TOP = """
top AS (
  SELECT * FROM gaps
  QUALIFY row_number() OVER (PARTITION BY source
            ORDER BY severity_rank DESC, duration_seconds DESC, tamper_confidence DESC, gap_number) = 1)"""


def fold(values: str, order: str) -> str:
    """The chain over an ordered list of texts."""
    return (
        f"list_reduce(list_prepend(repeat('0', 64), list({values} ORDER BY {order})), "
        "lambda a, v: sha256(v || a))"
    )


CHAIN = f"""
chains AS (
  SELECT source, {fold('line', 'line_number')} AS final_hash FROM parsed WHERE ts IS NOT NULL GROUP BY source)"""


def segments(size: int, relation: str = "parsed", name: str = "segments") -> str:
    return f"""
{name} AS (
  SELECT source, (line_number - 1) // {size} AS segment, {fold('line', 'line_number')} AS digest
  FROM {relation} WHERE ts IS NOT NULL GROUP BY 1, 2)"""


REPORT = (
    "source, gap_number, severity, gap_start, gap_end, duration_seconds, duration_human, line_before_gap, "
    "line_after_gap, line_number_start, line_number_end, tamper_confidence, fingerprint"
)


def query(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select
