"""A slow, plain reading of the rules, for comparison with small random logs."""

import hashlib
import math
import random
import re
from datetime import datetime, timedelta, timezone

from tracewarden.config import ERROR_WORDS

EPOCH = datetime(1970, 1, 1)


def us(moment):
    return (moment - EPOCH) // timedelta(microseconds=1)


def _zoned(text):
    moment = datetime.fromisoformat(text.replace("Z", "+00:00"))
    return moment.astimezone(timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment


def find_stamp(line, year, custom=None):
    rules = [
        ("ISO8601", r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,6})?(Z|[+-]\d\d:?\d\d)?", _zoned),
        ("ISO_SPACE", r"\d{4}-\d\d-\d\d\s+\d\d:\d\d:\d\d(\.\d{1,6})?", datetime.fromisoformat),
        ("SLASH", r"\d{4}/\d\d/\d\d\s+\d\d:\d\d:\d\d", lambda t: datetime.strptime(t, "%Y/%m/%d %H:%M:%S")),
        ("APACHE", r"\d{1,2}/[A-Za-z]{3}/\d{4}(:\d\d){3}", lambda t: datetime.strptime(t, "%d/%b/%Y:%H:%M:%S")),
        (
            "SYSLOG",
            r"[A-Z][a-z]{2}\s+\d{1,2}\s+\d\d:\d\d:\d\d",
            lambda t: datetime.strptime(f"{year} {t}", "%Y %b %d %H:%M:%S"),
        ),
    ]
    for name, pattern, convert in rules:
        hit = re.search(pattern, line)
        try:
            if hit:
                return convert(hit[0]), hit[0], name
        except (ValueError, OverflowError):
            pass
    return None, None, None


def scan(lines, year=2024, threshold=300.0, context=2):
    """Gaps, bursts, counters and chain of one source given as a list of lines."""
    rows = [(n, text, *find_stamp(text, year)) for n, text in enumerate(lines, 1)]
    flags = [any(w in text.lower() for w in ERROR_WORDS) for _, text, *_ in rows]
    bursts = []
    for n, flag in enumerate(flags, 1):
        if flag and n > 1 and flags[n - 2]:
            bursts[-1][1] = n
        elif flag:
            bursts.append([n, n])

    stamped, digest = [], "0" * 64
    for n, text, moment, _, parser in rows:
        if moment is None:
            continue
        if stamped:
            last = stamped[-1][1]
            if parser == "SYSLOG" and moment < last and (last.month, moment.month) == (12, 1):
                moment = moment.replace(year=last.year + 1)
        stamped.append((n, moment, text))
        digest = hashlib.sha256((text + digest).encode()).hexdigest()

    gaps = []
    for (n0, t0, x0), (n1, t1, x1) in zip(stamped, stamped[1:]):
        seconds = (t1 - t0).total_seconds()
        if seconds <= threshold:
            continue
        whole = round(seconds)
        distance, hour = n1 - n0, (t0 + timedelta(seconds=seconds / 2)).hour
        points = min(58.0, seconds / max(1.0, threshold) * 10.5)
        if seconds > 7200:
            points = min(65.0, points + 8.0)
        points += next((p for limit, p in ((2, 16.0), (5, 12.0), (20, 7.0)) if distance <= limit), 3.0)
        points += 14.0 if hour < 5 else 8.0 if hour in (5, 22, 23) else 3.0
        points += 6.0 if context else 2.0
        key = f"{t0.isoformat()}|{t1.isoformat()}|{n0}|{n1}|{whole}"
        gaps.append(
            {
                "gap_number": len(gaps) + 1,
                "severity": "CRITICAL" if seconds > 7200 else "SUSPICIOUS" if seconds >= 1800 else "WARNING",
                "gap_start": t0.isoformat(),
                "gap_end": t1.isoformat(),
                "duration_seconds": whole,
                "line_before_gap": x0,
                "line_after_gap": x1,
                "line_number_start": n0,
                "line_number_end": n1,
                "tamper_confidence": round(min(100.0, points), 2),
                "fingerprint": hashlib.md5(key.encode()).hexdigest(),
                "before": [(n, lines[n - 1]) for n in range(max(1, n1 - context), n1)],
                "after": [
                    (n, lines[n - 1]) for n in range(n1, min(len(lines), n1 + max(context, 1) - 1) + 1)
                ],
            }
        )
    return {
        "gaps": gaps,
        "bursts": [tuple(b) for b in bursts],
        "total": len(rows),
        "parsed": len(stamped),
        "errors": sum(flags),
        "first": us(stamped[0][1]) if stamped else None,
        "last": us(stamped[-1][1]) if stamped else None,
        "chain": digest,
        "stamped": stamped,
    }


def placement(gaps, first, last):
    """Score by the textbook formula over all bins, empty ones included."""
    if len(gaps) < 2 or last <= first:
        return 0.0
    bins = max(5, min(20, 2 * len(gaps)))
    seen = [0] * bins
    for gap in gaps:
        at = (us(datetime.fromisoformat(gap["gap_start"])) - first) / 1e6 / ((last - first) / 1e6)
        seen[min(bins - 1, int(min(max(at, 0.0), 1.0) * bins))] += 1
    p = [n / len(gaps) for n in seen]
    q = 1 / bins
    mix = [(x + q) / 2 for x in p]
    spread = sum(x * math.log2(x / m) for x, m in zip(p, mix) if x) / 2
    spread += sum(q * math.log2(q / m) for m in mix) / 2
    return round(min(1.0, max(0.0, spread / math.log2(bins))) * 100, 2)


def random_log(seed, size):
    """Mixed layouts, malformed stretches, backward jumps, error runs, year ends."""
    rng = random.Random(seed)
    moment = datetime(2024, 12, 30, rng.randrange(24)) if seed % 2 else datetime(2024, 3, 1)
    layouts = [
        lambda t: t.isoformat() + rng.choice(["", "Z", "+02:00", "-0530"]),
        lambda t: t.strftime("%Y-%m-%d %H:%M:%S.%f"),
        lambda t: t.strftime("%Y/%m/%d  %H:%M:%S"),
        lambda t: t.strftime("[%d/%b/%Y:%H:%M:%S +0200]"),
        lambda t: t.strftime("%b %d %H:%M:%S"),
        lambda t: t.strftime("%b %d %H:%M:%S"),
    ]
    junk = ["", "   ", "no stamp here", "ERROR without stamp", "2024-99-99 25:61:99 bad", "Feb 30 10:00:00 x"]
    lines = []
    while len(lines) < size:
        if rng.random() < 0.1:
            lines += [rng.choice(junk)] * rng.choice([1, 1, 2, 25])
            continue
        step = rng.choice([1, 5, 60, 299, 300, 301, 1800, 7200, 7201, 30000, -400])
        moment += timedelta(seconds=step, microseconds=rng.choice([0, 0, 1, 500000]))
        stamp = rng.choice(layouts)(moment)
        lines.append(f"{stamp} {rng.choice(['ok', 'ok', 'login failed', 'Fatal: disk', 'alert'])} {len(lines)}")
    return lines[:size]
