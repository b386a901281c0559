"""User-supplied date formats (percent directives) compiled to Column expressions.

A format gives two patterns. ``search_pattern`` finds the stamp in a line. ``strict_pattern``
re-reads the found text the way a date parser does (value ranges, names, one capture group
per directive) and must consume all of it. One replacement takes all groups out at once, with
a mark between them, so the strict pattern runs once per stamp however many directives it has.
The fields are then combined with integer arithmetic on the JVM side. Month and day names are
the English ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# What each directive matches while searching a line.
SEARCH = {
    "%Y": r"\d{4}",
    "%y": r"\d{2}",
    "%m": r"\d{1,2}",
    "%d": r"\d{1,2}",
    "%H": r"\d{1,2}",
    "%I": r"\d{1,2}",
    "%M": r"\d{1,2}",
    "%S": r"\d{1,2}",
    "%f": r"\d{1,6}",
    "%b": r"[A-Za-z]{3}",
    "%B": r"[A-Za-z]+",
    "%p": r"(?:AM|PM|am|pm)",
    "%z": r"[+-]\d{2}:?\d{2}",
    "%Z": r"[A-Za-z_+\-/]+",
    "%j": r"\d{1,3}",
    "%a": r"[A-Za-z]{3}",
    "%A": r"[A-Za-z]+",
    "%w": r"\d",
    "%U": r"\d{1,2}",
    "%W": r"\d{1,2}",
    # not ".": in Java it also stops at carriage returns and the Unicode line ends
    "%c": r"[^\n]+?",
    "%x": r"[^\n]+?",
    "%X": r"[^\n]+?",
}

MONTH_NAMES = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
DAY_NAMES = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def _short(names: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(n[:3] for n in names)


# What each directive accepts when its text is converted (C locale).
STRICT = {
    "%Y": r"\d\d\d\d",
    "%y": r"\d\d",
    "%m": r"1[0-2]|0[1-9]|[1-9]",
    "%d": r"3[01]|[12]\d|0[1-9]|[1-9]| [1-9]",
    "%H": r"2[0-3]|[01]\d|\d",
    "%I": r"1[0-2]|0[1-9]|[1-9]",
    "%M": r"[0-5]\d|\d",
    "%S": r"6[01]|[0-5]\d|\d",
    "%f": r"\d{1,6}",
    "%b": "|".join(_short(MONTH_NAMES)),
    "%B": "|".join(sorted(MONTH_NAMES, key=len, reverse=True)),
    "%p": "am|pm",
    "%z": r"[+-]\d\d:?[0-5]\d",
    "%Z": "utc|gmt",
    "%j": r"36[0-6]|3[0-5]\d|[12]\d\d|0[1-9]\d|00[1-9]|[1-9]\d|0[1-9]|[1-9]",
    "%a": "|".join(_short(DAY_NAMES)),
    "%A": "|".join(sorted(DAY_NAMES, key=len, reverse=True)),
    "%w": "[0-6]",
    "%U": r"5[0-3]|[0-4]\d|\d",
    "%W": r"5[0-3]|[0-4]\d|\d",
}
# Composite directives expand before conversion (C locale).
EXPANSIONS = {"%c": "%a %b %d %H:%M:%S %Y", "%x": "%m/%d/%y", "%X": "%H:%M:%S"}


def _tokens(fmt: str) -> list[str]:
    """Split a format into directives (``%Y``), ``%%`` and single literal characters."""
    tokens = re.findall(r"%[\s\S]|[\s\S]", fmt)
    if tokens and tokens[-1] == "%":
        raise ValueError("no directive after the last % of the layout")
    for token in tokens:
        if len(token) == 2 and token != "%%" and token not in SEARCH:
            raise ValueError(f"the layout uses {token}, which is not known here")
    return tokens


def _literal(char: str) -> str:
    return char if char.isalnum() else rf"\x{{{ord(char):x}}}"


@dataclass(frozen=True)
class CompiledFormat:
    search_pattern: str
    strict_pattern: str
    directives: tuple[str, ...]
    mark: str  # a character that no accepted text holds

    @property
    def convertible(self) -> bool:
        """A directive used twice never converts, so such a format never matches a line."""
        return len(set(self.directives)) == len(self.directives)

    def fields(self, raw: Column) -> Column:
        """The text before the match (empty), that of every directive, and the rest of ``raw`` behind it.

        The rest matches anything, so the strict pattern takes what it would take alone. Text that does not
        match has one field; text that holds the mark cannot be a date and has none.
        """
        groups = range(1, len(self.directives) + 2)
        marked = F.regexp_replace(raw, self.strict_pattern + r"([\s\S]*)$", "".join(f"{self.mark}${n}" for n in groups))
        return F.when((F.length(raw) > 0) & ~raw.contains(self.mark), F.split(marked, self.mark))

    def micros(self, fields: Column) -> Column:
        """``ts_us`` from the ``fields`` of the found text, NULL where it is not a valid date."""
        def field(name: str) -> Column:
            return F.get(fields, self.directives.index(name) + 1)

        def number(name: str, default: int) -> Column:
            if name not in self.directives:
                return F.lit(default)
            return F.trim(field(name)).try_cast("int")

        def position(name: str, names: tuple[str, ...]) -> Column:
            return F.array_position(F.array(*[F.lit(n) for n in names]), F.lower(field(name))).cast("int")

        year = F.lit(1900)
        month = F.lit(1)
        hour = F.lit(0)
        weekday = None  # Monday is 0
        for name in self.directives:  # where two directives set one field, the later wins
            if name == "%Y":
                year = number("%Y", 0)
            elif name == "%y":
                short = number("%y", 0)
                year = F.when(short <= 68, short + 2000).otherwise(short + 1900)
            elif name == "%m":
                month = number("%m", 1)
            elif name == "%b":
                month = position("%b", _short(MONTH_NAMES))
            elif name == "%B":
                month = position("%B", MONTH_NAMES)
            elif name == "%H":
                hour = number("%H", 0)
            elif name == "%I":
                half = number("%I", 0) % 12
                pm = F.lower(field("%p")) == "pm" if "%p" in self.directives else F.lit(False)
                hour = F.when(pm, half + 12).otherwise(half)
            elif name == "%a":
                weekday = position("%a", _short(DAY_NAMES)) - 1
            elif name == "%A":
                weekday = position("%A", DAY_NAMES) - 1
            elif name == "%w":
                weekday = (number("%w", 0) + 6) % 7

        one = F.lit(1)
        new_year = F.unix_date(F.make_date(F.greatest(year, one), one, one))
        parts = [F.lpad(v.cast("string"), n, "0") for v, n in ((year, 4), (month, 2), (number("%d", 1), 2))]
        dated = F.unix_date(F.concat_ws("-", *parts).try_cast("date"))
        if "%j" in self.directives:
            day_number = new_year + number("%j", 1) - 1
        elif weekday is not None and {"%U", "%W"} & set(self.directives) and {"%Y", "%y"} & set(self.directives):
            weeks = [n for n in self.directives if n in ("%U", "%W")][-1]
            # weeks start on Sunday for %U, on Monday for %W; week 0 precedes the first such day
            offset = 1 if weeks == "%U" else 0
            first = (F.weekday(F.make_date(F.greatest(year, one), one, one)) + offset) % 7
            inside = (weekday + offset) % 7
            week = number(weeks, 0)
            later = (7 - first) % 7 + 7 * (week - 1) + inside
            day_number = new_year + F.when(week == 0, inside - first).otherwise(later)
        else:
            day_number = dated

        second = number("%S", 0)
        micro = F.rpad(field("%f"), 6, "0").try_cast("int") if "%f" in self.directives else F.lit(0)
        clock = (hour * 3600 + number("%M", 0) * 60 + second).cast("long") * 1_000_000 + micro
        us = day_number.cast("long") * 86_400_000_000 + clock
        if "%z" in self.directives:
            zone = field("%z")
            minutes = F.substring(zone, 2, 2).try_cast("int") * 60 + F.right(zone, F.lit(2)).try_cast("int")
            sign = F.when(zone.startswith("-"), -1).otherwise(1)
            us = F.when(minutes < 1440, us - (sign * minutes).cast("long") * 60_000_000)

        last = len(self.directives) + 1
        whole = (F.size(fields) == last + 1) & (F.get(fields, last) == "")
        return F.when(whole & (second <= 59) & year.between(1, 9999), us)


def compile_format(fmt: str) -> CompiledFormat:
    """Compile a format; ``ValueError`` for an unknown or incomplete directive."""
    tokens = _tokens(fmt)
    search = "".join(SEARCH[t] if t in SEARCH else _literal(t[-1]) for t in tokens)

    expanded = _tokens("".join(EXPANSIONS.get(t, t) for t in tokens))
    expanded_text = []
    for token in expanded:
        if token in STRICT:
            expanded_text.append(f"({STRICT[token]})")
        elif token.isspace():
            if not expanded_text or expanded_text[-1] != r"\s+":
                expanded_text.append(r"\s+")
        else:
            expanded_text.append(_literal(token[-1]))
    return CompiledFormat(
        search_pattern=search,
        strict_pattern="(?i)^" + "".join(expanded_text),
        directives=tuple(t for t in expanded if t in STRICT),
        mark=next(c for c in map(chr, range(0xE000, 0xF8FF)) if c not in fmt),
    )
