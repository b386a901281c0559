"""Lines around each gap.

Wanted lines are few among all lines, but may be too many to broadcast. So each is marked in a bitmap whose size is fixed, which goes to all
tasks: a line that it does not show is dropped where it is read. Only the rest, wanted lines and a few that share
their bits, meets the gaps in an equi-join. However many gaps there are, text of other lines is not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewarden.config import ScanConfig

# rows of 64 bits in the bitmap, 16 bytes each as data: at most 4 million, chosen by the number of gaps
LEAST_SLOTS, MOST_SLOTS = 1 << 12, 1 << 22
CELL = 4  # neighbouring lines that share a bit


def _span(first: Column, last: Column) -> Column:
    """Numbers first..last, empty when the range is."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def _wanted(config: ScanConfig) -> Column:
    end = F.col("line_number_end")
    first = F.greatest(F.lit(1), end - config.context_lines).cast("bigint")
    last = (end + max(config.context_lines, 1) - 1).cast("bigint")
    return F.array_union(_span(first, last), F.array(F.col("line_number_start")))


def _place(rows: DataFrame, slots: int) -> DataFrame:
    """Adds the slot and the bit of a line."""
    return rows.withColumn("__h", F.expr(f"xxhash64(source, line_number div {CELL})")).selectExpr(
        "* EXCEPT (__h)",
        f"pmod(shiftrightunsigned(__h, 6), {slots}L) AS __slot",
        "shiftleft(1L, CAST(pmod(__h, 64) AS INT)) AS __bit",
    )


def marked_lines(lines: DataFrame, wanted: DataFrame, slots: int = LEAST_SLOTS) -> DataFrame:
    """Those of ``lines`` that the bitmap of ``wanted`` (``source, line_number``) shows: all wanted ones and a few others."""
    cells = _place(wanted.select("source", "line_number"), slots).groupBy("__slot").agg(F.bit_or("__bit").alias("__bits"))
    shown = _place(lines, slots).join(F.broadcast(cells), "__slot").filter("__bits & __bit <> 0")
    return shown.select(*[f"`{c}`" for c in lines.columns])


def _looked_up(gaps: DataFrame, lines: DataFrame, config: ScanConfig) -> DataFrame:
    """One row per gap and wanted line; an equi-join on the evenly spread (source, line_number)."""
    count = gaps.count()
    slots = min(MOST_SLOTS, max(LEAST_SLOTS, 1 << max(count - 1, 1).bit_length()))
    wanted = gaps.withColumn("line_number", F.explode(_wanted(config)))
    narrow = lines.select("source", "line_number", "line")
    return marked_lines(narrow, wanted, slots).join(wanted, ["source", "line_number"])


def context_lines(gaps: DataFrame, lines: DataFrame, config: ScanConfig) -> DataFrame:
    """Context as rows: ``source, gap_number, side, line_number, line``.

    ``before``: the N lines of any kind ahead of the gap's closing line, its opening line
    included. ``after``: the closing line and the N - 1 lines after it, at least itself.
    """
    slim = gaps.select("source", "gap_number", "line_number_start", "line_number_end")
    found = _looked_up(slim, lines, config)
    side = F.when(F.col("line_number") >= F.col("line_number_end"), "after").when(
        F.col("line_number") >= F.col("line_number_end") - config.context_lines, "before"
    )
    return (
        found.withColumn("side", side)
        .filter(F.col("side").isNotNull())
        .select("source", "gap_number", "side", "line_number", "line")
    )


def with_context(gaps: DataFrame, lines: DataFrame, config: ScanConfig) -> DataFrame:
    """Gaps with edge lines and ``raw_context`` (arrays of at most N lines on each side).

    One lookup serves edge text and context, so gap detection itself can stay text-free. ``gaps`` and ``lines`` are
    read more than once: stage them.
    """
    plain = gaps.drop("line_before_gap", "line_after_gap")
    slim = plain.select("source", "gap_number", "line_number_start", "line_number_end")
    found = _looked_up(slim, lines, config)
    number, start, end = F.col("line_number"), F.col("line_number_start"), F.col("line_number_end")
    entry = F.struct("line_number", "line")
    before = (number < end) & (number >= end - config.context_lines)
    texts = found.groupBy("source", "gap_number").agg(
        F.max(F.when(number == start, F.col("line"))).alias("line_before_gap"),
        F.max(F.when(number == end, F.col("line"))).alias("line_after_gap"),
        F.struct(
            F.array_sort(F.collect_list(F.when(before, entry))).alias("before"),
            F.array_sort(F.collect_list(F.when(number >= end, entry))).alias("after"),
        ).alias("raw_context"),
    )
    joined = plain.join(texts, ["source", "gap_number"])
    return joined.select(*plain.columns, "line_before_gap", "line_after_gap", "raw_context")
