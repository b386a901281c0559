"""Stream monitor on the batch operators: every micro-batch is a block-wise scan of its lines and a small carry.

The carry is what the lines before leave over for the next ones, as tables of the shared folder, one version per
micro-batch: a row of counters, digest and open burst per source, gaps whose lines after are not all there yet, and the few
lines that a later result may need (the last two with a stamp, the last ``context_lines``, those of open gaps).
A micro-batch reads the version before its own and overwrites its own, results included, so a batch that
is run again after a failure, wholly or in part, leaves the same tables.

Scale: new lines go through the same ``(source, block)`` groups, seams and bitmaps as in a batch scan, so a backfill
of one source is spread over tasks like any table. Only the exact chain follows each source line by line, in
bounded chunks; ``exact_chain=False`` leaves it out. A version holds a few lines per source, however long the source is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracewarden.config import ScanConfig
from tracewarden.operators import bursts, chain, context, gaps
from tracewarden.operators.blocks import block_of, number_rows, with_source_facts
from tracewarden.operators.chain import START
from tracewarden.operators.parsing import parse_lines
from tracewarden.sources.staging import stage
from tracewarden.streaming.metrics import observe_arrivals

LINE = "source string, line_number bigint, line string, ts_us bigint, parser string, is_error boolean"
SOURCE = (
    "source string, last_number bigint, total_lines bigint, parsed_lines bigint, error_lines bigint, closed_bursts bigint, "
    "gap_count bigint, first_us bigint, last_us bigint, digest string, "
    "open_start bigint, open_first_us bigint, open_last_us bigint"
)
OPEN_GAP = (
    "source string, block bigint, line_number_start bigint, line_number_end bigint, start_us bigint, end_us bigint, "
    "delta_us bigint, gap_number bigint"
)
NAMES = [part.split()[0] for part in SOURCE.split(", ")]
LINE_NAMES = [part.split()[0] for part in LINE.split(", ")]
GAP_NAMES = [part.split()[0] for part in OPEN_GAP.split(", ")]
BURST_NAMES = ["source", "burst_number", "line_number_start", "line_number_end", "line_count", "first_us", "last_us"]


@dataclass
class Carry:
    """What earlier lines leave over."""

    sources: DataFrame
    lines: DataFrame
    gaps: DataFrame


@dataclass
class Step:
    """Results that a micro-batch completes, and the carry after it."""

    gaps: DataFrame
    bursts: DataFrame
    late: DataFrame
    carry: Carry


def empty_carry(spark: SparkSession) -> Carry:
    return Carry(*(spark.createDataFrame([], schema) for schema in (SOURCE, LINE, OPEN_GAP)))


def _split_late(parsed: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines above the last number of their source, each number once, and the others."""
    here = with_source_facts(parsed, known.select("source", "last_number"), "line_number")
    here = stage(here.withColumn("late", F.coalesce(F.col("line_number") <= F.col("last_number"), F.lit(False))), "arrived")
    fresh = here.filter("NOT late").select(*LINE_NAMES)
    late = here.filter("late").select("source", "line_number", "line")
    bit = F.bit_or(F.expr("shiftleft(1L, CAST(pmod(line_number, 64) AS INT))"))
    cells = fresh.groupBy("source", F.expr("line_number div 64")).agg(F.count(F.lit(1)).alias("n"), bit.alias("bits"))
    if cells.filter("n <> bit_count(bits)").isEmpty():
        return fresh, late
    rank = F.row_number().over(Window.partitionBy("source", "line_number").orderBy("line"))
    ranked = stage(fresh.withColumn("nth", rank), "ranked")
    again = ranked.filter("nth > 1").select("source", "line_number", "line")
    return ranked.filter("nth = 1").select(*LINE_NAMES), late.unionByName(again)


def _burst_rows(fresh: DataFrame, known: DataFrame, now: DataFrame, config: ScanConfig) -> DataFrame:
    """Bursts that end in or reach into the new lines, numbered, with ``is_open``; staged."""
    runs = bursts.error_bursts(fresh, config)
    ends = known.select("source", "last_number", "closed_bursts", "open_start", "open_first_us", "open_last_us")
    met = runs.join(ends, "source", "left")
    goes_on = "open_start IS NOT NULL AND line_number_start = last_number + 1"
    grown = met.selectExpr(
        "source",
        f"if({goes_on}, open_start, line_number_start) AS line_number_start",
        "line_number_end",
        f"if({goes_on}, coalesce(open_first_us, first_us), first_us) AS first_us",
        f"if({goes_on}, coalesce(last_us, open_last_us), last_us) AS last_us",
    )
    opened = ends.filter("open_start IS NOT NULL").selectExpr(
        "source", "open_start AS line_number_start", "last_number AS line_number_end", "open_first_us AS first_us", "open_last_us AS last_us"
    )
    rest = opened.join(grown.select("source", "line_number_start"), ["source", "line_number_start"], "left_anti")
    every = stage(grown.unionByName(rest), "bursts")
    keyed = every.selectExpr("*", f"{block_of('line_number_start', config.block_lines)} AS block")
    numbered = number_rows(keyed, "line_number_start", "nth").drop("block")
    numbered = numbered.join(ends.select("source", "closed_bursts"), "source", "left").join(now, "source")
    return stage(
        numbered.selectExpr(
            "source",
            "nth + coalesce(closed_bursts, 0) AS burst_number",
            "line_number_start",
            "line_number_end",
            "line_number_end - line_number_start + 1 AS line_count",
            "first_us",
            "last_us",
            "line_number_end = now_number AS is_open",
        ),
        "numbered_bursts",
    )


def _digests(fresh: DataFrame, known: DataFrame, config: ScanConfig) -> DataFrame:
    """``source, new_digest`` of the sources with new parsed lines; their chains go on from the digests known."""
    first = known.select("source", F.col("last_number").alias("base"))
    moved = with_source_facts(fresh, first, "line_number")
    moved = moved.withColumn("line_number", F.col("line_number") - F.coalesce("base", F.lit(0))).drop("base")
    before = known.select("source", "digest")
    return chain.sequential_chain(moved, config, before=before).withColumnRenamed("final_hash", "new_digest")


def _kept_lines(both: DataFrame, marks: DataFrame, now: DataFrame, pending: DataFrame, config: ScanConfig) -> DataFrame:
    """The lines that a later micro-batch may need."""
    newest = Window.partitionBy("source").orderBy(F.desc("line_number"))
    seams = marks.filter("seam").select("source", "line_number").withColumn("nth", F.row_number().over(newest))
    wanted = seams.filter("nth <= 2").drop("nth")
    n = config.context_lines
    if n:
        ring = F.sequence(F.greatest(F.lit(1), F.col("now_number") - (n - 1)).cast("bigint"), F.col("now_number"))
        wanted = wanted.unionByName(now.select("source", F.explode(ring).alias("line_number")))
    wanted = wanted.unionByName(pending.select("source", F.explode(context._wanted(config)).alias("line_number")))
    wanted = stage(wanted.distinct(), "wanted")
    return context.marked_lines(both, wanted).join(wanted, ["source", "line_number"], "left_semi").select(*LINE_NAMES)


def advance(lines: DataFrame, before: Carry, config: ScanConfig, exact_chain: bool = True) -> Step:
    """Results of the new ``lines`` (``source, line_number, line``) after all lines behind ``before``.

    Within a source numbers must rise from micro-batch to micro-batch; a number at or below the last one
    seen, or repeated, is late and takes part in nothing.
    """
    parsed = stage(parse_lines(lines, config).select(*LINE_NAMES), "parsed")
    arrived = parsed.select("source").distinct()
    known = stage(before.sources.join(arrived, "source", "left_semi"), "known")
    fresh, late = _split_late(parsed, known)
    counts = fresh.groupBy("source").agg(
        F.max("line_number").alias("now_number"),
        F.count(F.lit(1)).alias("n"),
        F.count("ts_us").alias("n_parsed"),
        F.count_if("is_error").alias("n_errors"),
    )
    counts = stage(counts, "counts")
    touched = counts.select("source", "now_number")
    known = known.join(touched.select("source"), "source", "left_semi")

    both = stage(fresh.unionByName(before.lines), "both")
    marks = stage(gaps.gap_marks(both, config), "marks")
    # sources without new lines are among them: their kept lines show gaps that are reported already
    seen = before.sources.select("source", "last_number", "gap_count")
    found = gaps.raw_gaps(marks, config).join(seen, "source", "left")
    found = stage(found.filter("line_number_end > coalesce(last_number, 0)"), "found")
    numbered = number_rows(found, "line_number_end", "nth")
    numbered = numbered.withColumn("gap_number", F.expr("nth + coalesce(gap_count, 0)")).select(*GAP_NAMES)
    last = before.sources.join(touched, "source", "full_outer").select(
        "source", F.coalesce("now_number", "last_number").alias("now_number")
    )
    now = stage(last, "now")
    waiting = numbered.unionByName(before.gaps).join(now, "source")
    full = F.col("line_number_end") + max(config.context_lines, 1) - 1 <= F.col("now_number")
    waiting = stage(waiting.withColumn("full", full).drop("now_number"), "waiting")
    pending = waiting.filter("NOT full").drop("full")
    done = stage(gaps.score_gaps(waiting.filter("full").drop("full"), config), "done")

    runs = _burst_rows(fresh, known, touched, config)
    closed = runs.filter("NOT is_open").groupBy("source").agg(F.count(F.lit(1)).alias("n_closed"))
    opened = runs.filter("is_open").selectExpr(
        "source", "line_number_start AS new_start", "first_us AS new_first_us", "last_us AS new_last_us"
    )
    spans = gaps.source_spans(marks).withColumnsRenamed({"first_us": "span_first", "last_us": "span_last"})
    new_gaps = found.groupBy("source").agg(F.count(F.lit(1)).alias("n_gaps"))
    grown = counts.join(known, "source", "left")
    for facts in (closed, opened, spans, new_gaps):
        grown = grown.join(facts, "source", "left")
    if exact_chain:
        grown = grown.join(_digests(fresh, known, config), "source", "left")
    else:
        grown = grown.withColumn("new_digest", F.lit(None).cast("string"))
    grown = grown.selectExpr(
        "source",
        "now_number AS last_number",
        "coalesce(total_lines, 0) + n AS total_lines",
        "coalesce(parsed_lines, 0) + n_parsed AS parsed_lines",
        "coalesce(error_lines, 0) + n_errors AS error_lines",
        "coalesce(closed_bursts, 0) + coalesce(n_closed, 0) AS closed_bursts",
        "coalesce(gap_count, 0) + coalesce(n_gaps, 0) AS gap_count",
        "coalesce(first_us, span_first) AS first_us",
        "coalesce(span_last, last_us) AS last_us",
        f"coalesce(new_digest, digest, '{START}') AS digest",
        "new_start AS open_start",
        "new_first_us AS open_first_us",
        "new_last_us AS open_last_us",
    )
    still = before.sources.join(touched.select("source"), "source", "left_anti")
    return Step(
        gaps=context.with_context(done, both, config),
        bursts=runs.filter("NOT is_open").select(*BURST_NAMES),
        late=late.withColumn("reason", F.lit("late")),
        carry=Carry(
            still.unionByName(grown).select(*NAMES),
            _kept_lines(both, marks, now, pending, config),
            pending.select(*GAP_NAMES),
        ),
    )


class CarryLog:
    """The tables of one monitored stream: ``gaps, bursts, late`` and the versions of the carry, by micro-batch."""

    def __init__(self, spark: SparkSession, folder: str, config: ScanConfig, exact_chain: bool = True) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.config, self.exact_chain = config, exact_chain

    def _at(self, name: str, batch: int) -> str:
        return f"{self.folder}/{name}/batch={batch}"

    def carry(self, batch: int) -> Carry:
        """The version that a micro-batch left; that before the first is empty."""
        if batch < 0:
            return empty_carry(self.spark)
        names = (("sources", SOURCE), ("lines", LINE), ("open_gaps", OPEN_GAP))
        return Carry(*(self.spark.read.schema(schema).parquet(self._at(name, batch)) for name, schema in names))

    def run(self, lines: DataFrame, batch: int) -> None:
        """One micro-batch; running it again gives the same tables."""
        step = advance(lines, self.carry(batch - 1), self.config, self.exact_chain)
        tables = {"gaps": step.gaps, "bursts": step.bursts, "late": step.late}
        tables |= {"lines": step.carry.lines, "open_gaps": step.carry.gaps, "sources": step.carry.sources}
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(self._at(name, batch))

    def last_batch(self) -> int:
        """The newest version whose tables are all there: ``sources`` is written last."""
        return self.spark.read.parquet(f"{self.folder}/sources").agg(F.max("batch")).first()[0]

    def _written(self, name: str) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.folder}/{name}")
        return rows.filter(F.col("batch") <= self.last_batch()).drop("batch")

    def gaps(self) -> DataFrame:
        """All gaps so far with context; those still open with the lines after that there are."""
        now = self.carry(self.last_batch())
        rest = stage(gaps.score_gaps(now.gaps, self.config), "open")
        return self._written("gaps").unionByName(context.with_context(rest, now.lines, self.config))

    def bursts(self) -> DataFrame:
        """All bursts so far, the open one of a source included."""
        now = self.carry(self.last_batch()).sources.filter("open_start IS NOT NULL")
        rest = now.selectExpr(
            "source",
            "closed_bursts + 1 AS burst_number",
            "open_start AS line_number_start",
            "last_number AS line_number_end",
            "last_number - open_start + 1 AS line_count",
            "open_first_us AS first_us",
            "open_last_us AS last_us",
        )
        return self._written("bursts").unionByName(rest)

    def late(self) -> DataFrame:
        return self._written("late")

    def progress(self) -> DataFrame:
        """What each micro-batch added to each of its sources: ``batch, source, lines, parsed, malformed, errors, gaps, late``.

        The difference of two versions of the counters, so a batch that was run again counts once.
        """
        versions = self.spark.read.parquet(f"{self.folder}/sources").filter(F.col("batch") <= self.last_batch())
        along = Window.partitionBy("source").orderBy("batch")

        def added(counter: str) -> Column:
            return F.col(counter) - F.coalesce(F.lag(counter).over(along), F.lit(0))

        steps = versions.select(
            "batch",
            "source",
            added("total_lines").alias("lines"),
            added("parsed_lines").alias("parsed"),
            (added("total_lines") - added("parsed_lines")).alias("malformed"),
            added("error_lines").alias("errors"),
            added("gap_count").alias("gaps"),
        )
        late = self.spark.read.parquet(f"{self.folder}/late").groupBy("batch", "source").agg(F.count(F.lit(1)).alias("late"))
        joined = steps.join(late, ["batch", "source"], "left").na.fill(0, ["late"])
        return joined.filter("lines > 0 OR late > 0")

    def status(self) -> DataFrame:
        """Counters, span and digest of every source."""
        return self.carry(self.last_batch()).sources.selectExpr(
            "source",
            "total_lines",
            "parsed_lines",
            "total_lines - parsed_lines AS malformed_lines",
            "error_lines",
            "closed_bursts + if(open_start IS NULL, 0, 1) AS error_bursts",
            "first_us",
            "last_us",
            "gap_count AS gaps_detected",
            "digest AS final_hash",
        )


def monitor_blocks(
    stream: DataFrame, log: CarryLog, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Run ``log`` over a stream of ``source, line_number, line``: what is there now, or, with ``every``, again and again at that interval."""
    writer = observe_arrivals(stream).writeStream.foreachBatch(log.run).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
