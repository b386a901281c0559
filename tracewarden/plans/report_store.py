"""Reports of many sources in few files, found through a manifest, replaced as a whole.

A folder per source (``plans.reports``) suits some hundred sources. Here sources are hashed to buckets of about
``SOURCES_PER_BUCKET`` and laid end to end within their bucket by name; every ``ROWS_PER_PART`` rows make a part,
which is one file, ``bucket=b/part=p``. Where a row goes is arithmetic on one small table of row counts per
source, so a huge source is many parts, a million tiny ones are a hundred files, no task holds more than its
parts, and a task that runs again writes the same rows. The same table gives the manifest: which rows of which
parts a source has. Sources without rows are in it, too, with no part.

A run is written into a folder of its own and counts once a row in ``commits`` names it; readers take the newest
committed run, so they see the old reports or the new ones and never a mixture, whatever is lost while writing.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewarden.operators.blocks import number_rows, with_source_facts
from tracewarden.operators.gaps import REPORT_COLUMNS, report_rows
from tracewarden.plans.reports import CSV_OPTIONS, csv_ddl, json_pieces, read_csv, write_tables
from tracewarden.plans.scan import ScanResult
from tracewarden.sources.staging import stage
from tracewarden.sources.text import scan_text

SOURCES_PER_BUCKET = 10_000
ROWS_PER_PART = 100_000
COMMIT = "sequence bigint, run string, scan_time string"
IN_BLOCK = 200_000  # positions ranked in one group


def row_layout(rows: DataFrame, sources: DataFrame, buckets: int) -> DataFrame:
    """``source, bucket, first_row, row_count``: where the rows of each source lie in its bucket."""
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("row_count"))
    every = sources.select("source").distinct().join(counts, "source", "left").na.fill(0, ["row_count"])
    keyed = every.withColumn("bucket", F.pmod(F.xxhash64("source"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("bucket").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("row_count").over(before), F.lit(0)).alias("first_row")
    return keyed.select("source", "bucket", first, "row_count")


def manifest_rows(layout: DataFrame, rows_per_part: int) -> DataFrame:
    """``source, bucket, part, first, last``: rows of each source by part, counted from 0 within the part."""
    end = "first_row + row_count - 1"
    parts = layout.selectExpr(
        "*", f"explode_outer(if(row_count > 0, sequence(first_row div {rows_per_part}, ({end}) div {rows_per_part}), NULL)) AS part"
    )
    return parts.selectExpr(
        "source",
        "bucket",
        "part",
        f"if(part IS NULL, NULL, greatest(first_row - part * {rows_per_part}, 0L)) AS first",
        f"if(part IS NULL, NULL, least({end} - part * {rows_per_part}, {rows_per_part} - 1L)) AS last",
    )


class ReportStore:
    """Reports below ``path``, one committed run at a time."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        sources_per_bucket: int = SOURCES_PER_BUCKET,
        rows_per_part: int = ROWS_PER_PART,
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.sources_per_bucket = sources_per_bucket
        self.rows_per_part = rows_per_part

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(COMMIT).parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def current(self) -> str | None:
        """The folder of the newest committed run."""
        commits = self._commits()
        row = commits.agg(F.max_by("run", F.struct("sequence", "run"))).first() if commits is not None else None
        return f"{self.path}/runs/{row[0]}" if row and row[0] else None

    def _open(self) -> str:
        folder = self.current()
        if folder is None:
            raise ValueError(f"{self.path} holds no committed run")
        return folder

    def write(
        self, result: ScanResult, scan_time: dt.datetime, run: str | None = None, scan_seconds: float | None = None
    ) -> str:
        """Write CSV, JSON and tables of a scan and commit them; a run of the same name is written anew."""
        run = run or uuid.uuid4().hex
        folder = f"{self.path}/runs/{run}"
        sources = stage(result.stats.select("source"), "sources")
        buckets = max(1, -(-sources.count() // self.sources_per_bucket))
        report = report_rows(result.gaps).withColumn("position", F.col("gap_number"))
        self._write_rows(report, ["source", *REPORT_COLUMNS], sources, buckets, f"{folder}/csv")
        pieces = json_pieces(result, scan_time, scan_seconds)
        self._write_rows(pieces, ["piece"], sources, buckets, f"{folder}/json")
        write_tables(result, f"{folder}/tables", scan_time.date())
        self._commit(run, scan_time)
        return run

    def _write_rows(self, rows: DataFrame, columns: list[str], sources: DataFrame, buckets: int, target: str) -> None:
        blocked = stage(rows.withColumn("block", F.expr(f"position div {IN_BLOCK}")), "report_rows")
        ranked = number_rows(blocked, "position", "nth")
        layout = stage(row_layout(blocked, sources, buckets), "layout")
        manifest_rows(layout, self.rows_per_part).write.mode("overwrite").parquet(f"{target}_manifest")
        placed = with_source_facts(ranked, layout, "nth").selectExpr("*", "first_row + nth - 1 AS row")
        parted = placed.withColumn("part", F.expr(f"row div {self.rows_per_part}"))
        files = parted.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "row")
        writer = files.select("bucket", "part", *columns).write.mode("overwrite").partitionBy("bucket", "part")
        if columns == ["piece"]:
            writer.text(target)
        else:
            writer.options(**CSV_OPTIONS).csv(target)

    def _commit(self, run: str, scan_time: dt.datetime) -> None:
        commits = self._commits()
        last = commits.agg(F.max("sequence")).first()[0] if commits is not None else None
        row = self.spark.createDataFrame([((last or 0) + 1, run, scan_time.isoformat())], COMMIT)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def manifest(self, kind: str) -> DataFrame:
        """``source, bucket, part, first, last`` of ``csv`` or ``json``."""
        return self.spark.read.parquet(f"{self._open()}/{kind}_manifest")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._open()}/tables/{name}")

    def csv(self) -> DataFrame:
        """The gap report of all sources, ``source`` leading."""
        folder = f"{self._open()}/csv"
        if self.manifest("csv").filter("part IS NOT NULL").isEmpty():
            return self.spark.createDataFrame([], f"source string, {csv_ddl()}")
        return read_csv(self.spark, folder, source_first=True).select("source", *REPORT_COLUMNS)

    def json(self) -> DataFrame:
        """``source, place, piece``: the pieces of each document, ``place`` counting from 1 along it.

        A row's source is the last one that the manifest starts at or before it in its part.
        """
        lines = scan_text(self.spark, f"{self._open()}/json")

        def number(key: str):
            return F.regexp_extract("source", f"/{key}=([0-9]+)/", 1).cast("bigint").alias(key)

        pieces = lines.select(
            number("bucket"), number("part"), (F.col("line_number") - 1).alias("row"), F.lit(1).alias("kind"), F.col("line").alias("piece")
        )
        starts = self.manifest("json").filter("part IS NOT NULL").selectExpr(
            "CAST(bucket AS BIGINT) AS bucket", "part", "first AS row", "0 AS kind", "source"
        )
        along = Window.partitionBy("bucket", "part").orderBy("row", "kind")
        named = (
            pieces.unionByName(starts, allowMissingColumns=True)
            .withColumn("source", F.last("source", ignorenulls=True).over(along))
            .filter("kind = 1")
        )
        begins = self.manifest("json").filter("part IS NOT NULL").groupBy("source").agg(
            F.min(F.expr(f"part * {self.rows_per_part} + first")).alias("begin")
        )
        met = with_source_facts(named, begins, "row")
        return met.selectExpr("source", f"part * {self.rows_per_part} + row - begin + 1 AS place", "piece")
