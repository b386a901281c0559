"""Arriving log files: every micro-batch is a batch scan of whole new files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracewarden.config import ScanConfig
from tracewarden.operators.parsing import parse_lines
from tracewarden.plans.scan import ScanResult, scan_parsed
from tracewarden.sources.staging import stage
from tracewarden.sources.text import located_lines, number_lines


def watch_folder(
    spark: SparkSession,
    folder: str,
    config: ScanConfig,
    handle: Callable[[ScanResult, int], None],
    checkpoint: str,
    max_files_per_batch: int = 1000,
    every: str | None = None,
) -> StreamingQuery:
    """Scan each arriving file as one source and hand the results to ``handle(result, batch_id)``.

    Without ``every`` the query ends after the files that are there now; with an interval it keeps watching.
    The file source delivers whole files, so numbering inside a micro-batch is complete. A
    batch may be replayed after a failure: write per ``batch_id`` with overwrite.
    """
    stream = (
        spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", max_files_per_batch).text(folder)
    )
    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("*", F.monotonically_increasing_id().alias("row_id"))
        parsed = number_lines(stage(parse_lines(rows, config), "parsed"))
        handle(scan_parsed(parsed, config), batch_id)

    writer = located_lines(stream).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
