"""Progress of running streams: what each micro-batch took in, and how fast."""

from __future__ import annotations

import threading
from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tracewarden.plans.progress import lines_per_second

ARRIVED = "arrived_lines"
PROGRESS = "query string, batch bigint, lines bigint, bytes bigint, seconds double, lines_per_second double"


def observe_arrivals(stream: DataFrame) -> DataFrame:
    """Count lines and their UTF-8 bytes as they enter; the counts arrive in the query's progress events."""
    size = F.coalesce(F.sum(F.octet_length("line")), F.lit(0))
    return stream.observe(ARRIVED, F.count(F.lit(1)).alias("lines"), size.alias("bytes"))


class StreamMetrics(StreamingQueryListener):
    """Collects the arrivals of all streams of a session, a row per query and micro-batch.

    Register with ``spark.streams.addListener``. ``query`` is the id that a query keeps over restarts, so a
    micro-batch that is run again replaces its row. The newest ``keep`` rows stay in the driver; per source, the
    tables of ``streaming.carry`` keep the counts.
    """

    def __init__(self, keep: int = 10_000) -> None:
        self._keep = keep
        self._rows: OrderedDict[tuple[str, int], tuple] = OrderedDict()
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(ARRIVED)
        if seen is None or not seen["lines"]:
            return
        query, seconds = str(progress.id), progress.durationMs.get("triggerExecution", 0) / 1000
        row = (query, progress.batchId, seen["lines"], seen["bytes"], seconds, lines_per_second(seen["lines"], seconds))
        with self._change:
            self._rows.pop(row[:2], None)
            self._rows[row[:2]] = row
            while len(self._rows) > self._keep:
                self._rows.popitem(last=False)

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def wait_for(self, run_id: str, seconds: float = 60) -> None:
        """Until the events of a run that has ended are all here; they come some time after it."""
        with self._change:
            if not self._change.wait_for(lambda: str(run_id) in self._ended, seconds):
                raise TimeoutError(f"no end of run {run_id} reported within {seconds} seconds")

    def table(self, spark: SparkSession) -> DataFrame:
        """``query, batch, lines, bytes, seconds, lines_per_second``."""
        with self._change:
            rows = list(self._rows.values())
        return spark.createDataFrame(rows, PROGRESS)
