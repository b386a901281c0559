"""Keyed stream monitor: the batch rules as state per source.

Input is a stream of ``source, line_number, line``. Parsing and scoring are the same Column
expressions as in batch; only the ordered part (previous line, error flag, digest, counters)
is state. A source's lines must arrive in number order across micro-batches; a line at or
below the last number seen goes to the ``late`` rows and never touches the chain.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tracewarden.config import ScanConfig
from tracewarden.operators.chain import START
from tracewarden.operators.gaps import score_gaps
from tracewarden.operators.parsing import parse_lines

STATE = (
    "last_number bigint, was_error boolean, previous_number bigint, previous_raw_us bigint, "
    "previous_us bigint, previous_line string, first_us bigint, digest string, total_lines bigint, "
    "parsed_lines bigint, error_lines bigint, error_bursts bigint, gap_count bigint"
)
OUTPUT = (
    "kind string, source string, gap_number bigint, line_number_start bigint, line_number_end bigint, "
    "start_us bigint, end_us bigint, delta_us bigint, line_before_gap string, line_after_gap string, "
    "first_us bigint, last_us bigint, total_lines bigint, parsed_lines bigint, malformed_lines bigint, "
    "error_lines bigint, error_bursts bigint, gaps_detected bigint, final_hash string"
)
OUTPUT_NAMES = [part.split()[0] for part in OUTPUT.split(", ")]


def _lift(raw: np.ndarray, before: np.ndarray, syslog: np.ndarray) -> np.ndarray:
    """December to January steps of year-less stamps move to the next year (raw microseconds)."""
    here, prior = raw.astype("datetime64[us]"), before.astype("datetime64[us]")
    month = here.astype("datetime64[M]").astype(np.int64) % 12
    prior_month = prior.astype("datetime64[M]").astype(np.int64) % 12
    crossing = syslog & (raw < before) & (prior_month == 11) & (month == 0)
    target = prior.astype("datetime64[Y]") + 1
    day_us = np.timedelta64(1, "D") // np.timedelta64(1, "us")
    own_year = here.astype("datetime64[Y]")
    shift = (target.astype("datetime64[D]") - own_year.astype("datetime64[D]")).astype(np.int64) * day_us
    return np.where(crossing, raw + shift, raw)


class SourceMonitor(StatefulProcessor):
    """State of one source: what a line-by-line reader would keep between two lines."""

    def __init__(self, threshold: float) -> None:
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("source", STATE)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fields = [part.split()[0] for part in STATE.split(", ")]
        if self.state.exists():
            known = dict(zip(fields, self.state.get()))
        else:
            known = dict.fromkeys(fields)
            known.update(last_number=0, was_error=False, digest=START)
            for name in ("total_lines", "parsed_lines", "error_lines", "error_bursts", "gap_count"):
                known[name] = 0

        batch = pd.concat(list(rows), ignore_index=True).sort_values("line_number", kind="stable")
        late = (batch["line_number"] <= known["last_number"]) | batch["line_number"].duplicated()
        if late.any():
            yield self._rows(
                key[0],
                "late",
                line_number_end=batch.loc[late, "line_number"],
                line_after_gap=batch.loc[late, "line"],
            )
        batch = batch[~late]
        if batch.empty:
            return

        errors = batch["is_error"].to_numpy(dtype=bool)
        rising = errors & ~np.concatenate([[bool(known["was_error"])], errors[:-1]])
        known["total_lines"] += len(batch)
        known["error_lines"] += int(errors.sum())
        known["error_bursts"] += int(rising.sum())
        known["was_error"] = bool(errors[-1])
        known["last_number"] = int(batch["line_number"].iloc[-1])

        parsed = batch[batch["ts_us"].notna()]
        if len(parsed):
            gaps = self._steps(parsed, known)
            if len(gaps["delta_us"]):
                yield self._rows(key[0], "gap", **gaps)
        self.state.update(tuple(known[f] for f in fields))
        yield self._rows(
            key[0],
            "status",
            first_us=[known["first_us"]],
            last_us=[known["previous_us"]],
            total_lines=[known["total_lines"]],
            parsed_lines=[known["parsed_lines"]],
            malformed_lines=[known["total_lines"] - known["parsed_lines"]],
            error_lines=[known["error_lines"]],
            error_bursts=[known["error_bursts"]],
            gaps_detected=[known["gap_count"]],
            final_hash=[known["digest"]],
        )

    def _steps(self, parsed: pd.DataFrame, known: dict) -> dict:
        """Gaps among the parsed lines of this batch; moves ``known`` to its last line."""
        raw = parsed["ts_us"].to_numpy(dtype=np.int64)
        numbers = parsed["line_number"].to_numpy(dtype=np.int64)
        lines = parsed["line"].to_numpy(dtype=object)
        fresh = known["previous_us"] is None
        before_raw = np.concatenate([[raw[0] if fresh else known["previous_raw_us"]], raw[:-1]])
        us = _lift(raw, before_raw, (parsed["parser"] == "SYSLOG").to_numpy(dtype=bool))
        before_us = np.concatenate([[us[0] if fresh else known["previous_us"]], us[:-1]])
        before_number = np.concatenate([[0 if fresh else known["previous_number"]], numbers[:-1]])
        before_line = np.concatenate([[None if fresh else known["previous_line"]], lines[:-1]])

        delta = us - before_us
        hit = delta / 1_000_000.0 > self.threshold
        count = int(hit.sum())
        gaps = {
            "gap_number": np.arange(1, count + 1) + known["gap_count"],
            "line_number_start": before_number[hit],
            "line_number_end": numbers[hit],
            "start_us": before_us[hit],
            "end_us": us[hit],
            "delta_us": delta[hit],
            "line_before_gap": before_line[hit],
            "line_after_gap": lines[hit],
        }
        digest = known["digest"]
        for line in lines:
            digest = hashlib.sha256((line + digest).encode()).hexdigest()
        known.update(
            digest=digest,
            gap_count=known["gap_count"] + count,
            parsed_lines=known["parsed_lines"] + len(parsed),
            previous_number=int(numbers[-1]),
            previous_raw_us=int(raw[-1]),
            previous_us=int(us[-1]),
            previous_line=lines[-1],
        )
        if known["first_us"] is None:
            known["first_us"] = int(us[0])
        return gaps

    @staticmethod
    def _rows(source: str, kind: str, **values) -> pd.DataFrame:
        size = len(next(iter(values.values())))
        text = {"kind", "source", "line_before_gap", "line_after_gap", "final_hash"}
        out = {}
        for name in OUTPUT_NAMES:
            if name in values:
                data = values[name]
            elif name in ("kind", "source"):
                data = [kind if name == "kind" else source] * size
            else:
                data = [None] * size
            out[name] = pd.Series(list(data), dtype=object if name in text else "Int64")
        return pd.DataFrame(out)


def monitor_stream(lines: DataFrame, config: ScanConfig) -> DataFrame:
    """Rows of kind ``gap``, ``late`` and ``status`` (one per source and micro-batch)."""
    # ship this module's class with the query, whether or not workers have the package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    parsed = parse_lines(lines, config).select(
        "source", "line_number", "line", "ts_us", "parser", "is_error"
    )
    return parsed.groupBy("source").transformWithStateInPandas(
        statefulProcessor=SourceMonitor(config.effective_threshold),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="None",
    )


def monitor_gaps(rows: DataFrame, config: ScanConfig) -> DataFrame:
    """The gap rows of a monitor, scored as in batch."""
    columns = [
        "source",
        "gap_number",
        "line_number_start",
        "line_number_end",
        "start_us",
        "end_us",
        "delta_us",
        "line_before_gap",
        "line_after_gap",
    ]
    return score_gaps(rows.filter(F.col("kind") == "gap").select(*columns), config)


def monitor_late(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("kind") == "late").select(
        "source",
        F.col("line_number_end").alias("line_number"),
        F.col("line_after_gap").alias("line"),
        F.lit("late").alias("reason"),
    )


def monitor_status(rows: DataFrame) -> DataFrame:
    """Latest counters per source from a monitor's written output."""
    names = OUTPUT_NAMES[OUTPUT_NAMES.index("first_us") :]
    latest = F.max_by(F.struct(*names), F.col("total_lines")).alias("s")
    return rows.filter(F.col("kind") == "status").groupBy("source").agg(latest).select("source", "s.*")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Keep stream state in RocksDB (needed by the monitor) while queries are started."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(
        key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    try:
        yield
    finally:
        spark.conf.set(key, before)
