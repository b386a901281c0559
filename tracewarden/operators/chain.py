"""Rolling SHA-256 over parsed lines.

A chain is serial by definition: each digest needs the one before it. Two forms are given.

* ``sequential_chain``: the exact chain of a whole source. Lines are taken in rounds of a
  bounded number of lines per source; a round hands its digests to the next through a written
  table, so no task sorts more than one round of a source and a lost executor costs one
  round. Short rounds double, since each costs a job however few lines it has. Sources run side by
  side; a single source is as serial as its chain.
* ``segment_digests`` / ``segmented_chain``: one chain per fixed-size segment, all in
  parallel, then a chain over the segment digests. Another value that reveals the same changes,
  and a changed line is pinned to its segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.config import ScanConfig
from tracewarden.operators.blocks import block_of
from tracewarden.sources.staging import stage

START = "0" * 64
ROUND_LINES = 5_000_000  # of a source, to which shorter rounds grow


def _fold(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Chain ``payload`` (BINARY) in ``position`` order per key: ``keys..., digest``.

    Rows are spread by key and sorted by Spark; the Python side streams Arrow batches and
    keeps one digest. A ``carried`` row comes before all others of its key and holds the digest to
    start from.
    """
    names = [*keys, "position", "payload", "carried"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, schema = None, b"", None
        sha256, start = hashlib.sha256, START.encode()

        def rows_of(done: list[tuple]) -> pa.RecordBatch:
            cells = [pa.array(values, f.type) for values, f in zip(zip(*done), schema)]
            return pa.RecordBatch.from_arrays(cells, schema=schema)

        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            columns = [batch.column(i) for i in range(len(keys))]
            if schema is None:
                fields = [batch.schema.field(i) for i in range(len(keys))]
                schema = pa.schema([*fields, pa.field("digest", pa.string())])
            # rows are sorted by key: cut the batch where a key column changes
            changed = np.zeros(size, dtype=bool)
            for column in columns:
                differs = pc.not_equal(column.slice(1), column.slice(0, size - 1))
                changed[1:] |= differs.to_numpy(zero_copy_only=False)
            cuts = [0, *np.flatnonzero(changed).tolist(), size]
            payloads = batch.column(len(keys) + 1).to_pylist()
            done = []
            for first, last in zip(cuts, cuts[1:]):
                key = tuple(column[first].as_py() for column in columns)
                if key != current:
                    if current is not None:
                        done.append((*current, digest.decode()))
                    current, digest = key, start
                    if batch.column(len(keys) + 2)[first].as_py():
                        digest, first = payloads[first], first + 1
                for payload in payloads[first:last]:
                    digest = sha256(payload + digest).hexdigest().encode()
            if done:
                yield rows_of(done)
        if current is not None:
            yield rows_of([(*current, digest.decode())])

    types = dict(rows.dtypes)
    ddl = ", ".join([*(f"{k} {types[k]}" for k in keys), "digest string"])
    if "carried" not in rows.columns:
        rows = rows.withColumn("carried", F.lit(False))
    order = [*keys, F.desc("carried"), "position"]
    ordered = rows.select(*names).repartition(*keys).sortWithinPartitions(*order)
    return ordered.mapInArrow(run, ddl)


def _payload(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("ts_us").isNotNull()).select(
        "source",
        F.col("line_number").cast("bigint").alias("position"),
        F.col("line").cast("binary").alias("payload"),
    )


def round_ends(first: int, longest: int) -> list[int]:
    """The last line number of every round: ``first`` lines, then twice as many as the round before, at most ``ROUND_LINES``.

    Rounds of more than that from the start stay as long as they are.
    """
    ends, at, size = [], 0, first
    while at < longest or not ends:
        at += size
        ends.append(at)
        size = max(first, min(2 * size, ROUND_LINES))
    return ends


def sequential_chain(
    parsed: DataFrame, config: ScanConfig, staged: bool = False, before: DataFrame | None = None
) -> DataFrame:
    """``source, final_hash``: the chain over all parsed lines of each source.

    Malformed lines are not covered; a source without parsed lines has no row here (its
    hash is 64 zeros, which ``operators.stats`` fills in). Each round reads only its range of
    line numbers, so lines that are not ``staged`` yet are written once first. The first round has ``chain_chunk_lines``
    lines of each source, later ones up to ``ROUND_LINES`` or as many as the first. The number of rounds is
    that of the longest source: for sources of billions of lines use ``segment_digests``. With ``before``
    (``source, digest``) the chains of these sources go on from those digests.
    """
    rows = _payload(parsed) if staged else stage(_payload(parsed), "payload")
    longest = rows.agg(F.max("position")).first()[0] or 0  # one number, not rows
    rounds = round_ends(config.chain_chunk_lines, longest)
    ends = stage(rows.groupBy("source").agg(F.max("position").alias("end")), "chain_ends")
    first = rows.filter(F.col("position") <= rounds[0])
    if before is not None:
        begun = before.join(ends.select("source"), "source", "left_semi").select(
            "source",
            F.lit(0).cast("bigint").alias("position"),
            F.col("digest").cast("binary").alias("payload"),
            F.lit(True).alias("carried"),
        )
        first = first.withColumn("carried", F.lit(False)).unionByName(begun)
    digests = _fold(first, ["source"])
    finished = []
    for start, end in zip(rounds, rounds[1:]):
        # sources that end here leave; only the others are read and carried on
        carried = stage(digests.join(ends, "source"), f"chain_{start}")
        finished.append(carried.filter(F.col("end") <= start).select("source", "digest"))
        live = carried.filter(F.col("end") > start).select(
            "source",
            F.lit(start).cast("bigint").alias("position"),
            F.col("digest").cast("binary").alias("payload"),
            F.lit(True).alias("carried"),
        )
        chunk = rows.filter((F.col("position") > start) & (F.col("position") <= end))
        digests = _fold(chunk.withColumn("carried", F.lit(False)).unionByName(live), ["source"])
    for part in finished:
        digests = digests.unionByName(part)
    return digests.withColumnRenamed("digest", "final_hash")


def segment_digests(parsed: DataFrame, config: ScanConfig) -> DataFrame:
    """``source, segment, digest``: an independent chain per run of ``segment_lines`` lines."""
    rows = _payload(parsed).selectExpr("*", f"{block_of('position', config.segment_lines)} AS segment")
    return _fold(rows, ["source", "segment"])


def segmented_chain(digests: DataFrame) -> DataFrame:
    """``source, segment_count, segmented_hash``: the chain over a source's segment digests."""
    rows = digests.select(
        "source", (F.col("segment") + 1).alias("position"), F.col("digest").cast("binary").alias("payload")
    )
    counts = digests.groupBy("source").agg(F.count(F.lit(1)).alias("segment_count"))
    chained = _fold(rows, ["source"]).withColumnRenamed("digest", "segmented_hash")
    return counts.join(chained, "source")


def compare_digests(stored: DataFrame, rescanned: DataFrame) -> DataFrame:
    """Segments whose digests differ: ``source, segment, change`` (altered, missing, added)."""
    both = stored.withColumnRenamed("digest", "__old").join(
        rescanned.withColumnRenamed("digest", "__new"), ["source", "segment"], "full_outer"
    )
    change = (
        F.when(F.col("__new").isNull(), "missing")
        .when(F.col("__old").isNull(), "added")
        .when(F.col("__old") != F.col("__new"), "altered")
    )
    return (
        both.withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .select("source", "segment", "change")
    )


def first_difference(changes: DataFrame) -> DataFrame:
    """First changed segment per source; a source without a row here verified clean."""
    return changes.groupBy("source").agg(
        F.min("segment").alias("first_changed_segment"), F.count(F.lit(1)).alias("changed_segments")
    )
