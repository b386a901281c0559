"""Small helpers that the operators of this package share."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from itertools import count
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewarden.sources.staging import new_folder, stage

# the blanks that separate words, as one character class; bytes.split() splits at exactly these
BLANKS = "\\x20\\x09-\\x0D"

__all__ = [
    "BLANKS", "bounded_batches", "drop_worker_tables", "fold", "free_names", "hold_out", "raw_bytes", "stage", "stage_small", "table",
    "utf8_size", "worker_tables",
]


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Let batches to Python hold 4 MB instead of Spark's 64 where the session does not say otherwise.

    Rows of this package are texts, and two workers of an executor hold a few batches each. This is the only setting
    of a session that the package makes; the registered queries and the pipeline's stages call it, operators do not.
    """
    if spark.conf.get(BATCH_BYTES) in ("64MB", "67108864", "67108864b"):
        spark.conf.set(BATCH_BYTES, "4MB")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage_small(df: DataFrame, name: str) -> DataFrame:
    """Like ``stage``, in a codec that takes less room for large tables."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hold_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """True for rows whose CRC-32 of the id written as text leaves ``remainder``; null ids are not held out."""
    left = F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % modulus
    return F.coalesce(left == remainder, F.lit(False))


def utf8_size(text: str | Column) -> Column:
    """Bytes of the text in UTF-8; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def fold(text: str | Column) -> Column:
    """A-Z in lower case, every other character as it is; null becomes the empty text."""
    return F.translate(
        F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def raw_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A string column as UTF-8 bytes without decoding; nulls become empty."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return [v or b"" for v in column.cast(pa.large_binary() if large else pa.binary()).to_pylist()]


_KEPT = "tracewarden_worker_tables"


def worker_tables() -> dict:
    """What this worker process keeps from task to task; this package travels by value, so a module made here holds it."""
    return sys.modules.setdefault(_KEPT, ModuleType(_KEPT)).__dict__.setdefault("tables", {})


def drop_worker_tables() -> None:
    """Called by tasks that need the memory: workers go on to the tasks of other operators, and would hold tables to the end."""
    worker_tables().clear()


def free_names(df: DataFrame, names: Iterable[str]) -> Iterator[str]:
    """Column names built from ``names`` that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    for name in names:
        tries = (f"__{name}{n or ''}" for n in count())
        yield next(t for t in tries if t.lower() not in taken)
