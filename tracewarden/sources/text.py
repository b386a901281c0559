"""Text logs as ``(source, line_number, line)``.

Lines split at line feeds only, all trailing carriage returns are dropped and invalid UTF-8
becomes U+FFFD. Files are read in splits by many tasks; numbering needs no global sort: the
scan is staged once with each line's split and a rising id, the lines of earlier splits of
the same file are added up on a table of one row per split, and the number follows by
arithmetic. The ids are read back from the staged table rather than computed twice, so a
change of cluster size between two passes cannot shift the splits.

The reader swallows a byte-order mark at the start of a file. It is given back to line 1 of files that have three bytes
more than their lines and line ends add up to; sizes of compressed files do not tell, so theirs stay dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewarden.config import ScanConfig
from tracewarden.operators.parsing import parse_lines
from tracewarden.sources.staging import stage

# two integers and a flag per split, ~60 bytes in a broadcast map: at most ~180 MB, and 100 TB has ~800,000 splits of 128 MB
MAX_BROADCAST_SPLITS = 3_000_000
BYTE_ORDER_MARK = "\ufeff"
COMPRESSED = r"\.(gz|bz2|zst|lz4|snappy|deflate)$"


def _paths(paths: str | list[str]) -> list[str]:
    found = [paths] if isinstance(paths, str) else list(paths)
    if not found:
        raise ValueError("no input path given")
    return found


def file_facts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``source, file_name, file_size`` of every file; contents are not read.

    Scans skip empty files, so the names come from the listing the reader holds anyway.
    """
    files = spark.read.format("binaryFile").load(_paths(paths))
    listed = spark.createDataFrame([(path,) for path in files.inputFiles()], "source string")
    # the listing writes a missing host as "file:///", the scan as "file:/"
    listed = listed.select(F.regexp_replace("source", "^([a-z0-9]+):///", "$1:/").alias("source"))
    sized = files.select(
        F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_size").alias("file_size")
    )
    return listed.join(sized, "source", "left").select(
        "source",
        F.url_decode(F.regexp_replace(F.element_at(F.split("source", "/"), -1), "[+]", "%2B")).alias("file_name"),
        F.coalesce("file_size", F.lit(0)).cast("bigint").alias("file_size"),
    )


def read_splits(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Decoded lines with the split they came from and an id that rises along each split."""
    return decode_splits(spark.read.option("lineSep", "\n").text(_paths(paths)))


def located_lines(raw: DataFrame) -> DataFrame:
    """Decoded lines with their file, its size, their split and their length in bytes with one line end."""
    return raw.select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.col("_metadata.file_size").alias("file_size"),
        (F.octet_length("value") + 1).alias("line_bytes"),
        F.rtrim(F.make_valid_utf8(F.col("value")), F.lit("\r")).alias("line"),
    )


def decode_splits(raw: DataFrame) -> DataFrame:
    return located_lines(raw).withColumn("row_id", F.monotonically_increasing_id())


def number_lines(staged: DataFrame) -> DataFrame:
    """Replace place, size and row id of a staged scan by a dense 1-based ``line_number`` per source."""
    splits = staged.groupBy("source", "split_start").agg(
        F.min("row_id").alias("__first"),
        F.count(F.lit(1)).alias("__lines"),
        F.sum(F.col("line_bytes").cast("bigint")).alias("__bytes"),
        F.max("file_size").alias("__size"),
    )
    earlier = (
        Window.partitionBy("source").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.sum("__lines").over(earlier)
    shift = F.coalesce(before, F.lit(0)) - F.col("__first") + 1
    # a last line without an end counts one byte too many here
    unread = F.col("__size") - F.sum("__bytes").over(Window.partitionBy("source"))
    marked = before.isNull() & unread.isin(2, 3) & ~F.lower("source").rlike(COMPRESSED)
    # one integer names the split; should two splits share it, their full names do
    named = F.xxhash64("source", "split_start")
    offsets = splits.select(
        "source", "split_start", named.alias("__split"), shift.alias("__shift"), marked.alias("__marked")
    )
    offsets = stage(offsets, "splits")
    count, names = offsets.agg(F.count(F.lit(1)), F.count_distinct("__split")).first()
    if count == names:
        narrow = offsets.select("__split", "__shift", "__marked")
        few = F.broadcast(narrow) if count <= MAX_BROADCAST_SPLITS else narrow
        numbered = staged.withColumn("__split", named).join(few, "__split")
    else:
        numbered = staged.join(offsets, ["source", "split_start"])
    number = (F.col("row_id") + F.col("__shift")).cast("bigint")
    line = F.when(F.col("__marked") & (number == 1), F.concat(F.lit(BYTE_ORDER_MARK), "line")).otherwise(F.col("line"))
    placed = ("source", "split_start", "file_size", "line_bytes", "row_id")
    rest = [line.alias(c) if c == "line" else F.col(c) for c in staged.columns if c not in placed]
    return numbered.select("source", number.alias("line_number"), *rest)


def scan_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Numbered lines of the given files, folders or globs."""
    return number_lines(stage(read_splits(spark, paths), "lines"))


def scan_parsed_text(spark: SparkSession, paths: str | list[str], config: ScanConfig) -> DataFrame:
    """Like ``parse_lines(scan_text(...))``, parsed during the one pass over the text."""
    return number_lines(stage(parse_lines(read_splits(spark, paths), config), "parsed"))
