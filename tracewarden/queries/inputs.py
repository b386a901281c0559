"""Log lines derived from the given tables; every row of a table becomes one line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewarden.config import ScanConfig
from tracewarden.sources.tables import lines_from_table

CONFIG = ScanConfig(reference_year=2024)
FILE_EVENTS = 2_000  # events per derived log file


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_line() -> Column:
    """One event as text; five stamp layouts in turn, some corrupted and some empty lines."""
    ts, turn = F.col("ts"), F.col("event_id") % 5
    stamp = (
        F.when(turn == 0, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
        .when(turn == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(turn == 2, F.date_format(ts, "yyyy/MM/dd HH:mm:ss"))
        .when(turn == 3, F.date_format(ts, "dd/MMM/yyyy:HH:mm:ss"))
        .otherwise(F.date_format(ts, "MMM dd HH:mm:ss"))
    )
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    text = F.concat(stamp, F.lit(" ["), level, F.lit("] user="), F.col("user_id"), F.lit(" "), F.col("props"))
    return (
        F.when(F.col("event_id") % 389 == 0, "")
        .when(F.col("event_id") % 97 == 0, "corrupted entry")
        .otherwise(text)
    )


def service_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as eight interleaved sources."""
    source = F.concat(F.lit("svc-"), F.col("user_id") % 8)
    return lines_from_table(table(spark, folder, "events"), event_line(), source, "event_id")


def single_source_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as one source that already carries its order."""
    events = table(spark, folder, "events")
    return events.select(
        F.lit("all").alias("source"),
        (F.col("event_id") + 1).alias("line_number"),
        event_line().alias("line"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as year-less lines of seven sources in key order: many December to January steps."""
    orders = table(spark, folder, "orders")
    stamp = F.date_format("o_orderdate", "MMM d HH:mm:ss")
    line = F.concat(stamp, F.lit(" order "), F.col("o_orderkey"), F.lit(" "), F.col("o_orderpriority"))
    source = F.concat(F.lit("shop-"), F.col("o_custkey") % 7)
    return lines_from_table(orders, line, source, "o_orderkey")


def labelled_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as lines with level and service in brackets; one in 97 has neither stamp nor brackets."""
    events = table(spark, folder, "events")
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("value") > 10, "WARN").otherwise("INFO")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = F.concat(stamp, F.lit(" ["), level, F.lit("] ["), F.col("event_type"), F.lit("] "), F.col("props"))
    line = F.when(F.col("event_id") % 97 == 0, "corrupted entry").otherwise(text)
    source = F.concat(F.lit("host-"), F.col("user_id") % 5)
    return lines_from_table(events, line, source, "event_id")


def shipment_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as lines of three sources in the order of their orders: several rows tie in each order."""
    line = F.concat_ws(" ", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), "l_orderkey", "l_linenumber")
    source = F.concat(F.lit("dock-"), F.col("l_orderkey") % 3)
    return lines_from_table(table(spark, folder, "lineitem"), line, source, "l_orderkey")


def custom_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events in a layout that only a custom format reads."""
    events = table(spark, folder, "events")
    stamp = F.date_format("ts", "dd.MM.yyyy HH:mm:ss,SSSSSS")
    return events.select(
        F.lit("custom").alias("source"),
        (F.col("event_id") + 1).alias("line_number"),
        F.concat(stamp, F.lit(" "), F.col("event_type")).alias("line"),
    )


def event_files(spark: SparkSession, folder: str, target: str, mark: str = "") -> str:
    """Events written as text log files of ``FILE_EVENTS`` lines each, in event order; every second starts with ``mark``."""
    events = table(spark, folder, "events")
    lines = events.select(
        F.floor(F.col("event_id") / FILE_EVENTS).cast("bigint").alias("part"), "event_id", event_line().alias("line")
    )
    if mark:
        starts = F.col("event_id") % (2 * FILE_EVENTS) == 0
        lines = lines.withColumn("line", F.concat(F.when(starts, mark).otherwise(""), "line"))
    ordered = lines.repartition("part").sortWithinPartitions("part", "event_id")
    ordered.select("part", "line").write.partitionBy("part").text(target)
    return target
