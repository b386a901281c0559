"""Two-pass external shuffle: records in uniformly random order, cut into shards of equal counts.

Pass 1 scatters the records into buckets small enough for a task's memory, by a seeded hash.
Pass 2 gathers each bucket as one array, permutes it with Fisher-Yates (Spark's ``shuffle``
function) and writes it out. Bucket after bucket, the written records are one random
permutation of the input; shards are equal runs of it, so that their counts differ by one at
most. Only built-in functions are used.

Scale: records move once, in pass 2. Buckets grow in number with the bytes, never in size;
their offsets are two levels of sums, so no window holds all buckets. A bucket is chosen from
the whole record and its input partition, so that not even rows that are equal in all columns
can meet in one bucket in more than a partition's number. The bucket is staged with the record
before anything is counted: a lost executor or another split of the input cannot move records
between the two passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewarden.llm.common import free_names, stage, table, utf8_size

BUCKET_BYTES = 16 << 20
RUN = 1_000  # buckets in a run of the first level of offsets


def scatter(docs: DataFrame, bucket: str, shards: int, bucket_bytes: int, seed: int, text: str) -> DataFrame:
    """Pass 1: every record with its bucket, staged."""
    total = docs.agg(F.sum(utf8_size(text) + 64)).first()[0] or 0
    buckets = max(shards, -(-total // bucket_bytes))
    spread = F.xxhash64(F.lit(seed), F.spark_partition_id(), *[F.col(f"`{c}`") for c in docs.columns])
    return stage(docs.withColumn(bucket, F.pmod(spread, F.lit(buckets)).cast("int")), "scattered")


def bucket_offsets(scattered: DataFrame, bucket: str) -> DataFrame:
    """``bucket, __first``: number of records in earlier buckets, by sums within and over runs of buckets."""
    sizes = scattered.groupBy(bucket).agg(F.count(F.lit(1)).alias("__rows"))
    run = F.expr(f"`{bucket}` div {RUN}").alias("__run")
    inside = Window.partitionBy("__run").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(bucket, "__rows", run)
    runs = sizes.groupBy("__run").agg(F.sum("__rows").alias("__all"))
    runs = runs.select("__run", F.coalesce(F.sum("__all").over(over), F.lit(0)).alias("__before"))
    own = F.coalesce(F.sum("__rows").over(inside), F.lit(0))
    return sizes.withColumn("__own", own).join(runs, "__run").select(
        bucket, (F.col("__own") + F.col("__before")).alias("__first")
    )


def shuffle_into_shards(
    docs: DataFrame, shards: int = 40, bucket_bytes: int = BUCKET_BYTES, seed: int = 7, text: str = "text"
) -> DataFrame:
    """All records of ``docs`` in random order, with ``shard`` (0 to ``shards``-1) and gapless ``slot``.

    A column of ``docs`` named ``shard`` or ``slot`` (in any case) is replaced. Null values and
    empty texts are records like any other; repeated rows stay repeated; an empty table gives an
    empty table. Which record gets which slot depends on the seed and on how the input is split.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("shard", "slot")])
    bucket, record, place = free_names(docs, ("bucket", "record", "place"))
    scattered = scatter(docs, bucket, shards, bucket_bytes, seed, text)
    rows = scattered.count()
    columns = [F.col(f"`{c}`") for c in docs.columns]
    gathered = (
        scattered.repartition(F.col(bucket))
        .groupBy(bucket)
        .agg(F.collect_list(F.struct(*columns)).alias(record))
        .select(bucket, F.posexplode(F.shuffle(record, F.lit(seed))).alias(place, record))
    )
    order = F.col("__first") + F.col(place)
    shard = F.expr(f"(({{o}}) * {shards}) div {max(rows, 1)}".replace("{o}", f"`{place}` + __first"))
    # the first place of shard s is the smallest p with p * shards >= s * rows
    start = F.expr(f"(shard * {rows}L + {shards - 1}) div {shards}")
    return (
        gathered.join(bucket_offsets(scattered, bucket), bucket)
        .select(record, shard.cast("int").alias("shard"), order.alias(place))
        .select(*[F.col(record)[c].alias(c) for c in docs.columns], "shard", (F.col(place) - start).alias("slot"))
    )


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write the shuffled records as parquet, a folder for each shard, a file for each part of a bucket in it."""
    shuffle_into_shards(docs, **options).write.partitionBy("shard").parquet(path)


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards whose counts are at most one apart (law ``rows``)."""
    placed = shuffle_into_shards(table(spark, folder, "documents"))
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    return placed.select(
        "doc_id",
        (utf8_size("text") + 16).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
