"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find.

Every shingle draws a random permutation of the signature's places, one place per step, and
offers the rank ``step + random`` at the place drawn; a place keeps the least offer. Steps run
for all shingles of a text at once and stop as soon as no later step can lower any place, which
for a text of a thousand words is after the first.

1. One pass over the texts gives the number of distinct shingles, a fingerprint of the set and
   the keys of 40 bands of 8 signature places.
2. Texts with equal sets form a class; only the one with the smallest id goes on.
3. Members of a band's bucket are compared with one of them, the bucket's first in a random order, on
   their full sets; links are grouped by union-find.
4. Members of buckets that still hold several groups get longer signatures and finer bands. In a
   finer bucket of at most ``SMALL_BUCKET`` members, those of different groups whose signatures agree
   enough are compared. In a larger one, all those of different groups are: with one member in
   the first round, then two, up to ``MAX_PIVOTS`` a round, until no such pair is untested.

Two sets of similarity 0.85 share no band with a probability of about 1e-5.

Scale: one row per text and 40 narrow rows per class move; texts do not, unless more than
``MAX_BROADCAST_IDS`` need their sets for verification. A bucket's pairs are a star plus what lies
between groups, never all pairs of copies: copies end up in one group after step 3. A bucket or
a class with a third of all rows meets its smallest member in an equi-join that is salted or
split by adaptive execution.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewarden.llm.common import drop_worker_tables, raw_bytes, stage, table
from tracewarden.llm.components import components
from tracewarden.llm.words import mix, windows, word_hashes

SHINGLE = 5
PLACES, BANDS, ROWS = 128, 40, 8
PERCENT = 85
SALTS = 16
ORDERS = 4
SMALL_BUCKET = 4_096
LOOKS_ALIKE = 0.78  # of fine places; for a pair at the limit, 4.4 standard deviations below the mean
MAX_PIVOTS = 64
MAX_BROADCAST_IDS = 1_000_000  # 8 bytes each

FINE_PLACES, FINE_BANDS, FINE_ROWS = 512, 120, 12  # for what the first comparison leaves apart


def _layout(places: int, bands: int, rows: int) -> np.ndarray:
    """The signature places of every band, from as many random permutations as it takes."""
    draw = np.random.Generator(np.random.PCG64(places))
    line = np.concatenate([draw.permutation(places) for _ in range(-(-bands * rows // places))])
    return line[: bands * rows].reshape(bands, rows)


BAND_PLACES = _layout(PLACES, BANDS, ROWS)
FINE_BAND_PLACES = _layout(FINE_PLACES, FINE_BANDS, FINE_ROWS)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes."""
    hashes, offsets = word_hashes(texts, lower=True)
    grams = windows(hashes, SHINGLE)
    sets = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= SHINGLE:
            sets.append(np.unique(grams[a : b - SHINGLE + 1]))
        elif b > a:
            sets.append(windows(hashes[a:b], int(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _sets_in_groups(texts: list[bytes], group_bytes: int = 1 << 18) -> Iterator[np.ndarray]:
    """The shingle set of each text; texts are hashed in groups of bounded size."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= group_bytes:
            yield from shingle_sets(group)
            group, size = [], 0
    yield from shingle_sets(group)


def signature(elements: np.ndarray, places: int = PLACES) -> np.ndarray:
    """SuperMinHash of a non-empty set of 64-bit values."""
    kept = np.full(places, np.inf)
    rows = np.arange(len(elements))
    order = first = None
    for step in range(places):
        drawn = mix(elements + np.uint64(int(_STEP) * (2 * step + 1) & 0xFFFFFFFFFFFFFFFF))
        other = (mix(drawn ^ _STEP) >> np.uint64(11)) % np.uint64(places - step)
        at = other.astype(np.int64) + step
        if step == 0:
            place = first = at
        else:
            if order is None:  # permutations are kept only for texts that need a second step
                order = np.tile(np.arange(places, dtype=np.int16), (len(elements), 1))
                order[rows, first] = 0
                order[rows, 0] = first
            place = order[rows, at]
            order[rows, at] = order[rows, step]
            order[rows, step] = place
        np.minimum.at(kept, place, step + (drawn >> np.uint64(11)).astype(np.float64) * 2.0**-53)
        if kept.max() < step + 1:
            break
    return kept


def band_keys(kept: np.ndarray, layout: np.ndarray = BAND_PLACES) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    bits = kept.view(np.uint64)[layout]
    keys = np.arange(1, len(layout) + 1, dtype=np.uint64)
    for k in range(layout.shape[1]):
        keys = mix(keys * _STEP + bits[:, k])
    return keys.view(np.int64)


def sketches(docs: DataFrame, text: str) -> DataFrame:
    """``doc_id, n_shingles, class_key, bands`` of every row; empty sets have neither key nor bands."""

    def work(batches):
        drop_worker_tables()
        for batch in batches:
            sizes, keys, bands = [], [], []
            for s in _sets_in_groups(raw_bytes(batch.column(1))):
                sizes.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(band_keys(signature(s)) if len(s) else None)
            columns = [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "class_key", "bands"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(work, "doc_id bigint, n_shingles bigint, class_key binary, bands array<bigint>")


def full_sets(docs: DataFrame, ids: DataFrame, text: str) -> DataFrame:
    """``id, items`` (sorted hashes) of the documents named in ``ids``; an id that occurs twice gives its first set only."""

    def work(batches):
        for batch in batches:
            items = [s.tobytes() for s in _sets_in_groups(raw_bytes(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(items, pa.binary())], ["id", "items"])

    wanted = ids.select(F.col("id").alias("doc_id")).distinct()
    few = wanted.count() <= MAX_BROADCAST_IDS
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    chosen = narrow.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi")
    return chosen.mapInArrow(work, "id bigint, items binary")


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs ``u, v`` whose full sets are similar enough."""

    def work(batches):
        for batch in batches:
            good = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
                if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
                    good.append(False)
                    continue
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                good.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("id").alias("u"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("v"), F.col("items").alias("y"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "x", "y").mapInArrow(work, "u bigint, v bigint")


def _representatives(sketched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets (``class_key, id, n``), and the bands of each class's smallest id as ``key, id``."""
    keyed = sketched.filter("class_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = keyed.groupBy("class_key").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
    classes = stage(classes, "classes")
    first = classes.select("class_key", F.col("id").alias("doc_id"))
    bands = keyed.join(first, ["class_key", "doc_id"]).select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"))
    return classes, bands


def _order() -> Column:
    """A random order of the members of a bucket, one of ``ORDERS``.

    Buckets that hold the same copies thus begin with several different ones, not all with the smallest id:
    what the first does not link with, another may. And not each with its own: that would be one
    comparison per band.
    """
    return F.xxhash64(F.col("id"), F.pmod(F.col("key"), F.lit(ORDERS)))


def _fine_members(members: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of coarse buckets of several groups in those of their finer buckets that hold several, too; staged.

    ``key, band, id, component_id, n`` (of the bucket), ``sketch, short``. Texts that share a passage but are
    no copies share a band now and then. Longer signatures and bands keep nearly all of them apart,
    and pairs similar enough together. The sketch is one byte of each place,
    ``short`` has four bytes of every fine key.
    """

    def work(batches):
        for batch in batches:
            kept = [signature(np.frombuffer(x.as_buffer(), np.uint64), FINE_PLACES) for x in batch.column(1)]
            keys = [band_keys(k, FINE_BAND_PLACES) for k in kept]
            short = [k.astype(np.int32).tobytes() for k in keys]
            small = [(mix(k.view(np.uint64)) & np.uint64(255)).astype(np.uint8).tobytes() for k in kept]
            lists = pa.array([k.tolist() for k in keys], pa.list_(pa.int64()))
            columns = [batch.column(0), lists, pa.array(small, pa.binary()), pa.array(short, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "keys", "sketch", "short"])

    rows = _labelled(members.select("key", "id"), groups)
    span = rows.groupBy("key").agg(F.min("component_id").alias("a"), F.max("component_id").alias("b"))
    ids = rows.join(span.filter("a < b").select("key"), "key", "left_semi").select("id").distinct()
    schema = "id bigint, keys array<bigint>, sketch binary, short binary"
    fine = stage(sets.join(ids, "id", "left_semi").mapInArrow(work, schema), "fine")
    labelled = _labelled(fine.select(F.posexplode("keys").alias("band", "key"), "id"), groups)
    labelled = stage(labelled, "fine_bands")
    span = labelled.groupBy("key").agg(
        F.min("component_id").alias("a"), F.max("component_id").alias("b"), F.count(F.lit(1)).alias("n")
    )
    span = stage(span.filter("a < b").select("key", "n"), "fine_buckets")
    return stage(labelled.join(span, "key").join(fine.drop("keys"), "id"), "fine_members")


def _pairs_in_small_buckets(fine: DataFrame) -> DataFrame:
    """Pairs ``u, v`` of different groups in buckets of at most ``SMALL_BUCKET``, which look similar enough.

    A pair comes from the first of the bands that it shares.
    """

    def work(part: pa.Table) -> pa.Table:
        ids, group = part.column("id").to_numpy(), part.column("component_id").to_numpy()
        band = part.column("band")[0].as_py()
        sketch = np.frombuffer(b"".join(raw_bytes(part.column("sketch"))), np.uint8).reshape(len(ids), FINE_PLACES)
        short = np.frombuffer(b"".join(raw_bytes(part.column("short"))), np.int32).reshape(len(ids), FINE_BANDS)[:, :band]
        found = [np.zeros((0, 2), np.int64)]
        for k in range(len(ids) - 1):
            at = k + 1 + np.flatnonzero(group[k + 1 :] != group[k])
            at = at[(sketch[at] == sketch[k]).mean(1) >= LOOKS_ALIKE]
            other = ids[at[~(short[at] == short[k]).any(1)]]
            found.append(np.stack([np.maximum(other, ids[k]), np.minimum(other, ids[k])], 1))
        pairs = np.concatenate(found)
        return pa.table({"u": pa.array(pairs[:, 0]), "v": pa.array(pairs[:, 1])})

    small = fine.filter(F.col("n") <= SMALL_BUCKET).select("key", "band", "id", "component_id", "sketch", "short")
    return small.groupBy("key").applyInArrow(work, "u bigint, v bigint").distinct()


def _labelled(members: DataFrame, groups: DataFrame) -> DataFrame:
    """``members`` with the group of each."""
    rows = members.join(groups, "id", "left")
    return rows.withColumn("component_id", F.coalesce("component_id", "id"))


def _shared_buckets(bands: DataFrame) -> DataFrame:
    """``key, id, pivot`` of buckets with at least two members; the pivot is the first in the bucket's order."""
    first = F.min(F.struct(_order(), "id"))["id"]
    span = bands.groupBy("key").agg(first.alias("pivot"), F.min("id").alias("least"), F.max("id").alias("last"))
    # staged, so that the join below can split a bucket with very many members
    span = stage(span.filter("least < last").select("key", "pivot"), "buckets")
    return stage(bands.join(span, "key").distinct(), "members")


def _open_pivots(members: DataFrame, groups: DataFrame, done: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Members of buckets with several groups, and up to ``most`` of each bucket that are to be compared next.

    Pivots lie outside the largest group of their bucket. Once compared with all members of other
    groups they are done; when none is left, every untested pair of a bucket lies within one group.
    """
    rows = _labelled(members.select("key", "id"), groups)
    sizes = rows.groupBy("key", "component_id").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.max_by("component_id", "n").alias("main"))
    mixed = stage(mixed.filter("k > 1").select("key", "main"), "mixed")
    rows = stage(rows.join(mixed, "key"), "mixed_members")
    outside = rows.filter("component_id <> main").join(done, ["key", "id"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(_order(), "id"))
    first = outside.withColumn("rank", rank).filter(F.col("rank") <= most)
    return rows, stage(first.select("key", F.col("id").alias("pivot"), F.col("component_id").alias("own")), "pivots")


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Null, empty and blank texts have no shingles and are linked with nothing. Rows with one id twice
    are judged each by its own text; a row without an id is kept, without a component.
    Other columns are not read. An empty table gives an empty one.
    """
    sketched = stage(sketches(docs, text), "sketches")
    classes, bands = _representatives(sketched)
    members = _shared_buckets(bands)
    sets = stage(full_sets(docs, members.select("id"), text).dropDuplicates(["id"]), "sets")
    pairs = members.filter("id <> pivot").select(F.col("id").alias("u"), F.col("pivot").alias("v")).distinct()
    edges = stage(links(pairs, sets), "links")
    groups = components(edges)
    fine = _fine_members(members, groups, sets)
    edges = stage(edges.unionByName(links(_pairs_in_small_buckets(fine), sets)), "links")
    groups = components(edges)
    members = fine.filter(F.col("n") > SMALL_BUCKET).select("key", "id")
    done = members.limit(0)
    most = 1
    while True:
        rows, pivots = _open_pivots(members, groups, done, most)
        if pivots.isEmpty():
            break
        met = rows.join(pivots, "key").filter("component_id <> own")
        pairs = met.select(F.greatest("id", "pivot").alias("u"), F.least("id", "pivot").alias("v")).distinct()
        edges = stage(edges.unionByName(links(pairs, sets)), "links")
        groups = components(edges)
        done = stage(done.unionByName(pivots.select("key", F.col("pivot").alias("id"))), "done")
        most = min(2 * most, MAX_PIVOTS)  # groups merge fast at first; later pairs rarely link
    return _per_document(sketched, classes, groups)


def _per_document(sketched: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Components of classes brought to their documents.

    A class of one document is met by its id, a class of several by its key, salted.
    """
    grouped = classes.join(groups, "id", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    salted = grouped.filter("n > 1").select(
        "class_key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.col("component_id").alias("shared")
    )
    alone = grouped.filter("n = 1 AND component_id <> id").select(F.col("id").alias("doc_id"), "class_key", "component_id")
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt")
    found = sketched.select("doc_id", "n_shingles", "class_key", salt).join(salted, ["class_key", "salt"], "left")
    found = found.join(alone, ["class_key", "doc_id"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("shared", "component_id", "doc_id"))
    found = found.select("doc_id", "n_shingles", component.alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))
