"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Two texts are equal when they are identical after A-Z are in lower case.

1. Every task hashes its texts and keeps, for each run of at most ``SENDER_ROWS`` rows (a sender), ids,
   fingerprints and digests in one row of a staged table.
2. A sender cuts its sorted distinct fingerprints to as many bits as keep false alarms rare, splits them
   by value among the owners, and sends each owner the differences in Golomb-Rice code.
3. An owner merges the lists it gets and answers every sender with two bitmaps, one bit per fingerprint
   sent: whether another sender has it, too, and whether so many have it that its group is hot.
4. Rows whose fingerprint is shared, within a sender or between senders, are suspects. Only their texts are
   shuffled: they are grouped by their bytes, which settles false alarms, and named by their digest.
5. The size and the last id of every group go back to its rows.

Scale: what all rows send is about ``log2(rows / rows of a sender) + 14`` bits each. Grouping by the bytes combines
equal texts before the shuffle, and hot groups are salted, so copies that make up a third of all rows
meet in no single task. Other texts never leave their task: the suspects are found by a hash that is
broadcast for up to ``MAX_BROADCAST`` distinct texts; for more it is shuffled and joined, whereby texts move.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewarden.llm.common import fold, raw_bytes, stage, table

SENDER_ROWS = 100_000
OWNER_PRINTS = 20_000  # fingerprints that an owner gets, about ...
LEAST_SENT = 16  # ... if a sender then has so many for each owner; more per owner otherwise
LEAST_BITS, ALARM_BITS = 24, 12  # of a fingerprint; a lone one is taken for a shared one with a probability of 2^-12
HOT_SENDERS = 8
SALTS = 32
MAX_BROADCAST = 1_000_000  # rows of 9 bytes

SENDERS = "sender bigint, n bigint, ids array<bigint>, prints binary, raw binary, digests binary"
MESSAGES = "owner int, sender bigint, n int, blob binary"
ANSWERS = "owner int, sender bigint, shared binary, hot binary"


def rice_parameter(values: np.ndarray) -> int:
    """The number of low bits for which sorted ``values`` take least room."""
    mean = int(values[-1]) / len(values) if len(values) else 0
    return max(0, int(mean * 0.69).bit_length() - 1)


def rice_encode(values: np.ndarray) -> bytes:
    """Sorted distinct values below 2^63 as a number of low bits, then quotients in unary and low bits, each as one bit stream."""
    if not len(values):
        return b""
    steps = np.diff(values.astype(np.int64), prepend=0)
    low = rice_parameter(values)
    quotient = steps >> low
    unary = np.zeros(int(quotient.sum()) + len(steps), np.uint8)
    unary[np.cumsum(quotient + 1) - 1] = 1
    bits = ((steps[:, None] >> np.arange(low)) & 1).astype(np.uint8)
    head = bytes([low]) + len(unary).to_bytes(5, "little")
    return head + np.packbits(unary).tobytes() + np.packbits(bits.ravel()).tobytes()


def rice_decode(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    low, size = blob[0], int.from_bytes(blob[1:6], "little")
    body = np.frombuffer(blob, np.uint8, offset=6)
    cut = -(-size // 8)
    stops = np.flatnonzero(np.unpackbits(body[:cut], count=size))
    steps = (np.diff(stops, prepend=-1) - 1) << low
    if low:
        bits = np.unpackbits(body[cut:], count=n * low).reshape(n, low).astype(np.int64)
        steps += bits @ (np.int64(1) << np.arange(low, dtype=np.int64))
    return np.cumsum(steps)


def senders(docs: DataFrame) -> DataFrame:
    """Ids, fingerprints, hashes of the raw texts and digests of each run of rows of a task; staged."""

    def work(batches):
        number = TaskContext.get().partitionId() << 24
        ids: list = []
        prints, digests, raw = [], [], []

        def flush():
            nonlocal number
            columns = [
                pa.array([number], pa.int64()),
                pa.array([len(ids)], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([np.array(prints, np.uint64).tobytes()], pa.binary()),
                pa.array([np.concatenate(raw).tobytes()], pa.binary()),
                pa.array([b"".join(digests)], pa.binary()),
            ]
            number += 1
            for held in (ids, prints, digests, raw):
                held.clear()
            return pa.RecordBatch.from_arrays(columns, ["sender", "n", "ids", "prints", "raw", "digests"])

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                for text in raw_bytes(some.column(1)):
                    text = text.lower()  # bytes: A-Z only
                    prints.append(xxhash.xxh3_64_intdigest(text))
                    digests.append(hashlib.sha256(text).digest())
                ids += some.column(0).to_pylist()
                raw.append(some.column(2).to_numpy())
                if len(ids) >= SENDER_ROWS:
                    yield flush()
        if ids:
            yield flush()

    narrow = docs.select("doc_id", "text", F.xxhash64("text").alias("raw"))
    return stage(narrow.mapInArrow(work, SENDERS), "senders")


def _sent(prints: bytes, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct fingerprints of ``bits`` bits, the number of each row's among them, and how many rows have it."""
    values = (np.frombuffer(prints, np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    return np.unique(values, return_inverse=True, return_counts=True)


def _borders(values: np.ndarray, owners: int, bits: int) -> np.ndarray:
    """Where the share of each owner begins; shares are equal ranges of values."""
    starts = [(k << bits) // owners for k in range(owners + 1)]
    return np.searchsorted(values, np.array(starts, np.int64))


def messages(sent: DataFrame, owners: int, bits: int) -> DataFrame:
    """What every sender sends to every owner."""

    def work(batches):
        for batch in batches:
            for sender, prints in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values, _, _ = _sent(prints, bits)
                border = _borders(values, owners, bits)
                rows = []
                for k in np.flatnonzero(np.diff(border)).tolist():
                    own = values[border[k] : border[k + 1]] - (k << bits) // owners
                    rows.append((k, sender, len(own), rice_encode(own)))
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(arrays, ["owner", "sender", "n", "blob"])

    return sent.select("sender", "prints").mapInArrow(work, MESSAGES)


def answer(part: pa.Table) -> pa.Table:
    """Bitmaps for all lists that one owner got."""
    sizes = part.column("n").to_pylist()
    lists = [rice_decode(blob, n) for blob, n in zip(part.column("blob").to_pylist(), sizes)]
    _, place, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    times = times[place]
    ends = np.cumsum([0, *sizes])
    shared = [np.packbits(times[a:b] > 1).tobytes() for a, b in zip(ends[:-1], ends[1:])]
    hot = [np.packbits(times[a:b] >= HOT_SENDERS).tobytes() for a, b in zip(ends[:-1], ends[1:])]
    columns = {"owner": part.column("owner"), "sender": part.column("sender")}
    return pa.table({**columns, "shared": pa.array(shared, pa.binary()), "hot": pa.array(hot, pa.binary())})


def _marked(bits: int, owners: int):
    """Rows of a sender with what the answers say of them: 0 alone, 1 suspect, 2 suspect in a hot group."""

    def work(sender: pa.Table, answers: pa.Table) -> pa.Table:
        if not sender.num_rows:
            return out.empty_table()
        values, place, times = _sent(sender.column("prints")[0].as_py(), bits)
        border = _borders(values, owners, bits)
        state = (times > 1).astype(np.int8)
        for k, shared, hot in zip(*[answers.column(c).to_pylist() for c in ("owner", "shared", "hot")]):
            a, b = border[k], border[k + 1]
            one, two = (np.unpackbits(np.frombuffer(x, np.uint8), count=b - a) for x in (shared, hot))
            state[a:b] = np.maximum(state[a:b], one + two)
        digests = pa.Array.from_buffers(pa.binary(32), len(place), [None, pa.py_buffer(sender.column("digests")[0].as_py())])
        columns = [
            sender.column("ids").combine_chunks().flatten(),
            digests.cast(pa.binary()),
            pa.array(np.frombuffer(sender.column("raw")[0].as_py(), np.int64)),
            pa.array(state[place]),
        ]
        return pa.table(columns, schema=out)

    out = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("raw", pa.int64()), ("state", pa.int8())])
    return work


def facts(sent: DataFrame) -> DataFrame:
    """``doc_id, digest, raw, state`` of every row, by exchange of fingerprints; staged."""
    rows, count = sent.agg(F.sum("n"), F.count(F.lit(1))).first()
    rows = rows or 0
    bits = min(62, max(LEAST_BITS, rows.bit_length() + ALARM_BITS))
    owners = max(1, min(rows // OWNER_PRINTS, rows // max(count, 1) // LEAST_SENT))
    answers = messages(sent, owners, bits).groupBy("owner").applyInArrow(lambda part: answer(part), ANSWERS)
    own = sent.select("sender", "ids", "prints", "raw", "digests")
    schema = "doc_id bigint, digest binary, raw bigint, state tinyint"
    marked = own.groupBy("sender").cogroup(answers.groupBy("sender")).applyInArrow(_marked(bits, owners), schema)
    return stage(marked, "facts")


def _groups(docs: DataFrame, suspects: DataFrame) -> DataFrame:
    """``digest, hot, keep_id, n`` of the groups of equal texts among the suspects; staged."""
    few = suspects.count() <= MAX_BROADCAST
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("raw"))
    chosen = hashed.join(F.broadcast(suspects) if few else suspects, "raw")
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(F.lit(0))
    texts = chosen.select(fold(F.col("text")).alias("folded"), "hot", salt.alias("salt"), "doc_id")
    last, n = F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    parts = texts.groupBy("folded", "hot", "salt").agg(last, n)
    # the bytes of hot groups are compared once more, without salt; those of others are not needed any longer
    digest = F.unhex(F.sha2(F.encode("folded", "UTF-8"), 256)).alias("digest")
    parts = stage(parts.select(digest, F.when(F.col("hot"), F.col("folded")).alias("folded"), "hot", "keep_id", "n"), "parts")
    whole = parts.filter("hot").groupBy("digest", "folded").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    cold = parts.filter("NOT hot").select("digest", "hot", "keep_id", "n")
    return stage(cold.unionByName(whole.select("digest", F.lit(True).alias("hot"), "keep_id", "n")), "groups")


def exact_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    A null text counts as empty. ``keep_id`` is the largest id of the rows with an equal text, ``kept`` whether
    a row has it. Rows repeated with one id all have the same answer. A row without an id counts in
    ``group_size`` and is kept only if no row of its group has an id. Other columns are not read. An empty
    table gives an empty one.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = facts(senders(narrow))
    shared = rows.filter("state > 0")
    suspects = stage(shared.groupBy("raw").agg((F.max("state") == 2).alias("hot")), "suspects")
    groups = _groups(narrow, suspects)
    copies = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = groups.select("digest", "keep_id", "n", F.explode(copies).alias("salt"))
    salt = F.when(F.col("state") == 2, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    met = shared.select("doc_id", "digest", salt.alias("salt")).join(salted, ["digest", "salt"])
    alone = rows.filter("state = 0").select("doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("n"))
    return alone.unionByName(met.drop("salt")).select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


OP11_SQL = """
WITH folded AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS folded
  FROM documents),
grouped AS (
  SELECT folded, max(doc_id) AS keep_id, count(*) AS group_size FROM folded GROUP BY folded)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(folded) AS text_sha256
FROM folded JOIN grouped USING (folded)
"""
