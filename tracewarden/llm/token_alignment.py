"""Which tokens of one tokenizer stand for which of another, counted over all documents.

Both tokenizers read the same bytes. Where a token of each ends at the same byte the text is cut; the tokens between two
cuts form a group, and every A token of a group is linked with every B token of it.

1. A task tokenizes its texts and keeps the distinct linked pairs of each document. After ``RUN_RECORDS`` of them the
   pair-document records are sorted, A id by A id (the major side), radix-partitioned by A id, and spilled as a run:
   a row of a staged table with zstd blocks for the pairs, their numbers of documents, and the documents.
2. The pairs of all runs, one block per run and partition, go to the owner of the partition, which merges them with a heap
   of the runs' next blocks and adds up the documents of each pair. Since the order is A-major, the
   highest count of an A id is known when its pairs have passed. More than ``FAN`` runs are merged in several rounds.
3. The owner streams counts and the marks of highest ones back to every run, aligned with its pairs.
4. Each run, met by its answers, adds up what its documents get.

Scale: a run sends a pair once, whatever the number of its documents, so a pair that a third of all documents hold is
one entry per run. Texts and documents do not move; runs do once, compressed. Memory is bounded by a run, by ``FAN``
blocks, and by the pairs of one partition or of one document. Long texts are tokenized in slices.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewarden.llm.common import stage, table

PARTS = 64
RUN_RECORDS = 2_000_000
RUN_DOCS = 1 << 20
FAN = 256
BLOCK = 4_096  # pairs of a run that the merge takes at a time
GROUP_CHARS = 1 << 19  # texts are aligned in groups of this size
SLICE = 1 << 20  # longer texts are cut
SMALL_GROUP = 256  # links of a group that are written out one by one
LONG_BLANK = 1_000

B_BITS, DOC_BITS = 15, 20

RUNS = "run bigint, ids array<bigint>, facts binary, digests binary, pairs binary, body binary"
LISTS = "part int, run bigint, blob binary"

# a place to cut a text: both tokenizers begin anew at a single blank between two plain characters
_CUT = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")
_LONG_BLANK = re.compile(rf"\s{{{LONG_BLANK}}}")


def tokenizer_paths() -> tuple[str, str, str]:
    """Ranks and full form of the A tokenizer, which have the same vocabulary, and the model of B."""
    import public_tokenizers

    return tuple(public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))


class Encoders:
    """Both tokenizers with the bytes and the decimal id of every token."""

    def __init__(self, paths: tuple[str, str, str]):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(paths[0], "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.a = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.full_form, self.slow_a = paths[1], None
        self.b = sentencepiece.SentencePieceProcessor(model_file=paths[2])
        size_a, size_b = max(ranks.values()) + 2, self.b.get_piece_size()
        self.a_length = np.zeros(size_a, np.int64)
        for token, rank in ranks.items():
            self.a_length[rank] = len(token)
        self.b_bytes = [self._piece(n) for n in range(size_b)]
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        # an id followed by what comes after it: "," within a side, "|" after side A, ";" after side B
        marks = [(range(size_a), b","), (range(size_a), b"|"), (range(size_b), b","), (range(size_b), b";")]
        self.shown = [str(n).encode() + mark for ids, mark in marks for n in ids]
        self.size_a, self.size_b = size_a, size_b

    def _piece(self, n: int) -> bytes:
        piece = self.b.id_to_piece(n)
        if self.b.is_byte(n):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def ids_a(self, text: str) -> np.ndarray:
        if not _LONG_BLANK.search(text):
            return self.a.encode_to_numpy(text, disallowed_special=())
        # the fast form does not get through very long blanks
        if self.slow_a is None:
            from tokenizers import Tokenizer

            self.slow_a = Tokenizer.from_file(self.full_form)
            self.slow_a.encode_special_tokens = True
        return np.array(self.slow_a.encode(text, add_special_tokens=False).ids, np.int64)


class Aligned:
    """Aligned tokens of some texts: per text facts and the text to hash, and linked pairs with their numbers of links."""

    def __init__(self, encoders: Encoders, texts: list[str]):
        """Each text stands for a blank and itself; ``whole`` says whether both tokenizers give its bytes back."""
        ids_b = encoders.b.encode(texts, num_threads=1)
        raw = [b" " + t.encode() for t in texts]
        ids_a = [encoders.ids_a(" " + t) for t in texts]
        lengths = [int(encoders.a_length[a].sum()) for a in ids_a]
        self.whole = [
            n == len(r) and b"".join(map(encoders.b_bytes.__getitem__, b)) == r for n, b, r in zip(lengths, ids_b, raw)
        ]
        good = [k for k, whole in enumerate(self.whole) if whole]
        self.n_a, self.n_b = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        self.n_groups, self.n_links = self.n_a.copy(), self.n_a.copy()
        self.n_a[good], self.n_b[good] = [len(ids_a[k]) for k in good], [len(ids_b[k]) for k in good]
        a = np.concatenate([np.zeros(0, np.int64), *[ids_a[k] for k in good]]).astype(np.int64)
        b = np.fromiter(chain.from_iterable(ids_b[k] for k in good), np.int64, int(self.n_b.sum()))
        ends_a, ends_b = np.cumsum(encoders.a_length[a]), np.cumsum(encoders.b_length[b])
        cut_a = np.isin(ends_a, ends_b, assume_unique=True)
        cut_b = np.isin(ends_b, ends_a, assume_unique=True)
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        groups = int(cut_a.sum())
        size_a, size_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        first_a, first_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        text_a = np.repeat(np.arange(len(texts)), self.n_a)
        owner = text_a[first_a] if groups else np.zeros(0, np.int64)
        self.n_groups += np.bincount(owner, minlength=len(texts))
        np.add.at(self.n_links, owner, size_a * size_b)
        self.shown = self._shown(encoders, good, a, b, cut_a, cut_b, group_a, group_b, size_a, first_b)
        self.text, self.code, self.times = self._pairs(a, b, size_a, size_b, first_a, first_b, owner)

    def _shown(self, encoders, good, a, b, cut_a, cut_b, group_a, group_b, size_a, first_b) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every text."""
        line = np.empty(len(a) + len(b), np.int64)
        line[np.arange(len(a)) + first_b[group_a]] = a + np.where(cut_a, encoders.size_a, 0)
        through = np.cumsum(size_a)
        line[np.arange(len(b)) + through[group_b]] = b + 2 * encoders.size_a + np.where(cut_b, encoders.size_b, 0)
        shown = [b""] * len(self.whole)
        at = 0
        for k in good:
            end = at + int(self.n_a[k] + self.n_b[k])
            shown[k] = b"".join(map(encoders.shown.__getitem__, line[at:end].tolist()))[:-1]
            at = end
        return shown

    @staticmethod
    def _pairs(a, b, size_a, size_b, first_a, first_b, owner) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, pair and links, sorted by text and pair."""
        links = size_a * size_b
        small = np.flatnonzero(links <= SMALL_GROUP)
        width = links[small]
        nth = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
        group = np.repeat(small, width)
        own_a = a[first_a[group] + nth // size_b[group]]
        own_b = b[first_b[group] + nth % size_b[group]]
        keys = [np.unique(owner[group] << (16 + B_BITS) | own_a << B_BITS | own_b, return_counts=True)]
        for g in np.flatnonzero(links > SMALL_GROUP).tolist():  # distinct ids of each side with their numbers
            one, n_one = np.unique(a[first_a[g] : first_a[g] + size_a[g]], return_counts=True)
            two, n_two = np.unique(b[first_b[g] : first_b[g] + size_b[g]], return_counts=True)
            code = (one[:, None] << B_BITS | two[None, :]).ravel()
            keys.append((owner[g] << (16 + B_BITS) | code, np.outer(n_one, n_two).ravel()))
        key, times = _added(keys)
        return key >> (16 + B_BITS), key & ((1 << (16 + B_BITS)) - 1), times


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sum of their numbers."""
    if len(parts) == 1:
        return parts[0]
    keys, numbers = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2
    order = np.argsort(keys, kind="stable")
    keys, numbers = keys[order], numbers[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(numbers, first) if len(first) else numbers


def _slices(text: str) -> Iterator[str]:
    """Parts of a text such that a blank and each part, one after the other, are a blank and the text."""
    at = 0
    while len(text) - at > SLICE:
        cut = _CUT.search(text, at + SLICE)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def _pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays in zstd, each with its length."""
    head = np.array([len(arrays), *[len(x) for x in arrays]], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(x.tobytes() for x in arrays))


def _unpack(blob: bytes, *types) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, n, 8).tolist()
    at, found = 8 + 8 * n, []
    for size, kind in zip(sizes, types):
        found.append(np.frombuffer(data, kind, size, at))
        at += size * np.dtype(kind).itemsize
    return found


def _steps(codes: np.ndarray) -> np.ndarray:
    """Ascending codes below 2^31 as differences."""
    return np.diff(codes, prepend=0).astype(np.int32)


class Run:
    """Pair-document records of some documents until they are spilled."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.ids: list = []
        self.facts: list[tuple] = []
        self.digests: list[bytes] = []
        self.records: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def document(self, doc_id, facts: tuple[int, ...], digest: bytes) -> int:
        self.ids.append(doc_id)
        self.facts.append(facts)
        self.digests.append(digest)
        return len(self.ids) - 1

    def add(self, doc: np.ndarray, code: np.ndarray, times: np.ndarray) -> None:
        self.records.append((doc, code, times))
        self.size += len(code)

    @property
    def full(self) -> bool:
        return self.size >= RUN_RECORDS or len(self.ids) >= RUN_DOCS // 2

    def spill(self) -> pa.RecordBatch:
        doc, code, times = (np.concatenate(x) for x in zip(*self.records)) if self.records else (np.zeros(0, np.int64),) * 3
        part = (code >> B_BITS) % PARTS
        order = np.argsort((part << 16 + B_BITS | code) << DOC_BITS | doc)
        doc, code, times, part = doc[order], code[order], times[order], part[order]
        first = np.flatnonzero(np.diff(code, prepend=-1))
        held = np.diff(np.append(first, len(code)))
        bounds = np.searchsorted(part[first], np.arange(PARTS + 1))
        codes = code[first]
        steps = np.concatenate([_steps(codes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])])
        step = np.diff(doc, prepend=0)
        step[first] = doc[first]  # the documents of a pair ascend
        columns = [
            pa.array([self.number], pa.int64()),
            pa.array([self.ids], pa.list_(pa.int64())),
            pa.array([np.array(self.facts, np.int64).reshape(-1, 4).tobytes()], pa.binary()),
            pa.array([b"".join(self.digests)], pa.binary()),
            pa.array([_pack(bounds.astype(np.int32), steps, held.astype(np.int32))], pa.binary()),
            pa.array([_pack(held.astype(np.int32), step.astype(np.int32), times.astype(np.int32))], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["run", "ids", "facts", "digests", "pairs", "body"])


_NOTHING = (0, 0, 0, 0)


def spilled(docs: DataFrame, paths: tuple[str, str, str]) -> DataFrame:
    """The runs of all documents; staged."""

    def work(batches):
        encoders = Encoders(paths)
        run = Run(TaskContext.get().partitionId() << 24)
        ids: list = []
        texts: list[str] = []

        def aligned():
            found = Aligned(encoders, texts)
            facts = list(zip(found.n_a.tolist(), found.n_b.tolist(), found.n_groups.tolist(), found.n_links.tolist()))
            base = len(run.ids)
            for doc_id, whole, own, shown in zip(ids, found.whole, facts, found.shown):
                run.document(doc_id, own, hashlib.sha256(shown).digest() if whole else bytes(32))
            run.add(found.text + base, found.code, found.times)
            ids.clear()
            texts.clear()

        def long(doc_id, text):
            total, parts, digest = np.zeros(4, np.int64), [], hashlib.sha256()
            for n, part in enumerate(_slices(text)):
                found = Aligned(encoders, [part])
                if not found.whole[0]:
                    run.document(doc_id, _NOTHING, bytes(32))
                    return
                total += [x[0] for x in (found.n_a, found.n_b, found.n_groups, found.n_links)]
                digest.update(b";" * (n > 0) + found.shown[0])
                parts.append((found.code, found.times))
                if len(parts) == 32:
                    parts = [_added(parts)]
            code, times = _added(parts)
            at = run.document(doc_id, tuple(total.tolist()), digest.digest())
            run.add(np.full(len(code), at, np.int64), code, times)

        for batch in batches:
            size = 0
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    if not text:
                        run.document(doc_id, _NOTHING, bytes(32))
                    elif len(text) > SLICE:
                        long(doc_id, text)
                    else:
                        ids.append(doc_id)
                        texts.append(text)
                        size += len(text)
                    if size >= GROUP_CHARS:
                        aligned()
                        size = 0
                    if run.full:
                        if texts:
                            aligned()
                            size = 0
                        yield run.spill()
                        run = Run(run.number + 1)
            if texts:
                aligned()
        if run.ids:
            yield run.spill()

    return stage(docs.mapInArrow(work, RUNS), "runs")


def pair_lists(runs: DataFrame) -> DataFrame:
    """Pairs and numbers of documents of every run, a row per partition of A ids."""

    def work(batches):
        for batch in batches:
            for run, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bounds, steps, held = _unpack(blob, np.int32, np.int32, np.int32)
                some = np.flatnonzero(np.diff(bounds))
                blobs = [_pack(steps[bounds[p] : bounds[p + 1]], held[bounds[p] : bounds[p + 1]].astype(np.int64)) for p in some]
                columns = [pa.array(some.astype(np.int32)), pa.array([run] * len(some), pa.int64()), pa.array(blobs, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "run", "blob"])

    return runs.select("run", "pairs").mapInArrow(work, LISTS)


def _entries(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, held = _unpack(blob, np.int32, np.int64)
    return np.cumsum(steps, dtype=np.int64), held


def merge(blobs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of all lists in order with their sums, block by block.

    The heap holds the last pair of each list's current block. Up to the least of them, every list has
    shown all its pairs, so these are final.
    """
    lists = [_entries(b) for b in blobs]
    at = [0] * len(lists)
    heap = [(int(codes[min(BLOCK, len(codes)) - 1]), k) for k, (codes, _) in enumerate(lists) if len(codes)]
    heapq.heapify(heap)
    while heap:
        bound = heap[0][0]
        parts = []
        for last, k in heap:
            codes, held = lists[k]
            end = at[k] + int(np.searchsorted(codes[at[k] : at[k] + BLOCK], bound, "right"))
            if end > at[k]:
                parts.append((codes[at[k] : end], held[at[k] : end]))
                at[k] = end
        while heap and heap[0][0] <= bound:
            _, k = heapq.heappop(heap)
            codes = lists[k][0]
            if at[k] < len(codes):
                heapq.heappush(heap, (int(codes[min(at[k] + BLOCK, len(codes)) - 1]), k))
        yield _added(parts)


def _merged(lists: DataFrame) -> DataFrame:
    """Lists of each ``FAN`` runs as one."""

    def work(part: pa.Table) -> pa.Table:
        found = list(merge(part.column("blob").to_pylist()))
        codes, sums = (np.concatenate(x) for x in zip(*found))
        columns = [part.column("part")[:1], part.column("run")[:1], pa.array([_pack(_steps(codes), sums)], pa.binary())]
        return pa.table(columns, names=["part", "run", "blob"])

    return lists.groupBy("part", "run").applyInArrow(lambda part: work(part), LISTS)


def pair_totals(lists: DataFrame, runs: int) -> DataFrame:
    """One list per partition: pairs, numbers of documents in the whole table, and whether it is the A id's highest; staged."""
    numbered = lists.withColumn("run", F.pmod(F.xxhash64("run"), F.lit(max(1, -(-runs // FAN)))))
    while runs > FAN:
        runs = -(-runs // FAN)
        merged = stage(_merged(numbered), "merged")
        numbered = merged.withColumn("run", F.expr(f"run div {FAN}"))

    def work(part: pa.Table) -> pa.Table:
        codes, sums, best = [], [], []
        held: tuple = (np.zeros(0, np.int64), np.zeros(0, np.int64))

        def close(own_codes, own_sums):
            """Highest counts of A ids whose pairs have all passed."""
            side = own_codes >> B_BITS
            first = np.flatnonzero(np.diff(side, prepend=-1))
            top = np.maximum.reduceat(own_sums, first)
            best.append(own_sums == np.repeat(top, np.diff(np.append(first, len(side)))))
            codes.append(own_codes)
            sums.append(own_sums)

        for block in merge(part.column("blob").to_pylist()):
            own_codes, own_sums = (np.concatenate(x) for x in zip(held, block))
            passed = int(np.searchsorted(own_codes >> B_BITS, own_codes[-1] >> B_BITS))
            if passed:
                close(own_codes[:passed], own_sums[:passed])
            held = own_codes[passed:], own_sums[passed:]
        close(*held)
        blob = _pack(_steps(np.concatenate(codes)), np.concatenate(sums), np.concatenate(best).astype(np.int8))
        return pa.table([part.column("part")[:1], pa.array([blob], pa.binary())], names=["part", "totals"])

    return stage(numbered.groupBy("part").applyInArrow(lambda part: work(part), "part int, totals binary"), "totals")


def contributions(lists: DataFrame, totals: DataFrame, runs: int) -> DataFrame:
    """``run, part, blob``: the counts and marks of a run's pairs, in the order of its list."""

    def work(own: pa.Table, whole: pa.Table) -> pa.Table:
        if not own.num_rows:
            return out.empty_table()
        steps, sums, best = _unpack(whole.column("totals")[0].as_py(), np.int32, np.int64, np.int8)
        codes = np.cumsum(steps, dtype=np.int64)
        blobs = []
        for blob in own.column("blob").to_pylist():
            at = np.searchsorted(codes, _entries(blob)[0])
            blobs.append(_pack(sums[at], best[at]))
        return pa.table([own.column("run"), own.column("part"), pa.array(blobs, pa.binary())], schema=out)

    out = pa.schema([("run", pa.int64()), ("part", pa.int32()), ("blob", pa.binary())])
    salts = -(-max(1, runs) // FAN) * 2
    salt = F.pmod(F.xxhash64("run"), F.lit(salts)).cast("int")
    copies = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    own = lists.withColumn("salt", salt).groupBy("part", "salt")
    return own.cogroup(copies.groupBy("part", "salt")).applyInArrow(work, "run bigint, part int, blob binary")


RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _collected():
    """What the documents of a run get from the answers to its pairs."""

    def work(run: pa.Table, answers: pa.Table) -> pa.Table:
        if not run.num_rows:
            return out.empty_table()
        facts = np.frombuffer(run.column("facts")[0].as_py(), np.int64).reshape(-1, 4)
        digests = run.column("digests")[0].as_py()
        held, step, times = _unpack(run.column("body")[0].as_py(), np.int32, np.int32, np.int32)
        order = np.argsort(answers.column("part").to_numpy())
        blobs = answers.column("blob").to_pylist()
        found = [_unpack(blobs[k], np.int64, np.int8) for k in order.tolist()]
        n_best, count_sum = np.zeros(len(facts), np.int64), np.zeros(len(facts), np.int64)
        if found:
            count, best = (np.repeat(np.concatenate(x), held) for x in zip(*found))
            first = np.cumsum(held) - held
            walked = np.cumsum(step, dtype=np.int64)
            doc = walked - np.repeat(walked[first] - step[first], held)
            np.add.at(n_best, doc, times * (best > 0))
            np.add.at(count_sum, doc, times * count)
        shown = [digests[32 * k : 32 * k + 32].hex() if n else "" for k, n in enumerate(facts[:, 0].tolist())]
        columns = [run.column("ids").combine_chunks().flatten(), *[pa.array(facts[:, k].copy()) for k in range(4)]]
        columns += [pa.array(n_best), pa.array(count_sum), pa.array(shown, pa.string())]
        return pa.table(columns, schema=out)

    numbers = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    out = pa.schema([*[(n, pa.int64()) for n in numbers], ("groups_sha256", pa.string())])
    return work


def align_tokens(docs: DataFrame, paths: tuple[str, str, str], text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``.

    Null and empty texts, and those that a tokenizer does not give back byte by byte, have no tokens: zeros and an empty digest.
    Repeated rows are documents of their own, null ids stay null, other columns are not read. An empty
    table gives an empty one.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    runs = spilled(narrow, paths)
    n_runs = runs.select("run").count()
    lists = stage(pair_lists(runs), "lists")
    answers = contributions(lists, pair_totals(lists, n_runs), n_runs)
    own = runs.select("run", "ids", "facts", "digests", "body")
    return own.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(_collected(), RESULT)


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokens(table(spark, folder, "documents"), tokenizer_paths())
