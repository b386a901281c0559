"""Benchmark decontamination by latent semantic retrieval and order-aware checks.

1. Benchmark items are cut into equal passages of at most ``ITEM_WORDS`` words. Their words are the terms;
   document frequencies of the terms are counted over all documents.
2. A randomised SVD of the TF-IDF matrix of all item passages of a block gives the latent space: what is sought
   decides on its dimensions, documents are folded in. With at most ``RANK`` passages the space holds each of them whole
   and the cosines are exact. The rows stay on the executors; only products of terms times latent dimensions are added up.
3. Every document is read in overlapping windows a quarter apart, of several lengths; a passage is sought in those of the
   least length that holds it. A window whose cosine with it, estimated in the latent space, reaches ``gate()`` is a
   candidate: what the weakest match that step 4 accepts has, less a margin. Since latent vectors are
   projections, a window with too little weight in terms cannot reach it and is skipped: a bound, not a heuristic.
4. Candidates are confirmed by the longest common subsequence of words. Near the lower limit the
   answer has to be there too: the item's answer if the benchmark has such a column, else its last words.

Scale: documents are scanned twice (frequencies, search) and never shuffled. What each task gets is
bounded by ``BLOCK`` items and ``MAX_TERMS`` terms; a larger benchmark is searched block by block
against all rows. Blocks whose passages hold more distinct words are halved, so no word is left out; only an
item that by itself holds more is searched in several spaces at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tracewarden.llm.common import drop_worker_tables, raw_bytes, table
from tracewarden.llm.words import word_hashes

ITEM_WORDS = 72
LENGTHS = (8, 12, 16, 20, 24, 28, 32, 40, 48, 56, 64, 72)  # of windows, in words
SURE, LEAST, ANSWER = 0.75, 0.5, 0.5
MARGIN = 0.65  # of the gate: the words that a paraphrase keeps may be its lighter ones
RANK, EXTRA, POWERS = 256, 16, 2
MAX_TERMS = 1 << 15
BUCKETS = 1 << 17  # of words by hash, for document frequencies
BLOCK = 20_000
FOLD = 256  # passages whose cosines are taken at a time
HELD_SCORES = 1_000_000  # of words times passages that a task holds at a time
SUM_TERMS = 256  # of a product's rows that are added up together
GROUP_BYTES = 1 << 20

# A-Z to lower case, ASCII marks to blanks
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256)
)


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes([t.translate(_FOLD) for t in texts])


def common_subsequence(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence of ``words`` with the sequence whose places ``masks`` holds as bits."""
    full = (1 << size) - 1
    row = full
    for w in words:
        hit = row & masks.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def _masks(words: list[int]) -> dict[int, int]:
    found: dict[int, int] = {}
    for n, w in enumerate(words):
        found[w] = found.get(w, 0) | 1 << n
    return found


@dataclass
class Passages:
    """Item passages of one block: item ids, words, and the words of their answers."""

    items: list
    words: list[list[int]]
    answers: list[list[int]]

    def terms(self) -> np.ndarray:
        return np.unique(np.array([w for p in self.words for w in p], np.uint64))

    def part(self, a: int, b: int) -> Passages:
        return Passages(self.items[a:b], self.words[a:b], self.answers[a:b])

    def parts(self) -> list[list[Passages]]:
        """Passages halved until none has more than ``MAX_TERMS`` terms; those of one item stay in one list."""
        if len(self.words) < 2 or len(self.terms()) <= MAX_TERMS:
            return [[self]]
        middle = len(self.words) // 2
        # the end of an item that is nearest to the middle
        ends = [n for n in range(1, len(self.words)) if self.items[n] != self.items[n - 1]]
        at = min(ends, key=lambda n: abs(n - middle), default=middle)
        one, two = self.part(0, at).parts(), self.part(at, len(self.words)).parts()
        return one + two if ends else [[p for own in one + two for p in own]]


def item_passages(rows: list) -> Passages:
    """Passages of items given as ``(item_id, text, answer or None)``; items without a word have none."""
    found = Passages([], [], [])
    for item, text, answer in rows:
        words = words_of([(text or "").encode()])[0].tolist()
        told = words_of([(answer or "").encode()])[0].tolist()
        count = -(-len(words) // ITEM_WORDS)
        for k in range(count):
            part = words[len(words) * k // count : len(words) * (k + 1) // count]
            found.items.append(item)
            found.words.append(part)
            found.answers.append(told or part[-max(3, len(part) // 4) :])
    return found


def gate(words: int, length: int) -> float:
    """The cosine that a window of ``length`` words needs for a passage of ``words``.

    The weakest match keeps ``LEAST`` of the passage, of which an eighth may lie beyond the window, as windows are a quarter apart.
    """
    return MARGIN * LEAST * 0.875 * (min(words, length) / length) ** 0.5


def _places(terms: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Number of the term of every word, -1 for words that are none."""
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    return np.where(terms[at] == hashes, at, -1)


def _groups(texts: list[bytes]):
    start, size = 0, 0
    for n, text in enumerate(texts):
        size += len(text)
        if size >= GROUP_BYTES or n == len(texts) - 1:
            yield start, texts[start : n + 1]
            start, size = n + 1, 0


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % BUCKETS


def word_weights(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of the words of every bucket, from all documents."""

    def work(batches):
        drop_worker_tables()
        seen, rows = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, texts in _groups(raw_bytes(batch.column(0))):
                hashes, offsets = words_of(texts)
                owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
                pairs = np.unique(owner * BUCKETS + _buckets(hashes))
                seen += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
        at = np.flatnonzero(seen)
        columns = [pa.array(np.append(at, -1)), pa.array(np.append(seen[at], rows))]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "n"])

    counted = docs.mapInArrow(work, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    seen = np.zeros(BUCKETS + 1, np.int64)
    for bucket, n in counted.collect():  # at most BUCKETS + 1 rows
        seen[bucket] = n
    return np.log((seen[-1] + 1) / (np.minimum(seen[:-1], seen[-1]) + 1)) + 0.05


def _rows(places: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of a passage: its terms and their weights.

    A term counts by the root of its frequency, so squared lengths are sums over words.
    """
    ids, counts = np.unique(places[places >= 0], return_counts=True)
    return ids, np.sqrt(counts) * weights[ids]


def latent_space(spark: SparkSession, passages: Passages, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Terms times latent dimensions, orthonormal columns: randomised SVD with power iterations over all ``passages``.

    The matrix is cut over the executors by rows; they return partial products of bounded size.
    """
    own = [np.array(p, np.uint64).tobytes() for p in passages.words]
    # as an Arrow table: Spark would send a list through Python workers of another kind, kept beside the usual ones
    matrix = spark.createDataFrame(pa.table({"words": pa.array(own, pa.binary())})).repartition(4)
    # no more dimensions than rows: the product of that many random columns spans them all
    width = min(RANK + EXTRA, len(terms), len(own))
    basis = np.random.default_rng(3).standard_normal((len(terms), width))

    def product(basis: np.ndarray) -> np.ndarray:
        """A' (A basis)"""

        def work(batches):
            total = np.zeros(basis.shape)
            for batch in batches:
                for blob in raw_bytes(batch.column(0)):
                    ids, values = _rows(_places(terms, np.frombuffer(blob, np.uint64)), weights)
                    values = values / max(np.linalg.norm(values), 1e-12)
                    total[ids] += np.outer(values, values @ basis[ids])
            for at in range(0, len(total), SUM_TERMS):
                part = total[at : at + SUM_TERMS].tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([part], pa.binary())], ["at", "part"])

        def added(rows: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_buffer()) for x in rows.column("part"))
            return pa.table({"at": rows.column("at")[:1], "part": pa.array([total.tobytes()], pa.binary())})

        summed = matrix.mapInArrow(work, "at int, part binary").groupBy("at").applyInArrow(added, "at int, part binary")
        total = np.zeros(basis.shape)
        for at, part in summed.collect():  # one sum per term, at most MAX_TERMS of them
            total[at : at + SUM_TERMS] = np.frombuffer(part).reshape(-1, basis.shape[1])
        return total

    for _ in range(POWERS):
        basis, _ = np.linalg.qr(product(basis))
    image = product(basis)
    values, turn = np.linalg.eigh(basis.T @ image)
    order = np.argsort(values)[::-1][:RANK]
    return (basis @ turn[:, order]).astype(np.float32)


@dataclass
class Index:
    """What a task needs to search: terms, weights, latent space, and item passages by window length."""

    passages: Passages
    terms: np.ndarray
    weights: np.ndarray  # of terms
    word_weights: np.ndarray  # of all words, by bucket
    space: np.ndarray
    latent: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, float]]  # window length: passage numbers, vectors, gates, least share of weight

    def __post_init__(self):
        self.masks = [_masks(w) for w in self.passages.words]
        self.answer_masks = [_masks(w) for w in self.passages.answers]
        self.folded: dict = {}

    def _by_term(self, length: int, at: int) -> np.ndarray:
        """What a term adds to the cosines with ``FOLD`` passages: its latent vector times theirs. Last row: no term."""
        if (length, at) not in self.folded:
            if len(self.folded) > 8:
                self.folded.clear()
            vectors = self.latent[length][1][at : at + FOLD]
            scores = (self.space * self.weights[:, None].astype(np.float32)) @ vectors.T.astype(np.float32)
            self.folded[length, at] = np.concatenate([scores, np.zeros((1, scores.shape[1]), np.float32)])
        return self.folded[length, at]

    def search(self, hashes: np.ndarray, offsets: np.ndarray, best: list[dict] | None = None) -> list[dict]:
        """For each text the best match of each item that it holds: ``item: (cosine, lcs, item words, first word)``."""
        best = [{} for _ in offsets[1:]] if best is None else best
        if not len(hashes):
            return best
        place = _places(self.terms, hashes)
        square = self.word_weights[_buckets(hashes)] ** 2
        every = np.concatenate([[0.0], np.cumsum(square)])
        within = np.concatenate([[0.0], np.cumsum(np.where(place >= 0, square, 0.0))])
        for length, (numbers, _, gates, share) in self.latent.items():
            # a window is four steps; each step is summed once
            step = length // 4
            count = np.maximum(-(-np.diff(offsets) // step), 1)
            text = np.repeat(np.arange(len(count)), count)
            nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
            starts = offsets[text] + nth * step
            ends = np.minimum(starts + length, offsets[text + 1])
            whole = every[ends] - every[starts]
            # a projection is no longer than the part in terms
            likely = (nth <= np.maximum(count[text] - 4, 0)) & (ends > starts)
            likely &= within[ends] - within[starts] >= share * whole
            norm = np.sqrt(np.maximum(whole, 1e-18))
            at_once = max(4, HELD_SCORES // (step * min(FOLD, len(numbers))))
            for k in range(0, len(text), at_once):
                windows = k + np.flatnonzero(likely[k : k + at_once])
                if not len(windows):
                    continue
                last = min(k + at_once + 3, len(text))
                low, high = starts[k], min(starts[last - 1] + step, offsets[text[last - 1] + 1])
                known = low + np.flatnonzero(place[low:high] >= 0)
                first = np.searchsorted(known, starts[k:last])
                empty = first == np.append(first[1:], len(known))
                for at in range(0, len(numbers), FOLD):
                    by_term = self._by_term(length, at)
                    scores = np.concatenate([by_term[place[known]], by_term[-1:]])  # the last row: nothing
                    steps = np.add.reduceat(scores, np.minimum(first, len(known)), axis=0)
                    steps[empty] = 0
                    sums = np.zeros((len(windows), steps.shape[1]), np.float32)
                    for j in range(4):
                        own = np.minimum(windows - k + j, len(steps) - 1)
                        inside = (windows - k + j < len(steps)) & (text[np.minimum(windows + j, len(text) - 1)] == text[windows])
                        sums += steps[own] * inside[:, None]
                    rows, columns = np.nonzero(sums >= gates[at : at + FOLD] * norm[windows][:, None])
                    for r, c in zip(rows.tolist(), columns.tolist()):
                        w = windows[r]
                        n = text[w]
                        near = max(offsets[n], starts[w] - step), min(offsets[n + 1], ends[w] + step)
                        cosine = float(sums[r, c] / norm[w])
                        self._confirm(hashes[near[0] : near[1]], int(numbers[at + c]), cosine, int(near[0] - offsets[n]), best[n])
        return best

    def _confirm(self, hashes: np.ndarray, number: int, cosine: float, a: int, best: dict) -> None:
        words, item = self.passages.words[number], self.passages.items[number]
        masks = self.masks[number]
        near = [w for w in hashes.tolist() if w in masks]  # others are in no common subsequence
        if len(near) < LEAST * len(words):
            return
        lcs = common_subsequence(self.masks[number], len(words), near)
        if lcs < LEAST * len(words):
            return
        if lcs < SURE * len(words):
            answer = self.passages.answers[number]
            if common_subsequence(self.answer_masks[number], len(answer), hashes.tolist()) < ANSWER * len(answer):
                return
        found = (cosine, lcs, len(words), a)
        if item not in best or (lcs / len(words), cosine) > (best[item][1] / best[item][2], best[item][0]):
            best[item] = found


def build_index(spark: SparkSession, passages: Passages, every: np.ndarray) -> Index:
    terms = passages.terms()
    weights = every[_buckets(terms)]
    space = latent_space(spark, passages, terms, weights)
    latent: dict[int, tuple] = {}
    for n, words in enumerate(passages.words):
        length = next(x for x in LENGTHS if len(words) <= x)
        ids, values = _rows(_places(terms, np.array(words, np.uint64)), weights)
        vector = values.astype(np.float32) @ space[ids]
        size, whole = float(np.linalg.norm(vector)), max(float(np.linalg.norm(values)), 1e-12)
        # the cosine of whole vectors, estimated in the latent space: its part of the passage stands for all of it
        stretch = 1 / max(size / whole, 0.2)
        own = latent.setdefault(length, ([], [], [], []))
        least = gate(len(words), length)
        for column, value in zip(own, (n, vector / whole * stretch**2, least, (least / stretch) ** 2)):
            column.append(value)
    arrays = {k: (np.array(a), np.array(b), np.array(c, np.float32), min(d)) for k, (a, b, c, d) in latent.items()}
    return Index(passages, terms, weights, every, space, arrays)


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, made without a Python worker."""
    fields = StructType.fromDDL(schema).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, item_id, cosine, lcs, item_words, first_word`` for every document and item it holds.

    Null and empty texts hold nothing, items without words are held by nothing. Repeated rows are
    searched each; null ids stay null. ``benchmark`` has ``item_id``, ``text`` and perhaps ``answer``;
    other columns of either table are not read. Empty tables give an empty one.
    """
    spark = docs.sparkSession
    narrow = docs.select("doc_id", F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_type}, cosine double, lcs int, item_words int, first_word int"
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    found = _empty(spark, schema)
    items = benchmark.select("item_id", "text", answer.alias("answer"))
    blocks = -(-items.count() // BLOCK)
    weights = word_weights(narrow.select("text")) if blocks else None
    for block in range(blocks):
        own = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        passages = item_passages(items.filter(own).orderBy("item_id", "text").collect())  # about BLOCK rows
        for part in passages.parts() if passages.items else ():
            indices = [build_index(spark, p, weights) for p in part]
            found = found.unionByName(_searched(narrow, indices, schema, to_arrow_type(benchmark.schema["item_id"].dataType)))
    return found


def _searched(docs: DataFrame, indices: list[Index], schema: str, item_type: pa.DataType) -> DataFrame:
    def work(batches):
        for batch in batches:
            at, rows = [], []
            for start, texts in _groups(raw_bytes(batch.column(1))):
                hashes, offsets = words_of(texts)
                best = None
                for index in indices:
                    best = index.search(hashes, offsets, best)
                for n, held in enumerate(best):
                    at += [start + n] * len(held)
                    rows += [(item, *found) for item, found in held.items()]
            columns = list(zip(*rows)) or [()] * 5
            kinds = (item_type, pa.float64(), pa.int32(), pa.int32(), pa.int32())
            arrays = [batch.column(0).take(pa.array(at, pa.int64()))]
            arrays += [pa.array(c, t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["doc_id", "item_id", "cosine", "lcs", "item_words", "first_word"]
    return docs.mapInArrow(work, schema)


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
