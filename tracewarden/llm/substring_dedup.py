"""Removal of long repeated word runs across documents, found by recompression.

Recompression names longer and longer pieces of a word sequence. A round first names runs of
equal symbols, then merges a symbol of class L with a following one of class R; the class is a
bit of the symbol's name and the round. Names are hashes of what they stand for, so all tasks agree on them
without exchanging a dictionary, and a round's decision about a symbol depends only on the words
around it. Equal substrings therefore get the same symbols everywhere but at their ends. Each
symbol carries its span of influence: the words that determine that it exists.

1. Rounds go on until a text is one symbol. Symbols of ``LONG`` words and more are grouped by name, all levels
   at once: one that a document with a smaller id has, too, is *settled*, and with it every window inside.
2. What is left are windows at the ends of repeats and between symbols. A window of 13 words that occurs twice
   has, both times, the same symbols of round 2 among those whose span of influence lies inside. It chooses the one
   with the smallest name (a window without any is its own symbol); the chosen symbols are keyed by the words of
   their span, and only documents with a key that two have go on, with the windows that chose it.
3. These windows, but for those inside one settled symbol, are compared as a whole, by 96 bits of hash: which also
   starts in a document with a smaller id? Their words and those of settled symbols are removed.

Leaving out windows inside a settled symbol loses nothing: in the smallest document that has a window, no settled
symbol can hold it, or a smaller document would have it.

Scale: a fifth of the words have a key, a fifteenth a long symbol, and each moves once, with an id. A task reports a key,
symbol or window once and settles its further occurrences by itself, so a passage of a third of all
documents makes one row per task and no hot group. Texts move only when they hold a shared key,
and again when they lose words. Documents whose words equal those of a smaller id
are settled by a fingerprint beforehand.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewarden.llm.common import raw_bytes, stage, table
from tracewarden.llm.words import _powers, mix, windows, word_hashes

WIDTH = 13
ROUNDS = 2  # after which windows choose their keys
LONG = 2 * WIDTH  # words of a symbol that is looked up itself
MOST_ROUNDS = 128  # a round leaves three quarters of the symbols; what is left then is settled by windows
GROUP_BYTES = 2 << 20  # texts are parsed in groups of this size
HELD = 1_000_000  # keys that a task combines at a time
MAX_BROADCAST_IDS = 1_000_000
_RUN, _LEFT, _RIGHT = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def _runs_and_pairs(turn, names, starts, ends, low, high, text, made, first, last):
    """Round number ``turn``; ``made`` tells the symbols that it names anew. ``low`` and ``high`` bound the words that determine a symbol, ``text`` is its text's number.

    ``first`` and ``last`` are the word bounds of texts: a symbol at the edge depends on what is beyond.
    """
    n = len(names)
    change = np.ones(n, bool)
    change[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(change)
    after = np.append(at[1:], n)
    own, count = text[at], (after - at).astype(np.uint64)
    same_left = np.zeros(len(at), bool)
    same_left[1:] = own[1:] == own[:-1]
    same_right = np.append(same_left[1:], False)
    run_low = np.where(same_left, low[np.maximum(at - 1, 0)], first[own] - 1)
    run_high = np.where(same_right, high[np.minimum(after, n - 1)], last[own] + 1)
    letter = names[at]
    run_names = np.where(count > 1, mix(letter + count * _RUN), letter)
    salt = np.uint64((turn + 1) * int(_RIGHT) & 0xFFFFFFFFFFFFFFFF)
    left_class = (mix(letter ^ salt) & np.uint64(1)).astype(bool)
    merges = np.zeros(len(at), bool)  # with the next
    merges[:-1] = left_class[:-1] & ~left_class[1:] & same_right[:-1]
    taken = np.zeros(len(at), bool)
    taken[1:] = merges[:-1]
    keep = np.flatnonzero(~taken)
    to = np.where(merges[keep], keep + 1, keep)
    pair = mix(run_names[keep] * _LEFT + run_names[to] * _RIGHT)
    named = np.where(merges[keep], pair, run_names[keep])
    made = merges[keep] | (count[keep] > 1)
    return named, starts[at][keep], ends[after - 1][to], run_low[keep], run_high[to], own[keep], made


def rounds(hashes: np.ndarray, offsets: np.ndarray):
    """The symbols of all texts after each round, until every text is one symbol."""
    n = len(hashes)
    lengths = np.diff(offsets)
    at = np.arange(n)
    symbols = hashes, at, at + 1, at, at + 1, np.repeat(np.arange(len(lengths)), lengths), np.zeros(n, bool)
    filled = int((lengths > 0).sum())
    for turn in range(MOST_ROUNDS if n else 0):
        symbols = _runs_and_pairs(turn, *symbols, offsets[:-1], offsets[1:])
        yield symbols
        if len(symbols[0]) == filled and turn + 1 >= ROUNDS:
            return


def _spans(hashes: np.ndarray, low: np.ndarray, high: np.ndarray, which: int) -> np.ndarray:
    """A polynomial over the words of each span, mixed."""
    up, down = _powers(which, max(len(hashes), 1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64)])
    return mix((sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64) * _RUN)


class Symbols:
    """Symbols of ``LONG`` words and more of some texts, in the order of the texts, and those that keys are made of."""

    def __init__(self, hashes: np.ndarray, offsets: np.ndarray):
        long, self.short = [], None
        for turn, symbols in enumerate(rounds(hashes, offsets)):
            if turn + 1 == ROUNDS:
                self.short = symbols
            names, starts, ends, _, _, own, made = symbols
            keep = np.flatnonzero(made & (ends - starts >= LONG))
            long.append((names[keep], starts[keep], ends[keep], own[keep]))
        types = (np.uint64, np.int64, np.int64, np.int64)
        columns = [np.concatenate(c) for c in zip(*long)] if long else [np.zeros(0, t) for t in types]
        order = np.argsort(columns[3], kind="stable")
        self.names, self.starts, self.ends, self.own = (c[order] for c in columns)
        self.bounds = np.searchsorted(self.own, np.arange(len(offsets)))

    def inside(self, number: int, settled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the symbols of one text whose names are ``settled``."""
        part = slice(self.bounds[number], self.bounds[number + 1])
        found = np.isin(self.names[part], settled)
        return self.starts[part][found], self.ends[part][found]


def _between(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in one of the spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change)[:-1] > 0


def chosen_keys(hashes: np.ndarray, offsets: np.ndarray, symbols: Symbols | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For every window start the key of the symbol it chose, and whether a window starts there at all."""
    n = len(hashes)
    lengths = np.diff(offsets)
    text = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.arange(n)
    is_window = starts + WIDTH <= offsets[1:][text] if n else np.zeros(0, bool)
    if not n:
        return hashes, is_window
    names, _, _, low, high, own, _ = (symbols or Symbols(hashes, offsets)).short
    inside = (low >= offsets[:-1][own]) & (high <= offsets[1:][own]) & (high - low <= WIDTH)
    names, low, high = mix(names[inside] ^ _LEFT), low[inside], high[inside]
    best = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    choice = np.full(n, -1, np.int64)
    for back in range(WIDTH):
        at = low - back
        fits = np.flatnonzero((at >= 0) & (at + WIDTH >= high))
        if not len(fits):
            break
        at = at[fits]  # spans begin at different words, so no window is named twice here
        better = names[fits] < best[at]
        best[at[better]] = names[fits][better]
        choice[at[better]] = fits[better]
    # the key of a span: a polynomial over its words
    keys = _spans(hashes, low, high, 1)
    whole = np.zeros(n, np.uint64)
    whole[: max(0, n - WIDTH + 1)] = windows(hashes, WIDTH)
    return np.where(choice >= 0, keys[choice] if len(keys) else whole, whole), is_window


def _groups(ids: list, texts: list[bytes]):
    """Documents in groups of bounded size."""
    some_ids, some, size = [], [], 0
    for doc_id, text in zip(ids, texts):
        some_ids.append(doc_id)
        some.append(text)
        size += len(text)
        if size >= GROUP_BYTES:
            yield some_ids, some
            some_ids, some, size = [], [], 0
    if some:
        yield some_ids, some


class Combiner:
    """Rows ``(key columns, doc_id)`` of one task, each key's smallest document first.

    The role is 0 for a key's only document here, 1 for its smallest of several, 2 for every other: those
    of role 2 know already that a smaller document has the key.
    """

    def __init__(self, types: list):
        self.types, self.parts, self.rows = types, [], 0

    def add(self, *columns: np.ndarray):
        if len(columns[0]):
            self.parts.append(columns)
            self.rows += len(columns[0])
        if self.rows >= HELD:
            yield from self.flush()

    def flush(self):
        if not self.rows:
            return
        columns = [np.concatenate(c) for c in zip(*self.parts)]
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        new_key = np.ones(len(order), bool)
        new_key[1:] = np.any([c[1:] != c[:-1] for c in columns[:-1]], axis=0)
        new_row = new_key.copy()
        new_row[1:] |= columns[-1][1:] != columns[-1][:-1]
        columns, new_key = [c[new_row] for c in columns], new_key[new_row]
        followed = np.append(~new_key[1:], False)
        role = np.where(new_key, np.where(followed, 1, 0), 2).astype(np.int8)
        self.parts, self.rows = [], 0
        for at in range(0, len(role), 200_000):
            arrays = [pa.array(c[at : at + 200_000]).cast(t) for c, t in zip(columns, self.types)]
            arrays.append(pa.array(role[at : at + 200_000]))
            yield pa.RecordBatch.from_arrays(arrays, [f"k{k}" for k in range(len(columns) - 1)] + ["doc_id", "role"])


def document_facts(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id, n_words, words_sha256`` and ``copy``: whether a smaller id has the same words. Staged."""

    def work(batches):
        for batch in batches:
            words = [t.split() for t in raw_bytes(batch.column(1))]
            hashes = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words]
            columns = [batch.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array(hashes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "words_sha256"])

    facts = stage(docs.mapInArrow(work, "doc_id bigint, n_words bigint, words_sha256 string"), "facts")
    long = facts.filter(F.col("n_words") >= WIDTH)
    least = long.groupBy("words_sha256").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    least = least.filter("n > 1").select("words_sha256", "least", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(16)).cast("int").alias("salt")
    found = facts.select("*", salt).join(least, ["words_sha256", "salt"], "left")
    copy = F.coalesce((F.col("least") < F.col("doc_id")) & (F.col("n_words") >= WIDTH), F.lit(False))
    return stage(found.select("doc_id", "n_words", "words_sha256", copy.alias("copy")), "facts")


def shared_names(docs: DataFrame) -> DataFrame:
    """``doc_id, name, settled`` of all keys that two documents have and, ``settled``, of long symbols that a smaller id has; staged.

    Keys have 0 as second half of their name, symbols an odd number out of a second hash of their words.
    """

    def work(batches):
        held = Combiner([pa.int64(), pa.int32(), pa.int64()])
        for batch in batches:
            for ids, texts in _groups(batch.column(0).to_pylist(), raw_bytes(batch.column(1))):
                hashes, offsets = word_hashes(texts)
                second, _ = word_hashes(texts, which=1)
                symbols = Symbols(hashes, offsets)
                keys, is_window = chosen_keys(hashes, offsets, symbols)
                ids = np.array(ids, np.int64)
                owner = np.repeat(ids, np.diff(offsets))
                new = is_window.copy()
                new[1:] &= (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1]) | ~is_window[:-1]
                yield from held.add(keys[new].view(np.int64), np.zeros(int(new.sum()), np.int32), owner[new])
                half = (_spans(second, symbols.starts, symbols.ends, 0) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
                yield from held.add(symbols.names.view(np.int64), half.view(np.int32), ids[symbols.own])
        yield from held.flush()

    rows = docs.mapInArrow(work, "k0 bigint, k1 int, doc_id bigint, role tinyint")
    shared = "CASE WHEN k1 = 0 THEN role > 0 OR least < most ELSE role = 2 OR least < doc_id END"
    found = _with_least(rows, ["k0", "k1"]).filter(shared)
    return stage(found.select("doc_id", F.col("k0").alias("name"), (F.col("k1") != 0).alias("settled")), "shared_names")


def _lists(rows: DataFrame, name: str) -> DataFrame:
    """``doc_id, items, symbols``: names that are not settled, and that are, per document; staged."""
    items = F.collect_list(F.when(~F.col("settled"), F.col("name"))).alias("items")
    symbols = F.collect_list(F.when(F.col("settled"), F.col("name"))).alias("symbols")
    return stage(rows.groupBy("doc_id").agg(items, symbols), name)


def _with_least(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the smallest and largest document of each key among roles 0 and 1; a key has at most one such row per task.

    Rows of role 2 have got their answer and are only carried along, spread by document.
    """
    settled = F.col("role") == 2
    spread = F.when(settled, F.xxhash64("doc_id", *keys)).otherwise(F.lit(0))
    same = Window.partitionBy(*keys, "spread")
    rows = rows.withColumn("spread", spread)
    return rows.withColumn("least", F.min("doc_id").over(same)).withColumn("most", F.max("doc_id").over(same))


def _texts_of(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """Documents joined with their row of ``lists``; texts of other documents stay where they are if the ids are few."""
    ids = lists.select("doc_id")
    few = ids.count() <= MAX_BROADCAST_IDS
    chosen = docs.join(F.broadcast(ids), "doc_id", "left_semi") if few else docs
    return chosen.join(lists, "doc_id").select("doc_id", "text", "items", "symbols")


def _names(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(v.values).view(np.uint64) for v in column]


def repeated_windows(docs: DataFrame, names: DataFrame) -> DataFrame:
    """``doc_id, items, symbols``: hashes of the windows of a document that start in one with a smaller id, too, and
    its settled symbols. Windows inside one settled symbol are not listed. Staged."""

    def work(batches):
        held = Combiner([pa.int64(), pa.int32(), pa.int64()])
        for batch in batches:
            wanted, settled = _names(batch.column(2)), _names(batch.column(3))
            ids = batch.column(0).to_pylist()
            for some, texts in _groups(list(range(batch.num_rows)), raw_bytes(batch.column(1))):
                hashes, offsets = word_hashes(texts)
                second, _ = word_hashes(texts, which=1)
                symbols = Symbols(hashes, offsets)
                found, _ = chosen_keys(hashes, offsets, symbols)
                one, two = windows(hashes, WIDTH), windows(second, WIDTH)
                for place, (number, a, b) in enumerate(zip(some, offsets[:-1], offsets[1:] - WIDTH + 1)):
                    if b <= a:
                        continue
                    starts, ends = symbols.inside(place, settled[number])
                    inside = _between(b - a, starts - a, ends - WIDTH + 1 - a)
                    at = a + np.flatnonzero(np.isin(found[a:b], wanted[number]) & ~inside)
                    high = (two[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    yield from held.add(one[at].view(np.int64), high, np.full(len(at), ids[number], np.int64))
        yield from held.flush()

    rows = _texts_of(docs, _lists(names, "name_lists")).mapInArrow(work, "k0 bigint, k1 int, doc_id bigint, role tinyint")
    covered = _with_least(rows, ["k0", "k1"]).filter("role = 2 OR least < doc_id")
    covered = covered.select("doc_id", F.col("k0").alias("name"), F.lit(False).alias("settled"))
    return _lists(covered.unionByName(names.filter("settled")), "repeated")


def cut_words(texts: list[bytes], repeated: list[np.ndarray], settled: list[np.ndarray]):
    """Per text the number of words removed, the hash of all words and what is left, joined by blanks.

    ``repeated`` are hashes of windows and ``settled`` names of symbols of each text.
    """
    hashes, offsets = word_hashes(texts)
    every, symbols = windows(hashes, WIDTH), Symbols(hashes, offsets)
    for number, (text, a, b) in enumerate(zip(texts, offsets[:-1], offsets[1:])):
        words = text.split()
        at = np.flatnonzero(np.isin(every[a : max(a, b - WIDTH + 1)], repeated[number]))
        covered = _between(b - a, at, at + WIDTH)
        starts, ends = symbols.inside(number, settled[number])
        covered |= _between(b - a, starts - a, ends - a)
        left = b" ".join([w for w, out in zip(words, covered.tolist()) if not out])
        yield int(covered.sum()), hashlib.sha256(b" ".join(words)).hexdigest(), left


def remove_repeats(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Facts of every row, and what is left of the rows that lose words.

    The first table has ``doc_id, n_words, words_sha256, copy`` for every row of ``docs``; rows marked
    ``copy`` lose everything. The second has ``doc_id, words_sha256, n_removed, left`` for rows that
    lose a part, where ``left`` is the rest. Null, empty and blank texts have no words. A row without
    an id neither loses words nor makes others lose them. Rows with one id count as one document, so
    they take nothing from each other. Other columns are not read. Empty tables give empty ones.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    facts = document_facts(narrow)
    known = narrow.filter(F.col("doc_id").isNotNull())
    names = shared_names(known)
    settled = facts.groupBy("doc_id").agg(F.min("copy").alias("copy")).filter("copy").select("doc_id")
    repeated = repeated_windows(known, names.join(settled, "doc_id", "left_anti"))

    def work(batches):
        for batch in batches:
            items, symbols, found = _names(batch.column(2)), _names(batch.column(3)), []
            for some, texts in _groups(list(range(batch.num_rows)), raw_bytes(batch.column(1))):
                found += cut_words(texts, [items[n] for n in some], [symbols[n] for n in some])
            columns = [
                batch.column(0),
                pa.array([f[1] for f in found], pa.string()),
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([f[2] for f in found], pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "words_sha256", "n_removed", "left"])

    schema = "doc_id bigint, words_sha256 string, n_removed bigint, left string"
    return facts, _texts_of(known, repeated).mapInArrow(work, schema)


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    facts, changed = remove_repeats(table(spark, folder, "documents"))
    left = changed.select("doc_id", "words_sha256", "n_removed", F.sha2(F.encode("left", "UTF-8"), 256).alias("left_sha256"))
    found = facts.join(left.distinct(), ["doc_id", "words_sha256"], "left")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return found.select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(F.col("copy"), nothing).otherwise(F.coalesce("left_sha256", "words_sha256")).alias("kept_sha256"),
    )
