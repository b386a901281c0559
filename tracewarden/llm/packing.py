"""Harmonic packing of token ids into sequences of a fixed capacity.

A piece whose length lies in (C/(k+1), C/k] belongs to class k, and a bin of class k takes
exactly k pieces of that class. A worker therefore fills its bins alone: it holds at most one
open bin per class and needs to know nothing about other workers. Documents may be cut, so
they are cut where the method loses least: into pieces of exactly C/k ids while more than C/8
are left; the rest, of a class with little loss, stays whole.

A worker ends with some bins not full. In a second round the leftover pieces of every
``WORKERS`` workers are laid end to end and cut at the capacity, which leaves one open
sequence for so many workers.

Ids are looked up by word, once for each distinct word of a group of texts. Learning a word costs as much as tokenizing
it, so each worker process keeps its table from task to task: the words seen lately, without their trailing marks, in two
generations of bounded size, of which the older one goes. Tasks of other operators drop the table
(``common.drop_worker_tables``).

Scale: documents are not shuffled; only leftovers are, at most one open bin per class and
worker, and a group of the second round is a fixed number of workers. The packed pieces are
staged once, so tokenization is not repeated for the second round or after a lost executor.
A long text is tokenized in slices that end at a blank.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from codecs import charmap_decode
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewarden.llm.common import raw_bytes, stage, table, worker_tables

CAPACITY = 4096
SMALL = 8  # what is left of a document is cut while it exceeds capacity / SMALL
WORKERS = 16
GENERATION = 250_000  # words; a process holds two generations
SLICE = 1 << 20
END_ID = 2

PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary, sequence_id bigint, offset bigint, worker int, kind int"


class WordTokenizer:
    """Ids of a text as little-endian unsigned 32-bit values.

    The tokenizer drops white space and never joins across it, so ids are looked up by word, for a group of texts at
    once: Arrow splits them and numbers their distinct words, and only those are looked up or learned.
    A word's key is the word without its trailing marks, with A-Z in lower case as the tokenizer does
    itself; words that could hold a special token are looked up as they are.
    """

    MARKS = ".,;:!?|%$#&*"
    SEPARATOR = " \x01 "  # a control character is a token of its own
    # letters of Latin-1 in UTF-8: each is one character in the normal form, and so is its lower case
    LATIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
    LETTER_OR_DIGIT_LAST = "[0-9a-z\u00df-\u00f6\u00f8-\u00ff]$"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        # the same model for words that need no normalizing and are one run of letters: only bytes become characters
        self.latin = Tokenizer(self.tokenizer.model)
        self.latin.pre_tokenizer = WhitespaceSplit()
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        shown = byte_level.pre_tokenize_str("".join(map(chr, range(0xC0, 0x100))))[0][0]  # of bytes C3 80 to C3 BF
        self.characters = "".join(map(chr, range(0x80))) + shown[1::2] + 64 * shown[0]
        self.ids: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.split_at = self._encode(["\x01"])[0]
        self.is_end = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.is_end[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        found = array("I", ids)
        if sys.byteorder != "little":
            found.byteswap()
        return found.tobytes()

    def _learn_letters(self, words: list[bytes], ids: list[int]) -> bool:
        """Takes the ids of words joined by blanks apart, each having one token that ends a word; false if that fails."""
        ids = np.array(ids, np.uint32)
        ends = 4 * (np.flatnonzero(self.is_end[ids]) + 1)
        if len(ends) != len(words) or ends[-1] != 4 * len(ids):
            return False
        data, ends = ids.astype("<u4").tobytes(), ends.tolist()
        self.ids.update(zip(words, [data[a:b] for a, b in zip([0, *ends], ends)]))
        return True

    def _learn(self, words: list[bytes]) -> None:
        """Ids of unseen words; words are joined so that one call tokenizes many.

        A run of letters has one token that ends a word, so blanks between such words will do.
        """
        latin, letters, plain, odd = [], [], [], []
        for word in words:
            if word.isalpha() or self.LATIN.fullmatch(word):
                latin.append(word)
            elif word.decode().isalpha() and word.decode().lower().isalpha():
                letters.append(word)
            else:
                (odd if b"\x01" in word or b"<|" in word else plain).append(word)
        for at in range(0, len(latin), 2_000):
            some = latin[at : at + 2_000]
            shown = charmap_decode(b" ".join(some).decode().lower().encode(), "strict", self.characters)[0]
            if not self._learn_letters(some, self.latin.encode_batch_fast([shown], add_special_tokens=False)[0].ids):
                letters += some
        for at in range(0, len(letters), 500):
            some = letters[at : at + 500]
            if not self._learn_letters(some, self._encode([b" ".join(some).decode()])[0]):
                plain += some
        for at in range(0, len(plain), 500):
            some = plain[at : at + 500]
            (ids,) = self._encode([self.SEPARATOR.join(w.decode() for w in some)])
            found, own = [], []
            for i in ids:
                if i == self.split_at[0]:
                    found.append(own)
                    own = []
                else:
                    own.append(i)
            found.append(own)
            if len(self.split_at) == 1 and len(found) == len(some):
                self.ids.update(zip(some, map(self._packed, found)))
            else:
                odd += some
        for word, ids in zip(odd, self._encode([w.decode() for w in odd])):
            self.ids[word] = self._packed(ids)

    def _core(self, word: bytes) -> bytes:
        """A word without its trailing marks, if these are tokens of their own."""
        core = word.rstrip(self.MARKS.encode()) if b"<|" not in word and b"'" not in word else word
        # only a letter or digit surely ends a token; some letters gain a mark in lower case
        if not core or not core[-1:].isalnum():
            last = core[-4:].decode(errors="ignore")[-1:].lower()
            if not (len(last) == 1 and last.isalpha()):
                core = word
        return core

    def _distinct(self, words: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of distinct words."""
        if len(self.ids) > GENERATION:
            self.ids, self.older = {}, self.ids
        cores = pc.ascii_rtrim(words, characters=self.MARKS)
        marked = pc.less(pc.binary_length(cores), pc.binary_length(words))
        sure = pc.and_not(pc.match_substring_regex(cores, self.LETTER_OR_DIGIT_LAST), pc.match_substring_regex(words, "<\\||'"))
        keys = cores.cast(pa.binary()).to_numpy(zero_copy_only=False)
        marked, sure = (x.to_numpy(zero_copy_only=False) for x in (marked, sure))
        at = np.flatnonzero(marked).tolist()
        whole = words.filter(pa.array(marked)).cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        for n, word in zip(at, whole):
            if not sure[n]:
                keys[n] = self._core(word)
        keys = keys.tolist()
        tails = [word[len(keys[n]) :] for n, word in zip(at, whole)]
        found = list(map(self.ids.get, keys))
        unseen = {key for key, ids in zip(keys, found) if ids is None}
        unseen.update(set(tails).difference(self.ids))
        if unseen:
            known = {word: self.older[word] for word in unseen if word in self.older}
            self.ids.update(known)
            self._learn(list(unseen.difference(known)))
            found = [self.ids[key] if ids is None else ids for key, ids in zip(keys, found)]
        for n, tail in zip(at, tails):
            found[n] += self.ids[tail]
        return pa.array(found, pa.large_binary())

    def encode(self, text: bytes) -> bytes:
        out = []
        at = 0
        while at < len(text):
            end = at + SLICE
            if end < len(text):  # move on to the next blank
                blanks = [p for p in (text.find(b, end) for b in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if p >= 0]
                end = min(blanks, default=len(text))
            out += self.encode_all([text[at:end]])
            at = end
        return b"".join(out)

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """``encode`` of texts that are not long; their new words are learned together."""
        if not texts:
            return []
        lists = pc.ascii_split_whitespace(pa.array([t if b"<|" in t else t.lower() for t in texts], pa.string()))
        words = lists.flatten().dictionary_encode()
        ids = self._distinct(words.dictionary).take(words.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[: len(ids) + 1][lists.offsets.to_numpy()].tolist()
        data = ids.buffers()[2].to_pybytes() if ends[-1] else b""
        return [data[a:b] for a, b in zip(ends, ends[1:])]


def kept_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this process."""
    tables = worker_tables()
    if path not in tables:
        tables[path] = WordTokenizer(path)
    return tables[path]


def cuts(length: int, capacity: int) -> Iterator[int]:
    """Lengths of the pieces of a document, in order."""
    while length:
        if length * SMALL <= capacity:
            piece = length
        else:
            piece = capacity // -(-capacity // length)  # the largest capacity / k that is left
        yield piece
        length -= piece


def fill_bins(batches, path: str, capacity: int, worker: int):
    """Pieces of one worker: rows of full bins have a sequence, those of open bins have none."""
    tokenizer = kept_tokenizer(path)
    end = END_ID.to_bytes(4, "little")
    open_bins: dict[int, list[tuple]] = defaultdict(list)
    made = 0
    rows: list[tuple] = []

    def flush():
        # rows: doc_id, start, length, doc_tokens, ids, sequence, offset
        columns = list(zip(*rows))
        kinds = [None if not r[2] else capacity // r[2] for r in rows]
        arrays = [pa.array(c, pa.binary() if n == 4 else pa.int64()) for n, c in enumerate(columns)]
        arrays += [pa.array([worker] * len(rows), pa.int32()), pa.array(kinds, pa.int32())]
        names = "doc_id start length doc_tokens ids sequence_id offset worker kind".split()
        rows.clear()
        return pa.RecordBatch.from_arrays(arrays, names)

    def tokenized():
        """Ids of documents and their tokens, in groups of about half a slice."""
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), raw_bytes(batch.column(1))):
                if len(text) > SLICE:
                    yield [doc_id], [tokenizer.encode(text)]
                    continue
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if 2 * size > SLICE:
                    yield ids, tokenizer.encode_all(texts)
                    ids, texts, size = [], [], 0
            yield ids, tokenizer.encode_all(texts)

    for ids, found in tokenized():
        for doc_id, own_ids in zip(ids, found):
            tokens = own_ids + end
            total, start = len(tokens) // 4, 0
            for length in cuts(total, capacity):
                kind = capacity // length
                own = open_bins[kind]
                own.append((doc_id, start, length, total, tokens[4 * start : 4 * (start + length)]))
                start += length
                if len(own) == kind:
                    offset, sequence = 0, (worker << 33) | made
                    for piece in own:
                        rows.append((*piece, sequence, offset))
                        offset += piece[2]
                    made += 1
                    own.clear()
            if len(rows) >= 2_000:
                yield flush()
    for own in open_bins.values():
        rows += [(*piece, None, None) for piece in own]
        if len(rows) >= 2_000:
            yield flush()
    if rows:
        yield flush()


def second_round(left: DataFrame, capacity: int) -> DataFrame:
    """Leftover pieces of a group of workers laid end to end; a piece that crosses a border is cut there."""
    group = F.expr(f"worker div {WORKERS}").alias("__group")
    order = Window.partitionBy("__group").orderBy("kind", "worker", "doc_id", "start")
    begin = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    laid = left.select("*", group).withColumn("__begin", begin)
    first, last = f"__begin div {capacity}", f"(__begin + length - 1) div {capacity}"
    cut = laid.withColumn("__at", F.explode(F.expr(f"sequence({first}, {last})")))
    low = F.greatest(F.col("__at") * capacity - F.col("__begin"), F.lit(0))
    high = F.least((F.col("__at") + 1) * capacity - F.col("__begin"), F.col("length"))
    cut = cut.withColumn("__low", low.cast("int")).withColumn("__high", high.cast("int"))
    return cut.select(
        "doc_id",
        (F.col("start") + F.col("__low")).alias("start"),
        (F.col("__high") - F.col("__low")).cast("bigint").alias("length"),
        "doc_tokens",
        F.expr("substring(ids, 4 * __low + 1, 4 * (__high - __low))").alias("ids"),
        F.expr(f"(1L << 62) + (__group << 33) + __at").alias("sequence_id"),
        (F.col("__begin") + F.col("__low") - F.col("__at") * capacity).cast("bigint").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, text: str = "text") -> DataFrame:
    """Every id of every document in exactly one piece of one sequence.

    Returns ``doc_id, start, length, doc_tokens, ids, sequence_id, offset``. Null and empty texts
    are documents of the end id alone; repeated rows are packed once each; null ids stay null; an
    empty table gives an empty one. Other columns of ``docs`` are not carried along.
    """

    def work(batches):
        return fill_bins(batches, tokenizer_path, capacity, TaskContext.get().partitionId())

    packed = stage(docs.select("doc_id", F.col(text).alias("text")).mapInArrow(work, PIECES), "packed")
    shown = ("doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset")
    full = packed.filter(F.col("sequence_id").isNotNull()).select(*shown)
    return full.unionByName(second_round(packed.filter(F.col("sequence_id").isNull()), capacity))


def word_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digest(packed: DataFrame) -> DataFrame:
    shown = ("doc_tokens", "sequence_id", "offset")
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), *shown)


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return digest(pack(table(spark, folder, "documents"), word_tokenizer_path()))
