"""Prediction by partial matching over bytes, and a unigram score of words beside it.

The model is the context trie of all training texts to depth ``ORDER``: how often each byte
(or the end of the text) follows each context. A symbol that never followed a context is coded
by an escape (method D: half a count for each different symbol seen there, taken from that
symbol's count), then in the next shorter context without the symbols already ruled out, down to
a uniform choice. A text's
score is the log10 probability of its bytes, A-Z in lower case, and its end.

1. One pass cuts the texts into chunks of bounded size and stages them with the chunk's
   distinct words and byte strings of length ORDER + 1, each with its count in training texts.
2. Counts are added up over all chunks. The trie is laid out by the two bytes next to the
   symbol: a part holds every longer context that ends in them, at most 258^3 strings, and
   yields the probabilities of all strings in it. Contexts of one byte and none are 258 x 257
   numbers, which every part gets.
3. Counts and probabilities go back to the chunks that asked for them, and each chunk's texts
   are scored.

Scale: what moves per chunk are its distinct words and strings, not their occurrences, and the
texts once. A word or string has at most one row per chunk, so no key is hotter than the number
of chunks. The vocabulary is never held as a whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewarden.llm.common import hold_out, raw_bytes, stage_small, table

ORDER = 4
SYMBOLS = 257  # bytes and the end of a text
END, START = 256, 257
BITS = np.uint64(9)
CHUNK_BYTES = 10 << 20
PIECE = 1 << 21
FOLDS, HELD_OUT_FOLD = 7, 2
END_TOKEN = b""  # no word is empty


def pieces(texts: list[bytes]) -> Iterator[tuple[int, bytes, bytes, bool]]:
    """Text number, the bytes before, up to ``PIECE`` bytes, and whether the text ends there."""
    for n, text in enumerate(texts):
        for at in range(0, max(len(text), 1), PIECE):
            yield n, text[max(0, at - ORDER) : at], text[at : at + PIECE], at + PIECE >= len(text)


def strings(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of all strings (context and symbol) in groups of bounded size, and the text number of each."""

    def coded(group):
        symbols, fresh, owner = [], [], []
        for n, before, part, last in group:
            head = np.full(ORDER, START, np.uint16)
            if before:
                head[-len(before) :] = np.frombuffer(before, np.uint8)
            own = np.empty(len(part) + last, np.uint16)
            own[: len(part)] = np.frombuffer(part, np.uint8)
            if last:
                own[-1] = END
            symbols += [head, own]
            fresh += [np.zeros(ORDER, bool), np.ones(len(own), bool)]
            owner.append(np.full(len(own), n, np.int64))
        line = np.concatenate(symbols).astype(np.uint64)
        code = line[: len(line) - ORDER].copy()
        for k in range(1, ORDER + 1):
            code <<= BITS
            code |= line[k : len(line) - ORDER + k]
        return code[np.concatenate(fresh)[ORDER:]].view(np.int64), np.concatenate(owner)

    group, size = [], 0
    for piece in pieces(texts):
        group.append(piece)
        size += len(piece[2]) + ORDER + 1
        if size >= PIECE:
            yield coded(group)
            group, size = [], 0
    if group:
        yield coded(group)


def _counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings of some texts and how often each occurs."""
    found = [np.unique(codes, return_counts=True) for codes, _ in strings(texts)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    every, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    counts = np.zeros(len(every), np.int64)
    np.add.at(counts, at, np.concatenate([f[1] for f in found]))
    return every, counts


CHUNKED = "chunk bigint, doc_id bigint, held_out boolean, text string, word string, string bigint, seen bigint, kind string"


def chunked(docs: DataFrame, text: str) -> DataFrame:
    """Staged rows of three kinds per chunk: its texts, its distinct words, its distinct strings."""
    names = [f.split(" ")[0] for f in CHUNKED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def rows(n: int, chunk: int, kind: str, **columns):
        given = {"chunk": pa.array(np.full(n, chunk)), "kind": pa.array([kind] * n, pa.string()), **columns}
        arrays = [given[c] if c in given else pa.nulls(n, t) for c, t in zip(names, types)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def close(chunk: int, texts: list[bytes], held: list[bool]):
        words: dict[bytes, int] = {END_TOKEN: len(held) - sum(held)}
        for content, out in sorted(zip(texts, held), key=lambda x: x[1]):
            step = 0 if out else 1
            for word in content.split():
                words[word] = words.get(word, 0) + step
        keys, counts = list(words), list(words.values())
        for at in range(0, len(keys), 100_000):
            some = pa.array(keys[at : at + 100_000], pa.binary()).cast(pa.string())
            yield rows(len(some), chunk, "word", word=some, seen=pa.array(counts[at : at + 100_000], pa.int64()))
        seen, counts = _counted([t for t, out in zip(texts, held) if not out])
        asked, _ = _counted([t for t, out in zip(texts, held) if out])
        more = np.setdiff1d(asked, seen, assume_unique=True)
        found = pa.array(np.concatenate([seen, more])), pa.array(np.concatenate([counts, np.zeros(len(more), np.int64)]))
        for at in range(0, len(found[0]), 100_000):
            some = [x.slice(at, 100_000) for x in found]
            yield rows(len(some[0]), chunk, "string", string=some[0], seen=some[1])

    def work(batches):
        chunk, size = TaskContext.get().partitionId() << 20, 0
        texts: list[bytes] = []
        held: list[bool] = []
        for batch in batches:
            contents = [t.lower() for t in raw_bytes(batch.column(2))]
            out = batch.column(1).to_pylist()
            at = 0
            while at < len(contents):  # a batch may end one chunk and begin the next
                end = at
                while end < len(contents) and size < CHUNK_BYTES:
                    size += len(contents[end]) + 1
                    end += 1
                part = [pa.array(contents[at:end], pa.binary()).cast(pa.string())]
                ids = {"doc_id": batch.column(0).slice(at, end - at), "held_out": batch.column(1).slice(at, end - at)}
                yield rows(end - at, chunk, "text", text=part[0], **ids)
                texts += contents[at:end]
                held += out[at:end]
                at = end
                if size >= CHUNK_BYTES:
                    yield from close(chunk, texts, held)
                    chunk, size, texts, held = chunk + 1, 0, [], []
        if texts:
            yield from close(chunk, texts, held)

    out = hold_out("doc_id", FOLDS, HELD_OUT_FOLD).alias("held_out")
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), out, F.col(text).alias("text"))
    return stage_small(narrow.mapInArrow(work, CHUNKED), "chunks")


def probabilities(codes: np.ndarray, seen: np.ndarray, order1: np.ndarray, order0: np.ndarray) -> np.ndarray:
    """log10 of the probability of every string of one part of the trie (all end in the same two context bytes).

    ``order1`` counts the symbols after the last context byte, ``order0`` all symbols.
    """
    symbol = (codes & 511).astype(np.int64)
    farther, context = (codes >> 27) & 511, codes >> 27
    near, near_at = np.unique(farther, return_inverse=True)
    order3 = np.zeros((len(near), SYMBOLS))
    np.add.at(order3, (near_at, symbol), seen)
    order2 = order3.sum(0)
    contexts, at = np.unique(context, return_inverse=True)
    out = np.empty(len(codes))
    by_context = np.argsort(at, kind="stable")
    bounds = np.searchsorted(at[by_context], np.arange(0, len(contexts) + 2_000, 2_000))
    for n, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        rows = by_context[a:b]
        if not len(rows):
            continue
        own = at[rows] - n * 2_000
        order4 = np.zeros((own.max() + 1, SYMBOLS))
        np.add.at(order4, (own, symbol[rows]), seen[rows])
        third = np.zeros(len(order4), np.int64)
        third[own] = near_at[rows]
        p, left = np.zeros_like(order4), np.ones(len(order4))
        open_ = np.ones(order4.shape, bool)
        for counts in (order4, order3[third], order2[None, :], order1[None, :], order0[None, :]):
            free = np.where(open_, counts, 0.0)
            total, kinds = free.sum(1), (free > 0).sum(1)
            some = kinds > 0
            share = np.where(some, left / np.maximum(2 * total, 1), 0.0)
            p += np.maximum(2 * free - 1, 0.0) * share[:, None]
            left = np.where(some, kinds * share, left)
            open_ &= counts == 0
        rest = open_.sum(1)
        p += np.where(open_, (left / np.maximum(rest, 1))[:, None], 0.0)
        out[rows] = np.log10(p[own, symbol[rows]])
    return out


def trie(chunks: DataFrame) -> DataFrame:
    """``string, value``: every string that occurs, with its log10 probability, staged."""
    found = chunks.filter("kind = 'string'")
    counts = stage_small(found.groupBy("string").agg(F.sum("seen").alias("seen")), "strings")
    pair = counts.groupBy(F.expr("string & 262143").alias("pair")).agg(F.sum("seen").alias("seen"))
    order1 = np.zeros((512, SYMBOLS))
    for pair, seen in pair.collect():  # at most 258 * 257 rows
        order1[pair >> 9, pair & 511] = seen
    order0 = order1.sum(0)

    def work(part: pa.Table) -> pa.Table:
        codes = part.column("string").to_numpy()
        values = probabilities(codes, part.column("seen").to_numpy(), order1[(codes[0] >> 9) & 511], order0)
        return pa.table({"string": pa.array(codes), "value": pa.array(values)})

    # grouped by the two context bytes next to the symbol
    parts = counts.groupBy(F.expr("(string >> 9) & 262143").alias("part"))
    return stage_small(parts.applyInArrow(work, "string bigint, value double"), "trie")


def score(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Null and empty texts are the end token alone. Repeated rows count, and are scored, each; rows
    without an id are training texts. An empty table gives an empty one; without training texts
    every symbol is equally likely. Other columns are not read.
    """
    chunks = chunked(docs, text)
    same = Window.partitionBy("word")
    words = chunks.filter("kind = 'word'").select(
        "chunk", "word", "seen", F.sum("seen").over(same).alias("all"),
        F.row_number().over(same.orderBy("chunk")).alias("nth"),
    )
    words = stage_small(words, "words")
    known = F.sum(((F.col("nth") == 1) & (F.col("all") > 0)).cast("bigint"))
    tokens, kinds = (x or 0 for x in words.agg(F.sum("seen"), known).first())
    asked = chunks.filter("kind = 'string'").select("chunk", "string").join(trie(chunks), "string")
    wanted = words.select(
        "chunk", "word", F.lit(None).cast("bigint").alias("string"), F.col("all").cast("double").alias("value")
    ).unionByName(asked.select("chunk", F.lit(None).cast("string").alias("word"), "string", "value"))
    level = math.log10(tokens + kinds + 1)

    def work(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        is_word = wanted.column("word").is_valid()
        own = wanted.filter(is_word)
        logs = np.log10(own.column("value").to_numpy() + 1)
        value_of = dict(zip(raw_bytes(own.column("word")), logs.tolist()))
        model = wanted.filter(wanted.column("string").is_valid())
        codes, values = model.column("string").to_numpy(), model.column("value").to_numpy()
        order = np.argsort(codes)
        codes, values = codes[order], values[order]
        contents = raw_bytes(texts.column("text"))
        n_tokens, n_known, base = [], [], []
        for content in contents:
            found = np.array([*map(value_of.__getitem__, content.split()), value_of[END_TOKEN]])
            n_tokens.append(len(found))
            n_known.append(int(np.count_nonzero(found)))
            base.append(float(found.sum()) - len(found) * level)
        scores = np.zeros(len(contents))
        for some, owner in strings(contents):
            part = values[np.searchsorted(codes, some)]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            scores[owner[first]] += np.add.reduceat(part, first)
        columns = [
            texts.column("doc_id"), texts.column("held_out"), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
            pa.array(np.full(len(contents), tokens), pa.int64()), pa.array(base, pa.float64()), pa.array(scores),
        ]
        return pa.Table.from_arrays(columns, names)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    texts = chunks.filter("kind = 'text'").select("chunk", "doc_id", "held_out", "text")
    return texts.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(work, schema)


def op5_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return score(table(spark, folder, "documents"))
