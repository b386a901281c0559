"""Phrases whose words occur together more often than apart, from sorted suffixes.

A suffix is a word with the words that follow it in its piece, up to ``DEPTH`` words. Suffixes that begin
with a phrase stand together when sorted, so the size of their run is the count of the phrase.

1. Words are counted per language; those that occur ``LEAST`` times are kept with their names, 64-bit hashes of
   language and word. A bitmap of these names goes to all tasks.
2. Every task sorts its suffixes and counts equal ones. A suffix ends before a word that is not in the bitmap,
   as no phrase with a rare word is frequent. Suffixes are routed to owners by their two leading words.
3. An owner sorts what it gets by multikey three-way quicksort: all open parts of the array are split
   by a pivot of the word at their depth into smaller, equal and larger. Sizes of equal parts are counts;
   they go on one word deeper. Parts that hold less than ``LEAST`` suffixes hold no frequent phrase and are
   abandoned, which is final, because all suffixes with the same leading words have the same owner.
4. Counts of phrases, of their parts and of longer phrases around them are joined; the scores are exact
   integers.

Scale: texts do not move. A task sends each distinct suffix once per ``GROUP_BYTES`` of text. Up to ``COMMON`` of
the most frequent words are known to all tasks by number, other words are sent along by name. A pair of very frequent words may begin a third of all suffixes: such pairs
are counted on their own, and the suffixes behind them are routed by all their words. The words
frequent enough for that are fewer than ``HOT``, which bounds the list that tasks get.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewarden.llm.common import raw_bytes, stage, stage_small, table
from tracewarden.llm.words import _powers, mix

DEPTH = 3
LEAST = 10
TOP = 2_000
HOT = 1_000  # a word with more than one in so many of all occurrences is hot
BITS = 1 << 25  # of the bitmap of frequent words
COMMON = 1 << 20  # words that have a number; 8 bytes each
GROUP_BYTES = 8 << 20
SLICE = 1 << 18
OWNER_ROWS = 2_000_000  # suffixes that an owner gets, about
OPEN_SALTS = 64

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BETWEEN = np.zeros(256, bool)  # pieces end here
_BETWEEN[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
_BLANK = _BETWEEN.copy()
_BLANK[[0x20, 0x09]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _slices(text: bytes) -> Iterator[bytes]:
    """Parts of a text of about ``SLICE`` bytes that end before a character between words."""
    at = 0
    while at < len(text):
        end = min(at + SLICE, len(text))
        while end < len(text):
            window = np.frombuffer(text, np.uint8, min(SLICE, len(text) - end), end)
            ends = np.flatnonzero(_BLANK[window])
            if len(ends):
                end += int(ends[0])
                break
            end += len(window)
        yield text[at:end]
        at = end


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start, end and piece of the words of a buffer in lower case."""
    raw = np.frombuffer(data, np.uint8)
    solid = np.zeros(len(raw) + 2, bool)
    np.logical_not(_BLANK[raw], out=solid[1:-1])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(0, max(len(raw), 1))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, starts, ends, np.cumsum(_BETWEEN[raw])[starts]


def language_salt(lang: str) -> np.uint64:
    data = lang.encode()
    return mix(np.array([zlib.crc32(data) + (zlib.adler32(data) << 32)], np.uint64))[0]


def _parts(langs: list[str], texts: list[bytes]) -> Iterator[tuple[list[str], list[bytes]]]:
    """Neighbouring texts of one language joined by a line feed, in buffers of about ``SLICE`` bytes; grouped by ``GROUP_BYTES``."""
    names: list[str] = []
    buffers: list[bytes] = []
    held: list[bytes] = []
    size = total = 0

    def close(lang):
        nonlocal size
        if held:
            names.append(lang)
            buffers.append(b"\n".join(held))
            held.clear()
            size = 0

    order = sorted(range(len(texts)), key=langs.__getitem__)
    for n, k in enumerate(order):
        text = texts[k].translate(_FOLD)
        if n and langs[order[n - 1]] != langs[k]:
            close(langs[order[n - 1]])
        total += len(text)
        if len(text) > SLICE:
            close(langs[k])
            names.append(langs[k])
            buffers.append(text)
        else:
            held.append(text)
            size += len(text) + 1
            if size >= SLICE:
                close(langs[k])
        if total >= GROUP_BYTES:
            close(langs[k])
            yield names, buffers
            names, buffers, total = [], [], 0
    if order:
        close(langs[order[-1]])
    if buffers:
        yield names, buffers


def _named_words(lang: str, buffer: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """``_words`` of a buffer slice by slice; names hold the language, pieces go on over slices."""
    salt, before = language_salt(lang), 0
    for part in _slices(buffer) if len(buffer) > 2 * SLICE else (buffer,):
        hashes, starts, ends, piece = _words(part)
        yield mix(hashes ^ salt), starts, ends, piece + before, part
        before += int(_BETWEEN[np.frombuffer(part, np.uint8)].sum())


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, h, word, n`` of every word of every language; staged."""

    def work(batches):
        for batch in batches:
            for names, buffers in _parts(batch.column(0).to_pylist(), raw_bytes(batch.column(1))):
                found: dict[str, list] = {}
                for lang, buffer in zip(names, buffers):
                    for hashes, starts, ends, _, part in _named_words(lang, buffer):
                        own, first, n = np.unique(hashes, return_index=True, return_counts=True)
                        words = [part[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
                        found.setdefault(lang, []).append((own, n, words))
                for lang, parts in found.items():
                    own, first, place = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
                    n = np.bincount(place, np.concatenate([p[1] for p in parts]), len(own)).astype(np.int64)
                    words = [w for p in parts for w in p[2]]
                    columns = [
                        pa.array([lang] * len(own), pa.string()),
                        pa.array(own.view(np.int64)),
                        pa.array([words[k] for k in first.tolist()], pa.binary()).cast(pa.string()),
                        pa.array(n),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "h", "word", "n"])

    rows = docs.mapInArrow(work, "lang string, h bigint, word string, n bigint")
    return stage_small(rows.groupBy("lang", "h", "word").agg(F.sum("n").alias("n")), "words")


def frequent_bitmap(words: DataFrame) -> np.ndarray:
    """One bit for each remainder of a name, set if a frequent word has it; at most ``BITS / 64`` rows are collected."""
    place = F.pmod(F.col("h"), F.lit(BITS))
    cells = words.groupBy((place / 64).cast("int").alias("cell")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))).alias("bits")
    )
    found = cells.toArrow()
    bitmap = np.zeros(BITS // 64, np.int64)
    bitmap[found.column("cell").to_numpy()] = found.column("bits").to_numpy()
    return bitmap


def common_words(words: DataFrame) -> np.ndarray:
    """Names of the most frequent words in order: all words of at least the least power of two that at most ``COMMON`` reach."""
    power = F.floor(F.log2("n")).cast("int").alias("power")
    sizes = dict(words.groupBy(power).agg(F.count(F.lit(1))).collect())  # at most 64 rows
    total, least = 0, 64
    while least and total + sizes.get(least - 1, 0) <= COMMON:
        least -= 1
        total += sizes.get(least, 0)
    found = words.filter(F.floor(F.log2("n")) >= least).select("h").toArrow().column("h").to_numpy()
    return np.sort(found.view(np.uint64))


def _in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes.view(np.int64) % BITS  # as pmod
    return (bitmap[place >> 6] >> (place & 63)) & 1 == 1


def _suffixes(parts: list[tuple[np.ndarray, np.ndarray]], bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, distinct suffixes as rows of ``DEPTH`` places in them, and how often each occurs; name 0 is beyond the end."""
    hashes = np.concatenate([p[0] for p in parts])
    tops = np.cumsum([0, *[int(p[1][-1]) + 2 if len(p[1]) else 0 for p in parts]])
    piece = np.concatenate([p[1] + top for p, top in zip(parts, tops)])
    usual = _in_bitmap(bitmap, hashes)
    names, number = np.unique(hashes, return_inverse=True)
    number = np.where(usual, number + 1, 0)
    columns = [number]
    for k in range(1, DEPTH):
        follows = np.zeros(len(number), np.int64)
        if len(number) > k:
            follows[:-k] = np.where((piece[k:] == piece[:-k]) & (columns[-1][:-k] > 0), number[k:], 0)
        columns.append(follows)
    width = max(1, int(len(names)).bit_length())  # 8 MB of text hold less than 2^21 distinct words
    if DEPTH * width > 63:
        rows = np.stack(columns, 1)[columns[1] > 0]
        kept, times = np.unique(rows, axis=0, return_counts=True)
    else:
        key = columns[0]
        for column in columns[1:]:
            key = key << width | column
        key, times = np.unique(key[columns[1] > 0], return_counts=True)
        kept = np.stack([key >> (width * (DEPTH - 1 - k)) & ((1 << width) - 1) for k in range(DEPTH)], 1)
    return np.concatenate([np.zeros(1, np.uint64), names]), kept, times


def _numbered(names: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Numbers of common names from 1 on, 0 for name 0 at the first place, and minus the place of others."""
    at = np.minimum(np.searchsorted(common, names), max(len(common) - 1, 0))
    known = common[at] == names if len(common) else np.zeros(len(names), bool)
    numbers = np.where(known, at + 1, -np.arange(len(names)))
    numbers[0] = 0
    return numbers


def _blob(rows: np.ndarray, times: np.ndarray, names: np.ndarray, n_common: int) -> bytes:
    """Rows of numbers column by column with counts, and the names of those that are not common, numbered after these."""
    own = np.unique(rows[rows < 0])
    columns = np.where(rows < 0, n_common + 1 + np.searchsorted(own, rows), rows).astype(np.int32).T.copy()
    head = np.array([len(own), len(rows)], np.int64).tobytes()
    body = names[-own].tobytes() + columns.tobytes() + times.astype(np.int32).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + body)


def _unblobbed(blobs: list[bytes], n_common: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of numbers and their counts from all lists, and the names of the numbers after the common ones."""
    rows, times, names = [], [], []
    for blob in blobs:
        data = zstandard.ZstdDecompressor().decompress(blob)
        n_names, n = np.frombuffer(data, np.int64, 2).tolist()
        names.append(np.frombuffer(data, np.uint64, n_names, 16))
        at = 16 + 8 * n_names
        rows.append(np.frombuffer(data, np.int32, DEPTH * n, at).reshape(DEPTH, n))
        times.append(np.frombuffer(data, np.int32, n, at + 4 * DEPTH * n))
    every = np.unique(np.concatenate(names))
    for k, own in enumerate(names):
        if len(own):
            renamed = np.concatenate([np.zeros(1, np.int64), np.searchsorted(every, own)]) + n_common + 1
            beyond = np.maximum(rows[k] - n_common, 0)
            rows[k] = np.where(beyond > 0, renamed[beyond], rows[k]).astype(np.int32)
    return np.concatenate(rows, axis=1).T.copy(), np.concatenate(times).astype(np.int64), every


def routed_suffixes(docs: DataFrame, bitmap: np.ndarray, common: np.ndarray, hot: np.ndarray, owners: int) -> DataFrame:
    """Suffixes of at least two words as ``owner, deep, blob``.

    Those that begin with two words in ``hot`` are sent twice: cut to the two words, which count the pair, and, as
    ``deep``, by all of their words.
    """
    deal = np.uint64(owners)
    shared = docs.sparkSession.sparkContext.broadcast((bitmap, common))

    def work(batches):
        for batch in batches:
            for names, buffers in _parts(batch.column(0).to_pylist(), raw_bytes(batch.column(1))):
                parts = [found[:4:3] for lang, buffer in zip(names, buffers) for found in _joined(lang, buffer)]
                if not parts:
                    continue
                known, numbered = shared.value
                named, rows, times = _suffixes(parts, known)
                numbers, heated = _numbered(named, numbered), np.isin(named, hot)
                is_hot = heated[rows[:, 0]] & heated[rows[:, 1]]
                cut = rows[is_hot].copy()
                cut[:, 2:] = 0
                deep = is_hot & (rows[:, 2] > 0)
                kinds = [(False, rows[~is_hot], times[~is_hot]), (False, cut, times[is_hot]), (True, rows[deep], times[deep])]
                for is_deep, own, n in kinds:
                    lead = mix(named[own[:, 0]] * _STEP + named[own[:, 1]])
                    for k in range(2, DEPTH if is_deep else 2):
                        lead = mix(lead * _STEP + named[own[:, k]])
                    owner = (lead % deal).astype(np.int64)
                    order = np.argsort(owner, kind="stable")
                    own, n, owner = numbers[own[order]], n[order], owner[order]
                    starts = np.flatnonzero(np.diff(owner, prepend=-1))
                    ends = np.append(starts[1:], len(owner))
                    blobs = [_blob(own[a:b], n[a:b], named, len(numbered)) for a, b in zip(starts.tolist(), ends.tolist())]
                    columns = [
                        pa.array(owner[starts].astype(np.int32)),
                        pa.array([is_deep] * len(starts), pa.bool_()),
                        pa.array(blobs, pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["owner", "deep", "blob"])

    return docs.mapInArrow(work, "owner int, deep boolean, blob binary")


def _joined(lang: str, buffer: bytes) -> list[tuple]:
    """``_named_words`` of a buffer with its slices put together, so that phrases cross them."""
    found = list(_named_words(lang, buffer))
    if len(found) == 1:
        return found
    columns = [np.concatenate([f[k] for f in found]) for k in range(4)]
    return [(*columns, b"")]


def frequent_prefixes(rows: np.ndarray, times: np.ndarray, least: int, first: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Prefixes of at least ``first`` words that occur ``least`` times, 0 beyond their end, and their counts.

    Multikey three-way quicksort, all parts of one depth and round at once. ``order`` points at suffixes;
    a part is a run of it whose suffixes agree in the first ``depth`` words.
    """
    found, counts = [np.zeros((0, DEPTH), rows.dtype)], [np.zeros(0, np.int64)]
    order = np.arange(len(rows))
    starts = np.zeros(min(1, len(rows)), np.int64)
    for depth in range(DEPTH):
        key = rows[:, depth]
        deeper: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        while len(order):
            width = np.diff(np.append(starts, len(order)))
            part = np.repeat(np.arange(len(starts)), width)
            value = key[order]
            pivot = value[starts + width // 2][part]
            side = (value >= pivot).astype(np.int8) + (value > pivot)
            # stable three-way split of every part: smaller, equal, larger
            new = np.empty_like(order)
            begin = starts.copy()
            limits = [starts]
            for k in range(3):
                inside = side == k
                rank = np.cumsum(inside) - inside
                to = (begin[part] + rank - rank[starts][part])[inside]
                new[to] = order[inside]
                begin = begin + np.add.reduceat(inside, starts)
                limits.append(begin)
            order = new
            for k in range(3):  # parts of suffixes too few to hold a frequent phrase are abandoned
                a, b = limits[k], limits[k + 1]
                total = np.concatenate([[0], np.cumsum(times[order])])
                enough = total[b] - total[a] >= least
                a, b = a[enough], b[enough]
                if k == 1:
                    heads = order[a]
                    real = key[heads] > 0  # 0: the suffixes end here
                    a, b, heads = a[real], b[real], heads[real]
                    if depth + 1 >= first:
                        prefix = rows[heads].copy()
                        prefix[:, depth + 1 :] = 0
                        found.append(prefix)
                        counts.append(total[b] - total[a])
                    deeper.append(_pointers(order, a, b))
                    sizes.append(b - a)
                elif k == 0:
                    low = a, b
                else:
                    high = a, b
            a, b = np.concatenate([low[0], high[0]]), np.concatenate([low[1], high[1]])
            order = _pointers(order, a, b)
            starts = np.concatenate([[0], np.cumsum(b - a)])[:-1].astype(np.int64)
        order = np.concatenate(deeper) if deeper else order
        widths = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        starts = (np.cumsum(widths) - widths).astype(np.int64)
    return np.concatenate(found), np.concatenate(counts)


def _pointers(order: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The runs ``[a, b)`` of ``order`` one after the other."""
    width = b - a
    shift = np.repeat(a - (np.cumsum(width) - width), width)
    return order[shift + np.arange(len(shift))]


PREFIXES = "h1 bigint, h2 bigint, h3 bigint, a bigint"


def phrase_counts(suffixes: DataFrame, common: np.ndarray, least: int) -> DataFrame:
    """``h1, h2, h3, a`` of all phrases of two (``h3`` is 0) or three words that occur ``least`` times; staged."""
    shared = suffixes.sparkSession.sparkContext.broadcast(common)

    def work(part: pa.Table) -> pa.Table:
        rows, times, names = _unblobbed(part.column("blob").to_pylist(), len(shared.value))
        first = DEPTH if part.column("deep")[0].as_py() else 2
        found, n = frequent_prefixes(rows, times, least, first)
        names = np.concatenate([np.zeros(1, np.uint64), shared.value, names])
        columns = [pa.array(names[found[:, k]].view(np.int64)) for k in range(DEPTH)]
        return pa.table([*columns, pa.array(n)], names=["h1", "h2", "h3", "a"])

    return stage(suffixes.groupBy("owner", "deep").applyInArrow(lambda part: work(part), PREFIXES), "phrases")


def score(a: str, l: str, r: str) -> str:  # noqa: E741
    """floor(1000000 a a / (l r)), exact in 38 decimal digits for counts below 10^15."""
    big = "CAST({} AS DECIMAL(19, 0))"
    return f"CAST((CAST(1000000 AS DECIMAL(7, 0)) * ({big.format(a)} * {big.format(a)})) div ({big.format(l)} * {big.format(r)}) AS BIGINT)"


def scored_phrases(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the candidates that no longer one holds; ``words`` has the frequent words."""
    pairs = phrases.filter("h3 = 0").select("h1", "h2", "a")
    triples = phrases.filter("h3 <> 0")
    around = triples.select("h1", "h2", "a").unionByName(triples.selectExpr("h2 AS h1", "h3 AS h2", "a"))
    around = around.groupBy("h1", "h2").agg(F.max("a").alias("most"))
    free = pairs.join(around, ["h1", "h2"], "left").filter("most IS NULL OR 100 * most < 50 * a")

    def named(rows: DataFrame, k: int, *extra: str) -> DataFrame:
        own = words.select(F.col("h").alias(f"h{k}"), F.col("word").alias(f"w{k}"), F.col("n").alias(f"n{k}"), *extra)
        return rows.join(own, f"h{k}")

    two = named(named(free.select("h1", "h2", "a"), 1, "lang"), 2)
    two = two.selectExpr("lang", "concat_ws(' ', w1, w2) AS phrase", "a", "n1 AS l", "n2 AS r", f"{score('a', 'n1', 'n2')} AS score")
    three = triples.join(pairs.selectExpr("h1", "h2", "a AS front"), ["h1", "h2"])
    three = three.join(pairs.selectExpr("h1 AS h2", "h2 AS h3", "a AS back"), ["h2", "h3"])
    three = named(named(named(three, 1, "lang"), 2), 3).selectExpr(
        "lang",
        "concat_ws(' ', w1, w2, w3) AS phrase",
        "a",
        f"{score('a', 'n1', 'back')} AS s1",
        f"{score('a', 'front', 'n3')} AS s2",
        *["n1", "back", "front", "n3"],
    )
    early = "s1 <= s2"
    three = three.selectExpr(
        "lang", "phrase", "a", f"if({early}, n1, front) AS l", f"if({early}, back, n3) AS r", "least(s1, s2) AS score"
    )
    return two.unionByName(three)


def collocations(docs: DataFrame, text: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of every language, a null one being ``und``.

    ``a`` counts the phrase, ``l`` and ``r`` its parts at the cut with the lowest score, ``n`` all words of the
    language. Null, empty and blank texts have no words, ids play no part, repeated rows count each. Other
    columns are not read. An empty table gives an empty one.
    """
    narrow = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    every = word_counts(narrow.filter(F.col("text").isNotNull()))
    totals = stage(every.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    words = stage(every.filter(F.col("n") >= least), "frequent")
    total = totals.agg(F.sum("n")).first()[0] or 0
    often = words.filter(F.col("n") > total / HOT).select("h").toArrow().column("h").to_numpy()  # less than HOT rows
    owners = max(1, total // OWNER_ROWS)
    common = common_words(words)
    told = narrow.filter(F.col("text").isNotNull())
    suffixes = routed_suffixes(told, frequent_bitmap(words), common, often.view(np.uint64), owners)
    found = scored_phrases(phrase_counts(suffixes, common, least), words)
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(OPEN_SALTS)).alias("salt")
    place = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))
    found = found.select("*", salt).withColumn("place", place).filter(F.col("place") <= top).drop("place", "salt")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")
    found = found.withColumn("rank", rank).filter(F.col("rank") <= top).join(totals, "lang")
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


OP12_SQL = """
WITH folded AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS folded
  FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT lang, unnest(string_split_regex(folded, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM folded),
listed AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws FROM pieces),
grams AS (
  SELECT lang, 1 AS k, unnest(ws) AS phrase FROM listed
  UNION ALL SELECT lang, 2, unnest([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))]) FROM listed
  UNION ALL SELECT lang, 3, unnest([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)]) FROM listed),
f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
kept AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 10),
inner_pairs AS (
  SELECT lang, ws[1] || ' ' || ws[2] AS phrase, a FROM kept WHERE k = 3
  UNION ALL SELECT lang, ws[2] || ' ' || ws[3], a FROM kept WHERE k = 3),
free AS (
  SELECT * FROM kept c WHERE NOT EXISTS (
    SELECT 1 FROM inner_pairs p WHERE c.k = 2 AND p.lang = c.lang AND p.phrase = c.phrase AND 100 * p.a >= 50 * c.a)),
cuts AS (
  SELECT *, unnest(range(1, k)) AS cut FROM free),
scores AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.n AS l, y.n AS r,
         CAST(1000000::HUGEINT * c.a * c.a // (x.n::HUGEINT * y.n) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.cut + 1:], ' ')),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
