"""Quality rules with adaptive thresholds instead of fixed cutoffs.

One pass measures every whole text with built-in functions only. Quantile sketches of the
measures, merged over all tasks, are taken per (language, source), per language and over the
table. A fence lies beyond the upper quartile of a group; the quartiles of a small group lean on
those of its language, and these on the table's. No limit is a constant: where most values of a
group are zero and its quartiles tell nothing, the fence is one occurrence in a document of the
group's median size. A document is refused when it passes the fence by more than chance explains
for its own size, so that short texts are not refused for a single capital letter or line.
Documents meet their group's fences in an equi-join.

Scale: the text is read once and never shuffled. Sketches are combined map-side, so a source
with a third of all rows costs one sketch per task. The joined side holds one row per language
and source; Spark broadcasts it when its measured size allows, else the join splits hot keys
(salted here, so that it does not depend on runtime statistics).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewarden.llm.common import BLANKS, free_names, stage, table

SYMBOLS = "[#*$%&|<>]+"
WINDOW = 8
ACCURACY = 2_000  # of the quantile sketch: rank error 1 / ACCURACY
REACH = 6.0  # a fence lies REACH spans (75th minus 50th percentile) beyond the 75th
CHANCE = 3.0  # standard errors that a document may lie beyond its group's fence
LEAN = 100.0  # documents of the wider group that count beside a group's own
SALTS = 16


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), "")


def repeated_words(words: str, window: int = WINDOW) -> Column:
    """Words covered by windows whose word sequence occurs twice or more, as SQL over an array of words.

    Windows are named by a 64-bit hash of their words' hashes. Names are sorted only to find out
    whether any occurs twice; places are sorted only in texts where one does.
    """
    parts = ", ".join(f"h[i + {k}]" for k in range(window))
    named = f"transform(sequence(0, size(h) - {window}), i -> xxhash64({parts}))"
    # places of repeated windows: sorted by name then place, a neighbour has the same name
    places = (
        "transform(filter(s, (x, k) -> (k > 0 AND s[k - 1].n = x.n) OR (k + 1 < size(s) AND s[k + 1].n = x.n)), x -> x.p)"
    )
    pairs = "sort_array(transform(w, (n, p) -> named_struct('n', n, 'p', p)))"
    covered = (
        f"aggregate(sort_array({places}), named_struct('e', 0, 't', 0L), "
        f"(a, p) -> named_struct('e', p + {window}, 't', a.t + p + {window} - greatest(a.e, p)), a -> a.t)"
    )
    some = "size(array_distinct(w)) < size(w)"
    counted = f"element_at(transform(array({pairs}), s -> {covered}), 1)"
    inner = f"element_at(transform(array({named}), w -> CASE WHEN {some} THEN {counted} ELSE 0L END), 1)"
    hashed = f"element_at(transform(array(transform({words}, x -> xxhash64(x))), h -> {inner}), 1)"
    return F.expr(f"CASE WHEN size({words}) < {window + 1} THEN 0L ELSE {hashed} END")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with a struct ``__m`` of the measures of the whole text."""
    (word_list,) = free_names(docs, ("words",))
    content = F.coalesce(F.col(text), F.lit(""))
    bare = F.regexp_replace(content, f"[{BLANKS}]+", "")
    lines = F.filter(F.split(content, "\n"), lambda line: F.rlike(line, F.lit(f"[^{BLANKS}]")))
    n_words = F.size(word_list).cast("bigint")
    word_chars = F.length(bare).cast("bigint")
    measures = F.struct(
        n_words.alias("n_words"),
        word_chars.alias("word_chars"),
        (F.length(bare) - F.length(F.regexp_replace(bare, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.greatest(F.size(lines), F.lit(1)).alias("n_lines"),
        repeated_words(word_list).alias("n_repeat_words"),
        (F.length(bare) - F.length(F.regexp_replace(bare, "[A-Z]+", ""))).alias("n_upper"),
    )
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    listed = docs.withColumn(word_list, words_of(F.col(text)))
    return listed.select(*rest, measures.alias("__m"))


def rates() -> dict[str, Column]:
    """The measures that get adaptive limits; high values are bad."""
    m = lambda name: F.col(f"__m.{name}").cast("double")
    words, chars = F.greatest(m("n_words"), F.lit(1.0)), F.greatest(m("word_chars"), F.lit(1.0))
    return {
        "symbol_rate": m("n_symbols") / chars,
        "dup_line_rate": m("n_dup_lines") / F.greatest(m("n_lines"), F.lit(1.0)),
        "repeat_rate": m("n_repeat_words") / words,
        "upper_rate": m("n_upper") / chars,
        "mean_word": m("word_chars") / words,
    }


def sizes() -> dict[str, Column]:
    """How many chances a document has for an occurrence of each measure."""
    m = lambda name: F.greatest(F.col(f"__m.{name}").cast("double"), F.lit(1.0))
    return {
        "symbol_rate": m("word_chars"),
        "dup_line_rate": m("n_lines"),
        "repeat_rate": F.greatest(m("n_words") / WINDOW, F.lit(1.0)),
        "upper_rate": m("word_chars"),
        "mean_word": m("n_words"),
    }


def thresholds(measured: DataFrame, groups: list[str]) -> DataFrame:
    """One row per group with a fence for each rate; ``groups`` are null-safe keys, from wide to narrow.

    Fences come from the documents that hold the base rules, so that a group full of junk does not
    raise its own limit with texts that are refused anyway.
    """
    names, size = list(rates()), sizes()
    sound = measured.filter(~F.col("__base_failed")).select(
        *groups, *[r.alias(n) for n, r in rates().items()], *[size[n].alias(f"__s_{n}") for n in names]
    )
    sketches = [F.percentile_approx(n, F.array(F.lit(0.5), F.lit(0.75)), F.lit(ACCURACY)).alias(n) for n in names]
    sketches += [F.percentile_approx(f"__s_{n}", 0.5, F.lit(ACCURACY)).alias(f"__s_{n}") for n in names]
    facts = [f"__n{{k}}", *[f"__{x}{{k}}_{n}" for n in names for x in "mhs"]]
    # a row per group of every level; a level is told by its number of keys
    found = sound.rollup(*groups).agg(F.grouping_id().alias("__level"), F.count(F.lit(1)).cast("double").alias("__n"), *sketches)
    found = stage(found, "fences")
    limits = None
    for k in range(len(groups) + 1):
        level = found.filter(F.col("__level") == 2 ** (len(groups) - k) - 1).select(
            *groups[:k],
            F.col("__n").alias(f"__n{k}"),
            *[F.col(n)[i].alias(f"__{x}{k}_{n}") for n in names for i, x in enumerate("mh")],
            *[F.col(f"__s_{n}").alias(f"__s{k}_{n}") for n in names],
        )
        if limits is None:
            limits = level
            continue
        limits = level.join(limits, groups[: k - 1]) if k > 1 else level.crossJoin(F.broadcast(limits))
        own, wider = F.col(f"__n{k}"), facts[1:]
        leaned = [
            ((own * F.col(f.format(k=k)) + LEAN * F.col(f.format(k=k - 1))) / (own + LEAN)).alias(f.format(k=k)) for f in wider
        ]
        limits = limits.select(*groups[:k], f"__n{k}", *leaned)
    k, fences = len(groups), []
    for n in names:
        middle, high, chances = (F.col(f"__{x}{k}_{n}") for x in "mhs")
        fences.append(F.greatest(high + REACH * (high - middle), 1 / chances).alias(f"__max_{n}"))
    return limits.select(*groups, *fences)


def apply_rules(docs: DataFrame, text: str = "text", groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``doc_id`` with the measures, ``base_failed`` and ``kept``, a row for every input row.

    Null texts count as empty, null languages and sources form groups of their own, repeated rows
    are kept apart; other columns of ``docs`` play no part. A group none of whose documents hold
    the base rules has no limits, and none are needed.
    """
    narrow = docs.select("doc_id", *groups, text)
    keys = [f"__g{n}" for n in range(len(groups))]
    failed = (F.col("__m.n_words") < 20) | (100 * F.col("__m.n_repeat_words") > 30 * F.col("__m.n_words"))
    measured = measure(narrow, text).withColumn("__base_failed", failed)
    # a key for null of its own: 'n', other values get a prefix
    key = [F.coalesce(F.concat(F.lit("v"), F.col(g).cast("string")), F.lit("n")) for g in groups]
    measured = stage(measured.select("doc_id", *[k.alias(n) for k, n in zip(key, keys)], "__m", "__base_failed"), "measures")
    limits = thresholds(measured, keys).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("doc_id", "__m"), F.lit(SALTS)).cast("int")
    joined = measured.withColumn("__salt", salt).join(limits, [*keys, "__salt"], "left")
    within = F.lit(True)
    for name, rate in rates().items():
        fence = F.col(f"__max_{name}")
        within = within & F.coalesce(rate <= fence + CHANCE * F.sqrt(fence / sizes()[name]), F.lit(True))
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return joined.select(
        "doc_id",
        *[F.col(f"__m.{c}").alias(c) for c in shown],
        F.col("__base_failed").alias("base_failed"),
        (~F.col("__base_failed") & within).alias("kept"),
    )


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return apply_rules(table(spark, folder, "documents"))
