"""Quality classifier learned from trusted positives and unlabelled text.

The model is linear in measures of a whole text (frequencies of its bytes, repetition of words
and lines, lengths) and minimises the non-negative unbiased risk of positive-unlabelled
learning: with class prior p and logistic loss l,

    p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)])

where P are texts labelled 1 and U any texts. Labels of 0 enter only into the estimate of p,
the share of 1 among all labelled training rows. Logistic loss makes sigmoid(f) an estimate of
the probability of label 1.

Scale: scoring is one pass in Arrow batches without a shuffle; the model is a few kilobytes.
Fitting uses about ``MAX_POSITIVES`` and ``MAX_UNLABELLED`` texts, chosen by a hash of the id;
labels meet the documents through a broadcast of at most that many ids. Prior and counts cover
all labelled rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewarden.llm.common import drop_worker_tables, hold_out, raw_bytes, table

MAX_POSITIVES = 10_000
MAX_UNLABELLED = 20_000
CUT = 0.3
FOLDS, HELD_OUT_FOLD = 5, 0
STEPS = 400
RATE = 0.05
DECAY = 1e-4


def features(text: bytes) -> np.ndarray:
    """Measures of a whole text; the empty text has zeros but for the constant."""
    words = text.split()
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(np.float64)
    n, size = max(len(words), 1), max(len(text), 1)
    # line feeds and carriage returns tell about layout, other blanks only about word length
    lines = [line for line in text.split(b"\n") if line.strip()]
    same = sum(a == b for a, b in zip(words, words[1:]))
    distinct = len(set(words))
    upper = counts[65:91].sum()
    letters = upper + counts[97:123].sum() + counts[128:].sum()
    more = [
        same / n,
        1 - distinct / n,
        max(0.0, 1 - distinct / max(1.0, 3 * n**0.75)),
        1 - len(set(lines)) / max(len(lines), 1),
        upper / max(letters, 1),
        1 - letters / size,
        min(len(text) / n, 50) / 10,
        math.log1p(len(words)) / 10,
        1.0,
    ]
    return np.concatenate([np.sqrt(counts / size), more]).astype(np.float32)


WIDTH = 256 + 9


@dataclass
class Model:
    """Weights over centred and scaled measures; without any positive text, everything scores 0.5."""

    weights: np.ndarray
    shift: np.ndarray
    scale: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        f = np.clip(((rows - self.shift) / self.scale) @ self.weights, -40, 40)
        return 1 / (1 + np.exp(-f))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative risk by full-batch Adam steps from zero."""
    every = np.concatenate([positive, unlabelled]).astype(np.float64)
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(WIDTH), np.zeros(WIDTH), np.ones(WIDTH))
    shift, scale = every.mean(0), every.std(0)
    constant = scale < 1e-9
    shift[constant], scale[constant] = 0.0, 1.0
    scale = np.maximum(scale, 1e-3)
    p, u = (np.clip((x - shift) / scale, -30, 30).astype(np.float32) for x in (positive, unlabelled))
    w = np.zeros(WIDTH)
    first, second = np.zeros(WIDTH), np.zeros(WIDTH)
    for step in range(1, STEPS + 1):
        fp, fu = (np.clip(x @ w.astype(np.float32), -40, 40) for x in (p, u))
        sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        slope_negative = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        if negative >= 0:
            slope = prior * (p.T @ (sp - 1)) / len(p) + slope_negative
        else:  # the estimate of a non-negative risk fell below zero: undo the overfit
            slope = -slope_negative
        slope += DECAY * w
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(w, shift, scale)


def _measured(docs: DataFrame) -> np.ndarray:
    """Measures of a bounded number of texts, in the order of their ids."""

    def work(batches):
        drop_worker_tables()
        for batch in batches:
            rows = [features(t).tobytes() for t in raw_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["doc_id", "row"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = sorted((r[0], bytes(r[1])) for r in docs.mapInArrow(work, f"doc_id {kind}, row binary").collect())
    return np.frombuffer(b"".join(r[1] for r in rows), np.float32).reshape(-1, WIDTH)


def sampled(df: DataFrame, bound: int) -> DataFrame:
    """About ``bound`` rows of ``df``, or all if there are fewer, by a hash of the id."""
    rows = df.count()
    if rows <= bound:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(1 << 30)) < int(bound / rows * (1 << 30)))


def learn(docs: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """Fit on training rows only: ids that are held out give neither label nor text.

    Rows without a label, id or text are no positives; of an id labelled twice, the lower label counts.
    """
    usable = ~hold_out("doc_id", FOLDS, HELD_OUT_FOLD) & F.col("doc_id").isNotNull()
    known = labels.filter(usable & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = known.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    prior = min(max(0.5 if share is None else share, 0.02), 0.98)
    texts = docs.select("doc_id", F.col(text).alias("text")).filter(usable & F.col("text").isNotNull())
    trusted = F.broadcast(sampled(known.filter("quality = 1").select("doc_id"), MAX_POSITIVES))
    positive = _measured(texts.join(trusted, "doc_id", "left_semi"))
    unlabelled = _measured(sampled(texts, MAX_UNLABELLED))
    return fit(positive, unlabelled, prior)


def scored(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a column ``into`` in [0, 1], replacing one of that name; null texts are scored as empty ones."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == into.lower()])

    def work(batches):
        drop_worker_tables()
        for batch in batches:
            at = batch.schema.names.index(text)
            rows = np.array([features(t) for t in raw_bytes(batch.column(at))]).reshape(-1, WIDTH)
            score = pa.array(model.score(rows), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, into])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(work, f"{schema}, `{into}` double")


def classify(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; see ``learn`` and ``scored`` for odd rows."""
    model = learn(docs, labels, text)
    rows = scored(docs.select("doc_id", text), model, text)
    return rows.select(
        "doc_id",
        hold_out("doc_id", FOLDS, HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
