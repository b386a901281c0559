"""From raw documents to packed sequences, in five stages, each by an operator of ``tracewarden.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; its result is
written as Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``docs``; the last returns the packed pieces.
"""

from __future__ import annotations

import os
import sys
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tracewarden.llm.common import bounded_batches, free_names, stage, table  # noqa: E402
from tracewarden.llm.decontamination import contaminated  # noqa: E402
from tracewarden.llm.near_dedup import near_duplicates  # noqa: E402
from tracewarden.llm.packing import digest, pack, word_tokenizer_path  # noqa: E402
from tracewarden.llm.personal_data import mask_personal_data  # noqa: E402
from tracewarden.llm.quality_classifier import CUT, learn, scored  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of these documents, does not reject.

    Without labels for positives nothing is rejected.
    """
    model = learn(docs, table(spark, sf_dir, "labels"))
    (score,) = free_names(docs, ("score",))
    return scored(docs, model, into=score).filter(F.col(score) >= CUT).drop(score)


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` but for those with an id in ``ids``; rows without an id stay. Tens of thousands of ids are broadcast."""
    gone = stage(ids.select("doc_id").distinct(), "gone")
    few = gone.count() <= 1_000_000
    left = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti")
    return left.select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of every group of near-duplicates.

    Of rows with one id, all or none stay.
    """
    found = near_duplicates(docs)
    return without(docs, found.filter(~F.col("kept")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return without(docs, contaminated(docs, table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; ``n_chars`` follows the text."""
    return mask_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens."""
    return digest(pack(docs, word_tokenizer_path()))




def _bounded(step):
    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return step(spark, docs, sf_dir)

    return run_step


STAGES = [
    ("quality_classifier", _bounded(quality)),
    ("near_dedup", _bounded(near_dedup)),
    ("decontamination", _bounded(decontaminate)),
    ("personal_data", _bounded(personal_data)),
    ("packing", _bounded(packing)),
]

# a learned model, a verified similarity join and a tokenizer are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
