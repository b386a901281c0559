"""The pipeline's stages against the operators they call, on odd rows and empty tables."""

import importlib.util
import os

import pytest

_path = os.path.join(os.path.dirname(__file__), os.pardir, os.pardir, "corpus_pipeline.py")
_spec = importlib.util.spec_from_file_location("corpus_pipeline", _path)
pipeline = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(pipeline)


@pytest.mark.parametrize("which", ["odd", "nothing"])
def test_stages(spark, request, tmp_path, which):
    folder = request.getfixturevalue(which)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.dtypes
    seen = {}
    for name, step in pipeline.STAGES:
        step(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (docs, after)
        if name != "packing":
            assert after.dtypes == columns
            assert after.count() <= docs.count()
        docs = after
    if which == "odd":
        before, after = seen["near_dedup"]
        kept = {r[0] for r in pipeline.near_duplicates(before).filter("kept").select("doc_id").collect()}
        assert {r[0] for r in after.select("doc_id").collect()} == kept
        before, after = seen["personal_data"]
        assert before.count() == after.count()
        assert after.filter("text like '%@c.org%'").count() == 0
        assert after.filter("n_chars <> length(text)").count() == 0
        before, after = seen["packing"]
        assert after.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()


def test_tasks_of_other_stages_drop_the_tokenizer(spark, odd, monkeypatch):
    """A worker process keeps packing's table of words for later tasks of packing only."""
    from tracewarden.llm import common, decontamination, near_dedup, packing, personal_data, quality_classifier

    docs = spark.read.parquet(f"{odd}/documents.parquet")
    works, kind = [], type(docs)
    original = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, work, *a, **b: works.append(work) or original(self, work, *a, **b))
    model = quality_classifier.learn(docs, spark.read.parquet(f"{odd}/labels.parquet"))
    quality_classifier.scored(docs, model)
    near_dedup.sketches(docs, "text")
    decontamination.word_weights(docs.select("text"))
    personal_data.mask_personal_data(docs)
    personal_data.detect_personal_data(docs)
    assert len(works) == 7
    for work in works:
        packing.kept_tokenizer(packing.word_tokenizer_path())
        assert common.worker_tables()
        list(work(iter(())))
        assert not common.worker_tables()


def test_decontamination_needs_one_kind_of_worker(spark, odd, monkeypatch):
    """Lists of rows go through workers of another kind, which executors then keep beside the usual ones."""

    def refused(*args, **kinds):
        raise AssertionError("rows of a list are sent through Python workers")

    docs, benchmark = (spark.read.parquet(f"{odd}/{name}.parquet") for name in ("documents", "benchmark"))
    want = pipeline.contaminated(docs, benchmark).count()
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refused)
    assert pipeline.contaminated(docs, benchmark).count() == want > 0
    assert pipeline.contaminated(docs, benchmark.limit(0)).count() == 0


def test_words_and_their_parts_over_small_generations(monkeypatch):
    """Marks and words without them are met as words, too, before and after, over small generations."""
    from tokenizers import Tokenizer

    from tracewarden.llm import packing

    monkeypatch.setattr(packing, "GENERATION", 5)
    path = packing.word_tokenizer_path()
    ours, theirs = packing.WordTokenizer(path), Tokenizer.from_file(path)
    for text in ("one, one ,", ", two.. .. two", "one two, three! ! ?! three?!", "É, é %$ a% it's it's,", "four five, six; two one,"):
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert ours.encode(text.encode()) == b"".join(i.to_bytes(4, "little") for i in ids)
