"""Recall of paraphrases against brute-force longest common subsequences over all documents and items."""

import random

import numpy as np
import pytest

from tracewarden.llm import decontamination
from tracewarden.llm.decontamination import ANSWER, ITEM_WORDS, LEAST, SURE, contaminated, item_passages

EDITS = (0, 15, 25, 35, 45)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def accepted(item, near):
    """What the operator promises to report of a stretch of words: half of the item in order with its answer, or three quarters."""
    common, answer = lcs(item, near), item[-max(3, len(item) // 4) :]
    return common >= SURE * len(item) or (common >= LEAST * len(item) and lcs(answer, near) >= ANSWER * len(answer))


def planted_documents(size, items=40):
    """Items in edited copies, half of all words common; per share of edits the pairs of document and item, and all true pairs."""
    draw = random.Random(size)
    common = ["".join(draw.choice("abcdefghij") for _ in range(4)) for _ in range(300)]
    word = lambda: draw.choice(common) if draw.random() < 0.5 else "".join(draw.choice("klmnopqrst") for _ in range(7))
    texts = [[word() for _ in range(size)] for _ in range(items)]
    docs, planted = [], {e: set() for e in EDITS}
    for edits in EDITS:
        for k, item in enumerate(texts):
            answer = len(item) - max(3, len(item) // 4)
            copy = [w if n >= answer or draw.random() >= edits / 100 else word() for n, w in enumerate(item)]
            own = [word() for _ in range(draw.randrange(100, 300))]
            at = draw.randrange(len(own))
            own[at:at] = copy
            if accepted(item, copy):
                planted[edits].add((len(docs), k))
            docs.append(own)
    docs += [[word() for _ in range(200)] for _ in range(60)]
    truth = set().union(*planted.values())
    for d, own in enumerate(docs):  # matches by chance, within stretches half as long again as the item
        reach = size + size // 2 + 2
        places = {w: n for n, w in enumerate(own)}
        for k, item in enumerate(texts):
            if (d, k) not in truth and sum(w in places for w in item) >= LEAST * size:
                if any(accepted(item, own[a : a + reach]) for a in range(0, len(own), max(1, size // 6))):
                    truth.add((d, k))
    rows = [(n, " ".join(own).capitalize() + ".") for n, own in enumerate(docs)]
    return rows, [(k, " ".join(t)) for k, t in enumerate(texts)], planted, truth


@pytest.mark.parametrize("size", [6, 30, 60])
def test_recall_at_all_shares_of_edits(spark, size):
    docs, items, planted, truth = planted_documents(size)
    found = contaminated(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4), spark.createDataFrame(items, "item_id bigint, text string")
    )
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    for edits, pairs in planted.items():
        assert len(got & pairs) >= 0.9 * len(pairs), edits
    assert got <= truth


def test_no_end_of_an_item_is_left_out():
    for size in (1, 5, 72, 73, 75, 150, 400):
        passages = item_passages([(0, " ".join(f"w{n}" for n in range(size)), None)])
        assert sum(map(len, passages.words)) == size and max(map(len, passages.words)) <= ITEM_WORDS


@pytest.mark.parametrize("kind", ["tinyint", "decimal(9,0)", "string"])
def test_items_are_named_by_any_type(spark, kind):
    text = "one sentence of a benchmark that a document holds as it is"
    items = spark.createDataFrame([(text,)], "text string").selectExpr(f"CAST(7 AS {kind}) AS item_id", "text")
    docs = spark.createDataFrame([(1, f"before {text} after"), (2, "something else")], "doc_id int, text string")
    assert [(r["doc_id"], str(r["item_id"])) for r in contaminated(docs, items).collect()] == [(1, "7")]


def test_space_comes_from_all_item_passages(spark, monkeypatch):
    """As many passages as dimensions: each lies in the space whole, whatever the documents hold."""
    monkeypatch.setattr(decontamination, "RANK", 12)
    draw = random.Random(1)
    shared = [f"s{n}" for n in range(20)]
    items = [(k, " ".join(f"w{k}x{n}" if draw.random() < 0.6 else draw.choice(shared) for n in range(40)), None) for k in range(12)]
    passages = item_passages(items)
    docs = spark.createDataFrame([(" ".join(draw.choice(shared) for _ in range(60)),) for _ in range(200)], "text string")
    every = decontamination.word_weights(docs)
    index = decontamination.build_index(spark, passages, every)
    for words in passages.words:
        ids, values = decontamination._rows(decontamination._places(index.terms, np.array(words, np.uint64)), index.weights)
        assert np.linalg.norm(values @ index.space[ids]) >= 0.999 * np.linalg.norm(values)
