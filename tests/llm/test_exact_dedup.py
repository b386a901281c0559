"""Exact duplicates against a plain reading and SQL, and the coding of fingerprints."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tracewarden.llm import exact_dedup
from tracewarden.llm.queries import ORACLE, QUERIES

DOC = "doc_id bigint, text string, lang string"


def plain(docs):
    fold = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = defaultdict(list)
    for d, t in docs:
        groups[fold(t)].append(d)
    out = []
    for d, t in docs:
        own = groups[fold(t)]
        keep = max((x for x in own if x is not None), default=None)
        out.append((d, keep, len(own), d == keep, hashlib.sha256(fold(t).encode()).hexdigest()))
    return out


def family(seed, n=3_000):
    """Groups of copies from none to a third of all rows, in both cases of letters; ids are not in row order."""
    draw = random.Random(seed)
    texts = [f"Text {k} É" for k in range(n // 3)]
    docs = [draw.choice(texts[:40]) if draw.random() < 0.3 else draw.choice(texts) for _ in range(n)]
    docs += ["Hot " * 30] * (n // 3) + ["HOT " * 30] * 50 + [None, "", None, "x" * 200_000, "X" * 200_000]
    ids = list(range(len(docs)))
    draw.shuffle(ids)
    return [*zip(ids, docs), (7, "twice"), (7, "twice"), (None, "twice"), (None, "nobody"), (None, "NOBODY")]


def test_odd_rows_match_sql_and_the_plain_reading(spark, odd, rows):
    found = [tuple(r) for r in QUERIES["op11_exact_dedup"](spark, odd).collect()]
    assert Counter(found) == Counter(plain(rows))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{odd}/documents.parquet/*.parquet')")
    assert Counter(found) == Counter(db.execute(ORACLE["op11_exact_dedup"]).fetchall())


@pytest.mark.parametrize("setting", [{}, {"LEAST_BITS": 4, "ALARM_BITS": -8}, {"SENDER_ROWS": 40, "OWNER_PRINTS": 50, "LEAST_SENT": 1}])
def test_groups_of_all_sizes(spark, monkeypatch, setting):
    """Also with fingerprints that nearly all collide, and with many senders and owners."""
    for name, value in setting.items():
        monkeypatch.setattr(exact_dedup, name, value)
    docs = family(5)
    table = spark.createDataFrame([(*d, "en") for d in docs], DOC).repartition(12)
    assert Counter(map(tuple, exact_dedup.exact_duplicates(table).collect())) == Counter(plain(docs))


def test_more_suspects_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_BROADCAST", 10)
    docs = family(6, 600)
    table = spark.createDataFrame([(*d, "en") for d in docs], DOC).repartition(5)
    assert Counter(map(tuple, exact_dedup.exact_duplicates(table).collect())) == Counter(plain(docs))


def test_rice_code_is_a_round_trip():
    draw = np.random.default_rng(1)
    for size, top in ((0, 1), (1, 1), (1, 1 << 61), (5, 5), (1_000, 1 << 40), (30_000, 1 << 16), (30_000, 1 << 62)):
        values = np.unique(draw.integers(0, top, size))
        blob = exact_dedup.rice_encode(values)
        assert exact_dedup.rice_decode(blob, len(values)).tolist() == values.tolist()
    dense = np.unique(draw.integers(0, 1 << 30, 100_000))
    assert len(exact_dedup.rice_encode(dense)) < 2 * len(dense)  # of 8 bytes each
