"""Collocations against a plain reading and SQL, and the sorting of suffixes."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tracewarden.llm import collocations
from tracewarden.llm.queries import ORACLE, QUERIES


def plain(docs, least=10, top=2_000):
    """All n-grams counted in dictionaries, scores in Python's integers."""
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = lang or "und"
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", folded):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    kept = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inside = Counter()
    for p, a in kept.items():
        for q in ((p[0], *p[1:3]), (p[0], *p[2:4])) if len(p) == 4 else ():
            inside[q] = max(inside[q], a)
    rows: dict = {}
    for p, a in kept.items():
        if 100 * inside[p] >= 50 * a and len(p) == 3:
            continue
        cuts = [(f[p[: k + 1]], f[(p[0], *p[k + 1 :])]) for k in range(1, len(p) - 1)]
        score, _, left, right = min((1_000_000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
        rows.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return [
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, found in rows.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    ]


def small_language(seed, size=400):
    """Few words, repeated runs, all separators, both cases, several languages and one text in very many pieces."""
    draw = random.Random(seed)
    words = ["x", "y", "z", "The", "é", "漢", "B-c", "#"]
    docs = []
    for _ in range(size):
        own = [draw.choice(words[: draw.choice([1, 2, 8])]) + draw.choice(["", "", "", ",", ";\r", "?!"]) for _ in range(draw.randrange(30))]
        docs.append((draw.choice([" ", "\t", "  ", "\n"]).join(own), draw.choice(["en", "en", "de", None])))
    return docs + [(" ".join(draw.choice(words) for _ in range(20_000)), "en"), ("x" * 5_000, "de"), (None, "en"), ("", None), (" . ", "it")]


def test_odd_rows_match_sql_and_the_plain_reading(spark, odd):
    found = [tuple(r) for r in QUERIES["op12_collocations"](spark, odd).collect()]
    table = spark.read.parquet(f"{odd}/documents.parquet")
    assert Counter(found) == Counter(plain([tuple(r) for r in table.select("text", "lang").collect()]))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{odd}/documents.parquet/*.parquet')")
    assert found and Counter(found) == Counter(db.execute(ORACLE["op12_collocations"]).fetchall())


@pytest.mark.parametrize(
    "setting",
    [{}, {"HOT": 20, "OWNER_ROWS": 200}, {"SLICE": 64, "GROUP_BYTES": 500, "OWNER_ROWS": 50, "HOT": 4}, {"BITS": 64, "COMMON": 3}, {"COMMON": 0}],
    ids=["whole", "hot pairs", "slices", "full bitmap", "no common words"],
)
def test_small_languages(spark, monkeypatch, setting):
    for name, value in setting.items():
        monkeypatch.setattr(collocations, name, value)
    docs = small_language(3)
    table = spark.createDataFrame(docs, "text string, lang string").repartition(5)
    for least, top in ((10, 2_000), (2, 25)):
        found = [tuple(r) for r in collocations.collocations(table, least=least, top=top).collect()]
        assert Counter(found) == Counter(plain(docs, least, top))


def test_sorting_counts_prefixes_and_abandons_rare_ones():
    draw = np.random.default_rng(2)
    for n, kinds in ((0, 3), (1, 3), (400, 2), (3_000, 9), (3_000, 4_000)):
        rows = draw.integers(1, kinds + 1, (n, 3)).astype(np.int32)
        rows[draw.random(n) < 0.2, 2] = 0
        times = draw.integers(1, 4, n)
        wanted: Counter = Counter()
        for row, m in zip(rows.tolist(), times.tolist()):
            wanted[(*row[:2], 0)] += m
            if row[2]:
                wanted[tuple(row)] += m
        found, counts = collocations.frequent_prefixes(rows, times, 5)
        assert dict(zip(map(tuple, found.tolist()), counts.tolist())) == {p: m for p, m in wanted.items() if m >= 5}


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(a, left, right) for a in (10, 3 * 10**6, 10**12 - 1) for left in (a, 10**12) for right in (a, a + 7, 10**12)]
    table = spark.createDataFrame(rows, "a bigint, l bigint, r bigint")
    found = table.selectExpr("a", "l", "r", f"{collocations.score('a', 'l', 'r')} AS score").collect()
    assert all(r["score"] == 10**6 * r["a"] ** 2 // (r["l"] * r["r"]) for r in found)
