import random

import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, Score double, shard int, Slot int, bucket string, component_id int, kept boolean"


def prose(draw, n, vocabulary=400):
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def odd_rows():
    """Nulls, empties, ties, repeats, copies, junk, personal data, one long text, clashing columns."""
    draw = random.Random(11)
    base = [prose(draw, draw.randint(20, 120)) for _ in range(30)]
    texts = list(base)
    for text in base[:10]:  # near copies, exact copies, passages
        w = text.split()
        w[draw.randrange(len(w))] = "changed"
        texts += [" ".join(w), text, text.upper(), f"{prose(draw, 30)} {' '.join(w[:15])} {prose(draw, 9)}"]
    texts += [None, None, "", "", "   \n\t", "one", "two words", "a b c d", "a b c d e", "spam " * 300, "ab " * 40]
    texts += ["% % $ # | " * 20, "line one\nline one\nline two\n\nline one", "É ü ñ 漢字 ́", "x" * 3000]
    texts += ["mail a.b@c.org and 10.0.0.1, +1 (212) 555-0100, 4111 1111 1111 1111", "joe [at] host (dot) com"]
    texts.append(prose(draw, 30_000, 3_000))
    rows = [(n, t, draw.choice(["en", None]), draw.choice(["s0", "s0", "s1", None])) for n, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[4], None, None), (None, None, None, None)]
    draw.shuffle(rows)
    return [(*r, None if r[1] is None else len(r[1]), 0.5, 9, None, "b", 7, False) for r in rows]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """Folder with the tables of odd rows."""
    folder = str(tmp_path_factory.mktemp("odd"))
    rows = odd_rows()
    spark.createDataFrame(rows, DOC).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], 1 if r[1] and "%" not in r[1] and "spam" not in r[1] else 0, 0) for r in rows if r[0] is not None]
    labels += [(None, 1, 0), (5, None, 0), (10_000, 1, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    held = [(0, rows[0][1]), (1, None), (2, ""), (3, next(r[1] for r in rows if r[0] == 8)), (3, "tie of items")]
    spark.createDataFrame(held, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    big = "é\r\n\r\nWARC/1.1 " + "y" * 1200
    pages = [(n, f"http://h/{n}\n", None if n % 9 == 4 else big + str(n % 3) * (n % 2) if n % 4 else "") for n in range(60)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return folder


@pytest.fixture(scope="session")
def nothing(spark, odd, tmp_path_factory):
    """The same tables without rows."""
    folder = str(tmp_path_factory.mktemp("nothing"))
    for name in ("documents", "labels", "benchmark", "pages"):
        spark.read.parquet(f"{odd}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="session")
def rows(spark, odd):
    """``(doc_id, text)`` of the odd rows."""
    return [tuple(r) for r in spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "text").collect()]
