"""Disguised identifiers among prose: planted ones are found, sentences are left alone."""

import os
import random

import numpy as np
import pytest

from tracewarden.llm.personal_data import Tape, find_spans

TABLES = "/root/testdata/sf0.01"

PROSE = [
    "looking at this point in time",
    "he arrived at that point it was late",
    "she was at one point in the lead",
    "stopped at which point no one spoke",
    "look at the point at the end",
    "arrive chez un point de vente",
    "sind at dem punkt es gibt",
    "we met at noon point in fact",
    "version 3 point 2 point 1 point 0 is out",
    "release 10 dot 2 dot 1 dot 0",
    "grew 3 point 2 point 1 point 5 percent",
    "meet at example.com tomorrow",
    "a well-known at example.com",
    "see 2.0 at example.com",
]
DISGUISED = [
    ("j.doe99 at gmail.com", "email"),
    ("jane at mail dot de", "email"),
    ("jane_doe at host point com", "email"),
    ("max4 at the dot net", "email"),
    ("kim [at] site [dot] org", "email"),
    ("bob＠ｅxample．com", "email"),
    ("10 dot 20 dot 30 dot 40", "ip"),
    ("plus 49 30 1234567", "phone"),
    ("４１１１ 1111 1111 1111", "card"),
]


@pytest.mark.parametrize("text", PROSE)
def test_sentences_hold_no_address(text):
    assert find_spans(text)[1] == []


@pytest.mark.parametrize("text, kind", [*DISGUISED, ("3 dot 2 dot 1 dot 4", "ip")])
def test_disguises_are_found(text, kind):
    shown = f"the server {text} then" if kind == "ip" else f"so, {text} then"
    assert [(k, shown[a:b]) for k, a, b in find_spans(shown)[1]] == [(kind, text)]


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
def test_disguises_planted_in_prose(spark):
    draw = random.Random(3)
    rows = spark.read.parquet(f"{TABLES}/documents.parquet").select("text").collect()
    clean = [r[0] for r in rows if r[0] and not find_spans(r[0])[1]]
    assert len(clean) > 500 and all(find_spans(t)[0] == find_spans(t)[1] for t in (r[0] for r in rows))
    for n in range(1_000):
        words = draw.choice(clean).split(" ")
        at, (text, kind) = draw.randrange(len(words)), DISGUISED[n % len(DISGUISED)]
        before = " ".join(words[:at])
        start = len(before) + 2
        shown = f"{before}, {text} ; {' '.join(words[at:])}"
        assert (kind, start, start + len(text)) in find_spans(shown)[1], shown


def test_rewriting_keeps_the_source_of_every_character():
    draw = random.Random(1)
    for _ in range(2_000):
        text = "".join(draw.choice("abc") for _ in range(draw.randrange(1, 30)))
        tape, plain = Tape(text), [(c, n, n + 1) for n, c in enumerate(text)]
        for _ in range(3):
            edits, at = [], draw.randrange(3)
            while at < len(plain):
                end = min(len(plain), at + draw.randrange(1, 4))
                edits.append((at, end, draw.choice(["", "x", "yz", "uvw"])))
                at = end + draw.randrange(5)
            done, made = 0, []
            for a, b, new in edits:
                made += plain[done:a] + [(c, plain[a][1], plain[b - 1][2]) for c in new]
                done = b
            plain, tape = made + plain[done:], tape.rewrite(edits)
            assert list(zip(tape.text, tape.start.tolist(), tape.end.tolist())) == plain


def test_a_long_text_takes_little_memory_per_character():
    tape = Tape("a" * 1_000_000).rewrite([(5, 6, "bc")])
    assert tape.start.nbytes + tape.end.nbytes <= 8 * 1_000_001 and tape.start.dtype == np.int32
