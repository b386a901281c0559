"""Alignment of two tokenizers against a plain reading with whole texts and dictionaries."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tracewarden.llm import token_alignment
from tracewarden.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.001"


class Plain:
    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        _, full, model = token_alignment.tokenizer_paths()
        self.a, self.b = Tokenizer.from_file(full), sentencepiece.SentencePieceProcessor(model_file=model)
        self.a.encode_special_tokens = True
        # printable stand-ins of bytes in the entries of A
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [n for n in range(256) if n not in shown]
        self.byte = {chr(n): n for n in shown} | {chr(256 + k): n for k, n in enumerate(other)}

    def tokens(self, text):
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        return a, b

    def document(self, text):
        """Groups of ids, or none."""
        if not text:
            return []
        a, b = self.tokens(text)
        whole = b" " + text.encode()
        if any(b"".join(t for _, t in side) != whole for side in (a, b)):
            return []
        groups, at, i, j = [], 0, 0, 0
        while at < len(whole):
            own = ([a[i][0]], [b[j][0]])
            x, y = at + len(a[i][1]), at + len(b[j][1])
            i, j = i + 1, j + 1
            while x != y:
                if x < y:
                    own[0].append(a[i][0])
                    x, i = x + len(a[i][1]), i + 1
                else:
                    own[1].append(b[j][0])
                    y, j = y + len(b[j][1]), j + 1
            groups.append(own)
            at = x
        return groups


def plain(docs):
    reader = Plain()
    every = [(d, reader.document(t)) for d, t in docs]
    links = [Counter((x, y) for one, two in groups for x in one for y in two) for _, groups in every]
    count, best = Counter(p for own in links for p in own), defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (d, groups), own in zip(every, links):
        shown = ";".join(",".join(map(str, one)) + "|" + ",".join(map(str, two)) for one, two in groups)
        out.append(
            (
                d,
                sum(len(g[0]) for g in groups),
                sum(len(g[1]) for g in groups),
                len(groups),
                sum(own.values()),
                sum(n for p, n in own.items() if count[p] == best[p[0]]),
                sum(n * count[p] for p, n in own.items()),
                hashlib.sha256(shown.encode()).hexdigest() if groups else "",
            )
        )
    return out


def odd_texts():
    texts = ["a", " ", "  ", "\n", "a  b\n\n c\t　d ▁x", "café naïve 漢字漢 \U0001f600\U0001f600 ﬁ", "<|endoftext|> <s> </s> <unk> <0x41>"]
    texts += ["don't we'll I'M", "x" * 3_000, "漢" * 700, "\r\n();\r });\r", "1234567 8 90", "\x00\x01 a\x00b", "a  b   c"]
    return texts + ["The same words in the same order. " * 40, " " * 3_000 + "a" + "\n" * 2_000, "é" * 50, "﻿x ​ y"]


def test_odd_rows(spark, odd, rows):
    found = Counter(tuple(r) for r in QUERIES["op13_token_alignment"](spark, odd).collect())
    assert found == Counter(plain(rows))


@pytest.mark.parametrize(
    "setting", [{}, {"RUN_RECORDS": 150, "FAN": 3, "BLOCK": 5, "GROUP_CHARS": 200}, {"SLICE": 64, "SMALL_GROUP": 1, "PARTS": 4}], ids=["whole", "runs", "slices"]
)
def test_texts(spark, monkeypatch, setting):
    for name, value in setting.items():
        monkeypatch.setattr(token_alignment, name, value)
    draw = random.Random(7)
    texts = odd_texts() + [None, ""]
    words = [w for t in texts if t for w in t.split(" ")[:30]]
    texts += ["".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\n", ". "]) for _ in range(draw.randrange(60))) for _ in range(60)]
    docs = list(enumerate(texts)) + [(3, texts[20]), (None, texts[20]), (None, texts[14])]
    table = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, n_a string").repartition(4)
    found = token_alignment.align_tokens(table, token_alignment.tokenizer_paths()).collect()
    assert Counter(map(tuple, found)) == Counter(plain(docs))


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
def test_whole_small_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op13_token_alignment"](spark, TABLES).collect()
    assert Counter(map(tuple, found)) == Counter(plain(docs))


def test_both_forms_of_the_first_tokenizer_agree():
    """The fast form is used for nearly all texts; every character beside letters, digits and blanks."""
    encoders, full = token_alignment.Encoders(token_alignment.tokenizer_paths()), Plain().a
    draw = random.Random(1)
    chars = [chr(c) for c in [*range(0x3000), *range(0xA000, 0xD7FF, 7), *range(0xE000, 0x20000, 5)]]
    draw.shuffle(chars)
    for at in range(0, len(chars), 12):
        text = "".join(f"{c}{draw.choice(['', ' ', 'a', '1', '  ', chr(10)])}" for c in chars[at : at + 12])
        assert encoders.ids_a(text).tolist() == full.encode(text, add_special_tokens=False).ids, text


def test_merging_lists():
    draw = np.random.default_rng(3)
    lists, wanted = [], Counter()
    for _ in range(9):
        codes = np.unique(draw.integers(0, 30_000, draw.integers(1, 9_000)))
        held = draw.integers(1, 50, len(codes))
        wanted.update(dict(zip(codes.tolist(), held.tolist())))
        lists.append(token_alignment._pack(token_alignment._steps(codes), held))
    blocks = list(token_alignment.merge(lists))
    codes, sums = (np.concatenate(x) for x in zip(*blocks))
    assert len(blocks) > 2 and (np.diff(codes) > 0).all() and dict(zip(codes.tolist(), sums.tolist())) == wanted
