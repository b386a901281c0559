"""The registered queries on odd rows and empty tables, against plain readings of their contracts."""

import gzip
import hashlib
import importlib.util
import os
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tracewarden.llm import decontamination, near_dedup, packing, personal_data, substring_dedup, warc, words
from tracewarden.llm.components import components
from tracewarden.llm.decontamination import common_subsequence, contaminated
from tracewarden.llm.quality_rules import apply_rules
from tracewarden.llm.queries import ORACLE, QUERIES
from tracewarden.llm.warc import assemble, parse_records

_spec = importlib.util.spec_from_file_location("llm_brute", os.path.join(os.path.dirname(__file__), "brute.py"))
brute = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(brute)

TABLES = "/root/testdata/sf0.001"
on_tables = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")


def result(spark, name, folder):
    return QUERIES[name](spark, folder).collect()


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables_give_empty_results(spark, nothing, name):
    assert result(spark, name, nothing) == []


def test_shards(spark, odd, rows):
    found = result(spark, "op2_sharding", odd)
    facts = [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(facts)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(s, [])) for s in range(40)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1


def test_archives(spark, odd):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{odd}/pages.parquet/*.parquet')")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    theirs = db.execute(f"SELECT {', '.join(names)} FROM ({ORACLE['op3_warc']})").fetchall()
    ours = [tuple(r[c] for c in names) for r in result(spark, "op3_warc", odd)]
    assert sorted(map(str, ours)) == sorted(map(str, theirs))
    assert {r[3] for r in ours} == {"response", "revisit"}


def test_archives_keep_repeated_rows(spark, tmp_path):
    """Equal rows, null ids, null beside empty, one id with two urls, and payloads that only rows without id hold."""
    big, own = "y" * 1200, "z" * 1500
    pages = [(1, "a", "x"), (1, "a", "x"), (2, "b", big), (2, "b", big), (2, "c", big), (1, "b", big), (1, "b", big)]
    pages += [(None, "u", None), (None, "u", ""), (None, None, ""), (None, "", ""), (None, "b", big)]
    pages += [(None, "p", own), (None, "q", own), (None, "q", own)]
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(3)
    table.write.parquet(f"{tmp_path}/pages.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    theirs = db.execute(f"SELECT {', '.join(names)} FROM ({ORACLE['op3_warc']})").fetchall()
    ours = [tuple(r[c] for c in names) for r in result(spark, "op3_warc", str(tmp_path))]
    assert len(ours) == len(pages) and sorted(map(str, ours)) == sorted(map(str, theirs))


def test_assembly_follows_pointers_both_ways(spark):
    schema = "record_id string, warc_type string, concurrent_to array<string>, payload binary"
    records = [("r1", "response", [], b"x"), ("q1", "request", ["r1"], b""), ("m1", "metadata", ["r1"], b"")]
    records += [("r2", "response", ["q2"], b"y"), ("q2", "request", [], b""), ("q9", "request", [], b""), records[1]]
    for some in (records, records[:3]):
        found = {r["capture_id"]: r for r in assemble(spark.createDataFrame(some, schema)).collect()}
        assert [x["record_id"] for x in found["r1"]["requests"]] == ["q1"]
        assert [x["record_id"] for x in found["r1"]["metadata"]] == ["m1"]
    found = {r["capture_id"]: r for r in assemble(spark.createDataFrame(records, schema)).collect()}
    assert [x["record_id"] for x in found["r2"]["requests"]] == ["q2"]
    assert found["q9"]["response"] is None and set(found) == {"r1", "r2", "q9"}


def test_broken_archive_is_an_error():
    good = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    assert [r["payload"] for r in parse_records(good * 2)] == [b"ab", b"ab"]
    for bad in (good[:-5], b"junk" + good):
        with pytest.raises(ValueError):
            list(parse_records(bad))


def test_archives_are_unpacked_record_by_record():
    """Members and pieces end anywhere in a record; what is held stays near one record."""
    draw = random.Random(3)
    bodies = [b"", b"x", bytes(3_000_000), *[draw.randbytes(draw.randrange(200_000)) for _ in range(40)]]
    record = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    plain = b"".join(record % (len(b), b) for b in bodies)
    cuts = sorted(draw.randrange(len(plain)) for _ in range(30))
    members = b"".join(gzip.compress(plain[a:b]) for a, b in zip([0, *cuts], [*cuts, len(plain)]))
    for archive in (plain, gzip.compress(plain), members):
        assert [r["payload"] for r in parse_records(archive)] == bodies
        with pytest.raises(ValueError):
            list(parse_records(archive[: len(archive) * 2 // 3]))
    rest = warc._Bytes(gzip.compress(record % (10, b"a" * 10) * 1_000_000))
    assert rest.fill(100) and len(rest.held) < 80 << 20


def test_classifier_on_odd_rows(spark, odd, rows):
    found = result(spark, "op4_quality_classifier", odd)
    assert Counter(r["doc_id"] for r in found) == Counter(d for d, _ in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    assert all(r["held_out"] == brute.is_held_out(r["doc_id"], 5, 0) for r in found)


@on_tables
def test_classifier_is_accurate_on_held_out_rows(spark):
    folder = TABLES.replace("0.001", "0.01")
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in result(spark, "op4_quality_classifier", folder) if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.95


def test_language_model(spark, odd, rows):
    found = sorted(result(spark, "op5_language_model", odd), key=lambda r: (str(r["doc_id"]), r["n_tokens"], r["score"]))
    base, total = brute.unigram(rows)
    scores = brute.matching_scores(rows)
    wanted = sorted(
        ((d, *b, s) for (d, _), b, s in zip(rows, base, scores)), key=lambda r: (str(r[0]), r[1], r[4])
    )
    assert len(found) == len(wanted)
    for r, (d, n, known, score, matching) in zip(found, wanted):
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (d, n, known, total)
        assert r["base_score"] == pytest.approx(score) and r["score"] == pytest.approx(matching)
        assert r["held_out"] == brute.is_held_out(d, 7, 2)


def test_packing_is_an_exact_round_trip(spark, odd, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.word_tokenizer_path())
    docs = spark.read.parquet(f"{odd}/documents.parquet").filter("doc_id <> 3")
    found = packing.pack(docs, packing.word_tokenizer_path()).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    texts = {d: t for d, t in rows if d not in (3, None)}
    assert set(pieces) == set(texts)
    for d, text in texts.items():
        own = sorted(pieces[d], key=lambda r: r["start"])
        ids = np.frombuffer(b"".join(bytes(r["ids"]) for r in own), "<u4").tolist()
        assert ids == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert {r["doc_tokens"] for r in own} == {len(ids)} and own[0]["start"] == 0
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in own])
        assert [r["offset"] for r in own] == [0, *ends[:-1]] and ends[-1] <= packing.CAPACITY
    assert Counter(r["doc_id"] for r in result(spark, "op6_packing", odd))[3] >= 3


def test_word_lookup_equals_the_tokenizer():
    from tokenizers import Tokenizer

    ours, theirs = packing.WordTokenizer(packing.word_tokenizer_path()), Tokenizer.from_file(packing.word_tokenizer_path())
    draw = random.Random(2)
    signs = [*"abXY 's'll.,!?|%<>\x01́éÉßﬁ１ \t\n\x0b 1​　", "<|endoftext|>", "<|STARTOFTEXT|>", "İ", "Σ"]
    for _ in range(3_000):
        text = "".join(draw.choice(signs) for _ in range(draw.randrange(25)))
        ids = np.frombuffer(ours.encode(text.encode()), "<u4").tolist()
        assert ids == theirs.encode(text, add_special_tokens=False).ids, text


def test_words_of_latin_letters_are_learned_without_normalizing(monkeypatch):
    """Most new words are plain letters; they skip the normalizer and patterns, which cost as much as the rest."""
    from tokenizers import Tokenizer

    ours, theirs = packing.WordTokenizer(packing.word_tokenizer_path()), Tokenizer.from_file(packing.word_tokenizer_path())
    draw = random.Random(5)
    letters = [chr(i) for i in (*range(65, 91), *range(97, 123), *range(0xC0, 0x100)) if i not in (0xD7, 0xF7)]
    words = [*letters, *("".join(draw.choices(letters, k=draw.randrange(1, 30))) for _ in range(5_000))]
    texts = [" ".join(words[n::7]) for n in range(7)]
    wanted = [theirs.encode(text, add_special_tokens=False).ids for text in texts]
    slow = []
    original = ours._encode
    monkeypatch.setattr(ours, "_encode", lambda some: slow.extend(some) or original(some))
    found = ours.encode_all([text.encode() for text in texts])
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == wanted
    assert not slow


def test_groups_of_texts_equal_the_tokenizer():
    """Texts of one group share their words: empty and blank ones, marks after any letter, signs that look like letters."""
    from tokenizers import Tokenizer

    ours, theirs = packing.WordTokenizer(packing.word_tokenizer_path()), Tokenizer.from_file(packing.word_tokenizer_path())
    assert ours.encode_all([]) == [] and ours.encode_all([b"", b" \n"]) == [b"", b""]
    draw = random.Random(6)
    signs = [*"aZéÉßÿ×÷µªİſжЖως가中", *"1٣²½", "e\u0301", "\u0338", "\xa0", "\x85", "\u2028", "\x1c", "\x00", "<|", "|>", "'s", *".,;!|%$#&*", *"  \n"]
    texts = ["", " \n", *("".join(draw.choices(signs, k=draw.randrange(40))) for _ in range(3_000))]
    for at in range(0, len(texts), 50):
        some = texts[at : at + 50]
        found = ours.encode_all([text.encode() for text in some])
        for text, ids in zip(some, found):
            assert np.frombuffer(ids, "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids, text


def test_near_duplicates(spark, odd, rows):
    found = result(spark, "op7_near_dedup", odd)
    wanted = brute.near_components(rows)
    assert Counter(tuple(r)[:3] for r in found) == Counter(wanted)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in found)


@pytest.mark.parametrize("small_bucket", [0, 4_096])
def test_near_duplicates_of_one_large_family(spark, monkeypatch, small_bucket):
    """Many variants of one text, linked with some and not with others; also without the in-task comparison."""
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", small_bucket)
    draw = random.Random(4)
    base = [f"w{k}" for k in range(80)]
    docs = []
    for n in range(70):
        own = list(base)
        for _ in range(draw.randrange(4)):
            own[draw.randrange(80)] = f"x{draw.randrange(30)}"
        docs.append((n, " ".join(own)))
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = near_dedup.near_duplicates(table).collect()
    assert sorted(tuple(r)[:3] for r in found) == sorted(brute.near_components(docs))


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(0)
    for size in (4, 40, 1_000):
        errors = []
        for _ in range(40):
            one = draw.integers(0, 2**63, size, dtype=np.uint64)
            two = np.concatenate([one[size // 4 :], draw.integers(0, 2**63, size // 4, dtype=np.uint64)])
            true = (size - size // 4) / (size + size // 4)
            errors.append((near_dedup.signature(one) == near_dedup.signature(two)).mean() - true)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components_of_chains_and_stars(spark):
    draw = random.Random(1)
    edges = [(n, n + 1) for n in range(200)] + [(1_000, n) for n in range(1_001, 1_100)] + [(7, 7)]
    draw.shuffle(edges)
    found = dict(map(tuple, components(spark.createDataFrame(edges, "u bigint, v bigint").repartition(6)).collect()))
    assert found == {n: 0 for n in range(1, 201)} | {n: 1_000 for n in range(1_001, 1_100)}


def test_repeats_are_removed(spark, odd, rows):
    assert Counter(map(tuple, result(spark, "op8_substring_dedup", odd))) == Counter(brute.without_repeats(rows))


@pytest.mark.parametrize("alphabet", ["a", "ab", "abc", "abcdefgh"])
def test_repeats_in_small_alphabets(spark, tmp_path, alphabet):
    """Runs and periodic texts are where symbols of a window depend on what is outside."""
    draw = random.Random(alphabet)
    docs = []
    for n in range(60):
        own = [draw.choice(alphabet) for _ in range(draw.randrange(50))]
        if docs and draw.random() < 0.6:
            other = draw.choice(docs)[1].split()
            at, size = draw.randrange(len(other) + 1), draw.choice([12, 13, 14, 20])
            own[5:5] = other[at : at + size]
        docs.append((n, " ".join(own)))
    spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = result(spark, "op8_substring_dedup", str(tmp_path))
    assert sorted(map(tuple, found)) == sorted(brute.without_repeats(docs))


@pytest.mark.parametrize("alphabet", [3, 40, 5_000])
def test_long_repeats_settled_by_symbols(spark, tmp_path, alphabet):
    """Repeats of 26 to 600 words, cut, joined and nested, so that settled symbols and windows at their ends mix."""
    draw = random.Random(alphabet)
    word = lambda n: [f"w{draw.randrange(alphabet)}" for _ in range(n)]
    passages = [word(draw.choice([26, 60, 200, 600])) for _ in range(8)]
    docs = []
    for n in range(60):
        own = word(draw.randrange(40))
        for _ in range(draw.randrange(4)):
            p = draw.choice(passages)
            a = draw.choice([0, 0, draw.randrange(len(p))])
            own += p[a : a + draw.choice([15, 100, 600])] + word(draw.choice([0, 0, 1, 30]))
        docs.append((draw.randrange(10**6) if n % 10 else n, " ".join(own)))
    spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = result(spark, "op8_substring_dedup", str(tmp_path))
    assert sorted(map(tuple, found)) == sorted(brute.without_repeats(docs))


def test_a_repeat_of_500_words_is_settled_by_long_symbols(spark):
    draw = random.Random(10)
    word = lambda n: [f"w{draw.randrange(10_000)}" for _ in range(n)]
    repeat = word(500)
    docs = [(n, " ".join(word(draw.randrange(100, 300)) + repeat + word(200))) for n in range(3)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    names = {(r["doc_id"], r["name"]) for r in substring_dedup.shared_names(frame).filter("settled").collect()}
    for doc_id, text in docs:
        hashes, offsets = words.word_hashes([text.encode()])
        symbols = substring_dedup.Symbols(hashes, offsets)
        settled = np.array([n for d, n in names if d == doc_id], np.int64).view(np.uint64)
        starts, ends = symbols.inside(0, settled)
        if doc_id == 0:
            assert not len(starts)
            continue
        covered = {w for a, b in zip(starts, ends) for w in range(a, b)}
        assert len(covered) >= 400 and (ends - starts).max() >= 60 and (ends - starts).min() > substring_dedup.WIDTH


def test_chosen_symbols_are_the_same_wherever_a_window_stands():
    draw = random.Random(9)
    window = [draw.choice("abcd") for _ in range(substring_dedup.WIDTH)]
    keys = set()
    for _ in range(50):
        before, after = ([draw.choice("abcd") for _ in range(draw.randrange(6))] for _ in range(2))
        hashes, offsets = words.word_hashes([" ".join(before + window + after).encode()])
        keys.add(int(substring_dedup.chosen_keys(hashes, offsets)[0][len(before)]))
    assert len(keys) == 1


def test_rules(spark, odd, rows):
    found = result(spark, "op9_quality_rules", odd)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r["doc_id"], *(r[c] for c in names)) for r in found) == Counter((d, *brute.rule_counts(t)) for d, t in rows)
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_each_group_sets_its_own_limits(spark):
    """The same listing is usual in one group and refused in the other; nothing but the sketches tells them apart."""
    draw = random.Random(12)
    words = lambda n: [f"{draw.choice('abcdefg')}{draw.randrange(100, 999)}" for _ in range(n)]
    docs = [(n, " ".join(words(60)), "en", "prose") for n in range(4_000)]
    docs += [(4_000 + n, " ".join([*words(55), *["#" * draw.randint(10, 30)]]), "en", "code") for n in range(400)]
    some = " ".join([*words(57), "#" * 11])  # symbols: less than 0.05 of the characters
    loud = " ".join([*words(50), *["ABCDE"] * 6])
    long = " ".join(f"{w}{w}" for w in words(60))  # words of 8 characters, prose of this group has 4
    docs += [(5_000 + n, t, "en", g) for n, (t, g) in enumerate([(some, "prose"), (some, "code"), (loud, "prose"), (long, "prose")])]
    table = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in apply_rules(table).collect()}
    assert [kept[5_000 + n] for n in range(4)] == [False, True, False, False]
    assert sum(not k for d, k in kept.items() if d < 5_000) <= 20


def test_personal_data(spark, odd, rows):
    found = result(spark, "op10_personal_data", odd)

    def base(text):
        spans = brute.personal(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        return (*(sum(s[0] == k for s in spans) for k in personal_data.KINDS), hashlib.sha256(joined.encode()).hexdigest())

    assert Counter(tuple(r)[:6] for r in found) == Counter((d, *base(t)) for d, t in rows)
    text = dict(rows)
    for r in found:
        mine = [f"{k}:{a}:{b}" for k, a, b in brute.personal(text[r["doc_id"]])] if r["doc_id"] is not None else []
        assert set(mine) <= set(r["spans"].split(","))


def test_personal_data_detectors_on_random_texts():
    draw = random.Random(3)
    for _ in range(20_000):
        text = "".join(draw.choice("ab1.%@@..-+ ()0912345678é_") for _ in range(draw.randrange(40)))
        assert personal_data.detect(text) == brute.personal(text), text


@pytest.mark.parametrize(
    "text, hidden",
    [
        ("write john.doe [at] mail (dot) example (dot) com now", "john.doe [at] mail (dot) example (dot) com"),
        ("jane at example dot com, ok", "jane at example dot com"),
        ("bob＠ｅxample．com", "bob＠ｅxample．com"),
        ("jоhn@example.com", "jоhn@example.com"),
        ("call plus four nine three zero one two three four five six seven", "plus four nine three zero one two three four five six seven"),
        ("one nine two dot one six eight dot zero zero one dot one two three", "one nine two dot one six eight dot zero zero one dot one two three"),
        ("card ４１１１ 1111 1111 1111", "４１１１ 1111 1111 1111"),
        ("look at the dot matrix", None),
        ("one two three, and at dot com", None),
    ],
)
def test_disguises_map_back_to_the_source(text, hidden):
    base, every = personal_data.find_spans(text)
    added = [text[a:b] for _, a, b in every if (_, a, b) not in base]
    assert added == ([hidden] if hidden else [])
    assert set(base) <= set(every)


@pytest.mark.parametrize(
    "text, hidden",
    [
        ("call plus 49 30 1234567", "plus 49 30 1234567"),
        ("host ๑๙๒.๑๖๘.๐.๑ is up", "๑๙๒.๑๖๘.๐.๑"),
        ("card ৪১১১ ১১১১ ১১১১ ১১১১", "৪১১১ ১১১১ ১১১১ ১১১১"),
        ("card 𝟒𝟏𝟏𝟏 𝟏𝟏𝟏𝟏 𝟏𝟏𝟏𝟏 𝟏𝟏𝟏𝟏", "𝟒𝟏𝟏𝟏 𝟏𝟏𝟏𝟏 𝟏𝟏𝟏𝟏 𝟏𝟏𝟏𝟏"),
        ("write jane at example dot museum today", "jane at example dot museum"),
        ("write jane at mail.example dot cloud today", "jane at mail.example dot cloud"),
        ("write jane.doe at the dot agency today", "jane.doe at the dot agency"),
        ("jane at mail dot example.com", "jane at mail dot example.com"),
        ("plu\u017f 49 30 1234567", "plu\u017f 49 30 1234567"),
        ("meet at example.com or at the point where it ends", None),
        ("robbed at knife point and then left", None),
    ],
)
def test_every_disguise_opens_the_gate(text, hidden):
    """Each text alone, without a trigger of another transducer."""
    base, every = personal_data.find_spans(text)
    assert [text[a:b] for _, a, b in every if (_, a, b) not in base] == ([hidden] if hidden else [])


def test_the_gate_lets_every_changed_character_pass():
    changed = [c for c in map(chr, range(128, 0x110000)) if personal_data.character(c) != c]
    assert len(changed) > 600 and all(personal_data.may_hide(f"x{c}y") for c in changed)


def test_decontamination_finds_passages_and_paraphrases(spark, odd, rows):
    found = {(r["doc_id"], r["item_id"]) for r in result(spark, "op1_decontamination", odd)}
    whole = next(t for d, t in rows if d == 8)
    holders = {d for d, t in rows if t and whole in t}
    assert holders <= {d for d, item in found if item == 3}
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    items = [[word() for _ in range(30)] for _ in range(40)]
    docs, planted = [], set()
    for n in range(120):
        own = [word() for _ in range(draw.randrange(60, 300))]
        if n % 3 == 0:
            k = draw.randrange(40)
            part = [w if draw.random() > 0.15 else word() for w in items[k]]  # a paraphrase
            own[20:20] = part
            planted.add((n, k))
        docs.append((n, " ".join(own).title() + "."))
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id bigint, text string")
    hits = contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), benchmark)
    got = {(r["doc_id"], r["item_id"]) for r in hits.collect()}
    assert len(got & planted) >= 0.9 * len(planted) and got <= planted


def test_no_word_of_a_large_benchmark_is_left_out(spark, monkeypatch):
    """More distinct words than a block may hold, and an item with more by itself."""
    draw = random.Random(8)
    items = [[f"t{k}x{n}" for n in range(30)] for k in range(3)] + [[f"long{n}" for n in range(140)]]
    held = {n: draw.randrange(4) for n in range(12)}
    texts = {n: " ".join([*(f"w{draw.randrange(500)}" for _ in range(50)), *items[k], "end"]) for n, k in held.items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id bigint, text string")
    monkeypatch.setattr(decontamination, "MAX_TERMS", 80)
    found = contaminated(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == sorted(held.items())
    assert all(r["lcs"] == r["item_words"] for r in found)


def test_common_subsequence():
    draw = random.Random(8)
    for _ in range(300):
        a, b = ([draw.randrange(5) for _ in range(draw.randrange(1, 20))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        masks = {x: sum(1 << n for n, y in enumerate(a) if y == x) for x in a}
        assert common_subsequence(masks, len(a), b) == table[-1][-1]


@pytest.mark.parametrize("slice_bytes", [16, 1 << 18])
def test_word_hashes_do_not_depend_on_slices(monkeypatch, slice_bytes):
    monkeypatch.setattr(words, "SLICE", slice_bytes)
    draw = random.Random(0)
    texts = ["".join(draw.choice("aB é\n\t x") for _ in range(draw.randrange(60))).encode() for _ in range(200)]
    hashes, offsets = words.word_hashes(texts, lower=True)
    named: dict = {}
    for text, a, b in zip(texts, offsets[:-1], offsets[1:]):
        own = text.lower().split()
        assert len(own) == b - a
        assert all(named.setdefault(w, h) == h for w, h in zip(own, hashes[a:b].tolist()))
    assert len(set(named.values())) == len(named)


def test_warc_bodies_are_digested_where_they_are_read(spark, tmp_path):
    """Captures are assembled without their payloads, and the facts are those of the payloads read."""
    import hashlib

    html = ["<p>ä" * 500, "<p>ä" * 500, "", None, "x"]
    pages = spark.createDataFrame([(n, f"http://a/{n}", h) for n, h in enumerate(html)], "page_id bigint, url string, html string")
    warc.write_archives(pages, str(tmp_path / "archives"))
    records = warc.payload_facts(warc.read_records(spark, str(tmp_path / "archives"))).collect()
    main = [r for r in records if r["warc_type"] in warc.MAIN]
    assert len(main) == 5 and all(r["payload"] is None for r in main)
    assert all(r["payload"] for r in records if r["warc_type"] == "metadata")
    wanted = sorted(hashlib.sha1(x.encode()).hexdigest() for x in (html[0], "", "", "x"))
    assert sorted(r["payload_sha1"] for r in main if r["warc_type"] == "response") == wanted
    assert max(r["payload_bytes"] for r in main) == len(html[0].encode())
