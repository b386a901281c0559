"""Personal data in texts, also where it is disguised.

Plain detectors find e-mail addresses, IP addresses, card and phone numbers. A chain of small
transducers then rewrites the text: homoglyphs and width variants become ASCII, zero-width
characters go, spelled digits become digits, and "at"/"dot" disguises become "@" and ".". Every
rewritten character keeps the start and end of the source characters it stands for, so spans
that the same detectors find in the rewritten text map back to the source exactly.

Scale: a per-row pass in Arrow batches; nothing is shuffled. Texts without any trigger of the
transducers skip them. All scans are linear in the text, so very long texts cost no more per
character.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewarden.llm.common import drop_worker_tables, table

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never starts inside a run of digits: what follows the run decides for all of its suffixes
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        else:
            done = at + 1  # a later local part cannot hold this sign
        at = text.find("@", max(done, at + 1))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    doubled = (int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits)))
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


DETECTORS: dict[str, Callable] = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def detect(text: str) -> list[Span]:
    """All spans of a text, by kind, then start."""
    return [(kind, *span) for kind in KINDS for span in DETECTORS[kind](text)]


# ---- transducers -------------------------------------------------------------------------

# letters of other scripts that look like a Latin one
LOOKALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТУХаеѕіјорсухԁһӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧον",
        "ABESIJKMHOPCTYXaesijopcyxdhlABEZHIKMNOPTYXov",
    )
)
# what ignoring case takes for a Latin letter, though its lower case is another character
LOOKALIKES |= {"\u017f": "s", "\u212a": "K", "\u0130": "I", "\u0131": "i"}
MARKS = {"‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "․": ".", "。": ".", "｡": ".", "·": ".", "•": "."}
HIDDEN = "­​‌‍⁠﻿"
BLANK_VARIANTS = "    　"

DIGIT_WORDS = {
    word: str(n)
    for language in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for n, word in enumerate(language.split())
}
DIGIT = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
LETTER = r"[^\W\d_]"
# three or more spelled digits in a row; fewer are ordinary prose
SPELLED = re.compile(rf"(?<!{LETTER}){DIGIT}(?:[\s-]{{1,3}}{DIGIT}){{2,}}(?!{LETTER})", re.IGNORECASE)
SPELLED_WORD = re.compile(DIGIT, re.IGNORECASE)
AT, DOT = "(?:at|arroba|chez)", "(?:dot|punkt|point|punto)"
BRACKETED_AT = re.compile(rf"\s*[\[({{<]\s*(?:{AT}|@)\s*[\])}}>]\s*", re.IGNORECASE)
BRACKETED_DOT = re.compile(rf"\s*[\[({{<]\s*(?:{DOT}|\.)\s*[\])}}>]\s*", re.IGNORECASE)
# a bare "at" needs a domain with a dot, spelled or real; ``is_address`` tells addresses from prose
BARE = re.compile(
    rf"(?<=[A-Za-z0-9_%+-])(?P<at>\s+{AT}\s+)(?P<domain>[A-Za-z0-9-]+(?:(?:\.|\s+{DOT}\s+)[A-Za-z0-9-]+)+)", re.IGNORECASE
)
LABELS = re.compile(rf"\.|\s+{DOT}\s+", re.IGNORECASE)
SPELLED_LABEL = re.compile(rf"\s+({DOT})\s+([A-Za-z0-9-]+)", re.IGNORECASE)
# usual endings, and those of them that are also words of a sentence
ENDINGS = frozenset(
    "com org net edu gov mil int info biz io co ai app dev me tv eu uk de fr es it nl be ch at pl pt se no dk fi ie"
    " ru cn jp in br mx ar ca au us example test".split()
)
WORD_ENDINGS = frozenset("in it no at es de be me us se ch co ai is as or an on so do am to my by".split())
# "look at the dot matrix", "at some point we": words around a bare "at" and a spelled dot that make it prose
PROSE = frozenset(
    "a an the this that these those some any each every no one what which his her its our their your my such other"
    " where when while we he she they you and or but of is was were are has had did do does to for from with by if as"
    " than then there so le la les un une des ce cette el los las una der die das ein eine".split()
)
BARE_DOT = re.compile(rf"(?<=[A-Za-z0-9])\s+{DOT}\s+(?=[A-Za-z0-9])", re.IGNORECASE)
NUMBER_DOT = re.compile(rf"(?<=[0-9])\s+{DOT}\s+(?=[0-9])", re.IGNORECASE)
FOUR_PARTS = re.compile(rf"(?<![0-9.])[0-9]+(?:(?:\.|\s+{DOT}\s+)[0-9]+){{3}}(?!\.?[0-9])", re.IGNORECASE)
# what stands before four numbers: these make them a version or a section, those an address
VERSION = re.compile(r"(?:version|release|build|chapter|section|kapitel|abschnitt|chapitre|capítulo|sección|v|rev)\W*$", re.IGNORECASE)
ADDRESS = re.compile(r"(?:\bip(?:v4)?|address|adresse|dirección|host|server|serveur|servidor|ping|gateway)(?:\s+(?:is|ist|est|es|at))?\W*$", re.IGNORECASE)
PLUS = re.compile(r"(?<!\w)plus[\s-]+(?=[0-9])", re.IGNORECASE)

# what a text must hold for a transducer to change anything: a pattern for each; the last four want lower case
ODD = re.compile("[" + "".join([*LOOKALIKES, *MARKS, HIDDEN, BLANK_VARIANTS]) + r"！-～]|(?![0-9])\d")  # any decimal digit
BRACKETED = re.compile(rf"[\[({{<]\s*(?:{AT}|{DOT}|@|\.)\s*[\])}}>]")
SPELLED_DOT = re.compile(rf"{DOT}\s")
BARE_AT = re.compile(rf"[a-z0-9_%+-]\s+{AT}\s+[a-z0-9-]+\.[a-z0-9]")
SPELLED_RUN = re.compile(rf"{DIGIT}[\s-]{{1,3}}{DIGIT}[\s-]{{1,3}}{DIGIT}")
SPELLED_PLUS = re.compile(r"plus[\s-]+[0-9]")


def may_hide(text: str) -> bool:
    if not text.isascii() and ODD.search(text):
        return True
    low = text.lower()
    return any(p.search(low) for p in (BRACKETED, SPELLED_DOT, BARE_AT, SPELLED_RUN, SPELLED_PLUS))


class Tape:
    """A rewritten text; every character knows the source characters it stands for, in eight bytes."""

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None):
        self.text = text
        kind = np.int32 if len(text) < 1 << 31 else np.int64
        self.start = np.arange(len(text), dtype=kind) if start is None else start
        self.end = np.arange(1, len(text) + 1, dtype=kind) if end is None else end

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Tape:
        """Replace ``[a, b)`` by a text; a replacement stands for the whole replaced part."""
        if not edits:
            return self
        text, at = [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            at = b
        text.append(self.text[at:])
        low, high = (np.array(x) for x in list(zip(*edits))[:2])
        edge = np.zeros(len(self.text) + 1, np.int64)
        np.add.at(edge, low, 1)
        np.add.at(edge, high, -1)
        # kept characters are taken over once, the first of an edit as often as the replacement is long
        times = (np.cumsum(edge[:-1]) == 0).astype(np.int64)
        times[low] = [len(new) for _, _, new in edits]
        ends = self.end.copy()
        ends[low] = self.end[high - 1]
        return Tape("".join(text), np.repeat(self.start, times), np.repeat(ends, times))

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a]), int(self.end[b - 1])


def character(c: str) -> str:
    """What one character stands for."""
    if c.isascii():
        return c
    if c in HIDDEN:
        return ""
    if c in BLANK_VARIANTS:
        return " "
    if c in LOOKALIKES or c in MARKS:
        return LOOKALIKES.get(c) or MARKS[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    return chr(ord(c) - 0xFEE0) if "！" <= c <= "～" else c


def characters(tape: Tape) -> Tape:
    return tape.rewrite([(n, n + 1, new) for n, c in enumerate(tape.text) if (new := character(c)) != c])


def spelled_digits(tape: Tape) -> Tape:
    """Every word of a run becomes a digit; blanks within the run go."""
    edits = []
    for run in SPELLED.finditer(tape.text):
        at = run.start()
        for word in SPELLED_WORD.finditer(tape.text, run.start(), run.end()):
            if word.start() > at:
                edits.append((at, word.start(), ""))
            edits.append((*word.span(), DIGIT_WORDS[word.group().lower()]))
            at = word.end()
    return tape.rewrite(edits)


def is_address(text: str, m: re.Match) -> bool:
    """Whether a match of ``BARE`` is an address rather than prose.

    A local part that no word has, with a letter and a digit, underscore or inner dot, needs a last label of two or more
    letters, and so do others. They need a spelled dot, too, and no label that is a word of prose. An ending
    that is a word itself counts only after "dot": "point", "punkt" and "punto" stand in sentences.
    """
    labels = LABELS.split(m["domain"].lower())
    if len(labels[-1]) < 2 or not labels[-1].isalpha():
        return False
    start = m.start()
    while start > 0 and text[start - 1] in LOCAL:
        start -= 1
    local = text[start : m.start()].strip(".-")
    spelled = [(sign.lower(), x.lower()) for sign, x in SPELLED_LABEL.findall(m["domain"])]
    if any(c.isalpha() for c in local) and any(c in "0123456789_%+." for c in local):
        return bool(spelled) or labels[-1] in ENDINGS
    if not spelled or local.lower() in PROSE or PROSE.intersection(labels[:-1]):
        return False
    if labels[-1] in WORD_ENDINGS:
        return all(sign == "dot" for sign, _ in spelled)
    return labels[-1] not in PROSE


def is_numbered_host(text: str, m: re.Match) -> bool:
    """Whether four numbers with spelled dots are an address: not after a word such as "version", and not four digits alone without a cue."""
    before = text[max(0, m.start() - 40) : m.start()]
    if VERSION.search(before):
        return False
    return bool(ADDRESS.search(before)) or any(len(n) > 1 for n in re.findall("[0-9]+", m.group()))


def signs(tape: Tape) -> Tape:
    """Disguised "@", ".", and "+"."""
    edits = []
    m = BARE.search(tape.text)
    while m:
        if is_address(tape.text, m):
            edits.append((*m.span("at"), "@"))
            edits += [(*d.span(), ".") for d in BARE_DOT.finditer(tape.text, m.end("at"), m.end())]
        m = BARE.search(tape.text, m.end() if edits and edits[-1][1] > m.start() else m.end("at"))
    tape = tape.rewrite(edits)
    tape = tape.rewrite([(*m.span(), "@") for m in BRACKETED_AT.finditer(tape.text)])
    tape = tape.rewrite([(*m.span(), ".") for m in BRACKETED_DOT.finditer(tape.text)])
    # spelled dots after a sign that is there by now: "name@host dot org"
    edits = []
    for m in re.finditer(rf"@[A-Za-z0-9-]+(?:(?:\.|\s+{DOT}\s+)[A-Za-z0-9-]+)+", tape.text, re.IGNORECASE):
        edits += [(*d.span(), ".") for d in BARE_DOT.finditer(tape.text, m.start(), m.end())]
    tape = tape.rewrite(edits)
    edits = []
    for m in FOUR_PARTS.finditer(tape.text):
        if is_numbered_host(tape.text, m):
            edits += [(*d.span(), ".") for d in NUMBER_DOT.finditer(tape.text, m.start(), m.end())]
    tape = tape.rewrite(edits)
    return tape.rewrite([(*m.span(), "+") for m in PLUS.finditer(tape.text)])


TRANSDUCERS = (characters, spelled_digits, signs)


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Spans that only the rewritten text shows; those within a base span of their kind add nothing."""
    if not may_hide(text):
        return []
    tape = Tape(text)
    for transducer in TRANSDUCERS:
        tape = transducer(tape)
    if tape.text == text:
        return []
    held = {kind: [s[1:] for s in base if s[0] == kind] for kind in KINDS}
    added, at = [], dict.fromkeys(KINDS, 0)
    for kind, a, b in detect(tape.text):
        start, end = tape.source(a, b)
        own, k = held[kind], at[kind]
        while k < len(own) and own[k][1] < end:
            k += 1
        at[kind] = k
        if not (k < len(own) and own[k][0] <= start):
            added.append((kind, start, end))
    return added


def find_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: by kind, then start; code points, end exclusive. A null text has none."""
    base = detect(text or "")
    more = disguised(text or "", base)
    order = {kind: n for n, kind in enumerate(KINDS)}
    return base, sorted({*base, *more}, key=lambda s: (order[s[0]], s[1], s[2])) if more else base


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    merged: list[list] = []
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    out, at = [], 0
    for kind, start, end in merged:
        out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join([*out, text[at:]]) if merged else text


def detect_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` with counts of base spans, the digest of base spans and all spans, a row per input row.

    Null texts count as empty and have no spans; repeated rows and null ids stay as they are; other
    columns of ``docs`` are not read; an empty table gives an empty one.
    """

    def work(batches):
        drop_worker_tables()
        for batch in batches:
            rows = [find_spans(t) for t in batch.column(1).to_pylist()]
            counts = [[sum(s[0] == kind for s in base) for base, _ in rows] for kind in KINDS]
            hashes = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows]
            columns = [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(hashes, pa.string())]
            columns.append(pa.array([joined(every) for _, every in rows], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'n_{k} bigint' for k in KINDS)}, base_sha256 string, spans string"
    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(work, schema)


def mask_personal_data(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with personal data masked; ``length``, where there is such a column, follows the text.

    A null text stays null, and so does its length.
    """

    def work(batches):
        drop_worker_tables()
        for batch in batches:
            at = batch.schema.names.index(text)
            old = batch.column(at).to_pylist()
            new = [None if t is None else mask(t, find_spans(t)[1]) for t in old]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    masked = docs.mapInArrow(work, docs.schema)
    if length in docs.columns:
        changed = F.when(F.col(text).isNotNull(), F.length(text).cast(docs.schema[length].dataType))
        masked = masked.withColumn(length, F.coalesce(changed, F.col(length)))
    return masked


def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return detect_personal_data(table(spark, folder, "documents"))
