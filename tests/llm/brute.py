"""Plain readings of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fold(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def is_held_out(doc_id, modulus, remainder) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == remainder


def shingles(text: str | None) -> set:
    w = words(fold(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_components(docs: list[tuple]) -> list[tuple]:
    sets = [shingles(text) for _, text in docs]
    parent = {d: d for d, _ in docs if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(docs):
        for j in range(i):
            b = docs[j][0]
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [(d, len(s), None if d is None else root(d)) for (d, _), s in zip(docs, sets)]


def without_repeats(docs: list[tuple], width: int = 13) -> list[tuple]:
    first: dict = {}
    for d, text in docs:
        w = words(text)
        for i in range(len(w) - width + 1):
            if d is not None:
                key = tuple(w[i : i + width])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if d is not None and first[tuple(w[i : i + width])] < d:
                gone[i : i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def rule_counts(text: str | None) -> tuple:
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def unigram(docs: list[tuple]) -> tuple[list[tuple], int]:
    counts: Counter = Counter()
    tokens = [[*words(fold(text)), ("end",)] for _, text in docs]
    for (d, _), t in zip(docs, tokens):
        if not is_held_out(d, 7, 2):
            counts.update(t)
    total, kinds = sum(counts.values()), len(counts)
    rows = [
        (len(t), sum(counts[x] > 0 for x in t), sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in t))
        for t in tokens
    ]
    return rows, total


def matching_scores(docs: list[tuple], order: int = 4) -> list[float]:
    """Prediction by partial matching, escape method D with exclusion, symbol by symbol."""
    seen: dict = defaultdict(Counter)
    lines = [[257] * order + list(fold(text).encode()) + [256] for _, text in docs]
    for (d, _), s in zip(docs, lines):
        if not is_held_out(d, 7, 2):
            for i in range(order, len(s)):
                for k in range(order + 1):
                    seen[tuple(s[i - k : i])][s[i]] += 1
    out = []
    for s in lines:
        score = 0.0
        for i in range(order, len(s)):
            left, ruled_out, p = 1.0, set(), None
            for k in range(order, -1, -1):
                found = {x: n for x, n in seen.get(tuple(s[i - k : i]), {}).items() if x not in ruled_out}
                if not found:
                    continue
                total = sum(found.values())
                if s[i] in found:
                    p = left * (2 * found[s[i]] - 1) / (2 * total)
                    break
                left *= len(found) / (2 * total)
                ruled_out |= set(found)
            score += math.log10(p if p is not None else left / (257 - len(ruled_out)))
        out.append(score)
    return out


def personal(text: str | None) -> list[tuple]:
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        doubled = [d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out
