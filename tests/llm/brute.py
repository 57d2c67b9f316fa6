"""Slow and plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

LAST = 2**63 - 1
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def order(doc_id):
    return LAST if doc_id is None else doc_id


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def kept_lines(rows: list[tuple], least: int = 10) -> list[list[bool]]:
    """(doc_id, text) rows to a flag per line."""
    first: dict[str, int] = {}
    split = [(order(d), (t or "").split("\n")) for d, t in rows]
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    for d, lines in split:
        for k in map(key, lines):
            if len(k) >= least:
                first[k] = min(first.get(k, d), d)
    return [[first.get(key(line), d) >= d for line in lines] for d, lines in split]


def removed_bytes(rows: list[tuple], length: int = 50) -> list[tuple]:
    """(doc_id, text) rows to (n_bytes, n_removed, n_spans, sha256)."""
    least: dict[bytes, int] = {}
    data = [(order(d), (t or "").encode()) for d, t in rows]
    for d, b in data:
        for i in range(len(b) - length + 1):
            least[b[i:i + length]] = min(least.get(b[i:i + length], d), d)
    out = []
    for d, b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if least[b[i:i + length]] < d:
                gone[i:i + length] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def fingerprint(text: str | None) -> int:
    words = WORDS.findall(lower(text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(shingles))


def components(rows: list[tuple]) -> list[int]:
    """(doc_id, fingerprint) rows to the least id of each component."""
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 3:
                parent[top(i)] = top(j)
    least = defaultdict(lambda: LAST)
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least[top(i)], order(d))
    return [least[top(i)] for i in range(len(rows))]


def word_statistics(text: str | None) -> tuple:
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    again = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again))


def mix_targets(sizes: dict, weights=(1, 2, 3), repeats: int = 3) -> dict:
    """Source to size; null last. Shares what is above a cap again until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped: set = set()
    while True:
        rest = sum(sizes.values()) - sum(repeats * sizes[s] for s in capped)
        whole = sum(weight[s] for s in names if s not in capped)
        got = {s: repeats * sizes[s] if s in capped else rest * weight[s] / whole for s in names}
        above = {s for s in names if got[s] > repeats * sizes[s] + 1e-9}
        if not above:
            return got
        capped |= above
