"""Tokenizer alignment against a plain version."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from brookmart.llm import alignment
from brookmart.llm.pieces import model_path

SOME = ["", "  ", "a", " a  b ", "\u2581", "x\u2581y \u2581 z", "<s></s><unk><0x41><|endoftext|> hi", "\u65e5\u672c\u8a9e \u30c6\u30b9\u30c8\U0001f600\u00e9\u0301", "\x00a\x01", "\t\n x\r\n",
        " \u3000 ", None, "it's we'll   don't", "x \u2003 y\u200b z\u0085 \x1c q", "word " * 40 + "z" * 300]
LETTERS = " \u2581a\u00e9\u65e5\U0001f600\n\t.,'thein\u3000 Z\ufb01\u2460\u0085\u00ad\u200b\x1c12"


def plain(rows):
    a_model = Tokenizer.from_file(alignment.byte_path())
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=model_path())
    letters = alignment.byte_letters()
    out, counts, known = [], Counter(), {}
    for doc_id, text in rows:
        if text not in known:
            known[text] = [0, 0, 0, "", []]
            want = (" " + (text or "")).encode()
            a, b = (a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)) if text else ([], [])
            a_bytes = [bytes(letters[c] for c in a_model.id_to_token(x)) for x in a]
            b_bytes = [bytes([int(b_model.id_to_piece(x)[3:5], 16)]) if b_model.is_byte(x) else b_model.id_to_piece(x).replace("\u2581", " ").encode() for x in b]
            if text and b"".join(a_bytes) == want == b"".join(b_bytes):
                spans = lambda parts: list(zip(np.cumsum([0, *map(len, parts)]).tolist(), np.cumsum([*map(len, parts)]).tolist()))
                at_a, at_b = spans(a_bytes), spans(b_bytes)
                both = sorted({e for _, e in at_a} & {e for _, e in at_b})
                groups = []
                for low, high in zip([0, *both], both):
                    inside = lambda ids, at: ",".join(str(x) for x, (s, e) in zip(ids, at) if low <= s and e <= high)  # noqa: E731, B023
                    groups.append(inside(a, at_a) + "|" + inside(b, at_b))
                links = [(x, y) for x, (s, e) in zip(a, at_a) for y, (u, v) in zip(b, at_b) if max(s, u) < min(e, v)]
                known[text] = [len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links]
        counts.update(known[text][4])
        out.append((doc_id, text))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    result = Counter()
    for doc_id, text in out:
        n_a, n_b, n_groups, digest, links = known[text]
        result[(doc_id, n_a, n_b, n_groups, len(links), digest, sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links))] += 1
    return result, counts, best


@pytest.fixture(scope="module")
def rows(docs):
    rng = random.Random(1)
    real = [r.text for r in docs.where("n_chars < 1500").orderBy("doc_id").limit(40).collect()]
    texts = real + SOME + ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(40))) for _ in range(250)]
    return [*enumerate(texts), (5, texts[1]), *[(None, texts[0])] * 3, *[(10_000 + i, "a hot text") for i in range(150)]]


@pytest.mark.parametrize("small", [False, True])
def test_matches_plain_version(spark, rows, monkeypatch, small):
    if small:  # many runs, splits, frames, and a cache that starts anew
        monkeypatch.setattr(alignment, "RUN", 2000)
        monkeypatch.setattr(alignment, "SLICE_BYTES", 500)
        monkeypatch.setattr(alignment, "FRAME", 3)
    want, counts, best = plain(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got, pairs = alignment.aligned_counts(frame, parts=7, target=400 if small else alignment.TARGET)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert {(r.a, r.b): (r.total, r.best) for r in pairs.collect()} == {p: (n, n == best[p[1]]) for p, n in counts.items()}


def test_heap_merge():
    rng = np.random.default_rng(3)
    runs = []
    for size in (0, 1, 50, 400):
        keys = np.unique(rng.integers(0, 300, size))
        runs.append((keys, rng.integers(1, 9, len(keys))))
    want = Counter()
    for keys, sums in runs:
        for k, n in zip(keys.tolist(), sums.tolist()):
            want[k] += n
    for frame in (1, 7, 1000):
        parts = list(alignment.merged(runs, frame))
        keys = np.concatenate([k for k, _ in parts])
        assert (np.diff(keys) > 0).all()
        assert dict(zip(keys.tolist(), np.concatenate([n for _, n in parts]).tolist())) == want


def test_odd_rows(odd):
    got, pairs = alignment.aligned_counts(odd)
    rows = {}
    for r in got.collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, rows.values())) == odd.count() and len(rows[2]) == 2
    assert rows[3][0][1:] == rows[4][0][1:] == (0, 0, 0, 0, "", 0, 0)
    assert rows[10][0].n_links > 5000
    none, pairs = alignment.aligned_counts(odd.where("false"))
    assert none.count() == 0 and pairs.count() == 0
