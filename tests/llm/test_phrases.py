"""Phrase mining against a plain version."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import lower

from brookmart.llm import phrases


def plain(rows, least, best=2000):
    """(lang, text) rows to the result."""
    counts: dict[str, Counter] = {}
    sizes = Counter()
    for lang, text in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(words)
            for n in range(1, 5):
                own.update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            score, _, left, right = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in candidates.items())
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def got(frame, **options):
    return sorted(tuple(r) for r in phrases.collocations(frame, **options).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["the", "of", "a", "New", "york", "\u00dcber", "x\x00y", "caf\u00e9", *(f"w{i}" for i in range(30))]
    some = lambda n: " ".join(rng.choices(words, [12, 9, 7, *[2] * (len(words) - 3)], k=n))
    texts = [rng.choice(["{} new york city, {}", "{}\t of the  {}", "{}; {}\nin the end it is {}", "{}"]).format(some(9), some(7), some(3)) for _ in range(300)]
    hot = [f"one hot pair {rng.choice(words)} {rng.choice(words)}" for _ in range(200)] + ["the very same passage stands here, in full"] * 150
    return [(rng.choice(["en", "de", None, "und"]), t) for t in texts + hot] + [("en", None), ("en", ""), (None, " \t\n.,;"), ("one\nline", "a b. a b"), ("en", "long " * 3000)]


@pytest.mark.parametrize("small", [False, True])
def test_matches_plain_version(spark, rows, monkeypatch, small):
    options = {}
    if small:  # many batches and buckets, crowded ones too
        monkeypatch.setattr(phrases, "BATCH", 3000)
        options = {"target": 60}
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    for least in (3, 30):
        assert got(frame, least=least, **options) == plain(rows, least)
    assert got(frame, least=3, best=5) == plain(rows, 3, 5)


def test_infrequent_words_end_suffixes(spark, rows):
    """The slots keep suffixes of infrequent words away, and nothing else."""
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    counts = phrases.word_counts(frame)
    total = lambda bits: phrases.suffix_blocks(frame, 4, bits).selectExpr("sum(n)").first()[0] or 0
    everything = np.full(1 << phrases.SLOT_BITS - 3, 255, np.uint8)
    assert 0 < total(phrases.frequent_slots(counts, 40)) < total(phrases.frequent_slots(counts, 1)) == total(everything)


def test_multikey_quicksort():
    rng = np.random.default_rng(2)
    table, many = rng.integers(0, 6, (3000, 4)), rng.integers(1, 4, 3000)
    for least in (1, 20, 500):
        want = Counter()
        for row, n in zip(table.tolist(), many.tolist()):
            for d in range(4):
                if d and 0 in row[1:d + 1]:
                    break
                want[tuple(row[:d + 1])] += n
        want = {p: n for p, n in want.items() if n >= least}
        found = {tuple(table[i, :d + 1].tolist()): n for d, i, n in phrases.multikey_quicksort([table[:, d] for d in range(4)], many, least)}
        assert found == want


def test_scores_pass_64_bits(spark):
    """A count whose product with the scale passes 64 bits."""
    big = 10**13
    assert spark.sql(f"select cast({phrases.SCALE} as decimal(38,0)) * cast({big}L as decimal(19,0)) div (cast({big}L as decimal(19,0)) + cast({big}L as decimal(19,0))) x").first()[0] == 1_000_000


def test_odd_rows(odd):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert got(odd, least=2) == plain(rows, 2)
    assert phrases.collocations(odd.where("false")).count() == 0
