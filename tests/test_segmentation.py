"""Cutting runs by a lattice of words, against plain versions."""

from __future__ import annotations

from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brookmart.operators import segmentation
from brookmart.operators.segmentation import SCALE, Lattice, learned_words, segmenter, slices, trained

LETTERS = st.text("abc\u4e2d\u6587", min_size=1, max_size=12)


def plain_smart(words, run):
    total = sum(words.values())
    cost = lambda n: round(SCALE * (np.log(total) - np.log(n)))

    @cache
    def best(i):
        if i == len(run):
            return 0, ()
        ways = [(cost(words[run[i:j]]) + best(j)[0], i - j) for j in range(i + 1, len(run) + 1) if run[i:j] in words]
        if run[i] not in words:
            ways.append((cost(0.5) + best(i + 1)[0], -1))
        lowest, size = min(ways)
        return lowest, (run[i:i - size], *best(i - size)[1])

    return list(best(0)[1])


def plain_fine(words, run):
    found = [(i, i - j) for i in range(len(run)) for j in range(i + 1, len(run) + 1) if run[i:j] in words]
    covered = {k for i, size in found for k in range(i, i - size)}
    return [run[i:i - size] for i, size in sorted(found + [(i, -1) for i in range(len(run)) if i not in covered])]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(LETTERS, st.integers(1, 1000), min_size=1, max_size=30), st.lists(LETTERS, min_size=1, max_size=6))
def test_as_the_plain_versions(words, runs):
    lattice = Lattice(words)
    assert lattice.smart(runs) == [plain_smart(words, r) for r in runs]
    assert lattice.fine(runs) == [plain_fine(words, r) for r in runs]


def test_modes_and_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(segmentation, "SLICE", 8)
    lattice = Lattice({"\u4e2d\u56fd": 50, "\u4e2d\u56fd\u4eba": 40, "\u4eba": 30, "\u56fd\u4eba": 5, "tea": 20, "pot": 10, "teapot": 4})
    df = spark.createDataFrame([(1, "\u4e2d\u56fd\u4eba, TeaPot7"), (2, None), (3, ""), (4, " .,"), (5, "xtea")], "id long, text string")
    smart, fine = ({r.id: r.w for r in df.select("id", segmenter(lattice, m)("text").alias("w")).collect()} for m in (True, False))
    assert smart == {1: ["\u4e2d\u56fd\u4eba", "teapot", "7"], 2: None, 3: [], 4: [], 5: ["x", "tea"]}
    assert fine[1] == ["\u4e2d\u56fd\u4eba", "\u4e2d\u56fd", "\u56fd\u4eba", "\u4eba", "teapot", "tea", "pot", "7"]
    assert fine[5] == ["x", "tea"]
    assert Lattice({}).smart(["ab"]) == [["a", "b"]] == Lattice({}).fine(["ab"])


def test_very_long_run():
    run = "teapot" * 50_000
    assert Lattice({"tea": 9, "pot": 9, "teapot": 1}).smart([run, "tea"])[1] == ["tea"]
    assert [len(p) for p in slices(["ab" * 60_000, "c" * 90_000, "d" * 500_000, "e"])] == [1, 1, 1, 1]


def test_long_run_is_cut_in_stretches(monkeypatch):
    """The steps of the path search follow the longest stretch that words overlap in, not the longest run."""
    lattice, calls = Lattice({"tea": 9, "pot": 9, "teapot": 1}), []
    search = np.searchsorted
    monkeypatch.setattr(segmentation.np, "searchsorted", lambda *a, **k: calls.append(1) or search(*a, **k))
    assert set(lattice.smart(["teapot" * 5_000])[0]) <= {"tea", "pot", "teapot"}
    assert len(calls) <= 6


def test_runs_are_counted(spark):
    texts = spark.createDataFrame([("Tea7tea, pot",), ("TEA.tea",), (None,), ("",)], "text string")
    assert {(r.run, r.times) for r in segmentation.counted_runs(texts, "text").collect()} == {("tea", 4), ("7", 1), ("pot", 1)}


def test_words_are_learned(spark):
    texts = spark.createDataFrame([("Tea tea pot",), ("pot tea " + "x" * 17,), (None,)], "text string")
    assert [(r.word, r.freq) for r in learned_words(texts, "text").collect()] == [("tea", 3), ("pot", 2)]
    assert [(r.word, r.freq) for r in learned_words(texts, "text", most=1).collect()] == [("tea", 3)]
    cut = segmenter(trained(texts, "text"))
    assert texts.limit(1).select(cut(F.lit("teapottea")).alias("w")).first().w == ["tea", "pot", "tea"]
    with pytest.raises(ValueError):
        Lattice({"a": 1, "b": 1}, most=1)
