"""Line dedup, suffix arrays and SimHash against plain versions."""

from __future__ import annotations

import hashlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from brookmart.llm import line_dedup, simhash, substrings


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_lines(odd, pairs, bag):
    rows = pairs(odd)
    want = Counter()
    for (d, t), flags in zip(rows, brute.kept_lines(rows)):
        kept = [x for x, keep in zip((t or "").split("\n"), flags) if keep]
        want[(d, len(flags), flags.count(False), sha("\n".join(kept)))] += 1
    got = line_dedup.dedup_lines(odd).select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256))
    assert bag(got) == want


def test_lines_with_few_salts(docs, pairs, bag):
    rows = pairs(docs)
    want = Counter((d, len(f), f.count(False)) for (d, _), f in zip(rows, brute.kept_lines(rows)))
    assert bag(line_dedup.dedup_lines(docs, spread=2).select("row.doc_id", "n_lines", "n_dropped")) == want


def test_hot_line_is_spread(spark):
    """A line of half the rows is decided in parts: few of its rows meet in one group."""
    hot = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "the very same line").otherwise(
        F.concat(F.lit("line number "), F.col("id"))).alias("text"))
    out = line_dedup.dedup_lines(hot)
    assert out.where("n_dropped > 0").count() == 1999 and out.where("row.doc_id = 0 and n_dropped = 0").count() == 1
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h1" in text and "salt" in text.split("rangepartitioning(")[1].split("\n")[0]
    assert "Python" not in text and "Arrow" not in text


def test_rows_without_id_are_spread(spark):
    """A hot line in a third of rows without an id: no (hash, salt) group has more than twice the mean of the salts."""
    rows = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("the very same line\nown line "), F.col("id")).alias("text"))
    hashes = line_dedup.line_hashes(rows).withColumn("salt", F.pmod(F.xxhash64("doc", "text_hash"), F.lit(line_dedup.SPREAD)))
    hot = hashes.groupBy("h1", "h2", "salt").count().where("count > 20")
    assert hot.agg(F.max("count")).first()[0] < 2 * 6000 / line_dedup.SPREAD
    assert line_dedup.dedup_lines(rows).agg(F.sum("n_dropped")).first()[0] == 5999


def test_filtered_documents(odd):
    left = line_dedup.without_repeated_lines(odd)
    assert left.columns == odd.columns
    assert {r.doc_id for r in left.collect()} >= {1, 2, 3, 4, 5, 8}


@pytest.mark.parametrize("small", [False, True])
def test_strings(odd, docs, pairs, bag, monkeypatch, small):
    if small:  # many batches, levels and ranges
        monkeypatch.setattr(substrings, "SLICE", 3_000)
        monkeypatch.setattr(substrings, "BATCH", 10_000)
        monkeypatch.setattr(substrings, "RANGE", 20_000)
        monkeypatch.setattr(substrings, "SETTLED", 50)
    for frame in (odd, docs.where("doc_id < 120")):
        rows = pairs(frame)
        want = Counter((d, *r) for (d, _), r in zip(rows, brute.removed_bytes(rows)))
        assert bag(substrings.repeated_strings(frame).drop("spans")) == want


def test_rows_without_id_are_told_apart(spark, pairs, bag):
    """Many texts without an id: whatever part of a hash they share, each loses what an earlier document has."""
    passage = "a passage of eighty-four bytes that stands in a text before and in all of those without"
    rows = [(1, passage)] + [(None, f"{i} head {passage} {i * 7919}") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = Counter((d, *r) for (d, _), r in zip(pairs(frame), brute.removed_bytes(pairs(frame))))
    assert bag(substrings.repeated_strings(frame).drop("spans")) == want
    assert all(r.n_removed == len(passage) for r in substrings.repeated_strings(frame).where("doc_id is null").collect())


@pytest.mark.parametrize("slice_bytes", [1 << 20, 700])
def test_runs_and_short_periods(spark, pairs, bag, monkeypatch, slice_bytes):
    """Texts of one byte, of short periods and long ones in pieces; their suffixes stay few."""
    monkeypatch.setattr(substrings, "SLICE", slice_bytes)
    monkeypatch.setattr(substrings, "ENTRIES", 900)
    texts = ["x" * 5000, "word " * 900, "ab" * 800, "x" * 70 + "word " * 20 + "abc" * 40, "z" + "x" * 49, "z" + "x" * 50, "".join(f"{i} " for i in range(1500)), "".join(f"{i} " for i in range(700, 1300)) + "x" * 60]
    rows = list(enumerate(texts)) + [(None, texts[0]), (2, texts[2])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    want = Counter((d, *r) for (d, _), r in zip(pairs(frame), brute.removed_bytes(pairs(frame))))
    assert bag(substrings.repeated_strings(frame).drop("spans")) == want
    arrays = substrings.batch_arrays(substrings._keyed(frame), 1)
    assert arrays.where("range >= 0").selectExpr("sum(n)").first()[0] < 3000


def test_index_of_several_batches(docs, odd):
    """Batches against the stored levels give what one run over all gives, while ids grow."""
    frame = docs.where("doc_id < 120").select("doc_id", "text")
    whole = {r[0]: tuple(r) for r in substrings.repeated_strings(frame).drop("spans").collect()}
    index = substrings.SuffixIndex(ranges=3)
    cuts = [0, 40, 70, 85, 95, 120]
    for low, high in zip(cuts, cuts[1:]):
        got = index.add(frame.where(f"doc_id >= {low} and doc_id < {high}")).drop("spans").collect()
        assert got and all(tuple(r) == whole[r[0]] for r in got)
    sizes = [n for n, _ in index.levels]
    assert all(a > 2 * b for a, b in zip(sizes, sizes[1:])) and len(sizes) < 5
    assert index.add(odd.where("false")).count() == 0


def test_rolling_hash_of_any_size():
    data = np.frombuffer(np.random.default_rng(1).bytes(300), np.uint8)
    for size in (1, 2, 3, 5, 20, 50, 80):
        hashes = substrings.rolling(np.concatenate([data, data]), size)[:len(data)]
        assert (hashes[:200] == substrings.rolling(np.concatenate([data[7:], data, data]), size)[293:493]).all()
        assert len(set(hashes.tolist())) > (200 if size > 2 else 100)


def test_fingerprints_and_components(odd, docs, pairs, bag):
    for frame in (odd, docs):
        rows = pairs(frame)
        prints = [brute.fingerprint(t) for _, t in rows]
        roots = brute.components([(d, p) for (d, _), p in zip(rows, prints)])
        want = Counter((d, p, None if c == brute.LAST else c) for (d, _), p, c in zip(rows, prints, roots))
        got = simhash.near_duplicates(frame).select("doc_id", "print", "component_id").collect()
        assert Counter((r.doc_id, r["print"] & (1 << 64) - 1, r.component_id) for r in got) == want


@pytest.mark.parametrize("dense", [512, 3])
def test_links_within_three_bits(spark, monkeypatch, dense):
    """Chains, clusters and single pairs of every spread of differing bits over the blocks."""
    rng = np.random.default_rng(7)
    prints = set()
    for spread in ([1], [2], [3], [1, 1], [2, 1], [1, 2], [1, 1, 1]):
        for _ in range(30):
            base = int(rng.integers(0, 1 << 63))
            other = base
            for (start, width), n in zip([simhash.BLOCKS[i] for i in rng.permutation(3)], spread):
                for bit in rng.choice(width, n, replace=False):
                    other ^= 1 << int(start + bit)
            prints |= {base, other}
    center = int(rng.integers(0, 1 << 63))
    for _ in range(250):
        prints.add(center ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 4)), replace=False)))
    rows = sorted(prints)
    want = brute.components([(i, p) for i, p in enumerate(rows)])
    monkeypatch.setattr(simhash, "DENSE", dense)
    frame = spark.createDataFrame([(simhash._signed(p),) for p in rows], "print long")
    label = list(range(len(rows)))
    at = {simhash._signed(p): i for i, p in enumerate(rows)}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for r in simhash.links(frame).collect():
        a, b = at[r.a], at[r.b]  # joined by links, not always one itself
        x, y = sorted((top(a), top(b)))
        label[y] = x
    assert [top(i) for i in range(len(rows))] == want


def test_one_of_each(odd, docs):
    for frame in (odd, docs):
        rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").distinct().collect()]
        roots = brute.components([(d, brute.fingerprint(t)) for d, t in rows])
        left = simhash.one_of_each(frame)
        assert left.columns == frame.columns
        keys = [r.doc_id for r in left.collect()]
        n_without = sum(1 for r in set(roots) if r == brute.LAST)
        assert sorted(k for k in keys if k is not None) == sorted({r for r in roots if r != brute.LAST})
        assert (keys.count(None) > 0) == (n_without > 0)


def test_empty_tables(odd):
    none = odd.where("false")
    assert line_dedup.dedup_lines(none).count() == 0
    assert line_dedup.without_repeated_lines(none).count() == 0
    assert substrings.repeated_strings(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.one_of_each(none).count() == 0
