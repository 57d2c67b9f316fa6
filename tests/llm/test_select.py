"""Quality rules, language ID, mixing and sharding."""

from __future__ import annotations

import zlib
from collections import Counter

import brute
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brookmart.llm import language, mixing, quality, sharding


def test_statistics(odd, docs, pairs):
    for frame in (odd, docs):
        rows = pairs(frame)
        want = Counter((d, *brute.word_statistics(t)) for d, t in rows)
        got = quality.document_statistics(frame).select("doc_id", *quality.COUNTS).collect()
        assert Counter(map(tuple, got)) == want


def test_repeated_windows_at_random():
    rng = np.random.default_rng(2)
    for _ in range(60):
        texts = [" ".join(rng.choice(list("abc"), int(rng.integers(0, 40)))) for _ in range(5)]
        import pyarrow as pa
        got = quality.statistics(pa.array(texts))
        assert got["n_repeat_words"].tolist() == [brute.word_statistics(t)[4] for t in texts]


def test_verdicts(spark, sf_dir, docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality.judged(docs, labels)
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == docs.count()
    for r in rows.values():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    known = labels.collect()
    right = sum((rows[r.doc_id].score >= 0.5) == bool(r.quality) for r in known)
    assert right / len(known) > 0.97


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    stats = quality.document_statistics(spark.read.parquet(f"{sf}/documents.parquet")).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    both = stats.merge(labels, on="doc_id")
    x, y = quality.features(both), both["quality"].to_numpy(float)
    test = both["doc_id"].to_numpy() % 3 == 0
    trees = quality.boost(x[~test], y[~test], tuple(quality.FEATURES.index(f) for f in quality.FALLING))
    assert ((trees.score(x[test]) >= 0.5) == y[test]).mean() > 0.97
    for name in quality.FALLING:  # never rises along a constrained statistic
        column = quality.FEATURES.index(name)
        grid = np.repeat(x[test][:20], 50, axis=0)
        grid[:, column] = np.tile(np.linspace(0, 1, 50), len(grid) // 50)
        assert (np.diff(trees.margin(grid).reshape(-1, 50), axis=1) <= 1e-9).all()


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    trees = quality.boost(x, (x[:, 0] + x[:, 1] > 0).astype(float), (), trees=5, depth=3)

    def walk(row, at):
        while trees.left[at] != at:
            at = trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
        return trees.value[at]

    want = [trees.prior + sum(walk(r, root) for root in trees.roots) for r in x]
    assert np.allclose(trees.margin(x), want)
    assert ((trees.score(x) > 0.5) == (x[:, 0] + x[:, 1] > 0)).mean() > 0.9


def test_quality_edges(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality.judged(odd, none)
    assert out.where("kept AND NOT base_failed").count() == out.where("NOT base_failed").count() and out.where("score IS NOT NULL").count() == 0
    one = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.judged(odd, one).count() == odd.count()
    assert quality.judged(odd.where("false"), one).count() == 0


def test_gradients_by_differences():
    net = language.Network.new(["a", "b", "c"], 4, 1)
    for name in ("gates", "state", "out", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    data, inside = language.windows([b"hello there", b"short", b"", b"one more text to see"], 20)
    label = np.array([0, 1, 2, 1])
    _, grads = net.gradients(data, inside, label)
    rng = np.random.default_rng(1)
    for w, g in zip(net.weights(), grads):
        for _ in range(5):
            at = np.unravel_index(rng.choice(np.flatnonzero(g)), w.shape)
            old, step = w[at], 1e-3
            w[at] = old + step
            up, _ = net.gradients(data, inside, label)
            w[at] = old - step
            down, _ = net.gradients(data, inside, label)
            w[at] = old
            assert abs(g[at] - (up - down) / (2 * step)) < 1e-4


def test_windows_cover_whole_texts():
    net = language.Network.new(["a", "b"], 4, 3)
    texts = [b"x" * 1000, b"", b"abc", b"some text " * 77]
    data = np.frombuffer(b"".join(texts), np.uint8)
    got = net.pooled(data, np.array([len(t) for t in texts]))
    for row, text in zip(got, texts):
        if not text:
            assert (row == 0).all()
            continue
        parts = [text[i:i + language.WINDOW] for i in range(0, len(text), language.WINDOW)]
        want = np.zeros(2)
        for p in parts:
            codes = language.LOWER[np.frombuffer(p, np.uint8)][:, None]
            want += net._window_sums(codes, np.array([len(p)]))[:, 0]
        assert np.allclose(row, want / len(text), atol=1e-5) and abs(row.sum() - 1) < 1e-4


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(odd):
    rows = language.identified(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r.doc_id in (3, 4, 5, 6):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "de", "fr")
    assert {r.lang_pred for r in language.identified(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identified(odd.where("false")).count() == 0
    assert language.accepted(odd).columns == odd.columns
    assert not {3, 4, 5, 6} & {r.doc_id for r in language.accepted(odd).collect()}


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 1, "c": 1, "d": 5}, {"a": 0, "b": 0}, {"b": 10, None: 4, "é": 7, "z": 90, "A": 1},
    {f"s{i}": (i * 37) % 101 for i in range(40)}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s is None, s or "", n) for s, n in sizes.items()], "no_source boolean, source string, source_size long")
    got = {(None if r.no_source else r.source): r.target for r in mixing.targets(rows).collect()}
    want = brute.mix_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_fit_is_exact_where_it_can_be():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 12))
        lengths = sorted(rng.choice(np.arange(0, 60), n, replace=False).tolist())
        counts = rng.integers(1, 5, n).tolist()
        whole = sum(a * b for a, b in zip(lengths, counts))
        target = float(rng.uniform(0, 3 * whole))
        passes, chosen = mixing.fit(lengths, counts, target)
        assert all(0 <= c <= m for c, m in zip(chosen, counts))
        total = passes * whole + sum(a * b for a, b in zip(lengths, chosen))
        assert total <= target + 1e-9
        rest = int(target) - passes * whole if passes < 3 else 0
        sums = {0}
        for a, c in zip(lengths, counts):
            sums = {s + k * a for s in sums for k in range(c + 1) if s + k * a <= rest} if a else sums
        assert total == passes * whole + max(sums)


def test_mix(odd, docs, bag):
    for frame in (odd, docs):
        out = mixing.mix(frame)
        rows = out.join(frame.select(F.col("doc_id").alias("d"), "source", F.xxhash64("text").alias("t")).distinct(),
                        F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))).collect()
        assert out.count() == frame.count()
        size, taken, target = Counter(), Counter(), {}
        for r in rows:
            size[r.source] += r["size"]
            taken[r.source] += r.taken
            target[r.source] = r.target
            assert r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        for r in rows:
            assert r.source_size == size[r.source]
        want = brute.mix_targets({s: size[s] for s in target})
        for s in target:
            assert abs(target[s] - want[s]) < 1e-6 and taken[s] <= target[s] + 1e-9
            if frame is docs:
                assert target[s] - taken[s] < 0.02 * target[s]
        assert bag(mixing.mix(frame.repartition(7))) == bag(out)
        times = mixing.mixed_documents(frame)
        assert times.columns == frame.columns
        assert sum(len(brute.WORDS.findall(r.text)) for r in times.collect()) == sum(taken.values())
    assert mixing.mix(odd.where("false")).count() == 0 and mixing.mixed_documents(odd.where("false")).count() == 0


def test_language_sample_is_bounded(docs, monkeypatch):
    """A label of its own for every third row: the frequent labels are learned, from a bounded number of pieces."""
    seen = []
    monkeypatch.setattr(language, "train", lambda texts, labels: seen.append((len(texts), labels)))
    dirty = docs.withColumn("lang", F.expr("case when doc_id % 3 = 0 then concat('x', doc_id) else lang end"))
    language.fit(dirty, most=3, max_fit=60)
    (n, labels), = seen
    frequent = dirty.where(~language.held_out(F.col("doc_id")) & F.col("lang").isNotNull()).groupBy("lang").count()
    assert set(labels) == {r.lang for r in frequent.orderBy(F.col("count").desc(), "lang").limit(3).collect()}
    assert n <= 60 * language.PIECES and max(Counter(labels).values()) <= 20 * language.PIECES


def test_sharding(odd, docs):
    for frame in (odd, docs):
        out = sharding.assign(frame).toPandas()
        assert len(out) == frame.count() and set(out["law"]) == {"bytes"} and out["grown_shard"].isna().all()
        for _, own in out.groupby("shard"):
            assert sorted(own["slot"]) == list(range(len(own)))
        want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in frame.collect())
        ids = [None if pd.isna(x) else int(x) for x in out["doc_id"]]
        assert Counter(zip(ids, out["size"], out["text_crc32"])) == want
    loads = out.groupby("shard")["size"].sum()
    assert loads.max() - loads.min() < 0.05 * loads.mean()
    assert sharding.assign(odd.where("false")).count() == 0
    plan = sharding.assign(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sharding_of_repeated_rows(spark, tmp_path):
    """A third of the rows are one row, a third have no id and one text: the law holds, and no slot holds them all."""
    rows = spark.range(9000).selectExpr("case id % 3 when 0 then 7L when 1 then null else id end doc_id",
                                        "case id % 3 when 0 then repeat('same ', 20) when 1 then repeat('other ', 15) else concat('t', id) end text")
    out = sharding.assign(rows.repartition(5)).toPandas()
    loads = out.groupby("shard")["size"].sum()
    assert len(out) == 9000 and len(loads) == 8 and loads.max() - loads.min() < 0.05 * loads.mean()
    for _, own in out.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    assert out.groupby("vslot").size().max() < 3 * 3000 / sharding.PARTS
    assert Counter(zip(out["doc_id"].fillna(-1).astype(int), out["size"])) == Counter(
        (-1 if r.doc_id is None else r.doc_id, len(r.text) + 1) for r in rows.collect())

    base = rows.withColumn("vslot", sharding.virtual_slot(F.col("doc_id"), F.col("text")))
    crowded = sorted(r.vslot for r in base.groupBy("vslot").count().where("count > 100").collect())
    assert len(crowded) == 2
    slots = spark.createDataFrame([(s, s % 4) for s in range(sharding.SLOTS + 2 * sharding.PARTS)], "vslot int, shard int")
    sharding.write_shards(rows, slots, str(tmp_path / "out"), crowded=crowded)
    per_shard = spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().collect()
    assert sum(r["count"] for r in per_shard) == 9000 and max(r["count"] for r in per_shard) < 2 * 9000 / 4


def test_rebalancing_moves_little():
    rng = np.random.default_rng(4)
    sizes = {s: int(x) for s, x in enumerate(rng.integers(1, 1000, sharding.SLOTS))}
    one = sharding.place(sizes, 8)
    load = lambda m, n: np.bincount(m, [sizes.get(s, 0) for s in range(sharding.SLOTS)], n)
    assert np.ptp(load(one, 8)) <= 1000
    nine = sharding.place(sizes, 9, current=one)
    assert np.ptp(load(nine, 9)) <= 2000
    moved = [s for s in range(sharding.SLOTS) if one[s] != nine[s]]
    assert sum(sizes[s] for s in moved) < 1.05 * sum(sizes.values()) / 9
    assert sharding.place(sizes, 8, current=one) == one
    seven = sharding.place(sizes, 7, current=one)
    assert max(seven) == 6 and np.ptp(load(seven, 7)) <= 2000


def test_slot_map_versions(spark, tmp_path):
    maps = sharding.SlotMap(spark, str(tmp_path / "map"))
    maps.write(1, [0, 1, 0], [0, 0, 5])
    maps.write(2, [0, 1, 2], [0, 0, 0])
    assert [tuple(r) for r in maps.read(1).orderBy("vslot").collect()] == [(0, 0, 0), (1, 1, 0), (2, 0, 5)]
    assert [r.shard for r in maps.read(2).orderBy("vslot").collect()] == [0, 1, 2]


def test_written_shards(spark, odd, tmp_path):
    slots = spark.createDataFrame([(s, s % 3) for s in range(sharding.SLOTS)], "vslot int, shard int")
    plain = odd.select("doc_id", "text")
    sharding.write_shards(plain, slots, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == odd.count() and {r.shard for r in back.select("shard").distinct().collect()} <= {0, 1, 2}
