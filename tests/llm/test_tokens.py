"""Token ids, packing, training order and nearest neighbours."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brookmart.llm import materialise, neighbours, packing, tokens
from brookmart.llm.common import stored


@pytest.fixture(scope="module")
def encode():
    plain = Tokenizer.from_file(tokens.default_path())
    return lambda text: plain.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizers(odd, docs, pairs, encode, monkeypatch):
    texts = [t for _, t in pairs(odd) + pairs(docs)]
    encoder = tokens.ChunkTokenizer(tokens.default_path())
    for most, kept in ((1 << 20, 1 << 20), (20_000, 500)):  # a full cache starts anew
        monkeypatch.setattr(tokens, "KEPT_CHUNKS", kept)
        monkeypatch.setattr(tokens.slices, "__defaults__", (most,))
        got: list[list[int]] = [[] for _ in texts]
        for a, b, ids, counts in encoder.encode_all(pa.array(texts)):
            ends = np.cumsum(counts)
            for i in range(b - a):
                got[a + i] = ids[ends[i] - counts[i]:ends[i]].tolist()
        assert got == [encode(t) for t in texts]


def test_plain_chunks_go_straight_to_the_merges(encode, monkeypatch):
    """Words of ASCII letters, with signs behind them or not; the others go a bounded number at a time."""
    encoder, handed = tokens.ChunkTokenizer(tokens.default_path()), []
    whole = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda texts: handed.append(texts) or whole(texts))
    plain = "some words, others (not) ended... well_ end$$$ mc2 it's don't "
    odd = " ".join(f"{n}ä" for n in range(12_000))
    ids, _ = encoder.encode(pa.array([plain + odd]))
    assert ids.tolist() == encode(plain + odd)
    seen = " ".join(t for texts in handed for t in texts).split()
    assert "(not)" in seen and "mc2" in seen and "it's" in seen
    assert not {"some", "words,", "others", "ended...", "well_", "end$$$"} & set(seen)
    assert max(len(texts) for texts in handed) <= tokens.AT_ONCE and len(handed) > 1


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pack(odd, docs, pairs, encode, bag):
    for frame in (odd, docs):
        want = Counter()
        for d, t in pairs(frame):
            ids = [*encode(t), 0]
            want.update((d, k, a, len(ids[a:a + 2048]), crc(ids[a:a + 2048])) for k, a in enumerate(range(0, len(ids), 2048)))
        rows = packing.pack(frame).collect()
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
        bins = defaultdict(list)
        for r in rows:
            bins[r.sequence_id].append((r.offset, r.length))
        for own in bins.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= 2048
        if frame is docs:
            assert len(bins) <= 1.01 * sum(r.length for r in rows) / 2048 + 1
    assert packing.pack(odd.where("false")).count() == 0


def test_equal_rows_are_spread(spark):
    """A third of the rows equal: no group has twice the mean."""
    rows = spark.range(6000, numPartitions=4).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("text "), F.col("id"))).alias("text"))
    out = packing.pack(rows, group=500)
    sizes = [r["count"] for r in out.groupBy(F.shiftright("sequence_id", 40)).count().collect()]
    assert sum(sizes) == 6000 and len(sizes) == 12 and max(sizes) < 2 * 500


def test_sum_of_squares_choice():
    """Every placement has the least sum of squared counts over open gaps."""
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 33, 200)
    where, offset = packing.pack_sizes(sizes, 32)
    gaps: dict[int, int] = {}
    squares = lambda g: sum(n * n for n in Counter(x for x in g.values() if x).values())
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        options = {squares({**gaps, b: g - size}) for b, g in gaps.items() if g >= size} | {squares({**gaps, -1: 32 - size})}
        gaps[int(where[i])] = gaps.get(int(where[i]), 32) - size
        assert squares(gaps) == min(options) and gaps[int(where[i])] == 32 - int(offset[i]) - size


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 4097])
def test_permutation(n):
    slots = materialise.permuted(np.arange(n), n, 9)
    assert sorted(slots.tolist()) == list(range(n))
    if n > 100:
        assert (slots != materialise.permuted(np.arange(n), n, 10)).any() and abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.2


def test_training_order(odd, docs, pairs, encode, tmp_path):
    for k, frame in enumerate((odd, docs)):
        root = str(tmp_path / f"order{k}")
        rows = sorted(materialise.materialise(frame, root, length=256, per_shard=16).collect())
        assert [r.slot for r in rows] == list(range(len(rows)))
        read = list(materialise.read_slots(root, 0, 256, 16))
        assert len(read) == len(rows)
        again = list(materialise.read_slots(root, 21, 256, 16))
        assert len(again) == len(rows) - 21 and all((a == b).all() for a, b in zip(again, read[21:]))
        texts = defaultdict(list)
        for r, ids in zip(rows, read):
            assert (r.shard, r.place) == divmod(r.slot, 16) and len(ids) == 256 and (ids[r.n_tokens:] == 0).all()
            assert r.ids_crc32 == zlib.crc32(ids[:r.n_tokens].tobytes())
            for s in r.spans:
                texts[s.doc_id].append((s.start, ids[s.at:s.at + s.length].tolist()))
        want = defaultdict(Counter)
        for d, t in pairs(frame):
            want[d].update(enumerate([*encode(t), 0]))
        for d, parts in texts.items():
            got = Counter((start + i, x) for start, ids in parts for i, x in enumerate(ids))
            assert got == want[d]
        assert texts.keys() == want.keys()
    assert materialise.materialise(odd.where("false"), str(tmp_path / "none")).count() == 0


def nearest(rows: dict, q: int, k: int = 5) -> list[int]:
    v = np.array(rows[q], float)
    score = {i: float(np.dot(v, x) / np.sqrt(np.dot(v, v) * np.dot(x, x))) for i, x in rows.items() if i != q and len(x) == len(v)}
    return sorted(score, key=lambda i: (-round(score[i], 12), i))[:k]


def test_recall(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {r.vec_id: [float(x) for x in r.embedding] for r in frame.collect()}
    vectors = stored(neighbours.vectors(frame), "vectors")
    queries = vectors.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    for shard in (4096, 300):
        found = neighbours.search(neighbours.graph(vectors, shard=shard), queries).collect()
        got = defaultdict(list)
        for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
            got[r.query_id].append(r.vec_id)
        assert set(got) == {i for i in rows if i % 50 == 0} and all(len(x) == 5 for x in got.values())
        recall = np.mean([len(set(got[q]) & set(nearest(rows, q))) / 5 for q in got])
        assert recall >= 0.97, recall


def test_scaled_copies_by_id(spark):
    """Forty copies of each of fifty directions, scaled: all tie but for rounding, and the exact score decides."""
    rng = np.random.default_rng(4)
    rows = [(v, (rng.uniform(0.5, 2) * x).tolist()) for v, x in enumerate(np.repeat(rng.normal(size=(50, 16)), 40, axis=0))]
    got = defaultdict(list)
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((-r.score, r.vec_id))
    x = np.array([e for _, e in rows])
    norms = np.sqrt((x * x).sum(axis=1))
    for q, found in got.items():
        score = x @ x[q] / (norms * norms[q])
        assert found == sorted(found) and len(found) == 5
        assert min(-s for s, _ in found) >= np.sort(np.delete(score, q))[-5] - 1e-15


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 7 + 1), float(i % 5), 1.0]) for i in range(0, 120)]
    bad = [(150, None), (200, [0.0, 0.0, 0.0]), (250, [nan, 1.0, 1.0]), (300, [inf, 1.0, 1.0]), (350, [None, 1.0, 1.0]), (400, []), (None, [1.0, 1.0, 1.0])]
    same = [(i, [2.0, 1.0, 3.0]) for i in range(1000, 1400)]
    two = [(500, [1.0, 0.0]), (501, [1.0, 0.1])]
    frame = spark.createDataFrame([(*r, "x") for r in good + bad + same + two], "vec_id long, embedding array<float>, node string")
    got = defaultdict(list)
    for r in sorted(neighbours.nearest(frame).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append(r.vec_id)
    rows = dict(good + same + two)
    assert set(got) == {i for i in rows if i % 50 == 0}
    for q, found in got.items():
        assert found == nearest(rows, q), q
    assert got[500] == [501]
    assert neighbours.nearest(frame.where("false")).count() == 0


def test_graph_reaches_every_node():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(700, 8)) + rng.integers(0, 3, (700, 1)) * 20
    unit = neighbours._unit(x)
    near, entry = neighbours.build(unit, degree=6, width=12)
    seen, front = {entry}, [entry]
    while front:
        front = [j for i in front for j in near[i].tolist() if j >= 0 and j not in seen and not seen.add(j)]
    assert len(seen) == len(x)


def test_back_links_are_pruned_only_where_a_list_overflows():
    rng = np.random.default_rng(8)
    unit = neighbours._unit(rng.normal(size=(60, 6)))
    near = np.full((60, 4), -1, np.int64)
    near[:50, 0] = 59  # a hub that fifty nodes link to
    near[50, :2] = 51, 52
    neighbours._back_linked(unit, near, np.arange(51), 1.2)
    assert near[51].tolist() == [50, -1, -1, -1] and near[52].tolist() == [50, -1, -1, -1]
    hub = near[59][near[59] >= 0]
    assert 0 < len(hub) <= 4 and int((unit[:50] @ unit[59]).argmax()) in hub.tolist()
    assert (neighbours._table(neighbours.pa.chunked_array([neighbours._lists(near)])) == near).all()
    whole = neighbours.pruned(unit, np.arange(60), np.tile(np.arange(60), (60, 1)), 5, 1.0, block=7)
    assert (whole == neighbours.pruned(unit, np.arange(60), np.tile(np.arange(60), (60, 1)), 5, 1.0)).all()
    for i, row in enumerate(whole.tolist()):  # none of those kept is nearer to an earlier one than to the node
        kept = [j for j in row if j >= 0]
        assert i not in kept and all(unit[a] @ unit[b] < unit[i] @ unit[b] + 1e-6 for n, b in enumerate(kept) for a in kept[:n])
