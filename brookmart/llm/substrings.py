"""Long strings that an earlier document has too, by a logarithmic family of sparse suffix arrays.

Suffixes are taken at minimisers: of the ``length`` bytes of any string, the ``SEED`` bytes with the smallest hash, so equal
strings share a suffix at the same place and no match is lost. A batch's array is sorted by a hash of the suffix's first
``SEED`` bytes and then by a hash of its surroundings (all strings around the seed), not by the bytes themselves: strings of a fixed
length need equal keys next to each other, not the order of different ones. Suffixes of one document with equal keys at most
``length`` apart are one entry with an extent, so runs and short periods stay small.

Arrays are cut by hash range. Within a range they enter one by one and equal-sized ones merge, so an entry is moved a
logarithmic number of times. A merge scans what meets: suffixes with equal surroundings in two documents decide the later one,
which leaves the index. What is left with one seed and several surroundings is settled on the bytes themselves; a seed with more
than ``HOT`` such suffixes in halves of its strings, by the bytes that those share, after suffixes with a whole half in common are decided.

``repeated_strings`` does all this for one table. ``SuffixIndex`` keeps the levels as written tables: a new batch is
merge-scanned against them, and levels of about equal size become one.

What moves: about one suffix in sixteen bytes, as compressed column blocks of a batch for a hash range; the texts once, by
document, for the surroundings of open suffixes and for the result. A frequent string leaves each batch once. A batch ends at
``BATCH`` bytes or ``ENTRIES`` suffixes, a long text is read in overlapping pieces of ``SLICE`` bytes; hash ranges and text
groups grow in number with the input.

Defined results: a null or short text has nothing to remove; a null id comes after all others; rows that repeat an id are
one document, which never matches itself, and lose the same bytes where their texts are equal; other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookmart.llm.common import ordered_id, stored
from brookmart.llm.tokens import slices, text_bytes

LENGTH = 50
SEED = 20
BATCH = 8 << 20
ENTRIES = 600_000
RANGE = 8 << 20
SLICE = 1 << 20
HOT = 4096  # open suffixes of one seed, or of a part of its strings, that are settled together
DEALS = 256  # at least, of equal suffixes of such a seed
ODD = 0x2545F4914F6CDD1D
SETTLED = 1 << 15  # suffixes compared at a time
ENTRY = {"h": 7, "c": 6, "doc": 4, "pos": 4, "more": 4}  # bytes kept of each column of a block
WORD = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


LETTERS = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of the ``size`` bytes from each position (those that run over the end are not meant to be used)."""
    power, part, done, out = ODD, LETTERS[data], 1, None
    at = 0
    while True:
        if size & done:
            if out is None:
                out, at = part.copy(), done
            else:
                joined = out * np.uint64(power)  # the earlier bytes weigh more
                joined[:max(0, len(part) - at)] += part[at:]
                out, at = joined, at + done
        done *= 2
        if done > size:
            return out
        longer = part * np.uint64(power)
        longer[:-(done // 2)] += part[done // 2:]
        part, power = longer, power * power & WORD


def _slide(x: np.ndarray, width: int, best, back: bool = False) -> np.ndarray:
    """``best`` over ``width`` positions from each on (or up to each)."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        if back:
            out[step:] = best(out[step:], out[:-step])
        else:
            out[:-step] = best(out[:-step], out[step:])
        have += step
    return out


def suffixes(data: np.ndarray, sizes: np.ndarray, length: int = LENGTH, seed: int = SEED, only: tuple[int, int] | None = None) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end: text, position, seed hash, hash of the surroundings and whether a text's end cuts them.

    ``only`` limits the strings looked at to those that start there (for one text).
    """
    empty = np.zeros(0, np.int64)
    if not (sizes >= length).any():
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty.astype(bool)
    width, n = length - seed + 1, len(data)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    hashes = np.maximum(_mixed(rolling(data, seed)), np.uint64(1))
    least = _slide(hashes, width, np.minimum)
    inside = np.zeros(n + 1, np.int32)
    long = sizes >= length
    first, stop = (starts[long], ends[long] - length + 1) if only is None else (np.array([only[0]]), np.array([min(only[1], n - length + 1)]))
    inside[first] += 1
    np.subtract.at(inside, stop, 1)
    least[np.cumsum(inside[:-1], dtype=np.int32) == 0] = 0  # no string of this length starts here
    at = np.flatnonzero(_slide(least, width, np.maximum, back=True) == hashes)
    text = np.searchsorted(ends, at, side="right")
    reach = length - seed
    cut = (at - reach < starts[text]) | (at + length > ends[text])
    whole = rolling(np.concatenate([data, np.zeros(2 * length, np.uint8)]), seed + 2 * reach)
    around = _mixed(whole[np.maximum(at - reach, 0)])
    return text, at - starts[text], _mixed(hashes[at] ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(8), around, cut


def text_suffixes(texts: pa.Array, length: int = LENGTH, seed: int = SEED) -> Iterator[tuple[int, int, tuple[np.ndarray, ...]]]:
    """``suffixes`` over slices: (first text, end text, arrays). A text above ``SLICE`` comes in pieces that overlap."""
    for a, b in slices(texts, SLICE):
        data, sizes = text_bytes(texts.slice(a, b - a))
        if len(data) <= 2 * SLICE or b - a > 1:
            yield a, b, suffixes(data, sizes, length, seed)
            continue
        for at in range(0, max(1, len(data) - length + 1), SLICE):
            low, high = max(0, at - 2 * length), min(len(data), at + SLICE + 3 * length)
            text, pos, *rest = suffixes(data[low:high], np.array([high - low]), length, seed, (at - low, at - low + SLICE))
            yield a, b, (text, pos + low, *rest)


def _pack(columns: dict[str, np.ndarray]) -> bytes:
    """Byte planes, compressed: the high bytes of sorted differences and small numbers vanish."""
    n = len(columns["h"])
    columns = columns | {"h": np.diff(columns["h"], prepend=np.uint64(0))}
    planes = [np.ascontiguousarray(columns[c].astype("<u8").view(np.uint8).reshape(n, 8)[:, :k].T).tobytes() for c, k in ENTRY.items()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(block: bytes) -> dict[str, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8).reshape(sum(ENTRY.values()), -1)
    out, at = {}, 0
    for c, k in ENTRY.items():
        whole = np.zeros((planes.shape[1], 8), np.uint8)
        whole[:, :k] = planes[at:at + k].T
        out[c], at = whole.view("<u8")[:, 0], at + k
    out["h"] = np.cumsum(out["h"], dtype=np.uint64)
    return out


def _bounds(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _merged(levels: list[dict[str, np.ndarray]]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """The arrays merged by (h, c, id), and the entries decided by it: equal surroundings in a document with a smaller id."""
    both = {c: np.concatenate([x[c] for x in levels]) for c in levels[0]}
    order = np.argsort(both["h"], kind="stable")  # sorted runs: linear
    both = {c: x[order] for c, x in both.items()}
    first = _bounds(both["h"])
    size = np.diff(np.append(first, len(order)))
    several = np.flatnonzero(np.repeat(size > 1, size))
    sub = several[np.lexsort((both["id"][several], both["c"][several], both["h"][several]))]
    for c in both:
        both[c][several] = both[c][sub]
    h, c, ids = (both[k] for k in ("h", "c", "id"))
    classes = _bounds_of(h, c)
    later = ids > np.repeat(ids[classes], np.diff(np.append(classes, len(ids))))
    return {k: x[~later] for k, x in both.items()}, {k: x[later] for k, x in both.items()}


def _chained(level: dict[str, np.ndarray], length: int) -> dict[str, np.ndarray]:
    """Neighbours of one document with equal keys, at most ``length`` apart, as one entry that reaches to the last."""
    doc, pos = level["doc"].astype(np.int64), level["pos"].astype(np.int64)
    if not len(pos):
        return level | {"more": pos}
    joined = (level["h"][1:] == level["h"][:-1]) & (level["c"][1:] == level["c"][:-1]) & (doc[1:] == doc[:-1])
    joined &= (pos[1:] >= pos[:-1]) & (pos[1:] - pos[:-1] <= length)
    first = np.flatnonzero(np.concatenate([[True], ~joined]))
    last = np.append(first[1:], len(pos)) - 1
    return {c: x[first] for c, x in level.items()} | {"more": pos[last] - pos[first]}


def _bounds_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)


def _open(level: dict[str, np.ndarray]) -> np.ndarray:
    """Entries whose seed has several surroundings and several documents, one of them in the batch at hand."""
    h, ids = level["h"], level["id"]
    first = _bounds(h)
    if not first.size:
        return np.zeros(0, bool)
    size = np.diff(np.append(first, len(h)))
    several = (np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)) & np.logical_or.reduceat(level["fresh"], first)
    return np.repeat(several, size)


SPANS = "id long, tag long, start long, stop long, h long"


def _spans(level: dict[str, np.ndarray], start: np.ndarray, stop: np.ndarray, h: np.ndarray) -> pa.Table:
    return pa.table({"id": pa.array(level["id"]), "tag": pa.array(level["tag"]), "start": pa.array(start), "stop": pa.array(stop), "h": pa.array(h)})


ARRAYS = "range int, n long, ids array<long>, tags array<long>, block binary"


def _blocks(level: dict[str, np.ndarray], ids: np.ndarray, tags: np.ndarray, which: np.ndarray) -> Iterator[tuple]:
    """Rows of ``ARRAYS``: the entries of each number in ``which`` (which is sorted)."""
    first = _bounds(which)
    for a, b in zip(first.tolist(), np.append(first[1:], len(which)).tolist()):
        used, doc = np.unique(level["doc"][a:b], return_inverse=True)
        block = _pack({c: level[c][a:b] for c in ENTRY} | {"doc": doc})
        yield int(which[a]), b - a, ids[used], tags[used], block


def _array_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"range": pa.int32(), "n": pa.int64(), "ids": pa.list_(pa.int64()), "tags": pa.list_(pa.int64()), "block": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds.values())], list(kinds))


def _ranges(h: np.ndarray, ranges: int) -> np.ndarray:
    return ((h >> np.uint64(24)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def batch_arrays(docs: DataFrame, ranges: int, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Sorted suffixes of each batch, cut by hash range. Range -1: spans decided here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        names: list[tuple[np.ndarray, np.ndarray]] = []
        total = entries = known = 0

        def flush() -> pa.RecordBatch:
            ids, tags = (np.concatenate(x) for x in zip(*names))
            level = {c: np.concatenate([p[i] for p in held]) for i, c in enumerate(("doc", "pos", "h", "c"))}
            cut = np.concatenate([p[4] for p in held])
            held.clear()
            level["id"] = ids[level["doc"]]
            own = _mixed(tags[level["doc"]].astype(np.uint64) ^ _mixed(level["id"].astype(np.uint64)) + level["pos"].astype(np.uint64))
            level["c"] = np.where(cut, own, level["c"]) >> np.uint64(16)  # cut surroundings equal nothing
            del own, cut
            level, decided = _merged([level])
            level = _chained(level, length)
            rows = list(_blocks(level, ids, tags, _ranges(level["h"], ranges)))
            decided = _chained(decided, length)
            rows += _blocks(decided, ids, tags, np.full(len(decided["h"]), -1))
            return _array_rows(rows)

        for batch in batches:
            for a, b, (text, *arrays) in text_suffixes(batch.column(2), length, seed):
                names.append((np.asarray(batch.column(0))[a:b], np.asarray(batch.column(1))[a:b]))
                held.append((text + known, *arrays))
                known += b - a
                entries += len(text)
                total += batch.column(2).slice(a, b - a).nbytes if b - a > 1 else SLICE
                if total >= BATCH or entries >= ENTRIES:
                    yield flush()
                    names, total, entries, known = [], 0, 0, 0
        if held:
            yield flush()

    return docs.select("id", "tag", "text").mapInArrow(run, ARRAYS)


def _run(row_ids: list[int], row_tags: list[int], block: bytes, fresh: bool = True) -> dict[str, np.ndarray]:
    level = _unpack(block)
    doc = level["doc"].astype(np.int64)
    level["pos"], level["more"] = level["pos"].astype(np.int64), level["more"].astype(np.int64)
    return level | {"id": np.array(row_ids, np.int64)[doc], "tag": np.array(row_tags, np.int64)[doc], "fresh": np.full(len(doc), fresh)}


def _family(runs: list[dict[str, np.ndarray]], decided) -> dict[str, np.ndarray]:
    """One array of all runs, merged geometrically; ``decided`` gets what each merge decides."""
    levels: list[dict[str, np.ndarray]] = []
    runs.sort(key=lambda x: -int(x["id"].min()))
    while runs:
        level = runs.pop()
        while levels and len(levels[-1]["h"]) <= 2 * len(level["h"]):
            level, later = _merged([levels.pop(), level])
            decided(later)
        levels.append(level)
    level, later = _merged(levels)
    decided(later)
    return level


def index_spans(arrays: DataFrame, ranges: int, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Runs the family of each hash range. Spans with h = -1 are removed; others are open suffixes of seed ``h`` from ``start`` to ``stop``."""
    reach = length - seed

    def one(group: pa.Table) -> pa.Table:
        runs = [_run(*x) for x in zip(*(group.column(c).to_pylist() for c in ("ids", "tags", "block", "fresh")))]
        gone, out = -1, []

        def decided(level: dict[str, np.ndarray]) -> None:
            if len(level["id"]):
                out.append(_spans(level, level["pos"] - reach, level["pos"] + level["more"] + length, np.full(len(level["id"]), gone)))

        if group.column("range")[0].as_py() < 0:  # decided inside a batch
            for level in runs:
                decided(level)
        else:
            level = _family(runs, decided)
            several = _open(level)
            left = {k: x[several] for k, x in level.items()}
            out.append(_spans(left, left["pos"], left["pos"] + left["more"], left["h"].astype(np.int64)))
        return pa.concat_tables(out) if out else _spans({"id": np.zeros(0, np.int64), "tag": np.zeros(0, np.int64)}, *[np.zeros(0, np.int64)] * 3)

    # batch-decided rows are dealt over as many groups as there are ranges
    spread = F.when(F.col("range") < 0, -1 - F.pmod(F.hash("block"), F.lit(ranges))).otherwise(F.col("range"))
    return arrays.drop("n").withColumn("range", spread).groupBy("range").applyInArrow(one, SPANS)


def merged_level(arrays: DataFrame) -> DataFrame:
    """Several levels as one: what is not decided, a block per range."""
    def one(group: pa.Table) -> pa.Table:
        runs = [_run(*x) for x in zip(*(group.column(c).to_pylist() for c in ("ids", "tags", "block")))]
        level = _family(runs, lambda later: None)
        keys = np.stack([level["id"], level["tag"]], axis=1)
        used, doc = np.unique(keys, axis=0, return_inverse=True)
        level["doc"] = doc.reshape(-1)
        return pa.Table.from_batches([_array_rows(list(_blocks(level, used[:, 0], used[:, 1], np.full(len(doc), group.column("range")[0].as_py()))))])

    return arrays.where("range >= 0").groupBy("range").applyInArrow(one, ARRAYS)


def _surroundings(length: int, seed: int):
    reach = length - seed
    size = seed + 2 * reach

    def one(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        kinds = pa.schema([("h", pa.int64()), ("id", pa.int64()), ("tag", pa.int64()), ("start", pa.int64()), ("more", pa.int64()),
                           ("left", pa.int32()), ("right", pa.int32()), ("around", pa.binary())])
        if not wanted.num_rows or not texts.num_rows:
            return kinds.empty_table()
        data, sizes = text_bytes(texts.column("text").combine_chunks())
        first = np.cumsum(sizes) - sizes
        where = {key: i for i, key in enumerate(zip(texts.column("id").to_pylist(), texts.column("tag").to_pylist()))}  # equal keys: equal texts
        ids, tags, start = wanted.column("id"), wanted.column("tag"), np.asarray(wanted.column("start"))
        row = np.fromiter((where[k] for k in zip(ids.to_pylist(), tags.to_pylist())), np.int64, wanted.num_rows)
        if (start + seed > sizes[row]).any():
            raise ValueError("a suffix does not lie in its text")
        left, right = np.minimum(start, reach), np.minimum(sizes[row] - start, length)
        padded = np.concatenate([np.zeros(reach, np.uint8), data, np.zeros(length, np.uint8)])
        out = []
        for a in range(0, len(row), 1 << 16):
            own = slice(a, a + (1 << 16))
            around = padded[(first[row[own]] + start[own])[:, None] + np.arange(size)]
            columns = np.arange(size)
            around[(columns < reach - left[own][:, None]) | (columns >= reach + right[own][:, None])] = 0
            ends = np.arange(len(around) + 1, dtype=np.int32) * size
            out.append(pa.Array.from_buffers(pa.binary(), len(around), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(around))]))
        more = np.asarray(wanted.column("stop")) - start
        return pa.table([wanted.column("h"), ids, tags, wanted.column("start"), pa.array(more), pa.array(left, pa.int32()), pa.array(right, pa.int32()),
                         pa.chunked_array(out, pa.binary())], schema=kinds)

    return one, "h long, id long, tag long, start long, more long, left int, right int, around binary"


def _settled(length: int, seed: int):
    """Which strings around open suffixes of one seed lie in a document with a smaller id; compared byte by byte.

    Rows of ``_halved`` look at the strings of their half only.
    """
    reach = length - seed

    def some(group: pa.Table) -> pa.Table:
        h, ids = np.asarray(group.column("h")), np.asarray(group.column("id"))
        start, more, left, right = (np.asarray(group.column(c)).astype(np.int64) for c in ("start", "more", "left", "right"))
        low, high = (np.asarray(group.column(c)) if c in group.column_names else np.full(len(h), i) for c, i in (("low", 0), ("high", reach)))
        around = np.frombuffer(b"".join(group.column("around").to_pylist()), np.uint8).reshape(len(h), -1)
        prefix = np.zeros((len(h), around.shape[1] + 1), np.uint64)
        for i in range(around.shape[1]):
            prefix[:, i + 1] = prefix[:, i] * np.uint64(ODD) + LETTERS[around[:, i]]
        shift = np.uint64(pow(ODD, length, 1 << 64))
        lowest, highest = np.full(len(h), -1), np.full(len(h), -1)
        for before in range(reach + 1):  # bytes of the string before the seed
            valid = np.flatnonzero((left >= before) & (right >= length - before) & (low <= before) & (before <= high))
            if not valid.size:
                continue
            a = reach - before
            key = _mixed(prefix[valid, a + length] - prefix[valid, a] * shift) ^ _mixed(h[valid].astype(np.uint64))
            order = np.lexsort((ids[valid], key))
            valid, key = valid[order], key[order]
            first = _bounds(key)
            least = valid[np.repeat(first, np.diff(np.append(first, len(valid))))]
            hit = np.flatnonzero(ids[valid] > ids[least])
            same = (around[valid[hit], a:a + length] == around[least[hit], a:a + length]).all(axis=1)
            own = valid[hit[same]]
            highest[own] = before
            lowest[own] = np.where(lowest[own] < 0, before, lowest[own])
        found = np.flatnonzero(highest >= 0)
        level = {"id": ids[found], "tag": np.asarray(group.column("tag"))[found]}
        return _spans(level, start[found] - highest[found], start[found] + more[found] - lowest[found] + length, np.full(len(found), -1))

    def one(group: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(group.column("h")), kind="stable")
        first = _bounds(np.asarray(group.column("h"))[order])
        out, at = [], 0
        for stop in np.append(first[1:], len(order)).tolist():  # whole seeds, about SETTLED rows at a time
            if stop - at >= SETTLED or stop == len(order):
                out.append(some(group.take(pa.array(order[at:stop]))))
                at = stop
        return pa.concat_tables(out)

    return one


def _halved(rows: DataFrame, length: int, seed: int) -> DataFrame:
    """Each suffix once for either half of its strings from ``low`` to ``high``, with a hash of what the strings of the half share as ``h``.

    Strings with ``low`` to ``high`` bytes before the seed all have ``low`` bytes before it and ``length - seed - high`` behind it.
    """
    reach = length - seed
    low, high = F.col("low"), F.col("high")
    middle = F.floor((low + high) / 2).cast("int")
    half = lambda a, b: F.struct(a.alias("low"), b.alias("high"))
    halves = F.when(low == high, F.array(half(low, high))).otherwise(F.array(half(low, middle), half(middle + 1, high)))
    rows = rows.select("id", "tag", "start", "more", "left", "right", "around", F.explode(halves).alias("half")).select("*", "half.low", "half.high").drop("half")
    rows = rows.where(F.greatest(low, length - F.col("right")) <= F.least(high, F.col("left")))  # a string of the half lies in the text
    return rows.withColumn("h", F.xxhash64("low", "high", F.substring("around", reach + 1 - low, low + length - high)))


def _hot_groups(around: DataFrame, parts: int, length: int, seed: int) -> tuple[DataFrame, DataFrame | None]:
    """Seeds with many suffixes in smaller groups for ``_settled``, and spans of what is decided on the way.

    A group above ``HOT`` is halved by the place of its strings until its parts are small. Of a half that is still above it, suffixes
    that are equal in all its strings are decided at once and only those of the least id go on, so a passage of a whole half takes
    a row, not one for each of its strings in each document.
    """
    reach = length - seed
    rows = stored(around.withColumns({"low": F.lit(0), "high": F.lit(reach)}), "suffix-hot")
    small, spans = [], []
    for _ in range(reach.bit_length()):
        rows = stored(_halved(rows, length, seed), "suffix-halves")
        hot = stored(rows.groupBy("h").count().where(F.col("count") > HOT).select("h"), "suffix-hot-halves")
        if not hot.limit(1).count():
            small.append(rows)
            break
        small.append(rows.join(hot, "h", "left_anti").select(*rows.columns))
        judged = stored(_equal_halves(rows.join(hot, "h", "left_semi").select(*rows.columns), parts, length, seed), "suffix-equal")
        spans.append(judged.where("later").select("id", "tag", (F.col("start") - F.col("most")).alias("start"),
                                                  (F.col("start") + F.col("more") - F.col("fewest") + length).alias("stop"), F.lit(-1).cast("long").alias("h")))
        rows = judged.where("not later and low < high").select(*rows.columns)  # the least id of a single string keeps it
    return reduce(DataFrame.union, small), reduce(DataFrame.union, spans) if spans else None


def _equal_halves(rows: DataFrame, parts: int, length: int, seed: int) -> DataFrame:
    """Rows of ``_halved`` with whether a document with a smaller id has all their strings, ``fewest`` to ``most`` bytes before the seed.

    Bytes are compared, not hashes. Equal rows meet in ``parts`` or more deals first and then only the least id of each deal, so that no task
    has all of a frequent passage.
    """
    rows = rows.withColumns({"fewest": F.greatest("low", length - F.col("right")), "most": F.least("high", "left")})
    equal = ["h", "fewest", "most", F.substring("around", length - seed + 1 - F.col("most"), F.col("most") - F.col("fewest") + length)]
    dealt = rows.withColumn("deal", F.pmod(F.xxhash64("id", "tag", "start"), F.lit(max(parts, DEALS))))
    first = F.min("id").over(Window.partitionBy(*equal, "deal"))
    dealt = dealt.withColumn("deal", F.when(F.col("id") > first, F.col("deal")).otherwise(-1))
    least = F.min("id").over(Window.partitionBy(*equal, "deal"))
    return dealt.withColumn("later", (F.col("deal") >= 0) | (F.col("id") > least)).drop("deal")


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, stop: long>>"


def _results(texts: pa.Table, spans: pa.Table) -> pa.Table:
    """What remains of each text."""
    data, sizes = text_bytes(texts.column("text").combine_chunks())
    first = np.cumsum(sizes) - sizes
    step = np.zeros(len(data) + 1, np.int32)
    if spans.num_rows:
        rows: dict[tuple, list[int]] = {}
        for i, key in enumerate(zip(texts.column("id").to_pylist(), texts.column("tag").to_pylist())):
            rows.setdefault(key, []).append(i)
        keys = list(zip(spans.column("id").to_pylist(), spans.column("tag").to_pylist()))
        start, stop = np.asarray(spans.column("start")), np.asarray(spans.column("stop"))
        nth = 0
        while True:  # rows that repeat a document get its spans too
            at = np.array([rows[k][nth] if k in rows and nth < len(rows[k]) else -1 for k in keys], np.int64)
            own = np.flatnonzero(at >= 0)
            if not own.size:
                break
            if (start[own] < 0).any() or (stop[own] > sizes[at[own]]).any():
                raise ValueError("a span does not lie in its text")
            np.add.at(step, first[at[own]] + start[own], 1)
            np.add.at(step, first[at[own]] + stop[own], -1)
            nth += 1
    gone = np.cumsum(step[:-1], dtype=np.int32) > 0
    del step
    begins = np.zeros(len(data) + 1, bool)
    begins[first] = True
    starts = np.flatnonzero(gone & (begins[:-1] | ~np.concatenate([[False], gone[:-1]])))
    stops = np.flatnonzero(gone & (begins[1:] | ~np.concatenate([gone[1:], [False]]))) + 1
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
    removed = np.zeros(len(sizes), np.int64)
    full = np.flatnonzero(sizes)
    if full.size:
        removed[full] = np.add.reduceat(gone, first[full], dtype=np.int64)
    n_spans = np.bincount(owner, minlength=len(sizes))
    ends = np.concatenate([[0], np.cumsum(n_spans)])
    hexes, lists = [], []
    for i, (a, n) in enumerate(zip(first.tolist(), sizes.tolist())):
        mine = gone[a:a + n]
        part = data[a:a + n]
        hexes.append(hashlib.sha256(part[~mine].tobytes() if removed[i] else part.tobytes()).hexdigest())
        own = slice(ends[i], ends[i + 1])
        lists.append([{"start": x - a, "stop": y - a} for x, y in zip(starts[own].tolist(), stops[own].tolist())])
    return pa.table({
        "doc_id": texts.column("doc_id"), "n_bytes": pa.array(sizes), "n_removed": pa.array(removed), "n_spans": pa.array(n_spans, pa.int64()),
        "kept_sha256": pa.array(hexes, pa.string()),
        "spans": pa.array(lists, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))})


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), ordered_id(F.col("doc_id")).alias("id"),
                       F.xxhash64("text").alias("tag"), F.coalesce("text", F.lit("")).alias("text"))


def _judged(rows: DataFrame, arrays: DataFrame, texts: DataFrame, parts: int, length: int, seed: int) -> DataFrame:
    """Results of ``rows`` by the arrays of them and of earlier batches; ``texts`` has the texts of both."""
    spans = stored(index_spans(arrays, parts, length, seed), "suffix-spans")
    bucket = F.pmod(F.xxhash64("id", "tag"), F.lit(parts)).cast("int").alias("bucket")
    own = rows.select(bucket, "doc_id", "id", "tag", "text").groupBy("bucket")
    texts = own if texts is rows else texts.select(bucket, "doc_id", "id", "tag", "text").groupBy("bucket")
    left = spans.where("h >= 0").select(bucket, "id", "tag", "start", "stop", "h")
    hot = stored(left.groupBy("h").count().where(F.col("count") > HOT).select("h"), "suffix-hot-seeds")
    look, kind = _surroundings(length, seed)
    hot_left = left.join(hot, "h", "left_semi").select(*left.columns) if hot.limit(1).count() else None
    if hot_left is not None:
        left = left.join(hot, "h", "left_anti").select(*left.columns)

    def settled(groups: DataFrame) -> DataFrame:
        return groups.withColumn("part", F.pmod("h", F.lit(parts)).cast("int")).groupBy("part").applyInArrow(_settled(length, seed), SPANS)

    more = settled(texts.cogroup(left.groupBy("bucket")).applyInArrow(look, kind))
    if hot_left is not None:
        halves, equal = _hot_groups(texts.cogroup(hot_left.groupBy("bucket")).applyInArrow(look, kind), parts, length, seed)
        more = more.union(settled(halves))
        more = more if equal is None else more.union(equal)
    # one shuffle of the texts serves both uses: the plans below it are equal
    gone = spans.where("h < 0").union(more).select(bucket, "id", "tag", "start", "stop").groupBy("bucket")
    return own.cogroup(gone).applyInArrow(_results, RESULT)


def repeated_strings(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans, for strings of ``length`` bytes."""
    rows = _keyed(docs)
    total = docs.select(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = max(1, -(-total // RANGE))
    arrays = batch_arrays(rows, parts, length, seed).withColumn("fresh", F.lit(True))
    return _judged(rows, arrays, rows, parts, length, seed)


@dataclass
class SuffixIndex:
    """Levels of suffix arrays over the documents of earlier batches, each a written table.

    ``ranges`` is fixed for an index: about one for every ``RANGE`` bytes expected in all. Of a later batch, strings count that a document with a smaller
    id of any batch has; results of earlier batches stay as they were given.
    """

    ranges: int
    length: int = LENGTH
    seed: int = SEED
    levels: list[tuple[int, DataFrame]] = field(default_factory=list)  # entries, rows of ``ARRAYS``
    texts: list[DataFrame] = field(default_factory=list)

    def add(self, docs: DataFrame) -> DataFrame:
        """The results of a new batch (columns as in ``repeated_strings``), which then belongs to the index."""
        rows = stored(_keyed(docs), "suffix-texts")
        new = stored(batch_arrays(rows, self.ranges, self.length, self.seed), "suffix-level")
        arrays = reduce(DataFrame.union, (x.withColumn("fresh", F.lit(False)) for _, x in self.levels), new.withColumn("fresh", F.lit(True)))
        texts = reduce(DataFrame.union, self.texts, rows)
        out = stored(_judged(rows, arrays, texts if self.texts else rows, self.ranges, self.length, self.seed), "suffix-results")
        level = new.where("range >= 0")
        size = level.agg(F.sum("n")).first()[0] or 0
        while self.levels and self.levels[-1][0] <= 2 * size:
            level = stored(merged_level(self.levels.pop()[1].union(level)), "suffix-level")
            size = level.agg(F.sum("n")).first()[0] or 0
        if size:
            self.levels.append((size, level))
        self.texts.append(rows)
        return out
