"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints (64 bits, three-word shingles) that differ in at most three bits are linked. Half of three is one flip and an
odd bit: the 64 bits are cut into three blocks, and with one block set aside every fingerprint emits all variants of the
rest within one flip. Two fingerprints three bits apart lose a bit with one of the blocks, after which each is one flip from
a common variant. So variants meet (rest two bits apart), and fingerprints equal outside a block meet too; colliding ones
are verified on all 64 bits. No link is lost: with differing bits spread as (1,1,1), (2,1,0) or (1,1,0) some block leaves
exactly two outside and at most one inside, and all else lies within one block.

Equal fingerprints are one before anything is emitted, 131 rows each whatever the input. Within a collision only a spanning
forest of its links is passed on; collisions above ``DENSE`` members look up neighbours instead of comparing all.
Component numbers come from least labels with pointer jumping over written tables.

Defined results: null, empty and blank texts have fingerprint zero and are linked like any other; fewer than three words are
one shingle; equal rows are copies; a null id comes last and is a component's number only where it is alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import ordered_id, stored
from brookmart.llm.components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
BLOCKS = ((0, 21), (21, 21), (42, 22))
DENSE = 512
HASHES = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, HASHES):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + HASHES], stops[at:at + HASHES])], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, a hash that tells rows of one id apart, and the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints, pa.int64())],
                                             ["doc_id", "text_hash", "print"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id long, text_hash long, print long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def variants(prints: DataFrame) -> DataFrame:
    """(key, block, same, print): what a fingerprint looks like without a block, as it is (same) and with one flip."""
    kinds = []
    for block, (start, width) in enumerate(BLOCKS):
        keep = ~(((1 << width) - 1) << start) & (1 << 64) - 1
        for bit in [None, *(b for b in range(64) if keep >> b & 1)]:
            kinds.append(F.struct(F.lit(block).alias("block"), F.lit(bit is None).alias("same"), F.lit(_signed(keep)).alias("keep"),
                                  F.lit(0 if bit is None else _signed(1 << bit)).alias("flip")))
    out = prints.select("print", F.explode(F.array(*kinds)).alias("k"))
    rest = F.col("print").bitwiseAND(F.col("k.keep")).bitwiseXOR(F.col("k.flip"))
    return out.select(F.xxhash64("k.block", "k.same", rest).alias("key"), F.col("k.block").alias("block"), F.col("k.same").alias("same"), "print")


def _forest(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a small collision that keep its components: each member with its component's first."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= RADIUS
    label, big = np.arange(len(prints)), len(prints)
    while True:
        least = np.where(near, label[None, :], big).min(axis=1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    member = np.flatnonzero(label != np.arange(len(prints)))
    return prints[label[member]], prints[member]


def _dense(prints: np.ndarray, block: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The same for a large collision, in time proportional to its members.

    ``same``: all are equal outside the block, so neighbours within it are looked up at up to three flips. Otherwise the rests
    are one flip from the common variant: members with one block value are all linked, those one flip apart in the block are
    if their rests differ.
    """
    start, width = BLOCKS[block]
    value = prints >> np.uint64(start) & np.uint64((1 << width) - 1)
    order = np.argsort(value, kind="stable")
    prints, value = prints[order], value[order]
    own, first, size = np.unique(value, return_index=True, return_counts=True)
    second = np.where(size > 1, first + 1, first)
    head = np.repeat(first, size)
    chain = np.flatnonzero(head != np.arange(len(prints)))
    left, right = [head[chain]], [chain]
    flips = [1 << a for a in range(width)]
    if same:
        flips += [1 << a | 1 << b for a in range(width) for b in range(a)]
        flips += [1 << a | 1 << b | 1 << c for a in range(width) for b in range(a) for c in range(b)]
    for flip in flips:
        other = own ^ np.uint64(flip)
        at = np.minimum(np.searchsorted(own, other), len(own) - 1)
        hit = np.flatnonzero((own[at] == other) & (own < other))
        for x, y in ((first, first), (second, first), (first, second)):
            left.append(x[hit])
            right.append(y[at[hit]])
    a, b = prints[np.concatenate(left)], prints[np.concatenate(right)]
    good = (np.bitwise_count(a ^ b) <= RADIUS) & (a != b)
    return a[good], b[good]


def links(prints: DataFrame) -> DataFrame:
    """(a, b) pairs of fingerprints within the radius that connect all such pairs."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(key, block, same, own) -> pa.RecordBatch:
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
            size = ends - starts
            two = starts[size == 2]
            near = np.bitwise_count(own[two] ^ own[two + 1]) <= RADIUS
            a, b = [own[two][near]], [own[two + 1][near]]
            for i in np.flatnonzero(size > 2).tolist():
                s, e = int(starts[i]), int(ends[i])
                x, y = _forest(own[s:e]) if e - s <= DENSE else _dense(own[s:e], int(block[s]), bool(same[s]))
                a.append(x)
                b.append(y)
            a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        held: list[np.ndarray] | None = None  # the last key may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [np.asarray(batch.column(0)), np.asarray(batch.column(1)),
                   batch.column(2).to_numpy(zero_copy_only=False), np.asarray(batch.column(3)).view(np.uint64)]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            last = int(np.searchsorted(now[0], now[0][-1]))
            held = [x[last:] for x in now]
            if last:
                yield close(*(x[:last] for x in now))
        if held is not None:
            yield close(*held)

    met = variants(prints).repartition("key").sortWithinPartitions("key")
    return met.mapInArrow(meet, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, print (signed long) and component_id, the smallest id linked to it over any number of steps.

    ``root`` names the component by a fingerprint, ``text_hash`` tells rows of one id apart.
    """
    prints = stored(fingerprints(docs), "simhash-prints")
    unique = stored(prints.groupBy("print").agg(F.min(ordered_id(F.col("doc_id"))).alias("least")), "simhash-unique")
    roots = components(links(unique.select("print")))
    rooted = unique.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "least", F.coalesce("root", "print").alias("root"))
    rooted = stored(rooted, "simhash-roots")
    numbers = stored(rooted.groupBy("root").agg(F.min("least").alias("component")), "simhash-components")
    classes = stored(rooted.join(numbers, "root").select("print", "root", "component"), "simhash-classes")
    return prints.join(classes, "print").select(
        "doc_id", "print", F.nullif(F.col("component"), F.lit(2**63 - 1)).alias("component_id"), "root", "text_hash")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component: the smallest id, of rows without an id the first in order of a text hash."""
    least = F.min(F.struct(ordered_id(F.col("doc_id")).alias("id"), F.col("text_hash").alias("hash"))).alias("keep")
    keep = near_duplicates(docs).groupBy("root").agg(least).select("keep.id", "keep.hash")
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", ordered_id(F.col("row.doc_id")).alias("id"), F.xxhash64("row.text").alias("hash"))
    kept = rows.join(keep, ["id", "hash"]).dropDuplicates(["id", "hash"])
    return kept.select([F.col("row")[c].alias(c) for c in docs.columns])
