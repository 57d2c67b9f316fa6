"""Training-order materialisation: token sequences in permuted order as fixed-stride binary shards.

Texts become token ids plus an end id, laid end to end as they are read and cut every ``length`` ids; the token table that
holds these sequences is written once and fixes their numbers. A keyed Feistel network over the next power of four, walked
until it lands below the number of sequences, sends number to slot. Shard ``k`` holds slots ``k * per_shard`` onwards, each
record ``2 * length`` bytes, so slot ``s`` is found by one seek and a reader resumes at any slot.

What moves: the ids once, as compressed blocks of records for one shard each. A shard is put together in one task, from at
most ``per_shard`` records. Files are written under another name and then moved, so that a repeated task replaces its own.

Defined results: a null or empty text is the end id alone; a null id stays null; rows that repeat are laid down as often as
they occur; other columns take no part; without documents there are no shards. Which documents share a sequence follows the
order in which the input is read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookmart.llm.common import stored
from brookmart.llm.tokens import END, default_path, tokenizer
from brookmart.session import fresh_dir

LENGTH = 2048
PER_SHARD = 2048
ROUNDS = 6
SPANS = "array<struct<doc_id: long, start: long, at: int, length: int>>"
SPAN = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("at", pa.int32()), ("length", pa.int32())]))


def _scrambled(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: shifts and odd multipliers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """A bijection of 0 to n - 1 onto itself."""
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = _scrambled(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (_scrambled(right + k) & mask)
        return left << half | right

    out = once(numbers.astype(np.uint64))
    while (beyond := np.flatnonzero(out >= n)).size:
        out[beyond] = once(out[beyond])
    return out.astype(np.int64)


def sequences(docs: DataFrame, length: int = LENGTH, path: str | None = None) -> DataFrame:
    """One row per sequence: part, nth (its number within the part), n_tokens, spans of documents, ids."""
    path = path or default_path()

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, nth = tokenizer(path), TaskContext.get().partitionId(), 0
        rest = np.zeros(0, "<u2")
        spans: list[tuple] = []  # (doc_id, start within the document, length) of what rest holds

        def cut(ids: np.ndarray, spans: list[tuple], last: bool) -> tuple[pa.RecordBatch, np.ndarray, list[tuple]]:
            nonlocal nth
            whole = -(-len(ids) // length) if last else len(ids) // length
            listed: list[list[tuple]] = [[] for _ in range(whole + 1)]
            k, at = 0, 0
            for doc, start, size in spans:
                while size:
                    if k == whole:
                        listed[whole].append((doc, start, size))
                        break
                    take = min(size, length - at)
                    listed[k].append((doc, start, at, take))
                    start, size, at = start + take, size - take, at + take
                    if at == length:
                        k, at = k + 1, 0
            records = [ids[i * length:(i + 1) * length] for i in range(whole)]
            names = ("doc_id", "start", "at", "length")
            batch = pa.RecordBatch.from_arrays([
                pa.array([part] * whole, pa.int32()), pa.array(range(nth, nth + whole), pa.int64()),
                pa.array([len(r) for r in records], pa.int32()),
                pa.array([[dict(zip(names, s)) for s in own] for own in listed[:whole]], SPAN),
                pa.array([r.tobytes() for r in records], pa.binary())], ["part", "nth", "n_tokens", "spans", "ids"])
            nth += whole
            return batch, ids[whole * length:].copy(), listed[whole]

        for batch in batches:
            names = batch.column(0).to_pylist()
            for a, _, ids, counts in encoder.encode_all(batch.column(1)):
                ends = np.cumsum(counts)
                laid = np.insert(ids.astype("<u2"), ends, np.uint16(END))  # ids fit 16 bits, checked below
                if ids.size and int(ids.max()) > 65535:
                    raise ValueError("ids need more than 16 bits")
                spans += [(names[a + i], 0, n + 1) for i, n in enumerate(counts.tolist())]
                made, rest, spans = cut(np.concatenate([rest, laid]), spans, False)
                yield made
        made, _, _ = cut(rest, spans, True)
        yield made

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lay, f"part int, nth long, n_tokens int, spans {SPANS}, ids binary")


def shard_file(root: str, shard: int) -> str:
    return f"{root.rstrip('/')}/shard-{shard:08d}.bin"


def materialise(docs: DataFrame, root: str, key: int = 20, length: int = LENGTH, per_shard: int = PER_SHARD,
                path: str | None = None) -> DataFrame:
    """Write the shards below ``root``; one row per sequence: slot, shard, place, n_tokens, ids_crc32, spans."""
    made = stored(sequences(docs, length, path), "token-sequences")
    before = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per task that read the input
    firsts = stored(made.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(Window.partitionBy()).alias("total")),
        "sequence-numbers")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            if not batch.num_rows:
                continue
            total = batch.column("total")[0].as_py()
            slots = permuted(np.asarray(batch.column("number")), total, key)
            order = np.argsort(slots, kind="stable")
            shards = slots[order] // per_shard
            ids, spans, sizes = batch.column("ids"), batch.column("spans"), np.asarray(batch.column("n_tokens"))
            out: dict[str, list] = {"shard": [], "slots": [], "sizes": [], "spans": [], "block": []}
            for own in np.split(order, np.flatnonzero(np.diff(shards)) + 1):
                out["shard"].append(int(slots[own[0]]) // per_shard)
                out["slots"].append(slots[own])
                out["sizes"].append(sizes[own])
                out["spans"].append(spans.take(pa.array(own)).to_pylist())
                out["block"].append(press.compress(b"".join(ids[int(i)].as_py().ljust(2 * length, b"\0") for i in own)))
            yield pa.RecordBatch.from_arrays([
                pa.array(out["shard"], pa.int64()), pa.array(out["slots"], pa.list_(pa.int64())), pa.array(out["sizes"], pa.list_(pa.int32())),
                pa.array(out["spans"], pa.list_(SPAN)), pa.array(out["block"], pa.binary())], list(out))

    def write(group: pa.Table) -> pa.Table:
        opened = zstandard.ZstdDecompressor()
        shard, stride = group.column("shard")[0].as_py(), 2 * length
        slots = np.array([s for x in group.column("slots").to_pylist() for s in x], np.int64)
        sizes = [s for x in group.column("sizes").to_pylist() for s in x]
        spans = [s for x in group.column("spans").to_pylist() for s in x]
        data = b"".join(opened.decompress(x.as_py()) for x in group.column("block"))
        order = np.argsort(slots)
        fs, place = pafs.FileSystem.from_uri(shard_file(root, shard))
        attempt = f"{place}.{TaskContext.get().taskAttemptId()}.tmp"
        fs.create_dir(place.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(attempt) as out:
            for i in order.tolist():
                out.write(data[i * stride:(i + 1) * stride])
        fs.move(attempt, place)
        return pa.table({
            "slot": pa.array(slots[order]), "shard": pa.array([shard] * len(slots), pa.int64()),
            "place": pa.array(slots[order] % per_shard), "n_tokens": pa.array([sizes[i] for i in order], pa.int32()),
            "ids_crc32": pa.array([zlib.crc32(data[i * stride:i * stride + 2 * sizes[i]]) for i in order], pa.int64()),
            "spans": pa.array([spans[i] for i in order], SPAN)})

    numbered = made.join(firsts, "part").select((F.col("first") + F.col("nth")).alias("number"), "total", "n_tokens", "spans", "ids")
    packed = numbered.mapInArrow(blocks, f"shard long, slots array<long>, sizes array<int>, spans array<{SPANS}>, block binary")
    return packed.groupBy("shard").applyInArrow(
        write, f"slot long, shard long, place long, n_tokens int, ids_crc32 long, spans {SPANS}")


def read_slots(root: str, slot: int, length: int = LENGTH, per_shard: int = PER_SHARD) -> Iterator[np.ndarray]:
    """The ids of each slot from ``slot`` on: sequential reads after one seek. Only the last sequence of a part is padded."""
    while True:
        fs, place = pafs.FileSystem.from_uri(shard_file(root, slot // per_shard))
        if fs.get_file_info(place).type == pafs.FileType.NotFound:
            return
        with fs.open_input_file(place) as shard:
            shard.seek(slot % per_shard * 2 * length)
            while record := shard.read(2 * length):
                yield np.frombuffer(record, "<u2")
                slot += 1
        if slot % per_shard:
            return


def materialised(docs: DataFrame, **options) -> DataFrame:
    """``materialise`` into a new folder below the shared one; the rows carry its name."""
    root = fresh_dir(docs.sparkSession, "training-order")
    if "://" not in root and not root.startswith("/"):
        raise ValueError(f"{root} is no absolute path")
    return materialise(docs, root, **options).withColumn("root", F.lit(root))
