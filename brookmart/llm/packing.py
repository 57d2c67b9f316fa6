"""Sum-of-squares packing of token pieces into sequences of a fixed length.

A piece goes where the sum of the squared counts of open sequences per residual gap becomes smallest, a new sequence
included; ties go to the tightest gap. Long pieces come first.

Texts are tokenised once, where they are read; only (id, start, length, checksum) of each piece moves on. Pieces are dealt
by hash, with their place in the written table, into groups of about ``GROUP`` pieces and every group packs by itself, so groups grow in number, not in size: the
open sequences left over are a few per group. Memory of a group: its pieces and one counter per gap.

Defined results: a null or empty text is the end id alone; equal rows are packed each for itself; other columns take no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import stored
from brookmart.llm.tokens import END, default_path, tokenizer

LENGTH = 2048
GROUP = 1 << 15
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, length: int = LENGTH, path: str | None = None) -> DataFrame:
    """Documents as token ids plus the end id, cut only where longer than ``length``."""
    path = path or default_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path)
        for batch in batches:
            names = batch.column(0)
            for a, b, ids, counts in encoder.encode_all(batch.column(1)):
                ends = np.cumsum(counts)
                row, piece, size, crc = [], [], [], []
                for i, (n, end) in enumerate(zip(counts.tolist(), ends.tolist())):
                    own = np.append(ids[end - n:end], np.uint32(END)).astype("<u4")
                    for k, at in enumerate(range(0, n + 1, length)):
                        part = own[at:at + length]
                        row.append(a + i)
                        piece.append(k)
                        size.append(len(part))
                        crc.append(zlib.crc32(part))
                piece = np.array(piece, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(row, pa.int64())), pa.array(piece), pa.array(piece.astype(np.int64) * length),
                     pa.array(size, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECE)


def pack_sizes(sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each size (1 to ``length``), longest first."""
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    count = np.zeros(length + 1, np.int64)  # open sequences by gap; those without a gap are closed and count nothing
    open_at: list[list[int]] = [[] for _ in range(length + 1)]
    made = 0
    far = np.iinfo(np.int64).max
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        best, gap = (2 * int(count[length - size]) + 1 if size < length else 0), length
        if size < length:
            fits = count[size:length]
            change = np.where(fits > 0, 2 * (count[:length - size] - fits + 1), far)
            change[0] -= fits[0] > 0  # a sequence that becomes full leaves one count only
            k = int(change.argmin())
            if change[k] <= best:
                best, gap = int(change[k]), size + k
        if gap == length:
            where[i], made = made, made + 1
        else:
            where[i] = open_at[gap].pop()
            count[gap] -= 1
            offset[i] = length - gap
        if gap > size:
            open_at[gap - size].append(int(where[i]))
            count[gap - size] += 1
    return where, offset


def pack(docs: DataFrame, length: int = LENGTH, path: str | None = None, group: int = GROUP) -> DataFrame:
    """Every piece with its sequence and its place there: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = stored(pieces(docs, length, path), "pack-pieces")
    groups = max(1, -(-cut.count() // group))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "ids_crc32"], ignore_index=True)
        where, offset = pack_sizes(pdf["length"].to_numpy(), length)
        return pdf.assign(sequence_id=where + (int(pdf["pack_group"].iloc[0]) << 40), offset=offset).drop(columns="pack_group")

    # the place in the written file tells equal rows apart
    dealt = cut.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "_metadata.row_index"), F.lit(groups)).cast("int"))
    return dealt.groupBy("pack_group").applyInPandas(one, f"{PIECE}, sequence_id long, offset long")
