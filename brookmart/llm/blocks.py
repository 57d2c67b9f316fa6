"""Columns of whole numbers as compressed blocks, for rows that move many small numbers at once."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(*columns: np.ndarray) -> bytes:
    """Byte planes as narrow as each column allows, zstd-compressed; numbers from 0 on, columns of any lengths."""
    head, planes = [len(columns)], []
    for column in columns:
        c = np.ascontiguousarray(column, "<u8")
        width = max(1, (int(c.max()).bit_length() + 7) // 8) if len(c) else 1
        head += [len(c), width]
        planes.append(np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(np.array(head, "<u8").tobytes() + b"".join(planes))


def unpack(block: bytes) -> list[np.ndarray]:
    """The columns of ``pack`` as 64-bit numbers."""
    raw = zstandard.ZstdDecompressor().decompress(block)
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    at, out = 8 + 16 * n, []
    for size, width in np.frombuffer(raw, "<u8", 2 * n, 8).reshape(n, 2).tolist():
        whole = np.zeros((size, 8), np.uint8)
        whole[:, :width] = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size).T
        out.append(whole.view("<u8")[:, 0].astype(np.int64))
        at += size * width
    return out


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges ``starts`` .. ``starts + lengths`` of ``flat``, one after the other."""
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


def starts_of(sorted_keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.zeros(0, np.int64)
