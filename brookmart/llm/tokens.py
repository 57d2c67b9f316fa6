"""Token ids of whole texts by a public tokenizer, with a cache of white-space separated chunks.

The tokenizer drops white space and never joins what it separates, so a text's ids are the ids of its chunks in order. Each
distinct chunk is encoded once per worker process, and one of ASCII letters with or without signs behind them, which the tokenizer
neither changes nor cuts but before the signs, goes to its merges without the steps before them. Texts that name a special token are encoded whole, because special tokens
are found before lower-casing.
"""

from __future__ import annotations

import functools
import os
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "word_bpe_49k.json"
SLICE_BYTES = 4 << 20
KEPT_CHUNKS = 500_000
SEPARATOR = "\x01"
JOINED, AT_ONCE = 500, 20  # chunks of a joined text, and texts handed to the tokenizer at once
SIGNS = string.punctuation.replace("'", "")
PLAIN = re.compile(f"([a-z]+)([{re.escape(SIGNS)}]*)")
END = 0


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class ChunkTokenizer:
    """Ids of many texts at once; memory is bounded by the cache, which starts anew when it is full."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        cut = self._ids([SEPARATOR])[0]
        if len(cut) != 1:
            raise ValueError("the tokenizer has no id of its own for the separator")
        self.cut = cut[0]
        self.model = self.tokenizer.model
        self.direct = self._leaves_plain()
        self._forget()

    def _leaves_plain(self) -> bool:
        """Whether the steps before the merges leave lower-case letters and signs as they are and cut only between the two."""
        normal, cut, probe = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, string.ascii_lowercase + SIGNS
        if cut is None or normal is not None and normal.normalize_str(probe) != probe:
            return False
        return [part for part, _ in cut.pre_tokenize_str(probe)] == [string.ascii_lowercase, SIGNS] and self.tokenizer.post_processor is None

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)  # ends[i + 1]: end of chunk i in flat

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _direct(self, chunks: list[str]) -> tuple[list[str], list[int], list[int], list[str]]:
        """Chunks that go straight to the merges, their ids and numbers of ids, and the other chunks."""
        if not self.direct:
            return [], [], [], chunks
        tokens, match = self.model.tokenize, PLAIN.fullmatch
        words, ids, lengths, others = [], [], [], []
        for c in chunks:
            if (m := match(c)) is None:
                others.append(c)
                continue
            word, signs = m.groups()
            own = [t.id for t in tokens(word)]
            if signs:
                own += [t.id for t in tokens(signs)]
            words.append(c)
            ids += own
            lengths.append(len(own))
        return words, ids, lengths, others

    def _learn(self, chunks: list[str]) -> None:
        words, ids, lengths, others = self._direct(chunks)
        self._keep(words, np.array(ids, np.uint32), np.array(lengths, np.int64))
        plain = [c for c in others if SEPARATOR not in c]
        odd = [c for c in others if SEPARATOR in c]
        for a in range(0, len(plain), JOINED * AT_ONCE):
            some = plain[a:a + JOINED * AT_ONCE]
            joined = [f" {SEPARATOR} ".join([*some[i:i + JOINED], ""]) for i in range(0, len(some), JOINED)]
            ids = np.array([x for e in self._ids(joined) for x in e], np.uint32)
            at = np.flatnonzero(ids == self.cut)
            if len(at) != len(some):
                raise ValueError("chunks and separators do not match")
            self._keep(some, ids[ids != self.cut], np.diff(at, prepend=-1) - 1)
        if odd:
            more = self._ids(odd)
            self._keep(odd, np.array([i for x in more for i in x], np.uint32), np.array([len(x) for x in more], np.int64))

    def _keep(self, chunks: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, end = len(self.known), self.ends[len(self.known)]
        while end + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(lengths) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[end:end + len(ids)] = ids
        self.ends[n + 1:n + 1 + len(lengths)] = end + np.cumsum(lengths)
        self.known.update(zip(chunks, range(n, n + len(lengths))))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each text (null: none); no text may name a special token."""
        texts = pc.ascii_lower(pc.fill_null(texts, ""))
        words = pc.ascii_split_whitespace(texts)
        per_text = np.asarray(pc.list_value_length(words))
        coded = words.flatten().dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        known = self.known
        if len(known) + len(chunks) > KEPT_CHUNKS:
            self._forget()
            known = self.known
        new = [c for c in chunks if c not in known]
        if new:
            self._learn(new)
        where = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))[np.asarray(coded.indices)]
        starts, lengths = self.ends[where], self.ends[where + 1] - self.ends[where]
        before = np.cumsum(lengths) - lengths
        ids = self.flat[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]
        total, ends = np.append(0, np.cumsum(lengths)), np.cumsum(per_text)
        return ids, total[ends] - total[ends - per_text]

    def _whole(self, texts: pa.Array) -> np.ndarray:
        """Which texts name a special token, in whatever case."""
        lower, found = pc.ascii_lower(pc.fill_null(texts, "")), np.zeros(len(texts), bool)
        for name in self.special:
            found |= np.asarray(pc.match_substring(lower, name))
        return found

    def encode_all(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``encode`` over slices of bounded bytes: (first row, end row, ids, lengths)."""
        for a, b in slices(texts):
            whole = self._whole(texts.slice(a, b - a))
            for i, j in zip(*_runs(whole)):
                part = texts.slice(a + i, j - i)
                if whole[i]:
                    each = self._ids([t or "" for t in part.to_pylist()])
                    yield a + i, a + j, np.array([x for e in each for x in e], np.uint32), np.array([len(e) for e in each], np.int64)
                else:
                    yield a + i, a + j, *self.encode(part)


def _runs(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs of equal flags."""
    cuts = (np.flatnonzero(flags[1:] != flags[:-1]) + 1).tolist()
    return [0, *cuts], [*cuts, len(flags)]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    total, a = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            yield a, i
            total, a = 0, i
        total += n
    if a < len(sizes):
        yield a, len(sizes)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and the length of each (null: none)."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and ends[-1] else np.zeros(0, np.uint8)
    return data[ends[0]:ends[-1]], np.diff(ends)


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> ChunkTokenizer:
    """One per worker process."""
    return ChunkTokenizer(path)
