"""SentencePiece encoding and decoding with the place of every piece in the original bytes.

A text is normalised by longest prefixes of the model's compiled character map (a double-array trie over UTF-8 bytes followed
by the replacements), and every normalised character records the original byte it came from. The normalised text is cut
before runs of the space mark where no piece of the vocabulary can reach across; distinct chunks are encoded once by the
library, with its own normalisation switched off, and a piece's bytes are projected through the recorded alignment. Byte pieces of
one character share its span: the last has it, those before are empty at its start, as in the library's own offsets.

Nothing moves between tasks; texts are encoded where they are read, in slices of bounded bytes, and a worker keeps a bounded
number of chunks.

Defined results: a null text counts as empty, an empty text is the end id alone and decodes to an empty text; equal rows each
get their own result; a null id stays null; other columns take no part.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.blocks import gathered
from brookmart.llm.tokens import slices

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
SLICE_BYTES = 1 << 20
KEPT_CHUNKS = 300_000
CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# fixed values: field numbers and piece types of the public model format
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MODEL_TYPE, SUFFIX_SPACE, BYTE_FALLBACK, BPE = 3, 24, 35, 2
NAME, CHARSMAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 1, 2, 3, 4, 5


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffers message: numbers as they are, the rest as bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        field, kind = divmod(number(), 8)
        size = {1: 8, 5: 4}.get(kind)
        if kind == 0:
            yield field, number()
            continue
        if size is None:
            size = number()
        yield field, data[at:at + size]
        at += size


def _message(field: int, data: bytes) -> bytes:
    size, out = len(data), bytearray([field * 8 + 2])
    while size > 127:
        out.append(size & 127 | 128)
        size >>= 7
    return bytes(out + bytes([size]) + data)


def character_map(blob: bytes) -> dict[str, str]:
    """What a compiled character map replaces: its trie unfolded level by level."""
    if not blob:
        return {}
    size = int(np.frombuffer(blob, "<u4", 1)[0])
    units = np.frombuffer(blob, "<u4", size // 4, 4)
    texts = blob[4 + size:]
    out: dict[str, str] = {}

    def below(unit: np.ndarray) -> np.ndarray:
        return (unit >> np.uint32(10)) << ((unit & np.uint32(1 << 9)) >> np.uint32(6))

    nodes, keys = below(units[:1]), [b""]
    labels = np.arange(1, 256, dtype=np.uint32)
    while len(nodes):
        child = nodes[:, None] ^ labels
        inside = child < len(units)
        unit = units[np.where(inside, child, 0)]
        row, label = np.nonzero(inside & ((unit & np.uint32(0x800000FF)) == labels))
        unit = unit[row, label]
        nodes = child[row, label] ^ below(unit)
        keys = [keys[r] + bytes([x + 1]) for r, x in zip(row.tolist(), label.tolist())]
        leaf = np.flatnonzero(unit >> np.uint32(8) & np.uint32(1))
        for i, value in zip(leaf.tolist(), (units[nodes[leaf]] & np.uint32(0x7FFFFFFF)).tolist()):
            out[keys[i].decode()] = texts[value:texts.index(b"\0", value)].decode()
    return out


class Normaliser:
    """Longest-prefix replacement with alignment, space rules included."""

    def __init__(self, replaced: dict[str, str], kept: list[str], dummy: bool = True, remove_extra: bool = True, escape: bool = True):
        """``kept`` are symbols that stand as they are, before any replacement."""
        if any("  " in x for x in replaced.values()):
            raise ValueError("replacements with several spaces in a row are not supported")
        self.dummy, self.remove_extra, self.escape = dummy, remove_extra, escape
        rules = replaced | {x: x for x in kept}
        self.rules, self.kept = rules, set(kept)
        self.longest: dict[str, list[int]] = {}
        for key in rules:
            self.longest.setdefault(key[0], []).append(len(key))
        for sizes in self.longest.values():
            sizes.sort(reverse=True)
        self.find = re.compile("[" + "".join(map(re.escape, sorted(self.longest))) + "]") if rules else None

    def _match(self, text: str, at: int) -> int:
        sizes = self.longest[text[at]]
        for size in sizes:
            if text[at:at + size] in self.kept:
                return size
        return next((size for size in sizes if text[at:at + size] in self.rules), 0)

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and the original byte of each of its characters and of its end."""
        if not text:
            return "", np.zeros(1, np.int64)
        wide = np.frombuffer(text.encode("utf-32-le"), "<u4")
        offsets = np.concatenate([[0], np.cumsum(1 + (wide > 0x7F) + (wide > 0x7FF) + (wide > 0xFFFF))])
        out, origin = text, np.arange(len(text))
        if self.find is not None:
            parts, sources, done, at = [], [], 0, 0
            while (hit := self.find.search(text, at)) is not None:
                at = hit.start()
                size = self._match(text, at)
                if not size:
                    at += 1
                    continue
                new = self.rules[text[at:at + size]]
                parts += [text[done:at], new]
                sources += [np.arange(done, at), np.full(len(new), at)]
                done = at = at + size
            parts.append(text[done:])
            sources.append(np.arange(done, len(text)))
            out, origin = "".join(parts), np.concatenate(sources)
        end = len(text)
        if self.remove_extra:
            wide = np.frombuffer(out.encode("utf-32-le"), "<u4")
            space = wide == 32
            kept = np.flatnonzero(~(space & np.concatenate([[True], space[:-1]])))
            if len(kept) and space[kept[-1]]:  # a space at the end goes too
                end, kept = origin[kept[-1]], kept[:-1]
            if not len(kept):
                return "", np.zeros(1, np.int64)
            out, origin = wide[kept].tobytes().decode("utf-32-le"), origin[kept]
        source = offsets[np.append(origin, end)]
        if self.dummy:
            out, source = " " + out, np.append(source[0], source)
        return out.replace(" ", SPACE) if self.escape else out, source


class PieceModel:
    """One model: normaliser, library encoder for normalised chunks with a cache, and decoder."""

    def __init__(self, path: str):
        import sentencepiece

        raw = open(path, "rb").read()
        trainer, normal, pieces, rest = {}, {}, [], b""
        for field, value in fields(raw):
            if field == PIECES:
                d = dict(fields(value))
                pieces.append((d[1].decode(), d.get(3, NORMAL)))
            elif field == TRAINER:
                trainer = dict(fields(value))
            elif field == NORMALIZER:
                normal = dict(fields(value))
            if field != NORMALIZER:
                rest += _message(field, value)
        if trainer.get(SUFFIX_SPACE):
            raise ValueError("models with the space mark at word ends are not supported")
        if trainer.get(MODEL_TYPE) != BPE or not trainer.get(BYTE_FALLBACK):
            raise ValueError("only BPE models with byte pieces are supported: others have pieces without bytes of their own")
        self.replaced = character_map(normal.get(CHARSMAP, b""))
        own = [text for text, kind in pieces if kind == USER_DEFINED]
        self.normalise = Normaliser(self.replaced, own, bool(normal.get(DUMMY_PREFIX, 1)), bool(normal.get(REMOVE_EXTRA, 1)), bool(normal.get(ESCAPE, 1)))
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end = self.library.eos_id()
        # the same vocabulary without any normalisation
        plain = _message(NAME, b"identity") + bytes([DUMMY_PREFIX * 8, 0, REMOVE_EXTRA * 8, 0, ESCAPE * 8, 0])
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=rest + _message(NORMALIZER, plain))
        usable = [text for text, kind in pieces if kind in (NORMAL, USER_DEFINED, UNUSED)]
        #: whether no piece reaches from a character into a following space mark
        self.divisible = bool(normal.get(ESCAPE, 1)) and not any(SPACE in x.lstrip(SPACE) or " " in x for x in usable)
        #: whether texts reach the encoder as they are, a space mark before them
        self.plain = not self.replaced and not own and self.normalise.dummy and not self.normalise.remove_extra and self.normalise.escape
        self.bytes_of = [b"" if kind in (UNKNOWN, CONTROL) else bytes([int(text[3:5], 16)]) if kind == BYTE else text.encode() for text, kind in pieces]
        self.sizes = np.array([len(x) for x in self.bytes_of], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 14, np.int64)

    def _learn(self, chunks: list[str]) -> None:
        ids = self.segmenter.encode(chunks, num_threads=1)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        new = np.fromiter((x for e in ids for x in e), np.int32, int(lengths.sum()))
        n, end = len(self.known), self.ends[len(self.known)]
        while end + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(ids) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[end:end + len(new)] = new
        self.ends[n + 1:n + 1 + len(ids)] = end + np.cumsum(lengths)
        self.known.update(zip(chunks, range(n, n + len(ids))))

    def pieces(self, normalised: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of normalised texts, and the number of ids of each."""
        cut = [CHUNK.findall(x) for x in normalised] if self.divisible else [[x] if x else [] for x in normalised]
        chunks = [c for x in cut for c in x]
        new = list({c for c in chunks if c not in self.known})
        if len(self.known) + len(new) > KEPT_CHUNKS:
            self._forget()
            new = list(set(chunks))
        if new:
            self._learn(new)
        where = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        lengths = self.ends[where + 1] - self.ends[where]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return gathered(self.flat, self.ends[where], lengths), np.diff(ends[np.cumsum([0, *map(len, cut)])])

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids without the end id, and where the bytes of each piece begin and end in the text."""
        both = [self.normalise(t) for t in texts]
        ids, counts = self.pieces([x for x, _ in both])
        ends = np.cumsum(counts)
        for (normalised, source), end, n in zip(both, ends.tolist(), counts.tolist()):
            own = ids[end - n:end]
            data = np.frombuffer(normalised.encode(), np.uint8)
            chars = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))
            done = np.cumsum(self.sizes[own])
            if n and done[-1] != len(data):
                raise ValueError("pieces and text differ in length")
            stop = source[np.searchsorted(chars, done, side="right") - 1]
            yield own, np.append(source[:1], stop[:-1])[:n], stop


@functools.lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    """One per worker process."""
    return PieceModel(path)


ENCODED = "doc_id long, ids array<int>, starts array<int>, stops array<int>, decoded string"


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).astype(np.int32)))


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row: doc_id, all ids with the end id last, the original byte span of each piece (the end id: empty at the end), decoded text."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
                ids, starts, stops = [], [], []
                for text, (i, x, y) in zip(texts, own.encode(texts)):
                    size = len(text.encode())
                    ids.append(np.append(i, own.end))
                    starts.append(np.append(x, size))
                    stops.append(np.append(y, size))
                decoded = own.library.decode([i.tolist() for i in ids], num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), _lists(ids), _lists(starts), _lists(stops), pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "starts", "stops", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ENCODED)
