"""Alignment of two tokenizers over the same texts, with corpus-wide counts of linked id pairs by external spill counting.

A byte-level vocabulary (A) and a sentence-piece vocabulary (B) both tile the bytes of space+text. Where a token of each ends a
group ends; tokens whose bytes overlap are linked. Before a single space between two printable characters both always end a token,
so texts are cut there and each distinct chunk is encoded and aligned once per worker; a text is the sum of its chunks.

Counting: a run is what one task read, up to ``RUN`` bytes. Its (pair, document) records, already added up, are dealt by the
B id's residue into ``PARTS`` radix parts, ordered B id first, and written as zstd blocks of a stored table. Parts above
``TARGET`` bytes are split by run, so a B id with a third of all links is spread. Per part and split a k-way heap merge of the runs
adds up the pairs; the splits' sums meet in an aggregate, in which a pair has one row per split. As pairs
are ordered by B id, a B id's maximum is one more aggregate over its pairs, at most one row per B id. The blocks are read
once more to stream every record's contribution back to its run, whose documents add them up by position, so rows that share
an id, or have none, never meet.

Defined results: null and empty texts, and texts whose tokens do not give back space+text (say, with a space mark in them), have
no tokens: zeros and an empty digest; repeated rows count as often as they stand there; special tokens' strings are plain
text; other columns take no part.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.blocks import gathered, pack, starts_of, unpack
from brookmart.llm.common import stored
from brookmart.llm.pieces import PieceModel, SPACE, model_path
from brookmart.llm.tokens import slices

BYTE_MODEL = "byte_bpe_50k.json"
RUN = 8 << 20
SLICE_BYTES = 1 << 20
PARTS = 64
TARGET = 16 << 20  # compressed bytes of records merged in one group
FRAME = 1 << 14
KEPT_CHUNKS = 300_000
JOINED = 512
# no white space, control or format character under anybody's definition, and not the space mark
SOLID = rf"[^\x00-\x20\x7f-\xa0\xad\u0600-\u0605\u061c\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff{SPACE}]"
CUT = re.compile(rf"(?<={SOLID}) (?={SOLID})")
DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
RUNS = f"run long, part int, heads binary, records binary, docs array<struct<{DOC.replace(' ', ': ').replace(',:', ',')}>>"
RESULT = f"{DOC}, n_best long, count_sum long"


def byte_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(BYTE_MODEL)


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: bytes that print stand for themselves, the others follow from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both encoders and the aligned chunks seen so far."""

    def __init__(self, bytes_file: str, pieces_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(bytes_file)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        self.width = self.a.get_vocab_size()
        self.a_bytes = [b""] * self.width
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        own = PieceModel(pieces_file)
        self.b, self.divisible = own.library, own.divisible and own.plain
        self.b_bytes = [x.replace(SPACE.encode(), b" ") for x in own.bytes_of]
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.written = np.array([f"{i}{mark}" for i in range(self.width) for mark in ",|"] + [
            f"{i}{mark}" for i in range(len(self.b_sizes)) for mark in ",;"], object)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str | None] = []  # None: the tokens do not give the text back
        self.stats = np.zeros((1 << 14, 4), np.int64)  # n_a, n_b, n_groups, n_links
        self.flat = np.zeros(1 << 16, np.int64)  # linked pairs
        self.ends = np.zeros((1 << 14) + 1, np.int64)

    def _ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of both sides for parts that follow each other after single spaces."""
        text = " ".join(parts)
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        return np.array(a, np.int64), np.array(self.b.encode(text), np.int64)

    def aligned(self, parts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray] | None:
        """Group strings (a semicolon after each group), stats, pairs and pair counts of parts that follow each other; None if bytes are not given back."""
        a, b = self._ids(parts)
        raw = [(" " + p).encode() for p in parts]
        want = b"".join(raw)
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != want or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != want:
            return None
        stops = np.cumsum([len(x) for x in raw])
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        merged_ends = np.sort(np.concatenate([a_end, b_end]))
        ends = merged_ends[starts_of(merged_ends)]  # one link ends at each
        both = merged_ends[1:][merged_ends[1:] == merged_ends[:-1]]
        if not np.isin(stops, both).all():
            return None
        link_a, link_b = np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)
        pairs = b[link_b] * self.width + a[link_a]
        n = [np.diff(np.searchsorted(x, stops, side="right"), prepend=0) for x in (a_end, b_end, both, ends)]
        group_a, group_b = np.searchsorted(both, a_end), np.searchsorted(both, b_end)
        # each token's decimal id with what follows it: the table holds "id," "id|" of A, then "id," "id;" of B
        index = np.concatenate([2 * a + (both[group_a] == a_end), 2 * (self.width + b) + (both[group_b] == b_end)])
        items = self.written[index[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")]].tolist()
        of_chunk = np.cumsum([0, *(n[0] + n[1]).tolist()]).tolist()
        return ["".join(items[x:y]) for x, y in zip(of_chunk, of_chunk[1:])], np.stack(n, axis=1), pairs, n[3]

    def _learn(self, chunks: list[str]) -> None:
        for at in range(0, len(chunks), JOINED):
            parts = chunks[at:at + JOINED]
            found = self.aligned(parts)
            if found is None:  # somewhere in there
                each = [self.aligned([p]) for p in parts]
                found = ([e[0][0] if e else None for e in each], np.stack([e[1][0] if e else np.zeros(4, np.int64) for e in each]),
                         np.concatenate([e[2] if e else np.zeros(0, np.int64) for e in each]), np.array([len(e[2]) if e else 0 for e in each]))
            groups, stats, pairs, counts = found
            n, end = len(self.groups), self.ends[len(self.groups)]
            while end + len(pairs) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            while n + len(parts) + 1 > len(self.stats):
                self.stats = np.concatenate([self.stats, np.zeros_like(self.stats)])
                self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            self.flat[end:end + len(pairs)] = pairs
            self.stats[n:n + len(parts)] = stats
            self.ends[n + 1:n + 1 + len(parts)] = end + np.cumsum(counts)
            self.known.update(zip(parts, range(n, n + len(parts))))
            self.groups += groups

    def texts(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Stats and group digest of each text, its linked pairs (flat) and their number."""
        cut = [(CUT.split(t) if self.divisible else [t]) if t else [] for t in texts]
        chunks = [c for x in cut for c in x]
        new = list({c for c in chunks if c not in self.known})
        if len(self.known) + len(new) > KEPT_CHUNKS:
            self._forget()
            new = list(set(chunks))
        # chunks that start or end with white space do not follow others
        loose = [c for c in new if not c or not SOLID_ENDS(c)]
        self._learn([c for c in new if c and SOLID_ENDS(c)])
        for c in loose:
            self._learn([c])
        where = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        ends = np.cumsum(sizes)
        groups = [self.groups[i] for i in where.tolist()]
        stats = np.zeros((len(texts), 4), np.int64)
        np.add.at(stats, np.repeat(np.arange(len(texts)), sizes), self.stats[where])
        digests, own_pairs = [], {}
        for i, (end, n) in enumerate(zip(ends.tolist(), sizes.tolist())):
            own = groups[end - n:end]
            if None in own:  # a chunk is not given back; the text as one chunk decides
                found = self.aligned([texts[i]])
                own = found[0] if found else []
                stats[i] = found[1][0] if found else 0
                own_pairs[i] = found[2] if found else np.zeros(0, np.int64)
            digests.append(hashlib.sha256("".join(own)[:-1].encode()).hexdigest() if own else "")
        lengths = self.ends[where + 1] - self.ends[where]
        pairs = gathered(self.flat, self.ends[where], lengths)
        if own_pairs:
            parts = np.split(pairs, np.concatenate([[0], np.cumsum(lengths)])[ends][:-1])
            pairs = np.concatenate([own_pairs.get(i, x) for i, x in enumerate(parts)])
        return stats, digests, pairs, stats[:, 3]


SOLID_ENDS = re.compile(rf"(?s:{SOLID}.*{SOLID}|{SOLID})").fullmatch


@functools.lru_cache(maxsize=2)
def aligner(bytes_file: str, pieces_file: str) -> Aligner:
    """One per worker process."""
    return Aligner(bytes_file, pieces_file)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys with their values added up."""
    order = np.argsort(keys, kind="stable")
    first = starts_of(keys[order])
    return keys[order][first], *(np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values)


def runs(docs: DataFrame, bytes_file: str, pieces_file: str, parts: int = PARTS) -> DataFrame:
    """Per run a row with its documents (part -1) and one per radix part: pairs with their sum, and (pair, document) records."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(bytes_file, pieces_file)
        task, nth = TaskContext.get().partitionId(), 0
        held: list[dict] = []
        keys: list[np.ndarray] = []
        many: list[np.ndarray] = []
        total = 0

        def flush() -> pa.RecordBatch:
            nonlocal nth
            key, m = np.concatenate(keys), np.concatenate(many)
            pair, doc = np.divmod(key, 1 << 24)
            part = pair // own.width % parts
            order = np.lexsort((key, part))
            pair, doc, m, part = pair[order], doc[order], m[order], part[order]
            rows = {"run": [], "part": [], "heads": [], "records": [], "docs": []}
            cuts = np.searchsorted(part, np.arange(parts + 1)).tolist()
            for p, (x, y) in enumerate(zip(cuts, cuts[1:])):
                if x < y:
                    first = starts_of(pair[x:y])
                    rows["part"].append(p)
                    rows["heads"].append(pack(np.diff(pair[x:y][first], prepend=0), np.add.reduceat(m[x:y], first)))
                    rows["records"].append(pack(np.diff(np.append(first, y - x)), doc[x:y], m[x:y]))
                    rows["docs"].append(None)
            rows["part"].append(-1)
            rows["heads"].append(None)
            rows["records"].append(None)
            rows["docs"].append(held)
            rows["run"] = [task << 32 | nth] * len(rows["part"])
            nth += 1
            kinds = {"run": pa.int64(), "part": pa.int32(), "heads": pa.binary(), "records": pa.binary(), "docs": pa.list_(pa.struct(
                [(c.split()[0], pa.int64() if c.split()[1] == "long" else pa.string()) for c in DOC.split(", ")]))}
            return pa.RecordBatch.from_arrays([pa.array(rows[c], k) for c, k in kinds.items()], list(kinds))

        for batch in batches:
            for a, b in slices(batch.column(1), SLICE_BYTES):
                texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
                stats, digests, pairs, counts = own.texts(texts)
                names = batch.column(0).slice(a, b - a).to_pylist()
                doc = np.repeat(np.arange(len(held), len(held) + len(texts)), counts)
                key, m = _summed(pairs << 24 | doc, np.ones(len(pairs), np.int64))
                keys.append(key)
                many.append(m)
                held += [{"doc_id": i, "n_a": s[0], "n_b": s[1], "n_groups": s[2], "n_links": s[3], "groups_sha256": d}
                         for i, s, d in zip(names, stats.tolist(), digests)]
                total += sum(map(len, texts))
                if total >= RUN or len(held) >= 1 << 23:
                    yield flush()
                    held, keys, many, total = [], [], [], 0
        if held:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RUNS)


def merged(heads: list[tuple[np.ndarray, np.ndarray]], frame: int = FRAME) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """k-way heap merge of runs of (sorted pairs, sums), added up; memory beside the runs: a frame of each.

    The heap gives the frame that ends first; what all runs have up to there is complete and leaves in order.
    """
    at = [0] * len(heads)
    ends = [(int(pairs[min(frame, len(pairs)) - 1]), i) for i, (pairs, _) in enumerate(heads) if len(pairs)]
    heapq.heapify(ends)
    while ends:
        last, _ = ends[0]
        keys, sums = [], []
        for _, i in ends:
            pairs, m = heads[i]
            stop = at[i] + int(np.searchsorted(pairs[at[i]:at[i] + frame], last, side="right"))
            keys.append(pairs[at[i]:stop])
            sums.append(m[at[i]:stop])
            at[i] = stop
        yield _summed(np.concatenate(keys), np.concatenate(sums))
        while ends and ends[0][0] <= last:
            _, i = heapq.heappop(ends)
            pairs = heads[i][0]
            if at[i] < len(pairs):
                heapq.heappush(ends, (int(pairs[min(at[i] + frame, len(pairs)) - 1]), i))


def _counted(group: pa.Table) -> pa.Table:
    heads = []
    for block in group.column("heads").to_pylist():
        steps, m = unpack(block)
        heads.append((np.cumsum(steps), m))
    parts = [pa.table({"pair": pa.array(p), "m": pa.array(m)}) for p, m in merged(heads)]
    out = pa.concat_tables(parts)
    part, split = group.column("part")[0], group.column("split")[0]
    return out.add_column(0, "split", pa.array([split.as_py()] * len(out), pa.int64())).add_column(0, "part", pa.array([part.as_py()] * len(out), pa.int32()))


def _given_back(group: pa.Table, counts: pa.Table) -> pa.Table:
    """Per run: documents by position, the sum of their links' counts and the number of links with their B id's highest count."""
    order = np.argsort(np.asarray(counts.column("pair")))
    pairs, total = np.asarray(counts.column("pair"))[order], np.asarray(counts.column("total"))[order]
    best = np.asarray(counts.column("best"))[order].astype(np.int64)
    rows = []
    for run, heads, records in zip(group.column("run").to_pylist(), group.column("heads").to_pylist(), group.column("records").to_pylist()):
        steps, _ = unpack(heads)
        docs_of, doc, m = unpack(records)
        at = np.repeat(np.searchsorted(pairs, np.cumsum(steps)), docs_of)
        own, sums, bests = _summed(doc, m * total[at], m * best[at])
        rows.append((run, pack(own, sums, bests)))
    return pa.table({"run": pa.array([r for r, _ in rows], pa.int64()), "block": pa.array([b for _, b in rows], pa.binary())})


def _documents(group: pa.Table) -> pa.Table:
    docs, blocks = None, []
    for own, block in zip(group.column("docs"), group.column("block").to_pylist()):
        if block is None:
            docs = own.values
        else:
            blocks.append(block)
    sums, bests = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    for block in blocks:
        doc, s, b = unpack(block)
        sums[doc] += s
        bests[doc] += b
    columns = {c.split()[0]: docs.field(c.split()[0]) for c in DOC.split(", ")}
    return pa.table(columns | {"n_best": pa.array(bests), "count_sum": pa.array(sums)})


def aligned_counts(docs: DataFrame, bytes_file: str | None = None, pieces_file: str | None = None, parts: int = PARTS,
                   target: int = TARGET) -> tuple[DataFrame, DataFrame]:
    """Per row the counts of ``RESULT``; and the corpus-wide table (a, b, total, best) of linked id pairs."""
    from tokenizers import Tokenizer

    bytes_file = bytes_file or byte_path()
    width = Tokenizer.from_file(bytes_file).get_vocab_size()
    table = stored(runs(docs, bytes_file, pieces_file or model_path(), parts), "alignment-runs")
    spilled = table.where("part >= 0")
    sizes = spilled.groupBy("part").agg(F.ceil(F.sum(F.octet_length("records")) / target).alias("splits"))  # at most ``parts`` rows
    spilled = spilled.join(F.broadcast(sizes), "part").withColumn("split", F.pmod(F.xxhash64("run"), F.col("splits")))
    sums = stored(spilled.select("part", "split", "heads").groupBy("part", "split").applyInArrow(_counted, "part int, split long, pair long, m long"),
                  "alignment-sums")
    totals = stored(sums.groupBy("pair").agg(F.sum("m").alias("total")), "alignment-totals")
    b_id = F.floor(F.col("pair") / width).alias("b")
    most = totals.groupBy(b_id).agg(F.max("total").alias("most"))
    totals = totals.withColumn("b", b_id).join(most, "b").select("pair", "b", "total", (F.col("total") == F.col("most")).alias("best"))
    wanted = sums.join(totals, "pair").select("part", "split", "pair", "total", "best")
    back = spilled.select("part", "split", "run", "heads", "records").groupBy("part", "split").cogroup(
        wanted.groupBy("part", "split")).applyInArrow(_given_back, "run long, block binary")
    both = table.where("part < 0").select("run", "docs", F.lit(None).cast("binary").alias("block")).union(
        back.select("run", F.lit(None).cast(table.schema["docs"].dataType).alias("docs"), "block"))
    return (both.groupBy("run").applyInArrow(_documents, RESULT),
            totals.select(F.pmod("pair", F.lit(width)).alias("a"), "b", "total", "best"))
