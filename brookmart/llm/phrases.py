"""Phrases of two to four words that hold together, per language, by multikey quicksort of suffixes.

A suffix is the language and up to ``LONGEST`` words from a word's place on, within its piece. Single words are counted first and
their counts added up in 2**``SLOT_BITS`` slots by hash: a word in a slot below ``least`` is surely infrequent, so no phrase
holds it and suffixes end before it. The slots are a bitmap of fixed size; words that share a full slot merely stay.

What a task reads is turned into suffixes batch by batch; equal suffixes of a batch are one with a count, and all are dealt by a hash of the language and the two
leading words, as zstd blocks with a word list of their own, into a stored table. Each bucket then sorts its suffix pointers by
multikey three-way quicksort: the size of an equal-partition is the count of its phrase, and a partition below ``least`` is
abandoned at once, because nothing deeper can reach it. A bucket above twice ``TARGET`` suffixes is dealt anew by the third and fourth word; there
only suffixes of full depth lie together, so shorter phrases leave as partial counts and are added up afterwards. Copies of
one passage, however many, are one suffix with a count in each batch.

Scores, containment and ranks are joins over the phrases found; ranks are
taken in salted shares of a language first, so that no task sorts all phrases of a frequent language.

Defined results: null and empty texts have no words; a null language is ``und``, together with that name itself; repeated
rows count as often as they stand there; ids and other columns take no part; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookmart.llm.blocks import pack, starts_of, unpack
from brookmart.llm.common import stored
from brookmart.llm.tokens import slices, text_bytes

LONGEST = 4
LEAST = 30
BEST = 2000
COVERED = 80  # per cent of a phrase's occurrences inside a longer one
SCALE = 2_000_000
BATCH = 5 << 20
TARGET = 400_000
SALTS = 64
SLOT_BITS = 22
FEW = 10_000  # crowded buckets that may be broadcast
NO_LANGUAGE = "und"
WORD_BYTE, SPACE_BYTE, BREAK_BYTE = 0, 1, 2
KINDS = np.zeros(256, np.uint8)
KINDS[[0x20, 0x09]] = SPACE_BYTE
KINDS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = BREAK_BYTE
BLOCKS = "bucket int, n long, langs array<string>, words binary, block binary"
FOUND = "lang string, phrase string, n_words int, n long"


class Words:
    """The words of a batch of texts: codes, piece numbers, languages and the distinct words themselves."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        langs = pc.fill_null(langs, NO_LANGUAGE).dictionary_encode()
        self.langs: list[str] = langs.dictionary.to_pylist()
        data, sizes = text_bytes(pc.ascii_lower(pc.fill_null(texts, "")))
        kinds = KINDS[data]
        inside = kinds == WORD_BYTE
        ends_of_text = np.cumsum(sizes)
        begins = inside.copy()  # a word starts a text, or follows another kind of byte
        begins[1:] &= ~inside[:-1]
        heads = (ends_of_text - sizes)[sizes > 0]
        begins[heads] = inside[heads]
        starts = np.flatnonzero(begins)
        letters = data[inside]
        offsets = np.append((np.cumsum(inside, dtype=np.int64) - 1)[starts], len(letters))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(letters))]).dictionary_encode()
        self.words: list[bytes] = words.dictionary.to_pylist()
        self.code = np.asarray(words.indices).astype(np.int64)
        text = np.searchsorted(ends_of_text, starts, side="right")
        self.piece = np.cumsum(kinds == BREAK_BYTE, dtype=np.int64)[starts] + text  # grows with each break and each text
        self.lang = np.asarray(langs.indices).astype(np.int64)[text] if len(starts) else np.zeros(0, np.int64)

    def slots(self, lang: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The counting slot of each word."""
        langs, words = _hashes([x.encode() for x in self.langs])[1:], _hashes(self.words)[1:]
        return (_mixed(_mixed(langs)[lang] + words[code]) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def suffixes(self, frequent: np.ndarray) -> np.ndarray:
        """Rows (language, words + 1, 0 past a piece's end or a word outside ``frequent``) of all suffixes with two words at least."""
        out = np.zeros((len(self.code), 1 + LONGEST), np.int32)
        if not len(out):
            return out
        slot = self.slots(self.lang, self.code)
        good = (frequent[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
        out[:, 0] = self.lang
        valid = good
        for k in range(LONGEST):
            valid = valid[:len(good) - k] & good[k:] & (self.piece[k:] == self.piece[:len(self.piece) - k])
            out[:len(valid), 1 + k] = np.where(valid, self.code[k:] + 1, 0)
        return out[out[:, 2] > 0]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Columns lang and text in batches of bounded bytes."""
    held: list[tuple[pa.Array, pa.Array]] = []
    total = 0
    for batch in batches:
        for a, b in slices(batch.column(1), BATCH):
            part = batch.column(1).slice(a, b - a)
            held.append((batch.column(0).slice(a, b - a), part))
            total += part.nbytes
            if total >= BATCH:
                yield Words(*(pa.concat_arrays(x) for x in zip(*held)))
                held, total = [], 0
    if held:
        yield Words(*(pa.concat_arrays(x) for x in zip(*held)))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, slot, n) of single words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in _batches(batches):
            if len(w.code):
                keys, n = np.unique(w.lang * len(w.words) + w.code, return_counts=True)
                lang, word = np.divmod(keys, len(w.words))
                yield pa.RecordBatch.from_arrays([
                    pa.array(w.langs, pa.string()).take(pa.array(lang)), pa.array(w.words, pa.binary()).take(pa.array(word)).cast(pa.string()),
                    pa.array(w.slots(lang, word)), pa.array(n, pa.int64())], ["lang", "phrase", "slot", "n"])

    counted = docs.select("lang", "text").mapInArrow(run, "lang string, phrase string, slot long, n long")
    return counted.groupBy("lang", "phrase", "slot").agg(F.sum("n").alias("n"))


def frequent_slots(counts: DataFrame, least: int) -> np.ndarray:
    """A bit per slot: whether its words occur ``least`` times together. At most 2**``SLOT_BITS`` / 64 rows come to the driver."""
    full = counts.groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("slot", F.lit(64)).cast("int"))
    rows = full.groupBy(F.floor(F.col("slot") / 64).alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    out = np.zeros(1 << SLOT_BITS - 6, "<i8")
    out[[r.word for r in rows]] = [r.bits for r in rows]
    return out.view(np.uint8)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(words: list[bytes]) -> np.ndarray:
    """A hash of each word; 0 for the place before the first, the end of a piece."""
    return np.fromiter((0, *map(xxhash.xxh3_64_intdigest, words)), np.uint64, len(words) + 1)


def _rows(which: np.ndarray, rows: np.ndarray, many: np.ndarray, langs: list[str], words: list[bytes]) -> Iterator[tuple]:
    """(number, suffixes, languages, word list, block) of each group of ``which``; rows in order within a group."""
    order = np.argsort(which, kind="stable")
    first = starts_of(which[order])
    for a, b in zip(first, np.append(first[1:], len(order))):
        own = order[a:b]
        used_lang, lang = np.unique(rows[own, 0], return_inverse=True)
        used, code = np.unique(rows[own, 1:], return_inverse=True)
        none = len(used) and used[0] == 0
        code = code.reshape(len(own), -1) + (0 if none else 1)
        listed = b"\n".join(words[i - 1] for i in used[1 if none else 0:].tolist())
        yield (int(which[own[0]]), len(own), [langs[i] for i in used_lang.tolist()], zstandard.ZstdCompressor(level=1).compress(listed),
               pack(lang, *code.T, many[own]))


def _batch(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], [n for n, _ in kinds])


BLOCK_KINDS = [("n", pa.int64()), ("langs", pa.list_(pa.string())), ("words", pa.binary()), ("block", pa.binary())]


def suffix_blocks(docs: DataFrame, buckets: int, frequent: np.ndarray) -> DataFrame:
    """Distinct suffixes of each batch with their counts, dealt by language and two leading words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in _batches(batches):
            rows = w.suffixes(frequent)
            if not len(rows):
                continue
            base = len(w.words) + 1
            keys = rows.T.astype(np.int64)
            front, back = (keys[0] * base + keys[1]) * base + keys[2], keys[3] * base + keys[4]
            del keys
            order = np.lexsort((back, front))
            front, back, rows = front[order], back[order], rows[order]
            first = np.flatnonzero(np.concatenate([[True], (front[1:] != front[:-1]) | (back[1:] != back[:-1])]))
            many, rows = np.diff(np.append(first, len(rows))), rows[first]
            lang, word = _hashes([x.encode() for x in w.langs])[1:], _hashes(w.words)
            route = _mixed(_mixed(_mixed(lang[rows[:, 0]]) + word[rows[:, 1]]) + word[rows[:, 2]])
            yield _batch(list(_rows((route >> np.uint64(32)).astype(np.int64) % buckets, rows, many, w.langs, w.words)),
                         [("bucket", pa.int32()), *BLOCK_KINDS])

    return docs.select("lang", "text").mapInArrow(run, BLOCKS)


def _opened(langs: list[str], words: bytes, block: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    lang, *codes, many = unpack(block)
    return np.stack([lang, *codes], axis=1), many, zstandard.ZstdDecompressor().decompress(words).split(b"\n")


def _dealt_anew(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of crowded buckets cut by the third and fourth word; the others as they are, with the number -1."""
    kinds = [("bucket", pa.int32()), ("sub", pa.int32()), *BLOCK_KINDS]
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["subs"] is None:
                out.append((row["bucket"], -1, row["n"], row["langs"], row["words"], row["block"]))
                continue
            rows, many, words = _opened(row["langs"], row["words"], row["block"])
            word = _hashes(words)
            which = (_mixed(_mixed(word[rows[:, 3]]) + word[rows[:, 4]]) >> np.uint64(32)).astype(np.int64) % row["subs"]
            out += [(row["bucket"], *x) for x in _rows(which, rows, many, row["langs"], words)]
        if out:
            yield _batch(out, kinds)


def multikey_quicksort(columns: list[np.ndarray], many: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, a suffix, count) of every prefix that ``least`` suffixes share; ``columns[d]`` is the d-th key, 0 ends a suffix.

    Suffix pointers are parted into smaller, equal and greater by the key at the current depth. Equal ones share a prefix and go
    one key deeper; parts that hold fewer than ``least`` are left alone.
    """
    todo = [(np.arange(len(many)), 0)]
    while todo:
        own, depth = todo.pop()
        key = columns[depth][own]
        pivot = np.partition(key[:: max(1, len(key) // 7)][:7], 3 if len(key) > 6 else 0)[3 if len(key) > 6 else 0]
        less, more = key < pivot, key > pivot
        equal = own[~(less | more)]
        for part in (own[less], own[more]):
            if len(part) and int(many[part].sum()) >= least:
                todo.append((part, depth))
        count = int(many[equal].sum())
        if count >= least and (pivot or depth == 0):  # the language comes first and may have number 0
            yield depth, int(equal[0]), count
            if depth + 1 < len(columns):
                todo.append((equal, depth + 1))


def _sorted_bucket(least: int):
    """Phrases of a bucket; of a part of one also what may reach ``least`` together with others."""
    return lambda group: _phrases(group, least)


def _phrases(group: pa.Table, least: int) -> pa.Table:
    lang_ids: dict[str, int] = {}
    word_ids: dict[bytes, int] = {b"": 0}  # no word is empty
    rows, many = [], []
    for langs, words, block in zip(*(group.column(c).to_pylist() for c in ("langs", "words", "block"))):
        own, m, listed = _opened(langs, words, block)
        lang = np.array([lang_ids.setdefault(x, len(lang_ids)) for x in langs])
        word = np.array([0, *(word_ids.setdefault(x, len(word_ids)) for x in listed)])
        rows.append(np.concatenate([lang[own[:, :1]], word[own[:, 1:]]], axis=1).astype(np.int32))
        many.append(m)
    table, count = np.concatenate(rows), np.concatenate(many)
    columns = [np.ascontiguousarray(table[:, d]) for d in range(table.shape[1])]
    found: list[tuple[int, int, int]] = []
    if group.column("sub")[0].as_py() < 0:
        found = [x for x in multikey_quicksort(columns, count, least) if x[0] >= 2]
    else:  # only suffixes of full depth lie together here
        found = [x for x in multikey_quicksort(columns, count, least) if x[0] == LONGEST]
        for depth in range(2, LONGEST):
            own = np.flatnonzero(columns[depth])
            own = own[np.lexsort([columns[d][own] for d in range(depth, -1, -1)])]
            if len(own):
                ahead = table[own, :depth + 1]
                first = np.flatnonzero(np.concatenate([[True], (ahead[1:] != ahead[:-1]).any(axis=1)]))
                found += [(depth, i, n) for i, n in zip(own[first].tolist(), np.add.reduceat(count[own], first).tolist())]
    langs, words = list(lang_ids), list(word_ids)
    return pa.table({
        "lang": pa.array([langs[columns[0][i]] for _, i, _ in found], pa.string()),
        "phrase": pa.array([b" ".join(words[x] for x in table[i, 1:d + 1].tolist()).decode() for d, i, _ in found], pa.string()),
        "n_words": pa.array([d for d, _, _ in found], pa.int32()), "n": pa.array([n for _, _, n in found], pa.int64())})


def phrase_counts(docs: DataFrame, words: int, frequent: np.ndarray, least: int = LEAST, target: int = TARGET) -> DataFrame:
    """(lang, phrase, n_words, n) of all phrases of two words and more with ``least`` occurrences; ``words`` of the corpus in all."""
    buckets = max(1, -(-words // target))
    table = stored(suffix_blocks(docs, buckets, frequent), "phrase-suffixes")
    crowded = stored(table.groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") > 2 * target).select(
        "bucket", F.ceil(F.col("n") / target).cast("int").alias("subs")), "phrase-crowded")
    few = crowded.limit(FEW + 1).count()
    if few:
        dealt = table.join(F.broadcast(crowded) if few <= FEW else crowded, "bucket", "left")
    else:
        dealt = table.withColumn("subs", F.lit(None).cast("int"))
    dealt = dealt.mapInArrow(_dealt_anew, BLOCKS.replace("bucket int", "bucket int, sub int"))
    found = dealt.groupBy("bucket", "sub").applyInArrow(_sorted_bucket(least), FOUND)
    return found.groupBy("lang", "phrase", "n_words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def collocations(docs: DataFrame, least: int = LEAST, best: int = BEST, covered: int = COVERED, target: int = TARGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of each language.

    ``a`` counts the phrase, ``l`` and ``r`` its two parts at the cut that scores lowest.
    """
    counts = stored(word_counts(docs), "phrase-words")
    sizes = stored(counts.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-languages")
    total = int(sizes.agg(F.sum("n")).first()[0] or 0)
    found = stored(phrase_counts(docs, total, frequent_slots(counts, least), least, target), "phrase-found")
    candidates = found.select("lang", "phrase", "n_words", F.col("n").alias("a"))
    parts = counts.where(F.col("n") >= least).select("lang", "phrase", "n").union(found.select("lang", "phrase", "n"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)")).withColumn("tail", F.expr("substring_index(phrase, ' ', k - n_words)"))
    halves = cuts.select("lang", "phrase", "k", F.explode(F.array(
        F.struct(F.col("head").alias("part"), F.lit(True).alias("left")), F.struct(F.col("tail").alias("part"), F.lit(False).alias("left")))).alias("x"))
    halves = halves.select("lang", "phrase", "k", "x.*").join(
        parts.select("lang", F.col("phrase").alias("part"), "n"), ["lang", "part"])
    sides = halves.groupBy("lang", "phrase", "k").agg(
        F.max(F.when(F.col("left"), F.col("n"))).alias("l"), F.max(F.when(~F.col("left"), F.col("n"))).alias("r"))
    wide = "decimal(38,0)"
    sides = sides.join(candidates, ["lang", "phrase"]).withColumn("score", F.expr(
        f"cast({SCALE} as {wide}) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"))
    lowest = sides.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("cut")).select("lang", "phrase", "cut.*")
    # what lies inside a longer phrase nearly always
    inside = candidates.where("n_words > 2").withColumn("words", F.split("phrase", " ", -1)).withColumn(
        "size", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1))).withColumn(
        "at", F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("size") + 1)))
    inside = inside.select("lang", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase"), F.col("a").alias("longer"))
    longest = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    free = lowest.join(longest, ["lang", "phrase"], "left").where(F.expr(
        f"longer is null or cast(100 as {wide}) * cast(longer as decimal(19,0)) < cast({covered} as {wide}) * cast(a as decimal(19,0))"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    ahead = free.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= best)
    ranked = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= best)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
