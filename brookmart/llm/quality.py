"""Quality rules: gradient-boosted trees over document statistics, scored from flat numpy node arrays.

One pass over whole texts makes a small table of statistics, written once. The trees are fitted on the driver from labelled
rows of that table, at most ``MAX_FIT`` in order of a hash of the id (all of them below that), then every row is scored.
Statistics in ``FALLING`` may only lower the score: a split against that is not made, and both sides of a split on such a
statistic bound the values below them.

Defined results: a null text has no words and fails the base rules; repeated rows are scored alike; labels without a
quality are no use; without labels of both kinds the base rules decide alone; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import stored
from brookmart.llm.tokens import slices, text_bytes

MAX_FIT = 50_000
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_unique_words", "n_upper", "n_digits", "n_marks")
STATS = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS + MORE)
FEATURES = ("words", "word_length", "symbols", "dup_lines", "repeats", "unique", "upper", "digits", "marks", "line_words")
FALLING = ("symbols", "dup_lines", "repeats", "upper", "marks")


def _codes(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Equal keys get equal small numbers."""
    codes, found = pd.factorize(keys)
    return codes.astype(np.int64), len(found)


def repeated_words(words: np.ndarray, owner: np.ndarray, kinds: int, docs: int) -> np.ndarray:
    """Words of each document that lie in a window found twice or more in it. Windows are told apart exactly:

    positions whose first two words are unique in the document fall out, then the same with four words and with five.
    """
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(owner[WINDOW - 1:] == owner[:len(owner) - WINDOW + 1]) if len(words) >= WINDOW else np.zeros(0, np.int64)
    seen = owner[at]
    for first, second in ((0, 1), (2, 3), (4, None)):
        if not at.size:
            break
        pair = words[at + first] if second is None else words[at + first] * kinds + words[at + second]
        pair, n = _codes(pair)
        seen, n = _codes(seen * n + pair)
        again = np.bincount(seen, minlength=n)[seen] > 1
        at, seen = at[again], seen[again]
    np.add.at(covered, at, 1)
    np.add.at(covered, np.minimum(at + WINDOW, len(words)), -1)
    return np.bincount(owner[np.cumsum(covered[:-1]) > 0], minlength=docs)


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS and MORE of each text."""
    texts, docs = pc.fill_null(texts, ""), len(texts)
    split = pc.ascii_split_whitespace(texts)
    owner = np.repeat(np.arange(docs), np.asarray(pc.list_value_length(split)))
    flat = split.flatten()
    real = np.asarray(pc.greater(pc.binary_length(flat), 0))
    flat, owner = flat.filter(pa.array(real)), owner[real]
    coded = flat.dictionary_encode()
    words, kinds = np.asarray(coded.indices).astype(np.int64), len(coded.dictionary)
    out = {"n_words": np.bincount(owner, minlength=docs),
           "word_chars": np.bincount(owner, np.asarray(pc.utf8_length(flat)), docs).astype(np.int64),
           "n_repeat_words": repeated_words(words, owner, kinds, docs)}
    pairs, n = _codes(owner * max(kinds, 1) + words)
    firsts = np.zeros(n, np.int64)
    firsts[pairs] = owner
    out["n_unique_words"] = np.bincount(firsts, minlength=docs)

    split = pc.split_pattern(texts, "\n")
    owner = np.repeat(np.arange(docs), np.asarray(pc.list_value_length(split)))
    lines = split.flatten()
    real = np.asarray(pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0))
    lines, owner = lines.filter(pa.array(real)), owner[real]
    coded = lines.dictionary_encode()
    pairs, n = _codes(owner * max(len(coded.dictionary), 1) + np.asarray(coded.indices))
    firsts = np.zeros(n, np.int64)
    firsts[pairs] = owner
    out["n_lines"] = np.bincount(owner, minlength=docs)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(firsts, minlength=docs)

    data, sizes = text_bytes(texts)
    full = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[full]
    marks = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in SYMBOLS and chr(c) not in ".,")
    for name, chars in (("n_symbols", SYMBOLS), ("n_upper", bytes(range(65, 91))), ("n_digits", b"0123456789"), ("n_marks", marks)):
        table = np.zeros(256, np.uint8)
        table[list(chars)] = 1
        out[name] = np.zeros(docs, np.int64)
        if full.size:
            out[name][full] = np.add.reduceat(table[data], starts, dtype=np.int64)
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                stats = statistics(batch.column(1).slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(stats[c], pa.int64()) for c in COUNTS + MORE)], ["doc_id", *COUNTS, *MORE])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, STATS)


def features(stats: pd.DataFrame) -> np.ndarray:
    n = np.maximum(stats["n_words"].to_numpy(float), 1)
    chars = np.maximum(stats["word_chars"].to_numpy(float), 1)
    return np.stack([
        stats["n_words"].to_numpy(float), stats["word_chars"] / n, stats["n_symbols"] / n,
        stats["n_dup_lines"] / np.maximum(stats["n_lines"].to_numpy(float), 1), stats["n_repeat_words"] / n, stats["n_unique_words"] / n,
        stats["n_upper"] / chars, stats["n_digits"] / chars, stats["n_marks"] / n, n / np.maximum(stats["n_lines"].to_numpy(float), 1)], axis=1)


@dataclass
class Trees:
    """All nodes of all trees in flat arrays; a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    prior: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.prior), np.arange(len(x))
        for root in self.roots.tolist():
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def boost(x: np.ndarray, y: np.ndarray, falling: tuple[int, ...], trees: int = 60, depth: int = 4, rate: float = 0.25,
          bins: int = 64, damp: float = 1.0, least: float = 3.0) -> Trees:
    """Logistic boosting on binned columns; ``falling``: columns in which the score never rises."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    coded = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)  # code <= k iff value <= edge k
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    prior = float(np.log(share / (1 - share)))
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots, margin = [], np.full(len(y), prior)

    def grow(rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = grad[rows].sum(), hess[rows].sum()
        own = len(nodes)
        nodes.append([0, 0.0, own, own, rate * float(np.clip(g / (h + damp), low, high))])
        best = (1e-6, None)
        if level < depth and len(rows) > 1:
            for f, edge in enumerate(edges):
                if not len(edge):
                    continue
                code = coded[rows, f]
                gl = np.cumsum(np.bincount(code, grad[rows], len(edge) + 1))[:-1]
                hl = np.cumsum(np.bincount(code, hess[rows], len(edge) + 1))[:-1]
                gr, hr = g - gl, h - hl
                vl, vr = np.clip(gl / (hl + damp), low, high), np.clip(gr / (hr + damp), low, high)
                gain = gl * vl - (hl + damp) * vl**2 / 2 + gr * vr - (hr + damp) * vr**2 / 2
                gain = gain - (g**2 / (h + damp) / 2 if low == -np.inf and high == np.inf else 0)
                gain[(hl < least) | (hr < least)] = -np.inf
                if f in falling:
                    gain[vl < vr] = -np.inf
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, float(vl[k]), float(vr[k])))
        if best[1]:
            f, k, vl, vr = best[1]
            under = coded[rows, f] <= k
            mid = (vl + vr) / 2
            a = grow(rows[under], grad, hess, level + 1, mid if f in falling else low, high)
            b = grow(rows[~under], grad, hess, level + 1, low, mid if f in falling else high)
            nodes[own][:4] = [f, float(edges[f][k]), a, b]
        return own

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grow(np.arange(len(y)), y - p, p * (1 - p), 0, -np.inf, np.inf))
        one = _flat(nodes, roots[-1:], 0.0, depth)
        margin = margin + one.margin(x)
    return _flat(nodes, roots, prior, depth)


def _flat(nodes: list[list], roots: list[int], prior: float, depth: int) -> Trees:
    f, t, a, b, v = zip(*nodes)
    return Trees(np.array(roots), np.array(f), np.array(t), np.array(a), np.array(b), np.array(v), prior, depth)


def fit(stats: DataFrame, labels: DataFrame, most: int = MAX_FIT) -> Trees | None:
    """Trees from at most ``most`` labelled rows; None if there are not both kinds."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("label_quality"))
    n, turn = known.count(), F.xxhash64("doc_id")
    # about twice the wanted rows are ranked, however many there are
    few = known.where(F.shiftrightunsigned(turn, 11) / 2.0**53 <= min(1.0, 2 * most / max(n, 1)))
    sample = (stats.join(few, "doc_id").orderBy(turn, *COUNTS).limit(most)
              .select("label_quality", *COUNTS, *MORE).toPandas())
    y = (sample["label_quality"] > 0).to_numpy(float)
    if not len(y) or y.min() == y.max():
        return None
    return boost(features(sample), y, tuple(FEATURES.index(f) for f in FALLING))


def judged(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, COUNTS, base_failed, kept and score (probability of good quality; null without a model)."""
    stats = stored(document_statistics(docs), "quality-statistics")
    trees = fit(stats, labels)
    scored = stats.withColumn("score", F.lit(None).cast("double"))
    if trees:
        def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                yield pdf.assign(score=trees.score(features(pdf)))
        scored = stats.mapInPandas(score, f"{STATS}, score double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (scored.withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.coalesce("score", F.lit(1.0)) >= threshold))
            .select("doc_id", *COUNTS, "base_failed", "kept", "score"))
