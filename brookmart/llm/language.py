"""Language ID by a bidirectional gated recurrent network over bytes, written and trained in numpy.

Every byte of a text gets label probabilities from a forward and a backward state; a document's are their mean, its language
the largest, its score that mean. Texts are read whole, in windows of ``WINDOW`` bytes whose states start at zero, so memory
is bounded by a chunk of windows however long a text is. A-Z count as a-z.

Training: backpropagation through time on the driver, on pieces of at most ``PER_LANGUAGE`` documents of each language (all
of them below that) and ``MAX_FIT`` altogether, in order of a hash of the id. Of more labels than ``MAX_LANGUAGES``, as a column
that holds other things has, the most frequent are learned. Held-out documents (CRC-32 of the id as text is 2 modulo 4) and those
without an id or a language are never learned from. Only text enters a prediction.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is everything if no language was learned;
repeated rows get equal answers; a null id is not held out; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmart.llm.tokens import slices, text_bytes

WINDOW = 128
TRAINED = 64
HIDDEN = 6
PER_LANGUAGE = 1000
MAX_LANGUAGES = 200
MAX_FIT = 50_000
PIECES = 4
CHUNK = 4096
UNKNOWN = "und"

LOWER = np.arange(256)
LOWER[65:91] += 32


@dataclass
class Network:
    """Two gated recurrent layers (index 0 reads forwards, 1 backwards) and a softmax over both states.

    Rows of ``gates`` and ``state``: reset, update, candidate. Reset and update are 1/2 + tanh(x)/2.
    """

    languages: list[str]
    gates: np.ndarray  # (2, 3H, 256)
    state: np.ndarray  # (2, 3H, H)
    out: np.ndarray  # (2, C, H)
    bias: np.ndarray  # (C, 1)

    @classmethod
    def new(cls, languages: list[str], hidden: int, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        return cls(languages, draw(2, 3 * hidden, 256, scale=0.3), draw(2, 3 * hidden, hidden, scale=0.5 / hidden**0.5),
                   draw(2, len(languages), hidden, scale=0.3), np.zeros((len(languages), 1), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.gates, self.state, self.out, self.bias]

    def pooled(self, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Mean label probabilities (texts x languages) over all bytes of each text; empty texts have zeros."""
        count = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(sizes)), count)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        start = np.repeat(np.cumsum(sizes) - sizes, count) + nth * WINDOW
        length = np.minimum(WINDOW, np.repeat(sizes, count) - nth * WINDOW)
        order = np.argsort(-length, kind="stable")
        total = np.zeros((len(self.languages), len(sizes)))
        data = np.concatenate([LOWER.astype(np.uint8)[data], np.zeros(WINDOW, np.uint8)])
        for at in range(0, len(order), CHUNK):
            own = order[at:at + CHUNK]
            longest = int(length[own[0]])
            bytes_ = np.ascontiguousarray(data[start[own][None, :] + np.arange(longest)[:, None]].astype(np.intp))
            for c, row in enumerate(self._window_sums(bytes_, length[own])):
                total[c] += np.bincount(owner[own], row, len(sizes))
        return (total / np.maximum(sizes, 1)).T

    def _window_sums(self, data: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Label probabilities summed over each window's own bytes."""
        steps, n = data.shape
        hidden = self.state.shape[2]
        forward = np.empty((steps, hidden, n), np.float32)
        h = np.zeros((hidden, n), np.float32)
        for t in range(steps):
            h = self._step(0, data[t], h)
            forward[t] = h
        h, sums = np.zeros((hidden, n), np.float32), np.zeros((len(self.languages), n), np.float32)
        for t in range(steps - 1, -1, -1):
            inside = int(np.searchsorted(-length, -t, side="left"))  # windows are in order of falling length
            h = self._step(1, data[t], h)
            if inside < n:
                h[:, inside:] = 0  # these start later
            p = self.out[0] @ forward[t]
            p += self.out[1] @ h
            p += self.bias
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            sums[:, :inside] += p[:, :inside]
        return sums

    def _step(self, way: int, codes: np.ndarray, h: np.ndarray) -> np.ndarray:
        k = h.shape[0]
        x, s = self.gates[way].take(codes, axis=1, mode="clip"), self.state[way] @ h  # unchecked: codes are bytes
        g = x[:2 * k]
        g += s[:2 * k]
        np.tanh(g, out=g)
        g *= 0.5
        g += 0.5
        n = s[2 * k:]
        n *= g[:k]
        n += x[2 * k:]
        np.tanh(n, out=n)
        h = h - n
        h *= g[k:]
        h += n
        return h

    def gradients(self, data: np.ndarray, inside: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over the marked positions of (steps x n) windows, and its gradients by backpropagation through time."""
        steps, n = data.shape
        k = self.state.shape[2]
        kept: list[list] = [[None] * steps, [None] * steps]
        states = np.zeros((2, steps, k, n), np.float32)
        for way in (0, 1):
            h = np.zeros((k, n), np.float32)
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                x, s = self.gates[way].take(data[t], axis=1, mode="clip"), self.state[way] @ h
                g = 0.5 + 0.5 * np.tanh(x[:2 * k] + s[:2 * k])
                c = np.tanh(x[2 * k:] + g[:k] * s[2 * k:])
                kept[way][t] = (h, g, c, s[2 * k:])
                h = (c + g[k:] * (h - c)) * inside[t]
                states[way, t] = h
        p = np.einsum("ch,thn->tcn", self.out[0], states[0]) + np.einsum("ch,thn->tcn", self.out[1], states[1]) + self.bias
        p = np.exp(p - p.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        size = max(float(inside.sum()), 1.0)
        own = p[:, label, np.arange(n)]
        loss = float(-(np.log(own + 1e-9) * inside).sum() / size)
        d = p
        d[:, label, np.arange(n)] -= 1
        d *= (inside / size)[:, None, :]
        grads = [np.zeros_like(w) for w in self.weights()]
        grads[3][:, 0] = d.sum(axis=(0, 2))
        for way in (0, 1):
            grads[2][way] = np.einsum("tcn,thn->ch", d, states[way])
            into = np.einsum("ch,tcn->thn", self.out[way], d)
            dh = np.zeros((k, n), np.float32)
            gate = np.zeros((steps, 3 * k, n), np.float32)
            for t in range(steps - 1, -1, -1) if way == 0 else range(steps):
                h, g, c, s = kept[way][t]
                dh = (dh + into[t]) * inside[t]
                r, z = g[:k], g[k:]
                dc = dh * (1 - z) * (1 - c * c)
                gate[t, :k] = dc * s * 2 * r * (1 - r)  # derivative of 1/2 + tanh(x)/2
                gate[t, k:2 * k] = dh * (h - c) * 2 * z * (1 - z)
                gate[t, 2 * k:] = dc
                through = gate[t].copy()
                through[2 * k:] *= r
                grads[1][way] += through @ h.T
                dh = dh * z + self.state[way].T @ through
            flat, codes = gate.transpose(1, 0, 2).reshape(3 * k, -1), data.reshape(-1)
            for row in range(3 * k):
                grads[0][way, row] = np.bincount(codes, flat[row], 256)
        return loss, grads


def windows(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(length x n) byte codes and marks of the bytes that are there."""
    data, inside = np.zeros((length, len(texts)), np.intp), np.zeros((length, len(texts)), np.float32)
    for i, text in enumerate(texts):
        codes = LOWER[np.frombuffer(text[:length], np.uint8)]
        data[:len(codes), i] = codes
        inside[:len(codes), i] = 1
    return data, inside


def train(texts: list[bytes], languages: list[str], steps: int = 400, batch: int = 256, rate: float = 0.02, seed: int = 5,
          hidden: int = HIDDEN) -> Network:
    """Adam on windows drawn evenly by language."""
    names = sorted(set(languages))
    net, rng = Network.new(names, hidden, seed), np.random.default_rng(seed)
    data, inside = windows(texts, TRAINED)
    of = [np.flatnonzero(np.array(languages) == name) for name in names]
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    for step in range(1, steps + 1):
        label = rng.integers(0, len(names), batch)
        pick = np.array([rng.choice(of[c]) for c in label])
        _, grads = net.gradients(data[:, pick], inside[:, pick], label)
        norm = max(1.0, float(np.sqrt(sum((g * g).sum() for g in grads))))
        now = rate * min(1.0, step / 20) * 0.5 * (1 + np.cos(np.pi * step / (steps + 1)))
        for w, g, m, v in zip(net.weights(), grads, first, second):
            g = g / norm
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, most: int = MAX_LANGUAGES, max_fit: int = MAX_FIT) -> Network | None:
    """A network from a bounded sample; None if nothing is labelled."""
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
                       & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    frequent = known.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(most)
    counts = {r.lang: r["count"] for r in frequent.collect()}  # at most ``most`` rows
    if not counts:
        return None
    per_language = max(1, min(per_language, max_fit // len(counts)))
    at = lambda k: F.substring("text", F.lit(1) + F.pmod(
        F.xxhash64("doc_id", F.lit(k)), F.greatest(F.lit(1), F.char_length("text") - TRAINED + 1)).cast("int"), F.lit(TRAINED))
    turn = F.xxhash64(F.lit(9), "doc_id")
    # about four times the wanted rows of a language are ranked, however many it has
    shares = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, min(1.0, 4 * per_language / n))])
    few = known.where(F.shiftrightunsigned(turn, 11) / 2.0**53 <= F.try_element_at(shares, F.col("lang")))
    pieces = few.select(F.col("lang").alias("known"), turn.alias("turn"), F.array(*[at(k) for k in range(PIECES)]).alias("pieces"))
    nth = F.row_number().over(Window.partitionBy("known").orderBy("turn", "pieces"))
    rows = pieces.withColumn("nth", nth).where(F.col("nth") <= per_language).orderBy("known", "turn", "pieces").collect()
    if not rows:
        return None
    texts = [p.encode("utf-8", "replace") for r in rows for p in r.pieces]
    return train(texts, [r.known for r in rows for _ in r.pieces])


def labelled(docs: DataFrame, carry: list[Column], net: Network | None = None) -> DataFrame:
    """``row`` (a struct of ``carry``), lang_pred and score of every document; nothing is shuffled."""
    net = net or fit(docs)
    rows = docs.select(F.struct(*carry).alias("row"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    if net is None:
        return rows.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), 4 << 20):
                part = batch.slice(a, b - a)
                letters = part.column(2).to_numpy(zero_copy_only=False)
                pooled = net.pooled(*text_bytes(part.column(1)))
                names = [net.languages[c] if ok else UNKNOWN for c, ok in zip(pooled.argmax(axis=1).tolist(), letters)]
                score = np.where(letters, np.clip(pooled.max(axis=1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["row", "lang_pred", "score"])

    out = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, out)


def identified(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    carry = [F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out")]
    return labelled(docs, carry, net).select("row.*", "lang_pred", "score")


def accepted(docs: DataFrame, sure: float = 0.5, net: Network | None = None) -> DataFrame:
    """The documents whose language is told with a score of ``sure`` or more; those without a letter go."""
    found = labelled(docs, [F.col(c) for c in docs.columns], net)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= sure)).select([F.col("row")[c].alias(c) for c in docs.columns])
