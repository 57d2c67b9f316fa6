"""Cutting text without spaces into words: a lattice of dictionary words and the cheapest path through it.

The dictionary (a stated number of words with their frequencies) is a double-array trie that goes to the workers with the
function. Runs of letters or digits are laid end to end as one array of character codes, in slices of ``SLICE`` characters (a longer
run is a slice of its own): all words that start anywhere are found by as many steps down the trie as the longest word has letters,
and the best paths of all stretches of a slice are computed side by side, from their ends. Costs are whole numbers, so equal inputs give
equal cuts anywhere; of paths of equal cost the one whose first word is longer is taken. A letter that starts no word stands alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.operators.keywords import explode_words

RUN = r"\p{L}+|\p{N}+"
MOST_WORDS = 50_000
SCALE = 1000
SLICE = 200_000
WINDOW = 512
FAR = 1 << 30  # more than any word costs


def learned_words(texts: DataFrame, column: str, most: int = MOST_WORDS, longest: int = 16) -> DataFrame:
    """(word, freq): the ``most`` frequent words of ``column`` with up to ``longest`` letters."""
    words = explode_words(texts.select(column), column, "word").where(F.char_length("word") <= longest)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("freq")).orderBy(F.col("freq").desc(), "word").limit(most)


class Lattice:
    """``words`` with frequencies as a double-array trie: from state s, code c leads to t = base[s] + c where check[t] = s."""

    def __init__(self, words: dict[str, int], most: int = MOST_WORDS) -> None:
        if len(words) > most:
            raise ValueError(f"{len(words)} words, more than {most}")
        listed = sorted((w, n) for w, n in words.items() if w)
        total = sum(n for _, n in listed) or 1
        cost = lambda n: round(SCALE * (np.log(total) - np.log(n)))
        self.letters = {c: i for i, c in enumerate(sorted({c for w, _ in listed for c in w}), 1)}
        self.longest = max((len(w) for w, _ in listed), default=1)
        self.unknown = cost(0.5)
        size = len(self.letters) + 2
        self.base, self.check, self.cost = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, FAR, np.int32)
        self.check[0] = 0
        todo, free, last_of = [(0, 0, len(listed), 0)], 1, {}
        while todo:  # the words from a to b share their first ``depth`` letters, which lead to ``state``
            state, a, b, depth = todo.pop()
            if a < b and len(listed[a][0]) == depth:
                self.cost[state] = cost(listed[a][1])
                a += 1
            if a == b:
                continue
            heads = [(a, self.letters[listed[a][0][depth]])]
            for i in range(a + 1, b):
                if listed[i][0][depth] != listed[heads[-1][0]][0][depth]:
                    heads.append((i, self.letters[listed[i][0][depth]]))
            codes = np.array([c for _, c in heads])
            # slots of all letters must be free; looked for in windows from where states with as many letters went last
            at = max(1, (free if len(codes) == 1 else last_of.get(len(codes), 1)) - int(codes[0]))
            while True:
                self._reach(at + size + WINDOW)
                taken = self.check[at + codes[0]:at + codes[0] + WINDOW] >= 0
                for c in codes[1:]:
                    taken |= self.check[at + c:at + c + WINDOW] >= 0
                ahead = int(taken.argmin())
                if not taken[ahead]:
                    at += ahead
                    break
                at += WINDOW
            self.base[state], last_of[len(codes)] = at, at + int(codes[0])
            self.check[at + codes] = state
            while self.check[free] >= 0:
                free += 1
                self._reach(free + size)
            for (first, code), last in zip(heads, [*(i for i, _ in heads[1:]), b]):
                todo.append((at + code, first, last, depth + 1))
        self._reach(int(self.base.max()) + size)

    def _reach(self, size: int) -> None:
        if size >= len(self.base):
            more = max(size + 1 - len(self.base), len(self.base))
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1)])
            self.cost = np.concatenate([self.cost, np.full(more, FAR, np.int32)])

    def costs(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cost of the word of each length (row) that starts at each place of the runs laid end to end, and the runs' ends."""
        wide = np.frombuffer("".join(runs).encode("utf-32-le"), "<u4").astype(np.int64)
        used, code = np.unique(wide, return_inverse=True)
        code = np.array([self.letters.get(chr(c), len(self.letters) + 1) for c in used.tolist()], np.int64)[code]
        ends = np.cumsum([len(r) for r in runs])
        left = np.repeat(ends, [len(r) for r in runs]) - np.arange(len(code))  # letters up to the end of the run
        out = np.full((self.longest + 1, len(code)), FAR, np.int32)
        state = np.zeros(len(code), np.int64)
        live = np.arange(len(code))
        for size in range(1, self.longest + 1):
            live = live[left[live] >= size]
            if not live.size:
                break
            nxt = self.base[state[live]] + code[live + size - 1]
            ok = self.check[nxt] == state[live]
            live = live[ok]
            state[live] = nxt[ok]
            out[size, live] = self.cost[nxt[ok]]
        out[1] = np.where(out[1] < FAR, out[1], self.unknown)
        return out, ends

    def best_path(self, runs: list[str]) -> np.ndarray:
        """Length of the first word of the cheapest path from each place to the end of its run.

        A place inside no word of several letters ends a word on every path, so the stretches between such places are paths of their own.
        """
        costs, _ = self.costs(runs)
        places = costs.shape[1]
        longest = np.ones(places, np.int64)
        for size in range(2, self.longest + 1):
            longest[costs[size] < FAR] = size
        place = np.arange(places)
        ends = np.append(np.flatnonzero(np.maximum.accumulate(place + longest)[:-1] <= place[1:]) + 1, [places] if places else [])
        ends = ends.astype(np.int64)
        sizes = np.diff(ends, prepend=0)
        best = np.zeros(places + 1, np.int64)
        step = np.zeros(places, np.int64)
        order = np.argsort(-sizes, kind="stable")
        by_size, tails = -sizes[order], ends[order]
        for back in range(1, int(sizes.max(initial=0)) + 1):  # all places with ``back`` letters left, side by side
            at = tails[:np.searchsorted(by_size, -back, side="right")] - back
            length = np.arange(min(self.longest, back), 0, -1)[:, None]  # longer first: a tie keeps it
            own = costs[length, at].astype(np.int64)
            total = np.where(own < FAR, own, np.iinfo(np.int64).max // 2) + np.where(length < back, best[at + length], 0)
            first = total.argmin(axis=0)
            best[at], step[at] = total[first, np.arange(len(at))], length[first, 0]
        return step

    def smart(self, runs: list[str]) -> list[list[str]]:
        """Words of the cheapest path of each run."""
        step, out, at = self.best_path(runs).tolist(), [], 0
        for run in runs:
            words, i = [], 0
            while i < len(run):
                words.append(run[i:i + step[at + i]])
                i += step[at + i]
            out.append(words)
            at += len(run)
        return out

    def fine(self, runs: list[str]) -> list[list[str]]:
        """All dictionary words of each run by place, longer ones first, and single letters that no word covers."""
        costs, ends = self.costs(runs)
        known = costs < FAR
        known[1] &= costs[1] != self.unknown
        place = np.arange(costs.shape[1])
        longest = np.zeros(costs.shape[1], np.int64)
        for size in range(1, self.longest + 1):
            longest[known[size]] = size
        known[1] |= np.maximum.accumulate(place + longest) <= place  # covered by no word
        at, size = np.nonzero(known[::-1].T)
        size = self.longest - size
        text, cuts = "".join(runs), np.searchsorted(at, np.concatenate([[0], ends]))
        return [[text[i:i + n] for i, n in zip(at[a:b].tolist(), size[a:b].tolist())] for a, b in zip(cuts, cuts[1:])]


def slices(runs: list[str]) -> Iterator[list[str]]:
    part, held = [], 0
    for run in runs:
        if part and held + len(run) > SLICE:
            yield part
            part, held = [], 0
        part.append(run)
        held += len(run)
    if part:
        yield part


def segmenter(lattice: Lattice, smart: bool = True):
    """An Arrow-batched column function: lower-cased words of runs of letters or of digits; a null text gives null."""
    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import regex

        runs_of = regex.compile(RUN).findall
        split = lattice.smart if smart else lattice.fine
        for batch in batches:
            found = [None if t is None else runs_of(t.lower()) for t in batch]
            words = (w for part in slices([r for x in found if x for r in x]) for w in split(part))
            yield pd.Series([None if x is None else [w for _ in x for w in next(words)] for x in found], index=batch.index, dtype=object)

    return cut


def counted_runs(texts: DataFrame, column: str) -> DataFrame:
    """(run, times): the distinct runs of letters or of digits of ``column``, lower-cased, so that each is cut once and any task may cut it."""
    @F.pandas_udf("array<string>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import regex

        runs_of = regex.compile(RUN).findall
        for batch in batches:
            yield pd.Series([None if t is None else runs_of(t.lower()) for t in batch], index=batch.index, dtype=object)

    return texts.select(F.explode(found(column)).alias("run")).groupBy("run").agg(F.count(F.lit(1)).alias("times"))


def trained(texts: DataFrame, column: str, most: int = MOST_WORDS) -> Lattice:
    """The lattice of the ``most`` frequent words of ``column``; so many rows reach the driver at most."""
    return Lattice({r["word"]: r["freq"] for r in learned_words(texts, column, most).collect()}, most)
