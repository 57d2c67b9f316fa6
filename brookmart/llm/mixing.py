"""Mixing sources to target weights by fitting a subset sum to each budget.

Documents are counted by exact length. A source whose target exceeds its size is taken whole as often as it fits; the rest
of its budget takes the same share of every length, and a bounded knapsack over the lengths closes what rounding left open.
A seeded order says which documents of a length go in.

Source totals and targets are windows over one row per source; the knapsack of a source sees its lengths and counts, never
its documents. A length that many documents share is counted and ranked in ``spread`` parts.

Defined results: no text has length 0 and is never taken; a null source is a source of its own, last in order; rows that
repeat count as often as they occur; without any words all targets are 0; extra columns take no part.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookmart.llm.common import ordered_id, stored, word_count

WEIGHTS = (1, 2, 3)
REPEATS = 3
SPREAD = 64
DENSE = 1 << 17


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Target per source from (no_source, source, source_size).

    In the order of size per weight the capped sources come first. Each prefix gives the level at which the rest would share;
    the level rises as long as capping a source leaves excess and falls afterwards, so the highest is the answer.
    """
    by_name = Window.partitionBy().orderBy("no_source", "source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int")
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1))
    before = Window.partitionBy().orderBy(F.col("source_size") / F.col("weight"), "no_source", "source").rowsBetween(
        Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = ((F.sum("source_size").over(every) - repeats * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    leveled = weighed.withColumn("level", level).withColumn("level", F.max("level").over(every))
    return leveled.select("no_source", "source", "source_size", F.least(
        (F.lit(repeats) * F.col("source_size")).cast("double"), F.col("level") * F.col("weight")).alias("target"))


def fit(lengths: list[int], counts: list[int], target: float, repeats: int = REPEATS) -> tuple[int, list[int]]:
    """Whole passes over a source, and how many documents of each length go in once more.

    The sum is the target's integer part or the nearest found below it. First every length gives the same share; if no
    subset closes the gap then, the share shrinks, and without any share the knapsack has every choice (and is exact up to
    ``DENSE``).
    """
    whole = sum(n * c for n, c in zip(lengths, counts))
    if not whole:
        return 0, [0] * len(lengths)
    budget = int(target)
    passes = min(budget // whole, repeats)
    rest = 0 if passes == repeats else budget - passes * whole
    best: tuple[int, list[int]] = (-1, [])
    for share in (rest, rest * 3 // 4, rest // 2, 0):
        chosen = [c * share // whole if n else 0 for n, c in zip(lengths, counts)]
        total = _close(lengths, counts, chosen, rest)
        if total > best[0]:
            best = (total, chosen)
        if total == rest:
            break
    return passes, best[1]


def _close(lengths: list[int], counts: list[int], chosen: list[int], rest: int) -> int:
    """Add to ``chosen`` what brings its sum nearest to ``rest`` from below: a bounded knapsack over lengths. Returns the sum."""
    left = rest - sum(n * c for n, c in zip(lengths, chosen))
    order = sorted((i for i, n in enumerate(lengths) if n), key=lambda i: -lengths[i])
    for i in order:  # large lengths first, until the table below is small
        if left > DENSE:
            more = min(counts[i] - chosen[i], (left - DENSE) // lengths[i])
            chosen[i] += more
            left -= more * lengths[i]
    mask, reach, steps = (1 << (left + 1)) - 1, 1, []
    for i in reversed(order):
        spare, part = min(counts[i] - chosen[i], left // lengths[i]), 1
        while spare > 0 and not reach >> left & 1:
            part = min(part, spare)
            steps.append((i, part, reach))
            reach |= reach << part * lengths[i] & mask
            spare, part = spare - part, part * 2
    found = at = reach.bit_length() - 1
    for i, part, earlier in reversed(steps):
        if not earlier >> at & 1:
            chosen[i] += part
            at -= part * lengths[i]
    return rest - left + found


def _fitted(repeats: int):
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ignore_index=True)
        passes, chosen = fit([int(x) for x in pdf["size"]], [int(x) for x in pdf["n"]], float(pdf["target"].iloc[0]), repeats)
        return pdf.assign(passes=passes, chosen=chosen)[["no_source", "source", "size", "passes", "chosen"]]
    return one


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = 17, spread: int = SPREAD) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, and ``text_hash`` to tell rows of one id apart."""
    rows = docs.select(
        "doc_id", F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source"),
        word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))
    rows = rows.withColumn("turn", F.xxhash64(F.lit(seed), "doc_id", "text_hash")).withColumn(
        "part", F.pmod(F.shiftrightunsigned("turn", 32), F.lit(spread)).cast("int"))
    rows = stored(rows, "mix-rows")
    parts = stored(rows.groupBy("no_source", "source", "size", "part").agg(F.count("*").alias("n")), "mix-counts")
    totals = targets(parts.groupBy("no_source", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, repeats)
    totals = stored(totals, "mix-targets")
    lengths = parts.groupBy("no_source", "source", "size").agg(F.sum("n").alias("n"))
    chosen = (lengths.join(totals, ["no_source", "source"]).groupBy("no_source", "source")
              .applyInPandas(_fitted(repeats), "no_source boolean, source string, size long, passes int, chosen long"))
    earlier = Window.partitionBy("no_source", "source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    quotas = (parts.withColumn("before", before).join(chosen, ["no_source", "source", "size"]).join(totals, ["no_source", "source"])
              .withColumn("quota", F.least(F.col("n"), F.greatest(F.lit(0), F.col("chosen") - F.col("before"))))
              .select("no_source", "source", "size", "part", "passes", "quota", "source_size", "target"))
    quotas = stored(quotas, "mix-quotas")
    seeded = Window.partitionBy("no_source", "source", "size", "part").orderBy("turn", "doc_id")
    picked = F.row_number().over(seeded) <= F.col("quota")
    return (rows.join(quotas, ["no_source", "source", "size", "part"])
            .withColumn("taken", F.col("size") * (F.col("passes") + picked.cast("long")))
            .select("doc_id", "size", "source_size", "target", "taken", "text_hash"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken."""
    keyed = docs.select(F.struct("*").alias("row")).select(
        "row", ordered_id(F.col("row.doc_id")).alias("id"), F.xxhash64("row.text").alias("hash"))
    times = mix(docs).where("taken > 0").select(
        ordered_id(F.col("doc_id")).alias("id"), F.col("text_hash").alias("hash"), (F.col("taken") / F.col("size")).cast("int").alias("times"))
    # repeated rows of one document pair off with what the mix takes of each
    keyed = keyed.withColumn("nth", F.row_number().over(Window.partitionBy("id", "hash").orderBy(F.lit(1))))
    times = times.withColumn("nth", F.row_number().over(Window.partitionBy("id", "hash").orderBy(F.col("times").desc())))
    return (keyed.join(times, ["id", "hash", "nth"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
            .select([F.col("row")[c].alias(c) for c in docs.columns]))
