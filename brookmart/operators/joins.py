"""Joins.

No side is broadcast by hint. Catalyst broadcasts a side while its size statistics stay under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, where AQE splits hot keys.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _seconds(interval: str) -> int:
    amount, unit = interval.split()
    return int(amount) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def interval_join(left: DataFrame, right: DataFrame, keys: dict[str, str], left_ts: str, right_ts: str,
                  before: str, after: str) -> DataFrame:
    """Inner join on ``keys`` (left → right) where ``left_ts - before <= right_ts <= left_ts + after``.

    Column names must be distinct. In batch the key gets a time bucket as wide as the interval: a
    right row has one bucket, a left row at most two, so each pair meets once, a hot key is cut by
    time, and no task compares all pairs of a key. Streams join on the key with the range as
    condition, which lets the state store drop rows behind the watermark.
    """
    low = F.col(left_ts) - F.expr(f"interval {before}")
    high = F.col(left_ts) + F.expr(f"interval {after}")
    in_range = (F.col(right_ts) >= low) & (F.col(right_ts) <= high)
    same_key = [F.col(l) == F.col(r) for l, r in keys.items()]
    if left.isStreaming or right.isStreaming:
        condition = in_range
        for c in same_key:
            condition = condition & c
        return left.join(right, condition)

    width = _seconds(before) + _seconds(after) + 1

    def bucket(ts: Column) -> Column:
        return F.floor(F.unix_seconds(ts) / F.lit(width))

    lefts = left.withColumn("_bucket", F.explode(F.array_distinct(F.array(bucket(low), bucket(high)))))
    rights = right.withColumn("_right_bucket", bucket(F.col(right_ts)))
    condition = in_range & (F.col("_bucket") == F.col("_right_bucket"))
    for c in same_key:
        condition = condition & c
    return lefts.join(rights, condition).drop("_bucket", "_right_bucket")


def fact_join(left: DataFrame, right: DataFrame, keys: dict[str, str], how: str = "inner",
              left_ts: str | None = None, right_ts: str | None = None, within: str | None = None) -> DataFrame:
    """Equi-join of two fact streams; ``keys`` maps left to right columns, whose names are distinct.

    In batch there is no time bound. On streams both sides must be watermarked and rows meet only
    if their event times are at most ``within`` apart, which drops matches further apart: the caller
    must say how far. ``brookmart.streaming.keyed`` joins streams without such a bound.
    """
    condition = F.lit(True)
    for l, r in keys.items():
        condition = condition & (F.col(l) == F.col(r))
    if left.isStreaming and right.isStreaming:
        if within is None:
            raise ValueError("a join of two streams needs `within`, the largest distance of matching rows in event time")
        span = F.expr(f"interval {within}")
        condition = (condition & (F.col(right_ts) >= F.col(left_ts) - span)
                     & (F.col(right_ts) <= F.col(left_ts) + span))
    return left.join(right, condition, how)


def as_numbers(rows: DataFrame, **types: str) -> DataFrame:
    """Text columns that hold numbers as numbers, for what an exchange carries: ``as_numbers(rows, amount="decimal(16,2)")``.

    Where a number would not give its text back (other digits, any other text), the row's texts travel instead of its numbers, in
    ``_texts``, which is null in other rows. ``as_texts`` undoes it.
    """
    numbers = {name: F.col(name).try_cast(kind) for name, kind in types.items()}
    told = reduce(and_, [number.cast("string").eqNullSafe(F.col(name)) for name, number in numbers.items()])
    carried = {name: F.when(told, number) for name, number in numbers.items()}
    return rows.select(*[carried.get(name, F.col(name)).alias(name) for name in rows.columns], F.when(~told, F.array(*types)).alias("_texts"))


def as_texts(rows: DataFrame, *names: str) -> DataFrame:
    """``rows`` with the texts that ``as_numbers`` took in, named in the same order."""
    texts = {n: F.when(F.col("_texts").isNull(), F.col(n).cast("string")).otherwise(F.get("_texts", F.lit(i))) for i, n in enumerate(names)}
    return rows.withColumns(texts).drop("_texts")


def dictionary_join(facts: DataFrame, dictionary: DataFrame, code: str, name: str, how: str = "inner") -> DataFrame:
    """Add the dictionary name of ``facts[code]`` as column ``name``.

    ``dictionary`` has ``dic_code`` and the nested ``info.dic_name``. ``inner`` drops unknown codes.
    """
    side = dictionary.select(F.col("dic_code").alias(f"_{name}_code"), F.col("info.dic_name").alias(name))
    return facts.join(side, F.col(code) == F.col(f"_{name}_code"), how).drop(f"_{name}_code")


def look_up(rows: DataFrame, dim: DataFrame, key: str, dim_key: str, **columns: str) -> DataFrame:
    """Left join one dimension; keywords name the new columns: ``look_up(…, sku_name='name')``.

    A missing dimension row gives nulls.
    """
    side = dim.select(F.col(dim_key).alias("_dim_key"), *[F.col(src).alias(new) for new, src in columns.items()])
    return rows.join(side, F.col(key) == F.col("_dim_key"), "left").drop("_dim_key")


def _meeting(key: Column) -> Column:
    """A second key that is 0 for every key, which Catalyst cannot know.

    A side that comes straight from an aggregate by the key is already dealt out by it, and AQE splits
    hot keys only between two exchanges of the join's own. One more key makes the join ask for both.
    """
    return F.pmod(F.hash(key), F.lit(1))


def flag_members(rows: DataFrame, words: DataFrame, column: str, word: str = "word", flag: str = "is_member") -> DataFrame:
    """Add whether ``column`` is in the word list; null and empty strings are not."""
    listed = words.select(F.col(word).alias("_word")).where(F.coalesce("_word", F.lit("")) != "").distinct()
    joined = _left_by_key(rows, listed, F.col(column), "_word", [c for c in rows.columns])
    return joined.withColumn(flag, F.col("_word").isNotNull()).drop("_word")


def members_only(rows: DataFrame, words: DataFrame, column: str, word: str = "word") -> DataFrame:
    return rows.join(words.select(F.col(word).alias("_word")), F.col(column) == F.col("_word"), "left_semi")


def non_members(rows: DataFrame, words: DataFrame, column: str, word: str = "word") -> DataFrame:
    return rows.join(words.select(F.col(word).alias("_word")), F.col(column) == F.col("_word"), "left_anti")


NO_KEY_PARTS = 256


def _left_by_key(rows: DataFrame, side: DataFrame, key: Column, side_key: str, spread_by: list[str]) -> DataFrame:
    """Left join on one key, either side possibly hot or straight from an aggregate.

    Rows without a key match nothing and are dealt out by ``spread_by`` instead of meeting in one task.
    """
    nowhere = F.pmod(F.xxhash64(*spread_by), F.lit(NO_KEY_PARTS)).cast("int") + 1
    left = rows.withColumn("_meet", F.when(key.isNull(), nowhere).otherwise(_meeting(key)))
    right = side.withColumn("_side_meet", _meeting(F.col(side_key)))
    return left.join(right, (key == F.col(side_key)) & (F.col("_meet") == F.col("_side_meet")), "left").drop("_meet", "_side_meet")


def join_key_facts(rows: DataFrame, facts: DataFrame, key: str, *values: str, spread_by: list[str]) -> DataFrame:
    """Left join ``rows`` to ``facts``, an aggregate of the same rows with one row per key."""
    side = facts.select(F.col(key).alias("_fact_key"), *[F.col(v).alias(f"_fact_{v}") for v in values])
    joined = _left_by_key(rows, side, F.col(key), "_fact_key", spread_by)
    return joined.select(*rows.columns, *[F.col(f"_fact_{v}").alias(v) for v in values])
