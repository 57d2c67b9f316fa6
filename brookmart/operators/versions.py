"""Several versions of one keyed row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The newest version of each key; ``order`` lists columns, later is newer, and must break ties.

    ``row_number() = 1`` makes Spark limit each group before the shuffle (WindowGroupLimit), so a
    task sends at most one row per key, however many versions a key has.
    """
    newest_first = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first)))
    return ranked.where("_rank = 1").drop("_rank")
