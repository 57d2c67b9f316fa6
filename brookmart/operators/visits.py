"""Keyed visit logic in batch form.

The streaming forms keep the same facts in a state store (``brookmart.streaming.state``). Here they
are aggregates, not ordered windows over raw rows: partial aggregation runs before the shuffle, so
a visitor with a third of all rows sends one row per task and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from brookmart.functions.dates import DATE
from brookmart.operators.joins import join_key_facts


def first_of_day(df: DataFrame, keys: list[str], ts: str = "et", carry: list[str] = ()) -> DataFrame:
    """The first event of each key and day → keys, ``visit_date``, ``ts`` and the carried columns.

    Carried columns are grouped first, so that the hash aggregate works on the raw rows and only
    its few results go through the order-sensitive one.
    """
    day = F.date_format(ts, DATE).alias("visit_date")
    if not carry:
        return df.groupBy(*keys, day).agg(F.min(ts).alias(ts))
    firsts = df.groupBy(*keys, day, *carry).agg(F.min(ts).alias(ts))
    best = firsts.groupBy(*keys, "visit_date").agg(F.min(F.struct(ts, *carry)).alias("f"))
    return best.select(*keys, "visit_date", "f.*")


def first_visits(df: DataFrame, key: str = "mid", is_new: str = "is_new", ts: str = "et") -> DataFrame:
    """Per visitor the first-visit date: the day before, if the first event already says "not new"."""
    first = F.min(F.struct(F.col(ts).alias("t"), F.col(is_new).alias("n")))
    # min per (visitor, flag) is hash-aggregated; at most a few flags per visitor reach the second step
    part = df.where(F.col(key).isNotNull()).groupBy(key, is_new).agg(F.min(ts).alias(ts))
    one = part.groupBy(key).agg(first.alias("f"))
    date = F.when(F.col("f.n") == "1", F.date_format("f.t", DATE)).otherwise(
        F.date_format(F.col("f.t") - F.expr("interval 1 day"), DATE))
    return one.select(key, date.alias("first_date"))


def repair_is_new(df: DataFrame, key: str = "mid", is_new: str = "is_new", ts: str = "et",
                  spread_by: list[str] = ("et",), visits: DataFrame | None = None) -> DataFrame:
    """Set ``is_new`` to 0 where it says 1 on another day than the first visit's.

    Only rows that say 1 can change, so only their visitor is a join key; the others pass like rows
    without a visitor. ``visits`` may give ``first_visits`` from a cheaper reading of the same rows.
    The stream form decides by the rows seen so far: a visitor whose earliest row arrives in a later
    micro-batch is dated by an earlier arrival there, and by the earliest row here.
    """
    asked = df.withColumn("_asked", F.when(F.col(is_new) == "1", F.col(key)))
    facts = (first_visits(df, key, is_new, ts) if visits is None else visits).withColumnRenamed(key, "_asked")
    joined = join_key_facts(asked, facts, "_asked", "first_date", spread_by=list(spread_by))
    stale = (F.col(is_new) == "1") & (F.col("first_date") != F.date_format(ts, DATE))
    return joined.withColumn(is_new, F.when(stale, "0").otherwise(F.col(is_new))).drop("first_date", "_asked")


def login_days(df: DataFrame, key: str = "uid", ts: str = "et", back_days: int = 8) -> DataFrame:
    """One row per user and day: ``uu_ct`` = 1, ``back_ct`` = 1 after a gap of ``back_days`` or more.

    The ordered window sees one row per user and day, never raw events.
    """
    days = df.groupBy(key, F.to_date(ts).alias("_day")).agg(F.min(ts).alias(ts))
    gap = F.date_diff("_day", F.lag("_day").over(Window.partitionBy(key).orderBy("_day")))
    back = F.when(gap >= back_days, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    return days.select(key, ts, F.lit(1).cast("bigint").alias("uu_ct"), back.alias("back_ct"))
