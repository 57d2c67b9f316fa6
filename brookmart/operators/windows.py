"""Tumbling windows with labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.functions.dates import DATE, DATETIME


def labels(window: str = "window") -> list[Column]:
    return [F.date_format(f"{window}.start", DATETIME).alias("stt"),
            F.date_format(f"{window}.end", DATETIME).alias("edt"),
            F.date_format(f"{window}.start", DATE).alias("cur_date")]


def tumble(df: DataFrame, ts: str, size: str, keys: list[str], *aggs: Column) -> DataFrame:
    """Epoch-aligned tumbling windows → stt, edt, cur_date, keys, aggregates.

    Without keys the window is global; partial aggregation still runs in every task.
    """
    grouped = df.groupBy(F.window(ts, size).alias("window"), *keys).agg(*aggs)
    return grouped.select(*labels(), *[c for c in grouped.columns if c != "window"])


def total(column: str, alias: str | None = None) -> Column:
    return F.sum(column).alias(alias or column)
