"""Keyed state for streams.

The batch forms of the same logic are aggregates (``brookmart.operators.visits`` and ``versions``).
Here each key keeps one small value in the state store. Before the shuffle, ``reduce_locally``
thins every Arrow batch to the rows that can matter, so that a hot key sends a few rows per batch.
Event time drives everything but the optional TTL, which makes a replay give the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from brookmart.functions.dates import DATE


def reduce_locally(df: DataFrame, keys: list[str], order: list[str], keep: str) -> DataFrame:
    """Per Arrow batch and key only the ``first`` or ``last`` row by ``order``. Stateless.

    The last row of every batch stays too: it carries the watermark.
    """
    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ordered = pdf.sort_values(order, kind="stable", ignore_index=True)
            kept = ~ordered.duplicated(keys, keep=keep)
            if len(kept):
                kept.iloc[-1] = True
            yield ordered[kept]

    return df.mapInPandas(thin, df.schema)


DAY_MS = 86_400_000


class _FirstOfDay(StatefulProcessor):
    """Key (…, day): passes the first row, then nothing; forgets the day once it is over."""

    def __init__(self, columns: list[str], ts: str) -> None:
        self.columns, self.ts = columns, ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("seen", T.BooleanType())]))

    def handleInputRows(self, key, rows, timerValues):
        if self.seen.exists():
            return
        first = min(rows, key=lambda r: tuple(("" if r[c] is None else r[c]) for c in self.columns))
        self.seen.update((True,))
        self.handle.registerTimer(first["_day_end"])
        yield Row(**{c: first[c] for c in self.columns})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_of_day(df: DataFrame, keys: list[str], delay: str, ts: str = "et", carry: list[str] = ()) -> DataFrame:
    """The first event of each key and day, as it arrives → ``ts``, keys, carried columns."""
    columns = [ts, *keys, *carry]
    day = F.date_trunc("day", ts)
    thin = df.select(*columns, F.date_format(ts, DATE).alias("visit_date"),
                     F.unix_millis(day + F.expr("interval 1 day")).alias("_day_end"))
    thin = reduce_locally(thin, [*keys, "visit_date"], columns, "first").withWatermark(ts, delay)
    schema = T.StructType([thin.schema[c] for c in columns])
    return thin.groupBy(*keys, "visit_date").transformWithState(
        statefulProcessor=_FirstOfDay(columns, ts), outputStructType=schema, outputMode="Append",
        timeMode="EventTime", eventTimeColumnName=ts)


class _LoginDays(StatefulProcessor):
    """Key user: the last login day."""

    def __init__(self, ts: str, back_days: int, keep_days: int | None) -> None:
        self.ts, self.back_days, self.keep_days = ts, back_days, keep_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType([T.StructField("day", T.IntegerType())]))

    def handleInputRows(self, key, rows, timerValues):
        last = self.last.get()[0] if self.last.exists() else None
        for row in sorted(rows, key=lambda r: r[self.ts]):
            if last is not None and row["_day"] <= last:
                continue
            gap = 0 if last is None else row["_day"] - last
            last = row["_day"]
            yield Row(**{self.ts: row[self.ts], "uu_ct": 1, "back_ct": int(gap >= self.back_days)})
        self.last.update((last,))
        if self.keep_days is not None:
            self.handle.registerTimer((last + 1 + self.keep_days) * DAY_MS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.last.exists() and (self.last.get()[0] + 1 + self.keep_days) * DAY_MS <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def login_days(df: DataFrame, delay: str, key: str = "uid", ts: str = "et", back_days: int = 8,
               keep_days: int | None = None) -> DataFrame:
    """One row per user and login day with ``uu_ct`` and ``back_ct``.

    The last day is kept for good, or with ``keep_days`` until the watermark is that many days past
    it; who comes back later than that counts as a new user.
    """
    if keep_days is not None and keep_days < back_days:
        raise ValueError("users forgotten before `back_days` could never come back")
    thin = df.select(key, ts, F.unix_date(F.to_date(ts)).alias("_day"))
    thin = reduce_locally(thin, [key, "_day"], [ts], "first").withWatermark(ts, delay)
    schema = T.StructType([thin.schema[ts], T.StructField("uu_ct", T.LongType()), T.StructField("back_ct", T.LongType())])
    return thin.groupBy(key).transformWithState(
        statefulProcessor=_LoginDays(ts, back_days, keep_days), outputStructType=schema, outputMode="Append",
        timeMode="EventTime", eventTimeColumnName=ts)


class _RepairIsNew(StatefulProcessor):
    """Key visitor: the first-visit date."""

    def __init__(self, columns: list[str], is_new: str, ts: str, ttl_ms: int | None) -> None:
        self.columns, self.is_new, self.ts, self.ttl_ms = columns, is_new, ts, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("date", T.StringType())])
        self.first = handle.getValueState("first", schema, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        if not self.first.exists():
            # the earliest row decides; only a visitor's first micro-batch is held back for it
            rows = sorted(rows, key=lambda r: r[self.ts])
            head = rows[0]
            self.first.update((head["_date"] if head[self.is_new] == "1" else head["_day_before"],))
        date = self.first.get()[0]
        for row in rows:
            if row["_asks"]:
                values = {c: row[c] for c in self.columns}
                if row["_date"] != date:
                    values[self.is_new] = "0"
                yield Row(**values)

    def close(self) -> None:
        pass


def _earliest_or_asking(batches: Iterator[pd.DataFrame], key: str, ts: str) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        ordered = pdf.sort_values(ts, kind="stable", ignore_index=True)
        yield ordered[~ordered.duplicated(key) | ordered["_asks"].astype(bool)]


def repair_is_new(df: DataFrame, key: str = "mid", is_new: str = "is_new", ts: str = "et",
                  ttl_ms: int | None = None) -> DataFrame:
    """Set ``is_new`` to 0 where it says 1 on another day than the first visit's.

    Rows pass in their micro-batch. Rows that do not say 1 and rows without a visitor cannot change
    and pass the state by; of the former the earliest per visitor and Arrow batch goes in, without
    its other columns, because it may date the first visit. With ``ttl_ms`` the first visit is
    forgotten after that much processing time without a first visit, as a bounded-state deployment
    may want. That makes the query one of processing time, which never runs dry: give it an interval
    trigger, not ``availableNow``.
    """
    columns = df.columns
    asks = F.coalesce((F.col(is_new) == "1") & F.col(key).isNotNull(), F.lit(False))
    light = [F.when(asks, F.col(c)).alias(c) for c in columns if c not in (key, is_new, ts)]
    dated = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        key, is_new, ts, *light, asks.alias("_asks"), F.date_format(ts, DATE).alias("_date"),
        F.date_format(F.col(ts) - F.expr("interval 1 day"), DATE).alias("_day_before"))
    few = dated.mapInPandas(lambda batches: _earliest_or_asking(batches, key, ts), dated.schema)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    fixed = few.groupBy(key).transformWithState(
        statefulProcessor=_RepairIsNew(columns, is_new, ts, ttl_ms), outputStructType=schema,
        outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None")
    return df.where(~asks | F.col(ts).isNull()).unionByName(fixed)
