"""Epoch and label conversions, all in the session zone. Malformed text gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE = "yyyy-MM-dd"
DATETIME = "yyyy-MM-dd HH:mm:ss"
DAY_NUMBER = "yyyyMMdd"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def millis_to_date(ms) -> Column:
    return F.date_format(F.timestamp_millis(_col(ms)), DATE)


def millis_to_datetime(ms) -> Column:
    return F.date_format(F.timestamp_millis(_col(ms)), DATETIME)


def millis_to_day_number(ms) -> Column:
    return F.date_format(F.timestamp_millis(_col(ms)), DAY_NUMBER)


def datetime_to_millis(text) -> Column:
    return F.unix_millis(F.try_to_timestamp(_col(text), F.lit(DATETIME)))


def date_to_millis(text) -> Column:
    return F.unix_millis(F.try_to_timestamp(_col(text), F.lit(DATE)))


def _text_millis_to_seconds(text) -> Column:
    return F.timestamp_seconds(F.floor(_col(text).try_cast("bigint") / F.lit(1000)).cast("bigint"))


def text_millis_to_date(text) -> Column:
    """``'1714500000123'`` → ``'2024-04-30'``."""
    return F.date_format(_text_millis_to_seconds(text), DATE)


def text_millis_to_datetime(text) -> Column:
    return F.date_format(_text_millis_to_seconds(text), DATETIME)


def day_number(day) -> Column:
    """A date as the integer ``yyyyMMdd`` that names a day partition."""
    d = _col(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def today_number() -> Column:
    return day_number(F.current_date())


def day_numbers(first, last) -> Column:
    """Every day partition from ``first`` to ``last`` inclusive; empty when ``first`` is later."""
    f, l = _col(first), _col(last)
    days = F.sequence(f, F.greatest(f, l), F.expr("interval 1 day"))
    return F.when(f <= l, F.transform(days, day_number)).otherwise(F.array().cast("array<int>"))


def pick_event_time(preferred, fallback) -> Column:
    """Epoch seconds, the preferred field first, as a timestamp."""
    return F.timestamp_seconds(F.coalesce(_col(preferred), _col(fallback)))


def pick_window_start(batch) -> Column:
    """``window_start_time`` (ms) of the first record of a list."""
    return F.timestamp_millis(F.get(_col(batch), 0)["window_start_time"])


def epoch_to_millis(epoch) -> Column:
    """Seconds or milliseconds → milliseconds; ten digits and fewer are seconds."""
    e = _col(epoch)
    return F.when(e < F.lit(10_000_000_000), e * 1000).otherwise(e)
