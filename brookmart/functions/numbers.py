"""Hexadecimal quantities."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 16^31 < 10^38: the widest value a decimal(38,0) always holds.
NARROW_DIGITS = 31
_HALF = 15


@F.pandas_udf(T.StringType())
def _wide_hex(digits: pd.Series) -> pd.Series:
    return digits.map(lambda d: None if d is None else str(int(d, 16)))


def _narrow_hex(digits: Column) -> Column:
    """Two halves of at most 15 (60 bits) and 16 digits, combined as decimals."""
    padded = F.lpad(digits, NARROW_DIGITS, "0")
    high = F.conv(F.substring(padded, 1, _HALF + 1), 16, 10).cast("decimal(20,0)")
    low = F.conv(F.substring(padded, _HALF + 2, _HALF), 16, 10).cast("decimal(20,0)")
    # 16^15 = 2^60
    return (high * F.lit(1 << 60).cast("decimal(19,0)")).cast("decimal(38,0)") + low


def _shift_18(plain: Column) -> Column:
    """Divide a plain decimal text by 10^18 by moving the point; no trailing zeros.

    Each step reads its input once, which keeps the generated code linear.
    """
    steps = [
        (r"^\+?(-?)(\d+)\.?(\d*)$", "$1" + "0" * 18 + "$2|$3"),
        (r"(\d{18})\|", ".$1"),
        (r"\.?0*$", ""),
        (r"^(-?)0+(?=\d)", "$1"),
    ]
    for pattern, replacement in steps:
        plain = F.regexp_replace(plain, pattern, replacement)
    # nothing left before the point
    return F.regexp_replace(plain, r"^(-?)(?=\.|$)", "$10")


def hex_to_decimal_text(value: Column, to_ether: bool = False) -> Column:
    """``0x…`` or decimal text → plain decimal text, optionally ÷10^18; null → ``'0'``.

    Up to 31 hex digits stay in built-in functions; wider ones go through an Arrow batch, narrower
    ones through it as null. Decimal text may have an exponent.
    """
    digits = F.ltrim(F.substr(value, F.lit(3)), F.lit("0"))
    is_hex = value.startswith("0x")
    is_wide = is_hex & (F.length(digits) > NARROW_DIGITS)
    from_hex = F.when(is_wide, _wide_hex(F.when(is_wide, digits))).otherwise(_narrow_hex(digits).cast("string"))
    plain = F.when(is_hex, from_hex).otherwise(_without_exponent(value))
    if to_ether:
        plain = _shift_18(plain)
    return F.when(value.isNull(), F.lit("0")).otherwise(plain)


def _without_exponent(number: Column) -> Column:
    """``1.5E+3`` → ``1500``, ``12e-3`` → ``0.012``; text without an exponent stays as it is."""
    def part(i: int) -> Column:
        return F.regexp_extract(number, r"^([+-]?)(\d*)\.?(\d*)[eE]([+-]?\d+)$", i)

    power = part(4).try_cast("int")
    whole, fraction = part(2), part(3)
    left = F.concat(whole, F.rpad(fraction, F.greatest(F.length(fraction), power), "0"))
    up = F.concat(F.substring(left, F.lit(1), F.length(whole) + power), F.lit("."), F.substr(left, F.length(whole) + power + 1))
    padded = F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(0), -power - F.length(whole) + 1)), whole)
    cut = F.length(padded) + power
    down = F.concat(F.substring(padded, F.lit(1), cut), F.lit("."), F.substr(padded, cut + 1), fraction)
    moved = F.when(power >= 0, up).otherwise(down)
    plain = F.regexp_replace(F.regexp_replace(moved, r"^0+(?=\d)", ""), r"^\.", "0.")
    plain = F.regexp_replace(F.regexp_replace(plain, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    signed = F.concat(F.when(part(1) == "-", "-").otherwise(""), plain)
    return F.when(number.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)[eE][+-]?\d+$"), signed).otherwise(number)


def hex_words(data: Column) -> Column:
    """Cut a ``0x`` payload into ``0x`` words of 64 hex digits; empty or null → empty array."""
    n = F.floor(F.length(data) / 64).cast("int")
    words = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1),
                        lambda i: F.concat(F.lit("0x"), F.substring(data, i * 64 + 3, F.lit(64))))
    return F.when(n >= 1, words).otherwise(F.array().cast("array<string>"))
