"""String helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_list(items: Column, delimiter: str) -> Column:
    """Null list → null, null element → the word ``null``."""
    return F.array_join(items, delimiter, "null")


def to_csv_text(items: Column) -> Column:
    return join_list(items, ", ")


def capitalise_first(s: Column) -> Column:
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substr(s, F.lit(2)))


def lowercase_first(s: Column) -> Column:
    return F.concat(F.lower(F.substring(s, 1, 1)), F.substr(s, F.lit(2)))


def zeros(n: Column) -> Column:
    return F.repeat(F.lit("0"), n)


def is_empty(s: Column) -> Column:
    return F.coalesce(s, F.lit("")) == ""


def is_blank(s: Column) -> Column:
    return F.coalesce(s, F.lit("")).rlike(r"^[\x00-\x20]*$")


# Punctuation accepted besides CJK ideographs, Latin letters and digits.
ALLOWED_PUNCTUATION = "[]-_+{}:：“<>`?!—·~@#$%^&*(、，。；‘【】！￥…（）)\""


def only_allowed_characters(s: Column) -> Column:
    """True when the whole, non-empty string uses allowed characters only."""
    letters = "一-龥a-zA-Z0-9"
    marks = "".join(re.escape(ch) if ch.isascii() else ch for ch in ALLOWED_PUNCTUATION)
    return s.rlike(rf"\A[{letters}{marks}]+\z")


def camel_case(name: str) -> str:
    """``order_detail_id`` or ``ORDER_DETAIL_ID`` → ``orderDetailId``."""
    head, *rest = name.lower().split("_")
    return head + "".join(w[:1].upper() + w[1:] for w in rest)
