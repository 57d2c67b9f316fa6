"""JSON checks and access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def is_json_object(text: Column) -> Column:
    """True when the *whole* text is one JSON object.

    The readers stop after the first value and so let trailing text pass. Wrapped in brackets and
    in braces, trailing text turns into an error in at least one of the two wrappings: what follows
    the object would have to be ``]`` for the first and ``}`` for the second. A comma makes the
    bracketed list longer than one. Of the object no field is asked for but one of an odd name, so that the
    others are read through and not copied.
    """
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<struct<`_`: string>>", _STRICT)
    nested = F.from_json(F.concat(F.lit('{"w":'), text, F.lit("}")), "struct<w: struct<`_`: string>>", _STRICT)
    # the list is named once, so that it is parsed once
    single = F.exists(F.array(listed), lambda a: (F.size(a) == 1) & F.get(a, 0).isNotNull())
    return F.coalesce(single & nested["w"].isNotNull(), F.lit(False))


def parse_once(lines: DataFrame, schema: T.StructType | str, column: str = "value", keep: list[str] = ()) -> DataFrame:
    """The parsed fields as columns, after the columns in ``keep``.

    A filter on a field of a projected ``from_json`` is pushed below the projection, and the line is
    then parsed again for every condition. A generator is a stop for that: conditions stay above it.
    """
    return lines.select(*keep, F.inline(F.array(F.from_json(F.col(column), schema))))


def mark_objects(lines: DataFrame, column: str = "value", mark: str = "is_object") -> DataFrame:
    """Add whether the line is one JSON object, decided once however many filters use it."""
    return lines.select("*", F.inline(F.array(F.struct(is_json_object(F.col(column)).alias(mark)))))


def append_to_json_list(text: Column, element: Column) -> Column:
    """Append to a JSON list of strings; a null list starts empty. The result is valid JSON."""
    items = F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))
    return F.to_json(F.concat(items, F.array(element)))


def row_to_json(df, drop: tuple[str, ...] = ()) -> Column:
    """The row as JSON text without the columns in ``drop``."""
    return F.to_json(F.struct(*[c for c in df.columns if c not in drop]))
