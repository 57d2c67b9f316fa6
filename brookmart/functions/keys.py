"""Row keys and salting buckets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket numbers reserved for very hot addresses.
HOT_ADDRESS_BUCKETS = {
    "0x0000000000000000000000000000000000000000": "9001",
    "0xdac17f958d2ee523a2206206994597c13d831ec7": "9002",
    "0x7a250d5630b4cf539739df2c5dacb4c659f2488d": "9003",
    "0xea674fdde714fd979de3edf0f56aa9716b898ec8": "9004",
    "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2": "9005",
    "0x0000000000000000000000000000000000000001": "9006",
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48": "9007",
}


def hash_bucket(value: Column, buckets: int = 128) -> Column:
    """Four-digit bucket from the last three hex digits of the md5."""
    tail = F.conv(F.right(F.md5(value.cast("string")), F.lit(3)), 16, 10).cast("int")
    return F.lpad((tail % F.lit(buckets)).cast("string"), 4, "0")


def hash_bucket_with_overrides(value: Column, overrides: dict[str, str] | None = None,
                               buckets: int = 128) -> Column:
    """``hash_bucket``, except that listed (lower-case) keys have their own bucket."""
    overrides = HOT_ADDRESS_BUCKETS if overrides is None else overrides
    plain = hash_bucket(value, buckets)
    if not overrides:
        return plain
    table = F.create_map(*[F.lit(x) for pair in overrides.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(value.cast("string"))), plain)


@dataclass(frozen=True)
class KeyPart:
    field: str
    md5: bool = False


def row_key(*parts: KeyPart | str, separator: str = "", md5: bool = False) -> Column:
    """Composite key: parts joined by ``separator``, each and the whole optionally hashed."""
    cells = []
    for part in parts:
        part = KeyPart(part) if isinstance(part, str) else part
        cell = F.col(part.field).cast("string")
        cells.append(F.md5(cell) if part.md5 else cell)
    key = F.concat_ws(separator, *cells)
    return F.md5(key) if md5 else key
