"""Explicit schemas of every feed and table."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


_CELLS = T.MapType(T.StringType(), T.StringType())

ENVELOPE = T.StructType([
    T.StructField("before", _CELLS),
    T.StructField("after", _CELLS),
    T.StructField("source", _CELLS),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
])

LOG_COMMON = T.StructType(_strings("ar", "uid", "os", "ch", "is_new", "md", "mid", "vc", "ba", "sid"))

LOG_PAGE = T.StructType(
    _strings("page_id", "item", "item_type", "last_page_id")
    + [T.StructField("during_time", T.LongType()),
       T.StructField("from_pos_id", T.IntegerType()),
       T.StructField("from_pos_seq", T.IntegerType())])

# start, err, displays and actions are passed on unread, so they stay open maps.
LOG = T.StructType([
    T.StructField("common", LOG_COMMON),
    T.StructField("page", LOG_PAGE),
    T.StructField("start", _CELLS),
    T.StructField("err", _CELLS),
    T.StructField("displays", T.ArrayType(_CELLS)),
    T.StructField("actions", T.ArrayType(_CELLS)),
    T.StructField("ts", T.LongType()),
])

PAGE_LOG = T.StructType([
    T.StructField("common", LOG_COMMON),
    T.StructField("page", LOG_PAGE),
    T.StructField("ts", T.LongType()),
])

DIM_CONFIG = T.StructType(
    _strings("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key", "op"))

FACT_CONFIG = T.StructType(
    _strings("source_table", "source_type", "sink_table", "sink_columns", "op"))

ORDER_DETAIL = T.StructType(
    _strings("id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
             "activity_rule_id", "coupon_id", "date_id", "create_time", "sku_num",
             "split_original_amount", "split_activity_amount", "split_coupon_amount",
             "split_total_amount")
    + [T.StructField("ts", T.LongType())])

CART_ADD = T.StructType(_strings("id", "user_id", "sku_id", "sku_num") + [T.StructField("ts", T.LongType())])
