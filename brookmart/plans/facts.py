"""Fact tables from change-data envelopes.

Each builder takes the envelope DataFrame, batch or streaming. On streams ``within`` bounds how far
apart in event time joined rows may be (the state would otherwise grow without end); there is no
default, because matches further apart are lost. ``brookmart.streaming.keyed`` has the forms without a bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.functions.dates import text_millis_to_date, text_millis_to_datetime
from brookmart.operators.cdc import cart_increases, cells, changes_of, transition
from brookmart.operators.joins import as_numbers, as_texts, dictionary_join, fact_join, interval_join

WATERMARK = "3 seconds"


def _timed(df: DataFrame, name: str, delay: str = WATERMARK) -> DataFrame:
    """Add event time ``name`` from ``ts``, watermarked on streams only."""
    timed = df.withColumn(name, F.timestamp_millis("ts"))
    return timed.withWatermark(name, delay) if df.isStreaming else timed


def comment_rows(db: DataFrame) -> DataFrame:
    comments = changes_of(db, "comment_info").select(
        *cells("id", "user_id", "sku_id", "appraise", "comment_txt"), F.col("ts_ms").alias("ts"))
    return comments.where(F.col("id").isNotNull())


def named_comments(comments: DataFrame, dictionary: DataFrame) -> DataFrame:
    named = dictionary_join(comments, dictionary, "appraise", "appraise_name", "left")
    return named.select("id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts")


def comment_info(db: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Comments with the name of their appraisal; unknown codes keep a null name."""
    return named_comments(comment_rows(db), dictionary)


def cart_add(db: DataFrame) -> DataFrame:
    return cart_increases(db)


def order_detail_rows(db: DataFrame) -> DataFrame:
    original = (F.col("after")["sku_num"].try_cast("decimal(16,2)")
                * F.col("after")["order_price"].try_cast("decimal(16,2)")).cast("string")
    return changes_of(db, "order_detail", "c").select(
        *cells("id", "order_id", "sku_id", "sku_name", "create_time", "sku_num"),
        original.alias("split_original_amount"),
        *cells("split_activity_amount", "split_coupon_amount", "split_total_amount"), F.col("ts_ms").alias("ts"))


def created_orders(db: DataFrame) -> DataFrame:
    return changes_of(db, "order_info", "c").select(*cells("user_id", "province_id", oi_id="id"), F.col("ts_ms").alias("ts"))


def detail_activities(db: DataFrame) -> DataFrame:
    return changes_of(db, "order_detail_activity", "c").select(
        *cells("activity_id", "activity_rule_id", act_id="order_detail_id"), F.col("ts_ms").alias("ts"))


def detail_coupons(db: DataFrame) -> DataFrame:
    return changes_of(db, "order_detail_coupon", "c").select(
        *cells("coupon_id", cou_id="order_detail_id"), F.col("ts_ms").alias("ts"))


# cells of a detail that are numbers in most feeds
CELL_NUMBERS = {"sku_id": "bigint", "create_time": "bigint", "sku_num": "int", "split_original_amount": "decimal(18,4)"} | dict.fromkeys(
    ("split_activity_amount", "split_coupon_amount", "split_total_amount"), "decimal(16,2)")


def assembled_details(details: DataFrame, orders: DataFrame, activities: DataFrame, coupons: DataFrame,
                      within: str | None = None) -> DataFrame:
    """Order details with their order and, where present, activity and coupon (17 columns).

    A detail is exchanged twice, by order and by id, and on streams kept in three states; what is no key is carried as numbers.
    """
    side = lambda rows, name: _timed(rows, name).drop("ts")
    details = as_numbers(details, **CELL_NUMBERS)
    joined = fact_join(_timed(details, "et"), side(orders, "oi_et"), {"order_id": "oi_id"}, "inner", "et", "oi_et", within).drop("oi_id", "oi_et")
    joined = fact_join(joined, side(activities, "act_et"), {"id": "act_id"}, "left", "et", "act_et", within).drop("act_id", "act_et")
    joined = fact_join(joined, side(coupons, "cou_et"), {"id": "cou_id"}, "left", "et", "cou_et", within)
    return as_texts(joined, *CELL_NUMBERS).select(
        "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
        "coupon_id", text_millis_to_date("create_time").alias("date_id"), "create_time", "sku_num",
        "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount", "ts")


def order_detail(db: DataFrame, within: str | None = None) -> DataFrame:
    return assembled_details(order_detail_rows(db), created_orders(db), detail_activities(db), detail_coupons(db), within)


_DETAIL_AMOUNTS = ("sku_num", "split_original_amount", "split_activity_amount", "split_coupon_amount")
_DETAIL_KEYS = ("order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
                "coupon_id")
# and those of an assembled detail
_ASSEMBLED_NUMBERS = dict.fromkeys(("user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id"), "bigint") | {
    name: kind for name, kind in CELL_NUMBERS.items() if name not in ("sku_id", "create_time")}
#: the cells of the order-detail fact that are numbers or a day in most feeds
DETAIL_NUMBERS = {**_ASSEMBLED_NUMBERS, "date_id": "date", "create_time": "bigint"}


def cancelled_orders(db: DataFrame) -> DataFrame:
    """Orders whose status went from 1001 to 1003."""
    return transition(db, "order_info", "order_status", "1003", before="1001").select(
        *cells("operate_time", oc_id="id"), F.col("ts_ms").alias("ts"))


def assembled_cancels(details: DataFrame, cancels: DataFrame, within: str | None = None) -> DataFrame:
    """Details of cancelled orders (17 columns)."""
    cancels = _timed(cancels, "oc_et").withColumnRenamed("ts", "oc_ts")
    details = as_numbers(details, **_ASSEMBLED_NUMBERS)
    joined = fact_join(_timed(details, "et"), cancels, {"order_id": "oc_id"}, "inner", "et", "oc_et", within)
    return as_texts(joined, *_ASSEMBLED_NUMBERS).select("id", *_DETAIL_KEYS, text_millis_to_date("operate_time").alias("date_id"),
                         text_millis_to_datetime("operate_time").alias("cancel_time"), *_DETAIL_AMOUNTS,
                         "split_total_amount", F.col("oc_ts").alias("ts"))


def order_cancel(db: DataFrame, details: DataFrame, within: str | None = None) -> DataFrame:
    return assembled_cancels(details, cancelled_orders(db), within)


def successful_payments(db: DataFrame) -> DataFrame:
    return transition(db, "payment_info", "payment_status", "1602", ops=()).select(
        *cells("callback_time", pi_order_id="order_id", payment_type_code="payment_type"), F.col("ts_ms").alias("ts"))


def _payment_columns(paid: DataFrame, dictionary: DataFrame) -> DataFrame:
    named = dictionary_join(paid, dictionary, "payment_type_code", "payment_type_name")
    return named.select(F.col("id").alias("order_detail_id"), *_DETAIL_KEYS, "payment_type_code",
                        "payment_type_name", "callback_time", *_DETAIL_AMOUNTS,
                        F.col("split_total_amount").alias("split_payment_amount"), F.col("pi_ts").alias("ts"))


BEFORE, AFTER = "30 minutes", "5 seconds"


def assembled_payments(details: DataFrame, payments: DataFrame, dictionary: DataFrame, before: str = BEFORE, after: str = AFTER) -> DataFrame:
    """Paid details: detail time from ``before`` to ``after`` the payment (18 columns)."""
    payments = _timed(payments, "pi_et").withColumnRenamed("ts", "pi_ts")
    details = as_numbers(details, **_ASSEMBLED_NUMBERS)
    paid = interval_join(payments, _timed(details, "et"), {"pi_order_id": "order_id"}, "pi_et", "et", before, after)
    return _payment_columns(as_texts(paid, *_ASSEMBLED_NUMBERS), dictionary)


def payment_success(db: DataFrame, details: DataFrame, dictionary: DataFrame,
                    before: str = BEFORE, after: str = AFTER) -> DataFrame:
    return assembled_payments(details, successful_payments(db), dictionary, before, after)


def refund_requests(db: DataFrame) -> DataFrame:
    return changes_of(db, "order_refund_info").select(
        *cells("id", "user_id", "order_id", "sku_id", "refund_reason_txt", "refund_num", "refund_amount",
               refund_type_code="refund_type", refund_reason_type_code="refund_reason_type",
               created="create_time"), F.col("ts_ms").alias("ts"))


def refunded_orders(db: DataFrame) -> DataFrame:
    return transition(db, "order_info", "order_status", "1005").select(
        *cells("province_id", oi_id="id"), F.col("ts_ms").alias("ts"))


def assembled_refunds(refunds: DataFrame, orders: DataFrame, dictionary: DataFrame, within: str | None = None) -> DataFrame:
    """Refund requests of orders that reached status 1005 (15 columns)."""
    joined = fact_join(_timed(refunds, "et"), _timed(orders, "oi_et").drop("ts"), {"order_id": "oi_id"}, "inner", "et", "oi_et", within)
    named = dictionary_join(joined, dictionary, "refund_type_code", "refund_type_name")
    named = dictionary_join(named, dictionary, "refund_reason_type_code", "refund_reason_type_name")
    return named.select("id", "user_id", "order_id", "sku_id", "province_id",
                        text_millis_to_date("created").alias("date_id"),
                        text_millis_to_datetime("created").alias("create_time"),
                        "refund_type_code", "refund_type_name", "refund_reason_type_code",
                        "refund_reason_type_name", "refund_reason_txt", "refund_num", "refund_amount", "ts")


def order_refund(db: DataFrame, dictionary: DataFrame, within: str | None = None) -> DataFrame:
    return assembled_refunds(refund_requests(db), refunded_orders(db), dictionary, within)


def paid_out(db: DataFrame) -> DataFrame:
    return transition(db, "refund_payment", "refund_status", "1602").select(
        *cells("id", "order_id", "sku_id", payment_type_code="payment_type", called_back="callback_time",
               refund_amount="total_amount"), F.col("ts_ms").alias("ts"))


def paid_out_refunds(db: DataFrame) -> DataFrame:
    return transition(db, "order_refund_info", "refund_status", "0705").select(
        *cells("refund_num", ri_order_id="order_id", ri_sku_id="sku_id"), F.col("ts_ms").alias("ts"))


def refund_closed_orders(db: DataFrame) -> DataFrame:
    return transition(db, "order_info", "order_status", "1006").select(
        *cells("user_id", "province_id", oi_id="id"), F.col("ts_ms").alias("ts"))


def assembled_refund_payments(paid: DataFrame, refunds: DataFrame, orders: DataFrame, dictionary: DataFrame,
                              within: str | None = None) -> DataFrame:
    """Paid-out refunds, matched by order and sku to the refund and by order to its order (12 columns)."""
    joined = fact_join(_timed(paid, "et"), _timed(refunds, "ri_et").drop("ts"), {"order_id": "ri_order_id", "sku_id": "ri_sku_id"}, "inner",
                       "et", "ri_et", within).drop("ri_et")
    joined = fact_join(joined, _timed(orders, "oi_et").drop("ts"), {"order_id": "oi_id"}, "inner", "et", "oi_et", within)
    named = dictionary_join(joined, dictionary, "payment_type_code", "payment_type_name")
    return named.select("id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code",
                        "payment_type_name", text_millis_to_date("called_back").alias("date_id"),
                        text_millis_to_datetime("called_back").alias("callback_time"),
                        "refund_num", "refund_amount", "ts")


def refund_payment_success(db: DataFrame, dictionary: DataFrame, within: str | None = None) -> DataFrame:
    return assembled_refund_payments(paid_out(db), paid_out_refunds(db), refund_closed_orders(db), dictionary, within)
