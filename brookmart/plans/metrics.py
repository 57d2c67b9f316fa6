"""Windowed metrics, batch form. The streaming form of each job is in ``brookmart.streaming.jobs``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.operators.joins import look_up
from brookmart.operators.keywords import explode_words
from brookmart.operators.logs import home_or_detail, keyword_search, login_visit, session_start
from brookmart.operators.versions import newest_per_key
from brookmart.operators.visits import first_of_day, login_days
from brookmart.operators.windows import labels, total, tumble

TRAFFIC_KEYS = ["vc", "ch", "ar", "is_new"]
TRAFFIC_MEASURES = ["uv_ct", "sv_ct", "pv_ct", "dur_sum"]
AMOUNTS = ["original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_amount"]


def _count(n: int, name: str) -> Column:
    return F.lit(n).cast("bigint").alias(name)


def page_measures(pages: DataFrame) -> DataFrame:
    """Every page view as measures, without the visitor count."""
    return pages.select("et", *TRAFFIC_KEYS, _count(0, "uv_ct"), session_start().alias("sv_ct"),
                        _count(1, "pv_ct"), F.col("during_time").cast("bigint").alias("dur_sum"))


def visitor_measures(firsts: DataFrame) -> DataFrame:
    """First views of the day as measures that only count the visitor."""
    return firsts.select("et", *TRAFFIC_KEYS, _count(1, "uv_ct"), _count(0, "sv_ct"), _count(0, "pv_ct"),
                         _count(0, "dur_sum"))


def traffic_window(pages: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Visitors, sessions, views and stay time per version, channel, area and new flag.

    Views go straight into the window sums and only the first views of a day are shuffled by
    visitor; both meet in one aggregate. No raw row is shuffled.
    """
    firsts = first_of_day(pages, ["mid"], carry=TRAFFIC_KEYS)
    measures = page_measures(pages).unionByName(visitor_measures(firsts))
    return tumble(measures, "et", size, TRAFFIC_KEYS, *map(total, TRAFFIC_MEASURES))


def page_flags(firsts: DataFrame) -> DataFrame:
    home = F.when(F.col("page_id") == "home", 1).otherwise(0).cast("bigint")
    return firsts.select("et", home.alias("home_uv_ct"), (1 - home).alias("good_detail_uv_ct"))


def home_detail_window(pages: DataFrame, size: str = "3 seconds") -> DataFrame:
    """Unique visitors of the home and the detail page."""
    firsts = first_of_day(pages.where(home_or_detail()), ["mid", "page_id"])
    return tumble(page_flags(firsts), "et", size, [], total("home_uv_ct"), total("good_detail_uv_ct"))


def login_window(pages: DataFrame, size: str = "3 hours", back_days: int = 8) -> DataFrame:
    """Unique and returning users."""
    days = login_days(pages.where(login_visit()), back_days=back_days)
    return tumble(days, "et", size, [], total("back_ct"), total("uu_ct"))


def cart_window(cart: DataFrame, size: str = "5 seconds") -> DataFrame:
    """Users who put something into the cart for the first time that day."""
    firsts = first_of_day(cart.select("user_id", F.timestamp_millis("ts").alias("et")), ["user_id"])
    return tumble(firsts, "et", size, [], F.count(F.lit(1)).alias("cart_add_uu_ct"))


def keyword_window(pages: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Words of search phrases. Works on batch and streaming pages alike."""
    searches = pages.where(keyword_search()).select("et", "item")
    return tumble(explode_words(searches, "item"), "et", size, ["keyword"],
                  F.count(F.lit(1)).alias("keyword_count"))


MONEY = "decimal(16,2)"
DETAIL_AMOUNTS = {"split_original_amount": "original_amount", "split_activity_amount": "activity_reduce_amount",
                  "split_coupon_amount": "coupon_reduce_amount", "split_total_amount": "order_amount"}


def malformed_amounts(details: DataFrame) -> DataFrame:
    """Order details with an amount that is no number, for the dirty feed; the windows leave them out."""
    bad = F.lit(False)
    for c in DETAIL_AMOUNTS:
        bad = bad | (F.col(c).isNotNull() & F.col(c).try_cast(MONEY).isNull())
    return details.where(bad)


def order_measures(details: DataFrame) -> DataFrame:
    """The order-detail feed with typed amounts, without the rows of ``malformed_amounts``.

    Each amount is cast once: the casts are elements of an array that is exploded, and the filter behind it cannot be moved below.
    """
    amounts = F.struct(*[F.col(c).try_cast(MONEY).alias(name) for c, name in DETAIL_AMOUNTS.items()],
                       F.struct(*[F.col(c).isNull().alias(c) for c in DETAIL_AMOUNTS]).alias("missing"))
    rows = details.select("id", "order_id", "sku_id", "province_id", "ts", F.explode(F.array(amounts)).alias("m"))
    good = F.lit(True)
    for c, name in DETAIL_AMOUNTS.items():
        good = good & (F.col("m")[name].isNotNull() | F.col("m.missing")[c])
    return rows.where(good).select("id", "order_id", "sku_id", "province_id", "ts", F.timestamp_millis("ts").alias("et"),
                                   *[F.col("m")[name].alias(name) for name in DETAIL_AMOUNTS.values()])


def newest_details(details: DataFrame, tie_break: list[str] = ()) -> DataFrame:
    """One measure row per detail id, the newest version."""
    measures = order_measures(details)
    ties = list(tie_break) or ["order_id", "sku_id", "province_id", *AMOUNTS]
    return newest_per_key(measures, ["id"], ["ts", *ties])


def sku_window(details: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Amount sums per sku of the newest versions, without dimension names."""
    return tumble(newest_details(details), "et", size, ["sku_id"], *map(total, AMOUNTS))


def with_sku_dimensions(sums: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Add sku, spu, trademark and the three category levels; a missing row gives nulls.

    ``dims`` maps dim_sku_info, dim_spu_info, dim_base_trademark, dim_base_category3/2/1 to
    DataFrames with key ``id``. Runs after the aggregation, on its few rows. Sums that have their ``window`` yet are labelled after the joins.
    """
    out = look_up(sums, dims["dim_sku_info"], "sku_id", "id", sku_name="sku_name", spu_id="spu_id",
                  category3_id="category3_id", trademark_id="tm_id")
    out = look_up(out, dims["dim_spu_info"], "spu_id", "id", spu_name="spu_name")
    out = look_up(out, dims["dim_base_trademark"], "trademark_id", "id", trademark_name="tm_name")
    out = look_up(out, dims["dim_base_category3"], "category3_id", "id", category3_name="name",
                  category2_id="category2_id")
    out = look_up(out, dims["dim_base_category2"], "category2_id", "id", category2_name="name",
                  category1_id="category1_id")
    out = look_up(out, dims["dim_base_category1"], "category1_id", "id", category1_name="name")
    return out.select(*(labels() if "window" in out.columns else ["stt", "edt", "cur_date"]), "trademark_id", "trademark_name", "category1_id", "category1_name",
                      "category2_id", "category2_name", "category3_id", "category3_name", "sku_id", "sku_name",
                      "spu_id", "spu_name", *AMOUNTS)


def province_window(details: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Orders and amount per province of the newest versions, without the province name.

    Spark counts the distinct orders in two steps (per window, province and order, then per window
    and province), so a hot province is counted by many tasks.
    """
    return tumble(newest_details(details), "et", size, ["province_id"],
                  F.count_distinct("order_id").alias("order_count"), total("order_amount"))


def with_province_name(sums: DataFrame, provinces: DataFrame) -> DataFrame:
    out = look_up(sums, provinces, "province_id", "id", province_name="name")
    return out.select("stt", "edt", "cur_date", "province_id", "province_name", "order_count", "order_amount")


def missing_names(enriched: DataFrame, *names: str) -> DataFrame:
    """How many rows found no dimension row, per name column."""
    return enriched.agg(*[F.count_if(F.col(n).isNull()).alias(f"missing_{n}") for n in names])
