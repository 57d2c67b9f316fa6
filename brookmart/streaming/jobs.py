"""The windowed metrics as streams: the builders of ``brookmart.plans.metrics`` behind watermarks and state.

Order windows, whose rows are replaced, are in ``brookmart.streaming.retraction``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.operators.logs import home_or_detail, login_visit
from brookmart.operators.windows import total, tumble
from brookmart.plans import metrics
from brookmart.streaming import state

TRAFFIC_DELAY = "1 second"
PAGE_DELAY = "3 seconds"
ORDERED = "0 seconds"


def traffic_window(pages: DataFrame, size: str = "10 seconds", delay: str = TRAFFIC_DELAY) -> DataFrame:
    """Views go straight into the window sums; only first views of a day pass through the state."""
    firsts = state.first_of_day(pages, ["mid"], delay, carry=metrics.TRAFFIC_KEYS)
    views = metrics.page_measures(pages.withWatermark("et", delay))
    measures = views.unionByName(metrics.visitor_measures(firsts))
    return tumble(measures, "et", size, metrics.TRAFFIC_KEYS, *map(total, metrics.TRAFFIC_MEASURES))


def home_detail_window(pages: DataFrame, size: str = "3 seconds", delay: str = PAGE_DELAY) -> DataFrame:
    firsts = state.first_of_day(pages.where(home_or_detail()), ["mid", "page_id"], delay)
    return tumble(metrics.page_flags(firsts), "et", size, [], total("home_uv_ct"), total("good_detail_uv_ct"))


def login_window(pages: DataFrame, size: str = "3 hours", back_days: int = 8, delay: str = ORDERED) -> DataFrame:
    days = state.login_days(pages.where(login_visit()), delay, back_days=back_days)
    return tumble(days, "et", size, [], total("back_ct"), total("uu_ct"))


def cart_window(cart: DataFrame, size: str = "5 seconds", delay: str = ORDERED) -> DataFrame:
    timed = cart.select("user_id", F.timestamp_millis("ts").alias("et"))
    firsts = state.first_of_day(timed, ["user_id"], delay)
    return tumble(firsts, "et", size, [], F.count(F.lit(1)).alias("cart_add_uu_ct"))


def keyword_window(pages: DataFrame, size: str = "10 seconds", delay: str = ORDERED) -> DataFrame:
    return metrics.keyword_window(pages.withWatermark("et", delay), size)
