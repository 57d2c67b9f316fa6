"""Daily reports over the metric tables, and their chart payloads.

``day`` is the integer day partition ``yyyyMMdd``; it filters the partition column ``cur_date`` of
the stored table. Without it every day is reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The two labels that the charts show.
TURNOVER_LABEL = "交易额"
CHANNEL_LABEL = "渠道"


def _dates(table: DataFrame, day: int | None) -> DataFrame:
    if day is None:
        return table
    text = str(day)
    return table.where(F.col("cur_date") == f"{text[:4]}-{text[4:6]}-{text[6:]}")


def gmv(provinces: DataFrame, day: int | None = None) -> DataFrame:
    return _dates(provinces, day).groupBy("cur_date").agg(F.sum("order_amount").alias("order_amount"))


def province_gmv(provinces: DataFrame, day: int | None = None) -> DataFrame:
    return (_dates(provinces, day).groupBy("cur_date", "province_name")
            .agg(F.sum("order_amount").alias("order_amount")))


def channel_visitors(traffic: DataFrame, day: int | None = None, limit: int = 10) -> DataFrame:
    """The channels with most visitors of each day; equal counts in channel order."""
    sums = _dates(traffic, day).groupBy("cur_date", "ch").agg(F.sum("uv_ct").alias("uv_ct"))
    if day is not None:
        return sums.orderBy(F.desc("uv_ct"), "ch").limit(limit)
    rank = F.row_number().over(Window.partitionBy("cur_date").orderBy(F.desc("uv_ct"), "ch"))
    return sums.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def gmv_payload(report: DataFrame) -> DataFrame:
    return report.select("cur_date", F.to_json(F.struct(F.lit(0).alias("status"),
                                                        F.col("order_amount").alias("data"))).alias("payload"))


def province_payload(report: DataFrame) -> DataFrame:
    """One map payload per day, provinces by name. Its length is the number of provinces."""
    items = F.array_sort(F.collect_list(F.struct(F.col("province_name").alias("name"),
                                                 F.col("order_amount").alias("value"))))
    data = F.struct(F.col("items").alias("mapData"), F.lit(TURNOVER_LABEL).alias("valueName"))
    return (report.groupBy("cur_date").agg(items.alias("items"))
            .select("cur_date", F.to_json(F.struct(F.lit(0).alias("status"), data.alias("data"))).alias("payload")))


def channel_payload(report: DataFrame) -> DataFrame:
    """One bar-chart payload per day from a top-channel report."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("uv_ct")).alias("n"), "ch")))
    series = F.array(F.struct(F.lit(CHANNEL_LABEL).alias("name"), F.transform("o", lambda x: -x["n"]).alias("data")))
    data = F.struct(F.transform("o", lambda x: x["ch"]).alias("categories"), series.alias("series"))
    return (report.groupBy("cur_date").agg(ordered.alias("o"))
            .select("cur_date", F.to_json(F.struct(F.lit(0).alias("status"), data.alias("data"))).alias("payload")))
