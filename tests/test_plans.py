"""Plan shapes that matter at scale."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from brookmart import bindings as b
from brookmart.operators import joins, visits
from brookmart.operators.versions import newest_per_key
from brookmart.plans import facts, metrics
from brookmart.queries import QUERIES

BATCH = sorted(q for q in QUERIES if not q.endswith("_stream"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_single_task_collects(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name != "hex_decimal":  # its any-width column
        assert "Python" not in text and "ArrowEval" not in text


def test_versions_are_limited_before_the_shuffle(spark, sf_dir):
    text = plan(newest_per_key(b.order_details(b.batch_reader(spark, sf_dir)), ["id"], ["ts", "sku_id"]))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


def test_traffic_shuffles_no_raw_rows(spark, sf_dir):
    text = plan(metrics.traffic_window(b.page_views(b.batch_reader(spark, sf_dir))))
    lines = [line.lstrip(" :+-") for line in text.splitlines()]
    for i, line in enumerate(lines):
        if "Exchange" in line:
            below = next(x for x in lines[i + 1:] if "Sort [" not in x)
            assert "Aggregate" in below and "partial_" in below


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["pay_interval_join"](spark, sf_dir))
    assert "EqualTo(o_orderstatus,P)" in text
    scan = next(line for line in text.splitlines() if "FileScan" in line and "PushedFilters: [IsNotNull(o_orderstatus)" in line)
    assert "o_totalprice" not in scan.split("ReadSchema")[1]


def test_days_prune_partitions(spark, tmp_path):
    from brookmart.plans import reports
    from brookmart.sources.tables import MetricTable

    table = MetricTable(spark, str(tmp_path / "t"))
    table.apply(spark.sql("SELECT '2024-01-01' AS cur_date, 'A' AS province_name, 1.00 AS order_amount"), 0)
    text = plan(reports.gmv(table.read(), 20240101))
    assert "PartitionFilters: [isnotnull(cur_date" in text


@pytest.fixture
def skewed(spark):
    """Joins by shuffle only, and partitions of a few kilobytes count as large."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def largest_share(df) -> float:
    """Rows of the fullest task over the mean."""
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(counts) / (sum(counts) / len(counts))


@pytest.mark.parametrize("hot", ["half of the rows", "half without a visitor", "half not new"])
def test_hot_visitor_is_split(skewed, hot):
    n = F.col("id")
    mid = F.when(n % 2 == 0, None if "without" in hot else "hot").otherwise(F.concat(F.lit("m"), n))
    if "not new" in hot:
        mid = F.concat(F.lit("m"), n % 50)
    rows = skewed.range(0, 400_000, 1, 8).select(
        "id", mid.alias("mid"), F.when((n % 2 == 0) & F.lit("not new" in hot), "0").otherwise("1").alias("is_new"),
        F.timestamp_seconds(1704067200 + n % 200_000).alias("et"))
    fixed = visits.repair_is_new(rows, spread_by=["id"])
    assert largest_share(fixed) < 2
    assert "_meet" in plan(fixed).split("hashpartitioning(")[1].split("\n")[0]


def test_hot_word_is_split(skewed):
    n = F.col("id")
    rows = skewed.range(0, 400_000, 1, 8).select("id", F.when(n % 2 == 0, "the").otherwise(F.concat(F.lit("w"), n)).alias("word"))
    words = skewed.range(1000).select(F.when(F.col("id") == 0, "the").otherwise(F.concat(F.lit("w"), F.col("id"))).alias("word"))
    flagged = joins.flag_members(rows, words, "word")
    assert largest_share(flagged) < 2
    assert flagged.where("is_member").count() == 200_000 + 500


@pytest.mark.parametrize("name, scans", [("order_detail_fact", 4), ("refund_pay_fact", 3), ("refund_fact", 2), ("dirty_split", 1)])
def test_every_feed_is_read_once(spark, sf_dir, name, scans):
    assert plan(QUERIES[name](spark, sf_dir)).count("FileScan") <= scans


def test_dirty_lines_are_parsed_once(spark, sf_dir):
    assert plan(QUERIES["dirty_split"](spark, sf_dir)).count("from_json") <= 2


def test_paid_details_exchange_numbers_only(spark, sf_dir):
    """The texts of a detail are made behind the join of lines and orders."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = b.paid_details(b.batch_reader(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("split_total_amount") < plan.index("Join Inner") and "sku " not in plan[plan.index("Join Inner"):]


def test_log_lines_of_one_file_are_dealt_over_tasks(spark, tmp_path):
    """A small file is one split; its lines are made, and written for a stream, by several tasks."""
    events = spark.sql("SELECT id AS event_id, timestamp_seconds(1704067200 + id) AS ts, id % 3 AS user_id, 'view' AS event_type, 1.5D AS value, '{\"k\": 1}' AS props "
                       "FROM range(300) UNION ALL SELECT null, null, null, 'click', null, null")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    read = b.batch_reader(spark, str(tmp_path))
    lines = b.cut_log_lines(read)
    used = {r.p for r in lines.select(F.spark_partition_id().alias("p")).distinct().collect()}
    assert len(used) > 1
    cut = F.when(F.col("event_id") % 13 == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
    want = b.log_lines(read).select(cut.alias("value"), "ts")
    assert Counter(lines.collect()) == Counter(want.collect())


def test_order_details_travel_as_numbers(spark):
    """What is no key crosses the exchanges as numbers, and every text comes back as it was."""
    row = lambda **cells: F.create_map(*[x for k, v in cells.items() for x in (F.lit(k), F.col(v) if v else F.lit(None).cast("string"))])
    details = spark.createDataFrame(
        [("1", "1", "7", "12", "3", "2.50"), ("2", "1", "07", "x", "3.0", "2.5"), ("2", "1", None, None, None, None), ("3", "2", "", " 7", "-0", "1e3"),
         (None, "1", "9999999999999999999999", "9", "+4", "-0.00"), ("4", None, "1", "1", "1", "1.00"), ("5", "9", "1", "1", "1", "1.00")],
        "id string, o string, sku string, at string, n string, a string")
    after = row(id="id", order_id="o", sku_id="sku", sku_name="sku", create_time="at", sku_num="n", order_price="a",
                split_activity_amount="a", split_coupon_amount="a", split_total_amount="a")
    db = details.select(b.envelope("order_detail", "c", F.lit(5), after=after).alias("e")).select("e.*")
    for table, rows, cells in (("order_info", [("1", "u", "p"), ("2", None, "q"), ("2", "v", "q")], {"id": "k", "user_id": "x", "province_id": "y"}),
                               ("order_detail_activity", [("1", "a1", "r1"), ("2", "a2", None)], {"order_detail_id": "k", "activity_id": "x", "activity_rule_id": "y"}),
                               ("order_detail_coupon", [("2", "c1", ""), ("2", "c2", "")], {"order_detail_id": "k", "coupon_id": "x"})):
        side = spark.createDataFrame(rows, "k string, x string, y string")
        db = db.unionByName(side.select(b.envelope(table, "c", F.lit(5), after=row(**cells)).alias("e")).select("e.*"))
    parts = facts.order_detail_rows(db), facts.created_orders(db), facts.detail_activities(db), facts.detail_coupons(db)
    names = {"1": [("u", "p")], "2": [(None, "q"), ("v", "q")]}
    acts, cous = {"1": [("a1", "r1")], "2": [("a2", None)]}, {"2": ["c1", "c2"]}
    want = Counter((d.id, d.order_id, u, d.sku_id, d.sku_name, p, a, r, c, d.create_time, d.sku_num, d.split_original_amount, d.split_total_amount)
                   for d in parts[0].collect() for u, p in names.get(d.order_id, []) for a, r in acts.get(d.id, [(None, None)]) for c in cous.get(d.id, [None]))
    got = facts.assembled_details(*parts)
    assert Counter(got.select("id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id", "coupon_id", "create_time",
                              "sku_num", "split_original_amount", "split_total_amount").collect()) == want and sum(want.values()) == 8
    assert dict(got.dtypes)["split_total_amount"] == "string"
    assert "_texts" in plan(got)[plan(got).index("Join"):]


def test_exchanges_begin_with_partitions_for_every_core(spark, sf_dir):
    """A session that asks for a few partitions gets more to begin with, which a task sorts in its memory."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(QUERIES["order_detail_fact"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in text.split("\n") if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 5 and all(f", {16 * spark.sparkContext.defaultParallelism})" in line for line in exchanges)
