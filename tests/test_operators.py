"""Small fixtures, one per behaviour."""

from __future__ import annotations

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from brookmart import schemas
from brookmart.operators import cdc, joins, logs, versions, visits, windows
from brookmart.plans import dims, facts, metrics, reports
from brookmart.sources.databases import camel_columns


def ms(text: str) -> int:
    import datetime

    return int(datetime.datetime.fromisoformat(text + "+00:00").timestamp() * 1000)


def envelopes(spark, *rows):
    """(table, op, before, after, ts_ms)"""
    data = [(b, a, {"db": "shop", "table": t}, op, ts) for t, op, b, a, ts in rows]
    return spark.createDataFrame(data, schemas.ENVELOPE)


def dictionary(spark):
    return spark.sql("SELECT '1101' AS dic_code, named_struct('dic_name', 'alipay') AS info")


def visits_frame(spark, rows):
    df = spark.createDataFrame([(m, n, t) for m, n, t in rows], "mid string, is_new string, t string")
    return df.select("mid", "is_new", F.col("t").cast("timestamp").alias("et"))


# --- logs

def test_dirty_lines(spark, rows):
    lines = spark.createDataFrame([('{"a":1}',), ('{"a":1',), ('{"a":1}x',), ("",), ("[1]",), (None,)], "value string")
    good, bad = logs.split_dirty(lines)
    assert rows(good) == [('{"a":1}',)]
    assert bad.count() == 5


def log(**fields):
    return (json.dumps({"common": {"mid": "m", "is_new": "1"}, "page": {"page_id": "home"}, "ts": 1, **fields}),)


@pytest.fixture
def feeds(spark):
    lines = [log(err={"code": "1"}, start={"entry": "icon"}), log(err={"code": "2"}),
             log(displays=[{"item": "a"}, {"item": "b"}], actions=[{"action_id": "x"}]), log(displays=[], actions=[])]
    return logs.parse_logs(spark.createDataFrame(lines, "value string"))


def test_feeds(feeds):
    split = {n: [json.loads(r[0]) for r in logs.to_feed(df).collect()] for n, df in logs.split_feeds(feeds).items()}
    assert {n: len(v) for n, v in split.items()} == {"err": 2, "start": 1, "page": 3, "display": 2, "action": 1}
    assert "start" in next(r for r in split["err"] if r["err"]["code"] == "1")
    assert "err" not in split["start"][0] and all("err" not in r for r in split["page"])
    assert {r["display"]["item"] for r in split["display"]} == {"a", "b"} and all(r["ts"] == 1 for r in split["display"])
    assert "ts" not in split["action"][0]
    empty = [r for r in split["page"] if r.get("displays") == []]
    assert len(empty) == 1 and empty[0]["actions"] == []
    assert sum("displays" in r for r in split["page"]) == 1


@pytest.mark.parametrize("action_ts", [False, True])
def test_tagged_feeds_are_the_split_feeds(feeds, action_ts):
    tagged = {(r[0], r[1]) for r in logs.to_feed(logs.tag_feeds(feeds, action_ts), "feed").collect()}
    split = {(n, r[0]) for n, df in logs.split_feeds(feeds, action_ts).items() for r in logs.to_feed(df).collect()}
    assert {(n, tuple(sorted(json.loads(v)))) for n, v in tagged} == {(n, tuple(sorted(json.loads(v)))) for n, v in split}
    assert len(tagged) == len(split)


# --- visits

REPAIR = [("a", "1", "2024-01-01 10:00:00"), ("a", "1", "2024-01-01 11:00:00"), ("a", "1", "2024-01-02 10:00:00"),
          ("b", "0", "2024-01-01 10:00:00"), ("b", "1", "2024-01-01 11:00:00"), ("c", "0", "2024-01-01 10:00:00"),
          ("d", "1", "2024-01-05 00:00:00"), ("d", "0", "2024-01-06 00:00:00"), (None, "1", "2024-01-06 00:00:00")]
REPAIRED = [("a", "1", 1, 10), ("a", "1", 1, 11), ("a", "0", 2, 10), ("b", "0", 1, 10), ("b", "0", 1, 11), ("c", "0", 1, 10),
            ("d", "1", 5, 0), ("d", "0", 6, 0), (None, "1", 6, 0)]


def test_flag_repair(spark):
    data = REPAIR[:]
    random.Random(1).shuffle(data)
    fixed = visits.repair_is_new(visits_frame(spark, data))
    got = fixed.select("mid", "is_new", F.dayofmonth("et"), F.hour("et")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(REPAIRED, key=repr)


def test_first_of_day_ignores_input_order(spark, rows):
    data = [("a", "1", "2024-01-01 10:00:00"), ("a", "0", "2024-01-01 09:00:00"), ("a", "1", "2024-01-02 00:00:00")]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        got = visits.first_of_day(visits_frame(spark, data), ["mid"], carry=["is_new"])
        assert rows(got.select("visit_date", "is_new", F.hour("et"))) == [("2024-01-01", "0", 9), ("2024-01-02", "1", 0)]


def test_return_gap(spark, rows):
    data = [(u, "1", t) for u, days in {"seven": (1, 8), "eight": (1, 9), "nine": (1, 10)}.items()
            for d in days for t in (f"2024-01-{d:02d} 10:00:00", f"2024-01-{d:02d} 12:00:00")]
    days = visits.login_days(visits_frame(spark, data), key="mid")
    got = rows(days.groupBy("mid").agg(F.sum("uu_ct"), F.sum("back_ct")))
    assert got == [("eight", 2, 1), ("nine", 2, 1), ("seven", 2, 0)]


def test_window_edges(spark, rows):
    t = ["2024-01-01 00:00:10", "2024-01-01 00:00:19.999999", "2024-01-01 00:00:20"]
    df = visits_frame(spark, [("a", "1", x) for x in t])
    got = rows(windows.tumble(df, "et", "10 seconds", [], F.count(F.lit(1)).alias("n")))
    assert [(r[0][-8:], r[1][-8:], r[3]) for r in got] == [("00:00:10", "00:00:20", 2), ("00:00:20", "00:00:30", 1)]


def test_home_and_detail_are_counted_apart(spark, rows):
    data = [("m", p, f"2024-01-01 00:00:0{i}") for i, p in enumerate(("home", "good_detail", "home", "mine"))]
    df = spark.createDataFrame(data, "mid string, page_id string, t string").withColumn("et", F.col("t").cast("timestamp"))
    assert rows(metrics.home_detail_window(df, "10 seconds").select("home_uv_ct", "good_detail_uv_ct")) == [(1, 1)]


# --- change data

def test_valid_changes(spark):
    db = envelopes(spark, ("t", "c", None, {"id": "1"}, 1), ("t", "d", {"id": "1"}, None, 2), ("t", "d", None, None, 3),
                   ("t", "c", None, {}, 4), ("t", "x", None, {"id": "1"}, 5))
    assert sorted(r.ts_ms for r in cdc.valid_changes(db, "shop").collect()) == [1, 2]
    assert cdc.valid_changes(db, "other").count() == 0


def test_only_mentioned_lines_are_parsed(spark):
    db = envelopes(spark, ("a", "c", None, {"id": "1", "note": "b"}, 1), ("b", "c", None, {"id": "2"}, 2))
    lines = db.select(F.to_json(F.struct("*")).alias("value"))
    assert [r.ts_ms for r in cdc.parse_envelopes(lines, tables=["b"]).collect()] == [2]
    assert cdc.parse_envelopes(lines).count() == 2


def test_cart(spark, rows):
    base = {"id": "1", "user_id": "u", "sku_id": "s"}
    q = lambda n: None if n is None else {**base, "sku_num": str(n)}
    db = envelopes(spark, ("cart_info", "c", None, q(2), 1), ("cart_info", "r", None, q(9), 2), ("cart_info", "u", q(2), q(5), 3),
                   ("cart_info", "u", q(5), q(4), 4), ("cart_info", "u", base, q(4), 5), ("cart_info", "u", q(9), q(10), 6))
    assert [(r.sku_num, r.ts) for r in facts.cart_add(db).orderBy("ts").collect()] == [("2", 1), ("9", 2), ("3", 3), ("1", 6)]


def test_transition(spark):
    s = lambda x: {"id": "1", "order_status": x}
    db = envelopes(spark, ("order_info", "u", s("1001"), s("1003"), 1), ("order_info", "u", s("1002"), s("1003"), 2),
                   ("order_info", "u", {"id": "1"}, s("1003"), 3), ("order_info", "c", None, s("1003"), 4))
    ts = lambda df: sorted(r.ts_ms for r in df.collect())
    assert ts(cdc.transition(db, "order_info", "order_status", "1003", before="1001")) == [1]
    assert ts(cdc.transition(db, "order_info", "order_status", "1003")) == [1, 2]


def test_config_lifecycle(spark, rows):
    c = lambda cols: {"source_table": "t", "sink_table": "s", "sink_columns": cols}
    changes = envelopes(spark, ("cfg", "r", None, c("a"), 1), ("cfg", "u", c("a"), c("a,b"), 2))
    read = cdc.config_rows(changes, "source_table", "sink_table", "sink_columns")
    assert rows(cdc.live_config(read, "source_table").select("sink_columns")) == [("a,b",)]
    gone = read.unionByName(cdc.config_rows(envelopes(spark, ("cfg", "d", c("a,b"), None, 3)),
                                            "source_table", "sink_table", "sink_columns"))
    assert cdc.live_config(gone, "source_table").count() == 0


def test_null_column_list_keeps_all(spark):
    df = spark.sql("SELECT map('a', '1', 'b', '2') AS m, cast(null AS string) AS n, 'b,c' AS l")
    assert list(df.select(cdc.keep_cells(F.col("m"), F.col("n")), cdc.keep_cells(F.col("m"), F.col("l"))).first()) == [
        {"a": "1", "b": "2"}, {"b": "2"}]


def test_fact_routing_by_change_type(spark, rows):
    config = spark.createDataFrame([("o", "insert", "created", "id", "r"), ("o", "update", "changed", "st", "r"),
                                    ("o", "delete", "gone", None, "r")], schemas.FACT_CONFIG)
    row = {"id": "1", "st": "x", "z": "z"}
    db = envelopes(spark, ("o", "c", None, row, 1), ("o", "r", None, row, 2), ("o", "u", row, row, 3), ("o", "d", row, None, 4),
                   ("p", "c", None, row, 5))
    got = {(r[0], tuple(sorted(r[1].items()))) for r in cdc.route_facts(db, config).collect()}
    assert got == {("created", (("id", "1"), ("ts_ms", "1"))), ("created", (("id", "1"), ("ts_ms", "2"))),
                   ("changed", (("st", "x"), ("ts_ms", "3"))), ("gone", (("id", "1"), ("st", "x"), ("ts_ms", "4"), ("z", "z")))}


def dims_config(spark):
    return spark.createDataFrame([("t", "dim_t", "id,name,city", "info", "id", "r")], schemas.DIM_CONFIG)


def test_dimension_rows(spark, rows):
    r = lambda **k: {"id": "1", **k}
    db = envelopes(spark, ("t", "c", None, r(name="a", city="x", extra="e"), 1), ("t", "u", None, r(name="", city="y"), 2),
                   ("u", "c", None, r(name="not configured"), 3),
                   ("t", "c", None, {"id": "2", "name": "b", "city": "z"}, 1), ("t", "d", {"id": "2"}, None, 5),
                   ("t", "c", None, {"id": "3", "name": "c", "city": "q"}, 1), ("t", "d", {"id": "3"}, None, 5),
                   ("t", "c", None, {"id": "3", "name": "back"}, 6))
    cells = dims.dimension_cells(cdc.route_dimensions(cdc.valid_changes(db, "shop"), dims_config(spark)))
    assert rows(dims.dimension_rows(cells, "dim_t", ["id", "name", "city"])) == [("1", "1", "a", "y"), ("3", "3", "back", None)]


# --- joins

def test_order_detail_with_and_without(spark, rows):
    d = lambda i, o: {"id": i, "order_id": o, "sku_id": "s", "create_time": "1714500000123", "sku_num": "3", "order_price": "2.50"}
    db = envelopes(spark, ("order_detail", "c", None, d("1", "10"), 1), ("order_detail", "c", None, d("2", "10"), 1),
                   ("order_detail", "c", None, d("3", "99"), 1), ("order_detail", "u", None, d("4", "10"), 1),
                   ("order_info", "c", None, {"id": "10", "user_id": "u", "province_id": "p"}, 1),
                   ("order_info", "c", None, {"id": "11", "user_id": "u", "province_id": "p"}, 1),
                   ("order_detail_activity", "c", None, {"order_detail_id": "1", "activity_id": "a", "activity_rule_id": "r"}, 1),
                   ("order_detail_coupon", "c", None, {"order_detail_id": "2", "coupon_id": "c"}, 1))
    got = facts.order_detail(db).select("id", "user_id", "activity_id", "coupon_id", "date_id", "split_original_amount")
    assert rows(got) == [("1", "u", "a", None, "2024-04-30", "7.5000"), ("2", "u", None, "c", "2024-04-30", "7.5000")]


@pytest.mark.parametrize("offset, kept", [(-1800000, True), (-1800001, False), (5000, True), (5001, False), (0, True)])
def test_payment_bounds(spark, offset, kept):
    pay = ms("2024-01-01 12:00:00")
    db = envelopes(spark, ("payment_info", "u", {"payment_status": "1601"},
                           {"order_id": "10", "payment_status": "1602", "payment_type": "1101"}, pay),
                   ("payment_info", "u", {"payment_status": "1601"},
                    {"order_id": "10", "payment_status": "1602", "payment_type": "9999"}, pay),
                   ("payment_info", "c", None, {"order_id": "10", "payment_status": "1602", "payment_type": "1101"}, pay))
    detail = spark.createDataFrame([tuple(["1", "10"] + [None] * 14 + [pay + offset])], schemas.ORDER_DETAIL)
    assert facts.payment_success(db, detail, dictionary(spark)).count() == int(kept)


def test_interval_join_is_the_plain_join(spark, rows):
    """All pairs of one hot key, against the unbucketed condition."""
    rnd = random.Random(3)
    left = spark.createDataFrame([(i, "k", rnd.randrange(0, 20000)) for i in range(60)], "l int, lk string, a int")
    right = spark.createDataFrame([(i, "k", rnd.randrange(0, 20000)) for i in range(60)], "r int, rk string, b int")
    left, right = left.withColumn("lt", F.timestamp_seconds("a")), right.withColumn("rt", F.timestamp_seconds("b"))
    got = rows(joins.interval_join(left, right, {"lk": "rk"}, "lt", "rt", "30 minutes", "5 seconds").select("l", "r"))
    want = rows(left.join(right, F.expr("lk = rk AND b BETWEEN a - 1800 AND a + 5")).select("l", "r"))
    assert got == want and len(got) > 50


def test_dictionary_left_and_inner(spark, rows):
    df = spark.createDataFrame([("1", "1101"), ("2", "zz"), ("3", None)], "id string, code string")
    assert rows(joins.dictionary_join(df, dictionary(spark), "code", "name", "left").select("id", "name")) == [
        ("1", "alipay"), ("2", None), ("3", None)]
    assert rows(joins.dictionary_join(df, dictionary(spark), "code", "name").select("id")) == [("1",)]


def test_members(spark, rows):
    words = spark.createDataFrame([("bad",), ("bad",), ("",), (None,)], "word string")
    df = spark.createDataFrame([(1, "bad"), (2, "ok"), (3, ""), (4, None)], "i int, w string")
    assert rows(joins.flag_members(df, words, "w").select("i", "is_member")) == [(1, True), (2, False), (3, False), (4, False)]


def test_sku_chain_misses(spark):
    def dim(**columns):
        return spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} string" for c in columns))

    chain = {"dim_sku_info": dim(id="s", sku_name="S", spu_id="p", category3_id="c3", tm_id="t"),
             "dim_spu_info": dim(id="p", spu_name="P"), "dim_base_trademark": dim(id="t", tm_name="T"),
             "dim_base_category3": dim(id="c3", name="C3", category2_id="c2"),
             "dim_base_category2": dim(id="c2", name="C2", category1_id="c1"), "dim_base_category1": dim(id="c1", name="C1")}
    names = ["sku_name", "spu_name", "trademark_name", "category3_name", "category2_name", "category1_name"]
    sums = spark.sql("SELECT 'x' AS stt, 'y' AS edt, 'd' AS cur_date, 's' AS sku_id, 1 AS original_amount, "
                     "1 AS activity_reduce_amount, 1 AS coupon_reduce_amount, 1 AS order_amount")
    assert metrics.with_sku_dimensions(sums, chain).select(*names).first() == ("S", "P", "T", "C3", "C2", "C1")
    lost = {"dim_sku_info": 6, "dim_spu_info": 1, "dim_base_trademark": 1, "dim_base_category3": 3, "dim_base_category2": 2,
            "dim_base_category1": 1}
    for table, missing in lost.items():
        row = metrics.with_sku_dimensions(sums, {**chain, table: chain[table].where("false")}).select(*names).first()
        assert sum(v is None for v in row) == missing


# --- versions and reports

def test_newest_version(spark, rows):
    data = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", 2, "w")]
    random.Random(2).shuffle(data)
    df = spark.createDataFrame(data, "id string, ts int, v string")
    assert rows(versions.newest_per_key(df, ["id"], ["ts", "v"])) == [("a", 3, "z"), ("b", 2, "w")]


def test_reports(spark, rows):
    t = spark.createDataFrame([("2024-01-01", "A", 1), ("2024-01-01", "B", 2), ("2024-01-02", "A", 5)],
                              "cur_date string, province_name string, n int")
    t = t.withColumn("order_amount", F.col("n").cast("decimal(16,2)"))
    assert rows(reports.gmv(t, 20240101)) == [("2024-01-01", Decimal("3.00"))]
    assert json.loads(reports.gmv_payload(reports.gmv(t, 20240102)).first().payload) == {"status": 0, "data": 5.0}
    payload = json.loads(reports.province_payload(reports.province_gmv(t, 20240101)).first().payload)
    assert payload["data"] == {"mapData": [{"name": "A", "value": 1.0}, {"name": "B", "value": 2.0}], "valueName": "交易额"}
    v = spark.createDataFrame([("2024-01-01", c, n) for c, n in (("a", 1), ("b", 9), ("c", 9), ("d", 3))],
                              "cur_date string, ch string, uv_ct bigint")
    top = reports.channel_visitors(v, 20240101, limit=3)
    assert [r.ch for r in top.collect()] == ["b", "c", "d"]
    assert json.loads(reports.channel_payload(top).first().payload)["data"] == {
        "categories": ["b", "c", "d"], "series": [{"name": "渠道", "data": [9, 9, 3]}]}


def test_camel_columns(spark):
    assert camel_columns(spark.sql("SELECT 1 AS order_id, 2 AS X_Y")).columns == ["orderId", "xY"]
