"""Streams over several micro-batches, restarts, replays and stores."""

from __future__ import annotations

import json
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brookmart import bindings as b
from brookmart import schemas
from brookmart.operators import visits
from brookmart.operators.joins import fact_join, look_up
from brookmart.plans import dims, facts, metrics
from brookmart.session import prepare, shared_root
from brookmart.sources.files import read_lines, stream_by_day, stream_lines, write_by_day
from brookmart.sources.levels import LevelledTable, TableGroup
from brookmart.sources.tables import DimensionStore, MetricTable, UpsertTable
from brookmart.sources.topics import as_records, as_records_routed, json_table, topic_options
from brookmart.streaming import jobs, keyed, pipelines, retraction, state
from brookmart.streaming.runner import StreamJob, drain, replay, to_batches, to_files

FAR = "2030-01-01 00:00:00"


class Feed:
    """A folder that grows by one file per ``add``; streams read one file per micro-batch."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.n = spark, str(path), schema, 0

    def add(self, *rows):
        df = self.spark.createDataFrame(rows, self.schema)
        self.n += 1
        df.coalesce(1).write.mode("append").json(f"{self.path}/part={self.n:04d}")
        return self

    def stream(self):
        return (self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
                .json(f"{self.path}/part=*"))

    def batch(self):
        return self.spark.read.schema(self.schema).json(f"{self.path}/part=*")


@pytest.fixture
def feed(spark, tmp_path):
    return lambda schema: Feed(spark, tmp_path / uuid.uuid4().hex, schema)


PAGE = "mid string, uid string, vc string, ch string, ar string, is_new string, page_id string, last_page_id string, t string"


def page(mid, t, page_id="home", is_new="1", ch="c"):
    return (mid, mid, "v", ch, "1", is_new, page_id, None, t)


def pages(df):
    return df.withColumns({"et": F.col("t").cast("timestamp"), "during_time": F.lit(5)}).drop("t")


def visit_feed(feed):
    f = feed(PAGE)
    f.add(page("a", "2024-01-01 00:00:01"), page("b", "2024-01-01 00:00:02", "good_detail"), page("a", "2024-01-01 00:00:03"))
    f.add(page("a", "2024-01-01 00:00:12"), page("c", "2024-01-01 00:00:13"), page("b", "2024-01-01 00:00:14", "home"))
    f.add(page("a", "2024-01-02 00:00:01"), page("b", "2024-01-02 00:00:02"), page("a", "2024-01-10 00:00:00"))
    return f.add(page("z", FAR))


def closed(rows):
    return [r for r in rows if not r[0].startswith("2030")]


@pytest.mark.parametrize("job", ["traffic_window", "home_detail_window", "login_window"])
def test_streams_equal_batch(spark, feed, rows, job):
    f = visit_feed(feed)
    stream = rows(drain(getattr(jobs, job)(pages(f.stream()))))
    assert stream == closed(rows(getattr(metrics, job)(pages(f.batch()))))
    assert stream


def test_cart_stream_equals_batch(feed, rows):
    f = feed("user_id string, ts bigint")
    for t in (1704067200000, 1704067201000, 1704067209000, 1704153600000, 1893456000000):
        f.add(("u", t), ("v", t + 1))
    got = rows(drain(jobs.cart_window(f.stream())))
    assert got == closed(rows(metrics.cart_window(f.batch()))) and [r[3] for r in got] == [2, 2]


def test_first_of_day_across_batches(feed, rows):
    f = visit_feed(feed)
    got = rows(drain(state.first_of_day(pages(f.stream()), ["mid"], "0 seconds")).select("mid", F.col("et").cast("string")))
    want = rows(visits.first_of_day(pages(f.batch()), ["mid"]).select("mid", F.col("et").cast("string")))
    assert got == want


def test_flag_repair_across_batches(feed, rows):
    f = feed(PAGE)
    f.add(page("a", "2024-01-01 10:00:00"), page("b", "2024-01-01 10:00:00", is_new="0"))
    f.add(page("a", "2024-01-02 10:00:00"), page("b", "2024-01-01 11:00:00"), page(None, "2024-01-02 11:00:00"))
    repaired = drain(state.repair_is_new(pages(f.stream()).select("mid", "is_new", "et")))
    assert rows(repaired.select("mid", "is_new", F.col("et").cast("string"))) == rows(
        visits.repair_is_new(pages(f.batch()).select("mid", "is_new", "et")).select("mid", "is_new", F.col("et").cast("string")))


def test_flag_repair_with_ttl(spark, feed, tmp_path):
    """A processing-time query never runs dry, so it is stopped once its rows are there."""
    f = feed(PAGE).add(page("a", "2024-01-01 10:00:00"), page("a", "2024-01-02 10:00:00"))
    fixed = state.repair_is_new(pages(f.stream()).select("mid", "is_new", "et"), ttl_ms=3_600_000)
    out = str(tmp_path / "out")
    query = to_files(fixed, out, str(tmp_path / "c"), interval="1 second")
    try:
        until = time.time() + 60
        got = []
        while len(got) < 2 and time.time() < until:
            time.sleep(1)
            if query.lastProgress:
                got = [r.is_new for r in spark.read.schema(fixed.schema).parquet(out).collect()]
    finally:
        query.stop()
    assert sorted(got) == ["0", "1"]


def test_late_rows_are_dropped(feed):
    f = feed(PAGE).add(page("a", "2024-01-01 00:01:00")).add(page("b", "2024-01-01 00:02:00"))
    f.add(page("late", "2024-01-01 00:00:30")).add(page("z", FAR))
    got = drain(jobs.traffic_window(pages(f.stream())))
    assert got.agg(F.sum("pv_ct")).first()[0] == 2


DETAIL = ("id string, order_id string, sku_id string, province_id string, split_original_amount string, "
          "split_activity_amount string, split_coupon_amount string, split_total_amount string, ts bigint")
T0 = 1704067200000


def detail(i, amount, ts, order="o1", sku="s", province="p"):
    return (i, order, sku, province, amount, "1.00", "0.50", amount, ts)


@pytest.fixture
def order_windows(spark, feed, tmp_path):
    """The windows of a job over batches of details."""
    def run(build, labelled, *batches, **options):
        sums = build(spark, str(tmp_path / uuid.uuid4().hex), feed(DETAIL).add(detail("0", "1.00", T0)).batch().where("false"), **options)
        for n, batch in enumerate(batches):
            sums.apply(feed(DETAIL).add(*batch).batch(), n)
        return sums, lambda **kw: labelled(sums, **kw)

    return run


def test_retraction_in_one_window(order_windows):
    for build, labelled in ((retraction.sku_sums, retraction.sku_windows), (retraction.order_sums, retraction.province_windows)):
        _, read = order_windows(build, labelled, [detail("1", "10.00", T0), detail("2", "5.00", T0 + 1)], [detail("1", "30.00", T0 + 2)])
        assert [str(r.order_amount) for r in read().collect()] == ["35.00"]


def test_retraction_moves_to_the_later_window(order_windows):
    batches = [detail("1", "10.00", T0)], [detail("1", "30.00", T0 + 10**11)]
    sums, read = order_windows(retraction.sku_sums, retraction.sku_windows, *batches)
    assert [str(r.order_amount) for r in read().collect()] == ["30.00"]
    assert sorted(str(r.order_amount) for r in read(emptied=True).collect()) == ["0.00", "30.00"]
    # a batch comes twice
    sums.apply(sums.spark.createDataFrame([], sums.versions.schema), 1)
    assert [str(r.order_amount) for r in read().collect()] == ["30.00"]


def test_older_versions_change_nothing(order_windows):
    _, read = order_windows(retraction.order_sums, retraction.province_windows, [detail("1", "4.00", T0 + 3)], [detail("1", "2.00", T0 + 1)],
                            [detail("1", "1.00", T0), detail("1", "8.00", T0 + 4), detail("1", "5.00", T0 + 2)])
    row = read().first()
    assert (row.order_count, str(row.order_amount)) == (1, "8.00")


def test_no_python_in_the_difference(spark, order_windows):
    sums, read = order_windows(retraction.sku_sums, retraction.sku_windows, [detail("1", "4.00", T0)])
    rows = sums.versions.read()
    text = retraction.difference(rows, rows, ["id"], ["ts"], metrics.AMOUNTS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
    assert "Python" not in read()._jdf.queryExecution().executedPlan().toString()


def test_changes_are_exchanged_by_key_only(spark, feed, order_windows, monkeypatch):
    """A batch meets the stored versions by key; its changes go to the sums from there, and add up when they are read."""
    plans, write = [], retraction.LevelledTable._write
    monkeypatch.setattr(retraction.LevelledTable, "_write", lambda self, rows, run: (
        plans.append((self.name, rows._jdf.queryExecution().optimizedPlan().toString())), write(self, rows, run))[1])
    batches = [detail("1", "10.00", T0), detail("2", "5.00", T0 + 1), detail("3", "1.00", T0, sku="t")], [detail("1", "30.00", T0 + 2)]
    _, read = order_windows(retraction.sku_sums, retraction.sku_windows, *batches)
    assert sorted((r.sku_id, str(r.order_amount)) for r in read().collect()) == [("s", "35.00"), ("t", "1.00")]
    added = [p.split("InMemoryRelation")[0] for n, p in plans if n == "sums"]
    assert len(added) == 2 and not any("Aggregate" in p.split("Join")[0] for p in added)


def test_arrival_windows_survive_a_crash(spark, feed, order_windows, monkeypatch):
    """The batch is done again after a crash before its commit, an hour later: same windows."""
    ticks = iter([5_000, 3_605_000, 7_205_000])
    sums, read = order_windows(retraction.sku_sums, retraction.sku_windows, stamp=lambda: next(ticks))
    commit, batch = sums.group.commit, feed(DETAIL).add(detail("1", "4.00", T0)).batch()
    monkeypatch.setattr(sums.group, "commit", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        sums.apply(batch, 0)
    assert read().count() == 0
    monkeypatch.setattr(sums.group, "commit", commit)
    sums.apply(batch, 0)
    sums.apply(batch, 0)
    sums.apply(feed(DETAIL).add(detail("2", "4.00", T0)).batch(), 1)
    assert sorted((r.stt, str(r.order_amount)) for r in read().collect()) == [("1970-01-01 00:00:00", "4.00"), ("1970-01-01 01:00:00", "4.00")]


ENV = schemas.ENVELOPE


def env(table, op, ts, before=None, after=None):
    return (before, after, {"db": "shop", "table": table}, op, ts)


def test_left_join_pads_after_the_watermark(feed):
    f = feed(ENV)
    for i, act in (("1", True), ("2", False)):
        rows = [env("order_detail", "c", T0, after={"id": i, "order_id": "o", "sku_num": "1", "order_price": "1"})]
        if act:
            rows.append(env("order_detail_activity", "c", T0, after={"order_detail_id": i, "activity_id": "a"}))
        f.add(*rows)
    f.add(env("order_info", "c", T0, after={"id": "o", "user_id": "u"}))
    for n in (1, 2, 3):
        f.add(*[env(t, "c", T0 + n * 10_000_000, after={"id": f"x{n}", "order_id": "none", "order_detail_id": "none"})
                for t in ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")])
    got = {r.id: r.activity_id for r in drain(facts.order_detail(f.stream(), within="1 hour")).collect()}
    assert got == {"1": "a", "2": None}


def test_restart_from_checkpoint(spark, feed, tmp_path, rows):
    f = feed(PAGE).add(page("a", "2024-01-01 00:00:01"), page("b", "2024-01-01 00:00:02"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    run = lambda: to_files(jobs.traffic_window(pages(f.stream())), out, checkpoint, once=True).awaitTermination()
    run()
    f.add(page("a", "2024-01-01 00:00:03"), page("a", "2024-01-01 00:00:15")).add(page("z", FAR))
    run()
    run()
    assert rows(spark.read.parquet(out)) == closed(rows(metrics.traffic_window(pages(f.batch()))))


# --- stores

def config(op, ts, columns="id,name", before=False):
    row = {"source_table": "t", "sink_table": "dim_t", "sink_columns": columns, "sink_family": "info", "sink_row_key": "id"}
    return env("cfg", op, ts, before=row if op == "d" else None, after=None if op == "d" else row)


def test_dimension_sync(spark, feed, tmp_path, rows):
    cfg, data = feed(ENV).add(config("r", 0)), feed(ENV)
    store = DimensionStore(spark, str(tmp_path / "store"))
    sync = lambda: (pipelines.config_sync(cfg.stream(), store, str(tmp_path / "c1"), once=True).awaitTermination(),
                    pipelines.dimension_sync(data.stream(), store, "shop", str(tmp_path / "c2"), once=True).awaitTermination())
    data.add(env("t", "c", 1, after={"id": "1", "name": "a", "x": "x"}), env("t", "c", 1, after={"id": "2", "name": "b"}))
    data.add(env("t", "u", 2, after={"id": "1", "name": ""}), env("other", "c", 2, after={"id": "9"}))
    sync()
    assert store.tables() == ["dim_t"] and rows(store.read("dim_t")) == [("1", "1", "a"), ("2", "2", "b")]
    data.add(env("t", "d", 3, before={"id": "2", "name": "b"}), env("t", "c", 4, after={"id": "3", "name": "c"}))
    sync()
    assert rows(store.read("dim_t").select("id", "name")) == [("1", "a"), ("3", "c")]
    assert store.count("dim_t") == 2 and store.scan("dim_t", 1).count() == 1
    store.cells.compact()
    assert store.count("dim_t") == 2
    store.delete_rows("dim_t", spark.createDataFrame([("1",)], "k string"), 5)
    assert rows(store.read("dim_t").select("id")) == [("3",)]
    # the table is dropped and created anew with another column
    cfg.add(config("u", 6, "id,name,city"))
    data.add(env("t", "c", 7, after={"id": "4", "name": "d", "city": "x"}))
    sync()
    assert rows(store.read("dim_t")) == [("4", "4", "d", "x")]
    cfg.add(config("d", 8))
    sync()
    assert store.tables() == []
    with pytest.raises(ValueError):
        store.read("dim_t")


def test_drop_all(spark, feed, tmp_path):
    store = DimensionStore(spark, str(tmp_path / "s"))
    store.apply_config(spark.createDataFrame([("t", "dim_t", "id", "info", "id", "r", 0)],
                                             "source_table string, sink_table string, sink_columns string, "
                                             "sink_family string, sink_row_key string, op string, ts_ms bigint"), 0)
    assert store.tables() == ["dim_t"]
    store.drop_all(1)
    assert store.tables() == []


def test_upsert_table_replay_and_compaction(spark, tmp_path, rows):
    table = UpsertTable(spark, str(tmp_path / "t"), schemas.CART_ADD, ["id"], ["ts"])
    batch = lambda *r: spark.createDataFrame([(i, "u", "s", n, ts) for i, n, ts in r], schemas.CART_ADD)
    assert table.read().count() == 0
    table.apply(batch(("1", "a", 1), ("1", "b", 2), ("2", "c", 1)), 0)
    table.apply(batch(("1", "d", 3)), 1)
    table.apply(batch(("1", "d", 3)), 1)
    want = [("1", "d"), ("2", "c")]
    assert rows(table.read().select("id", "sku_num")) == want
    table.compact()
    assert rows(table.read().select("id", "sku_num")) == want
    table.apply(batch(("2", "e", 9)), 2)
    assert rows(table.read().select("id", "sku_num")) == [("1", "d"), ("2", "e")]


def cart_rows(spark, *rows):
    return spark.createDataFrame([(i, "u", "s", n, ts) for i, n, ts in rows], schemas.CART_ADD)


def test_levels_merge_and_leave_one_scan(spark, tmp_path, rows):
    table = UpsertTable(spark, str(tmp_path / "t"), schemas.CART_ADD, ["id"], ["ts"], fan=2, buckets=2)
    for n in range(11):
        table.apply(cart_rows(spark, ("1", str(n), n), (f"k{n}", "x", n)), n)
    got = rows(table.read().select("id", "sku_num"))
    assert ("1", "10") in got and len(got) == 12
    assert table.read()._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert table.group.state()["runs"]["rows"] == ["run=0-7-3", "run=8-9-1", "run=10-10-0"]
    left = {p.name for p in (tmp_path / "t/rows").iterdir() if p.is_dir()}
    assert "run=0-0-0" not in left and "run=0-7-3" in left
    assert len(list((tmp_path / "t/_commits").glob("*.json"))) == 8


def test_rows_are_rewritten_a_logarithmic_number_of_times(spark, tmp_path, monkeypatch):
    table = UpsertTable(spark, str(tmp_path / "t"), schemas.CART_ADD, ["id"], ["ts"])
    rewritten = []

    def join(runs, level):
        first, last = int(runs[0].split("=")[1].split("-")[0]), int(runs[-1].split("-")[1])
        rewritten.append(last - first + 1)
        return f"run={first}-{last}-{level}"

    monkeypatch.setattr(table, "_join", join)
    runs, most = [], 0
    for n in range(200):
        runs, _ = table._merged([*runs, f"run={n}-{n}-0"])
        most = max(most, len(runs))
    assert sum(rewritten) <= 200 * 4 and most <= 3 * 4  # log4(200) < 4


def test_keys_are_read_in_their_buckets(spark, tmp_path, rows):
    import re

    table = UpsertTable(spark, str(tmp_path / "t"), schemas.CART_ADD, ["id"], ["ts"], buckets=64)
    for n in range(2):
        table.apply(cart_rows(spark, *[(str(i), str(n), n) for i in range(300)]), n)
    keys = spark.createDataFrame([(str(i),) for i in range(0, 100, 10)], "id string")
    found = table.read(keys)
    assert rows(found.select("id", "sku_num")) == sorted((str(i), "1") for i in range(0, 100, 10))
    text = found._jdf.queryExecution().executedPlan().toString()
    listed = re.search(r"PartitionFilters: \[.*?_bucket#\d+ (IN|INSET) \(?([\d,]+)", text)
    assert listed and 1 <= len(listed[2].split(",")) <= 10


def test_a_crash_between_two_tables_shows_nothing(spark, tmp_path, monkeypatch, rows):
    """The side is written, the fact is not: readers see the batch before, and doing it again gives the whole."""
    fact = keyed.order_details(spark, str(tmp_path / "f"))
    give = lambda n, *changes: fact.apply(spark.createDataFrame(list(changes), ENV), n)
    give(0, env("order_detail", "c", T0, after={"id": "1", "order_id": "o", "sku_num": "1", "order_price": "2"}), env("order_info", "c", T0, after={"id": "o", "user_id": "u"}))
    second = (env("order_detail", "c", T0, after={"id": "2", "order_id": "o", "sku_num": "1", "order_price": "2"}),)
    stage = fact.table.stage
    monkeypatch.setattr(fact.table, "stage", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        give(1, *second)
    again = keyed.order_details(spark, str(tmp_path / "f"))
    assert [r.id for r in again.read().collect()] == ["1"] and again.stored["details"].read().count() == 1
    monkeypatch.setattr(fact.table, "stage", stage)
    give(1, *second)
    give(1, *second)
    assert sorted(r.id for r in again.read().collect()) == ["1", "2"] and again.stored["details"].read().count() == 2


def test_change_feed(spark, tmp_path, rows):
    table = UpsertTable(spark, str(tmp_path / "t"), schemas.CART_ADD, ["id"], ["ts"], fan=2)
    for n in range(4):
        table.apply(cart_rows(spark, (f"k{n}", "x", n), ("all", str(n), n)), n)
    feed = lambda since: rows(table.changes_since(since).select("id", "sku_num"))
    assert feed(3) == [] and feed(1) == [("all", "3"), ("k2", "x"), ("k3", "x")] and len(feed(-1)) == 5


def test_details_after_the_cancel(spark, tmp_path, rows):
    details = keyed.order_details(spark, str(tmp_path / "d"))
    fact = keyed.cancels(spark, str(tmp_path / "c"), details)
    envs = lambda *changes: spark.createDataFrame(list(changes), ENV)
    fact.apply(envs(env("order_info", "u", T0 + 5, {"order_status": "1001"}, {"id": "o", "order_status": "1003", "operate_time": str(T0)})), 0)
    assert fact.read().count() == 0
    details.apply(envs(env("order_info", "c", T0, after={"id": "o", "user_id": "u"}),
                       env("order_detail", "c", T0 + 10**11, after={"id": "1", "order_id": "o", "sku_num": "1", "order_price": "2"})), 0)
    fact.follow()
    assert rows(fact.read().select("id", "order_id", "user_id")) == [("1", "o", "u")]
    # numbers of follow-ups do not hide batches of the stream
    fact.apply(envs(env("order_info", "u", T0 + 5, {"order_status": "1001"}, {"id": "p", "order_status": "1003", "operate_time": str(T0)})), 1)
    details.apply(envs(env("order_info", "c", T0, after={"id": "p", "user_id": "v"}),
                       env("order_detail", "c", T0, after={"id": "2", "order_id": "p", "sku_num": "1", "order_price": "2"})), 1)
    fact.follow()
    assert rows(fact.read().select("id", "user_id")) == [("1", "u"), ("2", "v")]


def test_an_empty_metric_table_can_be_read(spark, tmp_path):
    schema = spark.sql("SELECT '2024-01-01' AS cur_date, 1 AS n").schema
    assert MetricTable(spark, str(tmp_path / "m"), schema).read().count() == 0
    with pytest.raises(ValueError):
        MetricTable(spark, str(tmp_path / "m")).read()


def test_changes_of_one_millisecond_by_sequence(spark):
    def cells(*changes):
        rows = [("dim", "1", op, 5, seq, {"id": "1", "name": name, "op": op}) for seq, (op, name) in enumerate(changes)]
        routed = spark.createDataFrame(rows, "sink_table string, row_key string, op string, ts_ms long, seq long, payload map<string,string>")
        return [r.name for r in dims.dimension_rows(dims.dimension_cells(routed), "dim", ["id", "name"]).collect()]

    assert cells(("c", "a"), ("d", "a"), ("c", "b")) == ["b"]
    assert cells(("c", "a"), ("d", "a")) == []
    assert cells(("c", "z"), ("u", "a")) == ["a"]


def test_streams_need_a_bound(feed):
    with pytest.raises(ValueError):
        facts.order_detail(feed(ENV).add(env("order_info", "c", T0, after={"id": "o"})).stream())


def test_keyed_fact_shows_nulls_first(spark, tmp_path, rows):
    """The row appears without its activity and is replaced when that comes, years later."""
    fact = keyed.order_details(spark, str(tmp_path / "f"))
    give = lambda n, *changes: fact.apply(spark.createDataFrame(list(changes), ENV), n)
    give(0, env("order_detail", "c", T0, after={"id": "1", "order_id": "o", "sku_num": "1", "order_price": "2"}))
    assert fact.read().count() == 0
    give(1, env("order_info", "c", T0, after={"id": "o", "user_id": "u"}))
    assert rows(fact.read().select("id", "user_id", "activity_id")) == [("1", "u", None)]
    give(2, env("order_detail_activity", "c", T0 + 10**11, after={"order_detail_id": "1", "activity_id": "a"}))
    give(2, env("order_detail_activity", "c", T0 + 10**11, after={"order_detail_id": "1", "activity_id": "a"}))
    assert rows(fact.read().select("id", "user_id", "activity_id")) == [("1", "u", "a")]


def test_malformed_amounts_do_not_stop_the_job(spark):
    rows = spark.createDataFrame([detail("1", "10.00", T0), detail("2", "1o.00", T0)], DETAIL)
    assert metrics.order_measures(rows).count() == 1 and [r.id for r in metrics.malformed_amounts(rows).collect()] == ["2"]
    bad = spark.createDataFrame([(None, {"id": "1", "sku_num": "x"}, {"db": "shop", "table": "cart_info"}, "c", 1),
                                 ({"sku_num": "y"}, {"id": "2", "sku_num": "3"}, {"db": "shop", "table": "cart_info"}, "u", 1)], ENV)
    assert [r.id for r in facts.cart_add(bad).collect()] == ["1"]


def test_metric_table_replay(spark, tmp_path, rows):
    table = MetricTable(spark, str(tmp_path / "m"))
    part = lambda d, n: spark.createDataFrame([(d, n)], "cur_date string, n int")
    table.apply(part("2024-01-01", 1), 0)
    table.apply(part("2024-01-01", 2), 1)
    table.apply(part("2024-01-01", 2), 1)
    assert rows(table.read().select("cur_date", "n")) == [("2024-01-01", 1), ("2024-01-01", 2)]
    lines = MetricTable(spark, str(tmp_path / "j"))
    lines.apply_json(spark.sql("SELECT '2024-01-01' AS cur_date, 1 AS n, 'x' AS hidden"), 0, hidden=("hidden",))
    assert json.loads(spark.read.text(str(tmp_path / "j")).first().value) == {"n": 1}


def test_enriched_metrics(spark, feed, tmp_path, rows):
    f = feed(PAGE).add(page("a", "2024-01-01 00:00:01")).add(page("z", FAR))
    table = MetricTable(spark, str(tmp_path / "m"))
    names = spark.createDataFrame([("c", "North")], "id string, name string")
    pipelines.enriched_metrics(jobs.traffic_window(pages(f.stream())), lambda s: look_up(s, names, "ch", "id", channel="name"), table,
                               str(tmp_path / "c"), once=True).awaitTermination()
    assert [(r.channel, r.uv_ct) for r in table.read().collect()] == [("North", 1)]


def test_fact_routing_folders(spark, feed, tmp_path, rows):
    cfg = spark.createDataFrame([("o", "insert", "created", "id", "r")], schemas.FACT_CONFIG)
    f = feed(ENV).add(env("o", "c", 1, after={"id": "1", "x": "y"}), env("o", "u", 2, after={"id": "1"}))
    pipelines.route_facts(f.stream(), lambda: cfg, pipelines.routed_folders(str(tmp_path / "out")), str(tmp_path / "c"),
                          once=True).awaitTermination()
    got = spark.read.text(str(tmp_path / "out")).collect()
    assert [(r.sink_table, json.loads(r.value)) for r in got] == [("created", {"id": "1", "ts_ms": "1"})]


def test_day_folders(spark, tmp_path, rows):
    lines = [json.dumps({"at": 1704067200}), json.dumps({"at": 1704067200000}), json.dumps({"x": 1}), "no json", json.dumps({"at": "x"})]
    src = str(tmp_path / "src")
    spark.createDataFrame([(v,) for v in lines], "value string").write.text(src)
    want = [("19700101", 1), ("20240101", 2), ("error_bucket", 2)]
    count = lambda p: rows(spark.read.schema("value string, day string").text(p).groupBy("day").count())
    write_by_day(read_lines(spark, src), str(tmp_path / "b"), "at")
    assert count(str(tmp_path / "b")) == want
    writer = stream_by_day(stream_lines(spark, src), str(tmp_path / "s"), str(tmp_path / "c"), "at")
    writer.trigger(availableNow=True).start().awaitTermination()
    assert count(str(tmp_path / "s")) == want
    flat = stream_by_day(stream_lines(spark, src), str(tmp_path / "f"), str(tmp_path / "c2"), None)
    flat.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.text(str(tmp_path / "f")).count() == 5


def test_stream_job(spark, feed, tmp_path):
    f = feed(PAGE).add(page("a", "2024-01-01 00:00:01")).add(page("z", FAR))
    table = MetricTable(spark, str(tmp_path / "m"))
    job = StreamJob("home", lambda s: jobs.home_detail_window(pages(s)), table.apply)
    job.start(spark, f.stream(), str(tmp_path), once=True).awaitTermination()
    assert [r.home_uv_ct for r in table.read().collect()] == [1]


# --- topic records

def test_records(spark):
    df = spark.sql("SELECT 'a' AS id, 1 AS n, 'topic_x' AS sink_table")
    row = as_records(df.drop("sink_table"), ["id"]).first()
    assert (json.loads(row.key), json.loads(row.value)) == ({"id": "a"}, {"id": "a", "n": 1})
    routed = as_records_routed(df, "sink_table").first()
    assert (routed.topic, json.loads(routed.value)) == ("topic_x", {"id": "a", "n": 1})
    assert as_records(spark.sql("SELECT 'raw' AS value")).first().value == "raw"
    assert topic_options("h:1", "t", group="g", discovery_ms=1000)["kafka.group.id"] == "g"


def test_json_table(spark):
    lines = spark.createDataFrame([('{"common":{"mid":"m"},"ts":1704067200000}',)], "value string")
    json_table(lines, schemas.PAGE_LOG, view="page_log", event_ms="ts", delay="3 seconds")
    assert spark.sql("SELECT common.mid, cast(et AS string) AS et FROM page_log").first() == ("m", "2024-01-01 00:00:00")


def test_state_has_a_few_stores_per_core(spark, feed, tmp_path):
    """A join in state opens one store per partition, and a few partitions per core however many a shuffle has."""
    left = feed("l string, t string").add(("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:00:00"), ("c", "2024-01-01 00:00:00"))
    right = feed("r string, u string").add(("a", "2024-01-01 00:00:01"), ("b", "2024-01-01 09:00:00"))
    timed = lambda f, c: f.stream().withColumn(c, F.col(c).cast("timestamp")).withWatermark(c, "1 second")
    prepare(spark)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        joined = fact_join(timed(left, "t"), timed(right, "u"), {"l": "r"}, "inner", "t", "u", "1 hour")
        to_files(joined, str(tmp_path / "data"), str(tmp_path / "checkpoint"), once=True).awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [r.l for r in spark.read.parquet(str(tmp_path / "data")).collect()] == ["a"]
    partitions = [p for p in (tmp_path / "checkpoint/state/0").iterdir() if p.name.isdigit()]
    assert len(partitions) == 2 * spark.sparkContext.defaultParallelism
    assert not any(p.name.startswith(("left-", "right-")) for part in partitions for p in part.iterdir())


def test_a_large_delivery_arrives_in_slices(spark):
    """A state that joins forgets between the slices of a delivery; the rows are those of one micro-batch per delivery."""
    feed = spark.range(2000).select(F.concat(F.lit("k"), F.col("id") % 500).alias("k"), (F.lit(T0) + F.col("id") * 60_000).alias("ts"), (F.col("id") % 3).alias("kind"))
    seen = []

    def build(stream):
        side = lambda n, name: stream.where(F.col("kind") == n).select(F.col("k").alias(f"{name}k"), F.col("ts").alias(f"{name}ts"), F.timestamp_millis("ts").alias(
            f"{name}et")).withWatermark(f"{name}et", "3 seconds")
        seen.append(stream)
        return fact_join(side(0, "a"), side(1, "b"), {"ak": "bk"}, "left", "aet", "bet", "10 hours").select("ak", "ats", "bts")

    closing = {"k": F.lit(None).cast("string"), "ts": F.lit(T0 + 10**10)}
    key = lambda r: (r[0] or "", r[1], r[2] or 0)
    whole = sorted(map(tuple, replay(feed, build, "ts", "whole_test", closing=closing).collect()), key=key)
    assert len(seen) == 3  # two deliveries and the closing row
    sliced = sorted(map(tuple, replay(feed, build, "ts", "sliced_test", closing=closing, slice_rows=300).collect()), key=key)
    assert len(seen) == 6  # slices are no restarts
    assert sliced == whole and any(r[2] for r in whole) and any(r[2] is None for r in whole)
    root = Path(shared_root(spark))
    assert len(list(root.glob("sliced_test-feed*/part=*"))) == 9 and len(list(root.glob("whole_test-feed*/part=*"))) == 3
    batches = lambda name: max(int(p.name) for p in root.glob(f"{name}-*/checkpoint/commits/*") if p.name.isdigit())
    assert batches("sliced_test") > batches("whole_test") + 4


def test_streams_clean_up_after_their_batches(spark, feed, tmp_path):
    """What a micro-batch shuffled goes with it; the session that started the stream keeps its settings."""
    key, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    lines = feed("value string").add(("x",)).stream()
    to_batches(lines, lambda batch, n: seen.append(batch.sparkSession.conf.get(key)), str(tmp_path / "c"), once=True).awaitTermination()
    assert seen == ["true"] and spark.conf.get(key, None) is None


def test_details_in_a_state_are_numbers(spark, feed, rows):
    f = feed(DETAIL.replace("id string", "id string, user_id string, sku_name string, activity_id string, activity_rule_id string, coupon_id string, sku_num string", 1))
    f.add(*[(i, "7", "a name", None, "x", None, "3", "o1", sku, "2", "1.50", "1.50", "0.5", "1.50", T0) for i, sku in (("1", "12"), ("2", "012"), ("3", None))])
    change = b.envelope("order_info", "u", F.lit(T0), b.row(id=F.lit("o1"), order_status=F.lit("1001")), b.row(id=F.lit("o1"), order_status=F.lit("1003"), operate_time=F.lit(T0)))
    changes = spark.range(1).select(change.alias("e")).select("e.*")
    got = facts.order_cancel(changes, f.batch())
    assert "_texts" in got._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in got.select("id", "sku_id", "activity_id", "activity_rule_id", "sku_num", "split_coupon_amount").orderBy("id").collect()] == [
        ("1", "12", None, "x", "3", "0.5"), ("2", "012", None, "x", "3", "0.5"), ("3", None, None, "x", "3", "0.5")]


def test_texts_of_a_table_travel_as_numbers(spark, tmp_path):
    """Of equal times the greater text is newer, also where its number is less; a read gives every text back."""
    table = LevelledTable(TableGroup(spark, str(tmp_path)), "t", T.StructType.fromDDL("id string, n string, m string, ts bigint"), ["id"], ["ts", "n"],
                          numbers={"n": "int", "m": "decimal(16,2)"})
    schema = table.schema
    table.apply(spark.createDataFrame([("a", "9", "1.50", 1), ("b", "07", None, 1), ("c", None, "1.5", 1), ("d", "1", "1.00", 5)], schema), 0)
    table.apply(spark.createDataFrame([("a", "10", "2.50", 1), ("b", "8", "x", 1), ("d", "2", "1.00", 4)], schema), 1)
    want = {("a", "9", "1.50", 1), ("b", "8", "x", 1), ("c", None, "1.5", 1), ("d", "1", "1.00", 5)}
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    assert {tuple(r) for r in table.read().collect()} == want == {tuple(r) for r in table.read(keys).collect()}
    assert "_texts" in table.read(keys)._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in table.cells(keys.where("id = 'a'"), "id", "n").collect()} == {("a", "9"), ("a", "10")}
