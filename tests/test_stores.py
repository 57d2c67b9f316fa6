"""First-visit dates, dictionary versions and day files."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from brookmart.sources.dictionaries import HOUR_MS, DictionaryVersions
from brookmart.sources.files import DayFiles
from brookmart.streaming import keyed
from brookmart.streaming.runner import deliveries, drain
from brookmart.streaming.first_visits import FirstVisits

VISIT = "n long, mid string, is_new string, et timestamp"


def at(text):
    return datetime.fromisoformat(text)


@pytest.fixture
def repair(spark, tmp_path):
    """Repaired flags by row number, batch after batch."""
    dates, out = FirstVisits(spark, str(tmp_path / "dates")), {}

    def give(batch_id, *rows):
        dates.apply(spark.createDataFrame(list(rows), VISIT), batch_id, ["n"], lambda df, _: out.update({r.n: r.is_new for r in df.collect()}))
        return out

    give.dates = dates
    return give


def test_flags_follow_the_first_date(repair):
    day1, day2 = at("2024-01-01 10:00:00"), at("2024-01-02 10:00:00")
    repair(0, (1, "a", "1", day1), (2, "a", "1", day2), (3, "b", "0", day2), (4, None, "1", day2), (5, "c", "1", None), (6, "b", "1", at("2024-01-02 11:00:00")))
    out = repair(1, (7, "a", "1", day1), (8, "a", "1", at("2024-01-09 00:00:00")), (9, "d", "1", day2), (10, "b", "1", day1))
    assert out == {1: "1", 2: "0", 3: "0", 4: "1", 5: "1", 6: "0", 7: "1", 8: "0", 9: "1", 10: "1"}
    assert {r.mid: r.first_date for r in repair.dates.dates.read().collect()} == {"a": "2024-01-01", "b": "2024-01-01", "d": "2024-01-02"}


def test_a_batch_done_again_keeps_its_dates(spark, repair, monkeypatch):
    day1, day2 = at("2024-01-01 10:00:00"), at("2024-01-02 10:00:00")
    commit = repair.dates.group.commit
    monkeypatch.setattr(repair.dates.group, "commit", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        repair(0, (1, "a", "1", day1))
    assert repair.dates.dates.read().count() == 0
    monkeypatch.setattr(repair.dates.group, "commit", commit)
    repair(0, (1, "a", "1", day1))
    assert repair(1, (2, "a", "1", day2)) == {1: "1", 2: "0"}


def test_a_hot_visitor_is_no_task_of_its_own(spark, tmp_path):
    """Half of all rows have one visitor: what is grouped is one row per visitor and task, and the join is split."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    rows = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("n"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("mid"), F.lit("1").alias("is_new"),
                                               F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("et"), F.sha2(F.col("id").cast("string"), 256).alias("more"))
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    dates = FirstVisits(spark, str(tmp_path / "dates"))
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        dates.dates.stage(dates.new_dates(rows), 0)
        fixed = dates.repaired(rows, ["n"])
        parts = fixed.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count(F.lit(1)).alias("count"), F.max("more")).collect()
        assert max(r["count"] for r in parts) < 2 * 60_000 / 16, sorted(r["count"] for r in parts)
        assert "Python" not in fixed._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_dictionary_versions(spark, tmp_path):
    words = {"a": "one", "b": "two"}
    load = lambda: spark.createDataFrame([(k, (v,)) for k, v in words.items()], "dic_code string, info struct<dic_name: string>")
    versions = DictionaryVersions(spark, str(tmp_path / "d"), load, max_age_ms=HOUR_MS)
    names = lambda ms: {r.dic_code: r.info.dic_name for r in versions.at(ms).collect()}
    assert names(1000) == {"a": "one", "b": "two"}
    words |= {"a": "uno", "c": "three"}
    del words["b"]
    assert names(1000 + HOUR_MS - 1) == {"a": "one", "b": "two"}  # not old enough
    assert names(1000 + HOUR_MS) == {"a": "uno", "c": "three"}
    assert names(2000) == {"a": "one", "b": "two"}  # a batch of before, done again
    words["b"] = "again"
    assert names(1000 + 3 * HOUR_MS) == {"a": "uno", "c": "three", "b": "again"}
    rows = spark.createDataFrame([("b", 5000), ("b", 1000 + 2 * HOUR_MS), ("b", 1000 + 9 * HOUR_MS), ("a", 0), (None, 5000)], "code string, ms long")
    assert [r.name for r in versions.join(rows, "code", "ms", "name").orderBy(F.col("code").desc(), "ms").collect()] == ["two", None, "again", None, None]


def test_day_files_roll(spark, tmp_path):
    table = DayFiles(spark, str(tmp_path / "f"), file_bytes=1000)
    line = lambda i, day: (f"line {i:04d} " + "x" * 20, day)
    for n in range(12):
        table.apply(spark.createDataFrame([line(n * 10 + i, "20240101") for i in range(10)] + [line(n, "20240102")], "value string, day string").repartition(4), n)
    table.apply(spark.createDataFrame([line(0, "20240101")], "value string, day string"), 11)  # done again
    before = table.read()
    assert before.count() == 132 and before.select(F.input_file_name()).distinct().count() > 24
    table.roll()
    files = {r.day: r.files for r in table.read().select("day", F.input_file_name().alias("file")).groupBy("day").agg(F.count_distinct("file").alias("files")).collect()}
    assert table.read().count() == 132 and files["20240102"] == 1 and 2 <= files["20240101"] <= 4
    assert before.count() == 132  # a reader that began earlier
    table.roll()
    assert DayFiles(spark, str(tmp_path / "f")).read().count() == 132
    for n in range(12, 24):
        table.apply(spark.createDataFrame([line(n, "20240103")], "value string, day string"), n)
    assert not (tmp_path / "f/lines/run=0-0").exists() and table.read().count() == 144


def test_a_feed_is_computed_once_for_all_its_parts(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    feed = spark.range(30).selectExpr("if(id = 7, null, id) AS id").mapInPandas(counted, "id long")
    sizes = []
    for part in deliveries(feed, "id", cuts=[9, 9, 40]):
        sizes.append(drain(part, "seen").count())
    assert sizes == [9, 9, 29, 29]  # null has no time, an empty part is delivered too
    assert seen.value == 30


def test_keyed_lines_are_parsed_for_their_own_side(spark, tmp_path, monkeypatch):
    asked, parse = [], keyed.parse_envelopes
    monkeypatch.setattr(keyed, "parse_envelopes", lambda lines, tables: asked.append(tables) or parse(lines, tables=tables))
    lines = spark.createDataFrame([
        ('{"after":{"id":"d","order_id":"o"},"source":{"table":"order_detail"},"op":"c","ts_ms":1}', 1),
        ('{"after":{"id":"o","user_id":"u"},"source":{"table":"order_info"},"op":"c","ts_ms":2}', 2),
        ('{"after":{"order_detail_id":"d","coupon_id":"c"},"source":{"table":"order_detail_coupon"},"op":"c","ts_ms":3}', 3)], "value string, at long")
    fact = keyed.order_details(spark, str(tmp_path / "f"))
    for part in deliveries(lines, "at", cuts=[1, 2]):
        fact.start(part, str(tmp_path / "c"), once=True).awaitTermination()
    assert [(r.id, r.user_id, r.coupon_id) for r in fact.read().collect()] == [("d", "u", "c")]
    assert set(map(tuple, asked)) == {("order_detail",), ("order_info",), ("order_detail_activity",), ("order_detail_coupon",)}
