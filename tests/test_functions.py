from __future__ import annotations

import json
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brookmart.functions import dates, jsons, keys, numbers, text
from brookmart.operators import keywords


def values(spark, data, expression, column="s", kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, {column} {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def strict_object(s: str) -> bool:
    def refuse(name):
        raise ValueError(name)

    try:
        return isinstance(json.loads(s, parse_constant=refuse), dict)
    except ValueError:
        return False


EDGES = ['{}', '{"a":1}', '{"a":1}x{', '{"a":1}]', '{"a":1}}', '{"a":1}],[{', '{"a":1},{"b":2}', '', ' ', '[]', '[{"a":1}]', 'null',
         '1', '"x"', "{'a':1}", '{"a":NaN}', '{"a":01}', '{a:1}', '{"a":1', ' {"a": 1} ', '{"a":{"b":[1,2,{"c":null}]}}',
         '{"a":"}"}', '{"a":"]"}', '{"a":1}\n{"b":2}', '{"a":1,}', '{"a":1} // c', '{"a":"\\ud83d"}', '{"a":1,"a":2}',
         '{"w":1}}', '{"a":1}]}', '{"a":1}}]']


def test_json_object_edges(spark):
    assert values(spark, EDGES, jsons.is_json_object(F.col("s"))) == [strict_object(s) for s in EDGES]


def test_json_object_null(spark):
    assert values(spark, [None], jsons.is_json_object(F.col("s"))) == [False]


plain = st.recursive(st.none() | st.booleans() | st.integers(-10**6, 10**6) | st.text("ab\"\\{}[],: é中", max_size=5),
                     lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text("ab", max_size=2), x, max_size=3), max_leaves=6)
broken = st.builds(lambda v, cut, tail: json.dumps(v)[:cut] + tail, plain, st.integers(0, 30), st.text("{}[],: \"x1", max_size=3))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(broken | st.builds(json.dumps, plain), min_size=20, max_size=60))
def test_json_object_like_strict_parser(spark, texts):
    assert values(spark, texts, jsons.is_json_object(F.col("s"))) == [strict_object(s) for s in texts]


def test_json_list_append(spark):
    df = spark.createDataFrame([(None, "a"), ('["x"]', 'b"c'), ("[]", "d")], "s string, e string")
    got = [r[0] for r in df.select(jsons.append_to_json_list(F.col("s"), F.col("e"))).collect()]
    assert [json.loads(g) for g in got] == [["a"], ["x", 'b"c'], ["d"]]


def test_hex_decimal(spark):
    big = "0x" + "f" * 64
    data = ["0x0", "0xff", "0x00ff", "0x" + "f" * 31, big, "123", None, "0x"]
    got = values(spark, data, numbers.hex_to_decimal_text(F.col("s")))
    assert got[:7] == ["0", "255", "255", str(16**31 - 1), str(16**64 - 1), "123", "0"]


def test_exponents(spark):
    data = ["1E+3", "1e3", "1.5E+3", "1.23456e2", "12e-3", "-12.5e-1", "0e5", "1E0", "+2E+1", "123e-3", ".5e1", "1e", "e3", "x"]
    want = ["1000", "1000", "1500", "123.456", "0.012", "-1.25", "0", "1", "20", "0.123", "5", "1e", "e3", "x"]
    assert values(spark, data, numbers.hex_to_decimal_text(F.col("s"))) == want
    assert values(spark, ["1E+18"], numbers.hex_to_decimal_text(F.col("s"), to_ether=True)) == ["1"]


@pytest.mark.parametrize("plain_text, expected", [
    ("1500000000000000000", "1.5"), ("2000000000000000000", "2"), ("1", "0.000000000000000001"), ("0", "0"),
    ("-2500000000000000000", "-2.5"), ("10" + "0" * 30, "10000000000000"), ("12.5", "0.0000000000000000125"),
    ("100000000000000000", "0.1"), (str(16**64 - 1), format(Decimal(16**64 - 1).scaleb(-18), "f"))])
def test_ether(spark, plain_text, expected):
    import decimal

    with decimal.localcontext(prec=90):
        if len(plain_text) > 40:
            expected = format(Decimal(plain_text).scaleb(-18), "f")
    assert values(spark, [plain_text], numbers.hex_to_decimal_text(F.col("s"), to_ether=True)) == [expected]


def test_hex_words(spark):
    one, two = "1" * 64, "2" * 64
    got = values(spark, [None, "", "0x" + one, "0x" + one + two], numbers.hex_words(F.col("s")))
    assert got == [[], [], ["0x" + one], ["0x" + one, "0x" + two]]


def test_buckets(spark):
    import hashlib

    data = ["a", "17", "0xDAC17F958D2EE523A2206206994597C13D831EC7"]
    got = values(spark, data, keys.hash_bucket(F.col("s"), 128))
    assert got == [f"{int(hashlib.md5(v.encode()).hexdigest()[-3:], 16) % 128:04d}" for v in data]
    assert values(spark, data, keys.hash_bucket_with_overrides(F.col("s")))[2] == "9002"


def test_strings(spark):
    data = [None, "", " ", "a", "éA", "\t"]
    assert values(spark, data, text.is_empty(F.col("s"))) == [True, True, False, False, False, False]
    assert values(spark, data, text.is_blank(F.col("s"))) == [True, True, True, False, False, True]
    assert values(spark, data, text.capitalise_first(F.col("s"))) == [None, "", " ", "A", "ÉA", "\t"]
    assert values(spark, ["中文a1[]-", "a b", "", "（）", "a\n", "é"], text.only_allowed_characters(F.col("s"))) == [
        True, False, False, True, False, False]
    assert text.camel_case("order_detail_id") == text.camel_case("ORDER_DETAIL_ID") == "orderDetailId"
    joined = values(spark, [["a", None, "b"], None, []], text.to_csv_text(F.col("s")), kind="array<string>")
    assert joined == ["a, null, b", None, ""]


def test_dates(spark):
    assert values(spark, ["1714500000123"], dates.text_millis_to_datetime(F.col("s"))) == ["2024-04-30 18:00:00"]
    df = spark.sql("SELECT date'2024-02-28' AS a, date'2024-03-01' AS b")
    row = df.select(dates.day_numbers("a", "b"), dates.day_numbers("b", "a"), dates.day_numbers("a", "a")).first()
    assert list(row) == [[20240228, 20240229, 20240301], [], [20240228]]
    assert values(spark, [1714500000, 1714500000123], dates.epoch_to_millis("s"), kind="bigint") == [1714500000000, 1714500000123]


def test_afternoon_keeps_its_hour(spark):
    assert values(spark, ["1714482000000"], dates.text_millis_to_datetime(F.col("s"))) == ["2024-04-30 13:00:00"]


def test_zone_round_trip(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        label = dates.millis_to_datetime(F.col("s"))
        assert values(spark, [1714500000000], label, kind="bigint") == ["2024-05-01 02:00:00"]
        assert values(spark, [1714500000000], dates.datetime_to_millis(label), kind="bigint") == [1714500000000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dictionary_splitter(spark):
    split = keywords.dictionary_splitter(["小米", "小米手机", "手机"])
    got = values(spark, ["小米手机x9 红", None, ""], split(F.col("s")))
    assert got == [["小米手机", "x", "9", "红"], None, []]
    with pytest.raises(ValueError):
        keywords.dictionary_splitter(["a", "b"], max_words=1)
