"""Column functions on literal rows."""

import datetime as dt
import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sedimenta.functions import (
    age_calendar,
    age_days365,
    blank_if_null,
    date_or_blank,
    decode_map,
    flag_from,
    flag_label,
    money,
    row_key,
    row_key_for,
    timestamp_or_blank,
    to_bigint,
)
from sedimenta.plans import retail


def values(spark, schema, data, column):
    frame = spark.createDataFrame(data, schema)
    return [r[0] for r in frame.select(column).collect()]


def test_channel_codes(spark):
    got = values(
        spark,
        "c string",
        [("L",), ("A",), ("S",), ("T",), (None,)],
        decode_map("c", retail.CHANNELS),
    )
    assert got == ["Loja", "App", "Site", None, None]


@pytest.mark.parametrize(
    "schema,data",
    [("c int", [1, 3, 6, 7, None]), ("c double", [1.0, 3.0, 6.0, 1.5, None]),
     ("c string", ["1", "3", "6", "junk", None])],
)
def test_numeric_codes_decode_whatever_the_column_type(spark, schema, data):
    column = decode_map("c", retail.MARITAL_STATES, "")
    got = values(spark, schema, [(d,) for d in data], column)
    assert got == ["Solteiro", "Viúvo", "Outros", "", ""]


def test_decode_needs_codes():
    with pytest.raises(ValueError):
        decode_map("c", {})


def test_flags(spark):
    assert values(spark, "c string", [("SIM",), ("NAO",), (None,)], flag_from("c")) == [
        True, False, False]
    assert values(spark, "c boolean", [(True,), (False,), (None,)], flag_label("c")) == [
        "SIM", "NÃO", ""]


def test_discount_type(spark):
    data = [("SIM", 0.0), ("NAO", 0.5), ("NAO", 0.0), ("NAO", None), (None, 1.0)]
    got = values(spark, "a string, d double", data, retail.discount_type("a", "d"))
    assert got == ["Convênio", "Promoção", "Sem Desconto", "Sem Desconto", "Sem Desconto"]


def test_dates_and_timestamps_or_blank(spark):
    moment = dt.datetime(2020, 1, 2, 3, 4, 5)
    assert values(spark, "c timestamp_ntz", [(moment,), (None,)], date_or_blank("c")) == [
        "2020-01-02", ""]
    assert values(spark, "c string", [("abc",), ("2020-01-02",)], date_or_blank("c")) == [
        "", "2020-01-02"]
    assert values(spark, "c timestamp_ntz", [(moment,), (None,)], timestamp_or_blank("c")) == [
        "2020-01-02 03:04:05", ""]


def test_ages(spark):
    data = [("1990-12-02",), ("",), (None,)]
    assert values(spark, "c string", data, age_days365("c", "2026-12-01")) == [36, None, None]
    assert values(spark, "c string", data, age_calendar("c", "2026-12-01")) == [35, None, None]


def test_age_defaults_to_today(spark):
    got = values(spark, "c date", [(dt.date(1990, 1, 1),)], age_days365("c"))
    assert got == [(dt.date.today() - dt.date(1990, 1, 1)).days // 365]


def test_number_casts(spark):
    assert values(spark, "c double", [(1.9,), (-1.9,), (None,)], to_bigint("c")) == [1, -1, None]
    assert values(spark, "c string", [("12",), ("x",)], to_bigint("c")) == [12, None]
    got = values(spark, "c double", [(1.005,), (2.5,), (None,)], money("c").cast("string"))
    assert got == ["1.01", "2.50", None]
    assert values(spark, "c string", [(None,), ("a",)], blank_if_null("c")) == ["", "a"]


NASTY = [
    ("x|1:y", "z"), ("x", "1:y|z"), (None, "~"), ("~", None), ("Viúvo", "😀"), ("", "a"),
    (None, None),
]


def test_strict_keys_are_distinct_and_never_null(spark):
    keys = values(spark, "a string, b string", NASTY, row_key(["a", "b"]))
    assert None not in keys and len(set(keys)) == len(NASTY)
    text = "5:x|1:y|1:z"
    assert keys[0] == hashlib.sha256(text.encode()).hexdigest()


def test_strict_key_by_type_is_distinct(spark):
    data = [(n, s, d) for n in (None, 1, 11) for s in (None, "~", "1|1", "") for d in
            (None, dt.date(2020, 1, 1))]
    frame = spark.createDataFrame(data, "n bigint, s string, d date")
    keys = [r[0] for r in frame.select(row_key_for(frame)).collect()]
    assert None not in keys and len(set(keys)) == len(data)


def test_compat_key_collides_and_goes_null(spark):
    data = [(1, 23, 5), (12, 3, 5), (None, 1, 1)]
    schema = "a bigint, b bigint, c bigint"
    compat = values(spark, schema, data, row_key(["a", "b", "c"], mode="compat"))
    assert compat == [base64.b64encode(b"1235").decode()] * 2 + [None]
    strict = values(spark, schema, data, row_key(["a", "b", "c"]))
    assert len(set(strict)) == 3


def test_long_compat_key_is_plain_base64_once_unwrapped(spark):
    text = "k" * 100
    key = F.regexp_replace(row_key(["c"], mode="compat"), r"\r\n", "")
    assert values(spark, "c string", [(text,)], key) == [base64.b64encode(text.encode()).decode()]


def test_key_arguments_are_checked():
    with pytest.raises(ValueError):
        row_key([])
    with pytest.raises(ValueError):
        row_key(["a"], mode="md5")


def test_functions_hold_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        got = spark.createDataFrame([("abc", "x")], "a string, b string").select(
            date_or_blank("a"), to_bigint("b"), flag_label("b"), money("b"))
        assert rows(got) == [("", None, "", None)]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numbers_and_timestamps_in_text(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        texts = ["12", "12.0", "-1.9", "1e3", "", "x", None, "1e30"]
        frame = spark.createDataFrame([(t,) for t in texts], "t string")
        assert [r[0] for r in frame.select(to_bigint("t")).collect()] == [12, 12, -1, 1000, None, None, None, None]
        times = spark.createDataFrame([("2020-01-02 03:04:05",), ("",), ("no",), (None,)], "t string")
        got = [r[0] for r in times.select(timestamp_or_blank("t")).collect()]
        assert got[0].startswith("2020-01-02") and got[1:] == ["", "", ""]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
