"""Audit, dedupe and joins."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sedimenta.operators import (
    dedupe,
    join_on_columns,
    join_on_concat,
    join_skewed,
    latest_per_key,
    normalize_temporal,
    null_to_nan,
    only_unprocessed,
    with_audit,
)
from sedimenta.plans import retail


def test_audit_columns(spark):
    got = with_audit(spark.range(1), "2026-12-01 10:00:00")
    assert rows(got) == [(0, False, dt.datetime(2026, 12, 1, 10))]
    now = with_audit(spark.range(1)).select("creationDate").first()[0]
    assert abs((dt.datetime.now() - now).total_seconds()) < 86400


def test_only_unprocessed_takes_null_flags(spark):
    flags = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, processed boolean")
    assert rows(only_unprocessed(flags).select("id")) == [(2,), (3,)]


def test_normalize_temporal(spark):
    moment = dt.datetime(2020, 1, 2, 3, 4, 5)
    frame = spark.createDataFrame(
        [(moment, moment, moment.date(), 1)], "a.b timestamp_ntz, t timestamp, d date, i int"
        .replace("a.b", "`a.b`"))
    got = normalize_temporal(frame)
    assert [f.dataType.simpleString() for f in got.schema] == [
        "timestamp", "timestamp", "date", "int"]
    assert rows(got) == rows(frame)
    assert normalize_temporal(got).schema == got.schema


def test_null_to_nan(spark):
    frame = spark.createDataFrame(
        [(None, None, None)], "d double, f float, i int")
    d, f, i = null_to_nan(frame).first()
    assert math.isnan(d) and math.isnan(f) and i is None


def test_dedupe_survivor_does_not_depend_on_row_order(spark):
    data = [(1, "b", 2), (1, "a", 3), (1, "a", 2), (2, None, 1), (None, "x", 1), (None, "y", 1)]
    schema = "k int, a string, b int"
    want = [(1, "a", 2), (2, None, 1), (None, "x", 1)]
    for order in (data, data[::-1]):
        frame = spark.createDataFrame(order, schema).repartition(3)
        assert rows(dedupe(frame, "k")) == sorted(want, key=repr)
    newest = dedupe(frame, ["k"], [F.col("b").desc()])
    assert (1, "a", 3) in rows(newest)


def test_dedupe_needs_keys(spark):
    with pytest.raises(ValueError):
        dedupe(spark.range(1), [])


def test_latest_per_key(spark):
    data = [(1, "old", dt.datetime(2020, 1, 1)), (1, "new", dt.datetime(2021, 1, 1)),
            (2, "only", None)]
    frame = spark.createDataFrame(data, "k int, v string, creationDate timestamp")
    assert rows(latest_per_key(frame, "k").select("k", "v")) == [(1, "new"), (2, "only")]


def test_compat_key_collapses_rows_with_null(spark):
    data = [("C1", 1, None, "A", "R1"), ("C2", 1, None, "B", "R1")]
    frame = spark.createDataFrame(
        data, "v_id_cli string, n_sq_end bigint, d_dt_exc timestamp, v_lcl string, v_uf string")
    compat = retail.bronze("enderecos_clientes", frame, key_mode="compat")
    assert dedupe(compat, "hash_id").count() == 1
    strict = retail.bronze("enderecos_clientes", frame)
    assert dedupe(strict, "hash_id").count() == 2
    assert retail.bronze_distinct("enderecos_clientes", frame.union(frame)).count() == 2


def test_concat_join_meets_across_the_border(spark):
    sales = spark.createDataFrame([(1, 23, "s")], "a int, b int, s string")
    items = spark.createDataFrame([(12, 3, "i")], "a int, b int, i string")
    assert join_on_concat(sales, items, ["a", "b"]).count() == 1
    assert join_on_columns(sales, items, ["a", "b"]).count() == 0


@pytest.mark.parametrize("salts", [1, 7])
def test_skewed_join_is_the_plain_join(spark, salts):
    many = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("k"),
        (F.col("id") % 2).alias("v"))
    one = spark.createDataFrame([(k, f"n{k}") for k in range(0, 30)], "k bigint, n string")
    assert rows(join_skewed(many, one, "k", salts)) == rows(many.join(one, "k"))


def test_skewed_join_checks_salts(spark):
    with pytest.raises(ValueError):
        join_skewed(spark.range(1), spark.range(1), "id", 0)


def test_the_repeated_side_of_a_salted_join_is_not_broadcast(spark):
    many, one = spark.range(100).selectExpr("id % 10 as k", "id as v"), spark.range(10).selectExpr("id as k", "id * 2 as w")
    joined = join_skewed(many, one, "k", salts=4)
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert rows(joined) == rows(many.join(one, "k"))
