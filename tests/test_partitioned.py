"""Tables split by a column."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sedimenta.plans import PartitionedStore, StepSpec, TableSpec, run_bronze, run_silver
from sedimenta.sources import write_files

SCHEMA = "k string, v int, d string"


@pytest.fixture
def split(spark, layout):
    day = F.col("d")
    return PartitionedStore(
        spark, layout, {(layer, "t"): day for layer in ("bronze", "silver", "gold")}, keep=2)


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def written(split):
    """The files of each partition."""
    base = split.layout.path("gold", "t")
    return {
        name.split("=")[1]: sorted(f for f in os.listdir(f"{base}/{name}") if f.endswith(".parquet"))
        for name in os.listdir(base) if name.startswith("lake_part=")
    }


def test_only_touched_partitions_are_written(spark, split):
    first = frame(spark, ("a", 1, "01"), ("b", 2, "02"), ("c", 3, None), ("d", 4, "x y/z:1"))
    assert not split.exists("gold", "t")
    split.save(first, "gold", "t", ["k"])
    assert rows(split.read("gold", "t")) == rows(first)
    before = written(split)
    assert set(before) == {"p01", "p02", "p", "px_y_z_1"}

    second = frame(spark, ("b", 20, "02"), ("e", 5, "02"), ("f", 6, "03"))
    split.save(second, "gold", "t", ["k"])
    want = [("a", 1, "01"), ("b", 20, "02"), ("c", 3, None), ("d", 4, "x y/z:1"),
            ("e", 5, "02"), ("f", 6, "03")]
    assert rows(split.read("gold", "t")) == sorted(want, key=repr)
    after = written(split)
    assert {p for p in after if after[p] != before.get(p)} == {"p02", "p03"}


def test_marks_touch_only_partitions_with_such_rows(spark, split):
    split.save(frame(spark, ("a", 1, "01"), ("b", 2, "02"), ("c", 3, "x y")), "gold", "t", ["k"])
    before = written(split)
    split.set_where("gold", "t", F.col("v") == 3, {"v": "v * 10"})
    split.set_matched(frame(spark, ("b", 0, "")), "gold", "t", ["k"], {"v": "99"})
    assert [r[:2] for r in rows(split.read("gold", "t"))] == [("a", 1), ("b", 99), ("c", 30)]
    assert written(split)["p01"] == before["p01"]
    split.set_where("gold", "t", F.col("v") == 12345, {"v": "0"})
    assert [r[:2] for r in rows(split.read("gold", "t"))] == [("a", 1), ("b", 99), ("c", 30)]


def test_late_columns_and_empty_batches(spark, split):
    assert split.save(frame(spark), "gold", "t", ["k"]).empty
    split.save(frame(spark, ("a", 1, "01")), "gold", "t", ["k"])
    late = frame(spark, ("b", 2, "02")).withColumn("late", F.lit("x"))
    split.save(late, "gold", "t", ["k"])
    assert rows(split.read("gold", "t").select("k", "late")) == [("a", None), ("b", "x")]


def test_other_tables_are_kept_whole(spark, split):
    split.save(frame(spark, ("a", 1, "01")), "gold", "other", ["k"])
    split.set_where("gold", "other", F.lit(True), {"v": "2"})
    split.set_matched(frame(spark, ("a", 0, "")), "gold", "other", ["k"], {"d": "'z'"})
    assert split.exists("gold", "other") and rows(split.read("gold", "other")) == [("a", 2, "z")]


def test_layer_steps_on_split_tables(spark, layout, split):
    table = TableSpec(
        "t",
        bronze=StepSpec(lambda f: f, key=("k",)),
        silver=StepSpec(lambda f: f.drop("processed", "creationDate"), key=("k",)),
    )
    for day, batch in enumerate(
        [[("a", 1, "01"), ("b", 2, "02")], [("b", 9, "02"), ("c", 3, "03")]], start=1
    ):
        write_files(frame(spark, *batch), layout.path("transient", "t"))
        as_of = f"2026-12-0{day} 00:00:00"
        assert run_bronze(split, table, layout, as_of).status == "ok"
        assert run_silver(split, table, as_of, incremental=True).status == "ok"
    got = split.read("silver", "t").select("k", "v", F.dayofmonth("creationDate"))
    assert rows(got) == [("a", 1, 1), ("b", 9, 2), ("c", 3, 2)]
    assert split.read("bronze", "t").where("not processed").count() == 0


def test_batches_that_do_not_fit_are_refused_before_any_change(spark, split):
    split.save(frame(spark, ("a", 1, "01"), ("b", 2, "02")), "gold", "t", ["k"])
    before = rows(split.read("gold", "t"))
    with pytest.raises(Exception, match="share one key"):
        split.save(frame(spark, ("n", 1, "03"), ("n", 2, "04")), "gold", "t", ["k"])
    wide = spark.createDataFrame([("w", 1 << 40, "05")], "k string, v bigint, d string")
    with pytest.raises(Exception, match="OVERFLOW"):
        split.save(wide, "gold", "t", ["k"])
    assert rows(split.read("gold", "t")) == before
    narrow = spark.createDataFrame([("w", 7, "05")], "k string, v bigint, d string")
    split.save(narrow, "gold", "t", ["k"])
    assert rows(split.read("gold", "t")) == sorted([*before, ("w", 7, "05")], key=repr)


def test_the_first_batch_is_written_once_and_marks_need_no_shuffle(spark, layout):
    split = PartitionedStore(spark, layout, {("gold", "t"): F.col("k")})
    first = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), (None, 3)], "k string, v int")
    assert not split.save(first, "gold", "t", ["k"], unique=True).empty
    assert not os.path.exists(f"{layout.path('gold', 't')}_batches")
    assert rows(split.read("gold", "t").select("k", "v")) == rows(first)
    split.set_where("gold", "t", F.col("v") == 3, {"v": "4"})
    assert sorted(r.v for r in split.read("gold", "t").collect()) == [1, 2, 4, 4]
