"""What merges, marks, changes and dedupes shuffle and leave on disk."""

from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sedimenta.functions.keys import content_sums, packed, unpacked
from sedimenta.operators.changes import table_changes
from sedimenta.operators.dedupe import dedupe
from sedimenta.operators.merge import leftover_keys, merge_frames
from sedimenta.operators.audit import with_audit
from sedimenta.plans import StepSpec, TableSpec, run_bronze, run_silver
from sedimenta.sources import snapshots, write_files
from sedimenta.sources.snapshots import (
    changes_in_slices,
    create_or_upsert,
    expire_snapshots,
    read_changes,
    read_table,
    replace_keys,
    save_first,
)

TEXTS = ["", "0", "00", "0a", "0A", "abc", "xyz", "ab" * 32, "é", "a b", None]
KEY = "k string, v int"


def test_packed_texts_come_back_and_stay_different(spark):
    data, text = packed(F.col("k"))
    pairs = spark.createDataFrame([(t,) for t in TEXTS], "k string").select("k", data.alias("d"), text.alias("t"))
    got = pairs.select("k", unpacked(F.col("d"), F.col("t")).alias("back"), "d", "t").collect()
    assert all(r.k == r.back for r in got) and len({(bytes(r.d), r.t) for r in got}) == len(TEXTS)
    assert {r.k: len(r.d) for r in got}["ab" * 32] == 32


@pytest.mark.parametrize("known", [True, False])
def test_whole_rows_are_replaced_as_by_the_outer_join(spark, known):
    target = spark.createDataFrame([(t, i) for i, t in enumerate(TEXTS)], KEY)
    source = spark.createDataFrame([("00", 100), ("xyz", 101), ("new", 102), ("ab" * 32, None), (None, 103)], KEY)
    leftover = leftover_keys(target, source, "k") if known else None
    got = merge_frames(target, source.select("v", "k"), "k", source_unique=True, form="replace", leftover=leftover)
    assert got.columns == ["k", "v"]
    assert rows(got) == rows(merge_frames(target, source, "k", source_unique=True, form="outer"))
    with pytest.raises(ValueError, match="columns and types"):
        merge_frames(target, source.withColumn("w", F.lit(1)), "k", source_unique=True, form="replace")


def test_a_large_batch_is_neither_shuffled_whole_nor_kept(spark, tmp_path, monkeypatch):
    seen = []
    write = snapshots._write_counted
    monkeypatch.setattr(snapshots, "_write_counted", lambda df, goal: seen.append((goal, df)) or write(df, goal))
    monkeypatch.setattr(snapshots, "_SMALL", 0)
    path = str(tmp_path / "t")
    first = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.col("id").alias("v"))
    create_or_upsert(first, path, "k", source_unique=True)
    second = first.where("v > 0").withColumn("v", -F.col("v"))
    assert create_or_upsert(second, path, "k", source_unique=True).rows == 2000
    assert sorted(r.v for r in read_table(spark, path).collect()) == list(range(-1999, 1))
    assert not os.path.exists(f"{path}/v000002/_batch")
    merges = [df for goal, df in seen if goal.endswith("v000002")]
    assert "FullOuter" not in merges[0]._jdf.queryExecution().toString()
    create_or_upsert(first.where("v = 5"), path, "k", source_unique=True)
    assert os.path.exists(f"{path}/v000003/_batch")
    assert sorted((r.v, r.change) for r in read_changes(spark, path, 2, "k").collect()) == [(-5, "update_before"), (5, "update_after")]
    assert read_changes(spark, path, 1, "k").where("change = 'update_after'").count() == 1998


def test_changes_of_text_keys(spark):
    old = spark.createDataFrame([(t, i) for i, t in enumerate(TEXTS) if t != "0A"], KEY)
    new = spark.createDataFrame([(t, 7 if t == "ab" * 32 else i) for i, t in enumerate(TEXTS) if t != "0a"], KEY)
    got = sorted((r.change, r.k, r.v) for r in table_changes(old, new, "k").collect())
    assert [g for g in got] == [("delete", "0a", 3), ("insert", "0A", 4)]
    moved = new.withColumn("v", F.when(F.col("k") == "ab" * 32, 70).otherwise(F.col("v")))
    got = sorted((r.change, r.k, r.v) for r in table_changes(new, moved, "k").collect())
    assert got == [("update_after", "ab" * 32, 70), ("update_before", "ab" * 32, 7)]


def test_packed_dedupe_is_the_same(spark):
    frame = spark.createDataFrame([(t, v) for t in TEXTS for v in (2, 1)] + [("ab" * 32, None)], KEY).select("v", "k")
    got = dedupe(frame, "k", pack=True)
    assert got.columns == frame.columns and rows(got) == rows(dedupe(frame, "k"))


def test_sql_steps_mark_bronze_by_a_note(spark, store, layout):
    def run(silver):
        bronze = StepSpec("select distinct *, sha2(k, 256) as hash_id from t_tmp", view="t_tmp")
        table = TableSpec("t", bronze=bronze, silver=StepSpec(silver, view="t_tmp"))
        write_files(spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], KEY), layout.path("transient", "t"))
        assert run_bronze(store, table, layout, "2026-12-01 00:00:00").status == "ok"
        assert run_silver(store, table).status == "ok"
        return [tuple(r) for r in store.read("bronze", "t").select("k", "processed").orderBy("k").collect()]

    assert run("select *, 1 as taken from t_tmp where k = 'a'") == [("a", True), ("b", False)]
    assert run("select *, 1 as taken from t_tmp") == [("a", True), ("b", True)]
    newest = f"{layout.path('bronze', 't')}/v{store.version('bronze', 't'):06d}"
    assert [f for f in os.listdir(newest) if f.endswith(".parquet")] == []


def test_set_most_leaves_rows_without_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_snapshot(spark.createDataFrame([("a", 0), ("a", 1), (None, 2), ("b", 3)], KEY), path)
    snapshots.set_most(spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "x string"), path, [("k", "x")], {"v": "9"})
    assert rows(read_table(spark, path)) == [("a", 9), ("a", 9), ("b", 3), (None, 2)]


def _parquet(path: str, version: int) -> list[str]:
    folder = f"{path}/v{version:06d}"
    return [f for f in os.listdir(folder) if f.endswith(".parquet")]


def _states(spark, path, since):
    return sorted((r.change, r.k, r.v) for r in read_changes(spark, path, since, "k").collect())


def test_a_batch_with_the_rows_of_the_table_is_a_note(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], KEY)
    create_or_upsert(with_audit(frame, "2026-12-01 00:00:00"), path, "k", source_unique=True)
    again = with_audit(frame.repartition(3), "2026-12-02 00:00:00").withColumn("processed", F.lit(True))
    assert create_or_upsert(again, path, "k", source_unique=True).rows == 3
    assert _parquet(path, 2) == [] and rows(read_table(spark, path)) == rows(again)
    assert _states(spark, path, 1) == []
    other = with_audit(frame.withColumn("v", F.coalesce("v", F.lit(2))), "2026-12-02 00:00:00")
    create_or_upsert(other, path, "k", source_unique=True)
    assert rows(read_table(spark, path)) == rows(other)
    assert _states(spark, path, 2) == [("update_after", "b", 2), ("update_before", "b", None)]


def test_rows_without_a_key_are_no_note(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = with_audit(spark.createDataFrame([("a", 1), (None, 2)], KEY), "2026-12-01 00:00:00")
    for _ in range(2):
        create_or_upsert(frame, path, "k", source_unique=True)
    assert sorted(r.v for r in read_table(spark, path).collect()) == [1, 2, 2]


def test_a_batch_of_new_keys_lies_beside_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    batches = [spark.createDataFrame([(f"{n}{t}", n) for t in "ab"], KEY) for n in range(5)]
    for n, batch in enumerate(batches):
        assert create_or_upsert(batch.select("v", "k") if n else batch, path, "k", source_unique=True).rows == 2 * n + 2
        snapshots.set_all(spark, path, {"v": "7"}) if n == 2 else None
    whole = [(f"{n}{t}", 7 if n < 3 else n) for n in range(5) for t in "ab"]
    assert read_table(spark, path).columns == ["k", "v"] and rows(read_table(spark, path)) == whole
    assert _states(spark, path, 5) == [("insert", "4a", 4), ("insert", "4b", 4)]
    assert expire_snapshots(spark, path, keep=1) and rows(read_table(spark, path)) == whole
    create_or_upsert(batches[0].unionByName(batches[4]), path, "k", source_unique=True)
    assert rows(read_table(spark, path)) == [("0a", 0), ("0b", 0), *whole[2:]]
    expire_snapshots(spark, path, keep=1)
    assert os.listdir(f"{path}/_base") == [] and read_table(spark, path).count() == 10


@pytest.mark.parametrize("sliced", [True, False])
def test_merges_changes_and_removals_in_slices(spark, tmp_path, monkeypatch, sliced):
    if sliced:
        monkeypatch.setattr(snapshots, "_SLICE", 1)
        monkeypatch.setattr(snapshots, "_SMALL", 0)
    path, keyless = str(tmp_path / "t"), [(None, -1), (None, -1)]
    first = [(f"{i:02d}", i) for i in range(20)]
    snapshots.write_snapshot(spark.createDataFrame([*first, *keyless], KEY), path)
    create_or_upsert(spark.createDataFrame([(k, v * 2) for k, v in first[1:]] + [("new", 1), (None, 5)], KEY), path, "k", source_unique=True)
    now = {k: v * 2 for k, v in first} | {"new": 1}
    assert rows(read_table(spark, path)) == sorted([*now.items(), *keyless, (None, 5)], key=repr)
    create_or_upsert(spark.createDataFrame([("03", 0), ("04", 0)], KEY), path, "k", source_unique=True)
    now |= {"03": 0, "04": 0}
    gone = spark.createDataFrame([("05",), ("06",), ("06",), (None,)], "k string")
    replace_keys(spark.createDataFrame([(9, "06")], "v int, k string"), path, gone, "k")
    now = {k: 9 if k == "06" else v for k, v in now.items() if k != "05"}
    assert rows(read_table(spark, path)) == sorted([*now.items(), *keyless, (None, 5)], key=repr)
    found = changes_in_slices(spark, path, 1, "k")
    assert len(found) == (8 if sliced else 1)
    got = sorted((r.change, r.k or "", r.v) for f in found for r in f.collect())
    before = dict(first)
    kept = [k for k in now if k in before and now[k] != before[k]]
    expected = [("update_before", k, before[k]) for k in kept] + [("update_after", k, now[k]) for k in kept]
    assert got == sorted([*expected, ("insert", "new", 1), ("insert", "", 5), ("delete", "05", 5)])


@pytest.mark.parametrize("repeated", [[], [("07", -7), ("07", None)], [(f"{i:02d}", -i) for i in range(15)], [(None, 1), (None, 0)]])
@pytest.mark.parametrize("small", [True, False])
def test_first_rows_of_keys_by_hashes(spark, tmp_path, monkeypatch, repeated, small):
    if not small:
        monkeypatch.setattr(snapshots, "_SMALL", 0)
    frame = spark.createDataFrame([(f"{i:02d}", i) for i in range(200)] + repeated, KEY)
    for order, finish in (([], None), ([F.col("v").desc_nulls_last()], lambda df: with_audit(df, "2026-12-01 00:00:00"))):
        path = str(tmp_path / f"t{len(order)}")
        expected = dedupe(frame, "k", order)
        expected = expected if finish is None else finish(expected)
        for _ in range(1 if (None, 1) in repeated else 2):  # rows without a key are put in each time
            assert save_first(frame, path, "k", ["k"], order, finish).rows == expected.count()
            assert rows(read_table(spark, path)) == rows(expected)


def test_content_sums_tell_rows_apart(spark):
    kinds = "a string, b string, c timestamp, d double, e decimal(6, 2)"
    base = "select 'x' a, 'y' b, timestamp '2026-12-01 00:00:00' c, 0.0d d, cast(1 as decimal(6, 2)) e"
    others = ["select 'xy', '', c, d, e", "select null, 'y', c, d, e", "select a, b, null, d, e", "select a, b, c + interval 1 microsecond, d, e", "select a, b, c, -0.0d, e", "select a, b, c, d, 1.01"]
    frames = [spark.sql(base)] + [spark.sql(f"with t as ({base}) {o} from t").toDF(*"abcde") for o in others]
    sums = {tuple(f.to(spark.createDataFrame([], kinds).schema).agg(*content_sums(list("abcde"), f)).first()) for f in frames}
    assert len(sums) == len(frames)
