"""Merged schemas, buckets, history, quarantine, hot keys, replays and runs by dependencies."""

import datetime as dt
import random
import re
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import rows
from sedimenta.operators import cast_fails, hot_keys, join_hot_keys, merge_frames, merge_history, split_rejected, valid_at
from sedimenta.operators.evolve import merged_type
from sedimenta.plans import GoldSpec, SnapshotStore, StepSpec, TableSpec, run_bronze, run_lake, run_sql
from sedimenta.sources import LandingFormat, latest_version, read_table, snapshots, write_files
from sedimenta.sources.bucketed import bucketed_versions, create_bucketed, expire_bucketed, merge_bucketed
from sedimenta.streaming import save_batch
from test_plans import plan


def kind(text):
    return StructType.fromDDL(f"x {text}").fields[0].dataType


# Schemas


@pytest.mark.parametrize("held, added, want", [
    ("int", "bigint", "bigint"), ("bigint", "tinyint", "bigint"), ("float", "double", "double"),
    ("int", "double", "double"), ("decimal(10,2)", "int", "decimal(12,2)"), ("decimal(10,2)", "decimal(6,4)", "decimal(12,4)"),
    ("decimal(38,2)", "decimal(38,10)", "decimal(38,2)"), ("decimal(10,2)", "double", "double"), ("date", "timestamp", "timestamp"),
    ("string", "int", "string"), ("int", "string", "int"), ("boolean", "int", "boolean"),
    ("struct<a: int>", "struct<b: string, A: bigint>", "struct<a: bigint, b: string>"),
    ("array<struct<a: int>>", "array<struct<b: int>>", "array<struct<a: int, b: int>>"),
    ("map<int, struct<a: int>>", "map<bigint, struct<b: date>>", "map<bigint, struct<a: int, b: date>>"),
    ("struct<a: int>", "int", "struct<a: int>"),
])
def test_merged_types(held, added, want):
    assert merged_type(kind(held), kind(added)).simpleString() == kind(want).simpleString()


def test_without_widening_only_fields_are_added():
    got = merged_type(kind("struct<a: int>"), kind("struct<a: bigint, b: bigint>"), widen=False)
    assert got.simpleString() == "struct<a:int,b:bigint>"


@pytest.mark.parametrize("form", ["probe", "outer"])
def test_nested_merge(spark, form):
    target = spark.createDataFrame(
        [(1, (1, ("a", 5)), [(1,)], {"k": (1,)}), (2, None, None, None), (3, (3, None), [], {})],
        "k int, s struct<n: int, t: struct<x: string, old: int>>, l array<struct<a: int>>, m map<string, struct<a: int>>")
    source = spark.createDataFrame(
        [(1, (1 << 40, ("b",), "new"), [(2, "z"), None], {"q": (7, "y")}), (3, None, None, None), (4, (4, None, "n"), [(9, None)], None)],
        "k int, s struct<n: bigint, t: struct<x: string>, extra: string>, l array<struct<a: bigint, b: string>>,"
        " m map<string, struct<a: int, b: string>>")
    got = merge_frames(target, source, "k", source_unique=True, form=form)
    assert got.schema["s"].dataType.simpleString() == "struct<n:bigint,t:struct<x:string,old:int>,extra:string>"
    table = {r.k: r for r in got.collect()}
    assert table[1].s == (1 << 40, ("b", 5), "new")  # `old` is not in the new struct: it stays
    assert table[1].l == [(2, "z"), None] and table[1].m == {"q": (7, "y")}
    assert table[2].s is None and table[2].l is None
    assert table[3].s is None and table[3].l is None  # the new row says NULL
    assert table[4].s == (4, None, "n") and table[4].l == [(9, None)]


def test_wider_values_are_kept_and_inserts_alone_widen_too(spark):
    target = spark.createDataFrame([(1, 7, Decimal("1.50"))], "k int, v int, d decimal(4,2)")
    source = spark.createDataFrame([(2, 1 << 40, Decimal("0.0625"))], "k int, v bigint, d decimal(6,4)")
    got = merge_frames(target, source, "k", update="none")
    assert rows(got) == [(1, 7, Decimal("1.5000")), (2, 1 << 40, Decimal("0.0625"))]
    with pytest.raises(Exception, match="OVERFLOW"):
        merge_frames(target, source, "k", widen=False).collect()


def test_stored_tables_take_wider_and_nested_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.create_or_upsert(spark.createDataFrame([(1, (1,))], "k int, s struct<a: int>"), path, "k", source_unique=True)
    late = spark.createDataFrame([(2, (1 << 40, "b"))], "k int, s struct<a: bigint, b: string>")
    snapshots.create_or_upsert(late, path, "k", source_unique=True)
    assert rows(read_table(spark, path)) == [(1, (1, None)), (2, (1 << 40, "b"))]


# Buckets


@pytest.fixture
def bucketed(spark):
    name = f"t_{random.getrandbits(60):x}"
    yield name
    for version in bucketed_versions(spark, name):
        spark.sql(f"drop table {name}__v{version:06d}")
    spark.sql(f"drop view if exists {name}")


def test_only_the_batch_is_shuffled(spark, bucketed):
    create_bucketed(spark.range(5000).selectExpr("id as k", "id * 2 as v"), bucketed, "k", 16)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_frames(
            spark.table(bucketed), spark.range(4990, 5010).selectExpr("id as k", "0 as v"), "k", source_unique=True, form="outer")
        text = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = text[text.index("SortMergeJoin"):]
    assert "Bucketed: true" in join and "SelectedBucketsCount: 16 out of 16" in join
    assert len(re.findall(r"Exchange hashpartitioning\(k#\d+L?, 16\)", join)) == 1
    assert "Exchange" not in join[: join.index("FileScan")]  # the table's side comes first


def test_bucketed_merge(spark, bucketed):
    def batch(*data):
        return spark.createDataFrame(list(data), "k int, j string, v int")

    merge_bucketed(batch((1, "a", 1), (2, "b", 2), (None, "n", 0)), bucketed, ["k", "j"], 4)
    merge_bucketed(batch((2, "b", 20), (3, "c", 3), (None, "n", 1)), bucketed, ["k", "j"], 4, delete_when="source.v > 99")
    assert rows(spark.table(bucketed)) == sorted(
        [(1, "a", 1), (2, "b", 20), (3, "c", 3), (None, "n", 0), (None, "n", 1)], key=repr)
    merge_bucketed(batch((1, "a", 100)), bucketed, ["k", "j"], 4, delete_when="source.v > 99", source_unique=True)
    assert rows(spark.table(bucketed).where("k = 1")) == []
    with pytest.raises(Exception, match="share one key"):
        merge_bucketed(batch((7, "a", 1), (7, "a", 2)), bucketed, ["k", "j"], 4)
    assert spark.table(bucketed).count() == 4
    assert bucketed_versions(spark, bucketed)[:3] == [1, 2, 3]
    expire_bucketed(spark, bucketed, keep=2)
    assert spark.table(bucketed).count() == 4


# History


def brute_history(batches):
    states = {}
    for batch in batches:
        for key, value, at in batch:
            states.setdefault(key, {})[at] = value
    out = []
    for key, seen in states.items():
        opened = []
        for at in sorted(seen):
            if not opened or opened[-1][0] != seen[at]:
                opened.append((seen[at], at))
        for i, (value, at) in enumerate(opened):
            until = opened[i + 1][1] if i + 1 < len(opened) else None
            out.append((key, value, at, until, until is None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_history_with_late_states(spark, seed):
    rng = random.Random(seed)
    history, batches = None, []
    for _ in range(4):
        taken = {}
        for _ in range(rng.randint(1, 12)):
            taken[rng.choice([None, "a", "b", "c"]), dt.datetime(2026, 1, rng.randint(1, 9))] = rng.choice(["x", "y", None])
        batches.append([(k, v, at) for (k, at), v in taken.items()])
        batch = spark.createDataFrame(batches[-1], "k string, v string, at timestamp")
        history = _stored(spark, merge_history(history, batch, "k", "at"))
        assert rows(history.drop("confirmed")) == brute_history(batches)
    moment = dt.datetime(2026, 1, 5, 12)
    want = [r[:2] for r in brute_history(batches) if r[2] <= moment and (r[3] is None or moment < r[3])]
    assert rows(valid_at(history, "2026-01-05 12:00:00").select("k", "v")) == sorted(want, key=repr)


def _stored(spark, frame):
    return spark.createDataFrame(frame.collect(), frame.schema)


def test_history_takes_new_columns_and_refuses_states_without_a_time(spark):
    first = merge_history(None, spark.createDataFrame([("a", 1, dt.datetime(2026, 1, 1))], "k string, v int, at timestamp"), "k", "at")
    late = spark.createDataFrame([("a", 1, "w", dt.datetime(2026, 1, 2))], "k string, v int, w string, at timestamp")
    got = merge_history(_stored(spark, first), late, "k", "at").select("v", "w", "is_current")
    assert rows(got) == [(1, "w", True), (1, None, False)]
    with pytest.raises(Exception, match="has no at"):
        merge_history(None, late.withColumn("at", F.lit(None).cast("timestamp")), "k", "at").collect()


# Quarantine


def test_split_rejected(spark):
    df = spark.createDataFrame([(1, "5"), (2, "x"), (2, "x"), (3, None), (None, "7")], "k int, v string")
    checks = {"number": cast_fails("v", F.col("v").try_cast("int")), "no key": "k is null", "unknown": "null"}
    good, bad = split_rejected(df, checks)
    assert rows(good) == sorted([(1, "5"), (3, None)], key=repr)
    assert rows(bad.select("reasons", "record")) == [(["no key"], '{"v":"7"}'), (["number"], '{"k":2,"v":"x"}')]


def test_json_records_that_do_not_fit(spark, store, layout, tmp_path):
    path = layout.path("transient", "t")
    spark.createDataFrame([('{"k": 1, "v": "a"}',), ('{"k": "one"}',), ("{nothing",)], "value string").write.text(path)
    form = LandingFormat(format_in="json", multiline="false", schema="k int, v string", corrupt="_bad")
    step = StepSpec(lambda df: df, key=("k",))
    for _ in range(2):  # taken again, they are no other records
        got = run_bronze(store, TableSpec("t", step, step, landing=form), layout, "2026-12-01 00:00:00")
        assert (got.status, got.rows, got.rejected) == ("ok", 1, 2)
    assert store.read("bronze", "t").columns == ["k", "v", "processed", "creationDate"]
    bad = store.read("bronze", "t_rejected").select("reasons", "record")
    assert rows(bad) == [(["unreadable"], '{"k": "one"}'), (["unreadable"], "{nothing")]


def test_a_corrupt_column_needs_a_schema():
    with pytest.raises(ValueError, match="schema"):
        LandingFormat(format_in="csv", corrupt="_bad")


def test_only_bad_rows(spark, store, layout):
    write_files(spark.createDataFrame([(1,)], "k int"), layout.path("transient", "t"))
    step = StepSpec(lambda df: df, key=("k",))
    got = run_bronze(store, TableSpec("t", step, step, checks={"all": "true"}), layout)
    assert (got.status, got.reason, got.rejected) == ("skipped", "no good landing rows", 1)


# Hot keys


def test_hot_keys_are_found_and_spread_alone(spark):
    many = spark.range(20000).selectExpr("if(id % 3 = 0, 1, id) as k", "'x' as j", "id as v")
    one = spark.range(20000).selectExpr("id as k", "'x' as j", "id * 10 as w")
    hot = hot_keys(many, ["k", "j"], 0.05)
    assert hot == [spark.sql("select xxhash64(1L, 'x')").first()[0]]
    got = join_hot_keys(many, one, ["k", "j"], share=0.05, salts=4)
    assert rows(got) == rows(many.join(one, ["k", "j"]))
    assert "Generate explode" in plan(got)
    repeated = one.where("k = 1").count() * 4 + one.where("k <> 1").count()
    salted = [n for n in re.findall(r"__salt", plan(got))]
    assert salted and repeated == 20003
    even = join_hot_keys(one, one.select("k", F.col("w").alias("w2")), "k", share=0.05)
    assert "__salt" not in plan(even)


def test_hot_null_keys_match_nothing(spark):
    many = spark.range(300).selectExpr("if(id % 2 = 0, null, id) as k", "id as v")
    one = spark.createDataFrame([(1, "a"), (None, "n")], "k bigint, w string")
    assert rows(join_hot_keys(many, one, "k", share=0.1, salts=3)) == [(1, 1, "a")]
    assert hot_keys(many.limit(0), "k", 0.1) == []


# Replays


STEP = StepSpec(lambda df: df, key=("k",))
STREAM = TableSpec("t", STEP, STEP)


def test_a_replayed_batch_changes_nothing(spark, store, layout):
    path = layout.path("bronze", "t")
    batch = lambda *data: spark.createDataFrame(list(data), "k int, v string")
    assert save_batch(store, STREAM, batch((1, "a")), "q", 0)
    assert save_batch(store, STREAM, batch((2, "b")), "q", 1)
    assert latest_version(spark, path) == 2
    for n in (1, 0):
        assert not save_batch(store, STREAM, batch((2, "other")), "q", n)
    assert latest_version(spark, path) == 2
    assert save_batch(store, STREAM, batch((2, "c")), "another", 0)  # numbers of another stream
    assert rows(store.read("bronze", "t").select("k", "v")) == [(1, "a"), (2, "c")]


def test_a_batch_that_was_announced_but_not_written_is_taken(spark, store, layout, monkeypatch):
    path = layout.path("bronze", "t")
    batch = lambda *data: spark.createDataFrame(list(data), "k int, v string")
    save_batch(store, STREAM, batch((1, "a")), "q", 0)
    with monkeypatch.context() as m:
        m.setattr(snapshots, "write_snapshot", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            save_batch(store, STREAM, batch((2, "b")), "q", 1)
    # Another write in between takes a number of its own, so it cannot pass for the batch.
    store.set_where("bronze", "t", F.lit(True), {"processed": "true"})
    assert latest_version(spark, path) == 3
    assert save_batch(store, STREAM, batch((2, "b")), "q", 1)
    assert rows(store.read("bronze", "t").select("k", "processed")) == [(1, True), (2, False)]
    assert not save_batch(store, STREAM, batch((2, "b")), "q", 1)


# Parameters


def test_values_never_become_text(spark):
    df = spark.createDataFrame([("it's",), ("x' or '1'='1",), ("y",)], "v string")
    for value in ("it's", "x' or '1'='1", ":v", "nothing"):
        got = run_sql(spark, "select v from text where v = :v", {"text": df}, {"v": value})
        assert rows(got) == [(v,) for (v,) in rows(df) if v == value]
    with pytest.raises(Exception, match="UNBOUND"):
        run_sql(spark, "select * from text where v = :v", {"text": df}).collect()
    assert run_sql(spark, "select :n + 1 as n", args={"n": 1}).first().n == 2


# Runs


def test_gold_starts_before_an_unrelated_slow_table_ends(spark, store, layout):
    built = threading.Event()
    for name in ("quick", "slow"):
        write_files(spark.createDataFrame([(1,)], "k int"), layout.path("transient", name))

    def slow(df):
        assert built.wait(120)  # it ends only after the gold table over `quick`
        return df

    def build(silver):
        built.set()
        return silver["quick"].select("k")

    tables = [TableSpec("slow", StepSpec(slow, key=("k",)), STEP), TableSpec("quick", STEP, StepSpec(lambda df: df.select("k"), key=("k",)))]
    tables[0] = TableSpec("slow", tables[0].bronze, tables[1].silver)
    golds = [GoldSpec("g", ("quick",), build, ("k",), distinct=True)]
    results = run_lake(store, layout, tables, golds, threads=2)
    assert [(r.table, r.layer, r.status) for r in results] == [
        ("slow", "bronze", "ok"), ("slow", "silver", "ok"), ("quick", "bronze", "ok"), ("quick", "silver", "ok"), ("g", "gold", "ok")]


def test_failures_are_passed_on_and_circles_refused(spark, store, layout):
    write_files(spark.createDataFrame([(1,)], "k int"), layout.path("transient", "bad"))
    table = TableSpec("bad", StepSpec(lambda df: df.select("nope"), key=("k",)), STEP)
    gold = lambda name, *after: GoldSpec(name, ("bad",) if not after else (), lambda s: None, ("k",), after=after)
    results = run_lake(store, layout, [table], [gold("second", "first"), gold("first")])
    assert [(r.table, r.status) for r in results if r.layer == "gold"] == [("second", "skipped"), ("first", "skipped")]
    with pytest.raises(ValueError, match="wait for one another"):
        run_lake(store, layout, [table], [gold("a", "b"), gold("b", "a")])
    assert isinstance(store, SnapshotStore)
