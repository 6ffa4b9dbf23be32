"""Change feeds, and silver and gold that follow them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sedimenta.operators import replace_by_key, table_changes
from sedimenta.plans import GoldSpec, StepSpec, TableSpec, retail, run_bronze, run_gold, run_lake, run_silver
from sedimenta.sources import create_or_upsert, latest_version, read_changes, read_table, write_files, write_snapshot
from sedimenta.sources import files, snapshots
from test_plans import plan

SCHEMA = "k int, v string"


def frame(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def feed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_every_kind_of_change(spark):
    old = frame(spark, (1, "a"), (2, "b"), (3, None), (4, "d"))
    new = frame(spark, (1, "a"), (2, "B"), (3, "c"), (5, "e"))
    assert feed(table_changes(old, new, "k")) == sorted(
        [(2, "b", "update_before"), (2, "B", "update_after"), (3, None, "update_before"),
         (3, "c", "update_after"), (4, "d", "delete"), (5, "e", "insert")], key=repr)


def test_null_keys_are_compared_as_whole_rows_with_their_copies(spark):
    old = frame(spark, (None, "a"), (None, "a"), (None, "b"))
    new = frame(spark, (None, "a"), (None, "c"))
    assert feed(table_changes(old, new, "k")) == sorted(
        [(None, "a", "delete"), (None, "b", "delete"), (None, "c", "insert")], key=repr)


def test_audit_columns_are_handed_on_but_not_compared(spark):
    old = frame(spark, (1, "a", False), (2, "b", False), schema="k int, v string, processed boolean")
    new = frame(spark, (1, "a", True), (2, "c", True), schema="k int, v string, processed boolean")
    assert feed(table_changes(old, new, "k")) == [(2, "b", False, "update_before"), (2, "c", True, "update_after")]


def test_columns_and_types_may_differ_between_versions(spark):
    old = frame(spark, (1, 7, "gone"), (2, 8, None), schema="k int, v int, dropped string")
    new = frame(spark, (1, 7, None), (2, 8, "x"), schema="k int, v bigint, added string")
    assert table_changes(old, new, "k").columns == ["k", "v", "added", "dropped", "change"]
    assert sorted(r[:1] + r[-1:] for r in feed(table_changes(old, new, "k"))) == [
        (1, "update_after"), (1, "update_before"), (2, "update_after"), (2, "update_before")]


def test_odd_column_names_and_empty_versions(spark):
    odd = spark.createDataFrame([(1, 2, 3)], "`a.b` int, `__old` int, `change ` int")  # and names of its own
    assert feed(table_changes(odd.limit(0), odd, ["a.b"])) == [(1, 2, 3, "insert")]
    assert feed(table_changes(odd, odd.limit(0), ["a.b"])) == [(1, 2, 3, "delete")]
    assert feed(table_changes(odd, odd, ["a.b", "__old", "change "])) == []


def test_replaced_keys(spark):
    target = frame(spark, (1, "a"), (1, "b"), (2, "c"))
    got = replace_by_key(target, frame(spark, (1, "z", 9), schema="k int, v string, w int"), frame(spark, (1, ""), (3, "")), "k")
    assert rows(got) == [(1, "z", 9), (2, "c", None)]


def test_feed_between_stored_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in ([(1, "a"), (2, "b"), (3, "c")], [(2, "B"), (3, "c")], [(4, "d")]):
        create_or_upsert(frame(spark, *batch), path, "k", source_unique=True)
    want = [(2, "B", "update_after"), (2, "b", "update_before"), (4, "d", "insert")]
    assert feed(read_changes(spark, path, 1, "k")) == want
    assert feed(read_changes(spark, path, 1, "k", until=2)) == want[:2]
    assert feed(read_changes(spark, path, 3, "k")) == []
    assert "LeftSemi" in plan(read_changes(spark, path, 1, "k"))  # only touched keys are compared
    write_snapshot(frame(spark, (1, "a")), path)  # a version without a batch: all rows are compared
    assert "LeftSemi" not in plan(read_changes(spark, path, 1, "k"))
    assert feed(read_changes(spark, path, 3, "k")) == [(2, "B", "delete"), (3, "c", "delete"), (4, "d", "delete")]
    snapshots.expire_snapshots(spark, path, keep=1)
    assert read_changes(spark, path, 1, "k") is None


TABLE = TableSpec(
    "t",
    bronze=StepSpec(lambda df: df, key=("k",), distinct=True),
    silver=StepSpec(lambda df: df.select("k", F.upper("v").alias("v")), key=("k",), distinct=True, one_to_one=True),
    tracks="changes",
)


def take(spark, store, layout, *data, day=1):
    write_files(frame(spark, *data), layout.path("transient", "t"))
    as_of = f"2026-12-0{day} 00:00:00"
    run_bronze(store, TABLE, layout, as_of)
    return run_silver(store, TABLE, as_of, incremental=True)


def test_silver_reads_changes_and_bronze_is_written_once_a_batch(spark, store, layout):
    assert take(spark, store, layout, (1, "a"), (2, "b")).status == "ok"
    assert take(spark, store, layout, (2, "c"), (3, "d"), day=2).status == "ok"
    assert store.version("bronze", "t") == 2
    assert store.read("bronze", "t").where("processed").count() == 0
    got = store.read("silver", "t").select("k", "v", F.dayofmonth("creationDate"))
    assert rows(got) == [(1, "A", 1), (2, "C", 2), (3, "D", 2)]
    again = take(spark, store, layout, (3, "d"), day=3)  # the same content, taken again
    assert (again.status, again.reason) == ("skipped", "no changes in bronze")
    assert store.version("silver", "t") == 2


def test_rows_that_leave_bronze_leave_silver(spark, store, layout):
    take(spark, store, layout, (1, "a"), (2, "b"))
    store.remove(frame(spark, (1, "")), "bronze", "t", ["k"])
    assert run_silver(store, TABLE, incremental=True).status == "ok"
    assert rows(store.read("silver", "t").select("k")) == [(2,)]


def test_silver_is_made_anew_when_the_version_it_took_is_gone(spark, store, layout):
    take(spark, store, layout, (1, "a"))
    for _ in range(4):
        snapshots.write_snapshot(store.read("bronze", "t"), layout.path("bronze", "t"))
    snapshots.expire_snapshots(spark, layout.path("bronze", "t"), keep=1)
    assert take(spark, store, layout, (2, "b")).status == "ok"
    assert rows(store.read("silver", "t").select("k")) == [(1,), (2,)]


def test_a_job_that_ends_before_its_note_repeats_the_same_changes(spark, store, layout, monkeypatch):
    take(spark, store, layout, (1, "a"))
    with monkeypatch.context() as m:
        m.setattr(type(store), "note_taken", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        assert take(spark, store, layout, (2, "b"), day=2).status == "failed"
    assert run_silver(store, TABLE, incremental=True).status == "ok"
    assert rows(store.read("silver", "t").select("k", "v")) == [(1, "A"), (2, "B")]
    files.write_text(spark, layout.path("silver", "t") + "/_taken.json", '{"bro')
    assert run_silver(store, TABLE, incremental=True).status == "ok"
    assert rows(store.read("silver", "t").select("k", "v")) == [(1, "A"), (2, "B")]


def test_tracks_is_checked():
    with pytest.raises(ValueError, match="tracks"):
        TableSpec("t", TABLE.bronze, TABLE.silver, tracks="magic")


# Gold

DAY = dt.datetime(2024, 5, 6)
SILVER = {
    "vendas": "codigo_filial bigint, id_venda_filial bigint, data_emissao string, codigo_cliente string",
    "itens_vendas": "codigo_filial bigint, id_venda_filial bigint, codigo_item_venda bigint, valor_final_item double,"
    " quantidade_itens bigint, tipo_desconto string",
    "pedido_venda": "codigo_filial bigint, id_venda_filial bigint, id_pedido bigint",
    "pedidos": "id_pedido bigint, canal_venda string",
}


def random_state(rng):
    n = range(8)
    return {
        "vendas": {(1, i): ("d", rng.choice("xyz")) for i in n if rng.random() < 0.7},
        "itens_vendas": {(1, i, j): (float(rng.randint(1, 3)), 1, "t") for i in n for j in range(2) if rng.random() < 0.6},
        "pedido_venda": {(1, i, rng.randint(1, 4)): () for i in n if rng.random() < 0.7},
        "pedidos": {(p,): (rng.choice("LAS"),) for p in range(1, 5) if rng.random() < 0.8},
    }


def bring(spark, store, name, old, new):
    """The stored table from one state to the next, by an upsert and a removal."""
    keys = list(retail.RECORD[name])
    put = [k + v for k, v in new.items() if old.get(k) != v]
    gone = [k + v for k, v in old.items() if k not in new]
    if put:
        store.save(spark.createDataFrame(put, SILVER[name]), "silver", name, keys)
    if gone:
        store.remove(spark.createDataFrame(gone, SILVER[name]), "silver", name, keys)


@pytest.mark.parametrize("seed", [1, 2])
def test_gold_from_changes_equals_gold_built_anew(spark, store, seed):
    rng = random.Random(seed)
    spec = retail.gold_specs(newest=True)[0]
    state = {n: {(9, 9, 9)[: len(retail.RECORD[n])]: None for _ in ()} for n in SILVER}
    for name in SILVER:  # tables exist, if empty
        store.overwrite(spark.createDataFrame([], SILVER[name]), "silver", name)
    for _ in range(4):
        new = random_state(rng)
        for name in rng.sample(sorted(SILVER), 3):
            bring(spark, store, name, state[name], new[name])
            state[name] = new[name]
        run_gold(store, spec, incremental=True)
        silver = {t: store.read("silver", t) for t in spec.tables}
        assert rows(store.read("gold", "vendas")) == rows(spec.build(silver))
    assert run_gold(store, spec, incremental=True).reason == "no changes in silver"


def test_gold_inputs_are_cut_down_by_touched_keys(spark, store):
    for name in SILVER:
        store.overwrite(spark.createDataFrame([], SILVER[name]), "silver", name)
    silver = {t: store.read("silver", t) for t in SILVER}
    coupons = spark.createDataFrame([(1, 1)], "codigo_filial bigint, codigo_cupom_venda bigint")
    text = plan(retail.gold_vendas(retail.narrow_sales(silver, coupons)))
    assert text.count("LeftSemi") >= 4


def test_another_stamp_builds_all_of_gold(spark, store):
    built = []
    store.overwrite(frame(spark, (1, "a"), (2, "b")), "silver", "t")

    def spec(stamp):
        def build(silver):
            built.append(stamp)
            return silver["t"].withColumn("stamp", F.lit(stamp))

        return GoldSpec(
            "g", ("t",), build, ("k",), distinct=True, stamp=stamp, input_keys={"t": ("k",)},
            touched=lambda changes, silver: changes["t"].select("k"),
            narrow=lambda silver, keys: {"t": silver["t"].join(keys, "k", "left_semi")})

    for stamp in ("1", "1", "2"):
        run_gold(store, spec(stamp), incremental=True)
    assert built == ["1", "2"]
    store.save(frame(spark, (2, "c")), "silver", "t", ["k"])
    run_gold(store, spec("2"), incremental=True)
    assert rows(store.read("gold", "g")) == [(1, "a", "2"), (2, "c", "2")]


def test_gold_without_propagation_is_overwritten(spark, store):
    store.overwrite(frame(spark, (1, "a"), (2, "b")), "silver", "t")
    spec = GoldSpec("g", ("t",), lambda silver: silver["t"], ("k",), distinct=True)
    run_gold(store, spec, incremental=True)
    store.remove(frame(spark, (1, "")), "silver", "t", ["k"])
    assert run_gold(store, spec, incremental=True).rows == 1
    assert rows(store.read("gold", "g")) == [(2, "b")]


def test_versions_only_grow(spark, store, layout):
    take(spark, store, layout, (1, "a"))
    assert latest_version(spark, layout.path("bronze", "t")) == 1
    assert read_table(spark, layout.path("silver", "t"), 1).count() == 1
    assert [r.status for r in run_lake(store, layout, [TABLE], [], incremental=True)] == ["ok", "skipped"]
