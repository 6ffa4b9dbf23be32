"""Layer steps and whole runs on small lakes."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sedimenta.operators import latest_per_key
from sedimenta.plans import (
    GoldSpec,
    StepSpec,
    TableSpec,
    apply_step,
    report_frame,
    retail,
    run_bronze,
    run_gold,
    run_lake,
    run_silver,
    run_sql,
)
from sedimenta.sources import write_files

AS_OF = "2026-12-01 00:00:00"
SALES_SCHEMA = (
    "d_dt_vd timestamp_ntz, n_id_fil bigint, n_id_vd_fil bigint, v_cli_cod string,"
    " n_vlr_tot_vd double, n_vlr_tot_desc double, v_cpn_eml string, tp_pgt string"
)
DAY = dt.datetime(2024, 5, 6, 7, 8, 9)


def sale(branch, number, total=10.0, client="C1"):
    return (DAY, branch, number, client, total, 0.0, "SIM", None)


def land(spark, layout, name, schema, *data, mode="overwrite"):
    write_files(spark.createDataFrame(list(data), schema), layout.path("transient", name), mode=mode)


def spec(name, key_mode="strict"):
    return next(s for s in retail.table_specs(key_mode) if s.name == name)


def load(store, layout, table, **silver):
    return run_bronze(store, table, layout, AS_OF), run_silver(store, table, AS_OF, **silver)


def test_taking_the_same_rows_again_changes_nothing(spark, store, layout):
    land(spark, layout, "vendas", SALES_SCHEMA, sale(1, 1), sale(1, 2), sale(1, 2), sale(2, 3, client=None))
    for _ in range(2):
        bronze, silver = load(store, layout, spec("vendas"))
        assert (bronze.status, bronze.rows) == ("ok", 3)
        assert (silver.status, silver.rows) == ("ok", 3)
    assert store.read("bronze", "vendas").where("processed").count() == 3


def test_incremental_silver_takes_new_rows_only_and_ends_up_the_same(spark, store, layout):
    table = spec("vendas")
    land(spark, layout, "vendas", SALES_SCHEMA, sale(1, 1))
    load(store, layout, table, incremental=True)
    land(spark, layout, "vendas", SALES_SCHEMA, sale(1, 2))
    run_bronze(store, table, layout, "2026-12-02 00:00:00")
    run_silver(store, table, "2026-12-02 00:00:00", incremental=True)
    got = store.read("silver", "vendas").select("id_venda_filial", F.to_date("creationDate"))
    assert rows(got) == [(1, dt.date(2026, 12, 1)), (2, dt.date(2026, 12, 2))]
    assert store.read("bronze", "vendas").where("not processed").count() == 0
    assert run_silver(store, table, AS_OF, incremental=True).status == "skipped"


def test_compat_keys_collapse_null_rows_and_grow_on_each_run(spark, store, layout):
    land(spark, layout, "vendas", SALES_SCHEMA, sale(1, 1), sale(1, 2))  # tp_pgt is NULL
    table = spec("vendas", "compat")
    assert [load(store, layout, table)[0].rows for _ in range(2)] == [1, 2]
    assert store.read("bronze", "vendas").where("processed").count() == 0


def test_compat_keys_mark_bronze_by_key(spark, store, layout):
    land(spark, layout, "pedido_venda", "n_id_fil bigint, n_id_vd_fil bigint, n_id_pdd bigint",
         (1, 23, 5), (12, 3, 5), (7, 7, None))
    bronze, silver = load(store, layout, spec("pedido_venda", "compat"))
    assert bronze.rows == 2 and silver.rows == 2
    marked = store.read("bronze", "pedido_venda").select("n_id_pdd", "processed")
    assert rows(marked) == sorted([(5, True), (None, False)], key=repr)


def test_changed_rows_are_new_versions_unless_merged_on_the_business_key(spark, store, layout):
    land(spark, layout, "vendas", SALES_SCHEMA, sale(1, 1, 10.0))
    load(store, layout, spec("vendas"))
    land(spark, layout, "vendas", SALES_SCHEMA, sale(1, 1, 99.0))
    run_bronze(store, spec("vendas"), layout, "2026-12-02 00:00:00")
    both = store.read("bronze", "vendas")
    assert both.count() == 2
    newest = latest_per_key(both, ["n_id_fil", "n_id_vd_fil"])
    assert rows(newest.select("n_vlr_tot_vd")) == [(99.0,)]


def test_merge_key_keeps_the_newest_version(spark, store, layout):
    base = spec("vendas")
    table = TableSpec(
        "vendas",
        bronze=StepSpec(base.bronze.transform, merge_key=("n_id_fil", "n_id_vd_fil")),
        silver=StepSpec(base.silver.transform, merge_key=("codigo_filial", "id_venda_filial")),
    )
    for total in (10.0, 99.0):
        land(spark, layout, "vendas", SALES_SCHEMA, sale(1, 1, total))
        bronze, silver = load(store, layout, table)
        assert (bronze.rows, silver.rows) == (1, 1)
    assert rows(store.read("silver", "vendas").select(F.col("valor_total_venda").cast("int"))) == [(99,)]
    assert rows(store.read("bronze", "vendas").select("processed")) == [(True,)]


def test_new_landing_columns_reach_the_table(spark, store, layout):
    table = TableSpec(
        "t", bronze=StepSpec(lambda df: df, key=("k",)), silver=StepSpec(lambda df: df, key=("k",)))
    land(spark, layout, "t", "k int, a string", (1, "x"))
    load(store, layout, table)
    land(spark, layout, "t", "k int, b string", (2, "y"))
    load(store, layout, table)
    got = store.read("silver", "t").select("k", "a", "b")
    assert rows(got) == [(1, "x", None), (2, None, "y")]


def test_missing_inputs_are_skipped(spark, store, layout):
    bronze, silver = load(store, layout, spec("vendas"))
    assert (bronze.status, silver.status) == ("skipped", "skipped")
    assert run_gold(store, retail.gold_specs()[0]).status == "skipped"


def test_empty_landing_makes_no_table(spark, store, layout):
    land(spark, layout, "vendas", SALES_SCHEMA)
    bronze, silver = load(store, layout, spec("vendas"))
    assert (bronze.status, silver.status) == ("skipped", "skipped")
    assert not store.exists("bronze", "vendas")


def test_a_failing_table_does_not_stop_the_run(spark, store, layout):
    pairs = "n_id_fil bigint, n_id_vd_fil bigint, n_id_pdd bigint"
    land(spark, layout, "vendas", "unexpected int", (1,))
    land(spark, layout, "pedido_venda", pairs, (1, 1, 1))
    results = run_lake(
        store, layout, [spec("vendas"), spec("pedido_venda"), spec("pedidos")],
        retail.gold_specs(), as_of=AS_OF, threads=3)
    got = {(r.table, r.layer): r.status for r in results}
    assert got[("vendas", "bronze")] == "failed"
    assert got[("pedido_venda", "silver")] == "ok"
    assert got[("pedidos", "bronze")] == "skipped"
    assert got[("vendas", "gold")] == "skipped"
    report = report_frame(spark, results)
    assert report.count() == len(results) == 8
    assert "d_dt_vd" in report.where("status = 'failed'").first()["reason"]


def test_archived_landing_files_are_not_taken_again(spark, store, layout):
    land(spark, layout, "vendas", SALES_SCHEMA, sale(1, 1))
    assert run_bronze(store, spec("vendas"), layout, AS_OF, archive=True).status == "ok"
    assert run_bronze(store, spec("vendas"), layout, AS_OF, archive=True).status == "skipped"
    assert spark.read.parquet(layout.archive("vendas")).count() == 1


def test_old_versions_are_expired(spark, store, layout):
    for n in range(4):
        land(spark, layout, "vendas", SALES_SCHEMA, sale(1, n))
        load(store, layout, spec("vendas"))
    versions = [d for d in os.listdir(layout.path("bronze", "vendas")) if d.startswith("v0")]
    assert len(versions) == 3 and store.read("bronze", "vendas").count() == 4


def test_steps_and_gold_as_sql_text(spark, store, layout):
    table = TableSpec(
        "t",
        bronze=StepSpec("select k, v from t_tmp", key=("k",), order_by=("v",), view="t_tmp"),
        silver=StepSpec("select k, v * 2 as w from t_tmp where v > 0", key=("k",), view="t_tmp"),
    )
    land(spark, layout, "t", "k int, v int", (1, 5), (1, 4), (2, 0))
    bronze, silver = load(store, layout, table)
    assert (bronze.rows, silver.rows) == (2, 1)
    marked = store.read("bronze", "t").select("k", "v", "processed")
    assert rows(marked) == [(1, 4, True), (2, 0, False)]
    gold = GoldSpec("g", ["t"], "select k, sum(w) as w from t group by k", ["k"])
    assert run_gold(store, gold).rows == 1
    assert rows(store.read("gold", "g")) == [(1, 8)]
    bad = GoldSpec("bad", ["t"], "select nope from t", ["k"])
    assert run_gold(store, bad).status == "failed"
    none = GoldSpec("none", ["t"], "select * from t where k > 9", ["k"])
    assert run_gold(store, none).status == "skipped"
    assert not spark.catalog.tableExists("t") and not spark.catalog.tableExists("t_tmp")


def test_sql_step_needs_a_view_name(spark):
    with pytest.raises(ValueError):
        apply_step(spark.range(1), StepSpec("select 1 as hash_id"))


def test_views_are_dropped_when_the_text_fails(spark):
    with pytest.raises(Exception):
        run_sql(spark, "select nope from v", {"v": spark.range(1)})
    assert not spark.catalog.tableExists("v")


def test_gold_write_back_marks_silver(spark, store, layout):
    table = TableSpec("t", bronze=StepSpec(lambda d: d, key=("k",)),
                      silver=StepSpec(lambda d: d.drop("processed", "creationDate"), key=("k",)))
    land(spark, layout, "t", "k int", (1,), (2,))
    load(store, layout, table)
    gold = GoldSpec("g", ["t"], lambda s: s["t"].where("k = 1").select(F.col("k").alias("id")),
                    ["id"], write_back={"t": [("k", "id")]})
    assert run_gold(store, gold).status == "ok"
    assert rows(store.read("silver", "t").select("k", "processed")) == [(1, True), (2, False)]


def test_coupon_grain_equals_first_row_of_item_grain(spark):
    """Cutting both sides before the join is the same as cutting after it."""
    from sedimenta.operators import dedupe

    def frame(schema, data):
        return spark.createDataFrame(data, schema)

    silver = {
        "vendas": frame("codigo_filial int, id_venda_filial int, data_emissao string, codigo_cliente string",
                        [(1, 1, "b", "x"), (1, 1, "a", "y"), (1, 2, "a", None), (2, 1, "c", "z")]),
        "pedido_venda": frame("codigo_filial int, id_venda_filial int, id_pedido int",
                              [(1, 1, 5), (1, 1, 6), (1, 2, 7), (2, 1, 9)]),
        "pedidos": frame("id_pedido int, canal_venda string",
                         [(5, "Site"), (6, None), (7, "App"), (7, "Loja")]),
        "itens_vendas": frame(
            "codigo_filial int, id_venda_filial int, codigo_item_venda int, valor_final_item int,"
            " quantidade_itens int, tipo_desconto string",
            [(1, 1, 3, 1, 1, "p"), (1, 1, 2, 9, 1, "p"), (1, 1, 2, 8, None, "q"), (1, 2, 1, 1, 1, "p"),
             (3, 3, 1, 1, 1, "p")]),
    }
    after = dedupe(
        retail.gold_vendas_items(silver), retail.COUPON,
        ["codigo_item", "valor_unitario", "quantidade", "tipo_desconto"])
    assert rows(retail.gold_vendas(silver)) == rows(after)
    assert after.count() == 2


def test_one_view_name_in_many_threads(spark):
    from concurrent.futures import ThreadPoolExecutor

    spark.range(1).createOrReplaceTempView("table_tmp")
    frames = {i: spark.createDataFrame([(i,)], "n int") for i in range(8)}

    def run(i):
        return [run_sql(spark, "-- a note\nselect n from table_tmp;", {"table_tmp": frames[i]}).first()[0] for _ in range(5)]

    with ThreadPoolExecutor(8) as pool:
        assert list(pool.map(run, frames)) == [[i] * 5 for i in frames]
    assert spark.table("table_tmp").columns == ["id"]
    spark.catalog.dropTempView("table_tmp")


def test_merge_key_keeps_the_newest_version(spark):
    step = StepSpec(lambda df: df.select("k", "v", "creationDate"), merge_key=["k"])
    rows = [(1, 1, "2020-01-01"), (1, 5, "2020-01-03"), (1, 3, "2020-01-02")]
    frame = spark.createDataFrame(rows, "k int, v int, d string").selectExpr("k", "v", "timestamp(d) as creationDate")
    assert [r.v for r in apply_step(frame, step).collect()] == [5]


def test_a_row_that_lands_while_silver_is_made_stays_unmarked(spark, store, layout):
    from dataclasses import dataclass

    from sedimenta.plans import SnapshotStore, StepSpec, TableSpec, run_bronze, run_silver
    from sedimenta.sources import write_files

    step = StepSpec(lambda f: f, key=("k",), distinct=True, one_to_one=True)
    table = TableSpec("t", bronze=step, silver=step)

    def land(*data):
        write_files(spark.createDataFrame(list(data), "k string"), layout.path("transient", "t"))

    @dataclass(frozen=True)
    class Busy(SnapshotStore):
        def save(self, source, layer, *args, **kwargs):
            saved = super().save(source, layer, *args, **kwargs)
            if layer == "silver":
                land(("late",))
                assert run_bronze(store, table, layout, "2026-12-02 00:00:00").status == "ok"
            return saved

    land(("a",), ("b",))
    run_bronze(store, table, layout, "2026-12-01 00:00:00")
    assert run_silver(Busy(spark, layout), table, incremental=True).status == "ok"
    assert rows(store.read("bronze", "t").select("k", "processed")) == [
        ("a", True), ("b", True), ("late", False)]
    assert run_silver(store, table, incremental=True).status == "ok"
    assert [r[0] for r in rows(store.read("silver", "t").select("k"))] == ["a", "b", "late"]


def test_a_wrong_claim_of_distinct_rows_fails(spark, store, layout):
    from sedimenta.plans import StepSpec, TableSpec, run_bronze
    from sedimenta.sources import write_files

    write_files(spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int"), layout.path("transient", "t"))
    step = StepSpec(lambda f: f, key=("k",), distinct=True)
    got = run_bronze(store, TableSpec("t", bronze=step, silver=step), layout)
    assert got.status == "failed" and not store.exists("bronze", "t")


def test_sql_steps_of_one_view_name_do_not_mix_in_threads(spark, store, layout):
    from sedimenta.plans import StepSpec, TableSpec, run_lake
    from sedimenta.sources import write_files

    step = StepSpec("select * from table_tmp", key=("k",), view="table_tmp")
    tables = [TableSpec(f"t{i}", bronze=step, silver=step) for i in range(8)]
    for i in range(8):
        write_files(spark.createDataFrame([(f"row {i}",)], "k string"), layout.path("transient", f"t{i}"))
    spark.createDataFrame([("mine",)], "k string").createOrReplaceTempView("table_tmp")
    run_lake(store, layout, tables, [], threads=8)
    for i in range(8):
        assert rows(store.read("bronze", f"t{i}").select("k")) == [(f"row {i}",)]
    assert spark.table("table_tmp").first()[0] == "mine"
    spark.catalog.dropTempView("table_tmp")


def test_gold_is_skipped_where_a_table_failed(spark, store, layout):
    from sedimenta.plans import GoldSpec, StepSpec, TableSpec, run_lake
    from sedimenta.sources import write_files

    write_files(spark.createDataFrame([("a",)], "k string"), layout.path("transient", "t"))
    good, bad = StepSpec(lambda f: f, key=("k",)), StepSpec("select nope from t_tmp", view="t_tmp")
    gold = GoldSpec("g", ("t",), lambda s: s["t"].select("k"), ("k",))
    run_lake(store, layout, [TableSpec("t", bronze=good, silver=StepSpec(lambda f: f.drop("processed", "creationDate"), key=("k",)))], [gold])
    got = run_lake(store, layout, [TableSpec("t", bronze=good, silver=bad)], [gold])
    assert [r.status for r in got] == ["ok", "failed", "skipped"]
