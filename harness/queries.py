"""One query per operator, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness.adapters import landing, table
from harness.scratch import new_folder, new_lake, write_json_documents
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
from sedimenta.operators import (
    dedupe,
    join_on_columns,
    join_on_concat,
    join_skewed,
    latest_per_key,
    merge_frames,
    normalize_temporal,
    null_to_nan,
    only_unprocessed,
    with_audit,
)
from sedimenta.plans import (
    PartitionedStore,
    SnapshotStore,
    apply_step,
    report_frame,
    run_bronze,
    run_gold,
    run_lake,
    run_silver,
    run_sql,
)
from sedimenta.plans import retail
from sedimenta.plans.spec import LakeLayout, StepSpec
from sedimenta.sources import (
    LandingFormat,
    compact_table,
    create_or_upsert,
    preview,
    read_landing,
    read_table,
    set_matched,
    upsert,
    write_files,
    write_snapshot,
)
from sedimenta.sources.snapshots import set_matched_many
from sedimenta.streaming import ingest_landing_stream

AS_OF = "2026-12-01 00:00:00"
AS_OF_DAY = "2026-12-01"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


# Sources and sinks


@query
def read_parquet(spark, sf_dir):
    return read_landing(spark, f"{sf_dir}/lineitem.parquet")


@query
def read_json_multiline(spark, sf_dir):
    path = new_folder(spark, "json")
    write_json_documents(landing(spark, sf_dir, "clientes_opt"), path)
    return read_landing(spark, path, LandingFormat(format_in="json"))


@query
def read_csv_infer(spark, sf_dir):
    path = new_folder(spark, "csv")
    write_files(table(spark, sf_dir, "orders"), path, format_out="csv")
    return read_landing(spark, path, LandingFormat(format_in="csv"))


@query
def read_table_latest(spark, sf_dir):
    path = new_folder(spark, "latest")
    orders = table(spark, sf_dir, "orders")
    write_snapshot(orders.where("o_orderstatus = 'P'"), path)
    write_snapshot(orders, path)
    return read_table(spark, path)


@query
def write_overwrite(spark, sf_dir):
    path = new_folder(spark, "overwrite")
    orders = table(spark, sf_dir, "orders")
    write_files(orders.where("o_orderstatus = 'P'"), path)
    write_files(orders, path, mode="overwrite", partition_by=["o_orderstatus"])
    return read_landing(spark, path)


@query
def write_append(spark, sf_dir):
    path = new_folder(spark, "append")
    orders = table(spark, sf_dir, "orders")
    write_files(orders.where("o_orderstatus = 'F'"), path)
    write_files(orders.where("o_orderstatus <> 'F'"), path, mode="append")
    return read_landing(spark, path)


@query
def compact_table_query(spark, sf_dir):
    path = new_folder(spark, "compact")
    write_snapshot(table(spark, sf_dir, "lineitem").repartition(32), path)
    compact_table(spark, path)
    return read_table(spark, path)


@query
def preview_all_string(spark, sf_dir):
    return preview(table(spark, sf_dir, "orders"), n=None)


@query
def preview_limit(spark, sf_dir):
    return preview(table(spark, sf_dir, "orders").orderBy("o_orderkey"), n=5)


# Columns


@query
def cast_bigint_text(spark, sf_dir):
    """Numbers in text: whole ones, with a fraction, with an exponent, and no numbers."""
    part = F.col("l_partkey").cast("string")
    turn = F.col("l_orderkey") % 5
    written = (
        F.when(turn == 0, part)
        .when(turn == 1, F.concat(part, F.lit(".0")))
        .when(turn == 2, F.concat(F.lit("-"), part, F.lit(".9")))
        .when(turn == 3, F.concat(part, F.lit("e3")))
        .otherwise(F.concat(part, F.lit("x")))
    )
    lines = table(spark, sf_dir, "lineitem").withColumn("written", written)
    return lines.select("l_orderkey", "l_linenumber", "written", to_bigint("written").alias("whole"))


@query
def timestamp_text_or_blank(spark, sf_dir):
    """Times in text: with a time, as a date only, empty, and no times."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    turn = F.col("o_orderkey") % 4
    written = (
        F.when(turn == 0, F.concat(day, F.lit(" 10:20:30")))
        .when(turn == 1, day)
        .when(turn == 2, F.lit(""))
        .otherwise(F.concat(F.lit("x"), day))
    )
    orders = table(spark, sf_dir, "orders").withColumn("written", written)
    return orders.select("o_orderkey", "written", timestamp_or_blank("written").alias("moment"))


@query
def cast_bigint_trunc(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_extendedprice",
        to_bigint("l_extendedprice").alias("whole_price"),
        to_bigint("l_quantity").alias("whole_quantity"),
        F.col("l_partkey").cast("string").alias("part_text"),
    )


@query
def cast_money(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        money("l_extendedprice").alias("price"),
        money("l_discount").alias("discount"),
        money("l_tax").alias("tax"),
    )


@query
def date_or_blank_query(spark, sf_dir):
    return landing(spark, sf_dir, "clientes").select(
        "v_id_cli", "d_dt_nasc", date_or_blank("d_dt_nasc").alias("born")
    )


@query
def timestamp_or_blank_query(spark, sf_dir):
    return landing(spark, sf_dir, "pedidos").select(
        "n_id_pdd", timestamp_or_blank("d_dt_entr_pdd").alias("delivered")
    )


@query
def blank_if_null_query(spark, sf_dir):
    return landing(spark, sf_dir, "vendas").select(
        "n_id_vd_fil",
        blank_if_null("v_cli_cod").alias("client"),
        blank_if_null("tp_pgt").alias("payment"),
    )


@query
def decode_gender(spark, sf_dir):
    return landing(spark, sf_dir, "clientes").select(
        "v_id_cli", "v_sx_cli", decode_map("v_sx_cli", retail.GENDERS, "").alias("gender")
    )


@query
def decode_marital(spark, sf_dir):
    return landing(spark, sf_dir, "clientes").select(
        "v_id_cli",
        "n_est_cvl",
        decode_map("n_est_cvl", retail.MARITAL_STATES, "").alias("marital_state"),
    )


@query
def decode_channel(spark, sf_dir):
    return landing(spark, sf_dir, "pedidos").select(
        "n_id_pdd", decode_map("v_cnl_orig_pdd", retail.CHANNELS).alias("channel")
    )


@query
def flag_from_sim(spark, sf_dir):
    return landing(spark, sf_dir, "vendas").select(
        "n_id_vd_fil", "v_cpn_eml", flag_from("v_cpn_eml").alias("mailed")
    )


@query
def flag_to_label(spark, sf_dir):
    return landing(spark, sf_dir, "clientes_opt").select(
        "v_id_cli",
        flag_label("b_email").alias("email"),
        flag_label("b_call").alias("call"),
        flag_label("b_push").alias("push"),
        flag_label("b_sms").alias("sms"),
    )


@query
def classify_discount(spark, sf_dir):
    return landing(spark, sf_dir, "itens_vendas").select(
        "n_id_vd_fil",
        "n_id_it",
        "v_it_vd_conv",
        "n_vlr_desc",
        retail.discount_type("v_it_vd_conv", "n_vlr_desc").alias("discount_type"),
    )


@query
def with_audit_columns(spark, sf_dir):
    return with_audit(table(spark, sf_dir, "customer"), AS_OF)


@query
def normalize_temporal_query(spark, sf_dir):
    return normalize_temporal(
        table(spark, sf_dir, "orders").withColumn("order_day", F.to_date("o_orderdate"))
    )


@query
def null_to_nan_count(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderstatus",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"),
    )
    filled = null_to_nan(orders)
    return filled.groupBy("o_orderstatus").agg(
        F.count_if(F.isnan("price")).alias("nan_prices"),
        F.count_if(F.col("price").isNull()).alias("null_prices"),
        F.count(F.lit(1)).alias("orders"),
    )


@query
def unprocessed_only(spark, sf_dir):
    orders = with_audit(table(spark, sf_dir, "orders"), AS_OF)
    shipped = orders.where("o_orderstatus = 'F'").select("o_orderkey")
    marked = merge_frames(
        orders,
        shipped,
        "o_orderkey",
        update={"processed": "true"},
        insert=False,
        source_unique=True,
    )
    return only_unprocessed(marked).drop("creationDate")


@query
def age_days365_query(spark, sf_dir):
    return landing(spark, sf_dir, "clientes").select(
        "v_id_cli", age_days365("d_dt_nasc", AS_OF_DAY).alias("age")
    )


@query
def age_calendar_query(spark, sf_dir):
    return landing(spark, sf_dir, "clientes").select(
        "v_id_cli", age_calendar("d_dt_nasc", AS_OF_DAY).alias("age")
    )


# Row keys


@query
def row_key_compat(spark, sf_dir):
    orders = landing(spark, sf_dir, "pedidos").withColumn("n_vlr_tot_pdd", money("n_vlr_tot_pdd"))
    key = row_key(retail.LANDING_COLUMNS["pedidos"], mode="compat")
    return orders.select("*", F.regexp_replace(key, r"\r\n", "").alias("hash_id"))


@query
def row_key_all_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("*", row_key_for(lines).alias("hash_id"))


@query
def row_key_business(spark, sf_dir):
    return landing(spark, sf_dir, "pedidos").select(
        "n_id_pdd", row_key(["n_id_pdd"], mode="compat").alias("hash_id")
    )


@query
def row_key_strict(spark, sf_dir):
    addresses = landing(spark, sf_dir, "enderecos_clientes")
    return addresses.select(
        "*", row_key(retail.LANDING_COLUMNS["enderecos_clientes"]).alias("hash_id")
    )


# Dedupe


@query
def dedupe_single_key(spark, sf_dir):
    return dedupe(table(spark, sf_dir, "lineitem"), "l_orderkey", ["l_shipdate"])


@query
def dedupe_composite_key(spark, sf_dir):
    return dedupe(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        [F.col("l_extendedprice").desc_nulls_last()],
    )


@query
def dedupe_compat_key(spark, sf_dir):
    addresses = landing(spark, sf_dir, "enderecos_clientes")
    keyed = retail.bronze("enderecos_clientes", addresses, key_mode="compat")
    key = F.regexp_replace("hash_id", r"\r\n", "")
    return dedupe(keyed.withColumn("hash_id", key), "hash_id")


@query
def latest_version_per_key(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


# Joins


def _sales_and_items(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    sales = retail.silver_vendas(_bronze(spark, sf_dir, "vendas")).drop("hash_id")
    items = retail.silver_itens_vendas(_bronze(spark, sf_dir, "itens_vendas")).drop("hash_id")
    return sales, items


@query
def join_composite_key(spark, sf_dir):
    sales, items = _sales_and_items(spark, sf_dir)
    return join_on_columns(items, sales, retail.SALE)


@query
def join_concat_compat(spark, sf_dir):
    sales, items = _sales_and_items(spark, sf_dir)
    return join_on_concat(items, sales, retail.SALE)


@query
def join_single_key(spark, sf_dir):
    links = retail.silver_pedido_venda(_bronze(spark, sf_dir, "pedido_venda")).drop("hash_id")
    orders = retail.silver_pedidos(_bronze(spark, sf_dir, "pedidos")).drop("hash_id")
    return join_on_columns(links, orders, "id_pedido")


@query
def join_salted(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return join_skewed(lines, parts, "l_partkey", salts=8)


# Merges. The order table split by status: 'F' rows are in the target only, 'O' rows in the
# source only, 'P' rows in both.


def _merge_sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    target = orders.where("o_orderstatus in ('F', 'P')").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.lit("old").alias("origin")
    )
    source = orders.where("o_orderstatus in ('O', 'P')").select(
        "o_orderkey",
        (F.col("o_custkey") + 1).alias("o_custkey"),
        (F.col("o_totalprice") * 2).alias("o_totalprice"),
        F.lit("new").alias("origin"),
    )
    return target, source


@query
def merge_upsert_all(spark, sf_dir):
    target, source = _merge_sides(spark, sf_dir)
    return merge_frames(target, source, "o_orderkey")


@query
def merge_upsert_delete(spark, sf_dir):
    target, source = _merge_sides(spark, sf_dir)
    return merge_frames(
        target, source, "o_orderkey", delete_when="source.o_totalprice > 500000"
    )


@query
def merge_schema_evolution(spark, sf_dir):
    target, source = _merge_sides(spark, sf_dir)
    target = target.withColumn("only_target", F.col("o_custkey") % 7)
    source = source.drop("origin").withColumn("only_source", F.col("o_custkey") % 5)
    return merge_frames(target, source, "o_orderkey")


def _flagged_target(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return orders.withColumn("processed", F.lit(False))


def _shipped_keys(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey")


@query
def merge_set_from_table(spark, sf_dir):
    target_path = new_folder(spark, "set-target")
    source_path = new_folder(spark, "set-source")
    write_snapshot(_flagged_target(spark, sf_dir), target_path)
    write_snapshot(_shipped_keys(spark, sf_dir), source_path)
    set_matched(
        read_table(spark, source_path), target_path, "o_orderkey", {"processed": "true"}
    )
    return read_table(spark, target_path)


@query
def merge_set_from_frame(spark, sf_dir):
    target = _flagged_target(spark, sf_dir)
    totals = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_key"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    return merge_frames(
        target,
        totals,
        [("o_orderkey", "order_key")],
        update={"processed": "source.lines > 3", "o_custkey": "target.o_custkey + source.lines"},
        insert=False,
    )


@query
def merge_set_many(spark, sf_dir):
    orders_path, lines_path = new_folder(spark, "many-orders"), new_folder(spark, "many-lines")
    write_snapshot(_flagged_target(spark, sf_dir), orders_path)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    write_snapshot(lines.withColumn("processed", F.lit(False)), lines_path)
    set_matched_many(
        _shipped_keys(spark, sf_dir),
        {orders_path: ["o_orderkey"], lines_path: [("l_orderkey", "o_orderkey")]},
        {"processed": "true"},
    )
    marked_orders = read_table(spark, orders_path).select(
        F.lit("orders").alias("kind"), F.col("o_orderkey").alias("order_key"), "processed"
    )
    marked_lines = read_table(spark, lines_path).select(
        F.lit("lines").alias("kind"), F.col("l_orderkey").alias("order_key"), "processed"
    )
    return marked_orders.unionByName(marked_lines)


@query
def merge_null_key(spark, sf_dir):
    sales = landing(spark, sf_dir, "vendas").withColumn("mailed", flag_from("v_cpn_eml"))

    def per_client(mailed: bool) -> DataFrame:
        return sales.where(F.col("mailed") == mailed).groupBy("v_cli_cod").agg(
            F.count(F.lit(1)).alias("sales"), F.lit(mailed).alias("mailed")
        )

    return merge_frames(per_client(True), per_client(False), "v_cli_cod")


@query
def upsert_stored_with_delete(spark, sf_dir):
    path = new_folder(spark, "stored-delete")
    target, source = _merge_sides(spark, sf_dir)
    write_snapshot(target, path)
    upsert(source, path, "o_orderkey", delete_when="source.o_totalprice > 500000")
    return read_table(spark, path)


@query
def create_or_upsert_twice(spark, sf_dir):
    path = new_folder(spark, "twice")
    target, source = _merge_sides(spark, sf_dir)
    create_or_upsert(target, path, "o_orderkey")
    create_or_upsert(source, path, "o_orderkey")
    return read_table(spark, path)


# Layer steps


def _bronze(spark, sf_dir, name: str, key_mode: str = "strict") -> DataFrame:
    return retail.bronze(name, landing(spark, sf_dir, name), key_mode)


def _spec(name: str, key_mode: str = "strict"):
    return next(s for s in retail.table_specs(key_mode) if s.name == name)


def _bronze_step(spark, sf_dir, name: str) -> DataFrame:
    return apply_step(landing(spark, sf_dir, name), _spec(name).bronze, AS_OF)


def _silver_step(spark, sf_dir, name: str) -> DataFrame:
    return apply_step(_bronze_step(spark, sf_dir, name), _spec(name).silver, AS_OF)


for _name in retail.LANDING_COLUMNS:
    QUERIES[f"bronze_{_name}"] = partial(_bronze_step, name=_name)
    QUERIES[f"silver_{_name}"] = partial(_silver_step, name=_name)


def _stored(spark, sf_dir, layer: str, name: str) -> DataFrame:
    layout = new_lake(spark, f"stored-{name}")
    write_landing(spark, sf_dir, layout, [name])
    store, spec = SnapshotStore(spark, layout), _spec(name)
    run_bronze(store, spec, layout, AS_OF)
    run_silver(store, spec, AS_OF)
    return store.read(layer, name)


for _name in retail.LANDING_COLUMNS:
    QUERIES[f"stored_bronze_{_name}"] = partial(_stored, layer="bronze", name=_name)
    QUERIES[f"stored_silver_{_name}"] = partial(_stored, layer="silver", name=_name)


@query
def silver_clientes_with_age(spark, sf_dir):
    return retail.silver_clientes_idade(landing(spark, sf_dir, "clientes"), AS_OF_DAY)


@query
def step_transform(spark, sf_dir):
    step = StepSpec(
        transform="""
            select n_id_fil, n_id_vd_fil, d_dt_vd, n_vlr_tot_vd
            from vendas_tmp""",
        view="vendas_tmp",
        key=("n_id_fil", "n_id_vd_fil"),
        order_by=("n_vlr_tot_vd",),
    )
    return apply_step(landing(spark, sf_dir, "vendas"), step, AS_OF)


def _silver_views(spark, sf_dir, names) -> dict[str, DataFrame]:
    return {n: retail.SILVER[n](_bronze(spark, sf_dir, n)) for n in names}


_SALES = ("vendas", "itens_vendas", "pedido_venda", "pedidos")
_CLIENTS = ("clientes", "clientes_opt", "enderecos_clientes")


@query
def gold_vendas_items(spark, sf_dir):
    return retail.gold_vendas_items(_silver_views(spark, sf_dir, _SALES))


@query
def gold_vendas_concat(spark, sf_dir):
    return retail.gold_vendas_concat(_silver_views(spark, sf_dir, _SALES))


@query
def gold_vendas(spark, sf_dir):
    return retail.gold_vendas(_silver_views(spark, sf_dir, _SALES))


@query
def gold_clientes_rows(spark, sf_dir):
    return retail.gold_clientes_rows(_silver_views(spark, sf_dir, _CLIENTS), AS_OF_DAY, salts=8)


@query
def gold_clientes(spark, sf_dir):
    return retail.gold_clientes(_silver_views(spark, sf_dir, _CLIENTS), AS_OF_DAY)


def write_landing(spark, sf_dir, layout: LakeLayout, names) -> None:
    """The landing files of the lake: JSON documents for the consents, else Parquet."""
    for name in names:
        path = layout.path("transient", name)
        frame = landing(spark, sf_dir, name)
        if name == "clientes_opt":
            write_json_documents(frame, path)
        else:
            write_files(frame, path)


def _full_run(spark, sf_dir, gold: str):
    layout = new_lake(spark, f"run-{gold}")
    golds = [g for g in retail.gold_specs(AS_OF_DAY) if g.name == gold]
    names = golds[0].tables
    write_landing(spark, sf_dir, layout, names)
    store = SnapshotStore(spark, layout)
    tables = [s for s in retail.table_specs() if s.name in names]
    results = run_lake(store, layout, tables, golds, as_of=AS_OF, threads=4)
    return store, results


@query
def full_run_vendas(spark, sf_dir):
    store, _ = _full_run(spark, sf_dir, "vendas")
    return store.read("gold", "vendas")


@query
def full_run_clientes(spark, sf_dir):
    store, _ = _full_run(spark, sf_dir, "clientes")
    return store.read("gold", "clientes")


@query
def run_report(spark, sf_dir):
    _, results = _full_run(spark, sf_dir, "vendas")
    return report_frame(spark, results)


@query
def bronze_marked_processed(spark, sf_dir):
    layout = new_lake(spark, "marked")
    write_landing(spark, sf_dir, layout, ["pedidos"])
    store, spec = SnapshotStore(spark, layout), _spec("pedidos")
    run_bronze(store, spec, layout, AS_OF)
    run_silver(store, spec, AS_OF)
    return store.read("bronze", "pedidos")


def _run_with_changes(spark, sf_dir, name: str, incremental: bool) -> SnapshotStore:
    """Sales taken twice; in between, two in three of them get a total and a client that sort
    behind or before the first ones, and the files of the first landing are replaced."""
    layout = new_lake(spark, name)
    store = SnapshotStore(spark, layout)
    golds = [g for g in retail.gold_specs(AS_OF_DAY) if g.name == "vendas"]
    tables = [s for s in retail.table_specs(newest=True) if s.name in _SALES]
    write_landing(spark, sf_dir, layout, _SALES)
    run_lake(store, layout, tables, golds, as_of=AS_OF, incremental=incremental)
    turn = F.col("n_id_vd_fil") % 3
    changed = landing(spark, sf_dir, "vendas").withColumns(
        {
            "n_vlr_tot_vd": F.when(turn == 0, F.col("n_vlr_tot_vd") * 2)
            .when(turn == 1, F.lit(0.0))
            .otherwise(F.col("n_vlr_tot_vd")),
            "v_cli_cod": F.when(turn == 0, F.lit("Z1"))
            .when(turn == 1, F.lit("A1"))
            .otherwise(F.col("v_cli_cod")),
        }
    )
    write_files(changed.where(turn != 2), layout.path("transient", "vendas"))
    run_lake(store, layout, tables, golds, as_of="2026-12-02 00:00:00", incremental=incremental)
    return store


@query
def changed_records_silver(spark, sf_dir):
    store = _run_with_changes(spark, sf_dir, "changed-silver", incremental=False)
    return store.read("silver", "vendas").drop("hash_id", "processed", "creationDate")


@query
def changed_records_gold(spark, sf_dir):
    return _run_with_changes(spark, sf_dir, "changed-gold", incremental=True).read("gold", "vendas")


@query
def full_run_sql_steps(spark, sf_dir):
    """All seven tables in threads, each bronze step SQL over a view of the same name."""
    layout = new_lake(spark, "sql-steps")
    write_landing(spark, sf_dir, layout, list(retail.LANDING_COLUMNS))
    store = SnapshotStore(spark, layout)
    tables = []
    for spec in retail.table_specs():
        names = ", ".join(retail.LANDING_COLUMNS[spec.name])
        text = f"select distinct *, sha2(concat_ws('|', {names}), 256) as hash_id from table_tmp"
        bronze = StepSpec(text, view="table_tmp")
        silver = StepSpec("select *, 1 as taken from table_tmp", view="table_tmp")
        tables.append(replace(spec, bronze=bronze, silver=silver))
    run_lake(store, layout, tables, [], as_of=AS_OF, threads=7)
    # One row a row of each table: the digest of all its columns, by the strict key's rule.
    digests = [
        store.read("silver", n).select(F.lit(n).alias("name"), row_key_for(store.read("silver", n), columns).alias("digest"), "taken")
        for n, columns in retail.LANDING_COLUMNS.items()
    ]
    return reduce(DataFrame.unionAll, digests)


@query
def merge_unmatched_copies(spark, sf_dir):
    """A source that repeats keys the target does not hold: all of its rows are inserted."""
    sides = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    target = sides.where("o_orderkey % 2 = 0")
    odd = sides.where("o_orderkey % 2 = 1")
    return merge_frames(target, odd.unionAll(odd), "o_orderkey")


@query
def merge_outer_checked(spark, sf_dir):
    """One full outer join for a source not known to have distinct keys."""
    sides = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    target = sides.where("o_orderkey % 3 <> 0")
    source = sides.where("o_orderkey % 3 <> 1").withColumn("o_custkey", -F.col("o_custkey"))
    return merge_frames(target, source, "o_orderkey", form="outer")


@query
def archived_landing(spark, sf_dir):
    """Landing files moved away once taken: the second run finds none, and bronze stays."""
    layout = new_lake(spark, "archived")
    write_landing(spark, sf_dir, layout, ["vendas"])
    store, spec = SnapshotStore(spark, layout), _spec("vendas")
    for day in (AS_OF, "2026-12-02 00:00:00"):
        run_bronze(store, spec, layout, day, archive=True)
    archived = read_landing(spark, layout.archive("vendas"))
    keys = archived.select("n_id_fil", "n_id_vd_fil").distinct()
    return store.read("bronze", "vendas").join(keys, ["n_id_fil", "n_id_vd_fil"], "left_semi")


@query
def rerun_incremental(spark, sf_dir):
    """The same landing files taken twice, the second time for new rows only."""
    layout = new_lake(spark, "rerun")
    write_landing(spark, sf_dir, layout, ["itens_vendas"])
    store, spec = SnapshotStore(spark, layout), replace(_spec("itens_vendas"), tracks="changes")
    for _ in range(2):
        run_bronze(store, spec, layout, AS_OF)
        run_silver(store, spec, AS_OF, incremental=True)
    return store.read("silver", "itens_vendas")


@query
def partitioned_batches(spark, sf_dir):
    """Sales in two batches into tables split by year, marked and merged year by year."""
    layout = new_lake(spark, "batches")
    years = {
        ("bronze", "vendas"): F.year("d_dt_vd"),
        ("silver", "vendas"): F.substring("data_emissao", 1, 4),
    }
    store, spec = PartitionedStore(spark, layout, years), _spec("vendas")
    sales = landing(spark, sf_dir, "vendas")
    for batch in (sales.where("d_dt_vd < timestamp '1998-01-01'"), sales):
        write_files(batch, layout.path("transient", "vendas"))
        run_bronze(store, spec, layout, AS_OF)
        run_silver(store, spec, AS_OF, incremental=True)
    return store.read("silver", "vendas")


@query
def gold_write_back(spark, sf_dir):
    layout = new_lake(spark, "write-back")
    store = SnapshotStore(spark, layout)
    for name in _SALES:
        # Equal keys are equal rows: made distinct before they get their key, they need no sort by it.
        bronze = retail.bronze_distinct(name, landing(spark, sf_dir, name))
        store.save(with_audit(retail.SILVER[name](bronze), AS_OF), "silver", name, ["hash_id"], unique=True)
    spec = retail.gold_specs(AS_OF_DAY)[0]
    sale_to_coupon = [
        ("codigo_filial", "codigo_filial"),
        ("id_venda_filial", "codigo_cupom_venda"),
    ]
    run_gold(store, replace(spec, write_back={"vendas": sale_to_coupon}))
    return store.read("silver", "vendas").select(*retail.SALE, "processed")


@query
def landing_stream_ingest(spark, sf_dir):
    layout = new_lake(spark, "stream")
    sales = landing(spark, sf_dir, "vendas")
    write_files(sales.repartition(3), layout.path("transient", "vendas"))
    spec = next(
        s
        for s in retail.table_specs(landing={"vendas": LandingFormat(schema=sales.schema)})
        if s.name == "vendas"
    )
    store = SnapshotStore(spark, layout)
    ingest_landing_stream(
        spark, store, spec, layout, f"{layout.transient}/_checkpoint", as_of=AS_OF
    )
    return store.read("bronze", "vendas")


# User SQL


@query
def user_sql_groupby(spark, sf_dir):
    return run_sql(
        spark,
        """select tipo_desconto, com_receita_eletronica, count(*) as itens,
                  sum(valor_final_item) as total, sum(quantidade_itens) as quantidade
           from itens group by tipo_desconto, com_receita_eletronica""",
        {"itens": retail.silver_itens_vendas(_bronze(spark, sf_dir, "itens_vendas"))},
    )


@query
def user_sql_window(spark, sf_dir):
    return run_sql(
        spark,
        """select codigo_cliente, id_venda_filial, valor_total_venda, posicao
           from (
             select codigo_cliente, id_venda_filial, valor_total_venda,
                    row_number() over (
                      partition by codigo_cliente
                      order by valor_total_venda desc, id_venda_filial) as posicao
             from vendas)
           where posicao <= 3""",
        {"vendas": retail.silver_vendas(_bronze(spark, sf_dir, "vendas"))},
    )


@query
def user_sql_union(spark, sf_dir):
    return run_sql(
        spark,
        """select cidade_endereco as cidade from enderecos
           union select cidade_entrega from pedidos
           except select '' as cidade""",
        {
            "enderecos": retail.silver_enderecos_clientes(_bronze(spark, sf_dir, "enderecos_clientes")),
            "pedidos": retail.silver_pedidos(_bronze(spark, sf_dir, "pedidos")),
        },
    )
