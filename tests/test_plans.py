"""What the physical plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import dedupe, join_on_columns, join_on_concat, merge_frames
from sedimenta.operators.dedupe import distinct_keys
from sedimenta.plans import apply_step, retail
from sedimenta.sources import read_table, write_snapshot

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def conf(spark):
    """Session settings for one test."""
    changed = []

    def put(name, value):
        changed.append((name, spark.conf.get(name, None)))
        spark.conf.set(name, value)

    yield put
    for name, value in reversed(changed):
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def plan(df, final=False):
    """The physical plan as text; the adapted one after running if ``final``."""
    query = df._jdf.queryExecution()
    if final:
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        return query.executedPlan().finalPhysicalPlan().toString()
    return query.executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def orders(spark):
    return spark.read.parquet(f"{SF_DIR}/orders.parquet")


def lines(spark):
    return spark.read.parquet(f"{SF_DIR}/lineitem.parquet")


def test_dedupe_limits_groups_before_its_one_shuffle(spark):
    text = plan(dedupe(lines(spark), "l_orderkey", ["l_shipdate"]))
    assert shuffles(text) == 1
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_column_keys_reach_the_scan_and_concat_keys_do_not(spark):
    left = orders(spark).withColumnRenamed("o_orderkey", "k").select("k", "o_custkey")
    right = lines(spark).withColumnRenamed("l_orderkey", "k").select("k", "l_partkey")
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan(join_on_columns(left, right, ["k"]))
    assert "IsNotNull(l_orderkey)" not in plan(join_on_concat(left, right, ["k", "k"][:1]))


def test_small_source_merges_without_shuffling_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    write_snapshot(lines(spark).select(F.monotonically_increasing_id().alias("k"), "*"), path)
    target = read_table(spark, path)
    source = target.where("l_quantity > 49")
    text = plan(merge_frames(target, source, "k", source_unique=True), final=True)
    assert "LeftOuter BuildRight" in text or "LeftOuter, BuildRight" in text
    assert "SortMergeJoin" not in text and "NestedLoop" not in text
    fold = text.index("HashAggregate", text.index("LeftAnti"))
    assert fold < text.index("LeftSemi"), "all keys of the target are shuffled"
    assert re.search(r"ReadSchema: struct<k:bigint>", text), "second scan reads more than keys"


def test_hot_target_key_is_split(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    hot = spark.range(40000).repartition(8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))
    source = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for unique in (True, False):
        text = plan(merge_frames(hot, source, "k", source_unique=unique), final=True)
        assert re.search(r"SortMergeJoin\(skew=true\).* LeftOuter", text)
        # the keys looked for in the target are folded before they are shuffled
        assert re.search(r"HashAggregate\(keys=\[__k0#\d+L\][^\n]*\n[^\n]*Project \[CASE", text)
    repeated = source.union(source)
    keys = distinct_keys(repeated, ["k"])
    marked = merge_frames(
        hot, keys, "k", update={"v": "0"}, insert=False, source_unique=True)
    assert "SortMergeJoin(skew=true)" in plan(marked, final=True)
    assert marked.where("v = 0").count() > 40000 / 3


def test_hot_sale_is_split_in_gold_vendas_items(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    sales = spark.range(2000).selectExpr(
        "id % 20 as codigo_filial", "id as id_venda_filial", "'d' as data_emissao",
        "'c' as codigo_cliente")
    links = sales.selectExpr("codigo_filial", "id_venda_filial", "id_venda_filial as id_pedido")
    kinds = links.selectExpr("id_pedido", "'Site' as canal_venda")
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2000)
    items = spark.range(60000).repartition(8).select(
        (hot % 20).alias("codigo_filial"), hot.alias("id_venda_filial"),
        F.col("id").alias("codigo_item_venda"), F.lit(1).alias("valor_final_item"),
        F.lit(1).alias("quantidade_itens"), F.lit("p").alias("tipo_desconto"))
    silver = {"vendas": sales, "pedido_venda": links, "pedidos": kinds, "itens_vendas": items}
    for build in (retail.gold_vendas_items, retail.gold_vendas_concat):
        frame = build(silver)
        text = plan(frame, final=True)
        assert "SortMergeJoin(skew=true)" in text
        assert frame.distinct().count() >= 60000


def test_coupons_share_one_partitioning(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    from harness.queries import _SALES, _silver_views

    text = plan(retail.gold_vendas(_silver_views(spark, SF_DIR, _SALES)))
    # links, orders, (links + orders), sales, items: the joins by sale add none
    assert shuffles(text) == 5


def test_clients_share_one_partitioning(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    data = spark.range(10).selectExpr(
        "cast(id as string) as codigo_cliente", "'' as data_nascimento_cliente",
        "'' as genero_biologico_cliente", "'' as estado_civil_cliente",
        "'' as autoriza_notificacao_ligacao", "'' as autoriza_notificacao_sms",
        "'' as autoriza_notificacao_email", "'' as autoriza_notificacao_push",
        "id as sequencia_endereco_cliente", "'' as UF_endereco", "'' as cidade_endereco")
    silver = dict.fromkeys(("clientes", "clientes_opt", "enderecos_clientes"), data)
    assert shuffles(plan(retail.gold_clientes(silver, "2026-12-01"))) == 3


def test_strict_silver_step_does_not_shuffle(spark, tmp_path):
    from harness.adapters import landing

    spec = next(s for s in retail.table_specs() if s.name == "itens_vendas")
    bronze = apply_step(landing(spark, SF_DIR, "itens_vendas"), spec.bronze)
    assert shuffles(plan(bronze)) == 1
    write_snapshot(bronze, str(tmp_path / "b"))
    silver = apply_step(read_table(spark, str(tmp_path / "b")), spec.silver)
    assert shuffles(plan(silver)) == 0
