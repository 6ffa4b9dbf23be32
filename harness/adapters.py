"""Landing tables of the retail lake, derived from the driver tables.

``landing`` builds them as frames, ``LANDING_SQL`` as SQL for the expected results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _client_code(column: str):
    return F.concat(F.lit("C"), F.col(column).cast("string"))


def _vendas(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("d_dt_vd"),
        (F.col("o_orderkey") % 20).alias("n_id_fil"),
        F.col("o_orderkey").alias("n_id_vd_fil"),
        F.when(F.col("o_custkey") % 11 != 0, _client_code("o_custkey")).alias("v_cli_cod"),
        F.col("o_totalprice").alias("n_vlr_tot_vd"),
        (F.col("o_custkey") % 50).cast("double").alias("n_vlr_tot_desc"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "SIM")
        .when(priority == "3-MEDIUM", "NAO")
        .alias("v_cpn_eml"),
        F.nullif(priority, F.lit("5-LOW")).alias("tp_pgt"),
    )


def _pedidos(spark: SparkSession, sf_dir: str) -> DataFrame:
    custkey = F.col("o_custkey")
    channel = F.col("o_orderkey") % 4
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("n_id_pdd"),
        F.col("o_orderdate").alias("d_dt_eft_pdd"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + F.expr("interval '3' day"))
        .alias("d_dt_entr_pdd"),
        F.when(channel == 0, "L").when(channel == 1, "A").when(channel == 2, "S").otherwise("T")
        .alias("v_cnl_orig_pdd"),
        F.concat(F.lit("U"), (custkey % 27).cast("string")).alias("v_uf_entr_pdd"),
        F.when(custkey % 13 != 0, F.concat(F.lit("L"), (custkey % 97).cast("string")))
        .alias("v_lc_ent_pdd"),
        F.col("o_totalprice").alias("n_vlr_tot_pdd"),
    )


def _pedido_venda(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        (key % 20).alias("n_id_fil"), key.alias("n_id_vd_fil"), key.alias("n_id_pdd")
    )


def _itens_vendas(spark: SparkSession, sf_dir: str) -> DataFrame:
    def sim(column: str, value: str):
        return F.when(F.col(column) == value, "SIM").otherwise("NAO")

    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 20).alias("n_id_fil"),
        F.col("l_orderkey").alias("n_id_vd_fil"),
        F.col("l_partkey").alias("n_id_it"),
        sim("l_returnflag", "R").alias("v_rc_elt"),
        sim("l_linestatus", "F").alias("v_it_vd_conv"),
        F.col("l_tax").alias("n_vlr_pis"),
        F.col("l_extendedprice").alias("n_vlr_vd"),
        F.col("l_discount").alias("n_vlr_desc"),
        F.col("l_quantity").alias("n_qtd"),
    )


def _clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    custkey, nation = F.col("c_custkey"), F.col("c_nationkey")
    born = F.date_add(F.lit("1950-01-01").cast("date"), (custkey % 20000).cast("int"))
    return table(spark, sf_dir, "customer").select(
        _client_code("c_custkey").alias("v_id_cli"),
        F.when(custkey % 17 != 0, born).alias("d_dt_nasc"),
        F.when(nation % 3 == 0, "F").when(nation % 3 == 1, "M").alias("v_sx_cli"),
        (nation % 8).alias("n_est_cvl"),
    )


def _clientes_opt(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        (balance > 0).alias("b_call"),
        F.when(nation % 5 != 0, balance > 1000).alias("b_email"),
        (F.col("c_mktsegment") == "BUILDING").alias("b_push"),
        (nation < 12).alias("b_sms"),
        _client_code("c_custkey").alias("v_id_cli"),
    )


def _enderecos_clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first address for everyone and a second for a third of the clients, in one pass."""
    located = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    first = F.lit(1)
    numbers = F.when(F.col("c_custkey") % 3 == 0, F.array(first, F.lit(2))).otherwise(
        F.array(first)
    )
    second = F.col("n_sq_end") == 2
    deleted = F.lit("2020-01-02 03:04:05").cast("timestamp_ntz")
    return located.withColumn("n_sq_end", F.explode(numbers)).select(
        _client_code("c_custkey").alias("v_id_cli"),
        "n_sq_end",
        F.when(second, deleted).alias("d_dt_exc"),
        F.col("n_name").alias("v_lcl"),
        F.when(second, "Z")
        .otherwise(F.concat(F.lit("R"), F.col("n_regionkey").cast("string")))
        .alias("v_uf"),
    )


_BUILDERS = {
    "clientes": _clientes,
    "clientes_opt": _clientes_opt,
    "enderecos_clientes": _enderecos_clientes,
    "itens_vendas": _itens_vendas,
    "pedidos": _pedidos,
    "pedido_venda": _pedido_venda,
    "vendas": _vendas,
}


def landing(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _BUILDERS[name](spark, sf_dir)


LANDING_SQL = {
    "vendas": """
        select o_orderdate as d_dt_vd, o_orderkey % 20 as n_id_fil, o_orderkey as n_id_vd_fil,
          case when o_custkey % 11 = 0 then null else 'C' || cast(o_custkey as varchar) end
            as v_cli_cod,
          o_totalprice as n_vlr_tot_vd, cast(o_custkey % 50 as double) as n_vlr_tot_desc,
          case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'SIM'
               when o_orderpriority = '3-MEDIUM' then 'NAO' end as v_cpn_eml,
          nullif(o_orderpriority, '5-LOW') as tp_pgt
        from orders""",
    "pedidos": """
        select o_orderkey as n_id_pdd, o_orderdate as d_dt_eft_pdd,
          case when o_orderstatus = 'P' then null else o_orderdate + interval '3' day end
            as d_dt_entr_pdd,
          case o_orderkey % 4 when 0 then 'L' when 1 then 'A' when 2 then 'S' else 'T' end
            as v_cnl_orig_pdd,
          'U' || cast(o_custkey % 27 as varchar) as v_uf_entr_pdd,
          case when o_custkey % 13 = 0 then null else 'L' || cast(o_custkey % 97 as varchar) end
            as v_lc_ent_pdd,
          o_totalprice as n_vlr_tot_pdd
        from orders""",
    "pedido_venda": """
        select o_orderkey % 20 as n_id_fil, o_orderkey as n_id_vd_fil, o_orderkey as n_id_pdd
        from orders""",
    "itens_vendas": """
        select l_orderkey % 20 as n_id_fil, l_orderkey as n_id_vd_fil, l_partkey as n_id_it,
          case when l_returnflag = 'R' then 'SIM' else 'NAO' end as v_rc_elt,
          case when l_linestatus = 'F' then 'SIM' else 'NAO' end as v_it_vd_conv,
          l_tax as n_vlr_pis, l_extendedprice as n_vlr_vd, l_discount as n_vlr_desc,
          l_quantity as n_qtd
        from lineitem""",
    "clientes": """
        select 'C' || cast(c_custkey as varchar) as v_id_cli,
          case when c_custkey % 17 = 0 then null
               else date '1950-01-01' + cast(c_custkey % 20000 as int) end as d_dt_nasc,
          case c_nationkey % 3 when 0 then 'F' when 1 then 'M' end as v_sx_cli,
          c_nationkey % 8 as n_est_cvl
        from customer""",
    "clientes_opt": """
        select c_acctbal > 0 as b_call,
          case when c_nationkey % 5 = 0 then null else c_acctbal > 1000 end as b_email,
          c_mktsegment = 'BUILDING' as b_push, c_nationkey < 12 as b_sms,
          'C' || cast(c_custkey as varchar) as v_id_cli
        from customer""",
    "enderecos_clientes": """
        select 'C' || cast(c_custkey as varchar) as v_id_cli, 1 as n_sq_end,
          cast(null as timestamp) as d_dt_exc, n_name as v_lcl,
          'R' || cast(n_regionkey as varchar) as v_uf
        from customer join nation on c_nationkey = n_nationkey
        union all
        select 'C' || cast(c_custkey as varchar), 2, timestamp '2020-01-02 03:04:05', n_name, 'Z'
        from customer join nation on c_nationkey = n_nationkey where c_custkey % 3 = 0""",
}
