"""Expected results as SQL over the driver tables, one text per query."""

from __future__ import annotations

from collections.abc import Sequence

from harness.adapters import LANDING_SQL
from sedimenta.plans import retail

_CREATED = "timestamp '2026-12-01 00:00:00'"
_AUDIT = f'false as processed, {_CREATED} as "creationDate"'

# Landing columns of each table, as the key covers them.
_COLUMNS = retail.LANDING_COLUMNS

# What each silver table selects from its bronze table.
_SILVER = {
    "vendas": """
        coalesce(strftime(d_dt_vd, '%Y-%m-%d %H:%M:%S'), '') as data_emissao,
        cast(n_id_fil as bigint) as codigo_filial, cast(n_id_vd_fil as bigint) as id_venda_filial,
        coalesce(v_cli_cod, '') as codigo_cliente,
        cast(n_vlr_tot_vd as decimal(38,2)) as valor_total_venda,
        cast(n_vlr_tot_desc as decimal(38,2)) as valor_total_desconto,
        coalesce(v_cpn_eml = 'SIM', false) as enviado_email,
        coalesce(tp_pgt, '') as tipo_pagamento""",
    "pedidos": """
        cast(n_id_pdd as bigint) as id_pedido,
        coalesce(cast(cast(d_dt_eft_pdd as date) as varchar), '') as data_realizacao_pedido,
        coalesce(strftime(d_dt_entr_pdd, '%Y-%m-%d %H:%M:%S'), '') as data_entrega,
        case v_cnl_orig_pdd when 'L' then 'Loja' when 'A' then 'App' when 'S' then 'Site' end
          as canal_venda,
        coalesce(v_uf_entr_pdd, '') as "UF_pedido", coalesce(v_lc_ent_pdd, '') as cidade_entrega,
        cast(n_vlr_tot_pdd as decimal(38,2)) as valor_total_pedido""",
    "pedido_venda": """
        cast(n_id_fil as bigint) as codigo_filial, cast(n_id_vd_fil as bigint) as id_venda_filial,
        cast(n_id_pdd as bigint) as id_pedido""",
    "itens_vendas": """
        cast(n_id_fil as bigint) as codigo_filial, cast(n_id_vd_fil as bigint) as id_venda_filial,
        cast(n_id_it as bigint) as codigo_item_venda,
        coalesce(v_rc_elt = 'SIM', false) as com_receita_eletronica,
        case when v_it_vd_conv = 'SIM' then 'Convênio'
             when v_it_vd_conv = 'NAO' and n_vlr_desc > 0 then 'Promoção'
             else 'Sem Desconto' end as tipo_desconto,
        cast(n_vlr_pis as decimal(38,2)) as valor_pis_item,
        cast(n_vlr_vd as decimal(38,2)) as valor_final_item,
        cast(n_vlr_desc as decimal(38,2)) as valor_desconto_item,
        cast(n_qtd as bigint) as quantidade_itens""",
    "clientes": """
        v_id_cli as codigo_cliente,
        coalesce(cast(d_dt_nasc as varchar), '') as data_nascimento_cliente,
        case v_sx_cli when 'F' then 'Feminino' when 'M' then 'Masculino' else '' end
          as genero_biologico_cliente,
        case n_est_cvl when 1 then 'Solteiro' when 2 then 'Casado' when 3 then 'Viúvo'
             when 4 then 'Desquitado' when 5 then 'Divorciado' when 6 then 'Outros' else '' end
          as estado_civil_cliente""",
    "clientes_opt": """
        v_id_cli as codigo_cliente,
        case when b_push then 'SIM' when not b_push then 'NÃO' else '' end
          as autoriza_notificacao_push,
        case when b_sms then 'SIM' when not b_sms then 'NÃO' else '' end
          as autoriza_notificacao_sms,
        case when b_email then 'SIM' when not b_email then 'NÃO' else '' end
          as autoriza_notificacao_email,
        case when b_call then 'SIM' when not b_call then 'NÃO' else '' end
          as autoriza_notificacao_ligacao""",
    "enderecos_clientes": """
        v_id_cli as codigo_cliente, cast(n_sq_end as bigint) as sequencia_endereco_cliente,
        coalesce(strftime(d_dt_exc, '%Y-%m-%d %H:%M:%S'), '') as data_exclusao_endereco,
        v_lcl as cidade_endereco, v_uf as "UF_endereco\"""",
}

# Columns of the driver tables.
_LINE_COLUMNS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]
_ORDER_COLUMNS = [
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
]


def _is_text(column: str) -> bool:
    return column.startswith("v_") or column in ("tp_pgt", "l_returnflag", "l_linestatus")


def _strict_key(columns: Sequence[str], by_type: bool = True) -> str:
    parts = [
        f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '~')"
        if _is_text(c) or not by_type
        else f"coalesce(cast({c} as varchar), '~')"
        for c in columns
    ]
    return f"sha256(concat_ws('|', {', '.join(parts)}))"


def _compat_key(columns: Sequence[str]) -> str:
    return "base64(encode(" + " || ".join(f"cast({c} as varchar)" for c in columns) + "))"


def _landing(*tables: str) -> str:
    return ", ".join(f"{t}_tmp as ({LANDING_SQL[t]})" for t in tables)


def _from_landing(table: str, select: str) -> str:
    return f"with {_landing(table)} select {select} from {table}_tmp"


def _bronze_select(table: str) -> str:
    columns = _COLUMNS[table]
    key = _strict_key(columns)
    return f"select distinct {', '.join(columns)}, {key} as hash_id from {table}_tmp"


def _bronze(table: str, audit: str = _AUDIT) -> str:
    return (
        f"with {_landing(table)}, bronze as ({_bronze_select(table)})"
        f" select *, {audit} from bronze"
    )


def _silver(table: str) -> str:
    return (
        f"with {_landing(table)}, bronze as ({_bronze_select(table)})"
        f" select {_SILVER[table]}, hash_id, {_AUDIT} from bronze"
    )


def _silver_tables(tables: Sequence[str], distinct: bool) -> str:
    """Silver tables as common table expressions; ``distinct`` as stored, by strict key."""
    views = [_landing(*tables)]
    for t in tables:
        source = f"(select distinct * from {t}_tmp)" if distinct else f"{t}_tmp"
        views.append(f"{t} as (select {_SILVER[t]} from {source} as landing_rows)")
    return ", ".join(views)


_SALES = ("vendas", "itens_vendas", "pedido_venda", "pedidos")
_CLIENTS = ("clientes", "clientes_opt", "enderecos_clientes")

_GOLD_VENDAS_ROWS = """
    select v.codigo_filial, v.id_venda_filial as codigo_cupom_venda, v.data_emissao,
      iv.codigo_item_venda as codigo_item, iv.valor_final_item as valor_unitario,
      iv.quantidade_itens as quantidade, v.codigo_cliente, iv.tipo_desconto, p.canal_venda
    from vendas v
    join pedido_venda pv
      on pv.codigo_filial = v.codigo_filial and pv.id_venda_filial = v.id_venda_filial
    join itens_vendas iv
      on iv.codigo_filial = v.codigo_filial and iv.id_venda_filial = v.id_venda_filial
    join pedidos p on p.id_pedido = pv.id_pedido"""

_GOLD_CLIENTES_COLUMNS = """
    c.codigo_cliente, c.data_nascimento_cliente as data_nascimento,
    cast(trunc(date_diff('day', try_cast(c.data_nascimento_cliente as date),
      date '2026-12-01') / 365.0) as integer) as idade,
    c.genero_biologico_cliente as sexo, ec."UF_endereco" as uf, ec.cidade_endereco as cidade,
    c.estado_civil_cliente as estado_civil, co.autoriza_notificacao_ligacao as flag_lgpd_call,
    co.autoriza_notificacao_sms as flag_lgpd_sms,
    co.autoriza_notificacao_email as flag_lgpd_email,
    co.autoriza_notificacao_push as flag_lgpd_push"""

_GOLD_CLIENTES_JOIN = """
    from clientes c
    join clientes_opt co on co.codigo_cliente = c.codigo_cliente
    join enderecos_clientes ec on ec.codigo_cliente = c.codigo_cliente"""


def _gold_vendas(distinct: bool) -> str:
    return f"""
        with {_silver_tables(_SALES, distinct)}, joined as ({_GOLD_VENDAS_ROWS}),
        ranked as (
          select *, row_number() over (
            partition by codigo_filial, codigo_cupom_venda
            order by codigo_item nulls first, valor_unitario nulls first,
              quantidade nulls first, tipo_desconto nulls first, data_emissao nulls first,
              codigo_cliente nulls first, canal_venda nulls first) as place
          from joined)
        select * exclude (place) from ranked where place = 1"""


def _gold_clientes(distinct: bool) -> str:
    return f"""
        with {_silver_tables(_CLIENTS, distinct)}, ranked as (
          select {_GOLD_CLIENTES_COLUMNS}, row_number() over (
            partition by c.codigo_cliente order by ec.sequencia_endereco_cliente nulls first,
              ec."UF_endereco" nulls first, ec.cidade_endereco nulls first) as place
          {_GOLD_CLIENTES_JOIN})
        select * exclude (place) from ranked where place = 1"""


def _first_line(keys: str, order: str, done: Sequence[str]) -> str:
    ties = ", ".join(f"{c} nulls first" for c in _LINE_COLUMNS if c not in done)
    return f"""
        with ranked as (
          select *, row_number() over (partition by {keys} order by {order}, {ties}) as place
          from lineitem)
        select * exclude (place) from ranked where place = 1"""


_ALL_ORDERS = "select * from orders"

_MERGE_SIDES = """
    target as (
      select o_orderkey, o_custkey, o_totalprice, 'old' as origin
      from orders where o_orderstatus in ('F', 'P')),
    source as (
      select o_orderkey, o_custkey + 1 as o_custkey, o_totalprice * 2 as o_totalprice,
        'new' as origin
      from orders where o_orderstatus in ('O', 'P'))"""

_UPSERTED = f"""
    with {_MERGE_SIDES}
    select * from target where o_orderkey not in (select o_orderkey from source)
    union all select * from source"""

_UPSERTED_OR_DELETED = f"""
    with {_MERGE_SIDES}
    select * from target where o_orderkey not in (select o_orderkey from source)
    union all
    select * from source
    where o_totalprice <= 500000 or o_orderkey not in (select o_orderkey from target)"""

_CHANGED_SALES = f"""
    select * replace (
      case n_id_vd_fil % 3 when 0 then n_vlr_tot_vd * 2 when 1 then 0.0 else n_vlr_tot_vd end
        as n_vlr_tot_vd,
      case n_id_vd_fil % 3 when 0 then 'Z1' when 1 then 'A1' else v_cli_cod end as v_cli_cod)
    from ({LANDING_SQL["vendas"]})"""

ORACLES: dict[str, str] = {
    "read_parquet": "select * from lineitem",
    "read_json_multiline": _from_landing("clientes_opt", "b_call, b_email, b_push, b_sms, v_id_cli"),
    "read_csv_infer": """
        select cast(o_orderkey as integer) as o_orderkey, cast(o_custkey as integer) as o_custkey,
          o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders""",
    "read_table_latest": _ALL_ORDERS,
    "write_overwrite": _ALL_ORDERS,
    "write_append": _ALL_ORDERS,
    "compact_table": "select * from lineitem",
    "preview_all_string": "select "
    + ", ".join(f"cast({c} as varchar) as {c}" for c in _ORDER_COLUMNS)
    + " from orders",
    "preview_limit": "select "
    + ", ".join(f"cast({c} as varchar) as {c}" for c in _ORDER_COLUMNS)
    + " from orders order by orders.o_orderkey limit 5",
    "cast_bigint_text": """
        select l_orderkey, l_linenumber,
          case l_orderkey % 5 when 0 then l_partkey || '' when 1 then l_partkey || '.0'
            when 2 then '-' || l_partkey || '.9' when 3 then l_partkey || 'e3'
            else l_partkey || 'x' end as written,
          cast(case l_orderkey % 5 when 2 then -l_partkey when 3 then l_partkey * 1000
            when 4 then null else l_partkey end as bigint) as whole from lineitem""",
    "timestamp_text_or_blank": """
        with days as (select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders)
        select o_orderkey,
          case o_orderkey % 4 when 0 then day || ' 10:20:30' when 1 then day when 2 then ''
            else 'x' || day end as written,
          case o_orderkey % 4 when 0 then day || ' 10:20:30' when 1 then day || ' 00:00:00'
            else '' end as moment from days""",
    "changed_records_silver": f"""
        with vendas_tmp as ({_CHANGED_SALES}) select {_SILVER["vendas"]} from vendas_tmp""",
    "full_run_sql_steps": f"with {_landing(*_COLUMNS)} "
    + " union all ".join(
        f"select '{t}' as name, {_strict_key(_COLUMNS[t])} as digest, 1 as taken from (select distinct * from {t}_tmp)"
        for t in _COLUMNS
    ),
    "merge_unmatched_copies": """
        select o_orderkey, o_custkey, o_totalprice from orders
        union all
        select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey % 2 = 1""",
    "merge_outer_checked": """
        select o_orderkey, case when o_orderkey % 3 = 1 then o_custkey else -o_custkey end
          as o_custkey, o_totalprice from orders""",
    "archived_landing": _bronze("vendas"),
    "cast_bigint_trunc": """
        select l_orderkey, l_extendedprice, cast(trunc(l_extendedprice) as bigint) as whole_price,
          cast(trunc(l_quantity) as bigint) as whole_quantity,
          cast(l_partkey as varchar) as part_text from lineitem""",
    "cast_money": """
        select l_orderkey, cast(l_extendedprice as decimal(38,2)) as price,
          cast(l_discount as decimal(38,2)) as discount, cast(l_tax as decimal(38,2)) as tax
        from lineitem""",
    "date_or_blank": _from_landing(
        "clientes", "v_id_cli, d_dt_nasc, coalesce(cast(d_dt_nasc as varchar), '') as born"
    ),
    "timestamp_or_blank": _from_landing(
        "pedidos",
        "n_id_pdd, coalesce(strftime(d_dt_entr_pdd, '%Y-%m-%d %H:%M:%S'), '') as delivered",
    ),
    "blank_if_null": _from_landing(
        "vendas",
        "n_id_vd_fil, coalesce(v_cli_cod, '') as client, coalesce(tp_pgt, '') as payment",
    ),
    "decode_gender": _from_landing(
        "clientes",
        """v_id_cli, v_sx_cli, case v_sx_cli when 'F' then 'Feminino'
           when 'M' then 'Masculino' else '' end as gender""",
    ),
    "decode_marital": _from_landing(
        "clientes",
        """v_id_cli, n_est_cvl, case n_est_cvl when 1 then 'Solteiro' when 2 then 'Casado'
           when 3 then 'Viúvo' when 4 then 'Desquitado' when 5 then 'Divorciado'
           when 6 then 'Outros' else '' end as marital_state""",
    ),
    "decode_channel": _from_landing(
        "pedidos",
        """n_id_pdd, case v_cnl_orig_pdd when 'L' then 'Loja' when 'A' then 'App'
           when 'S' then 'Site' end as channel""",
    ),
    "flag_from_sim": _from_landing(
        "vendas", "n_id_vd_fil, v_cpn_eml, coalesce(v_cpn_eml = 'SIM', false) as mailed"
    ),
    "flag_to_label": _from_landing(
        "clientes_opt",
        """v_id_cli, case when b_email then 'SIM' when not b_email then 'NÃO' else '' end as email,
           case when b_call then 'SIM' when not b_call then 'NÃO' else '' end as call,
           case when b_push then 'SIM' when not b_push then 'NÃO' else '' end as push,
           case when b_sms then 'SIM' when not b_sms then 'NÃO' else '' end as sms""",
    ),
    "classify_discount": _from_landing(
        "itens_vendas",
        """n_id_vd_fil, n_id_it, v_it_vd_conv, n_vlr_desc,
           case when v_it_vd_conv = 'SIM' then 'Convênio'
                when v_it_vd_conv = 'NAO' and n_vlr_desc > 0 then 'Promoção'
                else 'Sem Desconto' end as discount_type""",
    ),
    "with_audit_columns": f"select *, {_AUDIT} from customer",
    "normalize_temporal": "select *, cast(o_orderdate as date) as order_day from orders",
    "null_to_nan_count": """
        select o_orderstatus,
          cast(sum(case when o_orderpriority = '5-LOW' then 1 else 0 end) as bigint) as nan_prices,
          cast(0 as bigint) as null_prices, count(*) as orders
        from orders group by o_orderstatus""",
    "unprocessed_only": """
        select *, false as processed from orders where o_orderstatus <> 'F'""",
    "age_days365": _from_landing(
        "clientes",
        """v_id_cli, cast(trunc(date_diff('day', d_dt_nasc, date '2026-12-01') / 365.0)
           as integer) as age""",
    ),
    "age_calendar": _from_landing(
        "clientes",
        "v_id_cli, cast(date_sub('year', d_dt_nasc, date '2026-12-01') as integer) as age",
    ),
    "row_key_compat": f"""
        with {_landing("pedidos")}, priced as (
          select * replace (cast(n_vlr_tot_pdd as decimal(38,2)) as n_vlr_tot_pdd)
          from pedidos_tmp)
        select *, {_compat_key(_COLUMNS["pedidos"])} as hash_id from priced""",
    "row_key_all_columns": f"select *, {_strict_key(_LINE_COLUMNS)} as hash_id from lineitem",
    "row_key_business": _from_landing(
        "pedidos", f"n_id_pdd, {_compat_key(['n_id_pdd'])} as hash_id"
    ),
    "row_key_strict": _from_landing(
        "enderecos_clientes",
        "*, " + _strict_key(_COLUMNS["enderecos_clientes"], by_type=False) + " as hash_id",
    ),
    "dedupe_single_key": _first_line(
        "l_orderkey", "l_shipdate nulls first", ["l_orderkey", "l_shipdate"]
    ),
    "dedupe_composite_key": _first_line(
        "l_orderkey, l_linenumber",
        "l_extendedprice desc nulls last",
        ["l_orderkey", "l_linenumber"],
    ),
    "dedupe_compat_key": f"""
        with {_landing("enderecos_clientes")}, keyed as (
          select *, {_compat_key(_COLUMNS["enderecos_clientes"])} as hash_id
          from enderecos_clientes_tmp),
        ranked as (
          select *, row_number() over (partition by hash_id order by v_id_cli nulls first,
            n_sq_end nulls first, d_dt_exc nulls first, v_lcl nulls first, v_uf nulls first)
            as place
          from keyed)
        select * exclude (place) from ranked where place = 1""",
    "latest_version_per_key": """
        with ranked as (
          select *, row_number() over (partition by o_custkey
            order by o_orderdate desc nulls last, o_orderkey nulls first,
              o_orderstatus nulls first, o_totalprice nulls first, o_orderpriority nulls first)
            as place
          from orders)
        select * exclude (place) from ranked where place = 1""",
    "join_composite_key": f"""
        with {_silver_tables(("vendas", "itens_vendas"), False)}
        select * from itens_vendas join vendas using (codigo_filial, id_venda_filial)""",
    "join_concat_compat": f"""
        with {_silver_tables(("vendas", "itens_vendas"), False)}
        select iv.*, v.* exclude (codigo_filial, id_venda_filial)
        from itens_vendas iv join vendas v
          on cast(iv.codigo_filial as varchar) || cast(iv.id_venda_filial as varchar)
           = cast(v.codigo_filial as varchar) || cast(v.id_venda_filial as varchar)""",
    "join_single_key": f"""
        with {_silver_tables(("pedido_venda", "pedidos"), False)}
        select * from pedido_venda join pedidos using (id_pedido)""",
    "join_salted": """
        select l_orderkey, l_partkey, l_quantity, p_brand
        from lineitem join part on p_partkey = l_partkey""",
    "merge_upsert_all": _UPSERTED,
    "create_or_upsert_twice": _UPSERTED,
    "merge_upsert_delete": _UPSERTED_OR_DELETED,
    "upsert_stored_with_delete": _UPSERTED_OR_DELETED,
    "merge_schema_evolution": f"""
        with {_MERGE_SIDES}
        select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey,
          coalesce(s.o_custkey, t.o_custkey) as o_custkey,
          coalesce(s.o_totalprice, t.o_totalprice) as o_totalprice, t.origin,
          t.o_custkey % 7 as only_target, s.o_custkey % 5 as only_source
        from target t full join source s on s.o_orderkey = t.o_orderkey""",
    "merge_set_from_table": """
        select o_orderkey, o_custkey, o_orderstatus, o_orderstatus = 'F' as processed
        from orders""",
    "merge_set_from_frame": """
        with totals as (select l_orderkey, count(*) as lines from lineitem group by l_orderkey)
        select o_orderkey, o_custkey + coalesce(lines, 0) as o_custkey, o_orderstatus,
          coalesce(lines > 3, false) as processed
        from orders left join totals on l_orderkey = o_orderkey""",
    "merge_set_many": """
        select 'orders' as kind, o_orderkey as order_key, o_orderstatus = 'F' as processed
        from orders
        union all
        select 'lines', l_orderkey, o_orderstatus = 'F'
        from lineitem join orders on o_orderkey = l_orderkey""",
    "merge_null_key": f"""
        with {_landing("vendas")}, sales as (
          select v_cli_cod, coalesce(v_cpn_eml = 'SIM', false) as mailed, count(*) as sales
          from vendas_tmp group by all)
        select v_cli_cod, sales, mailed from sales
        where v_cli_cod is null or not mailed
          or v_cli_cod not in (
            select v_cli_cod from sales where not mailed and v_cli_cod is not null)""",
    "silver_clientes_with_age": _from_landing(
        "clientes",
        _SILVER["clientes"]
        + """, cast(trunc(date_diff('day', d_dt_nasc, date '2026-12-01') / 365.0) as integer)
          as idade""",
    ),
    "step_transform": f"""
        with {_landing("vendas")}, ranked as (
          select n_id_fil, n_id_vd_fil, d_dt_vd, n_vlr_tot_vd, row_number() over (
            partition by n_id_fil, n_id_vd_fil order by n_vlr_tot_vd, d_dt_vd) as place
          from vendas_tmp)
        select * exclude (place), {_AUDIT} from ranked where place = 1""",
    "gold_vendas_items": f"with {_silver_tables(_SALES, False)} {_GOLD_VENDAS_ROWS}",
    "gold_vendas_concat": f"""
        with {_silver_tables(_SALES, False)}
        select v.codigo_filial, v.id_venda_filial as codigo_cupom_venda, v.data_emissao,
          iv.codigo_item_venda as codigo_item, iv.valor_final_item as valor_unitario,
          iv.quantidade_itens as quantidade, v.codigo_cliente, iv.tipo_desconto, p.canal_venda
        from vendas v
        join pedido_venda pv
          on concat(pv.codigo_filial, pv.id_venda_filial)
           = concat(v.codigo_filial, v.id_venda_filial)
        join itens_vendas iv
          on concat(iv.codigo_filial, iv.id_venda_filial)
           = concat(v.codigo_filial, v.id_venda_filial)
        join pedidos p on p.id_pedido = pv.id_pedido""",
    "gold_vendas": _gold_vendas(distinct=False),
    "full_run_vendas": _gold_vendas(distinct=True),
    "gold_clientes_rows": f"""
        with {_silver_tables(_CLIENTS, False)} select {_GOLD_CLIENTES_COLUMNS}
        {_GOLD_CLIENTES_JOIN}""",
    "gold_clientes": _gold_clientes(distinct=False),
    "full_run_clientes": _gold_clientes(distinct=True),
    "run_report": f"""
        with {_silver_tables(_SALES, True)}, loaded as (
          select 'vendas' as "table", count(*) as n from vendas
          union all select 'itens_vendas', count(*) from itens_vendas
          union all select 'pedido_venda', count(*) from pedido_venda
          union all select 'pedidos', count(*) from pedidos),
        coupons as (
          select distinct codigo_filial, codigo_cupom_venda from ({_GOLD_VENDAS_ROWS}))
        select "table", layer, 'ok' as status, n as "rows", '' as reason
        from loaded cross join (values ('bronze'), ('silver')) as layers(layer)
        union all select 'vendas', 'gold', 'ok', count(*), '' from coupons""",
    "bronze_marked_processed": _bronze(
        "pedidos", f'true as processed, {_CREATED} as "creationDate"'
    ),
    "rerun_incremental": _silver("itens_vendas"),
    "partitioned_batches": _silver("vendas"),
    "gold_write_back": f"""
        with {_silver_tables(_SALES, True)}, coupons as (
          select distinct codigo_filial, codigo_cupom_venda from ({_GOLD_VENDAS_ROWS}))
        select v.codigo_filial, v.id_venda_filial, c.codigo_filial is not null as processed
        from vendas v left join coupons c
          on c.codigo_filial = v.codigo_filial and c.codigo_cupom_venda = v.id_venda_filial""",
    "landing_stream_ingest": _bronze("vendas"),
    "user_sql_groupby": f"""
        with {_silver_tables(("itens_vendas",), False)}
        select tipo_desconto, com_receita_eletronica, count(*) as itens,
          sum(valor_final_item) as total, cast(sum(quantidade_itens) as bigint) as quantidade
        from itens_vendas group by tipo_desconto, com_receita_eletronica""",
    "user_sql_window": f"""
        with {_silver_tables(("vendas",), False)}, ranked as (
          select codigo_cliente, id_venda_filial, valor_total_venda,
            cast(row_number() over (partition by codigo_cliente
              order by valor_total_venda desc, id_venda_filial) as integer) as posicao
          from vendas)
        select * from ranked where posicao <= 3""",
    "user_sql_union": f"""
        with {_silver_tables(("enderecos_clientes", "pedidos"), False)}
        select cidade_endereco as cidade from enderecos_clientes
        union select cidade_entrega from pedidos
        except select '' as cidade""",
}
for _table in LANDING_SQL:
    ORACLES[f"bronze_{_table}"] = _bronze(_table)
    ORACLES[f"silver_{_table}"] = _silver(_table)
    ORACLES[f"stored_bronze_{_table}"] = _bronze(
        _table, f'true as processed, {_CREATED} as "creationDate"'
    )
    ORACLES[f"stored_silver_{_table}"] = _silver(_table)
# An item that a sale holds twice is one record; both were taken at once, so the first by its
# other columns stays.
_ITEMS = "(select distinct * from itens_vendas_tmp) as landing_rows"
ORACLES["changed_records_gold"] = (
    _gold_vendas(distinct=True)
    .replace(LANDING_SQL["vendas"], _CHANGED_SALES)
    .replace(
        _ITEMS,
        _ITEMS
        + """ qualify row_number() over (
            partition by codigo_filial, id_venda_filial, codigo_item_venda
            order by com_receita_eletronica, tipo_desconto, valor_pis_item, valor_final_item,
              valor_desconto_item, quantidade_itens) = 1""",
    )
)
