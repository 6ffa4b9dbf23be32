"""The retail lake: seven source tables and two gold tables.

Column names, codes and labels are the model's own and stay in its language.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import (
    age_days365,
    blank_if_null,
    date_or_blank,
    decode_map,
    flag_from,
    flag_label,
    money,
    row_key_for,
    timestamp_or_blank,
    to_bigint,
)
from sedimenta.operators.audit import CREATED
from sedimenta.operators.dedupe import dedupe, distinct_keys
from sedimenta.operators.joins import join_on_concat, join_skewed
from sedimenta.plans.spec import GoldSpec, StepSpec, TableSpec
from sedimenta.sources.landing import LandingFormat

# Landing columns of each table.
LANDING_COLUMNS = {
    "clientes": ["v_id_cli", "d_dt_nasc", "v_sx_cli", "n_est_cvl"],
    "clientes_opt": ["b_call", "b_email", "b_push", "b_sms", "v_id_cli"],
    "enderecos_clientes": ["v_id_cli", "n_sq_end", "d_dt_exc", "v_lcl", "v_uf"],
    "itens_vendas": [
        "n_id_fil",
        "n_id_vd_fil",
        "n_id_it",
        "v_rc_elt",
        "v_it_vd_conv",
        "n_vlr_pis",
        "n_vlr_vd",
        "n_vlr_desc",
        "n_qtd",
    ],
    "pedidos": [
        "n_id_pdd",
        "d_dt_eft_pdd",
        "d_dt_entr_pdd",
        "v_cnl_orig_pdd",
        "v_uf_entr_pdd",
        "v_lc_ent_pdd",
        "n_vlr_tot_pdd",
    ],
    "pedido_venda": ["n_id_fil", "n_id_vd_fil", "n_id_pdd"],
    "vendas": [
        "d_dt_vd",
        "n_id_fil",
        "n_id_vd_fil",
        "v_cli_cod",
        "n_vlr_tot_vd",
        "n_vlr_tot_desc",
        "v_cpn_eml",
        "tp_pgt",
    ],
}

# Codes and labels.
GENDERS = {"F": "Feminino", "M": "Masculino"}
MARITAL_STATES = {
    1: "Solteiro",
    2: "Casado",
    3: "Viúvo",
    4: "Desquitado",
    5: "Divorciado",
    6: "Outros",
}
CHANNELS = {"L": "Loja", "A": "App", "S": "Site"}
AGREEMENT = "Convênio"
PROMOTION = "Promoção"
NO_DISCOUNT = "Sem Desconto"

SALE = ["codigo_filial", "id_venda_filial"]
COUPON = ["codigo_filial", "codigo_cupom_venda"]
CLIENT = "codigo_cliente"


def bronze(table: str, df: DataFrame, key_mode: str = "strict") -> DataFrame:
    """The landing columns plus the row key over all of them."""
    rows = df.select(*LANDING_COLUMNS[table])
    return rows.select("*", row_key_for(rows, mode=key_mode).alias("hash_id"))


def bronze_distinct(table: str, df: DataFrame) -> DataFrame:
    """``bronze`` with one row per strict key.

    Equal strict keys are equal rows, so the rows are made distinct before they get their
    key: the shuffle carries no keys, and a row with many copies leaves each map task once.
    """
    return bronze(table, df.select(*LANDING_COLUMNS[table]).distinct())


def discount_type(agreement: str, discount: str) -> Column:
    """Agreement sale, promotion (no agreement but a discount), or neither."""
    has_discount = F.col(discount).try_cast("double") > 0
    return (
        F.when(F.col(agreement) == "SIM", F.lit(AGREEMENT))
        .when((F.col(agreement) == "NAO") & has_discount, F.lit(PROMOTION))
        .otherwise(F.lit(NO_DISCOUNT))
    )


def silver_clientes(df: DataFrame, keep: Sequence[str] = ("hash_id",)) -> DataFrame:
    return df.select(
        F.col("v_id_cli").cast("string").alias("codigo_cliente"),
        date_or_blank("d_dt_nasc").alias("data_nascimento_cliente"),
        decode_map("v_sx_cli", GENDERS, "").alias("genero_biologico_cliente"),
        decode_map("n_est_cvl", MARITAL_STATES, "").alias("estado_civil_cliente"),
        *keep,
    )


def silver_clientes_idade(df: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """``silver_clientes`` with the age in it."""
    return df.select(
        F.col("v_id_cli").cast("string").alias("codigo_cliente"),
        date_or_blank("d_dt_nasc").alias("data_nascimento_cliente"),
        age_days365("d_dt_nasc", as_of).alias("idade"),
        decode_map("v_sx_cli", GENDERS, "").alias("genero_biologico_cliente"),
        decode_map("n_est_cvl", MARITAL_STATES, "").alias("estado_civil_cliente"),
    )


def silver_clientes_opt(df: DataFrame, keep: Sequence[str] = ("hash_id",)) -> DataFrame:
    return df.select(
        F.col("v_id_cli").cast("string").alias("codigo_cliente"),
        flag_label("b_push").alias("autoriza_notificacao_push"),
        flag_label("b_sms").alias("autoriza_notificacao_sms"),
        flag_label("b_email").alias("autoriza_notificacao_email"),
        flag_label("b_call").alias("autoriza_notificacao_ligacao"),
        *keep,
    )


def silver_enderecos_clientes(df: DataFrame, keep: Sequence[str] = ("hash_id",)) -> DataFrame:
    return df.select(
        F.col("v_id_cli").cast("string").alias("codigo_cliente"),
        to_bigint("n_sq_end").alias("sequencia_endereco_cliente"),
        timestamp_or_blank("d_dt_exc").alias("data_exclusao_endereco"),
        F.col("v_lcl").cast("string").alias("cidade_endereco"),
        F.col("v_uf").cast("string").alias("UF_endereco"),
        *keep,
    )


def silver_itens_vendas(df: DataFrame, keep: Sequence[str] = ("hash_id",)) -> DataFrame:
    return df.select(
        to_bigint("n_id_fil").alias("codigo_filial"),
        to_bigint("n_id_vd_fil").alias("id_venda_filial"),
        to_bigint("n_id_it").alias("codigo_item_venda"),
        flag_from("v_rc_elt").alias("com_receita_eletronica"),
        discount_type("v_it_vd_conv", "n_vlr_desc").alias("tipo_desconto"),
        money("n_vlr_pis").alias("valor_pis_item"),
        money("n_vlr_vd").alias("valor_final_item"),
        money("n_vlr_desc").alias("valor_desconto_item"),
        to_bigint("n_qtd").alias("quantidade_itens"),
        *keep,
    )


def silver_pedidos(df: DataFrame, keep: Sequence[str] = ("hash_id",)) -> DataFrame:
    return df.select(
        to_bigint("n_id_pdd").alias("id_pedido"),
        date_or_blank("d_dt_eft_pdd").alias("data_realizacao_pedido"),
        timestamp_or_blank("d_dt_entr_pdd").alias("data_entrega"),
        decode_map("v_cnl_orig_pdd", CHANNELS).alias("canal_venda"),
        blank_if_null("v_uf_entr_pdd").alias("UF_pedido"),
        blank_if_null("v_lc_ent_pdd").alias("cidade_entrega"),
        money("n_vlr_tot_pdd").alias("valor_total_pedido"),
        *keep,
    )


def silver_pedido_venda(df: DataFrame, keep: Sequence[str] = ("hash_id",)) -> DataFrame:
    return df.select(
        to_bigint("n_id_fil").alias("codigo_filial"),
        to_bigint("n_id_vd_fil").alias("id_venda_filial"),
        to_bigint("n_id_pdd").alias("id_pedido"),
        *keep,
    )


def silver_vendas(df: DataFrame, keep: Sequence[str] = ("hash_id",)) -> DataFrame:
    return df.select(
        timestamp_or_blank("d_dt_vd").alias("data_emissao"),
        to_bigint("n_id_fil").alias("codigo_filial"),
        to_bigint("n_id_vd_fil").alias("id_venda_filial"),
        blank_if_null("v_cli_cod").alias("codigo_cliente"),
        money("n_vlr_tot_vd").alias("valor_total_venda"),
        money("n_vlr_tot_desc").alias("valor_total_desconto"),
        flag_from("v_cpn_eml").alias("enviado_email"),
        blank_if_null("tp_pgt").alias("tipo_pagamento"),
        *keep,
    )


SILVER = {
    "clientes": silver_clientes,
    "clientes_opt": silver_clientes_opt,
    "enderecos_clientes": silver_enderecos_clientes,
    "itens_vendas": silver_itens_vendas,
    "pedidos": silver_pedidos,
    "pedido_venda": silver_pedido_venda,
    "vendas": silver_vendas,
}


#: What makes two silver rows versions of one record.
RECORD = {
    "clientes": (CLIENT,),
    "clientes_opt": (CLIENT,),
    "enderecos_clientes": (CLIENT, "sequencia_endereco_cliente"),
    "itens_vendas": (*SALE, "codigo_item_venda"),
    "pedidos": ("id_pedido",),
    "pedido_venda": (*SALE, "id_pedido"),
    "vendas": tuple(SALE),
}


def _sale_headers(silver: Mapping[str, DataFrame]) -> DataFrame:
    """One row per sale and order. All three inputs have a row per sale or order, so this
    stays far smaller than the items."""
    sales = silver["vendas"].select(*SALE, "data_emissao", "codigo_cliente")
    links = silver["pedido_venda"].select(*SALE, "id_pedido")
    orders = silver["pedidos"].select("id_pedido", "canal_venda")
    return sales.join(links, SALE).join(orders, "id_pedido").drop("id_pedido")


def _sale_items(silver: Mapping[str, DataFrame]) -> DataFrame:
    return silver["itens_vendas"].select(
        *SALE, "codigo_item_venda", "valor_final_item", "quantidade_itens", "tipo_desconto"
    )


def _gold_vendas_columns(joined: DataFrame) -> DataFrame:
    return joined.select(
        "codigo_filial",
        F.col("id_venda_filial").alias("codigo_cupom_venda"),
        "data_emissao",
        F.col("codigo_item_venda").alias("codigo_item"),
        F.col("valor_final_item").alias("valor_unitario"),
        F.col("quantidade_itens").alias("quantidade"),
        "codigo_cliente",
        "tipo_desconto",
        "canal_venda",
    )


def gold_vendas_items(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Sales at item grain.

    The small tables are joined first and the items last, so the items are shuffled once
    and not once per join. The last join has both inputs fresh from a shuffle, which lets
    AQE split a sale that holds very many items.
    """
    return _gold_vendas_columns(_sale_items(silver).join(_sale_headers(silver), SALE))


def gold_vendas(silver: Mapping[str, DataFrame]) -> DataFrame:
    """One row per coupon: its first item and its first order.

    Within a coupon the joins pair every sale with every order and every item, so the first
    row is the first sale with the first order and the first item. Each of the three is
    therefore cut to one row per coupon before the joins, on the map side, and versions of a
    sale do not multiply its orders; the joins find all three partitioned already.
    """
    sales = dedupe(silver["vendas"].select(*SALE, "data_emissao", "codigo_cliente"), SALE)
    links = silver["pedido_venda"].select(*SALE, "id_pedido")
    kinds = silver["pedidos"].select("id_pedido", "canal_venda")
    orders = dedupe(links.join(kinds, "id_pedido").drop("id_pedido"), SALE)
    items = dedupe(_sale_items(silver), SALE)
    return _gold_vendas_columns(items.join(sales, SALE).join(orders, SALE))


def gold_vendas_concat(silver: Mapping[str, DataFrame]) -> DataFrame:
    """``gold_vendas_items`` joined on concatenated key text, as older jobs wrote it."""
    sales = silver["vendas"].select(*SALE, "data_emissao", "codigo_cliente")
    links = silver["pedido_venda"].select(*SALE, "id_pedido")
    orders = silver["pedidos"].select("id_pedido", "canal_venda")
    headers = join_on_concat(sales, links, SALE).join(orders, "id_pedido").drop("id_pedido")
    return _gold_vendas_columns(join_on_concat(headers, _sale_items(silver), SALE))


def _profiles(silver: Mapping[str, DataFrame], one_each: bool) -> DataFrame:
    clients = silver["clientes"].select(
        CLIENT, "data_nascimento_cliente", "genero_biologico_cliente", "estado_civil_cliente"
    )
    consents = silver["clientes_opt"].select(
        CLIENT,
        "autoriza_notificacao_ligacao",
        "autoriza_notificacao_sms",
        "autoriza_notificacao_email",
        "autoriza_notificacao_push",
    )
    if one_each:
        clients, consents = dedupe(clients, CLIENT), dedupe(consents, CLIENT)
    return clients.join(consents, CLIENT)


def _gold_clientes_columns(joined: DataFrame, as_of: dt.date | str | None) -> DataFrame:
    return joined.select(
        CLIENT,
        F.col("data_nascimento_cliente").alias("data_nascimento"),
        age_days365("data_nascimento_cliente", as_of).alias("idade"),
        F.col("genero_biologico_cliente").alias("sexo"),
        F.col("UF_endereco").alias("uf"),
        F.col("cidade_endereco").alias("cidade"),
        F.col("estado_civil_cliente").alias("estado_civil"),
        F.col("autoriza_notificacao_ligacao").alias("flag_lgpd_call"),
        F.col("autoriza_notificacao_sms").alias("flag_lgpd_sms"),
        F.col("autoriza_notificacao_email").alias("flag_lgpd_email"),
        F.col("autoriza_notificacao_push").alias("flag_lgpd_push"),
    )


def gold_clientes_rows(
    silver: Mapping[str, DataFrame], as_of: dt.date | str | None = None, salts: int = 1
) -> DataFrame:
    """Clients once per address. Both joins share one partitioning, where AQE cannot split a
    client with very many addresses; ``salts`` above 1 spreads such clients, if the
    addresses come straight from a table."""
    addresses = silver["enderecos_clientes"].select(CLIENT, "UF_endereco", "cidade_endereco")
    joined = join_skewed(addresses, _profiles(silver, one_each=False), CLIENT, salts)
    return _gold_clientes_columns(joined, as_of)


def gold_clientes(
    silver: Mapping[str, DataFrame], as_of: dt.date | str | None = None
) -> DataFrame:
    """One row per client, with the address of the lowest sequence number. Each input is cut
    to one row per client before the joins, which then all share that partitioning."""
    addresses = dedupe(
        silver["enderecos_clientes"].select(
            CLIENT, "sequencia_endereco_cliente", "UF_endereco", "cidade_endereco"
        ),
        CLIENT,
        ["sequencia_endereco_cliente"],
    )
    return _gold_clientes_columns(
        _profiles(silver, one_each=True).join(addresses, CLIENT), as_of
    )


def touched_sales(changes: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]) -> DataFrame:
    """The coupons whose sale, items or orders changed. An order is found by its links; a link
    that is gone is among the changes itself."""
    direct = [changes[t].select(*SALE) for t in ("vendas", "itens_vendas", "pedido_venda")]
    orders = changes["pedidos"].select("id_pedido").distinct()
    linked = silver["pedido_venda"].join(orders, "id_pedido", "left_semi").select(*SALE)
    return reduce(DataFrame.unionByName, [*direct, linked]).toDF(*COUPON)


def narrow_sales(silver: Mapping[str, DataFrame], coupons: DataFrame) -> dict[str, DataFrame]:
    """The silver rows of some coupons: semi joins on their keys, which reach the scans."""
    keys = coupons.select(*COUPON).toDF(*SALE)
    cut = {t: silver[t].join(keys, SALE, "left_semi") for t in ("vendas", "itens_vendas", "pedido_venda")}
    orders = distinct_keys(cut["pedido_venda"], ["id_pedido"])
    return {**cut, "pedidos": silver["pedidos"].join(orders, "id_pedido", "left_semi")}


def touched_clients(changes: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [c.select(CLIENT) for c in changes.values()])


def narrow_clients(silver: Mapping[str, DataFrame], clients: DataFrame) -> dict[str, DataFrame]:
    return {t: df.join(clients.select(CLIENT), CLIENT, "left_semi") for t, df in silver.items()}


def table_specs(
    key_mode: str = "strict",
    landing: Mapping[str, LandingFormat] | None = None,
    newest: bool = False,
    tracks: str = "flag",
) -> list[TableSpec]:
    """The seven source tables, in load order.

    With ``newest`` silver holds the newest version of each record (``RECORD``), by the
    ``creationDate`` of bronze, so a correction replaces what it corrects, in gold too. Bronze
    keeps every version. Archive or replace landing files then: old ones read again are new.

    With strict keys bronze holds each key once and the silver steps map rows one to one,
    so silver needs no dedupe. Compat keys can be NULL and collapse rows, in both steps.
    """
    formats = {"clientes_opt": LandingFormat(format_in="json"), **(landing or {})}
    strict = key_mode == "strict"
    return [
        TableSpec(
            name=name,
            bronze=StepSpec(
                partial(bronze_distinct, name)
                if strict
                else partial(bronze, name, key_mode=key_mode),
                distinct=strict,
                unchecked=strict,
            ),
            silver=StepSpec(partial(SILVER[name], keep=("hash_id", CREATED)), merge_key=RECORD[name], one_to_one=strict)
            if newest
            else StepSpec(SILVER[name], distinct=strict, unchecked=strict, one_to_one=True),
            landing=formats.get(name, LandingFormat()),
            tracks=tracks,
        )
        for name in LANDING_COLUMNS
    ]


def gold_specs(as_of: dt.date | str | None = None, newest: bool = False) -> list[GoldSpec]:
    """The two gold tables. ``as_of`` is the day ages are taken at; today by default. ``newest``
    as in ``table_specs``: it decides by what silver rows are known."""
    silver_keys = RECORD if newest else {t: ("hash_id",) for t in RECORD}
    return [
        GoldSpec(
            name="vendas",
            tables=("vendas", "itens_vendas", "pedido_venda", "pedidos"),
            build=gold_vendas,
            key=COUPON,
            distinct=True,
            input_keys=silver_keys,
            touched=touched_sales,
            narrow=narrow_sales,
        ),
        GoldSpec(
            name="clientes",
            tables=("clientes", "clientes_opt", "enderecos_clientes"),
            build=partial(gold_clientes, as_of=as_of),
            key=(CLIENT,),
            distinct=True,
            input_keys=silver_keys,
            touched=touched_clients,
            narrow=narrow_clients,
            stamp=str(as_of or dt.date.today()),
        ),
    ]
