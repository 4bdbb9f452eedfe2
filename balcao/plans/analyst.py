"""The twenty analyst questions. Ordering is part of the answer; ties are broken by key so limits are repeatable."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao.functions.columns import pct
from balcao.functions.lineage import write_intermediate
from balcao.plans import views
from balcao.sources.warehouse import Warehouse

c = F.col


def latest_month_rows(df: DataFrame) -> DataFrame:
    """Rows of the newest month. The ``= 1`` filter on a rank is applied per task before the exchange, so only
    candidate rows of the newest month reach the final task."""
    recente = Window.orderBy(c("ano").desc(), c("mes").desc())
    return df.withColumn("_r", F.rank().over(recente)).where("_r = 1").drop("_r")


def last_twelve_months(wh: Warehouse) -> DataFrame:
    return views.monthly_revenue(wh).orderBy(c("ano").desc(), c("mes").desc()).limit(12)


def latest_store_ranking(wh: Warehouse) -> DataFrame:
    return latest_month_rows(views.store_revenue(wh)).orderBy("ranking", "loja_id")


def newest_top_products(wh: Warehouse, posicao: str, limite: int) -> DataFrame:
    """The first ``limite`` rows of the monthly product ranks, newest month first. Months are ranked one by one from the newest until
    the rows are complete, so older ones are neither read nor ranked."""
    partes, linhas = [], 0
    for competencia in wh.months():
        do_mes = write_intermediate(views.top_products(wh, competencia=competencia), "top_do_mes")
        partes.append(do_mes)
        linhas += do_mes.count()
        if linhas >= limite:
            break
    todas = reduce(DataFrame.unionByName, partes) if partes else views.top_products(wh, competencia=(0, 0))
    return todas.orderBy(c("ano").desc(), c("mes").desc(), posicao, "produto_id").limit(limite)


def top_by_revenue(wh: Warehouse, limite: int = 10) -> DataFrame:
    return newest_top_products(wh, "ranking_receita", limite)


def top_by_volume(wh: Warehouse, limite: int = 10) -> DataFrame:
    return newest_top_products(wh, "ranking_volume", limite)


def ticket_by_store(wh: Warehouse) -> DataFrame:
    return views.store_ticket(wh).orderBy(c("ano").desc(), c("mes").desc(), "loja_id")


def _completed_revenue(wh: Warehouse, coluna: str) -> DataFrame:
    return (
        wh.fato(coluna, "status", "valor_liquido")
        .where("status = 'CONCLUIDA'")
        .groupBy(coluna)
        .agg(F.sum("valor_liquido").alias("receita"))
        .orderBy(c("receita").desc(), coluna)
    )


def revenue_by_channel(wh: Warehouse) -> DataFrame:
    return _completed_revenue(wh, "canal_venda")


def revenue_by_payment(wh: Warehouse) -> DataFrame:
    return _completed_revenue(wh, "forma_pagamento")


def cancellation_by_store(wh: Warehouse) -> DataFrame:
    return (
        wh.fato("loja_id", "status")
        .groupBy("loja_id")
        .agg(pct(F.count_if(c("status") == "CANCELADA"), F.count("*")).alias("cancelamento_pct"))
        .orderBy(c("cancelamento_pct").desc(), "loja_id")
    )


def target_vs_actual(wh: Warehouse) -> DataFrame:
    return views.target_vs_actual(wh.shared("faturamento")).orderBy("ano", "mes", "loja_id")


def latest_dre(wh: Warehouse) -> DataFrame:
    return latest_month_rows(wh.dre()).orderBy("loja_id")


def store_margin(wh: Warehouse) -> DataFrame:
    return (
        wh.loja_mes("margem_bruta", "faturamento")
        .select(
            "ano", "mes", "loja_id", "margem_bruta", pct(c("margem_bruta"), c("faturamento")).alias("margem_pct")
        )
        .orderBy("ano", "mes", "loja_id")
    )


def network_margin(wh: Warehouse) -> DataFrame:
    return (
        wh.fato("ano", "mes", "status", "valor_liquido", "margem_bruta")
        .where("status = 'CONCLUIDA'")
        .groupBy("ano", "mes")
        .agg(pct(F.sum("margem_bruta"), F.sum("valor_liquido")).alias("margem_pct"))
        .orderBy("ano", "mes")
    )


def store_growth(wh: Warehouse) -> DataFrame:
    return views.store_revenue(wh).select("ano", "mes", "loja_id", "crescimento_mom").orderBy("ano", "mes", "loja_id")


def store_share(wh: Warehouse) -> DataFrame:
    return views.store_revenue(wh).select("ano", "mes", "loja_id", "market_share_pct").orderBy("ano", "mes", "loja_id")


def most_discounted(wh: Warehouse, limite: int = 10) -> DataFrame:
    """Mean discount percentage per product, summed exactly so the order of rows cannot change it."""
    exato = c("desconto_pct_calc").cast("decimal(7,2)")
    return (
        wh.fato("produto_id", "status", "desconto_pct_calc")
        .where("status = 'CONCLUIDA'")
        .groupBy("produto_id")
        .agg((F.sum(exato).cast("double") / F.count("*")).alias("desconto_medio_pct"))
        .orderBy(c("desconto_medio_pct").desc(), "produto_id")
        .limit(limite)
    )


def revenue_by_segment(wh: Warehouse) -> DataFrame:
    """Totals per customer come first, so the customer join sees one row per customer."""
    por_cliente = (
        wh.fato("cliente_id", "status", "valor_liquido")
        .where("status = 'CONCLUIDA'")
        .groupBy("cliente_id")
        .agg(F.sum("valor_liquido").alias("receita"))
    )
    return (
        por_cliente.join(wh.dim_cliente().select("cliente_id", "segmento"), "cliente_id")
        .groupBy("segmento")
        .agg(F.sum("receita").alias("receita"))
        .orderBy(c("receita").desc(), "segmento")
    )


def revenue_by_period(wh: Warehouse) -> DataFrame:
    return (
        wh.fato("periodo", "status", "id_venda", "valor_liquido")
        .where("status = 'CONCLUIDA'")
        .groupBy("periodo")
        .agg(F.count_distinct("id_venda").alias("pedidos"), F.sum("valor_liquido").alias("receita"))
        .orderBy(c("receita").desc(), "periodo")
    )


def year_over_year(wh: Warehouse) -> DataFrame:
    """Same month of the year before, found by window over the month instead of a second aggregation: a RANGE frame of
    exactly one year back."""
    ano_anterior = Window.partitionBy("mes").orderBy("ano").rangeBetween(-1, -1)
    return (
        wh.fato("ano", "mes", "status", "valor_liquido")
        .where("status = 'CONCLUIDA'")
        .groupBy("ano", "mes")
        .agg(F.sum("valor_liquido").alias("receita"))
        .withColumn("receita_ano_anterior", F.max("receita").over(ano_anterior))
        .withColumn(
            "crescimento_yoy_pct", pct(c("receita") - c("receita_ano_anterior"), c("receita_ano_anterior"))
        )
    )


def month_forecast(wh: Warehouse) -> DataFrame:
    return (
        views.fpa_view(wh)
        .select("ano", "mes", "loja_id", "forecast_mes", "run_rate_anual")
        .orderBy(c("ano").desc(), c("mes").desc(), "loja_id")
    )


def approval_by_date(wh: Warehouse) -> DataFrame:
    return (
        wh.auditoria()
        .groupBy("data_referencia")
        .agg(
            F.sum("registros_lidos").alias("lidos"),
            F.sum("registros_invalidos").alias("invalidos"),
            pct(F.sum("registros_validos"), F.sum("registros_lidos")).alias("aprovacao_pct"),
        )
        .orderBy(c("data_referencia").desc())
    )
