"""Monthly Gold marts: KPIs, managerial P&L and planning indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao.functions.columns import days_in_month, distinct_days, month_label, pct, pct2, ratio, rounded
from balcao.functions.lineage import write_intermediate
from balcao.operators.ranking import spread_ranks
from balcao.params import PADRAO, Params

DINHEIRO_MART = "decimal(15,2)"


def _completed(silver: DataFrame) -> DataFrame:
    return silver.where("status = 'CONCLUIDA'")


def kpi_summary(silver: DataFrame) -> DataFrame:
    """Network KPIs per month."""
    return summary_lines(
        _completed(silver)
        .groupBy("ano", "mes")
        .agg(
            F.sum("valor_liquido").alias("faturamento_total"),
            F.sum("valor_bruto").alias("receita_bruta"),
            F.sum("desconto_valor").alias("desconto_total"),
            F.sum("quantidade").alias("quantidade_total"),
            F.count_distinct("id_venda").alias("total_pedidos"),
            F.sum("margem_bruta").alias("margem_bruta"),
        )
    )


def summary_lines(totais: DataFrame) -> DataFrame:
    """Month label, ticket and margin next to network totals."""
    return totais.withColumns(
        {
            "competencia": month_label(F.col("ano"), F.col("mes")),
            "ticket_medio": rounded(ratio(F.col("faturamento_total"), F.col("total_pedidos"))),
            "margem_bruta_pct": pct2(F.col("margem_bruta"), F.col("faturamento_total")),
        }
    )


def kpi_stores(silver: DataFrame) -> DataFrame:
    """KPIs per store-month with the share of the network and a dense rank."""
    return store_lines(
        _completed(silver)
        .groupBy("ano", "mes", "loja_id", "loja_nome")
        .agg(
            F.sum("valor_liquido").alias("faturamento"),
            F.count_distinct("id_venda").alias("pedidos"),
            F.sum("quantidade").alias("quantidade"),
            F.sum("margem_bruta").alias("margem_bruta"),
        )
    )


def store_lines(totais: DataFrame) -> DataFrame:
    """Shares, ranks and ratios next to the totals of every store-month."""
    mes = Window.partitionBy("ano", "mes")
    return totais.withColumns(
        {
            "competencia": month_label(F.col("ano"), F.col("mes")),
            "ticket_medio": rounded(ratio(F.col("faturamento"), F.col("pedidos"))),
            "market_share_pct": pct2(F.col("faturamento"), F.sum("faturamento").over(mes)),
            "ranking_receita": F.dense_rank().over(mes.orderBy(F.col("faturamento").desc())),
            "margem_bruta_pct": pct2(F.col("margem_bruta"), F.col("faturamento")),
        }
    )


def kpi_products(silver: DataFrame, *grupo: str) -> DataFrame:
    """Revenue and volume per product with two dense ranks across all products of the input, or of each ``grupo``
    (year and month) when several months are given at once."""
    return product_lines(
        _completed(silver)
        .groupBy(*grupo, "produto_id", "produto_nome", "categoria")
        .agg(F.sum("valor_liquido").alias("faturamento"), F.sum("quantidade").alias("volume")),
        *grupo,
    )


def product_lines(totais: DataFrame, *grupo: str) -> DataFrame:
    """Two dense ranks next to the totals of every product."""
    return spread_ranks(
        write_intermediate(totais, "kpi_produtos"), grupo, {"ranking_receita": "faturamento", "ranking_volume": "volume"}, dense=True
    )


def dre_totals(silver: DataFrame) -> DataFrame:
    return (
        _completed(silver)
        .groupBy("loja_id", "ano", "mes")
        .agg(
            F.sum("valor_bruto").alias("receita_bruta"),
            F.sum("desconto_valor").alias("descontos"),
            F.sum("custo_total").alias("cmv"),
        )
    )


def dre_lines(totais: DataFrame, por_loja: DataFrame, params: Params = PADRAO) -> DataFrame:
    """P&L lines from store-month totals. ``por_loja`` holds fixed cost and depreciation (one row per store); a store
    without parameters keeps NULL from the fixed cost down. Amounts stay exact until the final rounding."""
    c = F.col
    linhas = totais.join(F.broadcast(por_loja), "loja_id", "left")
    etapas = (
        ("impostos", c("receita_bruta") * F.lit(params.taxa_imposto)),
        ("receita_liquida", c("receita_bruta") - c("descontos") - c("impostos")),
        ("lucro_bruto", c("receita_liquida") - c("cmv")),
        ("despesas_variaveis", c("receita_liquida") * F.lit(params.taxa_despesa_variavel)),
        ("ebitda", c("lucro_bruto") - c("despesas_variaveis") - c("despesas_fixas")),
        ("ebit", c("ebitda") - c("depreciacao")),
        (
            "despesas_financeiras",
            F.when(c("ebit") > 0, c("ebit") * F.lit(params.taxa_financeira)).when(
                c("ebit").isNotNull(), F.lit(0).cast("int")
            ),
        ),
        ("resultado_antes_ir", c("ebit") - c("despesas_financeiras")),
        ("margem_bruta_pct", pct2(c("lucro_bruto"), c("receita_liquida"))),
        ("margem_ebitda_pct", pct2(c("ebitda"), c("receita_liquida"))),
        ("margem_liquida_pct", pct2(c("resultado_antes_ir"), c("receita_liquida"))),
    )
    for nome, expressao in etapas:
        linhas = linhas.withColumn(nome, expressao)
    valores = (
        "receita_bruta", "descontos", "impostos", "receita_liquida", "cmv", "lucro_bruto", "despesas_variaveis",
        "despesas_fixas", "ebitda", "depreciacao", "ebit", "despesas_financeiras", "resultado_antes_ir",
    )
    return linhas.select(
        "loja_id",
        "ano",
        "mes",
        *[F.round(v, 2).cast(DINHEIRO_MART).alias(v) for v in valores],
        "margem_bruta_pct",
        "margem_ebitda_pct",
        "margem_liquida_pct",
    )


def dre(silver: DataFrame, por_loja: DataFrame, params: Params = PADRAO) -> DataFrame:
    return dre_lines(dre_totals(silver), por_loja, params)


def fpa_totals(silver: DataFrame) -> DataFrame:
    return (
        _completed(silver)
        .groupBy("loja_id", "ano", "mes")
        .agg(
            F.sum("valor_liquido").alias("receita_realizada"),
            F.sum("margem_bruta").alias("margem_bruta"),
            distinct_days(F.day("data_venda")).alias("dias_com_venda"),
        )
    )


def fpa_indicators(orcamento: DataFrame, totais: DataFrame, params: Params = PADRAO) -> DataFrame:
    """Budget against actual per store-month. Budgeted stores without sales stay with zeros; ranks are dense and run
    inside each month."""
    c = F.col
    atingido = ratio(c("receita_realizada"), c("receita_orcada"))
    margem = pct(
        c("margem_bruta"), F.when(c("receita_realizada") == 0, F.lit(1)).otherwise(c("receita_realizada"))
    )
    dias = F.when(c("dias_com_venda") == 0, F.lit(1)).otherwise(c("dias_com_venda"))
    previsao = ratio(c("receita_realizada"), dias) * days_in_month(c("ano"), c("mes"))
    mes = Window.partitionBy("ano", "mes")

    def posicao(coluna):
        return F.dense_rank().over(mes.orderBy(coluna.desc()))

    unido = orcamento.join(totais, ["loja_id", "ano", "mes"], "left").na.fill(
        0, ["receita_realizada", "margem_bruta", "dias_com_venda"]
    )
    return unido.select(
        "loja_id",
        "ano",
        "mes",
        F.round("receita_orcada", 2).alias("receita_orcada"),
        "margem_bruta_orcada",
        F.round("despesas_fixas_orcadas", 2).alias("despesas_fixas_orcadas"),
        "receita_realizada",
        "margem_bruta",
        "dias_com_venda",
        F.round(c("receita_realizada") - c("receita_orcada"), 2).alias("variacao_absoluta"),
        pct2(c("receita_realizada") - c("receita_orcada"), c("receita_orcada")).alias("variacao_percentual"),
        rounded(atingido * 100.0).alias("meta_atingida_pct"),
        rounded(ratio(c("receita_realizada"), dias)).alias("media_diaria"),
        rounded(previsao).alias("forecast_mes"),
        rounded(previsao * 12).alias("run_rate_anual"),
        rounded(margem).alias("margem_bruta_pct_realizada"),
        posicao(c("receita_realizada")).alias("ranking_receita"),
        posicao(margem).alias("ranking_margem"),
        posicao(atingido * 100.0).alias("ranking_meta"),
        F.when(atingido < params.meta_amarela, "VERMELHO")
        .when(atingido < params.meta_verde, "AMARELO")
        .otherwise("VERDE")
        .alias("status_semaforo"),
    )


def fpa(silver: DataFrame, orcamento: DataFrame, params: Params = PADRAO) -> DataFrame:
    return fpa_indicators(orcamento, fpa_totals(silver), params)
