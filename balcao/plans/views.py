"""Published views over the star schema. Each takes a Warehouse and returns a DataFrame.

Month filters belong after these functions: a filter moved below ``lag`` would change the previous month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from balcao.functions.columns import days_in_month, pct, pct2, ratio, rounded, traffic_light
from balcao.functions.lineage import write_intermediate
from balcao.operators.ranking import spread_ranks
from balcao.sources.warehouse import Warehouse

CHAVE = ["ano", "mes", "loja_id"]
c = F.col


def month_window() -> WindowSpec:
    return Window.partitionBy("ano", "mes")


def previous(coluna: str) -> Column:
    """Value of the store's previous row, which need not be the previous calendar month."""
    return F.lag(coluna).over(Window.partitionBy("loja_id").orderBy("ano", "mes"))


def month_rank(coluna: Column) -> Column:
    """Rank with gaps inside a month; NULL ranks first."""
    return F.rank().over(month_window().orderBy(coluna.desc_nulls_first()))


def monthly_revenue(wh: Warehouse) -> DataFrame:
    """One row per month. Sale ids may repeat across stores, so this count is distinct."""
    fato = wh.fato("ano", "mes", "id_venda", "status", "valor_bruto", "valor_liquido", "desconto_valor")
    return (
        fato.where("status = 'CONCLUIDA'")
        .groupBy("ano", "mes")
        .agg(
            F.sum("valor_bruto").alias("receita_bruta"),
            F.sum("valor_liquido").alias("receita_liquida"),
            F.sum("desconto_valor").alias("desconto_total"),
            F.count_distinct("id_venda").alias("total_pedidos"),
        )
        .withColumn("ticket_medio", ratio(c("receita_liquida"), c("total_pedidos")))
    )


def store_revenue(wh: Warehouse) -> DataFrame:
    anterior = previous("faturamento")
    return (
        wh.loja_mes("faturamento")
        .select(
            *CHAVE,
            "faturamento",
            month_rank(c("faturamento")).alias("ranking"),
            pct2(c("faturamento"), F.sum("faturamento").over(month_window())).alias("market_share_pct"),
            pct2(c("faturamento") - anterior, anterior).alias("crescimento_mom"),
        )
        .join(wh.lojas(), "loja_id")
    )


def store_ticket(wh: Warehouse) -> DataFrame:
    return (
        wh.loja_mes("faturamento", "pedidos")
        .select(*CHAVE, ratio(c("faturamento"), c("pedidos")).alias("ticket_medio"))
        .withColumn("ticket_anterior", previous("ticket_medio"))
        .withColumn("variacao_pct", pct2(c("ticket_medio") - c("ticket_anterior"), c("ticket_anterior")))
        .join(wh.lojas(), "loja_id")
    )


def store_ranking(wh: Warehouse) -> DataFrame:
    margem = pct(c("margem_bruta"), c("faturamento"))
    return (
        wh.loja_mes("faturamento", "margem_bruta")
        .join(wh.orcamento().select(*CHAVE, "receita_orcada"), CHAVE)
        .join(wh.lojas(), "loja_id")
        .select(
            *CHAVE,
            "loja_nome",
            c("faturamento").alias("receita"),
            rounded(margem).alias("margem_pct"),
            pct2(c("faturamento"), c("receita_orcada")).alias("meta_atingida_pct"),
            month_rank(c("faturamento")).alias("ranking_receita"),
            month_rank(margem).alias("ranking_margem"),
        )
    )


def target_vs_actual(wh: Warehouse) -> DataFrame:
    """Every budget month, with zero where nothing was sold."""
    realizado = wh.loja_mes("faturamento").select(*CHAVE, c("faturamento").alias("receita_realizada"))
    variacao = c("receita_realizada") - c("receita_orcada")
    return (
        wh.orcamento()
        .select(*CHAVE, "receita_orcada")
        .join(wh.lojas(), "loja_id")
        .join(realizado, CHAVE, "left")
        .na.fill(0, ["receita_realizada"])
        .select(
            *CHAVE,
            "loja_nome",
            "receita_orcada",
            "receita_realizada",
            variacao.alias("variacao_absoluta"),
            pct2(variacao, c("receita_orcada")).alias("variacao_pct"),
            traffic_light(ratio(c("receita_realizada"), c("receita_orcada"))).alias("status_semaforo"),
        )
    )


DRE_SOMAS = (
    "receita_bruta", "descontos", "impostos", "receita_liquida", "cmv", "lucro_bruto", "despesas_variaveis",
    "despesas_fixas", "ebitda", "depreciacao", "ebit", "despesas_financeiras", "resultado_antes_ir",
)
DRE_MARGENS = {
    "margem_bruta_pct": "lucro_bruto",
    "margem_ebitda_pct": "ebitda",
    "margem_liquida_pct": "resultado_antes_ir",
}


def consolidated_dre(wh: Warehouse) -> DataFrame:
    """Store lines plus one network line per month; network margins come from the summed amounts."""
    dre = wh.dre()
    colunas = ["ano", "mes", "unidade", *DRE_SOMAS, *DRE_MARGENS]
    detalhe = dre.withColumn("unidade", c("loja_id").cast("string")).select(*colunas)
    rede = (
        dre.groupBy("ano", "mes")
        .agg(*[F.sum(v).alias(v) for v in DRE_SOMAS])
        .withColumn("unidade", F.lit("REDE"))
        .withColumns({m: pct(c(v), c("receita_liquida")) for m, v in DRE_MARGENS.items()})
        .select(*colunas)
    )
    return detalhe.unionByName(rede)


def fpa_view(wh: Warehouse) -> DataFrame:
    """Month forecast from the observed days; only store-months that have a budget."""
    previsao = ratio(c("faturamento"), c("dias")) * days_in_month(c("ano"), c("mes"))
    return (
        wh.loja_mes("faturamento", "dias")
        .join(wh.orcamento().select(*CHAVE, "receita_orcada"), CHAVE)
        .select(
            *CHAVE,
            c("faturamento").alias("realizado"),
            "receita_orcada",
            pct2(c("faturamento"), c("receita_orcada")).alias("meta_atingida_pct"),
            rounded(previsao).alias("forecast_mes"),
            rounded(previsao * 12).alias("run_rate_anual"),
        )
    )


def product_month(wh: Warehouse) -> DataFrame:
    """Product totals per month, by id only."""
    fato = wh.fato("ano", "mes", "produto_id", "status", "valor_liquido", "quantidade")
    return (
        fato.where("status = 'CONCLUIDA'")
        .groupBy("ano", "mes", "produto_id")
        .agg(F.sum("valor_liquido").alias("receita"), F.sum("quantidade").alias("volume"))
    )


def top_products(wh: Warehouse, limite: int = 10, competencia: tuple[int, int] | None = None) -> DataFrame:
    """Products among the month's first ``limite`` by revenue or by volume, with both ranks, of every month or of one.
    Ranks cover the products of the dimension; names join the few rows that remain."""
    dim = wh.dim_produto()
    totais = product_month(wh)
    if competencia:
        totais = totais.where((c("ano") == competencia[0]) & (c("mes") == competencia[1]))
    conhecidos = totais.join(dim.select("produto_id"), "produto_id", "left_semi")
    produtos = write_intermediate(conhecidos, "produto_mes")
    ranqueados = spread_ranks(
        produtos, ["ano", "mes"], {"ranking_receita": "receita", "ranking_volume": "volume"}
    ).where((c("ranking_receita") <= limite) | (c("ranking_volume") <= limite))
    return ranqueados.join(dim.select("produto_id", "produto_nome", "categoria"), "produto_id")


def channel_cohort(wh: Warehouse) -> DataFrame:
    fato = wh.fato("ano", "mes", "canal_venda", "forma_pagamento", "status", "id_venda", "valor_liquido")
    return (
        fato.where("status = 'CONCLUIDA'")
        .groupBy("ano", "mes", "canal_venda", "forma_pagamento")
        .agg(F.count_distinct("id_venda").alias("pedidos"), F.sum("valor_liquido").alias("receita"))
        .withColumn("ticket_medio", ratio(c("receita"), c("pedidos")))
    )


def pipeline_health(wh: Warehouse) -> DataFrame:
    return (
        wh.auditoria()
        .groupBy("data_referencia", "task_id", "status")
        .agg(
            F.count("*").alias("execucoes"),
            F.sum("registros_lidos").alias("registros_lidos"),
            F.sum("registros_validos").alias("registros_validos"),
            F.sum("registros_invalidos").alias("registros_invalidos"),
            F.max("created_at").alias("ultima_execucao"),
        )
    )
