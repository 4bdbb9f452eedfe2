"""Dashboard and store-detail snapshots of one month.

Month arguments are plain numbers. Where none is given, the newest month is found by the plan itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao.functions.columns import approval_rate, completed, month_label, pct, percent_or_zero, ratio
from balcao.plans import forecast, views
from balcao.sources.warehouse import Warehouse

c = F.col


def _zero() -> Column:
    return F.lit(0).cast("int")


def months(wh: Warehouse) -> DataFrame:
    """Months with any sale, newest first."""
    return (
        wh.fato("ano", "mes")
        .distinct()
        .select(month_label(c("ano"), c("mes")).alias("competencia"))
        .orderBy(c("competencia").desc())
    )


def latest_month(wh: Warehouse) -> DataFrame:
    """Newest month with a completed sale, one row."""
    return (
        wh.fato("data_venda", "status")
        .where("status = 'CONCLUIDA'")
        .agg(F.date_format(F.max("data_venda"), "yyyy-MM").alias("competencia"))
    )


def latest_loaded_month(wh: Warehouse) -> tuple[int, int]:
    """Year and month of the newest sale of any status: one number brought to the driver as a default argument."""
    linha = wh.shared().loja_mes_status().agg(F.max(F.struct("ano", "mes")).alias("u")).first()
    if linha is None or linha["u"] is None:
        raise ValueError("no month has been loaded")
    return linha["u"]["ano"], linha["u"]["mes"]


def of_month(df: DataFrame, ano: int, mes: int) -> DataFrame:
    return df.where((c("ano") == ano) & (c("mes") == mes))


def _sales_overview(vendas: DataFrame) -> list[Column]:
    pedidos = F.count_distinct(completed(c("id_venda")))

    def soma(coluna: str) -> Column:
        return F.coalesce(F.sum(completed(c(coluna))), _zero())

    return [
        soma("valor_liquido").alias("receita_liquida"),
        soma("valor_bruto").alias("receita_bruta"),
        soma("desconto_valor").alias("descontos"),
        soma("margem_bruta").alias("margem_bruta"),
        pedidos.alias("pedidos"),
        F.count_if(c("status") == "CANCELADA").alias("canceladas"),
        F.count_if(c("status") == "PENDENTE").alias("pendentes"),
    ]


_COLUNAS_RESUMO = (
    "ano", "mes", "loja_id", "id_venda", "status", "valor_liquido", "valor_bruto", "desconto_valor", "margem_bruta",
)


def overview(wh: Warehouse, ano: int, mes: int) -> DataFrame:
    vendas = of_month(wh.fato(*_COLUNAS_RESUMO), ano, mes)
    return vendas.agg(*_sales_overview(vendas)).withColumns(
        {
            "ticket_medio": F.coalesce(ratio(c("receita_liquida"), c("pedidos")), F.lit(0.0)),
            "margem_pct": percent_or_zero(c("margem_bruta"), c("receita_liquida")),
        }
    )


def dre_totals(wh: Warehouse, ano: int, mes: int) -> DataFrame:
    somas = ("receita_liquida", "lucro_bruto", "ebitda", "resultado_antes_ir")
    return (
        of_month(wh.dre(), ano, mes)
        .agg(*[F.coalesce(F.sum(v), _zero()).alias(v) for v in somas])
        .withColumn("margem_ebitda_pct", F.coalesce(pct(c("ebitda"), c("receita_liquida")), F.lit(0.0)))
    )


def revenue_trend(wh: Warehouse) -> DataFrame:
    """Monthly revenue with its share of the highest month, as a bar chart needs it."""
    rede = views.monthly_revenue(wh).select("ano", "mes", "receita_liquida", "ticket_medio")
    maximo = F.greatest(F.max("receita_liquida").over(Window.partitionBy()), F.lit(1))
    return rede.withColumn("escala", ratio(c("receita_liquida"), maximo)).orderBy("ano", "mes")


def store_table(wh: Warehouse, ano: int, mes: int) -> DataFrame:
    """Stores of a month with revenue rank and target light."""
    wh = wh.shared("faturamento")
    meta = views.target_vs_actual(wh).select(*views.CHAVE, "receita_orcada", "variacao_pct", "status_semaforo")
    return (
        of_month(views.store_revenue(wh), ano, mes)
        .join(of_month(meta, ano, mes), views.CHAVE)
        .select(
            "loja_id", "loja_nome", "faturamento", "market_share_pct", "crescimento_mom", "ranking",
            "receita_orcada", "variacao_pct", "status_semaforo",
        )
        .orderBy("ranking", "loja_id")
    )


def month_products(wh: Warehouse, ano: int, mes: int, limite: int = 10) -> DataFrame:
    return (
        views.top_products(wh, limite, (ano, mes))
        .where(c("ranking_receita") <= limite)
        .select("produto_id", "produto_nome", "categoria", "receita", "volume", "ranking_receita")
        .orderBy("ranking_receita", "produto_id")
    )


def product_bars(wh: Warehouse, ano: int, mes: int, quantos: int = 6) -> DataFrame:
    """First products of the month with their share of the best one in percent."""
    maximo = F.greatest(F.max("receita").over(Window.partitionBy()), F.lit(1))
    return (
        month_products(wh, ano, mes)
        .withColumn("largura_pct", pct(c("receita"), maximo))
        .orderBy("ranking_receita", "produto_id")
        .limit(quantos)
    )


def fpa_by_store(wh: Warehouse, ano: int, mes: int) -> DataFrame:
    return (
        of_month(views.fpa_view(wh.shared("faturamento", "dias")), ano, mes)
        .join(wh.lojas(), "loja_id")
        .select(
            "loja_id", "loja_nome", "realizado", "receita_orcada", "meta_atingida_pct", "forecast_mes",
            "run_rate_anual",
        )
        .orderBy(c("realizado").desc(), "loja_id")
    )


def channel_mix(wh: Warehouse, ano: int, mes: int) -> DataFrame:
    return (
        of_month(views.channel_cohort(wh), ano, mes)
        .groupBy("canal_venda")
        .agg(F.sum("receita").alias("receita"), F.sum("pedidos").alias("pedidos"))
        .orderBy(c("receita").desc(), "canal_venda")
    )


def pipeline_counters(wh: Warehouse) -> DataFrame:
    """Counts over three tables as one row."""
    arquivos = wh.arquivos().agg(F.count("*").alias("arquivos_processados"))
    fatos = wh.fato("id_venda").agg(F.count("*").alias("fatos_carregados"))
    auditoria = wh.auditoria().agg(
        F.max("created_at").alias("ultima_execucao"), F.count_if(c("status") == "FAILED").alias("falhas")
    )
    return arquivos.crossJoin(F.broadcast(fatos)).crossJoin(F.broadcast(auditoria))


def monthly_counts(wh: Warehouse) -> DataFrame:
    """Facts per month, an operator's check."""
    return wh.fato("ano", "mes").groupBy("ano", "mes").agg(F.count("*").alias("vendas")).orderBy("ano", "mes")


def status_counts(wh: Warehouse) -> DataFrame:
    return wh.fato("status").groupBy("status").agg(F.count("*").alias("registros")).orderBy("status")


def period_axis(*series: DataFrame) -> DataFrame:
    """Sorted distinct months of several series with the overall value range."""
    todas = series[0].select("competencia", c("receita").cast("double"))
    for outra in series[1:]:
        todas = todas.unionByName(outra.select("competencia", c("receita").cast("double")))
    faixa = Window.partitionBy()
    return (
        todas.groupBy("competencia")
        .agg(F.max("receita").alias("maior"), F.min("receita").alias("menor"))
        .select(
            "competencia",
            F.greatest(F.max("maior").over(faixa), F.lit(1.0)).alias("maximo"),
            F.least(F.min("menor").over(faixa), F.lit(0.0)).alias("minimo"),
        )
        .orderBy("competencia")
    )


# Store detail


def store_master(wh: Warehouse, loja_id: int) -> DataFrame:
    return wh.dim_loja().where(c("loja_id") == loja_id).select(
        "loja_id", "loja_nome", "cidade", "estado", "regiao", "data_abertura", "tier", "ativa"
    )


def require_store(wh: Warehouse, loja_id: int) -> None:
    if store_master(wh, loja_id).isEmpty():
        raise ValueError(f"store {loja_id} not found")


def store_overview(wh: Warehouse, loja_id: int, ano: int, mes: int) -> DataFrame:
    """One row of sales totals with rank, target, forecast and P&L of the same store-month."""
    wh = wh.shared()

    def linha(df: DataFrame, *colunas: str) -> DataFrame:
        return F.broadcast(of_month(df, ano, mes).where(c("loja_id") == loja_id).select("loja_id", *colunas))

    vendas = of_month(wh.fato(*_COLUNAS_RESUMO), ano, mes).where(c("loja_id") == loja_id)
    resumo = (
        vendas.agg(*_sales_overview(vendas))
        .drop("descontos")
        .withColumn("ticket_medio", F.coalesce(ratio(c("receita_liquida"), c("pedidos")), F.lit(0.0)))
        .withColumn("loja_id", F.lit(loja_id))
    )
    return (
        resumo.join(
            linha(views.store_revenue(wh), "ranking", "market_share_pct", "crescimento_mom"), "loja_id", "left"
        )
        .join(
            linha(
                views.target_vs_actual(wh), "receita_orcada", "variacao_absoluta", "variacao_pct", "status_semaforo"
            ),
            "loja_id",
            "left",
        )
        .join(linha(views.fpa_view(wh), "meta_atingida_pct", "forecast_mes", "run_rate_anual"), "loja_id", "left")
        .join(linha(wh.dre(), "ebitda", "margem_ebitda_pct"), "loja_id", "left")
    )


def _store_month(wh: Warehouse, loja_id: int, ano: int, mes: int, *colunas: str) -> DataFrame:
    pedidas = dict.fromkeys(("ano", "mes", "loja_id", "status", *colunas))
    return of_month(wh.fato(*pedidas), ano, mes).where(c("loja_id") == loja_id)


def store_products(wh: Warehouse, loja_id: int, ano: int, mes: int, limite: int = 10) -> DataFrame:
    return (
        _store_month(wh, loja_id, ano, mes, "produto_id", "valor_liquido", "quantidade", "margem_bruta")
        .where("status = 'CONCLUIDA'")
        .groupBy("produto_id")
        .agg(
            F.sum("valor_liquido").alias("receita"),
            F.sum("quantidade").alias("volume"),
            F.sum("margem_bruta").alias("margem_bruta"),
        )
        .withColumn("margem_pct", pct(c("margem_bruta"), c("receita")))
        .join(wh.dim_produto().select("produto_id", "produto_nome", "categoria"), "produto_id")
        .orderBy(c("receita").desc(), "produto_id")
        .limit(limite)
    )


def store_channels(wh: Warehouse, loja_id: int, ano: int, mes: int) -> DataFrame:
    """Inside one store a sale id occurs once, so orders are counted, not counted distinct."""
    return (
        _store_month(wh, loja_id, ano, mes, "canal_venda", "forma_pagamento", "valor_liquido")
        .where("status = 'CONCLUIDA'")
        .groupBy("canal_venda", "forma_pagamento")
        .agg(F.count("*").alias("pedidos"), F.sum("valor_liquido").alias("receita"))
        .withColumn("ticket_medio", ratio(c("receita"), c("pedidos")))
        .orderBy(c("receita").desc(), "canal_venda", "forma_pagamento")
    )


def store_status(wh: Warehouse, loja_id: int, ano: int, mes: int) -> DataFrame:
    return (
        _store_month(wh, loja_id, ano, mes, "valor_liquido")
        .groupBy("status")
        .agg(F.count("*").alias("registros"), F.coalesce(F.sum("valor_liquido"), _zero()).alias("valor_liquido"))
        .orderBy(c("registros").desc(), "status")
    )


def store_quality(wh: Warehouse, loja_id: int, datas: int = 15) -> DataFrame:
    return (
        wh.arquivos()
        .where(c("loja_id") == loja_id)
        .groupBy("data_referencia")
        .agg(
            F.count("*").alias("arquivos"),
            F.count_if(c("status") == "PROCESSED").alias("processados"),
            F.count_if(c("status") == "REPROCESSED").alias("reprocessados"),
            F.count_if(c("status") == "FAILED").alias("falhas"),
            F.sum("registros_lidos").alias("registros_lidos"),
            F.sum("registros_validos").alias("registros_validos"),
            F.sum("registros_invalidos").alias("registros_invalidos"),
            F.max("updated_at").alias("atualizado_em"),
        )
        .withColumn("taxa_aprovacao", approval_rate(c("registros_lidos"), c("registros_invalidos")))
        .orderBy(c("data_referencia").desc())
        .limit(datas)
    )


def store_files(wh: Warehouse, loja_id: int, limite: int = 15) -> DataFrame:
    return (
        wh.arquivos()
        .where(c("loja_id") == loja_id)
        .select(
            "file_id", "file_path", "checksum", "data_referencia", "camada_destino", "status", "registros_lidos",
            "registros_validos", "registros_invalidos", "pipeline_version", "processed_at", "updated_at",
        )
        .orderBy(c("updated_at").desc(), c("file_id").desc())
        .limit(limite)
    )


def store_outlook(wh: Warehouse, loja_id: int, meses: int = 6) -> DataFrame:
    """Managerial and regression projection of one store side by side."""
    gerencial = forecast.store_projection(wh, meses).where(c("loja_id") == loja_id)
    ml = forecast.ml_projection(wh, meses).where(c("serie") == loja_id)
    return (
        gerencial.join(ml.drop("serie", "entidade", "passo"), "competencia", "left")
        .select(
            "loja_id", "loja_nome", "competencia", "forecast_base", "forecast_ajustado", "receita_orcada",
            "meta_atingida_pct", "tendencia_pct", "previsao", "limite_inferior", "limite_superior",
        )
        .orderBy("competencia")
    )
