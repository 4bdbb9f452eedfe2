"""Monthly series, managerial projection and regression forecast.

Everything works on store-month rows. A series is keyed by ``serie`` (store id, or 0 for the network) so one plan fits
all of them at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao.functions.columns import (
    label_to_date,
    month_distance,
    month_label,
    month_start,
    pct,
    ratio,
    rounded,
    shift_month,
)
from balcao.params import PADRAO, Params
from balcao.plans import views
from balcao.sources.warehouse import Warehouse

c = F.col
CHAVE = views.CHAVE


def horizon(meses: int) -> Column:
    return F.explode(F.sequence(F.lit(1), F.lit(meses)))


def check_horizon(meses: int, ajuste: float = 0.0) -> None:
    if not 1 <= meses <= 12:
        raise ValueError("months must be between 1 and 12")
    if not -30 <= ajuste <= 30:
        raise ValueError("adjustment must be between -30 and 30 percent")


# Series


def active_stores(wh: Warehouse) -> DataFrame:
    return wh.dim_loja().where("ativa").select("loja_id", "loja_nome").orderBy("loja_id")


def store_series(wh: Warehouse) -> DataFrame:
    """Store-month series. Built from one store-month table joined once to its budget, not from five views."""
    m = wh.shared().loja_mes("faturamento", "pedidos", "margem_bruta", "dias")
    ticket = ratio(c("faturamento"), c("pedidos"))
    anterior = views.previous("faturamento")
    orcamento = wh.orcamento().select(*CHAVE, "receita_orcada")
    # Share, growth and previous values are taken before the budget join: that join may drop months.
    base = m.select(
        *CHAVE,
        c("faturamento").alias("receita"),
        views.pct2(c("faturamento"), F.sum("faturamento").over(views.month_window())).alias(
            "market_share_pct"
        ),
        views.pct2(c("faturamento") - anterior, anterior).alias("crescimento_mom"),
        ticket.alias("ticket_medio"),
        views.pct2(c("margem_bruta"), c("faturamento")).alias("margem_pct"),
        "dias",
    )
    projecao = ratio(c("receita"), c("dias")) * views.days_in_month(c("ano"), c("mes"))
    return (
        base.join(orcamento, CHAVE)
        .join(wh.lojas(), "loja_id")
        .select(
            month_label(c("ano"), c("mes")).alias("competencia"),
            *CHAVE,
            "loja_nome",
            "receita",
            "market_share_pct",
            "crescimento_mom",
            "ticket_medio",
            "margem_pct",
            "receita_orcada",
            F.when(c("receita_orcada") == 0, F.lit(0.0))
            .otherwise(pct(c("receita"), c("receita_orcada")))
            .alias("meta_atingida_pct"),
            F.coalesce(rounded(projecao), c("receita").cast("double")).alias("forecast_mes"),
        )
    )


def network_margins(wh: Warehouse) -> DataFrame:
    return (
        wh.dre()
        .groupBy("ano", "mes")
        .agg(F.sum("ebitda").alias("ebitda"), pct(F.sum("ebitda"), F.sum("receita_liquida")).alias("margem_ebitda_pct"))
    )


def network_revenue(wh: Warehouse) -> DataFrame:
    """Network revenue and EBITDA margin per month from the shared store-month table."""
    receita = (
        wh.shared()
        .loja_mes("faturamento")
        .groupBy("ano", "mes")
        .agg(F.sum("faturamento").alias("receita_liquida"))
        .join(network_margins(wh), ["ano", "mes"], "left")
        .na.fill(0, ["ebitda", "margem_ebitda_pct"])
    )
    return receita.withColumn("competencia", month_label(c("ano"), c("mes")))


def network_series(wh: Warehouse) -> DataFrame:
    """Network months with ticket, EBITDA and cancellation. The ticket needs distinct sale ids across stores, the one
    measure the store-month table cannot give."""
    situacao = (
        wh.shared()
        .loja_mes_status()
        .groupBy("ano", "mes")
        .agg(F.sum("canceladas").alias("canceladas"), F.sum("registros").alias("registros"))
        .select("ano", "mes", pct(c("canceladas"), c("registros")).alias("cancelamento_pct"))
    )
    return (
        views.monthly_revenue(wh)
        .join(network_margins(wh), ["ano", "mes"], "left")
        .join(situacao, ["ano", "mes"], "left")
        .na.fill(0, ["ebitda", "margem_ebitda_pct", "cancelamento_pct"])
        .select(
            month_label(c("ano"), c("mes")).alias("competencia"),
            "ano",
            "mes",
            "receita_liquida",
            "ticket_medio",
            "total_pedidos",
            "ebitda",
            "margem_ebitda_pct",
            "cancelamento_pct",
        )
    )


def latest_network_month(wh: Warehouse) -> DataFrame:
    """One row: the newest month with a completed sale."""
    return wh.shared().loja_mes("pedidos").agg(F.max(month_label(c("ano"), c("mes"))).alias("ultima"))


def last_two(series: DataFrame, chave: str | None, valor: str) -> DataFrame:
    """Newest row and the one before it per series, with the change in percent (NULL when the base is zero)."""
    w = (Window.partitionBy(chave) if chave else Window.partitionBy()).orderBy(c("competencia").desc())
    colunas = [chave] if chave else []
    anterior = F.lead(valor).over(w)
    return (
        series.select(
            *colunas,
            "competencia",
            c(valor).alias("atual"),
            anterior.alias("anterior"),
            F.row_number().over(w).alias("_n"),
        )
        .where("_n = 1")
        .drop("_n")
        .withColumn("variacao_pct", pct(c("atual") - c("anterior"), c("anterior")))
    )


def recent_ebitda_margin(network: DataFrame, meses: int = 3) -> DataFrame:
    """Mean of the non-zero EBITDA margins of the last three network months, zero when there is none."""
    w = Window.orderBy(c("competencia").desc())
    return (
        network.withColumn("_n", F.row_number().over(w))
        .where(c("_n") <= meses)
        .agg(F.coalesce(F.avg(F.when(c("margem_ebitda_pct") != 0, c("margem_ebitda_pct"))), F.lit(0.0)).alias("margem"))
    )


# Managerial projection


def trend(series: DataFrame, ultima: DataFrame, params: Params = PADRAO) -> DataFrame:
    """Mean of the last growth rates per store, limited to +-15 %.

    The open month is left out only when it is the newest row of the store. Months without revenue are dropped first;
    the survivors are then compared with their neighbours.
    """
    w = Window.partitionBy("loja_id").orderBy("competencia")
    positivos = series.crossJoin(F.broadcast(ultima)).where((c("competencia") != c("ultima")) & (c("receita") > 0))
    receita = c("receita").cast("double")
    variacoes = (
        positivos.withColumn("variacao", receita / F.lag(receita).over(w) - 1)
        .where("variacao IS NOT NULL")
        .withColumn("_n", F.row_number().over(Window.partitionBy("loja_id").orderBy(c("competencia").desc())))
        .where(c("_n") <= params.meses_tendencia)
    )
    lim = params.limite_tendencia
    medias = variacoes.groupBy("loja_id").agg(
        F.greatest(F.lit(-lim), F.least(F.lit(lim), F.avg("variacao"))).alias("tendencia")
    )
    return (
        series.select("loja_id")
        .distinct()
        .join(medias, "loja_id", "left")
        .na.fill(0.0, ["tendencia"])
    )


def future_budgets(wh: Warehouse, ultima: DataFrame) -> DataFrame:
    """Budget rows of months after the newest network month."""
    return (
        wh.orcamento()
        .crossJoin(F.broadcast(ultima))
        .where(month_start(c("ano"), c("mes")) > label_to_date(c("ultima")))
        .select(month_label(c("ano"), c("mes")).alias("competencia"), "loja_id", "receita_orcada")
    )


def project_stores(
    series: DataFrame,
    ultima: DataFrame,
    orcamentos: DataFrame,
    meses: int,
    ajuste: float,
    params: Params = PADRAO,
) -> DataFrame:
    """Projection per store and month ahead. Months count from the network's newest month, growth compounds from the
    store's own newest month."""
    recente = Window.partitionBy("loja_id").orderBy(c("competencia").desc())
    atual = (
        series.withColumn("_n", F.row_number().over(recente))
        .where("_n = 1")
        .select(
            "loja_id",
            "loja_nome",
            c("competencia").alias("competencia_atual"),
            F.when(c("forecast_mes") != 0, c("forecast_mes").cast("double"))
            .otherwise(c("receita").cast("double"))
            .alias("valor_base"),
        )
    )
    futuro = (
        atual.join(trend(series, ultima, params), "loja_id")
        .crossJoin(F.broadcast(ultima))
        .withColumn("passo", horizon(meses))
        .withColumn("competencia", shift_month(c("ultima"), c("passo")))
        .withColumn("decorridos", month_distance(c("competencia_atual"), c("competencia")))
        .withColumn("base", c("valor_base") * F.pow(c("tendencia") + 1, c("decorridos")))
        .withColumn("projetado", c("base") * F.lit(1 + ajuste / 100))
    )
    orcado = c("receita_orcada").cast("double")
    return futuro.join(orcamentos, ["competencia", "loja_id"], "left").select(
        "competencia",
        "loja_id",
        "loja_nome",
        "passo",
        rounded(c("base")).alias("forecast_base"),
        rounded(c("projetado")).alias("forecast_ajustado"),
        rounded(orcado).alias("receita_orcada"),
        rounded(c("projetado") - orcado).alias("variacao_orcamento"),
        rounded(pct(c("projetado"), orcado)).alias("meta_atingida_pct"),
        rounded(c("tendencia") * 100).alias("tendencia_pct"),
    )


def store_projection(wh: Warehouse, meses: int = 6, ajuste: float = 0.0, params: Params = PADRAO) -> DataFrame:
    check_horizon(meses, ajuste)
    ultima = latest_network_month(wh)
    ativas = wh.dim_loja().where("ativa").select("loja_id")
    series = store_series(wh).join(F.broadcast(ativas), "loja_id", "left_semi")
    return project_stores(series, ultima, future_budgets(wh, ultima), meses, ajuste, params)


def project_network(lojas: DataFrame, margem: DataFrame) -> DataFrame:
    """Network projection: sums of the rounded store values and an EBITDA estimate. Sums run on cents, so the order
    of rows cannot change them."""

    def soma(coluna: str) -> Column:
        return F.sum(c(coluna).cast("decimal(18,2)")).cast("double")

    totais = lojas.groupBy("competencia", "passo").agg(
        soma("forecast_base").alias("forecast_base"),
        soma("forecast_ajustado").alias("forecast_ajustado"),
        soma("receita_orcada").alias("receita_orcada"),
    )
    return totais.crossJoin(F.broadcast(margem)).select(
        "competencia",
        "passo",
        "forecast_base",
        "forecast_ajustado",
        "receita_orcada",
        rounded(c("forecast_ajustado") - c("receita_orcada")).alias("variacao_orcamento"),
        rounded(pct(c("forecast_ajustado"), c("receita_orcada"))).alias("meta_atingida_pct"),
        rounded(c("forecast_ajustado") * c("margem") / 100).alias("ebitda_estimado"),
        rounded(c("margem")).alias("margem_ebitda_referencia_pct"),
    )


def network_projection(wh: Warehouse, meses: int = 6, ajuste: float = 0.0, params: Params = PADRAO) -> DataFrame:
    lojas = store_projection(wh, meses, ajuste, params)
    return project_network(lojas, recent_ebitda_margin(network_revenue(wh)))


def horizon_totals(projecao: DataFrame) -> DataFrame:
    """Totals over the horizon; the variance compares only months that have a budget."""
    com_orcamento = c("receita_orcada").isNotNull()

    def soma(coluna: str) -> Column:
        return c(coluna).cast("decimal(18,2)")

    totais = projecao.agg(
        F.sum(soma("forecast_ajustado")).alias("total_forecast"),
        F.sum(soma("forecast_base")).alias("total_base"),
        F.coalesce(F.sum(soma("receita_orcada")), F.lit(0).cast("decimal(18,2)")).alias("total_orcamento"),
        F.coalesce(F.sum(F.when(com_orcamento, soma("forecast_ajustado"))), F.lit(0).cast("decimal(18,2)")).alias(
            "forecast_com_orcamento"
        ),
    )
    return totais.withColumns(
        {
            "variacao_total": c("forecast_com_orcamento") - c("total_orcamento"),
            "delta_pct": F.coalesce(pct(c("total_forecast") - c("total_base"), c("total_base")), F.lit(0.0)),
        }
    )


# Regression forecast


def numbered(series: DataFrame) -> DataFrame:
    """Series with the position 0..n-1 as time axis; missing months leave no gap."""
    w = Window.partitionBy("serie").orderBy("competencia")
    total = F.count("*").over(Window.partitionBy("serie"))
    return series.select(
        "serie",
        "competencia",
        F.coalesce(c("valor").cast("double"), F.lit(0.0)).alias("y"),
        (F.row_number().over(w) - 1).cast("double").alias("x"),
        total.alias("n"),
    )


def fit(pontos: DataFrame) -> DataFrame:
    """Least squares line per series. One point gives a flat line with a perfect fit; a constant series fits with
    R2 = 1. The RMSE divides by n."""
    ajuste = pontos.groupBy("serie").agg(
        F.count("*").alias("n"),
        F.coalesce(F.regr_slope("y", "x"), F.lit(0.0)).alias("inclinacao"),
        F.coalesce(F.regr_intercept("y", "x"), F.max("y")).alias("intercepto"),
        F.regr_syy("y", "x").alias("syy"),
        F.regr_sxy("y", "x").alias("sxy"),
        F.regr_sxx("y", "x").alias("sxx"),
        F.coalesce(F.regr_r2("y", "x"), F.lit(1.0)).alias("r2"),
        F.max_by("y", "x").alias("ultimo"),
    )
    explicado = F.coalesce(F.try_divide(c("sxy") * c("sxy"), c("sxx")), F.lit(0.0))
    residual = F.greatest(F.lit(0.0), c("syy") - explicado)
    return ajuste.select(
        "serie",
        "n",
        "inclinacao",
        "intercepto",
        F.sqrt(residual / c("n")).alias("rmse"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), c("r2"))).alias("r2"),
        "ultimo",
    )


def models(series: DataFrame) -> DataFrame:
    tendencia = F.coalesce(pct(c("inclinacao"), c("ultimo")), F.lit(0.0))
    return fit(numbered(series)).select(
        "serie",
        rounded(c("intercepto")).alias("intercepto"),
        rounded(c("inclinacao")).alias("coeficiente_mensal"),
        rounded(tendencia).alias("tendencia_mensal_pct"),
        rounded(c("rmse")).alias("rmse"),
        rounded(c("r2"), 4).alias("r2"),
        c("n").alias("observacoes_treino"),
    )


def regression_projection(series: DataFrame, ultima: DataFrame, meses: int, params: Params = PADRAO) -> DataFrame:
    """Line continued from the last position, floored at zero, with a band that widens with the horizon."""
    previsto = F.greatest(F.lit(0.0), c("intercepto") + c("inclinacao") * (c("n") - 1 + c("passo")))
    margem = F.lit(params.z_intervalo) * c("rmse") * F.sqrt(F.lit(1.0) + c("passo") / c("n"))
    return (
        fit(numbered(series))
        .crossJoin(F.broadcast(ultima))
        .withColumn("passo", horizon(meses))
        .withColumn("previsto", previsto)
        .withColumn("margem", margem)
        .select(
            "serie",
            "passo",
            shift_month(c("ultima"), c("passo")).alias("competencia"),
            rounded(c("previsto")).alias("previsao"),
            rounded(F.greatest(F.lit(0.0), c("previsto") - c("margem"))).alias("limite_inferior"),
            rounded(c("previsto") + c("margem")).alias("limite_superior"),
        )
    )


def backtest(series: DataFrame) -> DataFrame:
    """The newest month predicted by a line fitted without it; series with fewer than three months have none."""
    pontos = numbered(series).where("n >= 3")
    treino = fit(pontos.where(c("x") < c("n") - 1)).select("serie", "intercepto", "inclinacao")
    alvo = pontos.where(c("x") == c("n") - 1).select("serie", "competencia", c("y").alias("realizado"), "x")
    previsto = F.greatest(F.lit(0.0), c("intercepto") + c("inclinacao") * c("x"))
    erro = c("previsto") - c("realizado")
    return (
        alvo.join(treino, "serie")
        .withColumn("previsto", previsto)
        .select(
            "serie",
            "competencia",
            rounded(c("realizado")).alias("realizado"),
            rounded(c("previsto")).alias("previsto"),
            rounded(erro).alias("erro_absoluto"),
            rounded(pct(F.abs(erro), c("realizado"))).alias("erro_percentual_abs"),
        )
    )


def ml_series(wh: Warehouse) -> DataFrame:
    """Series of the active stores (their id) and of the network (0)."""
    ativas = wh.dim_loja().where("ativa").select("loja_id")
    lojas = store_series(wh).join(F.broadcast(ativas), "loja_id", "left_semi")
    rede = (
        wh.loja_mes("faturamento")
        .groupBy("ano", "mes")
        .agg(F.sum("faturamento").alias("valor"))
        .select(F.lit(0).alias("serie"), month_label(c("ano"), c("mes")).alias("competencia"), "valor")
    )
    return lojas.select(c("loja_id").alias("serie"), "competencia", c("receita").alias("valor")).unionByName(rede)


def with_entity(df: DataFrame, wh: Warehouse) -> DataFrame:
    """Name of each series: the store, or the network."""
    nomes = wh.dim_loja().select(c("loja_id").alias("serie"), c("loja_nome").alias("entidade"))
    return df.join(F.broadcast(nomes), "serie", "left").na.fill("Rede", ["entidade"])


def ml_models(wh: Warehouse) -> DataFrame:
    return with_entity(models(ml_series(wh)), wh)


def ml_backtest(wh: Warehouse) -> DataFrame:
    return with_entity(backtest(ml_series(wh)), wh)


def ml_projection(wh: Warehouse, meses: int = 6, params: Params = PADRAO) -> DataFrame:
    check_horizon(meses)
    return with_entity(regression_projection(ml_series(wh), latest_network_month(wh), meses, params), wh)


def ml_forecast(wh: Warehouse, meses: int = 6, params: Params = PADRAO) -> DataFrame:
    """Model, backtest and projection side by side, one row per series and month ahead."""
    check_horizon(meses)
    series = ml_series(wh)
    teste = backtest(series).withColumnsRenamed({"competencia": "competencia_teste"})
    return with_entity(
        regression_projection(series, latest_network_month(wh), meses, params)
        .join(models(series), "serie")
        .join(teste, "serie", "left"),
        wh,
    )
