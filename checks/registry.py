"""Every registered query: its Spark plan over the sample star and, where SQL can say it, the reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao import schemas
from balcao.functions import columns as col
from balcao.functions.columns import serialize
from balcao.functions.labels import relabel
from balcao.functions.lineage import write_intermediate
from balcao.operators import contract, load, quality, silver
from balcao.params import PADRAO
from balcao.plans import alerts, analyst, forecast, marts, quality_status, snapshots, views
from balcao.sources import export, raw
from balcao.sources.sample_star import SEGMENTO, SampleStar
from checks import sample_job
from checks.faulty_rows import mistyped_product, unclean_bronze
from checks.oracle_base import DRE_VALORES, aprovacao, dbl, iso_date, iso_time, pct, pct2, sql

c = F.col
ANO, MES, LOJA = 1998, 6, 3
AJUSTE, MESES = 5.0, 6
DRE_MEDIDAS = ("faturamento", "receita_bruta", "descontos", "custo_total")


@dataclass(frozen=True)
class Query:
    plan: Callable[[SampleStar], DataFrame]
    oracle: str | None = None


QUERIES: dict[str, Query] = {}


def add(nome: str, plan: Callable[[SampleStar], DataFrame], oracle: str | None = None) -> None:
    QUERIES[nome] = Query(plan, sql(oracle) if oracle else None)


def run(nome: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return serialize(QUERIES[nome].plan(SampleStar(spark, sf_dir)))


DO_MES = f"WHERE ano = {ANO} AND mes = {MES}"
DA_LOJA = f"WHERE loja_id = {LOJA} AND ano = {ANO} AND mes = {MES}"

# Views

V2 = f"ano, mes, loja_id, loja_nome, {dbl('faturamento')}, ranking, market_share_pct, crescimento_mom"
V3 = "ano, mes, loja_id, loja_nome, ticket_medio, ticket_anterior, variacao_pct"
V5 = (
    f"ano, mes, loja_id, loja_nome, {dbl('receita_orcada', 'receita_realizada', 'variacao_absoluta')}, "
    "variacao_pct, status_semaforo"
)
V7 = (
    f"ano, mes, loja_id, {dbl('realizado', 'receita_orcada')}, meta_atingida_pct, forecast_mes, run_rate_anual"
)
V8 = f"ano, mes, produto_id, produto_nome, categoria, {dbl('receita')}, volume, ranking_receita, ranking_volume"
V1 = f"ano, mes, {dbl('receita_bruta', 'receita_liquida', 'desconto_total')}, total_pedidos, ticket_medio"
DRE = f"loja_id, ano, mes, {dbl(*DRE_VALORES)}, margem_bruta_pct, margem_ebitda_pct, margem_liquida_pct"

add("V1_faturamento_mensal", views.monthly_revenue, f"SELECT {V1} FROM v1")
add("V2_faturamento_por_loja", views.store_revenue, f"SELECT {V2} FROM v2")
add("V3_ticket_medio_por_loja", views.store_ticket, f"SELECT {V3} FROM v3")
add(
    "V4_ranking_lojas",
    lambda wh: views.store_ranking(wh.shared("faturamento", "margem_bruta")),
    f"SELECT ano, mes, loja_id, loja_nome, {dbl('receita')}, margem_pct, meta_atingida_pct, ranking_receita, "
    "ranking_margem FROM v4",
)
add("V5_meta_vs_realizado", lambda wh: views.target_vs_actual(wh.shared("faturamento")), f"SELECT {V5} FROM v5")
add(
    "V6_dre_consolidada",
    lambda wh: views.consolidated_dre(wh.shared(*DRE_MEDIDAS)),
    f"SELECT ano, mes, unidade, {dbl(*DRE_VALORES)}, margem_bruta_pct, margem_ebitda_pct, margem_liquida_pct FROM v6",
)
add("V7_indicadores_fpa", lambda wh: views.fpa_view(wh.shared("faturamento", "dias")), f"SELECT {V7} FROM v7")
add("V8_top10_produtos", views.top_products, f"SELECT {V8} FROM v8")
add(
    "V9_cohort_canais",
    views.channel_cohort,
    f"SELECT ano, mes, canal_venda, forma_pagamento, pedidos, {dbl('receita')}, ticket_medio FROM v9",
)
add(
    "V10_pipeline_health",
    views.pipeline_health,
    f"SELECT {iso_date('data_referencia')}, task_id, status, execucoes, registros_lidos, registros_validos, "
    f"registros_invalidos, {iso_time('ultima_execucao')} FROM v10",
)

# Analyst queries

add(
    "Q1_ultimos_doze_meses",
    analyst.last_twelve_months,
    f"SELECT {V1} FROM v1 ORDER BY ano DESC, mes DESC LIMIT 12",
)
add(
    "Q2_ranking_mes_recente",
    analyst.latest_store_ranking,
    f"SELECT {V2} FROM v2 WHERE (ano, mes) = (SELECT (ano, mes) FROM v1 ORDER BY ano DESC, mes DESC LIMIT 1)",
)
add(
    "Q3_top_receita",
    analyst.top_by_revenue,
    f"SELECT {V8} FROM v8 ORDER BY ano DESC, mes DESC, ranking_receita, produto_id LIMIT 10",
)
add(
    "Q4_top_volume",
    analyst.top_by_volume,
    f"SELECT {V8} FROM v8 ORDER BY ano DESC, mes DESC, ranking_volume, produto_id LIMIT 10",
)
add("Q5_ticket_por_loja", analyst.ticket_by_store, f"SELECT {V3} FROM v3")
for _numero, _plano, _coluna in (
    ("Q6_receita_por_canal", analyst.revenue_by_channel, "canal_venda"),
    ("Q7_receita_por_pagamento", analyst.revenue_by_payment, "forma_pagamento"),
):
    add(_numero, _plano, f"SELECT {_coluna}, CAST(SUM(receita) AS DOUBLE) AS receita FROM v9 GROUP BY {_coluna}")
add(
    "Q8_cancelamento_por_loja",
    analyst.cancellation_by_store,
    f"SELECT loja_id, {pct('COUNT(*) FILTER (WHERE status = ' + repr('CANCELADA') + ')', 'COUNT(*)')} "
    "AS cancelamento_pct FROM fato GROUP BY loja_id",
)
add("Q9_meta_vs_realizado", analyst.target_vs_actual, f"SELECT {V5} FROM v5")
add(
    "Q10_dre_mes_recente",
    lambda wh: analyst.latest_dre(wh.shared(*DRE_MEDIDAS)),
    f"SELECT {DRE} FROM dre WHERE (ano, mes) = (SELECT (ano, mes) FROM dre ORDER BY ano DESC, mes DESC LIMIT 1)",
)
add(
    "Q11_margem_por_loja",
    analyst.store_margin,
    f"SELECT ano, mes, loja_id, {dbl('margem_bruta')}, {pct('margem_bruta', 'faturamento')} AS margem_pct FROM loja_mes",
)
add(
    "Q12_margem_rede",
    analyst.network_margin,
    f"SELECT ano, mes, {pct('SUM(margem_bruta)', 'SUM(valor_liquido)')} AS margem_pct FROM concluidas GROUP BY ano, mes",
)
add("Q13_crescimento_mensal", analyst.store_growth, "SELECT ano, mes, loja_id, crescimento_mom FROM v2")
add("Q14_participacao", analyst.store_share, "SELECT ano, mes, loja_id, market_share_pct FROM v2")
add(
    "Q15_maior_desconto",
    analyst.most_discounted,
    "SELECT produto_id, CAST(SUM(CAST(desconto_pct AS DECIMAL(7,2))) AS DOUBLE) / COUNT(*) AS desconto_medio_pct "
    "FROM concluidas GROUP BY produto_id ORDER BY desconto_medio_pct DESC, produto_id LIMIT 10",
)
add(
    "Q16_receita_por_segmento",
    analyst.revenue_by_segment,
    "SELECT segmento, CAST(SUM(valor_liquido) AS DOUBLE) AS receita FROM concluidas "
    "JOIN dim_cliente USING (cliente_id) GROUP BY segmento",
)
add(
    "Q17_desempenho_periodo",
    analyst.revenue_by_period,
    "SELECT periodo, COUNT(DISTINCT id_venda) AS pedidos, CAST(SUM(valor_liquido) AS DOUBLE) AS receita "
    "FROM concluidas GROUP BY periodo",
)
add(
    "Q18_ano_contra_ano",
    analyst.year_over_year,
    f"SELECT a.ano, a.mes, {dbl('a.receita')}, CAST(b.receita AS DOUBLE) AS receita_ano_anterior, "
    f"{pct('a.receita - b.receita', 'b.receita')} AS crescimento_yoy_pct "
    "FROM (SELECT ano, mes, receita_liquida AS receita FROM v1) a "
    "LEFT JOIN (SELECT ano, mes, receita_liquida AS receita FROM v1) b ON b.ano = a.ano - 1 AND b.mes = a.mes",
)
add(
    "Q19_forecast_mensal",
    lambda wh: analyst.month_forecast(wh.shared("faturamento", "dias")),
    "SELECT ano, mes, loja_id, forecast_mes, run_rate_anual FROM v7",
)
add(
    "Q20_aprovacao_por_data",
    analyst.approval_by_date,
    f"SELECT {iso_date('data_referencia')}, CAST(SUM(registros_lidos) AS BIGINT) AS lidos, "
    "CAST(SUM(registros_invalidos) AS BIGINT) AS invalidos, "
    f"{pct('SUM(registros_validos)', 'SUM(registros_lidos)')} AS aprovacao_pct FROM auditoria GROUP BY data_referencia",
)

# Marts

KPI = ("status", "ano", "mes", "valor_liquido", "valor_bruto", "desconto_valor", "quantidade", "id_venda", "margem_bruta")
add(
    "E1_kpis_vendas",
    lambda wh: marts.kpi_summary(wh.fato(*KPI)),
    f"SELECT ano, mes, strftime(make_date(ano, mes, 1), '%Y-%m') AS competencia, "
    "CAST(SUM(valor_liquido) AS DOUBLE) AS faturamento_total, CAST(SUM(valor_bruto) AS DOUBLE) AS receita_bruta, "
    "CAST(SUM(desconto_valor) AS DOUBLE) AS desconto_total, CAST(SUM(quantidade) AS BIGINT) AS quantidade_total, "
    "COUNT(DISTINCT id_venda) AS total_pedidos, CAST(SUM(margem_bruta) AS DOUBLE) AS margem_bruta, "
    "R2(CAST(SUM(valor_liquido) AS DOUBLE) / COUNT(DISTINCT id_venda)) AS ticket_medio, "
    f"{pct2('SUM(margem_bruta)', 'SUM(valor_liquido)')} AS margem_bruta_pct FROM concluidas GROUP BY ano, mes",
)
add(
    "E2_faturamento_por_loja",
    lambda wh: marts.kpi_stores(wh.fato(*KPI, "loja_id", "loja_nome")),
    "SELECT ano, mes, loja_id, loja_nome, strftime(make_date(ano, mes, 1), '%Y-%m') AS competencia, "
    f"{dbl('faturamento', 'margem_bruta')}, pedidos, CAST(quantidade AS BIGINT) AS quantidade, "
    "R2(CAST(faturamento AS DOUBLE) / pedidos) AS ticket_medio, "
    f"{pct2('faturamento', 'SUM(faturamento) OVER (PARTITION BY ano, mes)')} AS market_share_pct, "
    "CAST(DENSE_RANK() OVER (PARTITION BY ano, mes ORDER BY faturamento DESC) AS INTEGER) AS ranking_receita, "
    f"{pct2('margem_bruta', 'faturamento')} AS margem_bruta_pct FROM loja_mes JOIN dim_loja USING (loja_id)",
)
add(
    "E3_top_produtos",
    lambda wh: marts.kpi_products(
        wh.fato("status", "produto_id", "produto_nome", "categoria", "valor_liquido", "quantidade")
    ),
    f"SELECT produto_id, produto_nome, categoria, {dbl('faturamento')}, volume, "
    "CAST(DENSE_RANK() OVER (ORDER BY faturamento DESC) AS INTEGER) AS ranking_receita, "
    "CAST(DENSE_RANK() OVER (ORDER BY volume DESC) AS INTEGER) AS ranking_volume "
    "FROM (SELECT produto_id, produto_nome, categoria, SUM(valor_liquido) AS faturamento, "
    "CAST(SUM(quantidade) AS BIGINT) AS volume FROM concluidas GROUP BY ALL)",
)
add("E4_dre_gerencial", lambda wh: wh.shared(*DRE_MEDIDAS).dre(), f"SELECT {DRE} FROM dre")


def _fpa(wh: SampleStar) -> DataFrame:
    orcamento = wh.shared("faturamento", "margem_bruta", "dias").orcamento()
    realizado = {"faturamento": "receita_realizada", "dias": "dias_com_venda"}
    totais = wh.loja_mes("faturamento", "margem_bruta", "dias").withColumnsRenamed(realizado)
    return marts.fpa_indicators(
        orcamento, totais.select("loja_id", "ano", "mes", "receita_realizada", "margem_bruta", "dias_com_venda")
    )


_REAL = "CAST(receita_realizada AS DOUBLE)"
_DIARIA = f"{_REAL} / CASE WHEN dias_com_venda = 0 THEN 1 ELSE dias_com_venda END"
_PREV = f"{_DIARIA} * day(last_day(make_date(ano, mes, 1)))"
_MARGEM = "CAST(margem_bruta AS DOUBLE) / CASE WHEN receita_realizada = 0 THEN 1 ELSE CAST(receita_realizada AS DOUBLE) END * 100"
_ATING = f"{_REAL} / CAST(receita_orcada AS DOUBLE)"


def _posicao(expressao: str, nome: str) -> str:
    return f"CAST(DENSE_RANK() OVER (PARTITION BY ano, mes ORDER BY {expressao} DESC) AS INTEGER) AS {nome}"


add(
    "E5_indicadores_fpa",
    _fpa,
    f"SELECT loja_id, ano, mes, {dbl('receita_orcada')}, CAST(39 AS DOUBLE) AS margem_bruta_orcada, "
    "CAST(ROUND(receita_orcada * CAST(0.05 AS DECIMAL(2,2)), 2) AS DOUBLE) AS despesas_fixas_orcadas, "
    f"{dbl('receita_realizada', 'margem_bruta')}, dias_com_venda, "
    "CAST(receita_realizada - receita_orcada AS DOUBLE) AS variacao_absoluta, "
    f"{pct2('receita_realizada - receita_orcada', 'receita_orcada')} AS variacao_percentual, "
    f"R2({_ATING} * 100) AS meta_atingida_pct, R2({_DIARIA}) AS media_diaria, "
    f"R2({_PREV}) AS forecast_mes, R2({_PREV} * 12) AS run_rate_anual, "
    f"R2({_MARGEM}) AS margem_bruta_pct_realizada, {_posicao(_REAL, 'ranking_receita')}, "
    f"{_posicao(_MARGEM, 'ranking_margem')}, {_posicao(_ATING + ' * 100', 'ranking_meta')}, "
    f"CASE WHEN {_ATING} < 0.80 THEN 'VERMELHO' WHEN {_ATING} < 0.95 THEN 'AMARELO' ELSE 'VERDE' END AS status_semaforo "
    "FROM (SELECT o.loja_id, o.ano, o.mes, o.receita_orcada, COALESCE(m.faturamento, 0) AS receita_realizada, "
    "COALESCE(m.margem_bruta, 0) AS margem_bruta, COALESCE(m.dias, 0) AS dias_com_venda "
    "FROM orcamento o LEFT JOIN loja_mes m USING (loja_id, ano, mes))",
)
add(
    "E6_dias_com_venda",
    lambda wh: wh.loja_mes("dias"),
    "SELECT ano, mes, loja_id, COUNT(DISTINCT data) AS dias FROM concluidas GROUP BY ano, mes, loja_id",
)

# Dashboard snapshots

_SOMAS = ", ".join(
    f"CAST(COALESCE(SUM({o}) FILTER (WHERE status = 'CONCLUIDA'), 0) AS DOUBLE) AS {n}"
    for n, o in (
        ("receita_liquida", "valor_liquido"),
        ("receita_bruta", "valor_bruto"),
        ("descontos", "desconto_valor"),
        ("margem_bruta", "margem_bruta"),
    )
)
_CONTAGENS = (
    "COUNT(DISTINCT id_venda) FILTER (WHERE status = 'CONCLUIDA') AS pedidos, "
    "COUNT(*) FILTER (WHERE status = 'CANCELADA') AS canceladas, COUNT(*) FILTER (WHERE status = 'PENDENTE') AS pendentes"
)
_TICKET = "COALESCE(v.receita_liquida / NULLIF(v.pedidos, 0), 0) AS ticket_medio"
add(
    "M1_resumo_do_mes",
    lambda wh: snapshots.overview(wh, ANO, MES),
    f"SELECT *, {_TICKET}, CASE WHEN receita_liquida > 0 THEN R2(margem_bruta / receita_liquida * 100) ELSE 0 END "
    f"AS margem_pct FROM (SELECT {_SOMAS}, {_CONTAGENS} FROM fato {DO_MES}) v",
)
add(
    "M2_dre_do_mes",
    lambda wh: snapshots.dre_totals(wh.shared(*DRE_MEDIDAS), ANO, MES),
    "SELECT CAST(SUM(receita_liquida) AS DOUBLE) AS receita_liquida, CAST(SUM(lucro_bruto) AS DOUBLE) AS lucro_bruto, "
    "CAST(SUM(ebitda) AS DOUBLE) AS ebitda, CAST(SUM(resultado_antes_ir) AS DOUBLE) AS resultado_antes_ir, "
    f"{pct('SUM(ebitda)', 'SUM(receita_liquida)')} AS margem_ebitda_pct FROM dre {DO_MES}",
)
add(
    "M3_tendencia_mensal",
    snapshots.revenue_trend,
    f"SELECT ano, mes, {dbl('receita_liquida')}, ticket_medio, CAST(receita_liquida AS DOUBLE) / "
    "CAST(GREATEST(MAX(receita_liquida) OVER (), 1) AS DOUBLE) AS escala FROM v1",
)
add(
    "M4_lojas_do_mes",
    lambda wh: snapshots.store_table(wh, ANO, MES),
    f"SELECT v2.loja_id, v2.loja_nome, {dbl('faturamento')}, market_share_pct, crescimento_mom, ranking, "
    f"{dbl('receita_orcada')}, variacao_pct, status_semaforo "
    f"FROM v2 JOIN v5 USING (ano, mes, loja_id) {DO_MES}",
)
_PRODUTOS = (
    f"SELECT produto_id, produto_nome, categoria, {dbl('receita')}, volume, ranking_receita FROM v8 {DO_MES} "
    "AND ranking_receita <= 10"
)
add("M5_produtos_do_mes", lambda wh: snapshots.month_products(wh, ANO, MES), _PRODUTOS)
add(
    "G5_barras_de_produtos",
    lambda wh: snapshots.product_bars(wh, ANO, MES),
    f"SELECT *, receita / GREATEST(MAX(receita) OVER (), 1) * 100 AS largura_pct FROM ({_PRODUTOS}) "
    "ORDER BY ranking_receita, produto_id LIMIT 6",
)
add(
    "M6_fpa_do_mes",
    lambda wh: snapshots.fpa_by_store(wh, ANO, MES),
    f"SELECT loja_id, loja_nome, {dbl('realizado', 'receita_orcada')}, meta_atingida_pct, forecast_mes, run_rate_anual "
    f"FROM v7 JOIN dim_loja USING (loja_id) {DO_MES}",
)
add(
    "M7_canais_do_mes",
    lambda wh: snapshots.channel_mix(wh, ANO, MES),
    "SELECT canal_venda, CAST(SUM(receita) AS DOUBLE) AS receita, CAST(SUM(pedidos) AS BIGINT) AS pedidos "
    f"FROM v9 {DO_MES} GROUP BY canal_venda",
)
add(
    "M8_contadores_pipeline",
    lambda wh: snapshots.pipeline_counters(wh.with_ledger()),
    "SELECT (SELECT COUNT(*) FROM arquivos) AS arquivos_processados, (SELECT COUNT(*) FROM fato) AS fatos_carregados, "
    "(SELECT strftime(MAX(created_at), '%Y-%m-%dT%H:%M:%S') FROM auditoria) AS ultima_execucao, "
    "(SELECT COUNT(*) FROM auditoria WHERE status = 'FAILED') AS falhas",
)
add(
    "M9_lojas_ativas",
    lambda wh: forecast.active_stores(wh),
    "SELECT loja_id, loja_nome FROM dim_loja WHERE ativa",
)
add(
    "M10_serie_da_rede",
    forecast.network_series,
    f"SELECT competencia, ano, mes, {dbl('receita_liquida', 'ebitda')}, ticket_medio, total_pedidos, margem_ebitda_pct, "
    "cancelamento_pct FROM rede_mes",
)
add(
    "M11_serie_por_loja",
    forecast.store_series,
    f"SELECT competencia, ano, mes, loja_id, loja_nome, {dbl('receita', 'receita_orcada')}, market_share_pct, "
    "crescimento_mom, ticket_medio, margem_pct, meta_atingida_pct, forecast_mes FROM serie_loja",
)


def _future(wh: SampleStar) -> DataFrame:
    wh = wh.shared("faturamento")
    return forecast.future_budgets(wh, forecast.latest_network_month(wh))


add(
    "M12_orcamento_futuro",
    _future,
    "SELECT strftime(make_date(ano, mes, 1), '%Y-%m') AS competencia, loja_id, CAST(receita_orcada AS DOUBLE) "
    "AS receita_orcada FROM orcamento, ultima WHERE make_date(ano, mes, 1) > ultima",
)
add("M13_forecast_gerencial", lambda wh: forecast.store_projection(wh, MESES, AJUSTE), "SELECT * FROM gerencial")
add("M14_forecast_rede", lambda wh: forecast.network_projection(wh, MESES, AJUSTE), "SELECT * FROM gerencial_rede")
add("M15_regressao", forecast.ml_models, "SELECT * FROM modelos")
add("M16_projecao_regressao", lambda wh: forecast.ml_projection(wh, MESES), "SELECT * FROM ml")
add("M17_backtest", forecast.ml_backtest, "SELECT * FROM teste")
add(
    "M18_forecast_ml",
    lambda wh: forecast.ml_forecast(wh, MESES),
    "SELECT m.*, d.* EXCLUDE (serie, entidade), t.competencia AS competencia_teste, "
    "t.* EXCLUDE (serie, entidade, competencia) FROM ml m JOIN modelos d USING (serie) LEFT JOIN teste t USING (serie)",
)
add(
    "E18_totais_do_horizonte",
    lambda wh: forecast.horizon_totals(forecast.network_projection(wh, MESES, AJUSTE)),
    "SELECT *, forecast_com_orcamento - total_orcamento AS variacao_total, "
    "(total_forecast - total_base) / total_base * 100 AS delta_pct FROM ("
    "SELECT CAST(SUM(CAST(forecast_ajustado AS DECIMAL(18,2))) AS DOUBLE) AS total_forecast, "
    "CAST(SUM(CAST(forecast_base AS DECIMAL(18,2))) AS DOUBLE) AS total_base, "
    "CAST(COALESCE(SUM(CAST(receita_orcada AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_orcamento, "
    "CAST(COALESCE(SUM(CAST(forecast_ajustado AS DECIMAL(18,2))) FILTER (WHERE receita_orcada IS NOT NULL), 0) AS DOUBLE) "
    "AS forecast_com_orcamento FROM gerencial_rede)",
)
add(
    "F7_tendencia",
    lambda wh: forecast.trend(forecast.store_series(wh), forecast.latest_network_month(wh)),
    "SELECT loja_id, tendencia FROM tendencia",
)
add(
    "F8_variacao_lojas",
    lambda wh: forecast.last_two(forecast.store_series(wh), "loja_id", "receita"),
    f"SELECT loja_id, competencia, CAST(receita AS DOUBLE) AS atual, CAST(anterior AS DOUBLE) AS anterior, "
    f"{pct('receita - anterior', 'anterior')} AS variacao_pct FROM (SELECT *, "
    "LAG(receita) OVER (PARTITION BY loja_id ORDER BY competencia) AS anterior, "
    "ROW_NUMBER() OVER (PARTITION BY loja_id ORDER BY competencia DESC) AS n FROM serie_loja) WHERE n = 1",
)
add(
    "F8_variacao_rede",
    lambda wh: forecast.last_two(forecast.network_revenue(wh), None, "ebitda"),
    f"SELECT competencia, CAST(ebitda AS DOUBLE) AS atual, CAST(anterior AS DOUBLE) AS anterior, "
    f"{pct('ebitda - anterior', 'anterior')} AS variacao_pct FROM (SELECT *, "
    "LAG(ebitda) OVER (ORDER BY competencia) AS anterior, ROW_NUMBER() OVER (ORDER BY competencia DESC) AS n "
    "FROM rede_mes) WHERE n = 1",
)
add(
    "F9_margem_ebitda_recente",
    lambda wh: forecast.recent_ebitda_margin(forecast.network_revenue(wh)),
    "SELECT margem FROM margem_rede",
)


def _axis(wh: SampleStar) -> DataFrame:
    rede = forecast.network_revenue(wh).select("competencia", c("receita_liquida").alias("receita"))
    projecao = forecast.network_projection(wh, MESES, AJUSTE)
    return snapshots.period_axis(rede, projecao.select("competencia", c("forecast_base").alias("receita")))


add(
    "H5_eixo_de_periodos",
    _axis,
    "SELECT competencia, GREATEST(MAX(MAX(r)) OVER (), 1) AS maximo, LEAST(MIN(MIN(r)) OVER (), 0) AS minimo FROM ("
    "SELECT competencia, CAST(receita_liquida AS DOUBLE) AS r FROM rede_mes "
    "UNION ALL SELECT competencia, forecast_base FROM gerencial_rede) GROUP BY competencia",
)

# Quality status

add(
    "M19_resumo_qualidade",
    lambda wh: quality_status.overview(wh.with_ledger()),
    f"SELECT * EXCLUDE (ultima_atualizacao_arquivo, ultima_data_referencia, ultima_execucao), "
    f"{iso_time('ultima_atualizacao_arquivo')}, {iso_date('ultima_data_referencia')}, {iso_time('ultima_execucao')} "
    "FROM resumo_qualidade",
)
_JANELA = "WHERE data_referencia >= (SELECT MAX(data_referencia) FROM {t}) - 13"
_FILTROS = ", ".join(
    f"COUNT(*) FILTER (WHERE status = '{s}') AS {n}"
    for n, s in (("processados", "PROCESSED"), ("reprocessados", "REPROCESSED"), ("falhas", "FAILED"))
)
_QUARENTENA = "COUNT(*) FILTER (WHERE status = 'QUARANTINED') AS quarentenados"
_REGISTROS = ", ".join(
    f"CAST(COALESCE(SUM({r}), 0) AS BIGINT) AS {r}" for r in ("registros_lidos", "registros_validos", "registros_invalidos")
)
_APROVACAO = f"CAST({aprovacao('registros_lidos', 'registros_invalidos')} AS DOUBLE) AS taxa_aprovacao"
add(
    "M20_qualidade_diaria",
    quality_status.daily_quality,
    f"SELECT *, {_APROVACAO} FROM (SELECT {iso_date('data_referencia')}, COUNT(*) AS arquivos, "
    f"COUNT(DISTINCT loja_id) AS lojas, {_FILTROS}, {_QUARENTENA}, {_REGISTROS}, "
    "strftime(MAX(updated_at), '%Y-%m-%dT%H:%M:%S') AS atualizado_em FROM arquivos "
    f"{_JANELA.format(t='arquivos')} GROUP BY arquivos.data_referencia)",
)
add(
    "M21_qualidade_por_tarefa",
    quality_status.task_quality,
    f"SELECT *, {_APROVACAO} FROM (SELECT task_id, status, COUNT(*) AS execucoes, {_REGISTROS}, "
    "CAST(SUM(registros_inseridos) AS BIGINT) AS registros_inseridos, "
    "CAST(SUM(registros_ignorados) AS BIGINT) AS registros_ignorados, "
    "CAST(SUM(duracao_segundos) AS DOUBLE) / COUNT(*) AS duracao_media_segundos, "
    "strftime(MAX(created_at), '%Y-%m-%dT%H:%M:%S') AS ultima_execucao FROM auditoria "
    f"{_JANELA.format(t='auditoria')} GROUP BY task_id, status)",
)
_ARQUIVO = (
    f"file_id, file_path, checksum, {iso_date('data_referencia')}, camada_destino, status, registros_lidos, "
    f"registros_validos, registros_invalidos, pipeline_version, {iso_time('processed_at')}, {iso_time('updated_at')}"
)
add(
    "M22_arquivos_recentes",
    quality_status.recent_files,
    f"SELECT {_ARQUIVO}, loja_id, COALESCE(loja_nome, 'Loja ' || loja_id) AS loja_nome "
    "FROM arquivos LEFT JOIN dim_loja USING (loja_id) ORDER BY arquivos.updated_at DESC, file_id DESC LIMIT 30",
)
add(
    "M22_execucoes_recentes",
    quality_status.recent_runs,
    f"SELECT audit_id, dag_id, run_id, task_id, {iso_date('data_referencia')}, status, registros_lidos, "
    f"registros_validos, registros_invalidos, registros_inseridos, registros_ignorados, {dbl('duracao_segundos')}, "
    f"mensagem, {iso_time('created_at')} FROM auditoria ORDER BY auditoria.created_at DESC, audit_id DESC LIMIT 25",
)
_COBERTURA = f"SELECT * EXCLUDE (atualizado_em), {iso_time('atualizado_em')} FROM cobertura"
add("M23_cobertura", quality_status.coverage, _COBERTURA)


def _messages(wh: SampleStar) -> DataFrame:
    wh = wh.with_ledger()
    return quality_status.messages(quality_status.overview(wh), quality_status.coverage(wh))


add(
    "M24_mensagens",
    _messages,
    "SELECT CAST(ROW_NUMBER() OVER (ORDER BY i) AS INTEGER) AS ordem, mensagem FROM ("
    f"SELECT 1 AS i, '{quality_status.MSG_FALHAS}' AS mensagem FROM resumo_qualidade "
    "WHERE falhas_arquivo > 0 OR execucoes_falha > 0 "
    f"UNION ALL SELECT 2, '{quality_status.MSG_REJEICOES}' FROM resumo_qualidade WHERE total_rejeicoes > 0 "
    f"UNION ALL SELECT 3, '{quality_status.MSG_COBERTURA}' "
    "WHERE EXISTS (SELECT 1 FROM cobertura WHERE arquivos < 3))",
)

# Store detail

add(
    "M25_cadastro_da_loja",
    lambda wh: snapshots.store_master(wh, LOJA),
    f"SELECT * EXCLUDE (data_abertura), {iso_date('data_abertura')} FROM dim_loja WHERE loja_id = {LOJA}",
)
add(
    "M26_resumo_da_loja",
    lambda wh: snapshots.store_overview(wh, LOJA, ANO, MES),
    f"SELECT v.* EXCLUDE (descontos), {LOJA} AS loja_id, {_TICKET}, r.ranking, r.market_share_pct, r.crescimento_mom, "
    f"{dbl('m.receita_orcada', 'm.variacao_absoluta')}, m.variacao_pct, m.status_semaforo, f.meta_atingida_pct, "
    f"f.forecast_mes, f.run_rate_anual, {dbl('d.ebitda')}, d.margem_ebitda_pct "
    f"FROM (SELECT {_SOMAS}, {_CONTAGENS} FROM fato {DA_LOJA}) v "
    f"LEFT JOIN (SELECT * FROM v2 {DA_LOJA}) r ON TRUE LEFT JOIN (SELECT * FROM v5 {DA_LOJA}) m ON TRUE "
    f"LEFT JOIN (SELECT * FROM v7 {DA_LOJA}) f ON TRUE LEFT JOIN (SELECT * FROM dre {DA_LOJA}) d ON TRUE",
)
add(
    "M27_produtos_da_loja",
    lambda wh: snapshots.store_products(wh, LOJA, ANO, MES),
    "SELECT produto_id, produto_nome, categoria, CAST(SUM(valor_liquido) AS DOUBLE) AS receita, "
    "CAST(SUM(quantidade) AS BIGINT) AS volume, CAST(SUM(margem_bruta) AS DOUBLE) AS margem_bruta, "
    f"{pct('SUM(margem_bruta)', 'SUM(valor_liquido)')} AS margem_pct FROM concluidas {DA_LOJA} "
    "GROUP BY produto_id, produto_nome, categoria ORDER BY receita DESC, produto_id LIMIT 10",
)
add(
    "M28_canais_da_loja",
    lambda wh: snapshots.store_channels(wh, LOJA, ANO, MES),
    "SELECT canal_venda, forma_pagamento, COUNT(DISTINCT id_venda) AS pedidos, "
    "CAST(SUM(valor_liquido) AS DOUBLE) AS receita, "
    "CAST(SUM(valor_liquido) AS DOUBLE) / COUNT(DISTINCT id_venda) AS ticket_medio "
    f"FROM concluidas {DA_LOJA} GROUP BY canal_venda, forma_pagamento",
)
add(
    "M29_status_da_loja",
    lambda wh: snapshots.store_status(wh, LOJA, ANO, MES),
    "SELECT status, COUNT(*) AS registros, CAST(SUM(valor_liquido) AS DOUBLE) AS valor_liquido "
    f"FROM fato {DA_LOJA} GROUP BY status",
)
add(
    "M30_qualidade_da_loja",
    lambda wh: snapshots.store_quality(wh, LOJA),
    f"SELECT *, {_APROVACAO} FROM (SELECT {iso_date('data_referencia')}, COUNT(*) AS arquivos, {_FILTROS}, {_REGISTROS}, "
    f"strftime(MAX(updated_at), '%Y-%m-%dT%H:%M:%S') AS atualizado_em FROM arquivos WHERE loja_id = {LOJA} "
    "GROUP BY arquivos.data_referencia ORDER BY arquivos.data_referencia DESC LIMIT 15)",
)
add(
    "M30_arquivos_da_loja",
    lambda wh: snapshots.store_files(wh, LOJA),
    f"SELECT {_ARQUIVO} FROM arquivos WHERE loja_id = {LOJA} ORDER BY arquivos.updated_at DESC, file_id DESC LIMIT 15",
)
add(
    "M31_perspectiva_da_loja",
    lambda wh: snapshots.store_outlook(wh, LOJA, MESES),
    "SELECT g.loja_id, g.loja_nome, g.competencia, g.forecast_base, g.forecast_base AS forecast_ajustado, "
    "g.receita_orcada, g.tendencia_pct, "
    f"{pct2('base_exata', 'g.receita_orcada')} AS meta_atingida_pct, m.previsao, m.limite_inferior, m.limite_superior "
    "FROM (SELECT *, forecast_base AS base_exata FROM gerencial) g "
    f"JOIN ml m ON m.competencia = g.competencia AND m.serie = g.loja_id WHERE g.loja_id = {LOJA}",
)
add(
    "E20_fatos_por_mes",
    snapshots.monthly_counts,
    "SELECT ano, mes, COUNT(*) AS vendas FROM fato GROUP BY ano, mes",
)
add(
    "E20_registros_por_status",
    snapshots.status_counts,
    "SELECT status, COUNT(*) AS registros FROM fato GROUP BY status",
)
add(
    "E21_competencias",
    snapshots.months,
    "SELECT DISTINCT strftime(data_venda, '%Y-%m') AS competencia FROM fato",
)
add(
    "E22_competencia_recente",
    snapshots.latest_month,
    "SELECT strftime(MAX(data_venda), '%Y-%m') AS competencia FROM concluidas",
)

# Alerts

_UM = "CAST(ROUND(CAST({v} AS DECIMAL(38,6)), 1) AS VARCHAR)"


def _um(valor: str) -> str:
    return _UM.format(v=valor)


def _alerta(
    regra: int, sequencia: str, tipo: str, severidade: str, entidade: str, loja: str, titulo: str, descricao: str,
    acao: str, valor: str, limite: str, origem: str,
) -> str:
    return (
        f"SELECT {regra} AS regra, {sequencia} AS sequencia, '{tipo}' AS type, {severidade} AS severity, "
        f"{entidade} AS entity, {loja} AS loja_id, {titulo} AS title, {descricao} AS description, '{acao}' AS action, "
        f"R2(CAST({valor} AS DOUBLE)) AS metric_value, '{limite}' AS threshold FROM {origem}"
    )


_LOJAS_K = (
    "(SELECT v2.loja_id, v2.loja_nome, COALESCE(crescimento_mom, 0) AS queda, COALESCE(variacao_pct, 0) AS meta, "
    "status_semaforo, ROW_NUMBER() OVER (ORDER BY ranking, v2.loja_id) AS p "
    "FROM v2 JOIN v5 USING (ano, mes, loja_id) JOIN ultimo_mes USING (ano, mes))"
)
_CANCEL_K = (
    f"(SELECT loja_id, loja_nome, {pct('canceladas', 'registros')} AS taxa "
    "FROM status_mes JOIN dim_loja USING (loja_id) JOIN ultimo_mes USING (ano, mes))"
)
_DIVERGENCIA = (
    "(SELECT g.loja_id, g.loja_nome, g.forecast_base AS forecast_ajustado, m.previsao, "
    f"COALESCE({pct('abs(m.previsao - g.forecast_base)', 'g.forecast_base')}, 0) AS divergencia_pct "
    "FROM gerencial g JOIN ml m ON m.serie = g.loja_id AND m.passo = 1 WHERE g.passo = 1)"
)
K1 = _alerta(
    1, "p * 2", "META", "CASE WHEN meta <= -20 THEN 'CRITICO' ELSE 'ALTO' END", "loja_nome", "loja_id",
    "loja_nome || ' abaixo da meta'",
    f"'A loja está ' || {_um('abs(meta)')} || '% abaixo do orçamento da competência.'",
    alerts.ACAO_META_VERMELHA, "meta", "Meta mínima de 80% do orçamento",
    f"{_LOJAS_K} WHERE status_semaforo = 'VERMELHO'",
) + " UNION ALL " + _alerta(
    1, "p * 2", "META", "'MEDIO'", "loja_nome", "loja_id", "loja_nome || ' perto de ficar abaixo da meta'",
    f"'{alerts.DESCRICAO_META_AMARELA}'", alerts.ACAO_META_AMARELA, "meta", "Meta saudável acima de 95%",
    f"{_LOJAS_K} WHERE status_semaforo = 'AMARELO'",
)
K2 = _alerta(
    1, "p * 2 + 1", "RECEITA", "CASE WHEN queda <= -18 THEN 'ALTO' ELSE 'MEDIO' END", "loja_nome", "loja_id",
    "'Queda de receita em ' || loja_nome",
    f"'A receita mensal caiu ' || {_um('abs(queda)')} || '% contra a competência anterior.'",
    alerts.ACAO_RECEITA, "queda", "Queda superior a 10% mês contra mês", f"{_LOJAS_K} WHERE queda <= -10",
)
K3 = _alerta(
    2, "ROW_NUMBER() OVER (ORDER BY margem_pct, loja_id)", "MARGEM",
    "CASE WHEN margem_pct < 20 THEN 'ALTO' ELSE 'MEDIO' END", "loja_nome", "loja_id",
    "'Margem baixa em ' || loja_nome", f"'A margem bruta da loja está em ' || {_um('margem_pct')} || '%.'",
    alerts.ACAO_MARGEM, "margem_pct", "Margem bruta mínima de 25%",
    "v4 JOIN ultimo_mes USING (ano, mes) WHERE margem_pct < 25",
)
K4 = _alerta(
    3, "ROW_NUMBER() OVER (ORDER BY taxa DESC, loja_id)", "CANCELAMENTO",
    "CASE WHEN taxa >= 12 THEN 'ALTO' ELSE 'MEDIO' END", "loja_nome", "loja_id",
    "'Cancelamento elevado em ' || loja_nome", f"'A taxa de cancelamento está em ' || {_um('taxa')} || '% na competência.'",
    alerts.ACAO_CANCELAMENTO, "taxa", "Taxa de cancelamento acima de 8%", f"{_CANCEL_K} WHERE taxa >= 8",
)
_NULO = "CAST(NULL AS INTEGER)"
K5 = _alerta(
    4, "1", "PIPELINE", "'CRITICO'", "'Rede'", _NULO, "'Falha registrada no pipeline'",
    f"'{alerts.DESCRICAO_PIPELINE}'", alerts.ACAO_PIPELINE, "execucoes_falha", "Zero falhas de execução",
    "resumo_qualidade WHERE execucoes_falha > 0",
)
K6 = _alerta(
    5, "1", "QUALIDADE", "'ALTO'", "'Rede'", _NULO, "'Registros inválidos detectados'",
    f"'{alerts.DESCRICAO_REJEICOES}'", alerts.ACAO_REJEICOES, "total_rejeicoes", "Zero registros inválidos",
    "resumo_qualidade WHERE total_rejeicoes > 0",
) + " UNION ALL " + _alerta(
    6, "ROW_NUMBER() OVER (ORDER BY loja_id)", "QUALIDADE", "'ALTO'", "loja_nome", "loja_id",
    "'Cobertura incompleta em ' || loja_nome",
    "'A última data processada possui ' || arquivos || ' arquivo(s) para a loja.'",
    alerts.ACAO_COBERTURA, "arquivos", "Três arquivos por loja no fechamento diário", "cobertura WHERE arquivos < 3",
)
K7 = _alerta(
    7, "ROW_NUMBER() OVER (ORDER BY loja_id)", "FORECAST", "'MEDIO'", "loja_nome", "loja_id",
    "'Forecast divergente em ' || loja_nome",
    f"'A previsão ML difere ' || {_um('divergencia_pct')} || '% do forecast gerencial do próximo mês.'",
    alerts.ACAO_FORECAST, "divergencia_pct", "Diferença máxima recomendada de 15%",
    f"{_DIVERGENCIA} WHERE divergencia_pct >= 15",
)
_CAMPOS_K = "type, severity, entity, loja_id, title, description, action, metric_value, threshold"


def _rule(nome: str) -> Callable[[SampleStar], DataFrame]:
    def plan(wh: SampleStar) -> DataFrame:
        if nome == "PIPELINE":
            linhas = alerts.pipeline_alerts(quality_status.overview(wh.with_ledger()))
        elif nome == "QUALIDADE":
            wh = wh.with_ledger()
            linhas = alerts.rejection_alerts(quality_status.overview(wh)).unionByName(
                alerts.coverage_alerts(quality_status.coverage(wh))
            )
        elif nome == "FORECAST":
            linhas = alerts.forecast_alerts(_divergence(wh.shared()))
        else:
            wh = wh.shared()
            ano, mes = snapshots.latest_loaded_month(wh)
            if nome == "MARGEM":
                linhas = alerts.margin_alerts(snapshots.of_month(views.store_ranking(wh), ano, mes))
            elif nome == "CANCELAMENTO":
                linhas = alerts.cancellation_alerts(alerts.month_cancellations(wh, ano, mes))
            else:
                linhas = alerts.store_alerts(snapshots.store_table(wh, ano, mes))
        return linhas.where(c("type") == nome).select(*_CAMPOS_K.split(", "))

    return plan


def _divergence(wh: SampleStar) -> DataFrame:
    return alerts.forecast_divergence(forecast.store_projection(wh, 3), forecast.ml_projection(wh, 3))


for _id, _tipo, _regra in (
    ("K1", "META", K1),
    ("K2", "RECEITA", K2),
    ("K3", "MARGEM", K3),
    ("K4", "CANCELAMENTO", K4),
    ("K5", "PIPELINE", K5),
    ("K6", "QUALIDADE", K6),
    ("K7", "FORECAST", K7),
):
    add(f"{_id}_{_tipo.lower()}", _rule(_tipo), f"SELECT {_CAMPOS_K} FROM ({_regra})")

add(
    "D20_divergencia_forecast",
    _divergence,
    f"SELECT * FROM {_DIVERGENCIA}",
)
_TODOS_K = " UNION ALL ".join((K1, K2, K3, K4, K5, K6, K7))
_COMPETENCIA = "(SELECT strftime(make_date(ano, mes, 1), '%Y-%m') FROM ultimo_mes)"
_CENTRAL = (
    "SELECT CAST(ROW_NUMBER() OVER (ORDER BY list_position(['CRITICO','ALTO','MEDIO','INFO'], severity), type, entity, "
    f"emissao) AS INTEGER) AS posicao, competencia || '-' || type || '-' || COALESCE(CAST(loja_id AS VARCHAR), 'rede') "
    f"|| '-' || emissao AS id, {_CAMPOS_K}, CASE WHEN loja_id IS NOT NULL THEN '/lojas/' || loja_id ELSE '/qualidade' END "
    f"AS route, competencia FROM (SELECT *, {_COMPETENCIA} AS competencia, "
    f"ROW_NUMBER() OVER (ORDER BY regra, sequencia) AS emissao FROM ({_TODOS_K}))"
)
add("K9_central_de_alertas", alerts.alert_center, _CENTRAL)
add(
    "E17_alertas_por_severidade",
    lambda wh: alerts.severity_counts(alerts.alert_center(wh)),
    "SELECT CAST(ordem AS INTEGER) AS ordem, severity, COUNT(k.type) AS alertas FROM (VALUES (1, 'CRITICO'), (2, 'ALTO'), "
    f"(3, 'MEDIO'), (4, 'INFO')) s(ordem, severity) LEFT JOIN ({_TODOS_K}) k USING (severity) GROUP BY ordem, severity",
)
add(
    "B24_alertas_filtrados",
    lambda wh: alerts.filter_alerts(alerts.alert_center(wh), "ALTO", "QUALIDADE").select("id", "title"),
    f"SELECT id, title FROM ({_CENTRAL}) WHERE severity = 'ALTO' AND type = 'QUALIDADE'",
)
add(
    "K10_rotulo_da_metrica",
    lambda wh: alerts.alert_center(wh).select(
        "posicao", col.metric_label(c("type"), c("metric_value")).alias("rotulo")
    ),
    "SELECT posicao, CASE WHEN metric_value IS NULL THEN 'Monitoramento' "
    f"WHEN type IN ('META','RECEITA','MARGEM','CANCELAMENTO','FORECAST') THEN translate({_um('metric_value')}, '.', ',') || '%' "
    "ELSE translate(regexp_replace(regexp_replace(format('{:,.3f}', metric_value), '0+$', ''), '[.]$', ''), '.,', ',.') END "
    f"AS rotulo FROM ({_CENTRAL})",
)
add(
    "K8_sem_alertas",
    lambda wh: _calm(wh).select(*_CAMPOS_K.split(", ")),
    f"SELECT 'OPERACAO' AS type, 'INFO' AS severity, 'Rede' AS entity, {_NULO} AS loja_id, "
    f"'Nenhum alerta crítico identificado' AS title, '{alerts.DESCRICAO_OPERACAO}' AS description, "
    f"'{alerts.ACAO_OPERACAO}' AS action, CAST(NULL AS DOUBLE) AS metric_value, CAST(NULL AS VARCHAR) AS threshold "
    "WHERE NOT EXISTS (SELECT 1 FROM status_mes WHERE canceladas > registros)",
)


def _calm(wh: SampleStar) -> DataFrame:
    """The cancellation rule on all stores with a limit that none can reach, so the calm alert must appear."""
    wh = wh.shared()
    limites = replace(PADRAO, cancelamento_medio=100.5, cancelamento_alto=100.5)
    return alerts.calm_alert(alerts.cancellation_alerts(alerts.month_cancellations(wh, *snapshots.latest_loaded_month(wh)), limites))


# Silver

add(
    "B5_valores_financeiros",
    lambda wh: wh.fato(
        "id_venda", "loja_id", "valor_bruto", "valor_liquido", "custo_total", "margem_bruta", "margem_bruta_pct",
        "desconto_pct_calc",
    ),
    f"SELECT id_venda, loja_id, {dbl('valor_bruto', 'valor_liquido', 'custo_total', 'margem_bruta')}, "
    "CASE WHEN valor_liquido > 0 THEN R2(CAST(margem_bruta AS DOUBLE) / CAST(valor_liquido AS DOUBLE) * 100) "
    "ELSE 0 END AS margem_bruta_pct, CAST(desconto_pct AS DOUBLE) AS desconto_pct_calc FROM fato",
)
_CALENDARIO = (
    "CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS data_sk, CAST(year({d}) AS INTEGER) AS ano, "
    "CAST(month({d}) AS INTEGER) AS mes, CAST(day({d}) AS INTEGER) AS dia, CAST(quarter({d}) AS INTEGER) AS trimestre, "
    "CASE WHEN month({d}) <= 6 THEN 1 ELSE 2 END AS semestre, CAST(isodow({d}) AS INTEGER) AS dia_semana, "
    "CAST(week({d}) AS INTEGER) AS semana_ano"
)
add(
    "B6_calendario_de_vendas",
    lambda wh: col.calendar_columns(wh.table("events").select("event_id", c("ts").alias("data_venda"))).drop("data_venda"),
    f"SELECT event_id, {_CALENDARIO.format(d='ts')}, CASE WHEN hour(ts) BETWEEN 6 AND 11 THEN 'MANHA' "
    "WHEN hour(ts) BETWEEN 12 AND 17 THEN 'TARDE' WHEN hour(ts) BETWEEN 18 AND 22 THEN 'NOITE' ELSE 'MADRUGADA' END "
    "AS periodo FROM events",
)
add(
    "B7_periodo_do_dia",
    lambda wh: wh.table("events").groupBy(col.day_period(c("ts")).alias("periodo")).agg(F.count("*").alias("eventos")),
    "SELECT CASE WHEN hour(ts) BETWEEN 6 AND 11 THEN 'MANHA' WHEN hour(ts) BETWEEN 12 AND 17 THEN 'TARDE' "
    "WHEN hour(ts) BETWEEN 18 AND 22 THEN 'NOITE' ELSE 'MADRUGADA' END AS periodo, COUNT(*) AS eventos "
    "FROM events GROUP BY 1",
)
add(
    "B8_duplicatas_removidas",
    lambda wh: silver.removed_duplicates(wh.bronze("id_venda", "loja_id")),
    "SELECT COUNT(*) AS registros_entrada, COUNT(DISTINCT (id_venda, loja_id)) AS registros_unicos, "
    "COUNT(*) - COUNT(DISTINCT (id_venda, loja_id)) AS duplicatas_removidas FROM bronze",
)


def _silver(wh: SampleStar, produto: Column | None = None) -> silver.Silver:
    """The whole Bronze to Silver path on sales whose file order is the order of the sample's own dedup."""
    ordem = F.concat_ws(
        "|", F.date_format("l_shipdate", "yyyyMMdd"), F.lpad(c("l_suppkey").cast("string"), 20, "0"),
        F.lpad(c("l_partkey").cast("string"), 20, "0"), F.lpad(c("l_quantity").cast("int").cast("string"), 6, "0"),
        F.lpad((c("l_extendedprice") * 100).cast("long").cast("string"), 20, "0"),
        F.lpad((c("l_discount") * 100).cast("int").cast("string"), 4, "0"), c("l_returnflag"), c("l_linestatus"),
    )
    bronze = wh.bronze("status", "custo_unitario", "cliente_segmento").withColumns(
        {
            "arquivo_origem": ordem,
            "cliente_segmento": F.concat(F.lit(" "), F.lower("cliente_segmento"), F.lit("\t")),
            "produto_id": c("produto_id") if produto is None else produto,
        }
    )
    return silver.to_silver(bronze.withColumn("status", F.lower("status")), PADRAO.instante)


add(
    "B9_silver_por_status",
    lambda wh: _silver(wh).todas().groupBy("status", "cliente_segmento").agg(
        F.count("*").alias("vendas"),
        F.sum("valor_liquido").alias("valor_liquido"),
        F.sum("margem_bruta").alias("margem_bruta"),
    ),
    "SELECT status, segmento AS cliente_segmento, COUNT(*) AS vendas, CAST(SUM(valor_liquido) AS DOUBLE) AS valor_liquido, "
    "CAST(SUM(margem_bruta) AS DOUBLE) AS margem_bruta FROM fato LEFT JOIN dim_cliente USING (cliente_id) GROUP BY ALL",
)
add(
    "A12_canceladas",
    lambda wh: _silver(wh).canceladas.select("id_venda", "loja_id", "status", "motivo_cancelamento", "valor_liquido"),
    f"SELECT id_venda, loja_id, status, 'Devolução' AS motivo_cancelamento, {dbl('valor_liquido')} FROM fato "
    "WHERE status = 'CANCELADA'",
)
add(
    "B4_rotulos",
    lambda wh: wh.table("customer")
    .groupBy(relabel(c("c_mktsegment"), SEGMENTO).alias("segmento"))
    .agg(F.count("*").alias("clientes")),
    "SELECT segmento, COUNT(*) AS clientes FROM dim_cliente GROUP BY segmento",
)


def _month_math(wh: SampleStar) -> DataFrame:
    meses = wh.table("orders").select(
        col.month_label(F.year("o_orderdate"), F.month("o_orderdate")).alias("competencia")
    ).distinct()
    inicio = col.label_to_date(c("competencia"))
    return meses.select(
        "competencia",
        col.shift_month(c("competencia"), 3).alias("mais_tres"),
        col.month_distance(c("competencia"), F.lit("2002-01")).alias("distancia"),
        col.days_in_month(F.year(inicio), F.month(inicio)).alias("dias"),
        inicio.alias("primeiro_dia"),
    )


add(
    "B18_aritmetica_de_meses",
    _month_math,
    "SELECT strftime(m, '%Y-%m') AS competencia, strftime(m + INTERVAL 3 MONTH, '%Y-%m') AS mais_tres, "
    "CAST(date_diff('month', m, DATE '2002-01-01') AS INTEGER) AS distancia, "
    "CAST(day(last_day(m)) AS INTEGER) AS dias, strftime(m, '%Y-%m-%d') AS primeiro_dia "
    "FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)",
)
add(
    "B22_nome_e_tom_do_arquivo",
    lambda wh: wh.arquivos().select(
        "file_id", col.file_name(c("file_path")).alias("arquivo"), col.status_tone(c("status")).alias("tom")
    ),
    "SELECT file_id, list_extract(string_split(file_path, '/'), -1) AS arquivo, CASE WHEN status = 'PROCESSED' "
    "THEN 'verde' WHEN status = 'REPROCESSED' THEN 'amarelo' ELSE 'vermelho' END AS tom FROM arquivos",
)
add(
    "B25_arredondamento",
    lambda wh: wh.table("lineitem").groupBy("l_returnflag").agg(
        F.sum(
            col.money(c("l_extendedprice").cast("decimal(12,2)") * c("l_discount").cast("decimal(4,2)"))
        ).alias("desconto")
    ),
    "SELECT l_returnflag, CAST(SUM(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)) "
    "AS DOUBLE) AS desconto FROM lineitem GROUP BY l_returnflag",
)

# Quality rules

_LISTADO = "CAST(l_tax AS DECIMAL(4,2)) <> CAST(0.08 AS DECIMAL(4,2))"
_REGRAS_SQL = {
    "id_venda_nao_nulo": "id_venda <> ''",
    "loja_id_valido": "loja_id BETWEEN 1 AND 5",
    "quantidade_positiva": "quantidade > 0",
    "valor_unitario_positivo": "preco > 0",
    "data_venda_valida": "NOT sem_data",
    "status_permitido": "flag IN ('R', 'A')",
    "desconto_nao_negativo": "desconto >= 0",
    "desconto_razoavel": "CAST(quantidade AS DOUBLE) * CAST(preco AS DOUBLE) > 0 AND CAST(desconto AS DOUBLE) <= "
    "CAST(quantidade AS DOUBLE) * CAST(preco AS DOUBLE) * CAST(0.30 AS DOUBLE)",
    "produto_id_valido": _LISTADO,
    "cliente_id_positivo": "o_custkey > 0",
    "custo_menor_que_preco": "custo < preco",
}
_SUJO = (
    "(SELECT CASE WHEN l_tax = 0 AND l_linenumber = 1 THEN '' ELSE 'VND-' || l_orderkey || '-' || l_linenumber END AS "
    "id_venda, l_tax = 0 AND l_linenumber = 2 AS sem_data, l_tax, CAST(loja_id - 1 AS INTEGER) AS loja_id, "
    "l_suppkey AS posicao, o_custkey, l_returnflag AS flag, CAST(l_quantity AS INTEGER) - 1 AS quantidade, "
    "CAST(floor(l_extendedprice * 100 / l_quantity) / 100 AS DECIMAL(12,2)) AS preco, "
    "ROUND(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(1.6 AS DECIMAL(2,1)), 2) AS custo, "
    "ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(l_discount AS DECIMAL(4,2)) - CAST(l_tax AS DECIMAL(4,2))), 2) "
    "AS desconto FROM linhas JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)"
)
_VIOLADAS = "list_filter([" + ", ".join(
    f"CASE WHEN NOT ({ok}) THEN '{nome}' END" for nome, ok in _REGRAS_SQL.items()
) + "], lambda x: x IS NOT NULL)"
_AVALIADAS = (
    f"(SELECT *, len(list_intersect(regras, ['id_venda_nao_nulo','loja_id_valido','quantidade_positiva',"
    "'valor_unitario_positivo','data_venda_valida','status_permitido','desconto_nao_negativo'])) > 0 AS bloqueada "
    f"FROM (SELECT *, {_VIOLADAS} AS regras FROM {_SUJO}))"
)


def _evaluated(wh: SampleStar) -> DataFrame:
    return quality.evaluate(unclean_bronze(wh), wh.dim_produto())


add(
    "C13_registros_invalidos",
    lambda wh: quality.route(_evaluated(wh)).invalidas.select("id_venda", "loja_id", "posicao", "regras_violadas"),
    f"SELECT id_venda, loja_id, posicao, array_to_string(regras, '|') AS regras_violadas FROM {_AVALIADAS} WHERE bloqueada",
)
add(
    "C13_registros_validos",
    lambda wh: quality.route(_evaluated(wh)).validas.select("id_venda", "loja_id", "posicao", "quantidade"),
    f"SELECT id_venda, loja_id, posicao, quantidade FROM {_AVALIADAS} WHERE NOT bloqueada",
)
add(
    "C14_falhas_por_regra",
    lambda wh: quality.failures_by_rule(_evaluated(wh)),
    " UNION ALL ".join(
        f"SELECT {i} AS ordem, '{nome}' AS regra, '{sev}' AS severidade, "
        f"COUNT(*) FILTER (WHERE NOT ({_REGRAS_SQL[nome]})) AS falhas FROM {_SUJO}"
        for i, (nome, sev) in enumerate(quality.schemas.REGRAS_QUALIDADE, 1)
    ),
)
add(
    "C15_relatorio_de_qualidade",
    lambda wh: quality.report(_evaluated(wh)).drop("por_regra"),
    "SELECT COUNT(*) AS total_registros, COUNT(*) FILTER (WHERE bloqueada) AS registros_invalidos, "
    "COUNT(*) FILTER (WHERE NOT bloqueada) AS registros_validos, "
    "R2(CAST(COUNT(*) FILTER (WHERE NOT bloqueada) AS DOUBLE) / COUNT(*) * 100) AS taxa_aprovacao "
    f"FROM {_AVALIADAS}",
)

# Raw envelopes: the sample's sales packed as terminal files, then read back through the input contract

def _envelopes(wh: SampleStar) -> DataFrame:
    return export.package(wh.bronze(), PADRAO.instante)


def _texts(wh: SampleStar) -> DataFrame:
    return export.as_raw_text(_envelopes(wh))


def _checked(wh: SampleStar) -> DataFrame:
    return contract.check(raw.parse(_texts(wh)))


_NOME = "'vendas_' || loja_id || strftime(data, '_%Y%m%d_') || lower(turno) || '-000.json'"
_ARQ = (
    f"(SELECT {_NOME} AS arquivo_origem, loja_id, data, turno, COUNT(*) AS registros, "
    "COUNT(*) FILTER (WHERE cliente_id = 0) AS sem_cliente, COUNT(*) FILTER (WHERE produto_id = 0) AS sem_produto "
    "FROM bronze GROUP BY loja_id, data, turno)"
)
_TEXTO_DA_VENDA = {campo: f"CAST({campo} AS VARCHAR)" for campo in schemas.CAMPOS_VENDA} | {
    "cliente_segmento": "segmento",
    "desconto_percentual": "CAST(CAST(taxa * 100 AS DECIMAL(5,2)) AS VARCHAR)",
    "data_venda": "strftime(data_venda, '%Y-%m-%dT%H:%M:%S')",
    "motivo_cancelamento": "CASE WHEN status = 'CANCELADA' THEN 'Devolução' END",
    "vendedor_id": "'VND-' || l_suppkey",
    "parcelas": "CAST(l_linenumber AS BIGINT)",
    **{campo: f"CAST({campo} AS BIGINT)" for campo in ("loja_id", "cliente_id", "produto_id", "quantidade")},
}
# The array in the order of its fields, and each sale with its keys in alphabetical order.
_ORDEM_DAS_VENDAS = ", ".join(_TEXTO_DA_VENDA[campo] for campo in schemas.CAMPOS_VENDA)
_VENDA_CANONICA = "struct_pack(" + ", ".join(f"{campo} := {_TEXTO_DA_VENDA[campo]}" for campo in sorted(schemas.CAMPOS_VENDA)) + ")"
add(
    "A19_envelopes",
    lambda wh: _envelopes(wh).select("loja_id", "data", "turno", "quantidade_registros", "checksum"),
    f"SELECT loja_id, {iso_date('bronze.data')}, turno, CAST(COUNT(*) AS INTEGER) AS quantidade_registros, "
    f"sha256(CAST(to_json(list({_VENDA_CANONICA} ORDER BY {_ORDEM_DAS_VENDAS})) AS VARCHAR)) AS checksum "
    "FROM bronze LEFT JOIN dim_cliente USING (cliente_id) GROUP BY loja_id, bronze.data, turno",
)
add(
    "A5_arquivos_recusados",
    lambda wh: contract.rejected(_checked(wh).withColumn("erros", F.array_sort("erros"))),
    f"SELECT {iso_date('data')}, arquivo_origem, CASE WHEN sem_cliente > 0 AND sem_produto > 0 "
    "THEN 'venda.cliente_id; venda.produto_id' WHEN sem_cliente > 0 THEN 'venda.cliente_id' "
    f"ELSE 'venda.produto_id' END AS erro FROM {_ARQ} WHERE sem_cliente > 0 OR sem_produto > 0".replace(
        "AS data,", "AS data_referencia,", 1
    ),
)


def _broken(wh: SampleStar) -> DataFrame:
    """Raw files with one fault for each of the first four stores: cut text, wrong version, wrong count, wrong checksum."""
    loja, texto = c("loja_pasta"), c("value")
    return _texts(wh).withColumn(
        "value",
        F.when(loja == 1, F.expr("left(value, length(value) - 20)"))
        .when(loja == 2, F.regexp_replace(texto, '"schema_version":"[^"]*"', '"schema_version":"0"'))
        .when(loja == 3, F.regexp_replace(texto, '"quantidade_registros":', '"quantidade_registros":9'))
        .when(loja == 4, F.regexp_replace(texto, '"checksum":"[^"]*"', f'"checksum":"{"0" * 64}"'))
        .otherwise(texto),
    )


_ERROS = (
    "list_filter([CASE WHEN loja_id = 2 THEN 'schema_version' END, CASE WHEN sem_cliente > 0 THEN 'venda.cliente_id' END, "
    "CASE WHEN sem_produto > 0 THEN 'venda.produto_id' END], lambda x: x IS NOT NULL)"
)
add(
    "A3_arquivos_quebrados",
    lambda wh: contract.rejected(contract.check(raw.parse(_broken(wh))).withColumn("erros", F.array_sort("erros"))),
    "SELECT * FROM (SELECT strftime(data, '%Y-%m-%d') AS data_referencia, arquivo_origem, CASE WHEN loja_id = 1 THEN "
    f"'json_ilegivel' WHEN len({_ERROS}) > 0 THEN array_to_string({_ERROS}, '; ') WHEN loja_id = 3 THEN "
    f"'contagem_divergente' WHEN loja_id = 4 THEN 'checksum_invalido' END AS erro FROM {_ARQ}) WHERE erro IS NOT NULL",
)
add(
    "A6_vendas_achatadas",
    lambda wh: contract.flatten(contract.accepted(_checked(wh)), PADRAO.instante).select(
        "id_venda", "loja_id", "cliente_segmento", "quantidade", "valor_unitario", "desconto_valor", "status", "estado",
        "turno_origem", "arquivo_origem",
    ),
    f"SELECT id_venda, b.loja_id, segmento AS cliente_segmento, quantidade, {dbl('valor_unitario', 'desconto_valor')}, "
    "status, left(loja_nome, 2) AS estado, b.turno AS turno_origem, arquivo_origem FROM bronze b "
    f"JOIN {_ARQ} a ON a.loja_id = b.loja_id AND a.data = b.data AND a.turno = b.turno "
    "LEFT JOIN dim_cliente USING (cliente_id) WHERE sem_cliente = 0 AND sem_produto = 0",
)
add(
    "A8_registros_por_loja",
    lambda wh: contract.counts_by_store(
        contract.flatten(contract.accepted(_checked(wh)), PADRAO.instante), raw.store_list(wh.spark)
    ),
    f"SELECT loja_id, CAST(SUM(registros) AS BIGINT) AS registros FROM {_ARQ} "
    "WHERE sem_cliente = 0 AND sem_produto = 0 GROUP BY loja_id",
)
add(
    "A23_arquivos_por_loja",
    lambda wh: raw.availability(_texts(wh), raw.store_list(wh.spark)),
    f"SELECT loja_id, COUNT(*) AS arquivos, TRUE AS disponivel FROM {_ARQ} GROUP BY loja_id",
)
add(
    "A24_continuar",
    lambda wh: raw.any_available(raw.availability(_texts(wh), raw.store_list(wh.spark))),
    f"SELECT COUNT(*) > 0 AS continuar FROM {_ARQ}",
)
add(
    "A25_perfil_raw",
    lambda wh: raw.profile(raw.parse(_texts(wh))),
    f"SELECT loja_id, turno, CAST(SUM(registros) AS BIGINT) AS registros FROM {_ARQ} GROUP BY loja_id, turno",
)
_RECIBO = (
    "COUNT(*) AS quantidade, CAST(SUM(valor_bruto) AS DOUBLE) AS valor_bruto, CAST(SUM(desconto_valor) AS DOUBLE) AS descontos, "
    "CAST(SUM(valor_liquido) AS DOUBLE) AS valor_liquido, COUNT(*) FILTER (WHERE status = 'CONCLUIDA') AS concluidas, "
    "COUNT(*) FILTER (WHERE status = 'PENDENTE') AS pendentes, COUNT(*) FILTER (WHERE status = 'CANCELADA') AS canceladas"
)
add(
    "E15_totais_do_turno",
    lambda wh: export.shift_totals(wh.bronze("status")),
    f"SELECT loja_id, strftime(bronze.data, '%Y-%m-%d') AS data, turno, {_RECIBO} FROM bronze "
    "GROUP BY loja_id, bronze.data, turno",
)
add(
    "E16_fechamento_do_dia",
    lambda wh: export.day_closing(wh.bronze("status")),
    f"SELECT loja_id, strftime(bronze.data, '%Y-%m-%d') AS data, turno, 'TURNO' AS nivel, CAST(1 AS BIGINT) AS arquivos, "
    f"{_RECIBO} FROM bronze GROUP BY loja_id, bronze.data, turno UNION ALL "
    "SELECT CAST(NULL AS INTEGER), strftime(bronze.data, '%Y-%m-%d'), CAST(NULL AS VARCHAR), 'DIA', "
    f"COUNT(DISTINCT (loja_id, turno)), {_RECIBO} FROM bronze GROUP BY bronze.data",
)
add(
    "E13_registros_por_arquivo",
    lambda wh: load.file_row_counts(
        wh.bronze("status").withColumn("arquivo_checksum", F.when(c("status") != "CANCELADA", c("turno_origem")))
    ),
    "SELECT 'raw/vendas/loja=loja_' || loja_id || strftime(data, '/ano=%Y/mes=%m/dia=%d/vendas_') || loja_id "
    "|| strftime(data, '_%Y%m%d_') || lower(turno) || '.json' AS arquivo_origem, "
    "CASE WHEN status <> 'CANCELADA' THEN turno END AS arquivo_checksum, loja_id, COUNT(*) AS registros "
    "FROM bronze GROUP BY ALL",
)

# Load

_PRIMEIRAS = (
    "(SELECT * FROM bronze QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber, loja_id "
    "ORDER BY data_venda, l_suppkey, produto_id, quantidade, valor_bruto, desconto_valor, status) = 1)"
)


def _versions(wh: SampleStar) -> tuple[DataFrame, DataFrame]:
    """First and last version of every repeated sale: a first load and its correction."""
    colunas = (
        "id_venda", "loja_id", "data_venda", "quantidade", "custo_unitario", "canal_venda", "valor_unitario", "desconto_valor",
        "valor_bruto", "valor_liquido", "custo_total", "margem_bruta", "status",
    )
    vendas = silver.financial_columns(wh.bronze("status", "custo_unitario"))
    chave = ("l_orderkey", "l_linenumber", "loja_id")
    ordem = ("data_venda", "l_suppkey", "produto_id", "quantidade", "valor_bruto", "desconto_valor", "status")
    primeira = silver.keep_last(vendas, chave, [c(o).asc() for o in ordem])
    return primeira.select(*colunas), wh.fato(*colunas)


add(
    "L1_merge_de_fatos",
    lambda wh: load.merge_facts(*_versions(wh)),
    f"SELECT p.id_venda, p.loja_id, {iso_time('p.data_venda')}, p.quantidade, p.custo_unitario::DOUBLE AS custo_unitario, p.canal_venda, "
    f"{dbl('u.valor_unitario', 'u.desconto_valor', 'u.valor_bruto', 'u.valor_liquido', 'u.custo_total', 'u.margem_bruta')}, u.status "
    f"FROM {_PRIMEIRAS} p JOIN fato u USING (l_orderkey, l_linenumber, loja_id)",
)
add(
    "L6_contagem_da_carga",
    lambda wh: load_counts(wh),
    "SELECT COUNT(*) AS registros_recebidos, COUNT(*) FILTER (WHERE ano > 1998) AS registros_inseridos, "
    "COUNT(*) FILTER (WHERE ano = 1998) AS registros_atualizados FROM fato WHERE ano >= 1998",
)


def load_counts(wh: SampleStar) -> DataFrame:
    """A batch that starts in 1998 against a table loaded up to the end of 1998."""
    from balcao.operators.merge import upsert_counts

    fato = wh.fato("id_venda", "loja_id", "ano")
    return upsert_counts(fato.where("ano >= 1998"), fato.where("ano <= 1998"), ["id_venda", "loja_id"])


add(
    "L2_clientes",
    lambda wh: load.customers(wh.bronze("status", "cliente_nome", "cliente_segmento")),
    "SELECT cliente_id, cliente_nome, segmento FROM dim_cliente WHERE cliente_id IN (SELECT cliente_id FROM bronze)",
)
_DIM_TEMPO = (
    f"SELECT {iso_date('data')}, {_CALENDARIO.format(d='data')}, monthname(data) AS nome_mes, "
    "dayname(data) AS nome_dia_semana, isodow(data) IN (6, 7) AS e_fim_semana"
)
add(
    "L3_calendario_das_vendas",
    lambda wh: load.calendar_rows(wh.lines().select(c("l_shipdate").alias("data"))),
    f"{_DIM_TEMPO} FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS data FROM lineitem) t".replace(
        "strftime(data, '%Y-%m-%d')", "strftime(t.data, '%Y-%m-%d')", 1
    ),
)


def _base_budgets(wh: SampleStar) -> DataFrame:
    """Base-year budget of every region of the sample."""
    return wh.spark.read.parquet(f"{wh.sf_dir}/region.parquet").selectExpr(
        "2026 AS ano_base", "CAST(r_regionkey + 1 AS int) AS loja_id",
        "CAST(300000 + 75000 * r_regionkey AS decimal(15,2)) AS receita_mensal",
        "CAST(36 + 0.5 * r_regionkey AS decimal(5,2)) AS margem_bruta_orcada",
        "CAST(24000 + 6000 * r_regionkey AS decimal(15,2)) AS despesas_fixas_orcadas",
    )


_FATOR = "POW(CAST(1.05 AS DOUBLE), ano - 2026)"
add(
    "L4_orcamentos_provisionados",
    lambda wh: load.monthly_budget(_base_budgets(wh), wh.fato("ano")),
    f"SELECT loja_id, ano, mes, {dbl('receita_orcada')}, CAST(margem AS DOUBLE) AS margem_bruta_orcada, "
    f"CAST(ROUND(CAST(CAST(fixas AS DOUBLE) * {_FATOR} AS DECIMAL(18,6)), 2) AS DOUBLE) AS despesas_fixas_orcadas, "
    "CAST(ROUND(receita_orcada * CAST(0.06 AS DECIMAL(2,2)), 2) AS DOUBLE) AS despesas_var_orcadas, "
    "CAST(ROUND(receita_orcada * CAST(0.22 AS DECIMAL(2,2)), 2) AS DOUBLE) AS resultado_orcado FROM ("
    "SELECT loja_id, ano, CAST(m AS INTEGER) AS mes, margem, fixas, CAST(ROUND(CAST(CAST(receita AS DOUBLE) * "
    f"{_FATOR} AS DECIMAL(18,6)), 2) AS DECIMAL(15,2)) AS receita_orcada FROM (SELECT r_regionkey + 1 AS loja_id, "
    "300000 + 75000 * r_regionkey AS receita, CAST(36 + 0.5 * r_regionkey AS DECIMAL(5,2)) AS margem, "
    "24000 + 6000 * r_regionkey AS fixas FROM region) v, (SELECT DISTINCT ano FROM fato) a, generate_series(1, 12) t(m))",
)


def _seed(wh: SampleStar) -> DataFrame:
    base = _base_budgets(wh)
    metas = base.select("loja_id", c("receita_mensal").alias("meta_mensal"))
    return load.seed_budget(metas, base.select("loja_id", "margem_bruta_orcada", "despesas_fixas_orcadas"), 2026)


add(
    "L10_orcamento_semente",
    _seed,
    "SELECT CAST(r_regionkey + 1 AS INTEGER) AS loja_id, CAST(2026 AS INTEGER) AS ano, CAST(m AS INTEGER) AS mes, "
    "CAST(meta AS DOUBLE) AS receita_orcada, 36 + CAST(0.5 AS DOUBLE) * r_regionkey AS margem_bruta_orcada, "
    "CAST(24000 + 6000 * r_regionkey AS DOUBLE) AS despesas_fixas_orcadas, "
    "CAST(ROUND(meta * CAST(0.06 AS DECIMAL(2,2)), 2) AS DOUBLE) AS despesas_var_orcadas, "
    "CAST(ROUND(meta * CAST(0.22 AS DECIMAL(2,2)), 2) AS DOUBLE) AS resultado_orcado "
    "FROM (SELECT *, CAST(300000 + 75000 * r_regionkey AS DECIMAL(15,2)) AS meta FROM region), generate_series(1, 12) t(m)",
)


def _ledger_merge(wh: SampleStar) -> DataFrame:
    """Files seen a second time with a checksum that counts no rejected rows: it differs where some were."""
    guardados = wh.with_ledger().arquivos()
    novo = F.sha2(F.concat_ws("|", "file_path", "registros_lidos", "registros_lidos"), 256)
    vistos = guardados.withColumns({"checksum": novo, "registros_validos": c("registros_lidos")})
    return load.merge_ledger(guardados, vistos).select("file_id", "checksum", "status", "registros_validos", "registros_invalidos")


add(
    "L5_controle_de_arquivos",
    _ledger_merge,
    "SELECT file_id, sha256(file_path || '|' || registros_lidos || '|' || registros_lidos) AS checksum, "
    "CASE WHEN registros_invalidos = 0 THEN 'PROCESSED' ELSE 'REPROCESSED' END AS status, "
    "registros_lidos AS registros_validos, registros_invalidos FROM arquivos",
)


def _dre_merge(wh: SampleStar) -> DataFrame:
    dre = wh.shared(*DRE_MEDIDAS).dre()
    chave = ["loja_id", "ano", "mes"]
    return load.merge_by_key(
        dre.where("ano <= 1999"), dre.where("ano >= 1999"), chave, [x for x in dre.columns if x not in chave]
    )


add("L7_merge_dre", _dre_merge, f"SELECT {DRE} FROM dre")


def _known(wh: SampleStar) -> DataFrame:
    """Fact rows per store; sales of a product that is not listed are dropped."""
    vendas = _silver(wh, mistyped_product()).todas()
    clientes = wh.dim_cliente()
    linhas = load.fact_rows(vendas, wh.dim_loja(), wh.dim_produto(), clientes, PADRAO.instante)
    return linhas.groupBy("loja_id").agg(F.count("*").alias("vendas"), F.sum("valor_liquido").alias("valor_liquido"))


add(
    "D1_fatos_com_dimensoes",
    _known,
    "SELECT loja_id, COUNT(*) AS vendas, CAST(SUM(valor_liquido) AS DOUBLE) AS valor_liquido FROM fato "
    f"JOIN part ON p_partkey = produto_id WHERE {_LISTADO} GROUP BY loja_id",
)

# Whole jobs: the sample's files of each store, month and shift, run through a lake

_MENSAL = (
    "(SELECT loja_id, ano, mes, turno, COUNT(*) AS registros, "
    "bool_or(cliente_id = 0 OR produto_id = 0) AS recusado FROM bronze GROUP BY loja_id, ano, mes, turno)"
)
_ACEITAS = f"(SELECT b.* FROM bronze b JOIN {_MENSAL} m USING (loja_id, ano, mes, turno) WHERE NOT recusado)"
_CARREGADAS = "COUNT(DISTINCT (id_venda, loja_id))"
add(
    "P2_carga_historica",
    sample_job.backfill_twice,
    "SELECT CAST(n AS INTEGER) AS execucao, arquivos_raw, arquivos_rejeitados, extraidos AS registros_extraidos, "
    "extraidos AS registros_validos, CAST(0 AS BIGINT) AS registros_invalidos, extraidos - por_mes AS duplicatas_removidas, "
    "carregadas AS registros_recebidos, CASE n WHEN 1 THEN carregadas ELSE 0 END AS registros_inseridos, "
    "CASE n WHEN 1 THEN 0 ELSE carregadas END AS registros_atualizados, CAST(0 AS BIGINT) AS sem_dimensao FROM "
    f"(SELECT COUNT(*) AS arquivos_raw, COUNT(*) FILTER (WHERE recusado) AS arquivos_rejeitados FROM {_MENSAL}), "
    f"(SELECT COUNT(*) AS extraidos, COUNT(DISTINCT (id_venda, loja_id, ano, mes)) AS por_mes, {_CARREGADAS} AS carregadas "
    f"FROM {_ACEITAS}), generate_series(1, 2) t(n)",
)
add(
    "P1_fatos_carregados",
    sample_job.loaded_facts,
    f"SELECT loja_id, vendas, clientes, primeiro_ano, ultimo_ano, arquivos, CAST(lidos AS BIGINT) AS lidos FROM (SELECT loja_id, {_CARREGADAS} AS vendas, "
    f"COUNT(DISTINCT cliente_id) AS clientes, MIN(ano) AS primeiro_ano, MAX(ano) AS ultimo_ano FROM {_ACEITAS} GROUP BY loja_id) "
    f"JOIN (SELECT loja_id, COUNT(*) AS arquivos, SUM(registros) AS lidos FROM {_MENSAL} WHERE NOT recusado GROUP BY loja_id) USING (loja_id)",
)
_POR_CARGA = f"(SELECT ano <= {sample_job.PRIMEIRA_CARGA} AS carga, COUNT(*) AS lidas, {_CARREGADAS} AS chaves, COUNT(DISTINCT (id_venda, loja_id, ano, mes)) AS silver FROM {_ACEITAS} GROUP BY 1)"
add(
    "A20_auditoria_das_execucoes",
    lambda wh: sample_job.audit_of_runs(wh).where("task_id in ('extrair_bronze', 'validar_qualidade', 'transformar_silver', 'carregar_datawarehouse')"),
    "SELECT task_id, COUNT(*) AS execucoes, COUNT(*) AS sucessos, CAST(SUM(CASE WHEN task_id = 'carregar_datawarehouse' THEN chaves ELSE lidas END) AS BIGINT) AS lidos, "
    f"CASE WHEN task_id = 'carregar_datawarehouse' THEN (SELECT {_CARREGADAS} FROM {_ACEITAS}) ELSE 0 END AS inseridos, TRUE AS tempo_medido, TRUE AS ids_unicos "
    f"FROM {_POR_CARGA}, (VALUES ('extrair_bronze'), ('validar_qualidade'), ('transformar_silver'), ('carregar_datawarehouse')) t(task_id) GROUP BY task_id",
)
QUERIES["A15_marts_por_parcelas"] = Query(
    lambda wh: sample_job.shares_in_steps(wh, _silver(wh).ativas, "kpis_vendas"), QUERIES["E1_kpis_vendas"].oracle
)
add(
    "E8_pedidos_por_bitmap",
    sample_job.orders_by_bitmap,
    "SELECT ano, pedidos, CAST(por_loja AS BIGINT) AS pedidos_por_loja FROM (SELECT ano, COUNT(DISTINCT l_orderkey) AS pedidos FROM concluidas GROUP BY ano) "
    "JOIN (SELECT ano, SUM(n) AS por_loja FROM (SELECT ano, loja_id, COUNT(DISTINCT l_orderkey) AS n FROM concluidas GROUP BY ano, loja_id) GROUP BY ano) USING (ano)",
)


def _found_months(wh: SampleStar) -> DataFrame:
    """Sales of 1997 looked up in a table of all sales: months that filters name, then the keys of those months only."""
    from balcao.operators import bloom

    fato = write_intermediate(wh.fato("id_venda", "loja_id", "ano", "mes"), "fato")
    filtros = write_intermediate(bloom.build(fato, ["id_venda", "loja_id"], ["ano", "mes"], 4096), "filtros")
    procuradas = fato.where("ano = 1997").select("id_venda", "loja_id")
    candidatos = bloom.probe(procuradas, ["id_venda", "loja_id"], filtros, ["ano", "mes"], 4096)
    achadas = candidatos.join(fato, ["id_venda", "loja_id", "ano", "mes"])
    return achadas.groupBy("ano", "mes").agg(F.count("*").alias("vendas"))


add("D18_meses_das_chaves", _found_months, "SELECT ano, mes, COUNT(*) AS vendas FROM fato WHERE ano = 1997 GROUP BY ano, mes")
