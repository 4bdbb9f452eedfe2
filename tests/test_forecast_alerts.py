from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from balcao import schemas
from balcao.functions.columns import metric_label
from balcao.plans import alerts, forecast, quality_status
from balcao.sources.warehouse import FrameWarehouse
from tests.conftest import rows

SERIE = "loja_id int, competencia string, receita double"


def series(spark, valores, loja=1, inicio="2026-01"):
    ano, mes = (int(x) for x in inicio.split("-"))
    linhas = [(loja, f"{ano + (mes - 1 + i) // 12:04d}-{(mes - 1 + i) % 12 + 1:02d}", float(v)) for i, v in enumerate(valores)]
    return spark.createDataFrame(linhas, SERIE)


def month(spark, valor):
    return spark.createDataFrame([(valor,)], "ultima string")


@pytest.mark.parametrize(
    ("valores", "ultima", "esperado"),
    [
        ([100, 110, 121, 133.1, 12], "2026-05", 0.1),
        ([100, 500, 1000], "2026-04", 0.15),
        ([1000, 500, 100], "2026-04", -0.15),
        ([100], "2026-04", 0.0),
        ([100, 50], "2026-02", 0.0),
        ([100, 0, 110], "2026-04", 0.1),
    ],
)
def test_trend(spark, valores, ultima, esperado):
    ((obtido,),) = rows(forecast.trend(series(spark, valores), month(spark, ultima)), "tendencia")
    assert obtido == pytest.approx(esperado, abs=1e-12)


def ml(spark, valores):
    return series(spark, valores).select(F.col("loja_id").alias("serie"), "competencia", F.col("receita").alias("valor"))


def test_regression(spark):
    m = forecast.models(ml(spark, [100, 120, 140])).first()
    assert (m["intercepto"], m["coeficiente_mensal"], m["rmse"], m["r2"], m["observacoes_treino"]) == (100, 20, 0, 1, 3)
    um = forecast.models(ml(spark, [50])).first()
    assert (um["intercepto"], um["coeficiente_mensal"], um["rmse"], um["r2"]) == (50, 0, 0, 1)
    plano = forecast.models(ml(spark, [5, 5, 5, 5])).first()
    assert (plano["coeficiente_mensal"], plano["rmse"], plano["r2"]) == (0, 0, 1)
    zero = forecast.models(ml(spark, [10, 0])).first()
    assert zero["tendencia_mensal_pct"] == 0


def test_regression_projection_and_backtest(spark):
    p = forecast.regression_projection(ml(spark, [100, 120, 140, 160]), month(spark, "2026-04"), 2)
    assert rows(p.orderBy("passo"), "competencia", "previsao", "limite_inferior") == [("2026-05", 180, 180), ("2026-06", 200, 200)]
    t = forecast.backtest(ml(spark, [100, 120, 140, 160])).first()
    assert (t["competencia"], t["previsto"], t["erro_absoluto"], t["erro_percentual_abs"]) == ("2026-04", 160, 0, 0)
    assert forecast.backtest(ml(spark, [100, 120])).count() == 0
    queda = forecast.regression_projection(ml(spark, [100, 50, 1]), month(spark, "2026-03"), 3).orderBy("passo")
    assert {r["previsao"] for r in queda.collect()} == {0.0}


def test_noisy_fit_matches_textbook(spark):
    y = [3.0, 7.0, 4.0, 9.0, 12.0, 8.0]
    n = len(y)
    xm, ym = (n - 1) / 2, sum(y) / n
    b = sum((i - xm) * (v - ym) for i, v in enumerate(y)) / sum((i - xm) ** 2 for i in range(n))
    a = ym - b * xm
    sse = sum((v - a - b * i) ** 2 for i, v in enumerate(y))
    m = forecast.fit(forecast.numbered(ml(spark, y))).first()
    assert m["inclinacao"] == pytest.approx(b) and m["intercepto"] == pytest.approx(a)
    assert m["rmse"] == pytest.approx((sse / n) ** 0.5) and m["r2"] == pytest.approx(1 - sse / sum((v - ym) ** 2 for v in y))


def test_horizon_bounds():
    with pytest.raises(ValueError):
        forecast.check_horizon(13)
    with pytest.raises(ValueError):
        forecast.check_horizon(3, 31)


def test_projection_counts_from_both_ends(spark):
    """Store 2 ends two months before the network: its growth compounds from its own last month."""
    linhas = [(1, "Um", "2026-01", 100.0), (1, "Um", "2026-02", 110.0), (1, "Um", "2026-03", 121.0), (1, "Um", "2026-04", 133.1),
              (2, "Dois", "2026-01", 100.0), (2, "Dois", "2026-02", 110.0)]
    s = spark.createDataFrame(linhas, "loja_id int, loja_nome string, competencia string, receita double").withColumn(
        "forecast_mes", F.col("receita")
    )
    orcado = spark.createDataFrame([("2026-05", 1, Decimal("100.00"))], "competencia string, loja_id int, receita_orcada decimal(15,2)")
    p = {(r["loja_id"], r["passo"]): r for r in forecast.project_stores(s, month(spark, "2026-04"), orcado, 2, 10.0).collect()}
    assert p[1, 1]["forecast_base"] == 146.41 and p[1, 1]["forecast_ajustado"] == 161.05
    assert p[1, 1]["variacao_orcamento"] == 61.05 and p[1, 2]["receita_orcada"] is None
    assert p[2, 1]["competencia"] == "2026-05" and p[2, 1]["forecast_base"] == 146.41
    rede = forecast.project_network(spark.createDataFrame(list(p.values())), spark.createDataFrame([(10.0,)], "margem double"))
    maio = rede.where("passo = 1").first()
    assert (maio["forecast_base"], maio["ebitda_estimado"], maio["receita_orcada"]) == (292.82, 32.21, 100.0)
    totais = forecast.horizon_totals(rede).first()
    assert float(totais["variacao_total"]) == pytest.approx(322.1 - 100) and totais["delta_pct"] == pytest.approx(10, abs=0.01)


def test_last_two_and_margin(spark):
    s = series(spark, [100, 0, 50])
    assert tuple(forecast.last_two(s, "loja_id", "receita").first()) == (1, "2026-03", 50.0, 0.0, None)
    m = spark.createDataFrame([("2026-01", 9.0), ("2026-02", 0.0), ("2026-03", 4.0), ("2026-04", 8.0)], "competencia string, margem_ebitda_pct double")
    assert forecast.recent_ebitda_margin(m).first()[0] == 6.0
    assert forecast.recent_ebitda_margin(m.where("margem_ebitda_pct = 0")).first()[0] == 0.0


# Alerts


def stores(spark, *linhas):
    return spark.createDataFrame(
        linhas, "loja_id int, loja_nome string, ranking int, status_semaforo string, variacao_pct double, crescimento_mom double"
    )


def test_store_rules(spark):
    a = alerts.store_alerts(
        stores(
            spark,
            (1, "A", 3, "VERMELHO", -20.0, -18.0),
            (2, "B", 1, "VERMELHO", None, -10.0),
            (3, "C", 2, "AMARELO", -10.0, -9.99),
            (4, "D", 4, "VERDE", 5.0, None),
        )
    ).orderBy("sequencia")
    assert rows(a, "entity", "type", "severity") == [
        ("B", "META", "ALTO"), ("B", "RECEITA", "MEDIO"), ("C", "META", "MEDIO"), ("A", "META", "CRITICO"), ("A", "RECEITA", "ALTO"),
    ]
    assert "20.0% abaixo" in a.where("severity = 'CRITICO'").first()["description"]


def test_margin_and_cancellation_limits(spark):
    m = spark.createDataFrame([(1, "A", 19.99), (2, "B", 20.0), (3, "C", 25.0), (4, "D", None)], "loja_id int, loja_nome string, margem_pct double")
    assert sorted(rows(alerts.margin_alerts(m), "loja_id", "severity")) == [(1, "ALTO"), (2, "MEDIO"), (4, "ALTO")]
    c = spark.createDataFrame([(1, "A", 12, 100), (2, "B", 8, 100), (3, "C", 7, 100), (4, "D", 0, 0)], "loja_id int, loja_nome string, canceladas long, registros long")
    assert sorted(rows(alerts.cancellation_alerts(c), "loja_id", "severity")) == [(1, "ALTO"), (2, "MEDIO")]


def test_order_ids_and_counts(spark):
    a = alerts.store_alerts(stores(spark, (1, "A", 1, "AMARELO", -10.0, -30.0), (2, "B", 2, "VERMELHO", -50.0, 0.0)))
    fim = alerts.finish(a.unionByName(alerts.calm_alert(a)), "2026-01")
    assert rows(fim, "id", "severity", "route") == [
        ("2026-01-META-2-3", "CRITICO", "/lojas/2"),
        ("2026-01-RECEITA-1-2", "ALTO", "/lojas/1"),
        ("2026-01-META-1-1", "MEDIO", "/lojas/1"),
    ]
    assert rows(alerts.severity_counts(fim), "severity", "alertas") == [("CRITICO", 1), ("ALTO", 1), ("MEDIO", 1), ("INFO", 0)]
    assert alerts.filter_alerts(fim, "ALTO").count() == 1 and alerts.filter_alerts(fim, tipo="META").count() == 2
    nada = a.where("false")
    calmo = alerts.finish(nada.unionByName(alerts.calm_alert(nada)), "2026-01").first()
    assert (calmo["id"], calmo["severity"], calmo["route"]) == ("2026-01-OPERACAO-rede-1", "INFO", "/qualidade")
    rotulos = fim.select(metric_label(F.lit("PIPELINE"), F.col("metric_value")).alias("p"), metric_label(F.lit("META"), F.col("metric_value")).alias("m"))
    assert rotulos.first()["m"] == "-50,0%" and rotulos.first()["p"] == "-50"
    grande = fim.select(metric_label(F.lit("PIPELINE"), F.lit(1234567.25)).alias("p"), metric_label(F.lit("META"), F.lit(1234.56)).alias("m"))
    assert tuple(grande.first()) == ("1.234.567,25", "1234,6%")


def control(spark, arquivos, execucoes):
    t = datetime(2026, 1, 8, 20)
    ledger = [
        (i, f"f{i}", "c", date.fromisoformat(d), loja, "SILVER", st, lidos, lidos - ruins, ruins, "1", t, t)
        for i, (d, loja, st, lidos, ruins) in enumerate(arquivos)
    ]
    log = [
        (i, "x", "r", tarefa, date.fromisoformat(d), st, 10, 10, ruins, 0, 0, Decimal("1.50"), "m", t)
        for i, (d, tarefa, st, ruins) in enumerate(execucoes)
    ]
    return FrameWarehouse(
        spark,
        {
            "processed_files": spark.createDataFrame(ledger, schemas.ARQUIVOS),
            "pipeline_audit_log": spark.createDataFrame(log, schemas.AUDITORIA),
            "dim_loja": spark.createDataFrame([(1, "Um", True), (2, "Dois", True), (3, "Fechada", False)], "loja_id int, loja_nome string, ativa boolean"),
        },
    )


def test_quality_status(spark):
    wh = control(
        spark,
        [("2026-01-07", 1, "PROCESSED", 10, 0), ("2026-01-08", 1, "PROCESSED", 10, 2), ("2026-01-08", 1, "REPROCESSED", 10, 0),
         ("2026-01-08", 9, "FAILED", 0, 0), ("2025-12-01", 2, "PROCESSED", 5, 0)],
        [("2026-01-08", "carregar", "FAILED", 0), ("2026-01-08", "validar", "SUCCESS", 7), ("2025-12-01", "validar", "SUCCESS", 0)],
    )
    o = quality_status.overview(wh).first()
    assert (o["total_arquivos"], o["falhas_arquivo"], o["taxa_aprovacao"], o["total_rejeicoes"]) == (5, 1, 94.29, 7)
    assert o["taxa_sucesso_execucoes"] == 66.67
    assert rows(quality_status.daily_quality(wh), "arquivos", "lojas", "taxa_aprovacao") == [(3, 2, 90.0), (1, 1, 100.0)]
    assert quality_status.daily_quality(wh, 1, "2025-12-01").count() == 3
    assert rows(quality_status.task_quality(wh), "task_id", "execucoes") == [("carregar", 1), ("validar", 1)]
    assert rows(quality_status.coverage(wh), "loja_id", "arquivos", "taxa_aprovacao") == [(1, 2, 90.0), (2, 0, 100.0)]
    assert rows(quality_status.recent_files(wh, 2), "loja_nome") == [("Dois",), ("Loja 9",)]
    m = quality_status.messages(quality_status.overview(wh), quality_status.coverage(wh))
    assert [r["ordem"] for r in m.collect()] == [1, 2, 3]
    bom = control(spark, [("2026-01-08", loja, "PROCESSED", 1, 0) for loja in (1, 2) for _ in range(3)], [("2026-01-08", "x", "SUCCESS", 0)])
    calmo = quality_status.messages(quality_status.overview(bom), quality_status.coverage(bom))
    assert rows(calmo, "mensagem") == [(quality_status.MSG_NORMAL,)]
    assert alerts.pipeline_alerts(quality_status.overview(bom)).count() == 0
    assert rows(alerts.coverage_alerts(quality_status.coverage(wh)), "loja_id", "metric_value") == [(1, 2.0), (2, 0.0)]
