from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from balcao import schemas
from balcao.operators import load, silver
from balcao.operators.merge import merge_by_key, only_missing, upsert_counts
from balcao.operators.ranking import spread_ranks
from balcao.params import Params
from balcao.plans import analyst, marts, snapshots, views
from balcao.sources.warehouse import FrameWarehouse
from tests.conftest import INSTANTE, TRES_VENDAS, bronze_frame, rows


@pytest.fixture(scope="module")
def ativas(spark):
    return silver.to_silver(bronze_frame(spark, TRES_VENDAS), INSTANTE).ativas


def test_kpis(ativas):
    resumo = marts.kpi_summary(ativas).first()
    assert (float(resumo["faturamento_total"]), resumo["ticket_medio"], resumo["total_pedidos"]) == (960.0, 480.0, 2)
    lojas = marts.kpi_stores(ativas)
    assert rows(lojas, "market_share_pct", "ranking_receita", "competencia") == [(100.0, 1, "2026-01")]
    produtos = marts.kpi_products(ativas).orderBy("produto_id")
    assert rows(produtos, "produto_id", "ranking_receita", "ranking_volume") == [(901, 1, 1), (902, 2, 1)]


def test_dre(spark, ativas, catalogo):
    linha = marts.dre(ativas, catalogo.dre_parameters()).first()
    assert float(linha["receita_liquida"]) == 840.0
    assert (float(linha["impostos"]), float(linha["cmv"])) == (120.0, 590.0)
    assert linha["despesas_financeiras"] == 0 and linha["ebit"] < 0


def test_dre_interest_and_unknown_store(spark, catalogo):
    totais = spark.createDataFrame(
        [(1, 2026, 1, Decimal("1000000.00"), Decimal("0.00"), Decimal("100000.00")), (9, 2026, 1, Decimal("10.00"), Decimal("0.00"), Decimal("1.00"))],
        "loja_id int, ano int, mes int, receita_bruta decimal(22,2), descontos decimal(22,2), cmv decimal(22,2)",
    )
    por_loja = {r["loja_id"]: r for r in marts.dre_lines(totais, catalogo.dre_parameters()).collect()}
    assert por_loja[1]["ebit"] == Decimal("684700.00")
    assert por_loja[1]["despesas_financeiras"] == Decimal("13694.00")
    assert por_loja[9]["despesas_fixas"] is None and por_loja[9]["ebitda"] is None
    assert por_loja[9]["despesas_financeiras"] is None and por_loja[9]["receita_liquida"] == Decimal("8.80")


def test_fpa(spark, ativas, catalogo):
    anos = spark.createDataFrame([(2026,)], "ano int")
    orcamento = load.monthly_budget(catalogo.budgets(), anos).where("mes = 1")
    linhas = {r["loja_id"]: r for r in marts.fpa(ativas, orcamento).collect()}
    assert len(linhas) == 5
    assert (linhas[1]["forecast_mes"], linhas[1]["status_semaforo"]) == (29760.0, "VERMELHO")
    assert linhas[2]["dias_com_venda"] == 0 and linhas[2]["forecast_mes"] == 0.0 and linhas[2]["ranking_receita"] == 2


def test_budgets(spark, catalogo):
    anos = spark.createDataFrame([(2026,), (2027,)], "ano int")
    df = load.monthly_budget(catalogo.budgets(), anos)
    assert df.count() == 120
    futuro = df.where("ano = 2027 and loja_id = 5 and mes = 1").first()
    assert (futuro["receita_orcada"], futuro["margem_bruta_orcada"]) == (Decimal("262500.00"), Decimal("40.00"))
    semente = load.seed_budget(catalogo.stores(), catalogo.seed_parameters(), 2026).where("loja_id = 5 and mes = 7").first()
    assert semente["margem_bruta_orcada"] == Decimal("41.00") and semente["resultado_orcado"] == Decimal("57200.00")


def test_calendar(spark):
    dias = load.calendar_range(spark)
    assert dias.count() == 1095
    sabado = dias.where("data = date'2026-01-10'").first()
    assert (sabado["data_sk"], sabado["nome_mes"], sabado["nome_dia_semana"], sabado["e_fim_semana"]) == (20260110, "January", "Saturday", True)


def warehouse(spark) -> FrameWarehouse:
    """Two stores with a missing month, ties, a zero budget and a sale id used by both stores."""
    d = Decimal
    vendas = [
        ("a", 1, "2026-01-05", 100, "CONCLUIDA"), ("b", 1, "2026-01-06", 100, "CONCLUIDA"),
        ("c", 1, "2026-03-05", 300, "CONCLUIDA"), ("a", 2, "2026-01-05", 200, "CONCLUIDA"),
        ("d", 2, "2026-03-05", 50, "CANCELADA"), ("e", 2, "2026-03-06", 100, "PENDENTE"),
    ]
    fato = spark.createDataFrame(
        [
            (i, loja, date.fromisoformat(dia), d(v), d(v), d(0), d(v) / 2, d(v) / 2, 1, st, 7, 1, "Online", "PIX", 5.0)
            for i, loja, dia, v, st in vendas
        ],
        "id_venda string, loja_id int, data date, valor_bruto decimal(12,2), valor_liquido decimal(12,2), "
        "desconto_valor decimal(12,2), custo_total decimal(12,2), margem_bruta decimal(12,2), quantidade int, status string, "
        "produto_id bigint, cliente_id bigint, canal_venda string, forma_pagamento string, desconto_pct_calc double",
    ).withColumns(
        {"ano": F.year("data"), "mes": F.month("data"), "dia": F.day("data"), "data_venda": F.col("data").cast("timestamp_ntz"),
         "periodo": F.lit("MANHA")}
    )
    orcamento = [(1, 2026, 1, d(200)), (1, 2026, 2, d(200)), (1, 2026, 3, d(350)), (2, 2026, 1, d(0))]
    return FrameWarehouse(
        spark,
        {
            "fato_vendas": fato,
            "dim_loja": spark.createDataFrame([(1, "Um", True), (2, "Dois", True)], "loja_id int, loja_nome string, ativa boolean"),
            "dim_produto": spark.createDataFrame([(7, "Sete", "X")], "produto_id bigint, produto_nome string, categoria string"),
            "dim_cliente": spark.createDataFrame([(1, "VIP")], "cliente_id bigint, segmento string"),
            "fato_orcamento": spark.createDataFrame(orcamento, "loja_id int, ano int, mes int, receita_orcada decimal(15,2)"),
        },
    )


def test_network_counts_sale_ids_once(spark):
    janeiro = views.monthly_revenue(warehouse(spark)).where("mes = 1").first()
    assert (janeiro["total_pedidos"], janeiro["ticket_medio"]) == (2, 200.0)


def test_store_views_compare_with_previous_row_and_rank_with_gaps(spark):
    linhas = {(r["loja_id"], r["mes"]): r for r in views.store_revenue(warehouse(spark)).collect()}
    assert len(linhas) == 3
    assert linhas[1, 3]["crescimento_mom"] == 50.0 and linhas[1, 1]["crescimento_mom"] is None
    assert (linhas[1, 1]["ranking"], linhas[2, 1]["ranking"]) == (1, 1)
    assert linhas[1, 3]["market_share_pct"] == 100.0
    ticket = {(r["loja_id"], r["mes"]): r for r in views.store_ticket(warehouse(spark)).collect()}
    assert (ticket[1, 3]["ticket_anterior"], ticket[1, 3]["variacao_pct"]) == (100.0, 200.0)


def test_targets_keep_budget_months_and_zero_budgets(spark):
    linhas = {(r["loja_id"], r["mes"]): r for r in views.target_vs_actual(warehouse(spark)).collect()}
    assert len(linhas) == 4
    assert (linhas[1, 2]["receita_realizada"], linhas[1, 2]["status_semaforo"]) == (0, "VERMELHO")
    assert (linhas[1, 1]["status_semaforo"], linhas[1, 3]["status_semaforo"]) == ("VERDE", "AMARELO")
    assert linhas[2, 1]["variacao_pct"] is None and linhas[2, 1]["status_semaforo"] == "VERMELHO"


def test_fpa_view_and_ranking(spark):
    fpa = {(r["loja_id"], r["mes"]): r for r in views.fpa_view(warehouse(spark)).collect()}
    assert fpa[1, 1]["forecast_mes"] == 3100.0 and (2, 3) not in fpa
    assert views.store_ranking(warehouse(spark)).count() == 3


def test_yoy_is_null_without_a_year_before(spark):
    assert {r["receita_ano_anterior"] for r in analyst.year_over_year(warehouse(spark)).collect()} == {None}


def test_overview_counts_and_latest(spark):
    wh = warehouse(spark)
    marco = snapshots.overview(wh, 2026, 3).first()
    assert (marco["canceladas"], marco["pendentes"], marco["pedidos"], marco["ticket_medio"]) == (1, 1, 1, 300.0)
    vazio = snapshots.overview(wh, 2020, 1).first()
    assert (vazio["receita_liquida"], vazio["ticket_medio"], vazio["margem_pct"]) == (0, 0.0, 0.0)
    assert [r[0] for r in snapshots.months(wh).collect()] == ["2026-03", "2026-01"]
    assert snapshots.latest_loaded_month(wh) == (2026, 3)
    assert views.top_products(wh).count() == 2


def test_shared_table_gives_the_same_answers(spark):
    a = sorted(views.store_revenue(warehouse(spark)).collect())
    assert sorted(views.store_revenue(warehouse(spark).shared()).collect()) == a


# Merge and ranks


def test_merge_chooses_columns(spark):
    alvo = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, fixo string, v int")
    novos = spark.createDataFrame([(2, "x", 99), (3, "c", 30)], "k int, fixo string, v int")
    assert sorted(rows(merge_by_key(alvo, novos, ["k"], ["v"]), "k", "fixo", "v")) == [(1, "a", 10), (2, "b", 99), (3, "c", 30)]
    assert sorted(rows(merge_by_key(alvo, novos, ["k"], []), "k", "v")) == [(1, 10), (2, 20), (3, 30)]
    assert rows(only_missing(novos, alvo, ["k"]), "k") == [(3,)]
    assert tuple(upsert_counts(novos, alvo, ["k"]).first()) == (2, 1, 1)


def test_ledger_status(spark):
    def linha(checksum, lidos, invalidos):
        return spark.createDataFrame(
            [(1, "f", checksum, date(2026, 1, 8), 1, "SILVER", "PROCESSED", lidos, lidos, invalidos, "1", INSTANTE, INSTANTE)],
            schemas.ARQUIVOS,
        )

    velho = linha("a", 5, 2)
    assert rows(load.merge_ledger(velho, linha("a", 5, 0)), "status", "registros_invalidos") == [("PROCESSED", 2)]
    assert rows(load.merge_ledger(velho, linha("b", 9, 0)), "status", "registros_lidos") == [("REPROCESSED", 9)]


@pytest.mark.parametrize("dense", [False, True])
def test_spread_rank_matches_window_with_a_hot_group(spark, dense):
    """A third of all rows share one value of one group; blocks are forced by the four shuffle partitions."""
    from pyspark.sql.window import Window

    df = spark.range(3000).select(
        F.when(F.col("id") < 2400, 1).otherwise(2).alias("g"),
        F.when(F.col("id") < 1000, 7).otherwise(F.expr("pmod(id * 7919, 501)")).cast("decimal(10,2)").alias("v"),
        F.expr("pmod(id * 104729, 13)").alias("w"),
        "id",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        meu = sorted(rows(spread_ranks(df, ["g"], {"rv": "v", "rw": "w"}, dense), "id", "rv", "rw"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    funcao = F.dense_rank if dense else F.rank
    g = Window.partitionBy("g")
    certo = df.select("id", funcao().over(g.orderBy(F.col("v").desc())).alias("rv"), funcao().over(g.orderBy(F.col("w").desc())).alias("rw"))
    assert meu == sorted(rows(certo, "id", "rv", "rw"))


def test_hot_key_dedup_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select(F.expr("id div 5000").alias("id_venda"), F.expr("id div 7000").alias("loja_id"), "id")
    plano = silver.keep_last(df, ("id_venda", "loja_id"), [F.col("id").desc()])
    assert rows(plano, "id") == [(999,)]
    assert "WindowGroupLimit" in plano._jdf.queryExecution().toString()


def test_params_change_results(spark, ativas, catalogo):
    caro = marts.dre(ativas, catalogo.dre_parameters(), Params(taxa_imposto=Decimal("0.20"))).first()
    assert float(caro["impostos"]) == 200.0
