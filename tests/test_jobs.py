"""Landing to warehouse on real files: isolation, reruns, corrections, backfill, stream."""

from __future__ import annotations

import json
import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F

from balcao import schemas
from balcao.operators import contract
from balcao.plans import alerts, analyst, forecast, quality_status, snapshots, views
from balcao.plans.jobs import Job, day_list, fpa_history, month_days, parse_date, quality_history
from balcao.sources import export, raw
from balcao.sources.lake import Lake, LakeWarehouse
from balcao.streaming.landing import start_landing
from tests.conftest import INSTANTE, TRES_VENDAS, bronze_frame, envelope, land, rows, sale


@pytest.fixture(scope="module", autouse=True)
def vazio(spark, tmp_path_factory, referencias):
    """A lake with dimensions and budgets only, copied by the tests."""
    raiz = tmp_path_factory.mktemp("vazio")
    Job(Lake(spark, str(raiz)), referencias).setup()
    VAZIO[:] = raiz, referencias


VAZIO: list = []


def job_at(spark, raiz) -> Job:
    shutil.copytree(VAZIO[0], raiz, dirs_exist_ok=True)
    return Job(Lake(spark, str(raiz)), VAZIO[1])


def fact(job):
    return job.lake.read("warehouse/fato_vendas", schemas.FATO_VENDAS)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Two days of three stores, one broken file and one empty shift, loaded once."""
    raiz = tmp_path_factory.mktemp("lake")
    job = job_at(spark, raiz)
    for dia in ("2026-01-08", "2026-01-09"):
        for loja in (1, 2, 3):
            vendas = [
                sale(id_venda=f"{dia}-{loja}-{n:04d}", loja_id=loja, quantidade=n, cliente_id=n, data_venda=f"{dia}T1{n}:00:00")
                for n in range(1, 5)
            ]
            vendas.append(
                sale(id_venda=f"{dia}-{loja}-9999", loja_id=loja, status="CANCELADA", motivo_cancelamento="x", data_venda=f"{dia}T10:00:00")
            )
            land(raiz, envelope(vendas, loja_id=loja), dia, loja)
    land(raiz, "{", "2026-01-08", 1, "vendas_1_20260108_noite.json")
    land(raiz, envelope([], turno="TARDE"), "2026-01-08", 1)
    resumo = job.run_range("2026-01-08", 2).first()
    return job, resumo


def test_summary(loaded):
    _, r = loaded
    assert (r["arquivos_raw"], r["arquivos_rejeitados"], r["registros_extraidos"]) == (8, 1, 30)
    assert (r["registros_validos"], r["registros_invalidos"]) == (30, 0)
    assert (r["registros_silver"], r["registros_cancelados"]) == (24, 6)
    assert (r["registros_inseridos"], r["registros_atualizados"], r["sem_dimensao"]) == (30, 0, 0)


def test_ledger_holds_empty_and_not_broken_files(loaded):
    job, _ = loaded
    ledger = job.lake.read("warehouse/processed_files", schemas.ARQUIVOS)
    assert ledger.count() == 7
    assert ledger.where("registros_lidos = 0").count() == 1
    assert job.lake.read("quarantine/arquivos_invalidos", schemas.QUARENTENA_ARQUIVOS).count() == 1


def test_marts_of_the_month(loaded):
    job, _ = loaded
    resumo = job.lake.read("gold/kpis_vendas").first()
    assert (resumo["total_pedidos"], resumo["competencia"]) == (24, "2026-01")
    assert float(resumo["faturamento_total"]) == 6 * (800 * 10 - 4 * 40)
    fpa = fpa_history(job.lake)
    assert fpa.count() == 5 and {r["status_semaforo"] for r in fpa.collect()} == {"VERMELHO"}
    assert job.lake.read("warehouse/fato_dre").count() == 3
    assert job.lake.read("gold/top_produtos").first()["ranking_receita"] == 1
    historico = rows(quality_history(job.lake), "total_registros", "taxa_aprovacao")
    assert historico == [(15, 100.0), (15, 100.0)]


def test_warehouse_plans_run_on_the_lake(loaded):
    job, _ = loaded
    wh = LakeWarehouse(job.lake)
    assert views.monthly_revenue(wh).first()["total_pedidos"] == 24
    assert rows(views.store_revenue(wh).orderBy("loja_id"), "loja_id", "ranking") == [(1, 1), (2, 1), (3, 1)]
    assert views.target_vs_actual(wh).count() == 60
    assert analyst.revenue_by_segment(wh).first()["segmento"] == "VAREJO"
    assert analyst.latest_dre(wh).count() == 3
    assert forecast.store_projection(wh, 3).count() == 9
    assert snapshots.pipeline_counters(wh).first()["arquivos_processados"] == 7
    cobertura = rows(quality_status.coverage(wh), "loja_id", "arquivos")
    assert cobertura == [(1, 1), (2, 1), (3, 1), (4, 0), (5, 0)]
    central = alerts.alert_center(LakeWarehouse(job.lake))
    tipos = {r["type"] for r in central.collect()}
    assert {"META", "QUALIDADE"} <= tipos and "OPERACAO" not in tipos
    with pytest.raises(ValueError, match="store 77"):
        snapshots.require_store(wh, 77)
    snapshots.require_store(wh, 1)


def test_csv_export_and_month_pruning(loaded, spark):
    job, _ = loaded
    job.lake.export_csv(job.lake.read("gold/dre_gerencial"), "dre_gerencial")
    assert spark.read.option("header", True).csv(job.lake.path("export/dre_gerencial")).count() == 3
    mes = job.read_month(2026, 1)
    assert mes.count() == 24
    plano = mes._jdf.queryExecution().executedPlan().toString()
    assert "data_referencia" in plano.split("PartitionFilters: [")[1].split("]")[0]


def test_rerun_changes_nothing(loaded):
    job, _ = loaded
    antes = sorted(rows(fact(job).drop("processed_at"), "id_venda", "loja_id", "valor_liquido", "status"))
    r = job.run_range("2026-01-08", 2).first()
    assert (r["registros_inseridos"], r["registros_atualizados"]) == (0, 30)
    assert sorted(rows(fact(job), "id_venda", "loja_id", "valor_liquido", "status")) == antes
    assert {x["status"] for x in job.lake.read("warehouse/processed_files", schemas.ARQUIVOS).collect()} == {"PROCESSED"}
    assert job.lake.read("quarantine/arquivos_invalidos", schemas.QUARENTENA_ARQUIVOS).count() == 1
    assert quality_history(job.lake).count() == 2
    assert job.lake.read("warehouse/dim_tempo").count() == 1095
    assert job.lake.read("warehouse/fato_orcamento").count() == 60


def test_backfill_equals_single_days(spark, tmp_path, loaded):
    origem, _ = loaded
    separado = job_at(spark, tmp_path)
    destino = Job(Lake(spark, str(tmp_path)), VAZIO[1])
    for dia in ("2026-01-08", "2026-01-09"):
        textos = raw.scan(spark, origem.lake.path("raw"), dia, dia)
        destino.run_texts(textos, day_list(date.fromisoformat(dia), 1))
    colunas = ("id_venda", "loja_id", "quantidade", "valor_liquido", "status", "produto_sk")
    assert sorted(rows(fact(separado), *colunas)) == sorted(rows(fact(origem), *colunas))


def test_correction_updates_only_some_columns(spark, tmp_path):
    job = job_at(spark, tmp_path)
    land(tmp_path, envelope([sale()]))
    job.run_day("2026-01-08")
    corrigida = sale(
        quantidade=2, valor_unitario="3000.00", desconto_valor="0.00", canal_venda="Online", status="CANCELADA",
        motivo_cancelamento="Erro", data_venda="2026-02-01T10:00:00",
    )
    land(tmp_path, envelope([corrigida]))
    r = job.run_day("2026-01-08").first()
    assert (r["registros_inseridos"], r["registros_atualizados"]) == (0, 1)
    f = fact(job).collect()
    assert len(f) == 1
    linha = f[0]
    assert (linha["quantidade"], linha["canal_venda"], linha["mes"], linha["custo_unitario"]) == (1, "Loja Física", 1, 500)
    assert (linha["valor_unitario"], linha["valor_bruto"], linha["status"]) == (3000, 6000, "CANCELADA")
    ledger = job.lake.read("warehouse/processed_files", schemas.ARQUIVOS).first()
    assert ledger["status"] == "REPROCESSED"
    # The date now has no active sale: its Silver day must be empty, not the old one.
    assert job.lake.read("silver/vendas").count() == 0
    with pytest.raises(FileNotFoundError):
        job.read_month(2026, 1)


def gold_orders(job, mes):
    linhas = job.lake.read("gold/kpis_vendas").where(F.col("mes") == mes).collect()
    return sum(r["total_pedidos"] for r in linhas)


def test_stored_days_outside_the_list_and_other_months_stay(spark, tmp_path):
    job = job_at(spark, tmp_path)
    for dia in ("2026-01-08", "2026-01-09", "2026-01-10", "2026-02-03"):
        land(tmp_path, envelope([sale(id_venda=f"VND-{dia}", data_venda=f"{dia}T10:00:00")]), dia)
    job.run_range("2026-01-08", 27)
    assert (gold_orders(job, 1), gold_orders(job, 2)) == (3, 1)
    # A late sale dated in February, in a January file; a list of days with a gap.
    extra = [sale(id_venda="VND-2026-01-08", data_venda="2026-01-08T10:00:00"), sale(id_venda="VND-T", data_venda="2026-02-01T09:00:00")]
    land(tmp_path, envelope(extra), "2026-01-08")
    dias = [d for d in day_list(parse_date("2026-01-08"), 3) if d.day != 9]
    textos = raw.scan(spark, job.lake.path("raw"), "2026-01-08", "2026-01-10").where(~F.col("arquivo_origem").contains("dia=09"))
    job.run_texts(textos, dias)
    assert job.lake.read("silver/vendas").select("data_referencia").distinct().count() == 4
    assert (gold_orders(job, 1), gold_orders(job, 2)) == (3, 2)


def test_day_without_files_is_an_empty_success(spark, tmp_path):
    job = job_at(spark, tmp_path)
    r = job.run_day("2026-03-01").first()
    assert (r["arquivos_raw"], r["registros_silver"], r["registros_inseridos"]) == (0, 0, 0)
    with pytest.raises(FileNotFoundError):
        job.process_date("2026-03-01")


def test_unknown_product_is_counted(spark, tmp_path):
    job = job_at(spark, tmp_path)
    land(tmp_path, envelope([sale(), sale(id_venda="VND-X-1", produto_id=999)]))
    r = job.process_date("2026-01-08").first()
    assert (r["registros_validos"], r["registros_inseridos"], r["sem_dimensao"], r["status"]) == (2, 1, 1, "PROCESSADO")


def test_failure_is_audited(spark, tmp_path):
    job = job_at(spark, tmp_path)
    ruim = spark.range(1).select(F.lit(1).alias("value"))
    with pytest.raises(Exception):  # noqa: B017
        job.run_texts(ruim, day_list(month_days("2026-01")[0], 1))
    log = job.lake.read("warehouse/pipeline_audit_log", schemas.AUDITORIA)
    assert rows(log, "status", "task_id") == [("FAILED", "extrair_bronze")]


def test_stream_lands_new_files_once(spark, tmp_path):
    job = job_at(spark, tmp_path)
    land(tmp_path, envelope([sale()]))
    ponto = str(tmp_path / "ponto")
    assert start_landing(job, ponto).awaitTermination(120)
    assert fact(job).count() == 1
    land(tmp_path, envelope([sale(id_venda="VND-2026-001-0000009")], turno="TARDE"))
    land(tmp_path, envelope([sale(id_venda="VND-2026-001-0000010", data_venda="2026-01-10T08:00:00")]), "2026-01-10")
    assert start_landing(job, ponto).awaitTermination(120)
    assert sorted(r["id_venda"][-1] for r in fact(job).collect()) == ["0", "1", "9"]
    assert start_landing(job, ponto).awaitTermination(120)
    assert fact(job).count() == 3


# Export


def export_input(spark, n=30):
    vendas = [sale(id_venda=f"VND-{i:06d}", quantidade=1 + i % 3) for i in range(n)]
    df = bronze_frame(spark, vendas).withColumn("data", F.to_date("data_venda"))
    return df.withColumn("data_venda", F.col("data_venda").cast("timestamp_ntz"))


def test_export_round_trip_and_write_once(spark, tmp_path):
    from balcao.params import Params

    vendas = export_input(spark)
    partes = export.package(vendas, INSTANTE, Params(partes_por_turno=4))
    assert partes.count() > 1
    raiz = f"{tmp_path}/raw"
    export.emit(partes, raiz)
    lidos = raw.parse(raw.scan(spark, raiz, "2026-01-08", "2026-01-08"))
    checados = contract.check(lidos)
    assert contract.rejected(checados).count() == 0
    bronze = contract.flatten(contract.accepted(checados), INSTANTE)
    assert bronze.count() == 30 and bronze.select("id_venda").distinct().count() == 30
    assert {r["quantidade"] for r in bronze.collect()} == {1, 2, 3}
    with pytest.raises(FileExistsError):
        export.emit(partes, raiz)


def test_parts_do_not_depend_on_size(spark):
    """One id with many rows is spread over the fixed parts; no sale is lost or moved by a growing shift."""
    from balcao.params import Params

    vendas = bronze_frame(spark, [sale(id_venda="VND-QUENTE", parcelas=1 + i % 12, quantidade=1 + i % 50) for i in range(600)])
    vendas = vendas.withColumn("data", F.to_date("data_venda")).withColumn("data_venda", F.col("data_venda").cast("timestamp_ntz"))
    params = Params(partes_por_turno=8)
    partes = {r["parte"]: r for r in export.package(vendas, INSTANTE, params).collect()}
    assert sorted(partes) == list(range(8)) and sum(r["quantidade_registros"] for r in partes.values()) == 600
    assert max(r["quantidade_registros"] for r in partes.values()) < 120
    metade = {r["parte"]: r for r in export.package(vendas.where("posicao < 300"), INSTANTE, params).collect()}
    assert all(set(map(str, metade[k]["vendas"])) <= set(map(str, partes[k]["vendas"])) for k in metade)


def test_tampered_export_is_refused(spark, tmp_path):
    import glob

    raiz = f"{tmp_path}/raw"
    export.emit(export.package(export_input(spark, 3), INSTANTE), raiz)
    (arquivo,) = glob.glob(f"{raiz}/vendas/**/*.json", recursive=True)
    doc = json.load(open(arquivo, encoding="utf-8"))
    doc["vendas"][0]["quantidade"] = 50
    land(tmp_path, doc, nome="alterado.json")
    erros = contract.rejected(contract.check(raw.parse(raw.scan(spark, raiz, "2026-01-08", "2026-01-08"))))
    assert rows(erros, "erro") == [("checksum_invalido",)]


def test_receipts(spark):
    vendas = export_input(spark, 4).unionByName(export_input(spark, 2).withColumn("turno_origem", F.lit("TARDE")))
    fechamento = {(r["nivel"], r["turno"]): r for r in export.day_closing(vendas).collect()}
    dia = fechamento[("DIA", None)]
    assert (dia["arquivos"], dia["quantidade"], dia["concluidas"]) == (2, 6, 6)
    assert fechamento[("TURNO", "TARDE")]["valor_bruto"] == 800 * 3
    assert dia["valor_liquido"] == dia["valor_bruto"] - 6 * 40


def test_dates():
    assert month_days("2028-02")[1] == 29 and month_days("2026-04")[1] == 30 and month_days("2026-12")[1] == 31
    with pytest.raises(ValueError):
        month_days("2026-13")
    with pytest.raises(ValueError):
        day_list(month_days("2026-01")[0], 0)
    assert len(TRES_VENDAS) == 3
