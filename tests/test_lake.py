"""Versions, transactions, key filters and daily shares of the lake."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from balcao import schemas
from balcao.operators import bloom, key_index
from balcao.plans.jobs import Job, day_list, parse_date
from balcao.sources import raw
from balcao.sources.lake import Lake, day_folder
from balcao.streaming.landing import land_batch
from tests.conftest import envelope, land, rows, sale

GOLD = ("kpis_vendas", "faturamento_por_loja", "top_produtos", "dre_gerencial", "indicadores_fpa")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def job(spark, tmp_path, referencias):
    job = Job(Lake(spark, str(tmp_path)), referencias)
    with job.lake.transaction():
        job.setup()
    return job


def days(spark, *linhas):
    return spark.createDataFrame([(v, date.fromisoformat(d)) for v, d in linhas], "v int, data_referencia date")


def content(lake, tabela):
    return sorted(map(str, lake.read(tabela).collect()))


def test_partitions_replace_add_and_empty(spark, lake):
    lake.replace_days(days(spark, (1, "2026-01-01"), (2, "2026-01-02")), "t", day_list(date(2026, 1, 1), 2))
    lake.replace_days(days(spark, (3, "2026-01-02")), "t", [date(2026, 1, 2)])
    assert rows(lake.read("t").orderBy("v"), "v") == [(1,), (3,)]
    lake.append_partitions(days(spark, (4, "2026-01-01")), "t", ["data_referencia"])
    assert rows(lake.read_days("t", [date(2026, 1, 1)]).orderBy("v"), "v") == [(1,), (4,)]
    lake.replace_days(days(spark).where("1 = 0"), "t", [date(2026, 1, 1)])
    assert rows(lake.read("t"), "v") == [(3,)]
    assert lake.read("t").schema.fieldNames() == ["v", "data_referencia"]
    assert lake.read("outra", "x int").count() == 0
    with pytest.raises(FileNotFoundError):
        lake.read("outra")


def test_day_read_lists_only_its_folder(spark, lake):
    todos = day_list(date(2026, 1, 1), 20)
    lake.replace_days(days(spark, *[(n, d.isoformat()) for n, d in enumerate(todos)]), "t", todos)
    um = lake.read_days("t", [date(2026, 1, 7)])
    assert len(um.inputFiles()) == 1 and day_folder(date(2026, 1, 7)) in um.inputFiles()[0]
    plano = lake.read("t").where(F.col("data_referencia") == date(2026, 1, 7))._jdf.queryExecution().executedPlan().toString()
    assert "data_referencia" in plano.split("PartitionFilters: [")[1].split("]")[0]


def test_transaction_is_all_or_nothing(spark, lake):
    um, dois = spark.range(1), spark.range(2)
    with lake.transaction():
        lake.replace_table(um, "a")
        lake.replace_table(um, "b")
        assert lake.read("a").count() == 1
    with pytest.raises(RuntimeError), lake.transaction():
        lake.replace_table(dois, "a")
        assert lake.read("a").count() == 2
        raise RuntimeError
    assert (lake.read("a").count(), lake.read("b").count()) == (1, 1)
    with lake.transaction():
        lake.replace_table(dois, "a")
        lake.append(um, "b")
    assert (lake.read("a").count(), lake.read("b").count()) == (2, 2)
    assert Lake(spark, lake.raiz, 1).read("a").count() == 1
    with pytest.raises(FileNotFoundError):
        Lake(spark, lake.raiz, 9).read("a")


def test_table_is_read_and_replaced_in_one_plan(spark, lake):
    lake.replace_table(spark.range(3), "a")
    antes = lake.read("a")
    lake.replace_table(antes.selectExpr("id + 10 AS id"), "a")
    assert sorted(r["id"] for r in lake.read("a").collect()) == [10, 11, 12]
    assert sorted(r["id"] for r in antes.collect()) == [0, 1, 2]


def test_second_writer_is_refused(spark, lake):
    lake.replace_table(spark.range(1), "a")
    outro = Lake(spark, lake.raiz)
    with pytest.raises(FileExistsError), lake.transaction():
        lake.replace_table(spark.range(2), "a")
        outro.replace_table(spark.range(3), "a")
    assert lake.read("a").count() == 3


def test_vacuum_keeps_what_manifests_name(spark, lake):
    for n in (1, 2, 3):
        lake.replace_table(spark.range(n), "a")
    with pytest.raises(RuntimeError), lake.transaction():
        lake.replace_table(spark.range(9), "a")
        raise RuntimeError
    assert len(lake.vacuum(manter=1)) == 3
    assert lake.read("a").count() == 3 and lake.versions() == [3]
    assert lake.vacuum(manter=1) == []


def test_run_killed_between_any_two_writes_leaves_the_old_lake(spark, tmp_path, job, monkeypatch):
    land(tmp_path, envelope([sale()]))
    job.run_day("2026-01-08")
    tabelas = [t for t in job.lake.manifest()["tabelas"] if t != "warehouse/pipeline_audit_log"]
    antes = {t: content(job.lake, t) for t in tabelas}
    land(tmp_path, envelope([sale(), sale(id_venda="VND-NOVA", cliente_id=5)]))
    escrever, contagem = Lake._stage, {"n": 0, "parar": 0}

    def cair(self, df, tabela, *resto):
        contagem["n"] += 1
        if tabela != "warehouse/pipeline_audit_log" and contagem["n"] == contagem["parar"]:
            raise KeyError(tabela)
        return escrever(self, df, tabela, *resto)

    monkeypatch.setattr(Lake, "_stage", cair)
    for parada in (1, 9, 20):
        contagem |= {"n": 0, "parar": parada}
        with pytest.raises(KeyError):
            job.run_day("2026-01-08")
        assert {t: content(Lake(spark, job.lake.raiz), t) for t in tabelas} == antes, parada
    contagem |= {"parar": 0}
    assert job.run_day("2026-01-08").first()["registros_inseridos"] == 1
    log = job.lake.read("warehouse/pipeline_audit_log", schemas.AUDITORIA)
    falhas = log.where("status = 'FAILED'")
    assert falhas.count() == 3 and log.select("audit_id").distinct().count() == log.count()
    assert {r["task_id"] for r in falhas.collect()} >= {"extrair_bronze", "gerar_indicadores", "carregar_datawarehouse"}


def test_audit_is_measured(spark, tmp_path, job):
    land(tmp_path, envelope([sale(), sale(id_venda="VND-2", produto_id=999), sale(id_venda="VND-3", status="PENDENTE")]))
    land(tmp_path, "{", nome="quebrado.json")
    job.run_day("2026-01-08")
    log = {r["task_id"]: r for r in job.lake.read("warehouse/pipeline_audit_log").collect()}
    assert set(log) == {"extrair_bronze", "validar_qualidade", "transformar_silver", "gerar_indicadores", "carregar_datawarehouse"}
    assert (log["extrair_bronze"]["registros_lidos"], log["extrair_bronze"]["registros_invalidos"]) == (3, 1)
    assert log["transformar_silver"]["registros_validos"] == 3
    assert (log["carregar_datawarehouse"]["registros_inseridos"], log["carregar_datawarehouse"]["registros_lidos"]) == (2, 2)
    assert all(r["duracao_segundos"] > 0 and r["status"] == "SUCCESS" for r in log.values())


def same_marts(job, meses):
    cheias = job.full_marts(meses)
    for nome in GOLD:
        parcial, cheia = job.lake.read_months(f"gold/{nome}", meses), cheias[nome]
        colunas = sorted(cheia.columns)
        assert sorted(parcial.columns) == colunas
        assert dict(parcial.dtypes) == dict(cheia.dtypes), nome
        assert sorted(map(str, parcial.select(colunas).collect())) == sorted(map(str, cheia.select(colunas).collect())), nome


def test_shares_add_up_to_a_full_rebuild(spark, tmp_path, job):
    """First loads, late sales of other months, corrections, shared ids, cancellations, an emptied day."""
    def deliver(dia, vendas, loja=1):
        land(tmp_path, envelope(vendas, loja_id=loja), dia, loja)

    def on(dia, n, **outros):
        return sale(id_venda=f"V-{dia}-{n}", data_venda=f"{dia}T1{n}:00:00", **outros)

    meses = [(2026, 1), (2026, 2)]
    deliver("2026-01-08", [on("2026-01-08", n, quantidade=n) for n in range(1, 5)])
    deliver("2026-01-08", [on("2026-01-08", 1, loja_id=2), on("2026-01-08", 9, loja_id=2, produto_id=902, produto_nome="Moedor Manual")], 2)
    deliver("2026-01-31", [on("2026-01-31", 1), on("2026-02-01", 2), sale(id_venda="V-2026-01-08-1", data_venda="2026-01-30T10:00:00")])
    deliver("2026-02-02", [on("2026-02-02", 1), on("2026-01-29", 5)])
    job.run_day("2026-01-08")
    same_marts(job, meses[:1])
    job.run_range("2026-01-31", 3)
    same_marts(job, meses)
    # A correction of the first day; the last day loses its January sale; the middle one is emptied.
    deliver("2026-01-08", [on("2026-01-08", 2, quantidade=7), on("2026-01-08", 3, status="CANCELADA", motivo_cancelamento="x")])
    deliver("2026-02-02", [on("2026-02-02", 1)])
    deliver("2026-01-31", [])
    for dia, n in (("2026-01-08", 1), ("2026-01-31", 3)):
        job.run_range(dia, n)
        same_marts(job, meses)


def test_day_run_reads_only_its_silver(spark, tmp_path, job, monkeypatch):
    for dia in ("2026-01-08", "2026-01-09", "2026-02-03"):
        land(tmp_path, envelope([sale(id_venda=f"V-{dia}", data_venda=f"{dia}T10:00:00")]), dia)
        job.run_day(dia)
    lidas = []
    carregar = Lake._load

    def anotar(self, tabela, pastas, *resto):
        lidas.append((tabela, tuple(pastas)))
        return carregar(self, tabela, pastas, *resto)

    monkeypatch.setattr(Lake, "_load", anotar)
    job.run_day("2026-01-09")
    silver = {p for t, ps in lidas if t.startswith("silver/") for p in ps}
    assert silver and all("data_referencia=2026-01-09" in p for p in silver)
    fatos = {p.split("/", 1)[1] for t, ps in lidas if t == "warehouse/fato_vendas" for p in ps}
    assert fatos == {"ano=2026/mes=1"}
    pedidos = {p.split("/", 1)[1] for t, ps in lidas if t == "gold/pedidos" for p in ps}
    assert pedidos == {"data_referencia=2026-01-08", "data_referencia=2026-01-09"}


def test_facts_are_found_in_candidate_months_only(spark, tmp_path, job):
    for mes in range(1, 7):
        dia = f"2026-{mes:02d}-05"
        land(tmp_path, envelope([sale(id_venda=f"V-{mes}-{n}", data_venda=f"{dia}T10:00:00") for n in range(20)]), dia)
    job.run_range("2026-01-01", 181)
    novas = job.lake.read("warehouse/fato_vendas").where("id_venda in ('V-3-4', 'V-3-5')").withColumn("mes", F.lit(9))
    achadas = job.find_facts(novas)
    assert rows(achadas.orderBy("id_venda"), "id_venda", "mes", "ano_fato", "mes_fato") == [("V-3-4", 9, 2026, 3), ("V-3-5", 9, 2026, 3)]
    filtros = job.lake.read("indice/fatos_filtro")
    meses = bloom.probe(novas, schemas.FATO_CHAVE, filtros, key_index.MES, job.params.blocos_filtro)
    assert sorted(set(rows(meses, "ano", "mes"))) == [(2026, 3)]


def test_bloom_has_no_false_negative(spark):
    chaves = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 3).cast("int").alias("g"))
    filtro = bloom.merge(bloom.build(chaves.where("id < 2500"), ["k"], ["g"], 8), bloom.build(chaves.where("id >= 2500"), ["k"], ["g"], 8), ["g"])
    filtro = filtro.select("bloco", "bits", "g")
    achadas = bloom.probe(chaves.drop("g"), ["k"], filtro, ["g"], 8)
    assert achadas.join(chaves, ["k", "g"]).count() == 5000
    falsas = bloom.probe(spark.range(5000).select(F.concat(F.lit("x"), "id").alias("k")), ["k"], filtro, ["g"], 8)
    assert falsas.count() < 20


def test_numbers_are_dense_and_lasting(spark, lake):
    def number(ids, mes):
        chaves = spark.createDataFrame([(str(i), 2026, mes) for i in ids], "chave string, ano int, mes int").repartition(3)
        with lake.transaction():
            return {r["chave"]: r["numero"] for r in key_index.numbered(lake, "indice/x", chaves, 64).collect()}

    primeiro = number(range(50), 1)
    assert sorted(primeiro.values()) == list(range(1, 51))
    segundo = number(range(40, 70), 2)
    assert all(segundo[k] == primeiro[k] for k in map(str, range(40, 50))) and sorted(segundo.values())[-20:] == list(range(51, 71))
    assert number([], 3) == {} and number([3, 65], 3) == {"3": primeiro["3"], "65": segundo["65"]}


def test_bitmaps_count_as_count_distinct(spark):
    vendas = spark.range(200_000).select(
        (F.pmod(F.xxhash64("id"), F.lit(70_000)) + 1).alias("numero"), (F.col("id") % 3).alias("loja"), (F.col("id") % 28).alias("dia")
    )
    bits = key_index.order_bits(vendas, "loja", "dia")
    assert key_index.counted(bits, "loja").join(vendas.groupBy("loja").agg(F.count_distinct("numero").alias("n")), "loja").where("pedidos <> n").count() == 0
    assert key_index.counted(bits).first()[0] == vendas.select("numero").distinct().count()


def test_stream_batch_is_published_once(spark, tmp_path, job, monkeypatch):
    land(tmp_path, envelope([sale()]))
    lote = raw.scan(spark, job.lake.path("raw"), "2026-01-08", "2026-01-08")
    publicar = job.lake.files.put

    def cair(caminho, texto):
        raise OSError("killed before the manifest")

    monkeypatch.setattr(job.lake.files, "put", cair)
    with pytest.raises(OSError):
        land_batch(job, lote, 0, "consulta")
    monkeypatch.setattr(job.lake.files, "put", publicar)
    job.lake._aberta = None
    assert not job.lake.done(("consulta", 0)) and job.lake.read("warehouse/fato_vendas", schemas.FATO_VENDAS).count() == 0
    land_batch(job, lote, 0, "consulta")
    versao, auditadas = job.lake.manifest()["versao"], job.lake.read("warehouse/pipeline_audit_log").count()
    land_batch(job, lote, 0, "consulta")
    assert job.lake.manifest()["versao"] == versao
    assert job.lake.read("warehouse/pipeline_audit_log").count() == auditadas == 5
    assert job.lake.done(("consulta", 0)) and not job.lake.done(("outra", 0))


def test_scan_lists_the_folders_of_its_dates(spark, tmp_path):
    for dia in ("2026-01-08", "2026-01-09", "2026-02-01", "2025-12-31"):
        for loja in (1, 2, 3, 4, 5):
            land(tmp_path, envelope([sale(loja_id=loja)], loja_id=loja), dia, loja)
    assert len(raw.folders(spark, f"{tmp_path}/raw", "2026-01-09", "2026-01-09", schemas.LOJAS)) == 5
    assert raw.scan(spark, f"{tmp_path}/raw", "2026-01-09", "2026-01-09").count() == 5
    assert raw.scan(spark, f"{tmp_path}/raw", "2025-12-01", "2026-01-08", (1, 3)).count() == 4
    assert raw.scan(spark, f"{tmp_path}/raw", "2027-01-01", "2027-01-31").count() == 0


def test_one_file_does_not_stop_the_others(spark, tmp_path, job):
    """Kinds and ranges: each file is refused or read by itself, as its own values demand."""
    def doc(**mudancas):
        return envelope([sale(**mudancas)])

    arquivos = {
        "texto_inteiro": (envelope([sale(loja_id=1)], loja_id="1.0"), ""),
        "numero_em_texto": (doc(vendedor_id=12345), "venda.vendedor_id"),
        "turno_numerico": (doc() | {"cidade": 12345}, "cidade"),
        "texto_em_numero": (doc(quantidade="muitas"), "venda.quantidade"),
        "valor_enorme": (doc(valor_unitario="99999999999.00", desconto_valor="0.00"), "venda.valor_unitario"),
        "produto_enorme": (doc(valor_unitario="9999999.00", quantidade=2_000_000, desconto_valor="0.00"), "venda.valor_unitario"),
        "quantidade_enorme": (doc(quantidade=3_000_000_000, valor_unitario="1.00", desconto_valor="0.00"), "venda.quantidade"),
        "fora_de_escala": (doc(valor_unitario="1e300", desconto_valor="0.00"), "venda.valor_unitario"),
        "certo": (doc(id_venda="VND-CERTA"), ""),
    }
    for nome, (documento, _) in arquivos.items():
        land(tmp_path, documento, nome=f"{nome}.json")
    resumo = job.run_day("2026-01-08").first()
    refused = {r["arquivo_origem"].rsplit("/", 1)[1].removesuffix(".json"): r["erro"] for r in job.lake.read("quarantine/arquivos_invalidos").collect()}
    assert set(refused) == {n for n, (_, erro) in arquivos.items() if erro}
    for nome, erro in refused.items():
        assert arquivos[nome][1] in erro.split("; "), (nome, erro)
    assert resumo["arquivos_raw"] == len(arquivos) and resumo["registros_inseridos"] == 2
    ledger = job.lake.read("warehouse/processed_files")
    assert {r["loja_id"] for r in ledger.collect()} == {1} and ledger.count() == 2


def test_manifest_is_plain_json(spark, lake):
    lake.replace_table(spark.range(1), "a")
    estado = json.loads(lake.files.read(lake._manifest_path(1)))
    assert estado["versao"] == 1 and list(estado["tabelas"]["a"]["partes"]) == [""]
    assert parse_date("2026-01-08") == date(2026, 1, 8)
