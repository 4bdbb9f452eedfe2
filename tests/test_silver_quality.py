from datetime import date

import pytest
from pyspark.sql import functions as F

from balcao.functions import columns as col
from balcao.functions.labels import normalize_labels
from balcao.operators import quality, silver
from tests.conftest import INSTANTE, TRES_VENDAS, bronze_frame, rows, sale


def test_financial_columns(spark, bronze):
    df = silver.financial_columns(silver.standardize(bronze)).orderBy("id_venda")
    obtido = rows(df, "valor_bruto", "valor_liquido", "margem_bruta", "desconto_pct_calc")
    assert [tuple(float(x) for x in r) for r in obtido][:2] == [(800, 760, 260, 5.0), (200, 200, 110, 0.0)]


def test_percentages_are_zero_without_base(spark):
    df = silver.financial_columns(silver.standardize(bronze_frame(spark, [sale(valor_unitario="0", desconto_valor="0")])))
    assert rows(df, "margem_bruta_pct", "desconto_pct_calc") == [(0.0, 0.0)]


def test_to_silver_splits_and_removes_duplicates(spark):
    com_repetida = [*TRES_VENDAS, sale(quantidade=3)]
    b = bronze_frame(spark, com_repetida)
    s = silver.to_silver(b, INSTANTE)
    assert s.ativas.count() == 2 and s.canceladas.count() == 1 and s.todas().count() == 3
    assert s.ativas.where("id_venda = 'PDV-L1-000451'").first()["quantidade"] == 3
    resumo = silver.removed_duplicates(b).first()
    assert (resumo["registros_entrada"], resumo["duplicatas_removidas"]) == (4, 1)


def test_dedup_runs_before_cleaning_and_by_file_name(spark):
    a = bronze_frame(spark, [sale(quantidade=1)]).withColumn("arquivo_origem", F.lit("x_manha.json"))
    b = bronze_frame(spark, [sale(quantidade=2)]).withColumn("arquivo_origem", F.lit("x_tarde.json"))
    c = bronze_frame(spark, [sale(quantidade=4)]).withColumn("arquivo_origem", F.lit("x_noite.json"))
    assert rows(silver.dedup_sales(a.union(b).union(c)), "quantidade") == [(2,)]
    datado = a.withColumn("data_referencia", F.lit("2026-01-08")).union(b.withColumn("data_referencia", F.lit("2026-01-09")))
    assert silver.dedup_sales(datado).count() == 2


def test_pending_stays_active(spark):
    s = silver.to_silver(bronze_frame(spark, [sale(status=" pendente ")]), INSTANTE)
    assert rows(s.ativas, "status") == [("PENDENTE",)]


def test_negative_net_aborts(spark):
    s = silver.to_silver(bronze_frame(spark, [sale(desconto_valor="4000")]), INSTANTE)
    with pytest.raises(Exception, match="negative net value"):
        s.ativas.collect()


def test_bad_number_aborts(spark, bronze):
    ruim = bronze.withColumn("quantidade", F.lit("dez"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.standardize(ruim).collect()


def test_calendar(spark):
    horas = [(h, f"2026-01-08 {h:02d}:30:00") for h in (5, 6, 11, 12, 17, 18, 22, 23)]
    df = spark.createDataFrame(horas, "h int, t string").withColumn("data_venda", F.col("t").cast("timestamp_ntz"))
    df = col.calendar_columns(df).orderBy("h")
    assert [r[0] for r in rows(df, "periodo")] == [
        "MADRUGADA", "MANHA", "MANHA", "TARDE", "TARDE", "NOITE", "NOITE", "MADRUGADA",
    ]
    primeira = df.first()
    assert (primeira["ano"], primeira["trimestre"], primeira["semestre"], primeira["dia_semana"]) == (2026, 1, 1, 4)
    # ISO week 53 of 2020 belongs to 1 January 2021, whose calendar year stays 2021.
    virada = spark.sql("select timestamp_ntz'2021-01-01 00:00:00' data_venda")
    assert rows(col.calendar_columns(virada), "ano", "semana_ano") == [(2021, 53)]


def test_labels_and_names(spark):
    df = spark.createDataFrame([("Loja Fisica", "Informatica", "Sao Paulo"), ("Online", "Móveis", "Manaus")], "canal_venda string, categoria string, cidade string")
    assert rows(normalize_labels(df), "canal_venda", "categoria", "cidade") == [
        ("Loja Física", "Informática", "São Paulo"),
        ("Online", "Móveis", "Manaus"),
    ]
    assert silver.lower_names(spark.range(1).withColumnRenamed("id", " Id ")).columns == ["id"]


def test_null_nans(spark):
    df = spark.sql("select double('NaN') a, 1.5D b, 'x' s")
    assert rows(silver.null_nans(df), "a", "b", "s") == [(None, 1.5, "x")]


REGISTRO = {
    "id_venda": "PDV-L3-000020", "loja_id": 3, "quantidade": 2, "valor_unitario": 640.0, "custo_unitario": 410.0,
    "desconto_valor": 32.0, "data_venda": "2026-03-02T16:40:00", "status": "PENDENTE", "produto_id": 902,
    "cliente_id": 58,
}
ESQUEMA = (
    "id_venda string, loja_id int, quantidade int, valor_unitario double, custo_unitario double, desconto_valor double, "
    "data_venda string, status string, produto_id int, cliente_id bigint"
)


def evaluated(spark, **mudancas):
    linha = REGISTRO | mudancas
    df = spark.createDataFrame([tuple(linha.values())], ESQUEMA)
    return quality.evaluate(df, spark.createDataFrame([(901,), (902,)], "produto_id bigint"))


@pytest.mark.parametrize(
    ("mudanca", "regras"),
    [
        ({}, []),
        ({"quantidade": 0}, ["quantidade_positiva", "desconto_razoavel"]),
        ({"valor_unitario": 0.0}, ["valor_unitario_positivo", "desconto_razoavel", "custo_menor_que_preco"]),
        ({"status": "DEVOLVIDA"}, ["status_permitido"]),
        ({"status": "concluida"}, ["status_permitido"]),
        ({"id_venda": ""}, ["id_venda_nao_nulo"]),
        ({"id_venda": None}, ["id_venda_nao_nulo"]),
        ({"loja_id": 6}, ["loja_id_valido"]),
        ({"data_venda": "ontem"}, ["data_venda_valida"]),
        ({"desconto_valor": -1.0}, ["desconto_nao_negativo"]),
        ({"desconto_valor": None}, ["desconto_nao_negativo", "desconto_razoavel"]),
        ({"desconto_valor": 384.01}, ["desconto_razoavel"]),
        ({"produto_id": 999}, ["produto_id_valido"]),
        ({"produto_id": None}, ["produto_id_valido"]),
        ({"cliente_id": 0}, ["cliente_id_positivo"]),
        ({"custo_unitario": 640.0}, ["custo_menor_que_preco"]),
    ],
)
def test_rules(spark, mudanca, regras):
    assert rows(evaluated(spark, **mudanca), "regras") == [(regras,)]


def test_routing_and_report(spark):
    todas = evaluated(spark).unionByName(evaluated(spark, quantidade=0, produto_id=999)).unionByName(
        evaluated(spark, cliente_id=0)
    )
    destino = quality.route(todas)
    assert destino.validas.count() == 2 and "regras" not in destino.validas.columns
    assert rows(destino.invalidas, "regras_violadas") == [("quantidade_positiva|desconto_razoavel|produto_id_valido",)]
    falhas = {r["regra"]: r["falhas"] for r in quality.failures_by_rule(todas).collect()}
    assert len(falhas) == 11 and falhas["quantidade_positiva"] == 1 and falhas["cliente_id_positivo"] == 1
    relatorio = quality.report(todas).first()
    assert (relatorio["total_registros"], relatorio["registros_invalidos"], relatorio["taxa_aprovacao"]) == (3, 1, 66.67)
    assert relatorio["por_regra"]["produto_id_valido"]["falhas"] == 1


def test_scores(spark):
    df = spark.createDataFrame([(100, 3), (0, 0), (10, 20)], "lidos int, ruins int")
    df = df.select(
        col.approval_rate(F.col("lidos"), F.col("ruins")).alias("a"), col.quality_score(F.col("lidos"), F.col("ruins")).alias("q")
    )
    assert rows(df, "a", "q") == [(97.0, 97.0), (100.0, 0.0), (0.0, -100.0)]


def test_months(spark):
    df = spark.createDataFrame([("2026-11",), ("2028-02",)], "m string")
    d = col.label_to_date(F.col("m"))
    df = df.select(
        col.shift_month(F.col("m"), 3).alias("s"),
        col.month_distance(F.col("m"), F.lit("2027-02")).alias("d"),
        col.days_in_month(F.year(d), F.month(d)).alias("n"),
    )
    assert rows(df, "s", "d", "n") == [("2027-02", 3, 30), ("2028-05", -12, 29)]


def test_presentation(spark):
    df = spark.createDataFrame(
        [("raw/a\\b/vendas_1.json", "PROCESSED"), ("", "pendente"), (None, "failed")], "p string, s string"
    ).select(col.file_name(F.col("p")).alias("f"), col.status_tone(F.col("s")).alias("t"))
    assert rows(df, "f", "t") == [
        ("vendas_1.json", "verde"),
        ("Arquivo não identificado", "amarelo"),
        ("Arquivo não identificado", "vermelho"),
    ]
    serial = col.serialize(spark.sql("select date'2026-01-08' d, 1.50BD v, timestamp_ntz'2026-01-08 10:00:00' t"))
    assert rows(serial, "d", "v", "t") == [("2026-01-08", 1.5, "2026-01-08T10:00:00")]
    assert date.fromisoformat(serial.first()["d"]) == date(2026, 1, 8)
