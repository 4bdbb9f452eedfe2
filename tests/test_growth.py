"""What must not grow faster than the data, or be computed twice, or be sent to the driver."""

from __future__ import annotations

from functools import reduce
from operator import and_

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from balcao import schemas
from balcao.functions.lineage import LINHAS_GRANDES, write_intermediate
from balcao.operators import bloom, contract, key_index, silver
from balcao.sources import export, raw
from balcao.sources.lake import Lake
from tests.conftest import INSTANTE, TRES_VENDAS, bronze_frame, envelope, land, sale


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_rows_are_few_bytes_and_never_broadcast(spark):
    chaves = spark.range(200).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 2).cast("int").alias("g"))
    filtro = bloom.build(chaves, ["k"], ["g"], 65_536)
    tamanho = filtro.agg(F.sum(F.octet_length(F.to_json("bits")))).first()[0]
    assert filtro.count() <= 200 and tamanho < 200 * 256
    pequeno = spark.createDataFrame(filtro.collect(), filtro.schema).coalesce(1)
    procura = bloom.probe(chaves.drop("g"), ["k"], pequeno, ["g"], 65_536)
    assert "BroadcastHashJoin" not in plan_of(procura)
    assert procura.join(chaves, ["k", "g"]).count() == 200


def test_active_and_cancelled_sales_are_computed_once(spark):
    s = silver.to_silver(bronze_frame(spark, TRES_VENDAS), INSTANTE)
    assert "Union" not in plan_of(s.todas())
    assert sorted(map(str, s.todas().collect())) == sorted(map(str, s.ativas.unionByName(s.canceladas).collect()))


def test_envelopes_are_spread_over_all_partitions_by_one_shuffle(spark):
    vendas = bronze_frame(spark, TRES_VENDAS).withColumn("data", F.to_date("data_venda"))
    plano = plan_of(export.package(vendas, INSTANTE))
    assert "REPARTITION_BY_NUM" in plano and plano.count("Exchange hashpartitioning") == 1
    assert export.package(vendas, INSTANTE).select("parte", "quantidade_registros").first() == (0, len(TRES_VENDAS))
    assert set(schemas.CAMPOS_ENVELOPE) <= set(export.package(vendas, INSTANTE).columns)


def test_orders_of_a_month_lie_in_few_bitmaps(spark, tmp_path):
    chaves = spark.range(72_000).select(F.concat(F.lit("VND-"), "id").alias("chave"), F.lit(2026).alias("ano"), (F.col("id") % 12 + 1).cast("int").alias("mes"))
    lago = Lake(spark, str(tmp_path))
    with lago.transaction():
        numeros = key_index.numbered(lago, "indice/vendas", chaves, 16)
        vendas = numeros.join(chaves, "chave")
        assert vendas.agg(F.min("numero"), F.max("numero"), F.count_distinct("numero")).first() == (1, 72_000, 72_000)
        bits = key_index.order_bits(vendas, "ano", "mes")
        assert bits.count() <= 12 + 2
        assert {r["pedidos"] for r in key_index.counted(bits, "ano", "mes").collect()} == {6_000}


def test_large_rows_lie_in_small_row_groups(spark):
    escritas = write_intermediate(spark.range(50).coalesce(1), "grandes", LINHAS_GRANDES)
    grupos = pq.ParquetFile(escritas.inputFiles()[0].removeprefix("file://")).metadata
    assert escritas.count() == 50 and max(grupos.row_group(i).num_rows for i in range(grupos.num_row_groups)) <= 8


def test_sale_rules_have_no_slow_membership_test(spark):
    assert " IN (" not in str(reduce(and_, contract.sale_rules(F.col("v")).values())).upper()
    lido = spark.sql("SELECT named_struct('status', 'X', 'cliente_segmento', cast(null as string)) AS v")
    assert [r[0] for r in lido.select(contract.among(F.col("v.status"), ("X", "Y"))).collect()] == [True]
    assert lido.select(contract.among(F.col("v.cliente_segmento"), ("X", "Y"))).first()[0] is None


def test_each_field_of_a_sale_is_trimmed_once(spark, tmp_path):
    land(tmp_path, envelope([sale(cliente_nome="  Ana Prado\t")]) | {"checksum": envelope([sale()])["checksum"]})
    checados = contract.check(raw.parse(raw.scan(spark, f"{tmp_path}/raw", "2026-01-08", "2026-01-08")))
    assert checados.selectExpr("erros", "vendas[0].cliente_nome").first() == ([], "Ana Prado")
    plano = checados._jdf.queryExecution().optimizedPlan().toString()
    assert plano.count("trim(") < 60
    regras = str(contract.sale_is_right(F.col("v"))).lower()
    assert "trim(" not in regras and regras.count("as timestamp_ntz") <= 1 and regras.count("multiply(") <= 2


def test_a_large_file_is_a_row_group_of_its_own(spark):
    grandes = spark.range(4).coalesce(1).select(F.repeat(F.col("id").cast("string"), 9_000_000).alias("value"))
    escritas = write_intermediate(grandes, "grandes", LINHAS_GRANDES)
    grupos = pq.ParquetFile(escritas.inputFiles()[0].removeprefix("file://")).metadata
    assert [grupos.row_group(i).num_rows for i in range(grupos.num_row_groups)] == [1, 1, 1, 1]


def test_sales_are_collected_as_bytes_by_small_tasks(spark):
    vendas = bronze_frame(spark, TRES_VENDAS).withColumn("data", F.to_date("data_venda"))
    plano = plan_of(export.package(vendas, INSTANTE))
    assert "collect_list(venda#" in plano
    partes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert f", {export.TAREFAS_POR_PARTICAO * partes}), REPARTITION_BY_NUM" in plano


def test_a_file_is_copied_by_two_generators_only(spark, tmp_path):
    land(tmp_path, envelope(TRES_VENDAS))
    checados = contract.check(raw.parse(raw.scan(spark, f"{tmp_path}/raw", "2026-01-08", "2026-01-08")))
    plano = checados._jdf.queryExecution().optimizedPlan().toString()
    assert plano.count("Generate ") == 2 and "value#" not in plano.split("Generate inline(true)")[0].split("Generate ")[0]
