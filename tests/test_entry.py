"""The registered queries against their SQL on the smallest sample; the whole set runs with checks.compare."""

import os

import pytest

import __spark_entry__ as entrada
from checks.compare import check, connect
from checks.registry import QUERIES

SF = "/root/testdata/sf0.001"
AMOSTRA = (
    "V2_faturamento_por_loja", "V5_meta_vs_realizado", "V8_top10_produtos", "E4_dre_gerencial", "M18_forecast_ml",
    "M20_qualidade_diaria", "K4_cancelamento", "C14_falhas_por_regra", "A5_arquivos_recusados", "L1_merge_de_fatos",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="sample tables are not here")


def test_contract():
    """Every query of the registry has SQL; only queries of the optional subpackage may go without."""
    nomes, sql = set(entrada.queries()), set(entrada.oracle_sql())
    assert set(QUERIES) <= sql <= nomes and len(QUERIES) > 100


def test_flagship(spark):
    df = entrada.entry(spark)
    assert df.count() > 0 and "crescimento_mom" in df.columns


@pytest.mark.parametrize("nome", AMOSTRA)
def test_query_matches_sql(spark, nome):
    ok, texto = check(spark, connect(SF), nome, SF)
    assert ok, texto


def test_plans_prune_push_and_broadcast(spark):
    """One fact scan with only the needed columns, no Python, bounded broadcasts."""
    plano = QUERIES["V2_faturamento_por_loja"]
    from balcao.sources.sample_star import SampleStar

    texto = plano.plan(SampleStar(spark, SF))._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert texto.count("lineitem.parquet") == 1
    assert "part.parquet" not in texto and "customer.parquet" not in texto
    assert "l_tax" not in texto and "Python" not in texto and "BroadcastHashJoin" in texto
