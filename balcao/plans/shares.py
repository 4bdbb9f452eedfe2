"""What each reference date adds to the months of its sales, so that a day's run changes the marts without reading other days.

Sums are kept per month, store and product; a rerun of a date withdraws what it had added and adds what it holds now.
Distinct orders and days cannot be withdrawn from a sum: they are kept per date as bitmaps and united for the month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.operators import key_index
from balcao.params import PADRAO, Params
from balcao.plans import marts

c = F.col
MES = ("ano", "mes")
LOJA = (*MES, "loja_id", "loja_nome")
GRAO = (*LOJA, "produto_id", "produto_nome", "categoria")
VALORES = ("valor_bruto", "desconto_valor", "valor_liquido", "custo_total", "margem_bruta")
SOMA = "decimal(22,2)"
#: Silver columns that the shares are made of, besides the reference date.
COLUNAS = (*GRAO, "id_venda", "status", "data_venda", "quantidade", *VALORES)
MEDIDAS = ("linhas", "quantidade", *VALORES)


def day_shares(silver: DataFrame) -> DataFrame:
    """Sums and row counts of the completed sales of each reference date, by sale month, store and product."""
    return (
        silver.where("status = 'CONCLUIDA'")
        .groupBy(*GRAO, "data_referencia")
        .agg(F.count("*").alias("linhas"), F.sum("quantidade").alias("quantidade"), *[F.sum(v).alias(v) for v in VALORES])
        .select(*GRAO, *MEDIDAS, "data_referencia")
    )


def applied(totais: DataFrame, novas: DataFrame, antigas: DataFrame) -> DataFrame:
    """Month totals after the old shares of some dates are withdrawn and their new ones added. Amounts are exact, so nothing
    drifts; what no row stands behind any more is gone."""
    parcelas = totais.select(*GRAO, *MEDIDAS).unionByName(novas.select(*GRAO, *MEDIDAS))
    saem = antigas.select(*GRAO, *[(-c(m)).cast(antigas.schema[m].dataType).alias(m) for m in MEDIDAS])
    somas = [F.sum(m).cast(SOMA if m in VALORES else "long").alias(m) for m in MEDIDAS]
    return parcelas.unionByName(saem).groupBy(*GRAO).agg(*somas).where("linhas <> 0").select(*GRAO[2:], *MEDIDAS, *MES)


def day_orders(silver: DataFrame, numeros: DataFrame) -> DataFrame:
    """Bitmaps of the completed orders of each reference date by sale month and store, with a mask of their days."""
    vendas = silver.where("status = 'CONCLUIDA'").select(*LOJA, "data_referencia", F.day("data_venda").alias("dia"), c("id_venda").alias("chave"))
    mascara = F.bit_or(F.call_function("shiftleft", F.lit(1), c("dia") - 1)).alias("dias")
    return (
        key_index.by_bucket(vendas.join(numeros.hint("merge"), "chave").drop("chave"), *LOJA, "data_referencia")
        .groupBy(*LOJA, "data_referencia", "balde")
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("numero")).alias("numeros"), mascara)
        .select(*LOJA, "balde", "numeros", "dias", "data_referencia")
    )


def month_marts(
    totais: DataFrame, pedidos: DataFrame, orcamento: DataFrame, por_loja: DataFrame, params: Params = PADRAO
) -> dict[str, DataFrame]:
    """The five marts of the months that ``totais`` holds whole and ``pedidos`` names the orders of."""
    soma = lambda v: F.sum(v).cast(SOMA if v in VALORES else "long")
    lojas = totais.groupBy(*LOJA).agg(*[soma(m).alias(m) for m in MEDIDAS])
    rede = (
        lojas.groupBy(*MES)
        .agg(
            soma("valor_liquido").alias("faturamento_total"),
            soma("valor_bruto").alias("receita_bruta"),
            soma("desconto_valor").alias("desconto_total"),
            soma("quantidade").alias("quantidade_total"),
            soma("margem_bruta").alias("margem_bruta"),
        )
        .join(key_index.counted(pedidos, *MES, nome="total_pedidos"), list(MES))
    )
    da_loja = lojas.select(*LOJA, c("valor_liquido").alias("faturamento"), "quantidade", "margem_bruta")
    da_loja = da_loja.join(key_index.counted(pedidos, *LOJA), list(LOJA))
    produtos = totais.groupBy(*MES, "produto_id", "produto_nome", "categoria").agg(
        soma("valor_liquido").alias("faturamento"), soma("quantidade").alias("volume")
    )
    chave = ["loja_id", *MES]
    dre = totais.groupBy(*chave).agg(
        soma("valor_bruto").alias("receita_bruta"), soma("desconto_valor").alias("descontos"), soma("custo_total").alias("cmv")
    )
    dias = pedidos.groupBy(*chave).agg(F.bit_count(F.bit_or("dias")).cast("long").alias("dias_com_venda"))
    fpa = totais.groupBy(*chave).agg(soma("valor_liquido").alias("receita_realizada"), soma("margem_bruta").alias("margem_bruta"))
    return {
        "kpis_vendas": marts.summary_lines(rede),
        "faturamento_por_loja": marts.store_lines(da_loja),
        "top_produtos": marts.product_lines(produtos, *MES),
        "dre_gerencial": marts.dre_lines(dre, por_loja, params),
        "indicadores_fpa": marts.fpa_indicators(orcamento, fpa.join(dias, chave), params),
    }


def full_marts(silver: DataFrame, orcamento: DataFrame, por_loja: DataFrame, params: Params = PADRAO) -> dict[str, DataFrame]:
    """The same marts from all Silver rows of the months."""
    return {
        "kpis_vendas": marts.kpi_summary(silver),
        "faturamento_por_loja": marts.kpi_stores(silver),
        "top_produtos": marts.kpi_products(silver, *MES),
        "dre_gerencial": marts.dre(silver, por_loja, params),
        "indicadores_fpa": marts.fpa(silver, orcamento, params),
    }
