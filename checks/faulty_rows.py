"""Rows of the sample as careless terminals would send them; they feed the rules that refuse such rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.schemas import DINHEIRO
from balcao.sources.sample_star import SampleStar, sale_time


def mistyped_product() -> Column:
    """The part key as a terminal without a catalogue sends it: lines taxed at 8 % carry an unlisted id."""
    return F.when(F.col("l_tax").cast("decimal(4,2)") == F.lit("0.08").cast("decimal(4,2)"), -1 - F.col("l_partkey")).otherwise(F.col("l_partkey"))


def unclean_bronze(wh: SampleStar) -> DataFrame:
    """Order lines read as records of a terminal that does not validate: zero-based quantities and regions, lower
    case statuses, discounts net of tax, unlisted products; untaxed first lines lack their id, untaxed second lines
    their date. Feeds the quality rules with rows that break them."""
    sem_imposto = F.col("l_tax") == 0
    status = F.when(F.col("l_returnflag") == "R", "CANCELADA").when(F.col("l_returnflag") == "A", "CONCLUIDA")
    linhas = wh.lines().withColumns({"loja_id": F.col("loja_id") - 1, "posicao": F.col("l_suppkey")})
    preco = (F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")) / 100).cast(DINHEIRO)
    bruto = F.col("l_extendedprice").cast(DINHEIRO)
    taxa = F.col("l_discount").cast("decimal(4,2)") - F.col("l_tax").cast("decimal(4,2)")
    return (
        linhas.join(wh.table("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(wh.dim_produto().select("produto_id", "custo_base"), F.col("l_partkey") == F.col("produto_id"))
        .select(
            F.when(sem_imposto & (F.col("l_linenumber") == 1), "")
            .otherwise(F.concat_ws("-", F.lit("VND"), "l_orderkey", "l_linenumber"))
            .alias("id_venda"),
            "loja_id",
            F.col("o_custkey").alias("cliente_id"),
            mistyped_product().alias("produto_id"),
            (F.col("l_quantity").cast("int") - 1).alias("quantidade"),
            preco.alias("valor_unitario"),
            F.col("custo_base").alias("custo_unitario"),
            F.round(bruto * taxa, 2).cast(DINHEIRO).alias("desconto_valor"),
            F.when(sem_imposto & (F.col("l_linenumber") == 2), "sem data")
            .otherwise(sale_time().cast("string"))
            .alias("data_venda"),
            status.otherwise("pendente").alias("status"),
            "posicao",
        )
    )
