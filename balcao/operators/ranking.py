"""Ranks over groups too large for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao.functions.lineage import write_intermediate

c = F.col
VALOR = "decimal(28,2)"


def spread_ranks(
    df: DataFrame, grupo: Sequence[str], ranks: Mapping[str, str], dense: bool = False
) -> DataFrame:
    """``rank`` or ``dense_rank`` (descending) of several money or count columns per group, without sorting a group in
    one task. ``ranks`` maps the new column to the ranked one.

    Rows are first reduced to a histogram of distinct values. The histogram is range-partitioned, each block is ranked
    on its own, and the rows of the blocks before it are added. Ties stay together because equal values share one
    histogram row; a window over a whole group only ever sees one row per block. A missing value ranks first, as in a descending order. ``df`` is read more than once, so
    pass a written table or a scan.
    """
    grupo = list(grupo)
    chave = [*grupo, "_m"]
    medidas = F.inline(
        F.array(*[F.struct(F.lit(nome).alias("_m"), c(col).cast(VALOR).alias("_v")) for nome, col in ranks.items()])
    )
    passo = F.lit(1).cast("long") if dense else F.count("*")
    hist = df.select(*grupo, medidas).groupBy(*chave, "_v").agg(passo.alias("_n"))
    # The block of a row must not change between the two readings below, so the placement is written.
    blocos = write_intermediate(
        hist.repartitionByRange(*chave, c("_v").desc_nulls_first()).withColumn("_b", F.spark_partition_id()), "rank"
    )
    anteriores = (Window.unboundedPreceding, -1)
    no_bloco = Window.partitionBy("_b", *chave).orderBy(c("_v").desc_nulls_first()).rowsBetween(*anteriores)
    entre_blocos = Window.partitionBy(*chave).orderBy("_b").rowsBetween(*anteriores)
    zero = F.lit(0).cast("long")
    inicio = (
        blocos.groupBy(*chave, "_b")
        .agg(F.sum("_n").alias("_t"))
        .select(*chave, "_b", F.coalesce(F.sum("_t").over(entre_blocos), zero).alias("_o"))
    )
    posicoes = join_null_safe(blocos.withColumn("_l", F.coalesce(F.sum("_n").over(no_bloco), zero)), inicio, [*chave, "_b"])
    posicoes = posicoes.withColumn("_r", (c("_o") + c("_l") + 1).cast("int"))
    for nome, coluna in ranks.items():
        da_medida = posicoes.where(c("_m") == nome).select(*grupo, "_v", c("_r").alias(nome))
        df = join_null_safe(df.withColumn("_v", c(coluna).cast(VALOR)), da_medida, [*grupo, "_v"]).drop("_v")
    return df


def join_null_safe(esquerda: DataFrame, direita: DataFrame, chave: Sequence[str]) -> DataFrame:
    """Inner join in which NULL equals NULL; the key columns come from the left side."""
    outra = direita.withColumnsRenamed({k: f"_d{k}" for k in chave})
    condicao = reduce(and_, [c(k).eqNullSafe(c(f"_d{k}")) for k in chave])
    return esquerda.join(outra, condicao).drop(*[f"_d{k}" for k in chave])
