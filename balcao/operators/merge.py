"""Upserts as joins: per-column choice between the stored and the incoming row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col


def merge_by_key(
    alvo: DataFrame,
    novos: DataFrame,
    chave: Sequence[str],
    atualizar: Sequence[str],
    calculadas: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Full outer join of a table with a batch, both unique on ``chave``.

    Existing rows take the ``atualizar`` columns from the batch and keep the others; new rows are added whole.
    ``calculadas`` overrides a column of rows present on both sides, written over ``t.`` (stored) and ``s.`` (incoming).
    """
    calculadas = calculadas or {}
    t = alvo.withColumn("_t", F.lit(True)).alias("t")
    s = novos.select(*alvo.columns).withColumn("_s", F.lit(True)).alias("s")
    condicao = [c(f"t.{k}") == c(f"s.{k}") for k in chave]
    antigo, novo = c("t._t").isNotNull(), c("s._s").isNotNull()
    saida = []
    for coluna in alvo.columns:
        velho, entrando = c(f"t.{coluna}"), c(f"s.{coluna}")
        if coluna in chave:
            valor = F.coalesce(velho, entrando)
        elif coluna in calculadas:
            valor = F.when(antigo & novo, calculadas[coluna]).when(novo, entrando).otherwise(velho)
        elif coluna in atualizar:
            valor = F.when(novo, entrando).otherwise(velho)
        else:
            valor = F.when(antigo, velho).otherwise(entrando)
        saida.append(valor.alias(coluna))
    return t.join(s, condicao, "full_outer").select(*saida)


def only_missing(novos: DataFrame, alvo: DataFrame, chave: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key is not stored yet."""
    return novos.join(alvo.select(*chave), list(chave), "left_anti")


def upsert_counts(novos: DataFrame, alvo: DataFrame, chave: Sequence[str]) -> DataFrame:
    """Received, inserted and updated rows of a batch in one pass over the keys."""
    marcado = novos.select(*chave).join(
        alvo.select(*chave).withColumn("_existe", F.lit(True)), list(chave), "left"
    )
    return marcado.agg(
        F.count("*").alias("registros_recebidos"),
        F.count_if(c("_existe").isNull()).alias("registros_inseridos"),
        F.count_if(c("_existe").isNotNull()).alias("registros_atualizados"),
    )
