"""Row quality rules on Bronze: evaluation, routing and report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from balcao import schemas
from balcao.functions.columns import once, quality_score

c = F.col
_BLOQUEANTES = [nome for nome, severidade in schemas.REGRAS_QUALIDADE if severidade in schemas.SEVERIDADES_BLOQUEANTES]


def _text_time(coluna: str) -> Column:
    return c(coluna).try_cast("timestamp_ntz")


def conditions(bronze: DataFrame, no_catalogo: Column) -> dict[str, Column]:
    """What a good row satisfies, rule by rule. Runs on values as they came, typed or still text."""

    def number(coluna: str) -> Column:
        return c(coluna).try_cast("double")

    bruto = number("quantidade") * number("valor_unitario")
    desconto = number("desconto_valor")
    momento = c("data_venda") if bronze.schema["data_venda"].dataType != T.StringType() else _text_time("data_venda")
    return {
        "id_venda_nao_nulo": c("id_venda").isNotNull() & (c("id_venda") != ""),
        "loja_id_valido": number("loja_id").isin(*[float(n) for n in schemas.LOJAS]),
        "quantidade_positiva": number("quantidade") > 0,
        "valor_unitario_positivo": number("valor_unitario") > 0,
        "data_venda_valida": momento.isNotNull(),
        "status_permitido": c("status").isin(*schemas.STATUS),
        "desconto_nao_negativo": F.coalesce(desconto, F.lit(-1.0)) >= 0,
        "desconto_razoavel": (bruto > 0) & (desconto <= bruto * 0.30),
        "produto_id_valido": no_catalogo,
        "cliente_id_positivo": number("cliente_id") > 0,
        "custo_menor_que_preco": number("custo_unitario") < number("valor_unitario"),
    }


def evaluate(bronze: DataFrame, catalogo: DataFrame) -> DataFrame:
    """Adds ``regras``: the violated rules in rule order. ``catalogo`` has one row per known product; Spark sizes
    that join, a large catalogue is shuffled and a hot product split."""
    conhecidos = catalogo.select(c("produto_id").alias("_produto")).distinct().withColumn("_conhecido", F.lit(True))
    marcado = bronze.join(conhecidos, c("produto_id") == c("_produto"), "left")
    ok = conditions(bronze, c("_conhecido"))
    violadas = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok[nome], F.lit(False)), F.lit(nome)) for nome, _ in schemas.REGRAS_QUALIDADE])
    )
    return once(marcado, "regras", violadas).drop("_produto", "_conhecido")


def is_blocked() -> Column:
    return F.arrays_overlap(c("regras"), F.array(*[F.lit(n) for n in _BLOQUEANTES]))


@dataclass(frozen=True)
class Routed:
    validas: DataFrame
    invalidas: DataFrame


def route(avaliadas: DataFrame) -> Routed:
    """Rows with a critical or error rule go to quarantine with all violated names, warnings included."""
    invalidas = avaliadas.where(is_blocked()).withColumn("regras_violadas", F.array_join("regras", "|"))
    return Routed(avaliadas.where(~is_blocked()).drop("regras"), invalidas.drop("regras"))


def failures_by_rule(avaliadas: DataFrame) -> DataFrame:
    """Failures per rule, zero rows included: one pass of counters, turned into rows afterwards."""
    contadores = avaliadas.agg(
        *[F.count_if(F.array_contains("regras", nome)).alias(nome) for nome, _ in schemas.REGRAS_QUALIDADE]
    )
    linhas = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordem"), F.lit(nome).alias("regra"), F.lit(sev).alias("severidade"), c(nome).alias("falhas")
            )
            for i, (nome, sev) in enumerate(schemas.REGRAS_QUALIDADE, 1)
        ]
    )
    return contadores.select(F.explode(linhas).alias("r")).select("r.*")


def report(avaliadas: DataFrame, *chave: str) -> DataFrame:
    """Totals and approval, for all rows or per key (the reference date), with the failures of each rule."""
    por_regra = F.struct(
        *[
            F.struct(
                F.count_if(F.array_contains("regras", nome)).alias("falhas"), F.first(F.lit(sev)).alias("severidade")
            ).alias(nome)
            for nome, sev in schemas.REGRAS_QUALIDADE
        ]
    )
    totais = avaliadas.groupBy(*chave).agg(
        F.count("*").alias("total_registros"),
        F.count_if(is_blocked()).alias("registros_invalidos"),
        por_regra.alias("por_regra"),
    )
    return totais.withColumn("registros_validos", c("total_registros") - c("registros_invalidos")).withColumn(
        "taxa_aprovacao", quality_score(c("total_registros"), c("registros_invalidos"))
    )
