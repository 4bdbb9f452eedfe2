"""Bronze to Silver: dedup, strict typing, financial and calendar columns, status split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from balcao.functions.columns import calendar_columns, percent_or_zero, text
from balcao.functions.labels import ROTULOS, normalize_labels
from balcao.params import PADRAO, Params
from balcao.schemas import BRONZE, DINHEIRO, FATO_CHAVE


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def keep_last(df: DataFrame, chave: Sequence[str], ordem: list[Column]) -> DataFrame:
    """Last row per key. The ``= 1`` filter lets Spark drop all but one row per key before the shuffle,
    so a hot key sends one row per task."""
    w = Window.partitionBy(*chave).orderBy(*ordem)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def dedup_sales(bronze: DataFrame) -> DataFrame:
    """File order decides which repeated sale survives: the highest file name, then the highest position.
    Runs on raw values, before any cleaning. With several reference dates each date is deduplicated on its own, as
    separate daily runs would do."""
    chave = [*FATO_CHAVE, "data_referencia"] if "data_referencia" in bronze.columns else list(FATO_CHAVE)
    return keep_last(bronze, chave, [F.col("arquivo_origem").desc(), F.col("posicao").desc()])


def standardize(df: DataFrame) -> DataFrame:
    """Strict casts (ANSI mode raises on a bad value) and clean status and segment text."""
    df = lower_names(df)
    tipos: dict[str, T.DataType | str] = {
        "data_venda": "timestamp_ntz",
        "loja_id": "int",
        "cliente_id": "bigint",
        "produto_id": "bigint",
        "quantidade": "int",
        "valor_unitario": DINHEIRO,
        "custo_unitario": DINHEIRO,
        "desconto_valor": DINHEIRO,
    }
    df = df.withColumns({c: F.col(c).cast(t) for c, t in tipos.items()})
    df = df.withColumns({c: F.upper(text(F.col(c))) for c in ("status", "cliente_segmento")})
    return normalize_labels(df, {"canal_venda": ROTULOS["canal_venda"]})


def financial_columns(df: DataFrame) -> DataFrame:
    """Gross, net, cost and margin in exact decimals; percentages are zero when their base is not positive.
    Without a unit cost column only the revenue side is added."""
    df = df.withColumn("valor_bruto", F.round(F.col("quantidade") * F.col("valor_unitario"), 2).cast(DINHEIRO))
    df = df.withColumn("valor_liquido", (F.col("valor_bruto") - F.col("desconto_valor")).cast(DINHEIRO))
    df = df.withColumn("desconto_pct_calc", percent_or_zero(F.col("desconto_valor"), F.col("valor_bruto")))
    if "custo_unitario" not in df.columns:
        return df
    df = df.withColumn("custo_total", F.round(F.col("quantidade") * F.col("custo_unitario"), 2).cast(DINHEIRO))
    df = df.withColumn("margem_bruta", (F.col("valor_liquido") - F.col("custo_total")).cast(DINHEIRO))
    return df.withColumn("margem_bruta_pct", percent_or_zero(F.col("margem_bruta"), F.col("valor_liquido")))


def reject_negative_net(df: DataFrame) -> DataFrame:
    """Fail the job when an active sale has a negative net value."""
    erro = F.raise_error(F.concat(F.lit("negative net value in sale "), F.col("id_venda")))
    return df.withColumn(
        "valor_liquido",
        F.when((F.col("status") != "CANCELADA") & (F.col("valor_liquido") < 0), erro.cast(DINHEIRO)).otherwise(F.col("valor_liquido")),
    )


def stamp(df: DataFrame, instante: datetime, params: Params = PADRAO) -> DataFrame:
    return df.withColumns(
        {"processed_at": F.lit(instante).cast("timestamp"), "pipeline_version": F.lit(params.versao)}
    )


@dataclass(frozen=True)
class Silver:
    ativas: DataFrame
    canceladas: DataFrame
    #: Both kinds as one plan, so that who reads both does not compute their sales twice.
    juntas: DataFrame | None = None

    def todas(self) -> DataFrame:
        return self.juntas if self.juntas is not None else self.ativas.unionByName(self.canceladas)


def to_silver(bronze: DataFrame, instante: datetime, params: Params = PADRAO) -> Silver:
    """Active sales (completed and pending) apart from cancelled ones."""
    tratadas = stamp(calendar_columns(financial_columns(standardize(dedup_sales(bronze)))), instante, params)
    ativas = reject_negative_net(tratadas.where("status <> 'CANCELADA'"))
    juntas = reject_negative_net(tratadas.where("status is not null"))
    return Silver(ativas, tratadas.where("status = 'CANCELADA'"), juntas)


def silver_schema(spark: SparkSession) -> T.StructType:
    """Schema of the Silver tables, taken from the plan itself."""
    vazio = spark.createDataFrame([], T.StructType([*BRONZE.fields, T.StructField("data_referencia", T.DateType())]))
    return to_silver(vazio, datetime(2026, 1, 1)).ativas.schema


def removed_duplicates(bronze: DataFrame) -> DataFrame:
    """Rows in, distinct keys and rows removed, as one row."""
    return (
        bronze.groupBy(*FATO_CHAVE)
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("registros_entrada"), F.count("*").alias("registros_unicos"))
        .withColumn("duplicatas_removidas", F.col("registros_entrada") - F.col("registros_unicos"))
    )


def null_nans(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column, as a load into typed tables expects."""
    reais = [c.name for c in df.schema.fields if isinstance(c.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in reais}) if reais else df
