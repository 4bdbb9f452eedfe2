"""Raw landing zone: one JSON envelope per file under loja=/ano=/mes=/dia= folders."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from balcao.operators.contract import TIPOS, integer
from balcao.schemas import CAMPOS_ENVELOPE, ENVELOPE_RAW, LOJAS
from balcao.sources.files import Files

c = F.col
CORROMPIDO = "_corrompido"
RAW_TEXT = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("loja", T.StringType()),
        T.StructField("ano", T.IntegerType()),
        T.StructField("mes", T.IntegerType()),
        T.StructField("dia", T.IntegerType()),
    ]
)


def partition_date() -> Column:
    return F.make_date(c("ano"), c("mes"), c("dia"))


def in_scope(inicio: str, fim: str, lojas: Sequence[int]) -> Column:
    """Partition filter for a date range and a list of stores."""
    pastas = [f"loja_{n}" for n in lojas]
    return c("loja").isin(pastas) & partition_date().between(F.lit(inicio).cast("date"), F.lit(fim).cast("date"))


def with_origin(arquivos: DataFrame) -> DataFrame:
    return arquivos.select(
        "value",
        F.regexp_extract("loja", r"(\d+)$", 1).cast("int").alias("loja_pasta"),
        partition_date().alias("data_referencia"),
        c("_metadata.file_path").alias("arquivo_origem"),
    )


def folders(spark: SparkSession, raiz: str, inicio: str, fim: str, lojas: Sequence[int]) -> list[str]:
    """Folders of the range that exist, below ``raiz``/vendas. Only the months of the range are listed, for each store."""
    arquivos, achadas = Files(spark), []
    primeiro, ultimo = date.fromisoformat(inicio), date.fromisoformat(fim)
    meses = sorted({(d.year, d.month) for d in (primeiro + timedelta(days=n) for n in range((ultimo - primeiro).days + 1))})
    for loja in lojas:
        for ano, mes in meses:
            # Terminals write months and days with or without a leading zero.
            for pasta in dict.fromkeys((f"{mes:02d}", str(mes))):
                do_mes = f"loja=loja_{loja}/ano={ano}/mes={pasta}"
                for nome in arquivos.names(f"{raiz}/vendas/{do_mes}"):
                    dia = nome.removeprefix("dia=")
                    if dia.isdecimal() and primeiro <= date(ano, mes, int(dia)) <= ultimo:
                        achadas.append(f"{do_mes}/{nome}")
    return achadas


def scan(spark: SparkSession, raiz: str, inicio: str, fim: str, lojas: Sequence[int] = LOJAS) -> DataFrame:
    """Text and origin of every raw file of the range. Only the folders of its dates and stores are listed."""
    leitor = spark.read.schema(RAW_TEXT).option("wholetext", True).option("pathGlobFilter", "*.json")
    pastas = folders(spark, raiz, inicio, fim, lojas)
    if not pastas:
        vazio = "value string, loja_pasta int, data_referencia date, arquivo_origem string"
        return spark.createDataFrame([], vazio)
    arquivos = leitor.option("basePath", f"{raiz}/vendas").format("text").load([f"{raiz}/vendas/{p}" for p in pastas])
    return with_origin(arquivos.where(in_scope(inicio, fim, lojas)))


def parse(textos: DataFrame) -> DataFrame:
    """Envelope fields as text next to the origin columns; unreadable JSON is kept and marked. ``tipos`` is the schema that the
    document's own values have, all its sales merged: it tells a number from a number written as text."""
    esquema = T.StructType([*ENVELOPE_RAW.fields, T.StructField(CORROMPIDO, T.StringType())])
    opcoes = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORROMPIDO}
    # Generated rather than projected, so that one parse serves all fields; the types come before, so that the text is not carried along.
    lido = textos.withColumn(TIPOS, F.schema_of_variant(F.try_parse_json("value"))).select(
        *[col for col in textos.columns if col != "value"],
        TIPOS,
        F.inline_outer(F.array(F.from_json("value", esquema, opcoes))),
    )
    vazio = F.coalesce(*CAMPOS_ENVELOPE).isNull() & c("vendas").isNull()
    return lido.withColumn("ilegivel", c(CORROMPIDO).isNotNull() | vazio).drop(CORROMPIDO)


def store_list(spark: SparkSession, lojas: Sequence[int] = LOJAS) -> DataFrame:
    return spark.createDataFrame([(n,) for n in lojas], "loja_id int")


def availability(textos: DataFrame, lojas: DataFrame) -> DataFrame:
    """Raw files per requested store; stores without files show zero."""
    contagem = textos.groupBy(c("loja_pasta").alias("loja_id")).agg(
        F.count_distinct("arquivo_origem").alias("arquivos")
    )
    return (
        lojas.join(contagem, "loja_id", "left")
        .na.fill(0, ["arquivos"])
        .withColumn("disponivel", c("arquivos") > 0)
        .orderBy("loja_id")
    )


def any_available(disponibilidade: DataFrame) -> DataFrame:
    return disponibilidade.agg(F.coalesce(F.bool_or("disponivel"), F.lit(False)).alias("continuar"))


def profile(envelopes: DataFrame) -> DataFrame:
    """Sales per store and shift straight from the envelopes."""
    return (
        envelopes.groupBy(integer(c("loja_id")).cast("int").alias("loja_id"), "turno")
        .agg(F.sum(F.size("vendas")).cast("long").alias("registros"))
        .orderBy("loja_id", "turno")
    )


# Reference files


def read_stores(spark: SparkSession, caminho: str) -> DataFrame:
    esquema = (
        "loja_id int, loja_nome string, cidade string, estado string, regiao string, data_abertura date, "
        "tier string, meta_mensal decimal(15,2), area_m2 int, capacidade_max int"
    )
    return spark.read.schema(esquema).option("multiLine", True).json(caminho)


def read_products(spark: SparkSession, caminho: str) -> DataFrame:
    esquema = (
        "produto_id bigint, categoria string, subcategoria string, produto_nome string, marca string, "
        "preco_base decimal(12,2), custo_base decimal(12,2)"
    )
    return spark.read.schema(esquema).option("multiLine", True).json(caminho)


def read_budgets(spark: SparkSession, caminho: str) -> DataFrame:
    """One row per store of the nested budget document, with its base year."""
    esquema = (
        "ano int, orcamentos array<struct<loja_id int, receita_mensal decimal(15,2), "
        "margem_bruta_orcada decimal(5,2), despesas_fixas_orcadas decimal(15,2), margem_semente decimal(5,2)>>"
    )
    documento = spark.read.schema(esquema).option("multiLine", True).json(caminho)
    return documento.select(c("ano").alias("ano_base"), F.explode("orcamentos").alias("o")).select("ano_base", "o.*")
