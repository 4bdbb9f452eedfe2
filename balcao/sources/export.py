"""Packaging of sales into raw envelopes and their write-once export."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao import schemas
from balcao.operators.contract import checksum
from balcao.params import PADRAO, Params
from balcao.sources import raw

c = F.col
GRUPO = ("loja_id", "data", "turno")
#: Tasks that collect envelopes for each partition of a shuffle.
TAREFAS_POR_PARTICAO = 4


def _raw_value(campo: str) -> Column:
    """Money as text with two decimals, the date as ISO text, whole numbers as numbers."""
    if campo in schemas.CAMPOS_DECIMAIS:
        return c(campo).cast("decimal(12,2)").cast("string")
    if campo in schemas.CAMPOS_INTEIROS:
        return c(campo).cast("long")
    if campo == "data_venda":
        return F.date_format("data_venda", "yyyy-MM-dd'T'HH:mm:ss")
    return c(campo).cast("string")


def _uuid(*partes: str) -> Column:
    digest = F.md5(F.concat_ws("|", *partes))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def package(vendas: DataFrame, gerado_em: datetime, params: Params = PADRAO) -> DataFrame:
    """One envelope per store, date and shift, or ``params.partes_por_turno`` of them, each complete in itself (own count and
    checksum).

    The number of parts is fixed, so what comes out does not depend on how many sales a shift has, and sales are not counted
    first. A sale's part is a hash of all its fields and its position, so the parts of a hot shift, or of one id with very many
    rows, are alike in size.
    """
    posicao = ["posicao"] if "posicao" in vendas.columns else []
    vendas = vendas.withColumn("turno", c("turno_origem"))
    espalha = F.xxhash64(*schemas.CAMPOS_VENDA, *posicao)
    parte = F.pmod(espalha, F.lit(params.partes_por_turno)).cast("int") if params.partes_por_turno > 1 else F.lit(0)
    venda = F.struct(*[_raw_value(campo).alias(campo) for campo in schemas.CAMPOS_VENDA])
    # Sales are spread before they become text, and over all partitions whatever their size: a task holds few envelopes at a time. Unlike
    # rows of a shuffle they are held on the heap, all of a task's envelopes at once, so the tasks are smaller than those of a shuffle.
    partes = TAREFAS_POR_PARTICAO * int(vendas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    juntas = vendas.withColumn("parte", parte).select(*dict.fromkeys([*GRUPO, "parte", "loja_nome", "cidade", "estado", *schemas.CAMPOS_VENDA]))
    chave = (*GRUPO, "parte") if params.partes_por_turno > 1 else GRUPO
    # Made into a column before they are collected, sales are held as one block of bytes each, not as an object for every field.
    envelopes = juntas.repartition(partes, *chave).withColumn("venda", venda).groupBy(*chave).agg(
        F.first("loja_nome").alias("loja_nome"),
        F.first("cidade").alias("cidade"),
        F.first("estado").alias("estado"),
        F.sort_array(F.collect_list("venda")).alias("vendas"),
    )
    envelopes = envelopes if "parte" in chave else envelopes.withColumn("parte", F.lit(0))
    campos = {
        "schema_version": F.lit(schemas.VERSAO_CONTRATO),
        "origem": F.lit(schemas.ORIGEM_CONTRATO),
        "data_geracao": F.lit(gerado_em.isoformat(timespec="seconds")),
        "pipeline_id": _uuid("loja_id", "data", "turno", "parte"),
        "quantidade_registros": F.size("vendas"),
        "checksum": checksum(c("vendas")),
    }
    return envelopes.withColumns(campos).select(*schemas.CAMPOS_ENVELOPE, "vendas", "data", "parte")


def document() -> Column:
    """JSON text of an envelope."""
    return F.to_json(F.struct(*schemas.CAMPOS_ENVELOPE, "vendas"), {"ignoreNullFields": "false"})


def as_raw_text(envelopes: DataFrame) -> DataFrame:
    """Envelopes in the form the raw scan returns them."""
    nome = F.format_string(
        "vendas_%d_%s_%s-%03d.json", "loja_id", F.date_format("data", "yyyyMMdd"), F.lower("turno"), "parte"
    )
    return envelopes.select(
        document().alias("value"),
        c("loja_id").alias("loja_pasta"),
        c("data").alias("data_referencia"),
        nome.alias("arquivo_origem"),
    )


def conflicts(envelopes: DataFrame, existentes: DataFrame) -> DataFrame:
    """Shifts of the batch that already have a raw file. ``existentes``: parsed raw envelopes."""
    ja = existentes.select(
        c("loja_pasta").alias("loja_id"), c("data_referencia").alias("data"), F.trim("turno").alias("turno")
    )
    return envelopes.select(*GRUPO).distinct().join(ja, list(GRUPO), "left_semi")


def emit(envelopes: DataFrame, raiz: str) -> None:
    """Write one JSON file per envelope. Refused as a whole when any shift was emitted before; raw files are never
    overwritten. Only the folders of the batch's dates are read for that. File names ascend with the shift name inside a
    store-day."""
    dias = envelopes.agg(F.min("data").cast("string").alias("de"), F.max("data").cast("string").alias("ate")).first()
    if dias["de"] is None:
        return
    existentes = raw.parse(raw.scan(envelopes.sparkSession, raiz, dias["de"], dias["ate"]))
    repetidos = conflicts(envelopes, existentes).count()
    if repetidos:
        raise FileExistsError(f"{repetidos} shift file(s) already exist for these dates")
    pasta = {
        "loja": F.concat(F.lit("loja_"), c("loja_id").cast("string")),
        "ano": F.date_format("data", "yyyy"),
        "mes": F.date_format("data", "MM"),
        "dia": F.date_format("data", "dd"),
    }
    ordem = ("loja", "ano", "mes", "dia", "turno", "parte")
    (
        envelopes.withColumns(pasta)
        .repartitionByRange(*ordem)
        .sortWithinPartitions(*ordem)
        .select(*schemas.CAMPOS_ENVELOPE, "vendas", "loja", "ano", "mes", "dia")
        .write.mode("append")
        .option("maxRecordsPerFile", 1)
        .option("ignoreNullFields", False)
        .partitionBy("loja", "ano", "mes", "dia")
        .json(f"{raiz}/vendas")
    )


def shift_totals(vendas: DataFrame) -> DataFrame:
    """Receipt totals per store, date and shift."""
    bruto = (c("valor_unitario") * c("quantidade")).cast("decimal(18,2)")
    return (
        vendas.groupBy("loja_id", "data", c("turno_origem").alias("turno"))
        .agg(
            F.count("*").alias("quantidade"),
            F.sum(bruto).alias("valor_bruto"),
            F.sum("desconto_valor").alias("descontos"),
            F.count_if(c("status") == "CONCLUIDA").alias("concluidas"),
            F.count_if(c("status") == "PENDENTE").alias("pendentes"),
            F.count_if(c("status") == "CANCELADA").alias("canceladas"),
        )
        .withColumn("valor_liquido", c("valor_bruto") - c("descontos"))
    )


MEDIDAS_TURNO = (
    "quantidade", "valor_bruto", "descontos", "valor_liquido", "concluidas", "pendentes", "canceladas",
)


def day_closing(vendas: DataFrame) -> DataFrame:
    """Shift lines and one line per day. The day line adds up shift totals, so sales are read once."""
    return shift_totals(vendas).groupingSets([["data", "loja_id", "turno"], ["data"]], "data", "loja_id", "turno").agg(
        F.when(F.grouping("turno") == 1, "DIA").otherwise("TURNO").alias("nivel"),
        F.count("*").alias("arquivos"),
        *[F.sum(m).alias(m) for m in MEDIDAS_TURNO],
    )
