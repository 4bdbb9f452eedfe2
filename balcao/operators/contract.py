"""Input contract of an envelope and of the sales inside it.

An envelope is judged as a whole: one bad sale rejects its file and no other file. All checks are expressions on the
envelope row, so no sale is moved before its file is accepted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from balcao import schemas
from balcao.functions.columns import text
from balcao.params import PADRAO, Params

c = F.col

# Text minimum lengths of the contract.
TAMANHO_MINIMO = {
    "id_venda": 5,
    "loja_nome": 3,
    "cliente_nome": 3,
    "produto_nome": 2,
    "categoria": 2,
    "subcategoria": 2,
    "canal_venda": 2,
    "forma_pagamento": 2,
    "vendedor_id": 3,
}
ID_VENDA_MAXIMO = 50
DESCONTO_MAXIMO_PCT = 25
PARCELAS_MAXIMO = 24
INTEIRO_MAXIMO = 2**31 - 1
# Fields that must be JSON strings. Numbers may be written as numbers or as text.
CAMPOS_TEXTO_VENDA = (*TAMANHO_MINIMO, "cliente_segmento", "status", "motivo_cancelamento", "data_venda")
CAMPOS_TEXTO_ENVELOPE = (
    "schema_version", "origem", "loja_nome", "cidade", "estado", "turno", "data_geracao", "pipeline_id", "checksum",
)
#: Column with the schema of the document's own values, where the source gives it.
TIPOS = "tipos"
UUID = r"^[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}$"
CHECKSUM_TAMANHO = 64


def integer(valor: Column) -> Column:
    """Whole number written as a number or as text (``3`` or ``3.0``), NULL for anything else."""
    return clean_integer(text(valor))


def clean_integer(texto: Column) -> Column:
    """The same of a text that has been trimmed."""
    numero = clean_decimal(texto)
    return F.coalesce(texto.try_cast("bigint"), F.when(numero == F.floor(numero), numero.try_cast("bigint")))


def clean_decimal(texto: Column) -> Column:
    return texto.try_cast("decimal(28,6)")


def clean_timestamp(texto: Column) -> Column:
    return texto.try_cast("timestamp_ntz")


def timestamp(valor: Column) -> Column:
    return clean_timestamp(text(valor))


def bound(valores: dict[str, Column]) -> Column:
    """The given values as an array of one struct, for a lambda to read. Functions of an array are not compiled, so an expression that
    is written twice in them is also evaluated twice; what a lambda is given is evaluated once."""
    return F.array(F.struct(*[v.alias(nome) for nome, v in valores.items()]))


def trimmed(v: Column) -> Column:
    """A sale with all its fields trimmed."""
    return F.struct(*[text(v.getField(campo)).alias(campo) for campo in schemas.CAMPOS_VENDA])


def iso_timestamp(bruto: Column) -> Column:
    """Trimmed date and time as the checksum spells them: seconds always, microseconds unless zero, the offset as given, ``Z`` for zero."""
    lido = clean_timestamp(bruto)
    segundos = F.date_format(lido, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(lido, "SSSSSS")
    zona = F.regexp_extract(bruto, r"\d:\d{2}[\d.:]*([+-]\d{2}:?\d{2}|[Zz])$", 1)
    zona = F.regexp_replace(F.regexp_replace(zona, r"^([+-]\d{2})(\d{2})$", "$1:$2"), r"^([+-]00:00|z)$", "Z")
    fracao = F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise("")
    # Most are written that way already.
    return F.when(bruto == segundos, bruto).otherwise(F.concat(segundos, fracao, zona))


def among(valor: Column, opcoes: Sequence[str | int]) -> Column:
    """Membership in a short list as plain comparisons: ``isin`` is slow inside the functions of an array, which are not compiled."""
    return reduce(or_, [valor == F.lit(o) for o in opcoes])


def holds(condicao: Column) -> Column:
    """A check on a missing value fails."""
    return F.coalesce(condicao, F.lit(False))


def failures(regras: dict[str, Column]) -> Column:
    """Names of the failed checks, in declaration order."""
    return F.array_compact(F.array(*[F.when(~holds(ok), F.lit(nome)) for nome, ok in regras.items()]))


def fits(valor: Column, tipo: T.DecimalType = schemas.DINHEIRO) -> Column:
    """Whether an amount can be stored; beyond the type, its file is refused and no other."""
    return F.abs(valor) < F.lit(10 ** (tipo.precision - tipo.scale)).cast("decimal(28,6)")


def misspelled(campos: Sequence[str], esquema: Column) -> Column:
    """Names of the text fields that ``esquema`` shows with another kind of value. Sales of one file are merged in it, so a single
    number among texts shows too; a field that is only null, or missing, is left to the other rules."""
    outro = lambda campo: esquema.rlike(rf"[<, ]`?{campo}`?: (?!STRING\b|VOID\b)")
    nomes = F.array_compact(F.array(*[F.when(holds(outro(campo)), F.lit(campo)) for campo in campos]))
    return F.when(holds(outro(f"(?:{'|'.join(campos)})")), nomes).otherwise(F.array().cast("array<string>"))


def _schemas() -> tuple[Column, Column]:
    """Schema of the sales and of the envelope without them."""
    da_venda = r"vendas: ARRAY<OBJECT<([^<>]*)>>"
    return F.concat(F.lit("<"), F.regexp_extract(TIPOS, da_venda, 1)), F.regexp_replace(TIPOS, da_venda, "")


def read_values(v: Column) -> dict[str, Column]:
    """What the rules read of a trimmed sale: its texts, and its numbers and date as values."""
    g = v.getField
    lidos = {campo: g(campo) for campo in (*TAMANHO_MINIMO, "cliente_segmento", "status", "motivo_cancelamento")}
    lidos |= {campo: clean_integer(g(campo)) for campo in schemas.CAMPOS_INTEIROS}
    lidos |= {campo: clean_decimal(g(campo)) for campo in schemas.CAMPOS_DECIMAIS}
    return lidos | {"data_venda": clean_timestamp(g("data_venda"))}


def products(lidos: Column) -> dict[str, Column]:
    """The values of a sale next to its gross and cost totals."""
    g = lidos.getField
    vezes = lambda campo: F.try_multiply(g(campo), g("quantidade").cast("decimal(20,0)")).try_cast("decimal(28,6)")
    return {"v": lidos, "bruto": vezes("valor_unitario"), "custo": vezes("custo_unitario")}


def sale_is_right(v: Column) -> Column:
    """Whether a trimmed sale satisfies all rules. The first one that fails decides."""
    certas = lambda p: reduce(and_, [holds(ok) for ok in sale_rules(p).values()])
    return F.forall(bound(read_values(v)), lambda lidos: F.forall(bound(products(lidos)), certas))


def sale_failures(v: Column) -> Column:
    """Names of the rules that a trimmed sale breaks."""
    nomes = lambda lidos: F.flatten(F.transform(bound(products(lidos)), lambda p: failures(sale_rules(p))))
    return F.flatten(F.transform(bound(read_values(v)), nomes))


def sale_rules(p: Column) -> dict[str, Column]:
    """Checks of one sale, read by ``read_values`` and ``products``. Field checks carry the field name, checks across fields a name of
    their own."""
    g = p.getField("v").getField
    regras = {campo: F.length(g(campo)) >= minimo for campo, minimo in TAMANHO_MINIMO.items()}
    regras["id_venda"] = regras["id_venda"] & (F.length(g("id_venda")) <= ID_VENDA_MAXIMO)
    status, motivo = g("status"), F.coalesce(g("motivo_cancelamento"), F.lit(""))
    bruto, custo = p.getField("bruto"), p.getField("custo")
    # A product is missing only where one of its factors fails its own rule.
    cabe = lambda campo, total: fits(g(campo)) & fits(F.coalesce(total, F.lit(0).cast("decimal(28,6)")))
    teto = bruto * F.lit("0.25").cast("decimal(3,2)") + F.lit("0.01").cast("decimal(3,2)")
    regras |= {
        "loja_id": among(g("loja_id"), schemas.LOJAS),
        "cliente_id": g("cliente_id") > 0,
        "cliente_segmento": among(g("cliente_segmento"), schemas.SEGMENTOS),
        "produto_id": g("produto_id") > 0,
        "quantidade": g("quantidade").between(1, INTEIRO_MAXIMO),
        "valor_unitario": (g("valor_unitario") > 0) & cabe("valor_unitario", bruto),
        "custo_unitario": (g("custo_unitario") > 0) & cabe("custo_unitario", custo),
        "desconto_percentual": g("desconto_percentual").between(0, DESCONTO_MAXIMO_PCT),
        "desconto_valor": g("desconto_valor") >= 0,
        "parcelas": g("parcelas").between(1, PARCELAS_MAXIMO),
        "data_venda": g("data_venda").isNotNull(),
        "status": among(status, schemas.STATUS),
        "desconto_acima_do_limite": g("desconto_valor") <= teto,
        "cancelada_sem_motivo": (status != "CANCELADA") | (motivo != ""),
        "motivo_sem_cancelamento": (status == "CANCELADA") | (motivo == ""),
    }
    return regras


def envelope_rules() -> dict[str, Column]:
    return {
        "schema_version": text(c("schema_version")) == schemas.VERSAO_CONTRATO,
        "origem": text(c("origem")) == schemas.ORIGEM_CONTRATO,
        "loja_id": integer(c("loja_id")).isin(*schemas.LOJAS),
        "loja_nome": F.length(text(c("loja_nome"))) >= 3,
        "cidade": F.length(text(c("cidade"))) >= 2,
        "estado": F.length(text(c("estado"))) == 2,
        "turno": text(c("turno")).isin(*schemas.TURNOS),
        "data_geracao": timestamp(c("data_geracao")).isNotNull(),
        "pipeline_id": text(c("pipeline_id")).rlike(UUID),
        "quantidade_registros": integer(c("quantidade_registros")) >= 0,
        "checksum": F.length(text(c("checksum"))) == CHECKSUM_TAMANHO,
        "vendas": c("vendas").isNotNull(),
    }


def integrity_rules(vendas: Column) -> dict[str, Column]:
    """Checks across the fields of an envelope and its trimmed sales."""
    loja = integer(c("loja_id"))
    return {
        "contagem_divergente": integer(c("quantidade_registros")) == F.size(vendas),
        "venda_de_outra_loja": ~F.exists(vendas, lambda v: clean_integer(v.getField("loja_id")) != loja),
        "checksum_invalido": clean_checksum(vendas) == text(c("checksum")),
    }


def _plain_number(valor: Column) -> Column:
    """Text of a money value as the contract spells it: large JSON numbers without an exponent."""
    longo = F.regexp_replace(valor.try_cast("double").cast("decimal(30,6)").cast("string"), "0+$", "")
    longo = F.when(longo.endswith("."), F.concat(longo, F.lit("0"))).otherwise(longo)
    return F.when(valor.contains("E"), longo).otherwise(valor)


def canonical_sale(v: Column) -> Column:
    """One trimmed sale with its fields in alphabetical order, integers as numbers, money and dates as text."""

    def campo(nome: str) -> Column:
        bruto = v.getField(nome)
        if nome in schemas.CAMPOS_INTEIROS:
            return clean_integer(bruto)
        if nome in schemas.CAMPOS_DECIMAIS:
            return _plain_number(bruto)
        return iso_timestamp(bruto) if nome == "data_venda" else bruto

    return F.struct(*[campo(nome).alias(nome) for nome in sorted(schemas.CAMPOS_VENDA)])


def checksum(vendas: Column) -> Column:
    """SHA-256 of the compact, key-sorted JSON of the sales."""
    return clean_checksum(F.transform(vendas, trimmed))


def clean_checksum(vendas: Column) -> Column:
    """The same of trimmed sales."""
    return F.sha2(F.to_json(F.transform(vendas, canonical_sale), {"ignoreNullFields": "false"}), 256)


def check(envelopes: DataFrame) -> DataFrame:
    """Adds ``erros``: names of every failed check. Integrity is judged only when the fields are right. The sales come out trimmed.

    A file is one row, so every operator that adds a column to it holds one more copy of the whole file: trimmed sales and verdict come
    from one generator.
    """
    outras = [col for col in envelopes.columns if col not in ("vendas", TIPOS)]
    julgada = lambda vendas: F.struct(vendas.alias("vendas"), _verdict(vendas, TIPOS in envelopes.columns).alias("erros"))
    return envelopes.select(*outras, F.inline(F.transform(F.array(F.transform("vendas", trimmed)), julgada)))


def _verdict(vendas: Column, com_tipos: bool) -> Column:
    """Failed checks of an envelope with the given trimmed sales."""
    nomes = F.array_distinct(F.flatten(F.transform(vendas, sale_failures)))
    nenhum = F.array().cast("array<string>")
    # Most files are right: one pass of short-circuit checks decides, the names are built for the others.
    das_vendas = F.when(F.coalesce(F.forall(vendas, sale_is_right), F.lit(True)), nenhum).otherwise(
        F.transform(nomes, lambda n: F.concat(F.lit("venda."), n))
    )
    do_envelope = failures(envelope_rules())
    if com_tipos:
        tipos_vendas, tipos_envelope = _schemas()
        do_envelope = F.array_union(do_envelope, misspelled(CAMPOS_TEXTO_ENVELOPE, tipos_envelope))
        tipos = F.transform(misspelled(CAMPOS_TEXTO_VENDA, tipos_vendas), lambda n: F.concat(F.lit("venda."), n))
        das_vendas = F.array_union(das_vendas, tipos)
    campos = F.when(c("ilegivel"), F.array(F.lit("json_ilegivel"))).otherwise(F.concat(do_envelope, das_vendas))
    integra = lambda falhas: F.when(F.size(falhas) > 0, falhas).otherwise(failures(integrity_rules(vendas)))
    return F.flatten(F.transform(F.array(campos), integra))


def accepted(checados: DataFrame) -> DataFrame:
    return checados.where(F.size("erros") == 0)


def rejected(checados: DataFrame) -> DataFrame:
    """Quarantine rows: one per refused file."""
    return checados.where(F.size("erros") > 0).select(
        "data_referencia", "arquivo_origem", F.array_join("erros", "; ").alias("erro")
    )


def _typed(campo: str) -> Column:
    """A field of an accepted sale in its Bronze type, read as the contract read it."""
    valor = c(f"v.{campo}")
    if campo in schemas.CAMPOS_INTEIROS:
        valor = clean_integer(valor)
    elif campo in schemas.CAMPOS_DECIMAIS:
        valor = clean_decimal(valor)
    elif campo == "data_venda":
        valor = clean_timestamp(valor)
    return valor.cast(schemas.BRONZE[campo].dataType).alias(campo)


def flatten(aceitos: DataFrame, instante: datetime, params: Params = PADRAO) -> DataFrame:
    """One typed Bronze row per sale, with its position in the file and the lineage of the envelope."""
    vendas = aceitos.select(
        "data_referencia",
        text(c("cidade")).alias("cidade"),
        F.upper(text(c("estado"))).alias("estado"),
        text(c("turno")).alias("turno_origem"),
        F.lower(text(c("pipeline_id"))).alias("pipeline_id"),
        text(c("checksum")).alias("arquivo_checksum"),
        "arquivo_origem",
        F.posexplode("vendas").alias("posicao", "v"),
    )
    return vendas.select(
        *[_typed(campo) for campo in schemas.CAMPOS_VENDA],
        "posicao",
        "cidade",
        "estado",
        "turno_origem",
        "pipeline_id",
        "arquivo_checksum",
        "arquivo_origem",
        F.lit(instante).cast("timestamp").alias("timestamp_ingestao"),
        F.lit(params.versao).alias("pipeline_versao"),
        "data_referencia",
    )


def counts_by_store(bronze: DataFrame, lojas: DataFrame) -> DataFrame:
    """Extracted rows per requested store, zero included."""
    return (
        lojas.join(bronze.groupBy("loja_id").agg(F.count("*").alias("registros")), "loja_id", "left")
        .na.fill(0, ["registros"])
        .orderBy("loja_id")
    )
