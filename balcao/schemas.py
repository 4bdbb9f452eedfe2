"""Data contract: field names, types, enumerations and rule names shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the contract.
LOJAS = (1, 2, 3, 4, 5)
STATUS = ("CONCLUIDA", "CANCELADA", "PENDENTE")
TURNOS = ("MANHA", "TARDE", "NOITE")
SEGMENTOS = ("VAREJO", "CORPORATIVO", "VIP")
VERSAO_CONTRATO = "1.0"
ORIGEM_CONTRATO = "sistema-pdv"

CAMPOS_VENDA = (
    "id_venda",
    "loja_id",
    "loja_nome",
    "cliente_id",
    "cliente_nome",
    "cliente_segmento",
    "produto_id",
    "produto_nome",
    "categoria",
    "subcategoria",
    "quantidade",
    "valor_unitario",
    "custo_unitario",
    "desconto_percentual",
    "desconto_valor",
    "canal_venda",
    "forma_pagamento",
    "parcelas",
    "vendedor_id",
    "data_venda",
    "status",
    "motivo_cancelamento",
)
CAMPOS_INTEIROS = ("loja_id", "cliente_id", "produto_id", "quantidade", "parcelas")
CAMPOS_DECIMAIS = ("valor_unitario", "custo_unitario", "desconto_percentual", "desconto_valor")

CAMPOS_ENVELOPE = (
    "schema_version",
    "origem",
    "loja_id",
    "loja_nome",
    "cidade",
    "estado",
    "turno",
    "data_geracao",
    "pipeline_id",
    "quantidade_registros",
    "checksum",
)

# Money may arrive as a JSON number or a JSON string, so raw scalars are all read as text.
VENDA_RAW = T.StructType([T.StructField(c, T.StringType()) for c in CAMPOS_VENDA])
ENVELOPE_RAW = T.StructType(
    [T.StructField(c, T.StringType()) for c in CAMPOS_ENVELOPE]
    + [T.StructField("vendas", T.ArrayType(VENDA_RAW))]
)

DINHEIRO = T.DecimalType(12, 2)
PERCENTUAL = T.DecimalType(5, 2)

LINHAGEM = (
    ("cidade", T.StringType()),
    ("estado", T.StringType()),
    ("turno_origem", T.StringType()),
    ("pipeline_id", T.StringType()),
    ("arquivo_checksum", T.StringType()),
    ("arquivo_origem", T.StringType()),
    ("timestamp_ingestao", T.TimestampType()),
    ("pipeline_versao", T.StringType()),
)


def _tipo_bronze(campo: str) -> T.DataType:
    if campo in ("loja_id", "quantidade", "parcelas"):
        return T.IntegerType()
    if campo in ("cliente_id", "produto_id"):
        return T.LongType()
    if campo in CAMPOS_DECIMAIS:
        return PERCENTUAL if campo == "desconto_percentual" else DINHEIRO
    return T.StringType()


BRONZE = T.StructType(
    [T.StructField(c, _tipo_bronze(c)) for c in CAMPOS_VENDA]
    + [T.StructField("posicao", T.IntegerType())]
    + [T.StructField(nome, tipo) for nome, tipo in LINHAGEM]
)

# Quality rules in evaluation order, with severity.
REGRAS_QUALIDADE = (
    ("id_venda_nao_nulo", "CRITICA"),
    ("loja_id_valido", "CRITICA"),
    ("quantidade_positiva", "CRITICA"),
    ("valor_unitario_positivo", "CRITICA"),
    ("data_venda_valida", "CRITICA"),
    ("status_permitido", "CRITICA"),
    ("desconto_nao_negativo", "ERRO"),
    ("desconto_razoavel", "AVISO"),
    ("produto_id_valido", "AVISO"),
    ("cliente_id_positivo", "AVISO"),
    ("custo_menor_que_preco", "AVISO"),
)
SEVERIDADES_BLOQUEANTES = ("CRITICA", "ERRO")

# Columns that a repeated load of the same sale may change.
FATO_CHAVE = ("id_venda", "loja_id")
FATO_ATUALIZAVEIS = (
    "produto_sk",
    "cliente_sk",
    "valor_unitario",
    "desconto_valor",
    "desconto_pct",
    "valor_bruto",
    "valor_liquido",
    "custo_total",
    "margem_bruta",
    "margem_bruta_pct",
    "status",
    "motivo_cancelamento",
    "arquivo_origem",
    "pipeline_id",
)

FATO_VENDAS = T.StructType(
    [
        T.StructField("id_venda", T.StringType()),
        T.StructField("loja_sk", T.LongType()),
        T.StructField("produto_sk", T.LongType()),
        T.StructField("cliente_sk", T.LongType()),
        T.StructField("data_sk", T.IntegerType()),
        T.StructField("loja_id", T.IntegerType()),
        T.StructField("produto_id", T.LongType()),
        T.StructField("cliente_id", T.LongType()),
        T.StructField("data_venda", T.TimestampNTZType()),
        T.StructField("canal_venda", T.StringType()),
        T.StructField("forma_pagamento", T.StringType()),
        T.StructField("parcelas", T.IntegerType()),
        T.StructField("vendedor_id", T.StringType()),
        T.StructField("quantidade", T.IntegerType()),
        T.StructField("valor_unitario", DINHEIRO),
        T.StructField("custo_unitario", DINHEIRO),
        T.StructField("desconto_valor", DINHEIRO),
        T.StructField("desconto_pct", PERCENTUAL),
        T.StructField("valor_bruto", DINHEIRO),
        T.StructField("valor_liquido", DINHEIRO),
        T.StructField("custo_total", DINHEIRO),
        T.StructField("margem_bruta", DINHEIRO),
        T.StructField("margem_bruta_pct", T.DecimalType(7, 2)),
        T.StructField("status", T.StringType()),
        T.StructField("motivo_cancelamento", T.StringType()),
        T.StructField("dia", T.IntegerType()),
        T.StructField("trimestre", T.IntegerType()),
        T.StructField("periodo", T.StringType()),
        T.StructField("arquivo_origem", T.StringType()),
        T.StructField("pipeline_id", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("ano", T.IntegerType()),
        T.StructField("mes", T.IntegerType()),
    ]
)

ARQUIVOS = T.StructType(
    [
        T.StructField("file_id", T.LongType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("checksum", T.StringType()),
        T.StructField("data_referencia", T.DateType()),
        T.StructField("loja_id", T.IntegerType()),
        T.StructField("camada_destino", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("registros_lidos", T.LongType()),
        T.StructField("registros_validos", T.LongType()),
        T.StructField("registros_invalidos", T.LongType()),
        T.StructField("pipeline_version", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

AUDITORIA = T.StructType(
    [
        T.StructField("audit_id", T.LongType()),
        T.StructField("dag_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("task_id", T.StringType()),
        T.StructField("data_referencia", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("registros_lidos", T.LongType()),
        T.StructField("registros_validos", T.LongType()),
        T.StructField("registros_invalidos", T.LongType()),
        T.StructField("registros_inseridos", T.LongType()),
        T.StructField("registros_ignorados", T.LongType()),
        T.StructField("duracao_segundos", T.DecimalType(10, 2)),
        T.StructField("mensagem", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

QUARENTENA_ARQUIVOS = T.StructType(
    [
        T.StructField("data_referencia", T.DateType()),
        T.StructField("arquivo_origem", T.StringType()),
        T.StructField("erro", T.StringType()),
    ]
)
