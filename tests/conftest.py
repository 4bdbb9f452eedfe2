"""Shared session and small inputs."""

from __future__ import annotations

import json
import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from balcao import schemas  # noqa: E402
from balcao.session import build_session  # noqa: E402
from balcao.sources.catalog import Catalog  # noqa: E402

INSTANTE = datetime(2026, 1, 9, 6, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    sessao = build_session(
        app="balcao-tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    sessao.sparkContext.setLogLevel("OFF")
    yield sessao
    sessao.stop()


def sale(**mudancas) -> dict:
    """One valid sale of the contract as parsed values."""
    base = {
        "id_venda": "PDV-L1-000451",
        "loja_id": 1,
        "loja_nome": "Casa do Porto",
        "cliente_id": 77,
        "cliente_nome": "Ana Prado",
        "cliente_segmento": "VAREJO",
        "produto_id": 901,
        "produto_nome": "Cafeteira de Prensa",
        "categoria": "Cozinha",
        "subcategoria": "Café",
        "quantidade": 1,
        "valor_unitario": "800.00",
        "custo_unitario": "500.00",
        "desconto_percentual": "5.00",
        "desconto_valor": "40.00",
        "canal_venda": "Loja Física",
        "forma_pagamento": "DEBITO",
        "parcelas": 1,
        "vendedor_id": "L1-V7",
        "data_venda": "2026-01-08T11:05:00",
        "status": "CONCLUIDA",
        "motivo_cancelamento": None,
    }
    return base | mudancas


TRES_VENDAS = (
    sale(),
    sale(
        id_venda="PDV-L1-000452", produto_id=902, produto_nome="Moedor Manual", valor_unitario="200.00",
        custo_unitario="90.00", desconto_valor="0.00", data_venda="2026-01-08T18:20:00",
    ),
    sale(id_venda="PDV-L1-000453", status="CANCELADA", motivo_cancelamento="Cliente desistiu"),
)


def reference_files(pasta) -> str:
    """Stores, products and budgets of the tests as the files a job reads."""
    nomes = ("Casa do Porto", "Casa da Serra", "Casa do Vale", "Casa do Lago", "Casa da Ilha")
    orcado = ((500000, 36, 40000), (300000, 37, 25000), (420000, 38, 31000), (610000, 39, 45000), (250000, 40, 20000))
    lojas = [
        {
            "loja_id": n, "loja_nome": nome, "cidade": nome.split()[-1], "estado": "SC", "regiao": "Sul",
            "data_abertura": f"20{10 + n}-02-01", "tier": "STANDARD", "meta_mensal": 250000 + 2000 * n, "area_m2": 100 * n,
            "capacidade_max": 50 * n,
        }
        for n, nome in enumerate(nomes, 1)
    ]
    produtos = [
        {
            "produto_id": 900 + n, "categoria": "Cozinha", "subcategoria": "Café", "produto_nome": nome, "marca": "Própria",
            "preco_base": preco, "custo_base": custo,
        }
        for n, (nome, preco, custo) in enumerate((("Cafeteira de Prensa", 800, 500), ("Moedor Manual", 200, 90)), 1)
    ]
    orcamentos = [
        {"loja_id": n, "receita_mensal": receita, "margem_bruta_orcada": margem, "despesas_fixas_orcadas": fixas}
        for n, (receita, margem, fixas) in enumerate(orcado, 1)
    ]
    orcamentos[4]["margem_semente"] = 41
    os.makedirs(pasta, exist_ok=True)
    documentos = {"lojas": lojas, "produtos": produtos, "orcamentos": {"ano": 2026, "orcamentos": orcamentos}}
    for nome, documento in documentos.items():
        with open(os.path.join(pasta, f"{nome}.json"), "w", encoding="utf-8") as saida:
            json.dump(documento, saida, ensure_ascii=False)
    return str(pasta)


@pytest.fixture(scope="session")
def referencias(tmp_path_factory):
    return reference_files(tmp_path_factory.mktemp("referencias"))


@pytest.fixture(scope="session")
def catalogo(spark, referencias):
    return Catalog(spark, referencias)


def bronze_frame(spark, vendas):
    """Bronze rows of the given sales, in file order of one file."""
    linhas = []
    for posicao, v in enumerate(vendas):
        valores = dict(v)
        for campo in schemas.CAMPOS_DECIMAIS:
            valores[campo] = Decimal(valores[campo])
        valores |= {
            "posicao": posicao,
            "cidade": "Itajaí",
            "estado": "SC",
            "turno_origem": "MANHA",
            "pipeline_id": "00000000-0000-4000-8000-00000000c0de",
            "arquivo_checksum": "a" * 64,
            "arquivo_origem": "raw/vendas_1.json",
            "timestamp_ingestao": INSTANTE,
            "pipeline_versao": "1.0.0",
        }
        linhas.append(tuple(valores[f.name] for f in schemas.BRONZE.fields))
    return spark.createDataFrame(linhas, schemas.BRONZE)


@pytest.fixture
def bronze(spark):
    return bronze_frame(spark, TRES_VENDAS)


def canonical_checksum(vendas) -> str:
    """Checksum of the contract written independently of the engine."""
    import hashlib

    texto = json.dumps(list(vendas), ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(texto.encode("utf-8")).hexdigest()


def envelope(vendas, **mudancas) -> dict:
    base = {
        "schema_version": "1.0",
        "origem": "sistema-pdv",
        "loja_id": 1,
        "loja_nome": "Casa do Porto",
        "cidade": "Itajaí",
        "estado": "sc",
        "turno": "MANHA",
        "data_geracao": "2026-01-08T12:00:00",
        "pipeline_id": "00000000-0000-4000-8000-00000000c0de",
        "quantidade_registros": len(vendas),
        "checksum": canonical_checksum(vendas),
        "vendas": list(vendas),
    }
    return base | mudancas


def land(raiz, documento, dia="2026-01-08", loja=1, nome=None) -> str:
    """Write a raw file where a terminal would put it."""
    ano, mes, d = dia.split("-")
    pasta = os.path.join(raiz, "raw", "vendas", f"loja=loja_{loja}", f"ano={ano}", f"mes={mes}", f"dia={d}")
    os.makedirs(pasta, exist_ok=True)
    turno = documento["turno"].lower() if isinstance(documento, dict) else "manha"
    caminho = os.path.join(pasta, nome or f"vendas_{loja}_{ano}{mes}{d}_{turno}.json")
    with open(caminho, "w", encoding="utf-8") as saida:
        saida.write(documento if isinstance(documento, str) else json.dumps(documento, ensure_ascii=False, indent=2))
    return caminho


def rows(df, *colunas):
    return [tuple(r[c] for c in colunas) for r in df.collect()]
