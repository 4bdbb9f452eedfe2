"""Business parameters. Every rate, threshold and clock value is passed in, never read from the machine."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal


@dataclass(frozen=True)
class Params:
    # Tax, expense and planning rates.
    taxa_imposto: Decimal = Decimal("0.12")
    taxa_despesa_variavel: Decimal = Decimal("0.06")
    taxa_financeira: Decimal = Decimal("0.02")
    crescimento_orcamento: float = 0.05
    resultado_orcado: Decimal = Decimal("0.22")

    # Traffic light limits as a share of the budget.
    meta_verde: float = 0.95
    meta_amarela: float = 0.80

    # Forecast limits.
    limite_tendencia: float = 0.15
    meses_tendencia: int = 3
    z_intervalo: float = 1.96

    # Alert limits, in percent.
    meta_critica: float = -20.0
    queda_media: float = -10.0
    queda_alta: float = -18.0
    margem_media: float = 25.0
    margem_alta: float = 20.0
    cancelamento_medio: float = 8.0
    cancelamento_alto: float = 12.0
    divergencia_forecast: float = 15.0
    arquivos_por_dia: int = 3

    versao: str = "1.0.0"
    fluxo: str = "vendas_diario"
    instante: datetime = datetime(2026, 1, 1, 6, 0, 0)
    #: Files of one shift; raise it where a shift has too many sales for one array.
    partes_por_turno: int = 1

    # Layout of the lake: blocks of a month's Bloom filter (4 KB each, only those in use are stored), buckets of customers.
    blocos_filtro: int = 65_536
    baldes_clientes: int = 256


PADRAO = Params()
