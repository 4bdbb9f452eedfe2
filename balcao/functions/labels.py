"""Text normalisation of business labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unaccented spelling and its corrected label, per column.
ROTULOS = {
    "cidade": {"Sao Paulo": "São Paulo"},
    "categoria": {
        "Informatica": "Informática",
        "Eletronicos": "Eletrônicos",
        "Eletrodomesticos": "Eletrodomésticos",
        "Moveis": "Móveis",
        "Acessorios": "Acessórios",
    },
    "subcategoria": {
        "Audio": "Áudio",
        "Escritorio": "Escritório",
        "Impressao": "Impressão",
        "Informatica": "Informática",
    },
    "produto_nome": {
        "Maquina de Lavar 11kg": "Máquina de Lavar 11kg",
        "Teclado Mecanico": "Teclado Mecânico",
    },
    "canal_venda": {"Loja Fisica": "Loja Física"},
}


def relabel(col: Column, mapa: dict[str, str]) -> Column:
    """Replace exact labels from a small map, keep the rest."""
    pares = [F.lit(x) for par in mapa.items() for x in par]
    return F.coalesce(F.element_at(F.create_map(*pares), col), col)


def normalize_labels(df: DataFrame, rotulos: dict[str, dict[str, str]] = ROTULOS) -> DataFrame:
    return df.withColumns({c: relabel(F.col(c), m) for c, m in rotulos.items() if c in df.columns})
