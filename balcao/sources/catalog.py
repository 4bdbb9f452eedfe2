"""Stores, product catalogue and base budgets, read from the reference files of a folder."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.sources import raw

# Fixed value: monthly depreciation of every store.
DEPRECIACAO = Decimal("2500.00")


@dataclass(frozen=True)
class Catalog:
    """``pasta`` holds ``lojas.json``, ``produtos.json`` and ``orcamentos.json``; it is any path that Spark reads."""

    spark: SparkSession
    pasta: str

    def stores(self) -> DataFrame:
        return raw.read_stores(self.spark, f"{self.pasta}/lojas.json").withColumn("ativa", F.lit(True))

    def products(self) -> DataFrame:
        produtos = raw.read_products(self.spark, f"{self.pasta}/produtos.json")
        alvo = F.round((F.col("preco_base") - F.col("custo_base")) / F.col("preco_base") * 100, 2)
        return produtos.withColumn("margem_alvo_pct", alvo.cast("decimal(5,2)"))

    def _orcamentos(self) -> DataFrame:
        return raw.read_budgets(self.spark, f"{self.pasta}/orcamentos.json")

    def budgets(self) -> DataFrame:
        return self._orcamentos().drop("margem_semente")

    def base_year(self) -> int:
        return self._orcamentos().agg(F.max("ano_base")).first()[0]

    def seed_parameters(self) -> DataFrame:
        """Margin and fixed cost of the seeded budget; a store may state a margin of its own for it."""
        margem = F.coalesce("margem_semente", "margem_bruta_orcada").alias("margem_bruta_orcada")
        return self._orcamentos().select("loja_id", margem, "despesas_fixas_orcadas")

    def dre_parameters(self) -> DataFrame:
        """Fixed cost and depreciation per store of the managerial P&L."""
        depreciacao = F.lit(DEPRECIACAO).cast("decimal(15,2)").alias("depreciacao")
        return self.budgets().select("loja_id", F.col("despesas_fixas_orcadas").alias("despesas_fixas"), depreciacao)
