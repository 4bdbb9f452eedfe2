"""The star schema as the query plans see it: one method per table, columns on request."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.functions.columns import completed, distinct_days
from balcao.functions.lineage import write_intermediate


CHAVE = ("ano", "mes", "loja_id")

# Measure -> fact column and aggregate. ``(id_venda, loja_id)`` is unique in the fact table, so inside one store the
# distinct sale count is a row count and needs no second shuffle.
MEDIDAS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "faturamento": ("valor_liquido", F.sum),
    "receita_bruta": ("valor_bruto", F.sum),
    "descontos": ("desconto_valor", F.sum),
    "custo_total": ("custo_total", F.sum),
    "margem_bruta": ("margem_bruta", F.sum),
    "quantidade": ("quantidade", F.sum),
    "pedidos": ("status", F.count),
    "dias": ("dia", distinct_days),
}


class Warehouse:
    """Base class. Subclasses say where the tables come from."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._loja_mes: DataFrame | None = None

    def fato(self, *colunas: str) -> DataFrame:
        raise NotImplementedError

    def dim_loja(self) -> DataFrame:
        raise NotImplementedError

    def dim_produto(self) -> DataFrame:
        raise NotImplementedError

    def dim_cliente(self) -> DataFrame:
        raise NotImplementedError

    def orcamento(self) -> DataFrame:
        raise NotImplementedError

    def dre(self) -> DataFrame:
        raise NotImplementedError

    def arquivos(self) -> DataFrame:
        raise NotImplementedError

    def auditoria(self) -> DataFrame:
        raise NotImplementedError

    def months(self) -> list[tuple[int, int]]:
        """(year, month) of the facts, newest first."""
        meses = self.fato("ano", "mes").distinct().collect()
        return sorted(((r["ano"], r["mes"]) for r in meses), reverse=True)

    def lojas(self) -> DataFrame:
        """Store names for joins. The contract allows five store ids, so the broadcast is bounded."""
        return F.broadcast(self.dim_loja().select("loja_id", "loja_nome"))

    def loja_mes(self, *medidas: str) -> DataFrame:
        """Completed sales per store-month; all measures unless some are named. Only the fact columns behind the named
        measures are requested, so a revenue question never joins product costs."""
        pedidas = medidas or tuple(MEDIDAS)
        if self._loja_mes is not None and set(pedidas) <= set(self._loja_mes.columns):
            return self._loja_mes.where("pedidos > 0").select(*CHAVE, *pedidas)
        fato = self.fato(*CHAVE, "status", *sorted({MEDIDAS[m][0] for m in pedidas} - {"status"}))
        return (
            fato.where("status = 'CONCLUIDA'")
            .groupBy(*CHAVE)
            .agg(*[MEDIDAS[m][1](F.col(MEDIDAS[m][0])).alias(m) for m in pedidas])
        )

    def loja_mes_status(self, *medidas: str) -> DataFrame:
        """Every store-month whatever the status of its sales: status counts next to the measures of the completed
        ones (all unless some are named)."""
        if self._loja_mes is not None:
            return self._loja_mes
        pedidas = tuple(dict.fromkeys((*(medidas or MEDIDAS), "pedidos")))
        fato = self.fato(*CHAVE, "status", *sorted({MEDIDAS[m][0] for m in pedidas} - {"status"}))
        return fato.groupBy(*CHAVE).agg(
            *[MEDIDAS[m][1](completed(F.col(MEDIDAS[m][0]))).alias(m) for m in pedidas],
            F.count_if(F.col("status") == "CANCELADA").alias("canceladas"),
            F.count_if(F.col("status") == "PENDENTE").alias("pendentes"),
            F.count("*").alias("registros"),
        )

    def shared(self, *medidas: str) -> Warehouse:
        """Compute the store-month table once (stores x months rows) for plans that read it in several branches."""
        if self._loja_mes is None:
            self._loja_mes = write_intermediate(self.loja_mes_status(*medidas), "loja_mes")
        return self

    def with_ledger(self) -> Warehouse:
        """Hook for warehouses that derive the file ledger: compute it once for plans that read it repeatedly."""
        return self


class FrameWarehouse(Warehouse):
    """Tables given as DataFrames."""

    def __init__(self, spark: SparkSession, tabelas: Mapping[str, DataFrame]):
        super().__init__(spark)
        self.tabelas = dict(tabelas)

    def fato(self, *colunas: str) -> DataFrame:
        return self.tabelas["fato_vendas"].select(*colunas)

    def dim_loja(self) -> DataFrame:
        return self.tabelas["dim_loja"]

    def dim_produto(self) -> DataFrame:
        return self.tabelas["dim_produto"]

    def dim_cliente(self) -> DataFrame:
        return self.tabelas["dim_cliente"]

    def orcamento(self) -> DataFrame:
        return self.tabelas["fato_orcamento"]

    def dre(self) -> DataFrame:
        return self.tabelas["fato_dre"]

    def arquivos(self) -> DataFrame:
        return self.tabelas["processed_files"]

    def auditoria(self) -> DataFrame:
        return self.tabelas["pipeline_audit_log"]
