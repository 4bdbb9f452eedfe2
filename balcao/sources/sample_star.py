"""Adapter that reads the order tables of the sample data as store sales.

Regions act as stores, order lines as sales, ship dates as sale dates. Columns of customers, orders and parts are
joined only when a query asks for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from balcao.functions.columns import calendar_columns, money
from balcao.functions.labels import relabel
from balcao.functions.lineage import write_intermediate
from balcao.operators.silver import financial_columns, keep_last
from balcao.params import PADRAO, Params
from balcao.plans.marts import dre_lines
from balcao.schemas import DINHEIRO
from balcao.sources.warehouse import Warehouse

# Market segment of the sample data -> customer segment of the contract.
SEGMENTO = {
    "HOUSEHOLD": "VAREJO",
    "FURNITURE": "VAREJO",
    "BUILDING": "CORPORATIVO",
    "MACHINERY": "CORPORATIVO",
    "AUTOMOBILE": "VIP",
}
TAREFAS = ("extrair_bronze", "validar_qualidade", "transformar_silver", "carregar_datawarehouse")

# Repeated lines share this key; the last in this order stays.
LINHA_CHAVE = ("l_orderkey", "l_linenumber", "loja_id")
LINHA_ORDEM = (
    "l_shipdate", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus",
)

_DE_PEDIDO = {"status", "motivo_cancelamento", "cliente_id", "canal_venda", "cliente_nome", "cliente_segmento"}
_DE_CLIENTE = {"cliente_nome", "cliente_segmento"}
_DE_PRODUTO = {
    "produto_nome", "categoria", "subcategoria", "custo_unitario", "custo_total", "margem_bruta", "margem_bruta_pct",
}


def sale_time() -> Column:
    """Ship date plus an hour of day taken from the order key."""
    return F.expr("l_shipdate + make_dt_interval(0, int(l_orderkey % 24))")


def shift_of(ts: Column) -> Column:
    hora = F.hour(ts)
    return F.when(hora < 12, "MANHA").when(hora < 18, "TARDE").otherwise("NOITE")


class SampleStar(Warehouse):
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = PADRAO):
        super().__init__(spark)
        self.sf_dir = sf_dir
        self.params = params
        self._arquivos: DataFrame | None = None

    def table(self, nome: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{nome}.parquet")

    def lines(self) -> DataFrame:
        """Order lines with their store, repeated keys included. Region and nation are fixed lists (5 and 25 rows);
        the supplier side is left to Spark's size check. One spread by the order key serves the dedup of repeated lines
        and the join with the orders, at every input size."""
        regioes = F.broadcast(
            self.table("nation")
            .join(F.broadcast(self.table("region")), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", (F.col("r_regionkey") + 1).alias("loja_id"), F.col("r_name").alias("loja_nome"))
        )
        linhas = self.table("lineitem")
        # Suppliers join first and alone: the size estimate of a pre-joined side would make Spark broadcast the lines.
        com_loja = linhas.join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(
            regioes, F.col("s_nationkey") == F.col("n_nationkey")
        )
        return com_loja.repartition("l_orderkey")

    def unique_lines(self) -> DataFrame:
        return keep_last(self.lines(), LINHA_CHAVE, [F.col(o).desc() for o in LINHA_ORDEM])

    def sales(self, linhas: DataFrame, colunas: set[str]) -> DataFrame:
        """Contract columns of the given order lines. Joins come before the columns that are computed from them, and customers are
        joined to their orders, so that what is shuffled is as narrow, and as few rows, as it can be."""
        df = linhas
        if colunas & _DE_PEDIDO:
            pedidos = self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
            if colunas & _DE_CLIENTE:
                clientes = self.dim_cliente().withColumnsRenamed({"cliente_id": "_cliente", "segmento": "cliente_segmento"})
                pedidos = pedidos.join(clientes, F.col("o_custkey") == F.col("_cliente"), "left").drop("_cliente")
            df = df.join(pedidos, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        if colunas & _DE_PRODUTO:
            produtos = self.dim_produto().withColumnsRenamed({"produto_id": "_produto", "custo_base": "custo_unitario"})
            df = df.join(produtos, F.col("l_partkey") == F.col("_produto"), "left").drop("_produto")
        df = df.withColumn("data_venda", sale_time()).withColumns(
            {
                "id_venda": F.concat_ws("-", F.lit("VND"), "l_orderkey", "l_linenumber"),
                "produto_id": F.col("l_partkey"),
                "quantidade": F.col("l_quantity").cast("int"),
                "valor_unitario": (F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")) / 100).cast(DINHEIRO),
                "desconto_percentual": (F.col("l_discount") * 100).cast("decimal(5,2)"),
                "forma_pagamento": F.when(F.col("l_linestatus") == "F", "CARTAO").otherwise("PIX"),
                "parcelas": F.col("l_linenumber"),
                "vendedor_id": F.concat_ws("-", F.lit("VND"), "l_suppkey"),
                "cidade": F.col("loja_nome"),
                "estado": F.left(F.col("loja_nome"), F.lit(2)),
                "turno_origem": shift_of(F.col("data_venda")),
            }
        )
        df = df.withColumn(
            "desconto_valor",
            F.round(
                (F.col("quantidade") * F.col("valor_unitario")).cast(DINHEIRO)
                * F.col("l_discount").cast("decimal(4,2)"),
                2,
            ).cast(DINHEIRO),
        )
        if colunas & _DE_PEDIDO:
            df = df.withColumns(
                {
                    "cliente_id": F.col("o_custkey"),
                    "canal_venda": F.col("o_orderpriority"),
                    "status": F.expr(
                        "CASE WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN 'CANCELADA' "
                        "WHEN o_orderstatus = 'P' AND l_linenumber = 3 THEN 'PENDENTE' ELSE 'CONCLUIDA' END"
                    ),
                }
            )
            df = df.withColumn("motivo_cancelamento", F.when(F.col("status") == "CANCELADA", "Devolução"))
        return df

    def fato(self, *colunas: str) -> DataFrame:
        pedidas = set(colunas)
        df = calendar_columns(financial_columns(self.sales(self.unique_lines(), pedidas)))
        return df.select(*colunas)

    def bronze(self, *colunas: str) -> DataFrame:
        """Every order line as a sale with lineage, repeated keys kept; all 22 fields unless columns are named."""
        df = self.sales(self.lines(), set(colunas) or _DE_PEDIDO | _DE_PRODUTO)
        return df.withColumns(
            {
                "arquivo_origem": self._caminho(),
                "posicao": F.col("l_suppkey").cast("int"),
                "data": F.to_date("data_venda"),
                "pipeline_id": F.lit("00000000-0000-0000-0000-000000000000"),
            }
        )

    @staticmethod
    def _caminho() -> Column:
        return F.concat(
            F.lit("raw/vendas/loja=loja_"), F.col("loja_id").cast("string"),
            F.date_format("data_venda", "'/ano='yyyy'/mes='MM'/dia='dd'/vendas_'"),
            F.col("loja_id").cast("string"), F.date_format("data_venda", "'_'yyyyMMdd'_'"),
            F.lower(shift_of(F.col("data_venda"))), F.lit(".json"),
        )

    def dim_loja(self) -> DataFrame:
        return self.table("region").select(
            (F.col("r_regionkey") + 1).alias("loja_id"),
            F.col("r_name").alias("loja_nome"),
            F.col("r_name").alias("cidade"),
            F.left(F.col("r_name"), F.lit(2)).alias("estado"),
            F.col("r_name").alias("regiao"),
            F.make_date(F.col("r_regionkey") + 1991, F.lit(3), F.lit(1)).alias("data_abertura"),
            F.when(F.col("r_regionkey").isin(0, 3), "PREMIUM").otherwise("STANDARD").alias("tier"),
            F.lit(True).alias("ativa"),
        )

    def dim_produto(self) -> DataFrame:
        custo = F.round(F.col("p_retailprice").cast(DINHEIRO) * F.lit("1.6").cast("decimal(2,1)"), 2).cast(DINHEIRO)
        return self.table("part").select(
            F.col("p_partkey").alias("produto_id"),
            F.col("p_name").alias("produto_nome"),
            F.col("p_type").alias("categoria"),
            F.col("p_brand").alias("subcategoria"),
            custo.alias("custo_base"),
        )

    def dim_cliente(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("cliente_id"),
            F.col("c_name").alias("cliente_nome"),
            relabel(F.col("c_mktsegment"), SEGMENTO).alias("segmento"),
        )

    def orcamento(self) -> DataFrame:
        """Twelve budget months per store-year: the year's mean month times a store factor."""
        p = self.params
        media = F.sum("faturamento").cast("double") / F.count("*")
        fator = (F.lit(80) + F.col("loja_id") * 10) / F.lit(100.0)
        receita = money(media * fator)
        return (
            self.loja_mes("faturamento")
            .groupBy("loja_id", "ano")
            .agg(receita.alias("receita_orcada"))
            .withColumn("mes", F.explode(F.sequence(F.lit(1), F.lit(12))))
            .withColumns(
                {
                    "margem_bruta_orcada": F.lit("39.00").cast("decimal(5,2)"),
                    "despesas_fixas_orcadas": F.round(F.col("receita_orcada") * F.lit("0.05").cast("decimal(2,2)"), 2),
                    "despesas_var_orcadas": F.round(F.col("receita_orcada") * F.lit(p.taxa_despesa_variavel), 2),
                    "resultado_orcado": F.round(F.col("receita_orcada") * F.lit(p.resultado_orcado), 2),
                }
            )
        )

    def dre_params(self) -> DataFrame:
        """Fixed cost (5 % of the store's mean month) and depreciation per store."""
        return (
            self.loja_mes("faturamento")
            .groupBy("loja_id")
            .agg(
                money(F.sum("faturamento").cast("double") / F.count("*") * 0.05).alias("despesas_fixas")
            )
            .withColumn("depreciacao", F.lit("2500.00").cast("decimal(15,2)"))
        )

    def dre(self) -> DataFrame:
        totais = self.loja_mes("receita_bruta", "descontos", "custo_total").select(
            "loja_id", "ano", "mes", "receita_bruta", "descontos", F.col("custo_total").alias("cmv")
        )
        return dre_lines(totais, self.dre_params(), self.params)

    def with_ledger(self) -> SampleStar:
        if self._arquivos is None:
            self._arquivos = write_intermediate(self.arquivos(), "arquivos")
        return self

    def arquivos(self) -> DataFrame:
        """One file per store, date and shift, from one scan. Repeated sales count as invalid records of their file."""
        if self._arquivos is not None:
            return self._arquivos
        versao = F.row_number().over(Window.partitionBy(*LINHA_CHAVE).orderBy(*[F.col(o).desc() for o in LINHA_ORDEM]))
        valida = F.col("versao") == 1
        df = (
            self.sales(self.lines(), {"status"})
            .withColumn("versao", versao)
            .groupBy("loja_id", F.to_date("data_venda").alias("data_referencia"), shift_of(F.col("data_venda")).alias("turno"))
            .agg(
                F.count("*").alias("registros_lidos"),
                F.count_if(valida).alias("registros_validos"),
                F.count_if(valida & (F.col("status") == "CANCELADA")).alias("canceladas"),
            )
        )
        ordem_turno = F.array_position(F.array(*[F.lit(t) for t in ("MANHA", "TARDE", "NOITE")]), F.col("turno"))
        data_ts = F.col("data_referencia").cast("timestamp_ntz")
        df = df.withColumns(
            {
                "data_venda": data_ts + F.expr("make_dt_interval(0, CASE turno WHEN 'MANHA' THEN 0 "
                                               "WHEN 'TARDE' THEN 12 ELSE 18 END)"),
                "registros_invalidos": F.col("registros_lidos") - F.col("registros_validos"),
            }
        )
        df = df.withColumns(
            {
                "file_id": F.date_format("data_referencia", "yyyyMMdd").cast("long") * 100
                + F.col("loja_id") * 10
                + ordem_turno,
                "file_path": self._caminho(),
                "camada_destino": F.lit("SILVER"),
                "status": F.expr(
                    "CASE WHEN registros_validos = 0 THEN 'QUARANTINED' "
                    "WHEN registros_validos >= 2 AND canceladas = registros_validos THEN 'FAILED' "
                    "WHEN registros_invalidos > 0 THEN 'REPROCESSED' ELSE 'PROCESSED' END"
                ),
                "pipeline_version": F.lit(self.params.versao),
                "processed_at": data_ts + F.expr("make_dt_interval(0, 20)"),
                "updated_at": data_ts + F.expr("make_dt_interval(0, 20, int(registros_lidos))"),
            }
        )
        df = df.withColumn(
            "checksum", F.sha2(F.concat_ws("|", "file_path", "registros_lidos", "registros_validos"), 256)
        )
        return df.select(
            "file_id", "file_path", "checksum", "data_referencia", "loja_id", "camada_destino", "status",
            "registros_lidos", "registros_validos", "registros_invalidos", "pipeline_version",
            "processed_at", "updated_at",
        )

    def auditoria(self) -> DataFrame:
        """Four task rows per date, summed from the file ledger; a failed file fails the load task."""
        dias = self.arquivos().groupBy("data_referencia").agg(
            F.sum("registros_lidos").alias("lidos"),
            F.sum("registros_validos").alias("validos"),
            F.sum("registros_invalidos").alias("invalidos"),
            F.count_if(F.col("status") == "FAILED").alias("falhas"),
        )
        tarefas = F.array(*[F.lit(t) for t in TAREFAS])
        df = dias.select("*", F.posexplode(tarefas).alias("i", "task_id")).withColumn("ordem", F.col("i") + 1)
        carga = F.col("task_id") == "carregar_datawarehouse"
        zero = F.lit(0).cast("long")
        status = F.when(carga & (F.col("falhas") > 0), "FAILED").otherwise("SUCCESS")
        dia_txt = F.date_format("data_referencia", "yyyyMMdd")
        return df.select(
            (dia_txt.cast("long") * 10 + F.col("ordem")).alias("audit_id"),
            F.lit(self.params.fluxo).alias("dag_id"),
            F.concat_ws("_", F.lit("diario"), dia_txt).alias("run_id"),
            "task_id",
            "data_referencia",
            status.alias("status"),
            F.col("lidos").alias("registros_lidos"),
            F.col("validos").alias("registros_validos"),
            F.when(F.col("task_id") == "validar_qualidade", F.col("invalidos"))
            .otherwise(zero)
            .alias("registros_invalidos"),
            F.when(carga, F.col("validos")).otherwise(zero).alias("registros_inseridos"),
            F.when(carga, F.col("invalidos")).otherwise(zero).alias("registros_ignorados"),
            (F.col("lidos") * F.col("ordem") * F.lit("0.25").cast("decimal(3,2)"))
            .cast("decimal(10,2)")
            .alias("duracao_segundos"),
            F.concat(F.lit("Tarefa "), "task_id", F.lit(" finalizada com status "), status).alias("mensagem"),
            (F.col("data_referencia").cast("timestamp_ntz") + F.expr("make_dt_interval(1, 6, int(ordem * 10))")).alias(
                "created_at"
            ),
        )
