"""Loading rules of the star schema."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao import schemas
from balcao.functions.columns import calendar_columns
from balcao.operators.contract import integer
from balcao.operators.merge import merge_by_key
from balcao.operators.silver import keep_last
from balcao.params import PADRAO, Params

c = F.col

# Columns a repeated store, product or file row may change.
LOJA_ATUALIZAVEIS = ("loja_nome", "cidade", "meta_mensal", "updated_at")
LEDGER_ATUALIZAVEIS = ("checksum", "registros_lidos", "registros_validos", "pipeline_version", "updated_at")
PRODUTO_ATUALIZAVEIS = ("produto_nome", "categoria", "subcategoria", "preco_base", "custo_base")



def calendar_rows(datas: DataFrame) -> DataFrame:
    """Calendar dimension rows of distinct dates (column ``data``). Names are English, independent of the server."""
    base = calendar_columns(datas.select(c("data").cast("date").alias("data")).distinct(), "data")
    return base.select(
        "data_sk",
        "data",
        "ano",
        "semestre",
        "trimestre",
        "mes",
        F.date_format("data", "MMMM").alias("nome_mes"),
        "semana_ano",
        "dia",
        "dia_semana",
        F.date_format("data", "EEEE").alias("nome_dia_semana"),
        c("dia_semana").isin(6, 7).alias("e_fim_semana"),
    )


def calendar_range(spark: SparkSession, inicio: str = "2025-01-01", fim: str = "2027-12-31") -> DataFrame:
    dias = F.sequence(F.lit(inicio).cast("date"), F.lit(fim).cast("date"))
    return calendar_rows(spark.range(1).select(F.explode(dias).alias("data")))


def customers(silver: DataFrame) -> DataFrame:
    """Newest name and segment per customer: cancelled rows come after active ones, then file order."""
    ordem = [(c("status") == "CANCELADA").desc(), c("arquivo_origem").desc(), c("posicao").desc()]
    return keep_last(silver, ("cliente_id",), ordem).select(
        "cliente_id", "cliente_nome", c("cliente_segmento").alias("segmento")
    )


def fact_rows(
    silver: DataFrame, lojas: DataFrame, produtos: DataFrame, clientes: DataFrame, instante: datetime
) -> DataFrame:
    """Silver rows whose store, product and customer are known, in fact layout. Surrogate keys are hashes of the
    business keys, so a rerun gives the same ones."""
    conhecidos = (
        silver.join(F.broadcast(lojas.select("loja_id")), "loja_id", "left_semi")
        .join(produtos.select("produto_id"), "produto_id", "left_semi")
        .join(clientes.select("cliente_id"), "cliente_id", "left_semi")
    )
    linhas = conhecidos.withColumns(
        {
            "loja_sk": c("loja_id").cast("long"),
            "produto_sk": F.xxhash64("produto_id"),
            "cliente_sk": F.xxhash64("cliente_id"),
            "desconto_pct": c("desconto_pct_calc"),
            "processed_at": F.lit(instante).cast("timestamp"),
        }
    )
    return linhas.select(*[c(f.name).cast(f.dataType).alias(f.name) for f in schemas.FATO_VENDAS.fields])


def unknown_dimension_count(silver: DataFrame, linhas: DataFrame) -> DataFrame:
    """Rows dropped for a missing store, product or customer."""
    return silver.agg(F.count("*").alias("lidas")).crossJoin(F.broadcast(linhas.agg(F.count("*").alias("carregadas")))).select(
        (c("lidas") - c("carregadas")).alias("sem_dimensao")
    )


def merge_facts(fato: DataFrame, novos: DataFrame) -> DataFrame:
    """Repeated sales change only the correctable columns; date, quantity, unit cost and channel keep their first
    loaded value."""
    return merge_by_key(fato, novos, schemas.FATO_CHAVE, [*schemas.FATO_ATUALIZAVEIS, "processed_at"])


def found_counts(achadas: DataFrame) -> DataFrame:
    """Received, inserted and updated rows of a batch whose stored months were looked up."""
    return achadas.agg(
        F.count("*").alias("registros_recebidos"),
        F.count_if(c("ano_fato").isNull()).alias("registros_inseridos"),
        F.count_if(c("ano_fato").isNotNull()).alias("registros_atualizados"),
    )


def ledger_rows(envelopes: DataFrame, instante: datetime, params: Params = PADRAO) -> DataFrame:
    """One ledger row per accepted file, empty files included."""
    quando = F.lit(instante).cast("timestamp")
    registros = F.size("vendas").cast("long")
    return envelopes.select(
        F.xxhash64("arquivo_origem").alias("file_id"),
        c("arquivo_origem").alias("file_path"),
        F.trim("checksum").alias("checksum"),
        "data_referencia",
        integer(c("loja_id")).cast("int").alias("loja_id"),
        F.lit("SILVER").alias("camada_destino"),
        F.lit("PROCESSED").alias("status"),
        registros.alias("registros_lidos"),
        registros.alias("registros_validos"),
        F.lit(0).cast("long").alias("registros_invalidos"),
        F.lit(params.versao).alias("pipeline_version"),
        quando.alias("processed_at"),
        quando.alias("updated_at"),
    )


def merge_ledger(ledger: DataFrame, novos: DataFrame) -> DataFrame:
    """A file seen again stays PROCESSED while its checksum is unchanged and becomes REPROCESSED otherwise. The count
    of invalid rows and the first processing time are never changed."""
    return merge_by_key(ledger, novos, ["file_path"], LEDGER_ATUALIZAVEIS, {"status": ledger_status()})


def ledger_status() -> Column:
    return F.when(c("t.checksum") == c("s.checksum"), "PROCESSED").otherwise("REPROCESSED")


def file_row_counts(bronze: DataFrame) -> DataFrame:
    """Rows per file, checksum and store; missing values form their own group."""
    return bronze.groupBy("arquivo_origem", "arquivo_checksum", "loja_id").agg(F.count("*").alias("registros"))


# Budgets


def monthly_budget(config: DataFrame, anos: DataFrame, params: Params = PADRAO) -> DataFrame:
    """Configured budgets for every month of the given years (column ``ano``), grown per year from the base year."""
    fator = F.pow(F.lit(1 + params.crescimento_orcamento), c("ano") - c("ano_base"))
    receita = F.round((c("receita_mensal").cast("double") * fator).cast("decimal(18,6)"), 2).cast("decimal(15,2)")
    fixas = F.round((c("despesas_fixas_orcadas").cast("double") * fator).cast("decimal(18,6)"), 2).cast("decimal(15,2)")
    return (
        config.crossJoin(F.broadcast(anos.select("ano").distinct()))
        .withColumn("mes", F.explode(F.sequence(F.lit(1), F.lit(12))))
        .select(
            "loja_id",
            "ano",
            "mes",
            receita.alias("receita_orcada"),
            "margem_bruta_orcada",
            fixas.alias("despesas_fixas_orcadas"),
            F.round(receita * F.lit(params.taxa_despesa_variavel), 2).cast("decimal(15,2)").alias("despesas_var_orcadas"),
            F.round(receita * F.lit(params.resultado_orcado), 2).cast("decimal(15,2)").alias("resultado_orcado"),
        )
    )


def seed_budget(lojas: DataFrame, parametros: DataFrame, ano: int, params: Params = PADRAO) -> DataFrame:
    """Twelve budget months from the monthly target of each store; ``parametros`` gives margin and fixed cost."""
    meta = c("meta_mensal")
    return (
        lojas.join(F.broadcast(parametros), "loja_id")
        .withColumn("mes", F.explode(F.sequence(F.lit(1), F.lit(12))))
        .select(
            "loja_id",
            F.lit(ano).alias("ano"),
            "mes",
            meta.cast("decimal(15,2)").alias("receita_orcada"),
            "margem_bruta_orcada",
            "despesas_fixas_orcadas",
            F.round(meta * F.lit(params.taxa_despesa_variavel), 2).cast("decimal(15,2)").alias("despesas_var_orcadas"),
            F.round(meta * F.lit(params.resultado_orcado), 2).cast("decimal(15,2)").alias("resultado_orcado"),
        )
    )


# Audit


def audit_row(
    spark: SparkSession,
    tarefa: str,
    data_referencia: str,
    status: str,
    instante: datetime,
    run_id: str,
    params: Params = PADRAO,
    mensagem: str | None = None,
    duracao: float = 0.0,
    tentativa: int = 0,
    **metricas: int,
) -> DataFrame:
    """One append-only audit row; metrics that are not given count zero. ``tentativa`` tells runs of the same date apart."""
    nomes = ("lidos", "validos", "invalidos", "inseridos", "ignorados")
    return spark.range(1).select(
        F.xxhash64(F.lit(run_id), F.lit(tentativa), F.lit(tarefa), F.lit(data_referencia), F.lit(status)).alias("audit_id"),
        F.lit(params.fluxo).alias("dag_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(tarefa).alias("task_id"),
        F.lit(data_referencia).cast("date").alias("data_referencia"),
        F.lit(status).alias("status"),
        *[F.lit(metricas.get(n, 0)).cast("long").alias(f"registros_{n}") for n in nomes],
        F.lit(duracao).cast("decimal(10,2)").alias("duracao_segundos"),
        F.lit(mensagem or f"Tarefa {tarefa} finalizada com status {status}").alias("mensagem"),
        F.lit(instante).cast("timestamp").alias("created_at"),
    )
