"""Whole jobs over the sample: its sales packed as terminal files, run through a lake of their own in the shared folder."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.functions.lineage import LINHAS_GRANDES, shared_folder, write_intermediate
from balcao.operators import key_index
from balcao.params import PADRAO
from balcao.plans import shares
from balcao.plans.jobs import Job
from balcao.sources import export
from balcao.sources.lake import Lake
from balcao.sources.sample_star import SampleStar

c = F.col


@dataclass(frozen=True)
class SampleCatalog:
    """Regions and parts of the sample as the reference data of a job."""

    wh: SampleStar

    def stores(self) -> DataFrame:
        return self.wh.dim_loja()

    def products(self) -> DataFrame:
        return self.wh.dim_produto()

    def budgets(self) -> DataFrame:
        return self.wh.table("region").selectExpr(
            "1998 AS ano_base", "CAST(r_regionkey + 1 AS int) AS loja_id",
            "CAST(300000 + 75000 * r_regionkey AS decimal(15,2)) AS receita_mensal",
            "CAST(36 + 0.5 * r_regionkey AS decimal(5,2)) AS margem_bruta_orcada",
            "CAST(24000 + 6000 * r_regionkey AS decimal(15,2)) AS despesas_fixas_orcadas",
        )

    def dre_parameters(self) -> DataFrame:
        return self.budgets().select(
            "loja_id", c("despesas_fixas_orcadas").alias("despesas_fixas"), F.lit("2500.00").cast("decimal(15,2)").alias("depreciacao")
        )


def sample_job(wh: SampleStar) -> Job:
    """A job on a new lake with the dimensions of the sample."""
    job = Job(Lake(wh.spark, f"{shared_folder(wh.spark)}/balcao/lake-{uuid.uuid4().hex}"), SampleCatalog(wh))
    with job.lake.transaction():
        job.lake.replace_table(wh.dim_loja(), "warehouse/dim_loja")
        job.lake.replace_table(wh.dim_produto(), "warehouse/dim_produto")
    return job


def monthly_files(wh: SampleStar) -> DataFrame:
    """One raw file for each store, month and shift: all sales of the sample, repeated ones included."""
    vendas = wh.bronze().withColumn("data", F.trunc("data_venda", "month"))
    return write_intermediate(export.as_raw_text(export.package(vendas, PADRAO.instante)), "arquivos-raw", LINHAS_GRANDES)


def dates_of(df: DataFrame) -> list:
    return sorted(r[0] for r in df.select("data_referencia").distinct().collect())


CONTAGENS = (
    "arquivos_raw", "arquivos_rejeitados", "registros_extraidos", "registros_validos", "registros_invalidos", "duplicatas_removidas",
    "registros_recebidos", "registros_inseridos", "registros_atualizados", "sem_dimensao",
)


def backfill_twice(wh: SampleStar) -> DataFrame:
    """Summaries of a backfill of all files and of its repetition, which inserts nothing."""
    job, textos = sample_job(wh), monthly_files(wh)
    dias = dates_of(textos)
    resumos = [job.run_texts(textos, dias).select(F.lit(n).alias("execucao"), *CONTAGENS) for n in (1, 2)]
    return reduce(DataFrame.unionByName, resumos)


#: Last year of the first of two loads.
PRIMEIRA_CARGA = 1995


def two_loads(wh: SampleStar) -> Job:
    """All files by two runs, the older ones first: the second finds the facts of the first through the key filters."""
    job, textos = sample_job(wh), monthly_files(wh)
    dias, antes = dates_of(textos), F.year("data_referencia") <= PRIMEIRA_CARGA
    job.run_texts(textos.where(antes), [d for d in dias if d.year <= PRIMEIRA_CARGA])
    job.run_texts(textos.where(~antes), [d for d in dias if d.year > PRIMEIRA_CARGA])
    return job


def loaded_facts(wh: SampleStar) -> DataFrame:
    """Facts, customers and files per store of a warehouse loaded in two runs."""
    job = two_loads(wh)
    fatos = job.lake.read("warehouse/fato_vendas").groupBy("loja_id").agg(
        F.count("*").alias("vendas"), F.count_distinct("cliente_id").alias("clientes"), F.min("ano").alias("primeiro_ano"), F.max("ano").alias("ultimo_ano")
    )
    arquivos = job.lake.read("warehouse/processed_files").groupBy("loja_id").agg(F.count("*").alias("arquivos"), F.sum("registros_lidos").alias("lidos"))
    return fatos.join(arquivos, "loja_id")


def audit_of_runs(wh: SampleStar) -> DataFrame:
    """Tasks of two runs as they were audited: their counts, and that every row has an id of its own and a measured time."""
    job = two_loads(wh)
    log = job.lake.read("warehouse/pipeline_audit_log")
    unicos = log.agg((F.count_distinct("audit_id") == F.count("*")).alias("ids_unicos"))
    return (
        log.groupBy("task_id")
        .agg(
            F.count("*").alias("execucoes"),
            F.count_if(c("status") == "SUCCESS").alias("sucessos"),
            F.sum("registros_lidos").alias("lidos"),
            F.sum("registros_inseridos").alias("inseridos"),
            F.bool_and(c("duracao_segundos") > 0).alias("tempo_medido"),
        )
        .crossJoin(F.broadcast(unicos))
    )


def shares_in_steps(wh: SampleStar, ativas: DataFrame, gold: str) -> DataFrame:
    """A mart after three runs: first lines missing everywhere, then the even months delivered whole, then the odd ones."""
    job = sample_job(wh)
    mes = F.to_date(F.trunc("data_venda", "month")).alias("data_referencia")
    silver = write_intermediate(ativas.select(*shares.COLUNAS, mes), "silver")
    dias = dates_of(silver)
    par = F.month("data_referencia") % 2 == 0
    etapas = (
        (silver.where(F.substring_index("id_venda", "-", -1) != "1"), dias),
        (silver.where(par), [d for d in dias if d.month % 2 == 0]),
        (silver.where(~par), [d for d in dias if d.month % 2]),
    )
    for linhas, datas in etapas:
        with job.lake.transaction():
            job.marts(linhas, datas)
    return job.lake.read(f"gold/{gold}")


def orders_by_bitmap(wh: SampleStar) -> DataFrame:
    """Orders of the network by year, united from monthly bitmaps of each store."""
    vendas = wh.fato("id_venda", "loja_id", "ano", "mes", "status").where("status = 'CONCLUIDA'")
    vendas = vendas.withColumn("pedido", F.regexp_extract("id_venda", r"^VND-(\d+)-", 1))
    chaves = vendas.select("pedido").distinct()
    numeros = key_index.consecutive(chaves, 1)
    bits = write_intermediate(key_index.order_bits(vendas.join(numeros, "pedido"), "ano", "mes", "loja_id"), "bits")
    return key_index.counted(bits, "ano", nome="pedidos").join(key_index.counted(bits, "ano", "loja_id").groupBy("ano").agg(F.sum("pedidos").alias("pedidos_por_loja")), "ano")
