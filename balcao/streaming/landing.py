"""Incremental landing: new raw files since the last run go through the same job as a daily run.

The source tracks which files were seen, and the manifest that publishes a batch also names it: a batch that is replayed after a
crash was published whole, and is skipped, or left nothing. The query keeps no state and needs no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from balcao.plans.jobs import Job
from balcao.sources import raw


def raw_stream(job: Job, arquivos_por_lote: int | None = None) -> DataFrame:
    leitor = (
        job.spark.readStream.format("text")
        .schema(raw.RAW_TEXT)
        .option("wholetext", True)
        .option("pathGlobFilter", "*.json")
    )
    if arquivos_por_lote:
        leitor = leitor.option("maxFilesPerTrigger", arquivos_por_lote)
    return raw.with_origin(leitor.load(f"{job.lake.path('raw')}/vendas"))


def land_batch(job: Job, lote: DataFrame, numero: int, consulta: str | None = None) -> None:
    """Reprocess the reference dates that received files. Whole dates are read again from the landing zone, because
    Bronze and Silver are replaced by date and a date's files may arrive in different batches. ``consulta`` is the stream's lasting
    id; Spark names it in the batch's own thread."""
    consulta = consulta or job.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if job.lake.done((consulta, numero)):
        return
    datas = sorted(r[0] for r in lote.select("data_referencia").distinct().collect())
    if not datas:
        return
    textos = raw.scan(job.spark, job.lake.path("raw"), datas[0].isoformat(), datas[-1].isoformat())
    job.run_texts(textos.where(F.col("data_referencia").isin(datas)), datas, lote=(consulta, numero))


def start_landing(job: Job, checkpoint: str, arquivos_por_lote: int | None = None) -> StreamingQuery:
    """Process everything that has arrived, then stop. ``checkpoint`` must be on shared storage."""
    return (
        raw_stream(job, arquivos_por_lote)
        .writeStream.foreachBatch(lambda lote, numero: land_batch(job, lote, numero))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
