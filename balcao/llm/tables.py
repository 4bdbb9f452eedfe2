"""Reading the corpus tables, and the fold of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Rows whose CRC-32 of the decimal id is divisible by five; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` training rows, chosen by a hash of the id.

    Only ids outside the held-out fold count. ``max_rows`` bounds the training set of a model, nothing else. The ids are
    chosen before the texts are read, so the join's small side is bounded by ``max_rows``; of an id with several rows the text
    with the least hash is taken, so the result is bounded too.
    """
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text", "label")).alias("row"))
    return found.select("doc_id", "row.text", "row.label")
