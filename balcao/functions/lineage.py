"""Written intermediate tables: one small result feeds several branches without a second fact scan."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one only in local mode."""
    pasta = spark.conf.get("spark.checkpoint.dir", None)
    if pasta:
        return pasta.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    pasta = tempfile.mkdtemp(prefix="balcao-")
    spark.conf.set("spark.checkpoint.dir", pasta)
    return pasta


#: Writing options of tables with large rows. Parquet first looks at the size of a row group after 100 rows, and a group is read as one
#: batch; so a task would hold up to 100 whole files of thousands of sales each, written or read. Here a group ends after 8 rows, or
#: as soon as it has 1 MB as compressed: a large file is a group of its own.
LINHAS_GRANDES = {
    "parquet.block.row.count.limit": "8", "parquet.block.size": str(1 << 20), "parquet.page.size.row.check.min": "1",
}


def write_intermediate(df: DataFrame, name: str, opcoes: Mapping[str, str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it, so lost executors never replay its lineage."""
    destino = f"{shared_folder(df.sparkSession)}/balcao/{name}-{uuid.uuid4().hex}"
    df.write.options(**(opcoes or {})).parquet(destino)
    return df.sparkSession.read.schema(df.schema).parquet(destino)
