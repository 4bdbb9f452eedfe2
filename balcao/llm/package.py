"""The package's code on the executors, for clusters where it is not installed."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import lru_cache, wraps

from pyspark.sql import SparkSession

import balcao


@lru_cache(maxsize=8)
def _ship(application: str) -> str:
    """A zip of the package; the driver's file server hands it to the executors."""
    root = os.path.dirname(os.path.abspath(balcao.__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="balcao-code-"), "balcao_code.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("balcao", os.path.relpath(path, root)))
    return out


def ship(spark: SparkSession) -> None:
    """Make the package importable in the Python workers of this application."""
    context = spark.sparkContext
    path = _ship(context.applicationId)
    if not any(f.endswith("balcao_code.zip") for f in context._python_includes):
        context.addPyFile(path)


def shipped(query: Callable) -> Callable:
    """A query or stage (spark, ...) that ships the package first."""

    @wraps(query)
    def run(spark: SparkSession, *args):
        ship(spark)
        return query(spark, *args)

    return run
