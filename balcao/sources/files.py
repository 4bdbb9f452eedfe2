"""Small files on the lake's file system, through the file system interface that Spark itself uses."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self.spark = spark

    def _open(self, caminho: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(caminho)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def names(self, pasta: str) -> list[str]:
        """Names in a folder, sorted; none when it does not exist."""
        fs, p = self._open(pasta)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def folders(self, pasta: str, niveis: int) -> list[str]:
        """Relative paths of the key=value folders ``niveis`` levels below a folder."""
        achadas = [""]
        for _ in range(niveis):
            achadas = [f"{a}/{n}".lstrip("/") for a in achadas for n in self.names(f"{pasta}/{a}") if "=" in n]
        return achadas

    def read(self, caminho: str) -> str:
        fs, p = self._open(caminho)
        entrada = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(entrada, "UTF-8")
        finally:
            entrada.close()

    def put(self, caminho: str, texto: str) -> None:
        """A new file that is seen whole or not at all; refused when it exists."""
        fs, p = self._open(caminho)
        pasta, nome = caminho.rsplit("/", 1)
        _, provisorio = self._open(f"{pasta}/.{nome}.{uuid.uuid4().hex}")
        saida = fs.create(provisorio, False)
        try:
            saida.write(bytearray(texto, "utf-8"))
        finally:
            saida.close()
        if fs.exists(p) or not fs.rename(provisorio, p):
            fs.delete(provisorio, False)
            raise FileExistsError(f"another writer has published {nome}")

    def delete(self, pasta: str) -> None:
        fs, p = self._open(pasta)
        fs.delete(p, True)
