"""Tables of the lake: versioned folders, and one manifest that names the folders of every table.

A write goes to a new folder ``versao=...`` and changes nothing that can be read. Publishing a manifest makes all writes of a
transaction current at once, in all tables; a run that is killed before leaves folders that no manifest names. A frame
keeps reading the folders it was made from, so a table can be read and replaced in one plan.
"""

from __future__ import annotations

import copy
import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from balcao import schemas
from balcao.sources.files import Files
from balcao.sources.warehouse import Warehouse

MANIFESTO = "_manifesto"
VAZIO = {"versao": 0, "tabelas": {}, "lotes": {}}
#: Folder of a partition: column=value below column=value.
Pasta = str


def day_folder(dia: date) -> Pasta:
    return f"data_referencia={dia.isoformat()}"


def month_folder(ano: int, mes: int) -> Pasta:
    return f"ano={ano}/mes={mes}"


class Lake:
    """Tables of one lake, for a single writer and any number of readers.

    ``versao`` reads the lake as it was after that manifest. Outside a transaction each write is one of its own.
    """

    def __init__(self, spark: SparkSession, raiz: str, versao: int | None = None):
        self.spark = spark
        self.raiz = raiz.rstrip("/")
        self.versao = versao
        self.files = Files(spark)
        self._aberta: dict | None = None

    def path(self, tabela: str) -> str:
        return f"{self.raiz}/{tabela}"

    # Manifests

    def versions(self) -> list[int]:
        nomes = self.files.names(f"{self.raiz}/{MANIFESTO}")
        return [int(n.removesuffix(".json")) for n in nomes if n.endswith(".json") and not n.startswith(".")]

    def manifest(self) -> dict:
        """The tables as this lake sees them: the open transaction's, else the version asked for, else the newest."""
        if self._aberta is not None:
            return self._aberta
        versoes = self.versions()
        if self.versao is not None:
            if self.versao not in versoes:
                raise FileNotFoundError(f"the lake has no version {self.versao}")
            versoes = [self.versao]
        return json.loads(self.files.read(self._manifest_path(versoes[-1]))) if versoes else copy.deepcopy(VAZIO)

    def _manifest_path(self, versao: int) -> str:
        return f"{self.raiz}/{MANIFESTO}/{versao:012d}.json"

    @contextmanager
    def transaction(self, lote: tuple[str, int] | None = None) -> Iterator[dict]:
        """All writes inside become current together, or none does. ``lote`` (stream, batch number) is noted with them."""
        if self.versao is not None:
            raise PermissionError("an old version is read only")
        if self._aberta is not None:
            yield self._aberta
            return
        self._aberta = estado = copy.deepcopy(self.manifest())
        estado["versao"] += 1
        try:
            yield estado
            if lote:
                estado["lotes"][lote[0]] = lote[1]
            self.files.put(self._manifest_path(estado["versao"]), json.dumps(estado))
        finally:
            self._aberta = None

    def done(self, lote: tuple[str, int]) -> bool:
        """Whether a batch of a stream has been published."""
        return self.manifest()["lotes"].get(lote[0], -1) >= lote[1]

    def vacuum(self, manter: int = 2) -> list[str]:
        """Delete the folders that none of the newest ``manter`` manifests names: old versions and remains of killed runs.

        Frames made from older versions cannot be read any more. Returns the deleted folders.
        """
        versoes = self.versions()
        manifestos = [json.loads(self.files.read(self._manifest_path(v))) for v in versoes[-max(1, manter) :]]
        usadas = {(t, v) for m in manifestos for t, x in m["tabelas"].items() for vs in x["partes"].values() for v in vs}
        apagadas = []
        for tabela in sorted({t for m in manifestos for t in m["tabelas"]}):
            for nome in self.files.names(self.path(tabela)):
                if nome.startswith("versao=") and (tabela, nome.removeprefix("versao=")) not in usadas:
                    self.files.delete(f"{self.path(tabela)}/{nome}")
                    apagadas.append(f"{tabela}/{nome}")
        for velha in versoes[: -max(1, manter)]:
            self.files.delete(self._manifest_path(velha))
        return apagadas

    # Reading

    def read(
        self, tabela: str, schema: T.StructType | str | None = None, so: Callable[[Pasta], bool] | None = None
    ) -> DataFrame:
        """The table, or a typed empty frame when it has not been written yet. ``so`` keeps partitions by folder: the others
        are not even listed."""
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        entrada = self.manifest()["tabelas"].get(tabela)
        if entrada is None:
            if schema is None:
                raise FileNotFoundError(f"the lake has no table {tabela}")
            return self.spark.createDataFrame([], schema)
        schema = schema or T.StructType.fromJson(json.loads(entrada["esquema"]))
        pastas = [f"versao={v}/{p}".rstrip("/") for p, vs in sorted(entrada["partes"].items()) if so is None or so(p) for v in vs]
        return self._load(tabela, pastas, schema, entrada["formato"])

    def read_days(self, tabela: str, dias: Sequence[date], schema: T.StructType | None = None) -> DataFrame:
        return self.read(tabela, schema, {day_folder(d) for d in dias}.__contains__)

    def read_months(self, tabela: str, meses: Sequence[tuple[int, int]], schema: T.StructType | None = None) -> DataFrame:
        return self.read(tabela, schema, {month_folder(a, m) for a, m in meses}.__contains__)

    def partitions(self, tabela: str) -> list[Pasta]:
        return sorted(self.manifest()["tabelas"].get(tabela, {"partes": {}})["partes"])

    def _load(self, tabela: str, pastas: Sequence[str], schema: T.StructType, formato: str) -> DataFrame:
        if not pastas:
            return self.spark.createDataFrame([], schema)
        leitor = self.spark.read.schema(schema).option("basePath", self.path(tabela)).format(formato)
        return leitor.load([f"{self.path(tabela)}/{p}" for p in pastas]).select(*schema.fieldNames())

    # Writing

    def _stage(self, df: DataFrame, tabela: str, particoes: Sequence[str], formato: str = "parquet") -> tuple[str, list[Pasta]]:
        """Write ``df`` to a folder of its own; gives its version and the partitions it holds.

        Rebalancing keeps one partition's rows in few files and splits a partition that is too large for one task.
        """
        versao = f"{self.manifest()['versao']:08d}-{uuid.uuid4().hex}"
        destino = f"{self.path(tabela)}/versao={versao}"
        if particoes:
            df = df.hint("rebalance", *[F.col(p) for p in particoes])
        escrita = df.write.option("ignoreNullFields", False).partitionBy(*particoes) if particoes else df.write.option("ignoreNullFields", False)
        escrita.format(formato).save(destino)
        return versao, self.files.folders(destino, len(particoes))

    def _put(
        self, df: DataFrame, tabela: str, particoes: Sequence[str] = (), formato: str = "parquet",
        vazias: Sequence[Pasta] = (), tudo: bool = False, somar: bool = False,
    ) -> DataFrame:
        """Stage ``df`` and name it in the manifest: in place of the partitions it holds and of ``vazias``, of the whole table
        (``tudo``), or beside what is there (``somar``). Returns the written rows."""
        with self.transaction():
            return self._name(df.schema, tabela, self._stage(df, tabela, particoes, formato), particoes, formato, vazias, tudo, somar)

    def _name(
        self, schema: T.StructType, tabela: str, escrito: tuple[str, list[Pasta]], particoes: Sequence[str] = (), formato: str = "parquet",
        vazias: Sequence[Pasta] = (), tudo: bool = False, somar: bool = False,
    ) -> DataFrame:
        """Name a staged write in the open transaction's manifest."""
        versao, pastas = escrito
        ultimas = [f for f in schema if f.name in particoes]
        esquema = T.StructType([f for f in schema if f.name not in particoes] + sorted(ultimas, key=lambda f: particoes.index(f.name)))
        with self.transaction() as estado:
            entrada = estado["tabelas"].setdefault(tabela, {"partes": {}})
            entrada |= {"formato": formato, "esquema": esquema.json()}
            partes = {} if tudo else {p: v for p, v in entrada["partes"].items() if p not in vazias}
            for pasta in pastas:
                partes[pasta] = [*(partes.get(pasta, []) if somar else []), versao]
            entrada["partes"] = partes
        return self._load(tabela, [f"versao={versao}/{p}".rstrip("/") for p in pastas], esquema, formato)

    def append(self, df: DataFrame, tabela: str) -> DataFrame:
        return self._put(df, tabela, somar=True)

    def append_partitions(self, df: DataFrame, tabela: str, particoes: Sequence[str]) -> DataFrame:
        """Add rows to the partitions present in ``df``."""
        return self._put(df, tabela, particoes, somar=True)

    def append_json(self, df: DataFrame, tabela: str) -> DataFrame:
        return self._put(df, tabela, formato="json", somar=True)

    def replace_json_days(self, df: DataFrame, tabela: str, dias: Sequence[date]) -> DataFrame:
        """One JSON report per reference date; a rerun replaces the report of every given date, also by none."""
        return self._put(df, tabela, ["data_referencia"], "json", [day_folder(d) for d in dias])

    def replace_partitions(self, df: DataFrame, tabela: str, particoes: Sequence[str]) -> DataFrame:
        """Replace the partitions present in ``df``."""
        return self._put(df, tabela, particoes)

    def replace_months(self, df: DataFrame, tabela: str, meses: Sequence[tuple[int, int]]) -> DataFrame:
        """Replace the given (year, month) partitions, which hold all of ``df``; a month without rows is emptied."""
        return self._put(df, tabela, ["ano", "mes"], vazias=[month_folder(a, m) for a, m in meses])

    def replace_months_of(self, tabelas: Mapping[str, DataFrame], meses: Sequence[tuple[int, int]]) -> dict[str, DataFrame]:
        """``replace_months`` for several small tables whose writes run side by side."""
        mes, vazias = ["ano", "mes"], [month_folder(a, m) for a, m in meses]
        with self.transaction(), ThreadPoolExecutor(len(tabelas)) as grupo:
            escritas = {nome: grupo.submit(inheritable_thread_target(self.spark)(self._stage), df, nome, mes) for nome, df in tabelas.items()}
            return {nome: self._name(df.schema, nome, escritas[nome].result(), mes, vazias=vazias) for nome, df in tabelas.items()}

    def replace_days(self, df: DataFrame, tabela: str, dias: Sequence[date]) -> DataFrame:
        """Replace the given reference days; a day without rows is emptied, not left as it was."""
        return self._put(df, tabela, ["data_referencia"], vazias=[day_folder(d) for d in dias])

    def replace_table(self, df: DataFrame, tabela: str) -> DataFrame:
        return self._put(df, tabela, tudo=True)

    def export_csv(self, df: DataFrame, tabela: str) -> None:
        df.write.mode("overwrite").option("header", True).csv(self.path(f"export/{tabela}"))


class LakeWarehouse(Warehouse):
    """Star schema read from the lake. One object is one reading of the lake: after a load, make a new one."""

    def __init__(self, lake: Lake):
        super().__init__(lake.spark)
        self.lake = lake

    def fato(self, *colunas: str) -> DataFrame:
        fato = self.lake.read("warehouse/fato_vendas", schemas.FATO_VENDAS)
        return fato.withColumn("desconto_pct_calc", F.col("desconto_pct")).select(*colunas)

    def months(self) -> list[tuple[int, int]]:
        """The partitions that the manifest names; no fact is read."""
        pastas = [dict(x.split("=") for x in p.split("/")) for p in self.lake.partitions("warehouse/fato_vendas")]
        return sorted(((int(p["ano"]), int(p["mes"])) for p in pastas), reverse=True)

    def dim_loja(self) -> DataFrame:
        return self.lake.read("warehouse/dim_loja")

    def dim_produto(self) -> DataFrame:
        return self.lake.read("warehouse/dim_produto")

    def dim_cliente(self) -> DataFrame:
        return self.lake.read("warehouse/dim_cliente").drop("balde")

    def orcamento(self) -> DataFrame:
        return self.lake.read("warehouse/fato_orcamento")

    def dre(self) -> DataFrame:
        return self.lake.read("warehouse/fato_dre")

    def arquivos(self) -> DataFrame:
        return self.lake.read("warehouse/processed_files", schemas.ARQUIVOS)

    def auditoria(self) -> DataFrame:
        return self.lake.read("warehouse/pipeline_audit_log", schemas.AUDITORIA)
