"""Jobs over a lake: daily run, historical backfill and the step shared with the streaming landing.

A job covers a range of reference dates with the same plans; a single day is a range of one. Every stage result is
written before the next stage reads it, so a lost executor repeats one stage only, and a rerun of a range gives the
same tables. All writes of a run become current together at its end: a run that fails or is killed changes nothing but the audit
log. A run reads the partitions of its own dates and of the months that they touch, never a table's whole history.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao import schemas
from balcao.functions.lineage import LINHAS_GRANDES, write_intermediate
from balcao.operators import bloom, contract, load, quality, silver
from balcao.operators.key_index import FILTRO, MES, months_of, numbered
from balcao.operators.merge import merge_by_key, only_missing
from balcao.params import PADRAO, Params
from balcao.plans import shares
from balcao.sources import raw
from balcao.sources.catalog import Catalog
from balcao.sources.lake import Lake

c = F.col
GOLD = ("kpis_vendas", "faturamento_por_loja", "top_produtos", "dre_gerencial", "indicadores_fpa")


def parse_date(texto: str) -> date:
    try:
        return date.fromisoformat(texto)
    except ValueError as erro:
        raise ValueError(f"invalid reference date {texto!r}, use YYYY-MM-DD") from erro


def month_days(competencia: str) -> tuple[date, int]:
    """First day and length of a month written as YYYY-MM."""
    try:
        inicio = datetime.strptime(competencia, "%Y-%m").date()
    except (TypeError, ValueError) as erro:
        raise ValueError(f"invalid month {competencia!r}, use YYYY-MM") from erro
    return inicio, ((inicio + timedelta(days=31)).replace(day=1) - inicio).days


def month_end(ano: int, mes: int) -> date:
    inicio, dias = month_days(f"{ano:04d}-{mes:02d}")
    return inicio + timedelta(days=dias - 1)


def day_list(inicio: date, dias: int) -> list[date]:
    if dias < 1:
        raise ValueError("a backfill needs at least one day")
    return [inicio + timedelta(days=n) for n in range(dias)]


@dataclass(frozen=True)
class Job:
    lake: Lake
    #: Folder of the reference files (stores, products, budgets), or a catalogue that gives them.
    referencias: str | Catalog
    params: Params = PADRAO
    run_id: str = "cli_or_backfill"
    #: Measured tasks of the run in progress: audit rows, and the task that is open.
    tarefas: list = field(default_factory=list, compare=False, repr=False)

    @property
    def spark(self) -> SparkSession:
        return self.lake.spark

    @property
    def catalog(self) -> Catalog:
        return Catalog(self.spark, self.referencias) if isinstance(self.referencias, str) else self.referencias

    # Setup

    def setup(self) -> None:
        """Create the dimensions, the calendar and the base-year budgets. Repeating it changes nothing else."""
        lojas = self.catalog.stores().withColumn("updated_at", F.lit(self.params.instante).cast("timestamp"))
        self.upsert("dim_loja", lojas, ["loja_id"], load.LOJA_ATUALIZAVEIS)
        self.upsert("dim_produto", self.catalog.products(), ["produto_id"], load.PRODUTO_ATUALIZAVEIS)
        self.upsert("dim_tempo", load.calendar_range(self.spark), ["data_sk"], ())
        semente = load.seed_budget(
            self.lake.read("warehouse/dim_loja"), self.catalog.seed_parameters(), self.catalog.base_year(), self.params
        )
        valores = [col for col in semente.columns if col not in ("loja_id", "ano", "mes")]
        self.upsert("fato_orcamento", semente, ["loja_id", "ano", "mes"], valores)

    def upsert(self, tabela: str, novos: DataFrame, chave: Sequence[str], colunas: Sequence[str]) -> None:
        """Merge into a table of stores, products, dates or budgets; without update columns only missing keys are appended."""
        atual = self.lake.read(f"warehouse/{tabela}", novos.schema)
        if colunas:
            self.lake.replace_table(merge_by_key(atual, novos, chave, colunas), f"warehouse/{tabela}")
        else:
            self.lake.append(only_missing(novos, atual, chave), f"warehouse/{tabela}")

    def upsert_customers(self, clientes: DataFrame) -> DataFrame:
        """Merge customers by buckets of their id: only buckets with a new or changed customer are written. Returns the dimension."""
        balde = F.pmod(F.xxhash64("cliente_id"), F.lit(self.params.baldes_clientes)).cast("int")
        novos = write_intermediate(clientes.withColumn("balde", balde), "clientes")
        atual = self.lake.read("warehouse/dim_cliente", novos.schema)
        mudados = novos.join(atual, ["cliente_id", "cliente_nome", "segmento"], "left_anti")
        pastas = {f"balde={r['balde']}" for r in mudados.select("balde").distinct().collect()}
        if pastas:
            alvo = self.lake.read("warehouse/dim_cliente", novos.schema, pastas.__contains__)
            dos_baldes = novos.where(c("balde").isin([int(p.removeprefix("balde=")) for p in pastas]))
            junto = merge_by_key(alvo, dos_baldes, ["cliente_id"], ["cliente_nome", "segmento"])
            self.lake.replace_partitions(junto, "warehouse/dim_cliente", ["balde"])
        return self.lake.read("warehouse/dim_cliente", novos.schema)

    def upsert_ledger(self, linhas: DataFrame, dias: Sequence[date]) -> None:
        """Merge the files of the given dates; a file lies in the folder of its date, so other dates are not read."""
        atual = self.lake.read_days("warehouse/processed_files", dias, schemas.ARQUIVOS)
        novo = load.merge_ledger(atual, linhas.select(*atual.columns))
        self.lake.replace_days(novo, "warehouse/processed_files", dias)

    # Raw to Silver

    def extract(self, textos: DataFrame, dias: Sequence[date]) -> tuple[DataFrame, DataFrame]:
        """Check the raw files once and keep the verdicts; refused files go to quarantine, the rest to Bronze."""
        checados = write_intermediate(contract.check(raw.parse(textos)), "envelopes", LINHAS_GRANDES)
        recusados = contract.rejected(checados)
        guardados = self.lake.read_days("quarantine/arquivos_invalidos", dias, schemas.QUARENTENA_ARQUIVOS)
        novos = only_missing(recusados.distinct(), guardados, recusados.columns)
        self.lake.append_partitions(novos, "quarantine/arquivos_invalidos", ["data_referencia"])
        bronze = contract.flatten(contract.accepted(checados), self.params.instante, self.params)
        return checados, self.lake.replace_days(bronze, "bronze/vendas", dias)

    def validate(self, bronze: DataFrame, dias: Sequence[date]) -> tuple[DataFrame, DataFrame]:
        """Route Bronze rows and write the quality report. Returns the valid rows and the report."""
        produtos = self.lake.read("warehouse/dim_produto")
        avaliadas = write_intermediate(quality.evaluate(bronze, produtos), "avaliadas")
        destino = quality.route(avaliadas)
        self.lake.replace_days(destino.invalidas, "quarantine/registros_invalidos", dias)
        relatorio = self.lake.replace_json_days(quality.report(avaliadas, "data_referencia"), "reports/qualidade", dias)
        return destino.validas, relatorio

    def transform(self, validas: DataFrame, dias: Sequence[date]) -> tuple[DataFrame, DataFrame]:
        s = silver.to_silver(validas, self.params.instante, self.params)
        ativas = self.lake.replace_days(s.ativas, "silver/vendas", dias)
        return ativas, self.lake.replace_days(s.canceladas, "silver/canceladas", dias)

    # Gold

    @staticmethod
    def _months(meses: Sequence[tuple[int, int]]) -> Column:
        """Partition filter: the reference dates of the given months."""
        intervalos = [c("data_referencia").between(date(a, m, 1), month_end(a, m)) for a, m in meses]
        return reduce(or_, intervalos)

    def read_month(self, ano: int, mes: int) -> DataFrame:
        do_mes = f"data_referencia={ano:04d}-{mes:02d}-"
        linhas = self.lake.read("silver/vendas", silver.silver_schema(self.spark), lambda pasta: pasta.startswith(do_mes))
        linhas = linhas.where(self._months([(ano, mes)]))
        if linhas.isEmpty():
            raise FileNotFoundError(f"no Silver rows for {ano}-{mes:02d}")
        return linhas

    def marts(self, ativas: DataFrame, dias: Sequence[date]) -> dict[str, DataFrame]:
        """Write the marts of every month touched: those of the dates, of their sales, and of the sales they had before.

        ``ativas`` holds the active Silver rows of the dates. Their old shares are withdrawn from the month totals and the new
        ones added; orders and days are united from the bitmaps of the dates that have sales in those months. Silver rows of
        other dates are not read. A mart's month holds all sales dated in it, whichever date brought them; a
        touched month without sales is emptied.
        """
        lake, p = self.lake, self.params
        antigas = lake.read_days("gold/parcelas", dias, shares.day_shares(ativas).schema)
        novas = lake.replace_days(shares.day_shares(ativas), "gold/parcelas", dias)
        datas = lake.read("gold/meses", "ano int, mes int, linhas long, data_referencia date")
        dos_meses = novas.groupBy(*MES, "data_referencia").agg(F.sum("linhas").alias("linhas"))
        datas = lake.replace_table(
            datas.where(~c("data_referencia").isin(list(dias))).unionByName(dos_meses).coalesce(1), "gold/meses"
        )
        chaves = ativas.where("status = 'CONCLUIDA'").select(c("id_venda").alias("chave"), *MES)
        numeros = numbered(lake, "indice/vendas", chaves, p.blocos_filtro)
        lake.replace_days(shares.day_orders(ativas, numeros), "gold/pedidos", dias)

        tocados = {(d.year, d.month) for d in dias} | set(months_of(novas)) | set(months_of(antigas))
        meses = sorted(tocados)
        do_mes = (c("ano") * 100 + c("mes")).isin([a * 100 + m for a, m in meses])
        totais = lake.read_months("gold/totais", meses, shares.applied(novas, novas, antigas).schema)
        totais = lake.replace_months(shares.applied(totais, novas, antigas), "gold/totais", meses)
        com_vendas = [r[0] for r in datas.where(do_mes).select("data_referencia").distinct().collect()]
        pedidos = lake.read_days("gold/pedidos", com_vendas).where(do_mes)
        tabelas = shares.month_marts(totais, pedidos, self._budgets(meses), self.catalog.dre_parameters(), p)
        escritas = lake.replace_months_of({f"gold/{nome}": df for nome, df in tabelas.items()}, meses)
        return {nome: escritas[f"gold/{nome}"] for nome in tabelas}

    def _budgets(self, meses: Sequence[tuple[int, int]]) -> DataFrame:
        anos = self.spark.createDataFrame([(a,) for a in sorted({a for a, _ in meses})], "ano int")
        return load.monthly_budget(self.catalog.budgets(), anos, self.params).where(
            (c("ano") * 100 + c("mes")).isin([a * 100 + m for a, m in meses])
        )

    def full_marts(self, meses: Sequence[tuple[int, int]]) -> dict[str, DataFrame]:
        """The marts of some months from all Silver rows: what the daily shares must add up to."""
        vendas = self.lake.read("silver/vendas", silver.silver_schema(self.spark))
        vendas = vendas.where((c("ano") * 100 + c("mes")).isin([a * 100 + m for a, m in meses]))
        return shares.full_marts(vendas, self._budgets(meses), self.catalog.dre_parameters(), self.params)

    # Warehouse

    def load_warehouse(self, vendas: DataFrame, checados: DataFrame, dias: Sequence[date]) -> DataFrame:
        """Merge Silver rows of the range into the star schema. Returns the counts as one row."""
        lake, p = self.lake, self.params
        vendas = silver.null_nans(vendas)
        self.upsert("dim_tempo", load.calendar_rows(vendas.select(c("data_venda").alias("data"))), ["data_sk"], ())
        orcamentos = load.monthly_budget(self.catalog.budgets(), vendas.select("ano"), p)
        self.upsert("fato_orcamento", orcamentos, ["loja_id", "ano", "mes"], ())
        clientes = self.upsert_customers(load.customers(vendas))

        # A sale repeated on several reference dates of one range is loaded once, with its newest version.
        ordem = [c("data_referencia").desc(), c("arquivo_origem").desc(), c("posicao").desc()]
        unicas = silver.keep_last(vendas, schemas.FATO_CHAVE, ordem)
        lojas, produtos = lake.read("warehouse/dim_loja"), lake.read("warehouse/dim_produto")
        novas = write_intermediate(load.fact_rows(unicas, lojas, produtos, clientes, p.instante), "fatos")
        achadas = self.find_facts(novas)
        contagem = write_intermediate(
            load.found_counts(achadas).crossJoin(load.unknown_dimension_count(unicas, novas)), "contagem"
        )
        guardadas = achadas.where(c("ano_fato").isNotNull()).select(c("ano_fato").alias("ano"), c("mes_fato").alias("mes"))
        ineditas = achadas.where(c("ano_fato").isNull())
        meses = sorted({*months_of(guardadas), *months_of(ineditas)})
        if meses:
            alvo = lake.read_months("warehouse/fato_vendas", meses, schemas.FATO_VENDAS)
            lake.replace_months(load.merge_facts(alvo, novas), "warehouse/fato_vendas", meses)
            self.index_facts(ineditas)
        self.upsert_ledger(load.ledger_rows(contract.accepted(checados), p.instante, p), dias)
        return contagem

    def find_facts(self, novas: DataFrame) -> DataFrame:
        """(key, ano, mes, ano_fato, mes_fato): the month that holds each sale of a batch, null where none does.

        The months whose Bloom filter may hold a key are the only ones read, and only their key columns.
        """
        chave = list(schemas.FATO_CHAVE)
        filtros = self.lake.read("indice/fatos_filtro", FILTRO)
        candidatos = months_of(bloom.probe(novas, chave, filtros, MES, self.params.blocos_filtro))
        fatos = self.lake.read_months("warehouse/fato_vendas", candidatos, schemas.FATO_VENDAS)
        fatos = fatos.select(*chave, c("ano").alias("ano_fato"), c("mes").alias("mes_fato"))
        return write_intermediate(novas.select(*chave, *MES).join(fatos.hint("merge"), chave, "left"), "achadas")

    def index_facts(self, ineditas: DataFrame) -> None:
        """Add the keys of new facts to the filters of their months."""
        meses = months_of(ineditas)
        if meses:
            novos = bloom.build(ineditas, schemas.FATO_CHAVE, MES, self.params.blocos_filtro).select(*FILTRO.fieldNames())
            filtros = self.lake.read_months("indice/fatos_filtro", meses, FILTRO)
            self.lake.replace_months(bloom.merge(filtros, novos, MES).select(*FILTRO.fieldNames()), "indice/fatos_filtro", meses)

    def upsert_dre(self, dre: DataFrame) -> None:
        chave = ["loja_id", "ano", "mes"]
        self.upsert("fato_dre", dre, chave, [col for col in dre.columns if col not in chave])

    # Audit

    @contextmanager
    def task(self, tarefa: str, dia: date) -> Iterator[dict]:
        """Measure a task: its time here, its counts as the body fills them in from what was written."""
        medidas: dict[str, int] = {}
        inicio = time.monotonic()
        self.tarefas.append([tarefa, dia, "FAILED", medidas, 0.0])
        try:
            yield medidas
            self.tarefas[-1][2] = "SUCCESS"
        finally:
            self.tarefas[-1][4] = time.monotonic() - inicio

    def audit(self, mensagem: str | None = None) -> None:
        """Append one row for every task measured since the last audit. The manifest number makes the ids of two runs differ."""
        if not self.tarefas:
            return
        with self.lake.transaction() as estado:
            linhas = [
                load.audit_row(
                    self.spark, tarefa, dia.isoformat(), status, self.params.instante, self.run_id, self.params,
                    mensagem=mensagem if status == "FAILED" else None, duracao=round(duracao, 2), tentativa=estado["versao"], **medidas,
                )
                for tarefa, dia, status, medidas, duracao in self.tarefas
            ]
            self.tarefas.clear()
            self.lake.append(reduce(DataFrame.unionByName, linhas).coalesce(1), "warehouse/pipeline_audit_log")

    # Whole runs

    def run_texts(
        self, textos: DataFrame, dias: Sequence[date], load_database: bool = True, lote: tuple[str, int] | None = None
    ) -> DataFrame:
        """All stages for raw texts of the given dates, published at once; returns the summary as one row.

        ``lote`` names a batch of a stream, noted in the same manifest, so a batch that is replayed after a crash is either
        known or has left nothing.
        """
        dia = dias[-1]
        self.tarefas.clear()
        try:
            with self.lake.transaction(lote):
                with self.task("extrair_bronze", dia) as medidas:
                    checados, bronze = self.extract(textos, dias)
                    arquivos = checados.agg(F.count("*").alias("n"), F.count_if(F.size("erros") > 0).alias("r")).first()
                    extraidos = bronze.count()
                    medidas |= {"lidos": extraidos, "validos": extraidos, "invalidos": arquivos["r"]}
                with self.task("validar_qualidade", dia) as medidas:
                    validas, relatorio = self.validate(bronze, dias)
                    zero = F.lit(0).cast("long")
                    q = relatorio.agg(*[F.coalesce(F.sum(f"registros_{n}"), zero).alias(n) for n in ("validos", "invalidos")]).first()
                    medidas |= {"lidos": extraidos, "validos": q["validos"], "invalidos": q["invalidos"]}
                with self.task("transformar_silver", dia) as medidas:
                    ativas, canceladas = self.transform(validas, dias)
                    n_ativas, n_canceladas = ativas.count(), canceladas.count()
                    medidas |= {"lidos": q["validos"], "validos": n_ativas + n_canceladas, "ignorados": q["validos"] - n_ativas - n_canceladas}
                with self.task("gerar_indicadores", dia) as medidas:
                    tabelas = self.marts(ativas, dias)
                    medidas |= {"lidos": n_ativas, "validos": n_ativas}
                totais = {
                    "arquivos_raw": arquivos["n"], "arquivos_rejeitados": arquivos["r"], "registros_extraidos": extraidos,
                    "registros_validos": q["validos"], "registros_invalidos": q["invalidos"], "registros_silver": n_ativas,
                    "registros_cancelados": n_canceladas, "duplicatas_removidas": q["validos"] - n_ativas - n_canceladas,
                }
                if load_database:
                    with self.task("carregar_datawarehouse", dia) as medidas:
                        carga = self.load_warehouse(ativas.unionByName(canceladas), checados, dias).first().asDict()
                        self.upsert_dre(tabelas["dre_gerencial"])
                        totais |= carga
                        medidas |= {
                            "lidos": carga["registros_recebidos"], "validos": carga["registros_recebidos"],
                            "inseridos": carga["registros_inseridos"], "ignorados": carga["registros_atualizados"],
                        }
                resumo = self.spark.range(1).select(
                    F.lit(self.run_id).alias("run_id"), *[F.lit(v).cast("long").alias(k) for k, v in totais.items()]
                )
                resumo = self.lake.append_json(resumo, "audit")
                self.audit()
        except Exception as erro:
            self.audit(type(erro).__name__)
            raise
        return resumo

    def run_range(self, inicio: str, dias: int = 1, load_database: bool = True) -> DataFrame:
        """Raw to Gold (and warehouse) for consecutive reference dates, as one plan per stage."""
        datas = day_list(parse_date(inicio), dias)
        textos = raw.scan(self.spark, self.lake.path("raw"), datas[0].isoformat(), datas[-1].isoformat())
        return self.run_texts(textos, datas, load_database)

    def run_day(self, dia: str, load_database: bool = True) -> DataFrame:
        return self.run_range(dia, 1, load_database)

    def run_month(self, competencia: str, load_database: bool = True) -> DataFrame:
        inicio, dias = month_days(competencia)
        return self.run_range(inicio.isoformat(), dias, load_database)

    def process_date(self, dia: str) -> DataFrame:
        """Run one emitted date and return its count summary; refused when nothing was emitted for it."""
        if raw.scan(self.spark, self.lake.path("raw"), dia, dia).isEmpty():
            raise FileNotFoundError(f"no raw file was emitted for {dia}")
        return self.run_day(dia).withColumns({"status": F.lit("PROCESSADO"), "data": F.lit(dia).cast("date")})


def quality_history(lake: Lake) -> DataFrame:
    """Quality reports of all runs, by date."""
    return (
        lake.read("reports/qualidade")
        .select("data_referencia", "total_registros", "registros_validos", "registros_invalidos", "taxa_aprovacao")
        .orderBy("data_referencia")
    )


def fpa_history(lake: Lake) -> DataFrame:
    """Planning marts of all months, highest revenue first."""
    return (
        lake.read("gold/indicadores_fpa")
        .select("loja_id", "receita_realizada", "receita_orcada", "forecast_mes", "run_rate_anual", "status_semaforo")
        .orderBy(c("receita_realizada").desc(), "loja_id")
    )
