"""State of files and runs: totals, windows of days, recent records, coverage and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao.functions.columns import approval_rate, window_start
from balcao.params import PADRAO, Params
from balcao.schemas import TURNOS
from balcao.sources.warehouse import Warehouse

c = F.col

# Operational messages.
MSG_FALHAS = "Existem falhas registradas na auditoria ou no controle de arquivos."
MSG_REJEICOES = "Há registros inválidos acumulados para investigar na quarentena."
MSG_COBERTURA = "A última data processada possui lojas com menos de três turnos carregados."
MSG_NORMAL = "Nenhuma anomalia operacional detectada no período analisado."

_REGISTROS = ("registros_lidos", "registros_validos", "registros_invalidos")


def _status(valor: str) -> Column:
    return F.count_if(c("status") == valor)


def _total(coluna: str) -> Column:
    return F.coalesce(F.sum(coluna), F.lit(0).cast("long"))


def _records() -> list[Column]:
    return [_total(r).alias(r) for r in _REGISTROS]


def overview(wh: Warehouse) -> DataFrame:
    """Ledger totals beside audit totals, one row."""
    arquivos = wh.arquivos().agg(
        F.count("*").alias("total_arquivos"),
        _status("PROCESSED").alias("processados"),
        _status("REPROCESSED").alias("reprocessados"),
        _status("FAILED").alias("falhas_arquivo"),
        _status("QUARANTINED").alias("quarentenados"),
        *_records(),
        F.max("updated_at").alias("ultima_atualizacao_arquivo"),
        F.max("data_referencia").alias("ultima_data_referencia"),
    )
    auditoria = wh.auditoria().agg(
        F.count("*").alias("total_execucoes"),
        _status("SUCCESS").alias("execucoes_sucesso"),
        _status("FAILED").alias("execucoes_falha"),
        _total("registros_lidos").alias("registros_auditados"),
        _total("registros_invalidos").alias("rejeicoes_auditadas"),
        _mean_duration().alias("duracao_media_segundos"),
        F.max("created_at").alias("ultima_execucao"),
    )
    return arquivos.crossJoin(F.broadcast(auditoria)).withColumns(
        {
            "taxa_aprovacao": approval_rate(c("registros_lidos"), c("registros_invalidos")),
            "taxa_sucesso_execucoes": approval_rate(c("total_execucoes"), c("execucoes_falha")),
            "total_rejeicoes": F.greatest("registros_invalidos", "rejeicoes_auditadas"),
        }
    )


def _mean_duration() -> Column:
    return F.coalesce(F.try_divide(F.sum("duracao_segundos").cast("double"), F.count("*")), F.lit(0.0))


def _in_window(por_dia: DataFrame, dias: int, as_of: str | None) -> DataFrame:
    """Rows of the last ``dias`` days. Without a date the newest reference date ends the window; it is taken over
    rows already reduced to a few per day, so the table is read once."""
    if as_of is not None:
        return por_dia.where(c("data_referencia") >= window_start(F.lit(as_of).cast("date"), dias))
    fim = F.max("data_referencia").over(Window.partitionBy())
    return por_dia.withColumn("_fim", fim).where(c("data_referencia") >= window_start(c("_fim"), dias)).drop("_fim")


def daily_quality(wh: Warehouse, dias: int = 14, as_of: str | None = None) -> DataFrame:
    por_loja = (
        wh.arquivos()
        .groupBy("data_referencia", "loja_id")
        .agg(
            F.count("*").alias("arquivos"),
            _status("PROCESSED").alias("processados"),
            _status("REPROCESSED").alias("reprocessados"),
            _status("FAILED").alias("falhas"),
            _status("QUARANTINED").alias("quarentenados"),
            *_records(),
            F.max("updated_at").alias("atualizado_em"),
        )
    )
    contagens = ("arquivos", "processados", "reprocessados", "falhas", "quarentenados", *_REGISTROS)
    por_dia = por_loja.groupBy("data_referencia").agg(
        F.count("*").alias("lojas"),
        *[F.sum(n).alias(n) for n in contagens],
        F.max("atualizado_em").alias("atualizado_em"),
    )
    return (
        _in_window(por_dia, dias, as_of)
        .withColumn("taxa_aprovacao", approval_rate(c("registros_lidos"), c("registros_invalidos")))
        .orderBy(c("data_referencia").desc())
    )


def task_quality(wh: Warehouse, dias: int = 14, as_of: str | None = None) -> DataFrame:
    soma = ("registros_lidos", "registros_validos", "registros_invalidos", "registros_inseridos", "registros_ignorados")
    por_dia = (
        wh.auditoria()
        .groupBy("data_referencia", "task_id", "status")
        .agg(
            F.count("*").alias("execucoes"),
            *[_total(s).alias(s) for s in soma],
            F.sum("duracao_segundos").alias("duracao"),
            F.max("created_at").alias("ultima_execucao"),
        )
    )
    return (
        _in_window(por_dia, dias, as_of)
        .groupBy("task_id", "status")
        .agg(
            F.sum("execucoes").alias("execucoes"),
            *[F.sum(s).alias(s) for s in soma],
            F.try_divide(F.sum("duracao").cast("double"), F.sum("execucoes")).alias("duracao_media_segundos"),
            F.max("ultima_execucao").alias("ultima_execucao"),
        )
        .withColumn("taxa_aprovacao", approval_rate(c("registros_lidos"), c("registros_invalidos")))
        .orderBy(c("ultima_execucao").desc(), "task_id", "status")
    )


def recent_files(wh: Warehouse, limite: int = 30) -> DataFrame:
    nome = F.coalesce(c("loja_nome"), F.concat(F.lit("Loja "), c("loja_id").cast("string")))
    return (
        wh.arquivos()
        .join(wh.lojas(), "loja_id", "left")
        .withColumn("loja_nome", nome)
        .orderBy(c("updated_at").desc(), c("file_id").desc())
        .limit(limite)
    )


def recent_runs(wh: Warehouse, limite: int = 25) -> DataFrame:
    return wh.auditoria().orderBy(c("created_at").desc(), c("audit_id").desc()).limit(limite)


def shifts_with_files() -> Column:
    """Shift files of a group of ledger rows: the parts of a split shift count as one, a file that names no shift as itself."""
    turno = F.regexp_extract(F.lower("file_path"), rf"_({'|'.join(t.lower() for t in TURNOS)})(?:-\d+)?\.json$", 1)
    posicao = F.array_position(F.array(*[F.lit(t.lower()) for t in TURNOS]), turno).cast("int")
    vistos = F.bit_or(F.when(posicao > 0, F.call_function("shiftleft", F.lit(1), posicao - 1)))
    return (F.coalesce(F.bit_count(vistos), F.lit(0)) + F.count_if(posicao == 0)).cast("long")


def coverage(wh: Warehouse) -> DataFrame:
    """Shifts with files of every active store on the newest date, stores without files included."""
    por_loja_data = (
        wh.arquivos()
        .groupBy("loja_id", "data_referencia")
        .agg(shifts_with_files().alias("arquivos"), *_records(), F.max("updated_at").alias("atualizado_em"))
    )
    # The newest date per store is one row per store; the newest of all is taken over those few rows.
    ultimas = por_loja_data.groupBy("loja_id").agg(
        F.max_by(F.struct("data_referencia", "arquivos", *_REGISTROS, "atualizado_em"), "data_referencia").alias("u")
    )
    fim = ultimas.agg(F.max("u.data_referencia").alias("fim"))
    do_dia = ultimas.join(F.broadcast(fim), c("u.data_referencia") == c("fim")).select("loja_id", "u.*")
    lojas = wh.dim_loja().where("ativa").select("loja_id", "loja_nome")
    return (
        lojas.join(do_dia.drop("data_referencia"), "loja_id", "left")
        .na.fill(0, ["arquivos", *_REGISTROS])
        .withColumn("taxa_aprovacao", approval_rate(c("registros_lidos"), c("registros_invalidos")))
        .orderBy("loja_id")
    )


def messages(resumo: DataFrame, cobertura: DataFrame, params: Params = PADRAO) -> DataFrame:
    """Operational messages in fixed order; a single calm one when nothing is wrong."""
    falta = cobertura.agg(F.count_if(c("arquivos") < params.arquivos_por_dia).alias("lojas_incompletas"))
    avisos = F.array_compact(
        F.array(
            F.when((c("falhas_arquivo") > 0) | (c("execucoes_falha") > 0), MSG_FALHAS),
            F.when(c("total_rejeicoes") > 0, MSG_REJEICOES),
            F.when(c("lojas_incompletas") > 0, MSG_COBERTURA),
        )
    )
    return (
        resumo.crossJoin(F.broadcast(falta))
        .select(avisos.alias("m"))
        .select(F.posexplode(F.when(F.size("m") > 0, c("m")).otherwise(F.array(F.lit(MSG_NORMAL)))))
        .select((c("pos") + 1).alias("ordem"), c("col").alias("mensagem"))
    )
