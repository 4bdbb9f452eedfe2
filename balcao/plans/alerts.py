"""Alert centre: every rule is a filter and a projection; the rules are united, numbered and sorted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from balcao.functions.columns import one_decimal, pct, rounded
from balcao.functions.lineage import write_intermediate
from balcao.params import PADRAO, Params
from balcao.plans import forecast, quality_status, snapshots, views
from balcao.sources.warehouse import Warehouse

c = F.col

# Severities in order of urgency.
SEVERIDADES = ("CRITICO", "ALTO", "MEDIO", "INFO")

# Texts of the alerts.
ACAO_META_VERMELHA = (
    "Abrir o detalhe da loja e revisar receita, canais e produtos que mais explicam o desvio."
)
ACAO_META_AMARELA = "Monitorar o run rate e comparar o forecast da loja com o orçamento."
DESCRICAO_META_AMARELA = "A loja está na faixa amarela de atingimento e merece acompanhamento."
ACAO_RECEITA = "Verificar mix de produtos, canais e status de vendas no drill-down da loja."
ACAO_MARGEM = "Analisar produtos de menor margem e descontos no detalhe da loja."
ACAO_CANCELAMENTO = "Revisar status operacional, canais e possíveis motivos de cancelamento."
ACAO_PIPELINE = "Abrir a página de qualidade e revisar as últimas tarefas auditadas."
DESCRICAO_PIPELINE = "Existem execuções com status de falha na auditoria do Data Warehouse."
ACAO_REJEICOES = "Consultar quarentena, arquivo de origem e regras de validação."
DESCRICAO_REJEICOES = "Há rejeições acumuladas na auditoria ou no controle de arquivos."
ACAO_COBERTURA = "Verificar emissão dos turnos no PDV e reprocessar a data se necessário."
ACAO_FORECAST = "Comparar tendência histórica, forecast ajustado e intervalo da previsão ML."
ACAO_OPERACAO = "Manter acompanhamento diário e revisar a evolução das lojas."
DESCRICAO_OPERACAO = "As principais regras de meta, qualidade, pipeline e previsão estão dentro dos limites."


def _text(*partes: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in partes])


def _alert(
    df: DataFrame,
    regra: int,
    tipo: str,
    severidade: Column,
    titulo: Column,
    descricao: Column,
    acao: str,
    limite: str,
    valor: Column,
    entidade: Column | None = None,
    ordem: list[Column] | None = None,
) -> DataFrame:
    """``regra`` and ``ordem`` fix the emission order inside the rule; rules about the network carry no store."""
    loja = c("loja_id") if entidade is not None else F.lit(None).cast("int")
    sequencia = F.row_number().over(Window.orderBy(*ordem)) if ordem else F.lit(1)
    return df.select(
        F.lit(regra).alias("regra"),
        sequencia.alias("sequencia"),
        F.lit(tipo).alias("type"),
        severidade.alias("severity"),
        (entidade if entidade is not None else F.lit("Rede")).alias("entity"),
        loja.alias("loja_id"),
        titulo.alias("title"),
        descricao.alias("description"),
        F.lit(acao).alias("action"),
        rounded(valor.cast("double")).alias("metric_value"),
        F.lit(limite).alias("threshold"),
    )


def store_alerts(lojas: DataFrame, params: Params = PADRAO) -> DataFrame:
    """Target and revenue rules. Both run store by store in ranking order, the target rule first."""
    meta = F.coalesce(c("variacao_pct"), F.lit(0.0))
    queda = F.coalesce(c("crescimento_mom"), F.lit(0.0))
    nome = c("loja_nome")
    vermelho = _alert(
        lojas.where("status_semaforo = 'VERMELHO'"),
        1,
        "META",
        F.when(meta <= params.meta_critica, "CRITICO").otherwise("ALTO"),
        _text(nome, " abaixo da meta"),
        _text("A loja está ", one_decimal(F.abs(meta)), "% abaixo do orçamento da competência."),
        ACAO_META_VERMELHA,
        "Meta mínima de 80% do orçamento",
        meta,
        nome,
        [c("ranking"), c("loja_id")],
    )
    amarelo = _alert(
        lojas.where("status_semaforo = 'AMARELO'"),
        1,
        "META",
        F.lit("MEDIO"),
        _text(nome, " perto de ficar abaixo da meta"),
        F.lit(DESCRICAO_META_AMARELA),
        ACAO_META_AMARELA,
        "Meta saudável acima de 95%",
        meta,
        nome,
        [c("ranking"), c("loja_id")],
    )
    receita = _alert(
        lojas.where(queda <= params.queda_media),
        1,
        "RECEITA",
        F.when(queda <= params.queda_alta, "ALTO").otherwise("MEDIO"),
        _text("Queda de receita em ", nome),
        _text("A receita mensal caiu ", one_decimal(F.abs(queda)), "% contra a competência anterior."),
        ACAO_RECEITA,
        "Queda superior a 10% mês contra mês",
        queda,
        nome,
        [c("ranking"), c("loja_id")],
    )
    alertas = vermelho.unionByName(amarelo).unionByName(receita)
    # Emission order of this rule: by store rank, target before revenue.
    posicao = lojas.select("loja_id", F.row_number().over(Window.orderBy("ranking", "loja_id")).alias("_p"))
    return (
        alertas.join(F.broadcast(posicao), "loja_id")
        .withColumn("sequencia", c("_p") * 2 + F.when(c("type") == "META", 0).otherwise(1))
        .drop("_p")
    )


def margin_alerts(ranking: DataFrame, params: Params = PADRAO) -> DataFrame:
    margem = F.coalesce(c("margem_pct"), F.lit(0.0))
    return _alert(
        ranking.where(margem < params.margem_media),
        2,
        "MARGEM",
        F.when(margem < params.margem_alta, "ALTO").otherwise("MEDIO"),
        _text("Margem baixa em ", c("loja_nome")),
        _text("A margem bruta da loja está em ", one_decimal(margem), "%."),
        ACAO_MARGEM,
        "Margem bruta mínima de 25%",
        margem,
        c("loja_nome"),
        [margem, c("loja_id")],
    )


def cancellation_alerts(loja_mes: DataFrame, params: Params = PADRAO) -> DataFrame:
    taxa = F.coalesce(pct(c("canceladas"), c("registros")), F.lit(0.0))
    return _alert(
        loja_mes.where(taxa >= params.cancelamento_medio),
        3,
        "CANCELAMENTO",
        F.when(taxa >= params.cancelamento_alto, "ALTO").otherwise("MEDIO"),
        _text("Cancelamento elevado em ", c("loja_nome")),
        _text("A taxa de cancelamento está em ", one_decimal(taxa), "% na competência."),
        ACAO_CANCELAMENTO,
        "Taxa de cancelamento acima de 8%",
        taxa,
        c("loja_nome"),
        [taxa.desc(), c("loja_id")],
    )


def pipeline_alerts(resumo: DataFrame) -> DataFrame:
    falhas = c("execucoes_falha")
    return _alert(
        resumo.where(falhas > 0),
        4,
        "PIPELINE",
        F.lit("CRITICO"),
        F.lit("Falha registrada no pipeline"),
        F.lit(DESCRICAO_PIPELINE),
        ACAO_PIPELINE,
        "Zero falhas de execução",
        falhas,
    )


def rejection_alerts(resumo: DataFrame) -> DataFrame:
    total = c("total_rejeicoes")
    return _alert(
        resumo.where(total > 0),
        5,
        "QUALIDADE",
        F.lit("ALTO"),
        F.lit("Registros inválidos detectados"),
        F.lit(DESCRICAO_REJEICOES),
        ACAO_REJEICOES,
        "Zero registros inválidos",
        total,
    )


def coverage_alerts(cobertura: DataFrame, params: Params = PADRAO) -> DataFrame:
    return _alert(
        cobertura.where(c("arquivos") < params.arquivos_por_dia),
        6,
        "QUALIDADE",
        F.lit("ALTO"),
        _text("Cobertura incompleta em ", c("loja_nome")),
        _text("A última data processada possui ", c("arquivos").cast("string"), " arquivo(s) para a loja."),
        ACAO_COBERTURA,
        "Três arquivos por loja no fechamento diário",
        c("arquivos"),
        c("loja_nome"),
        [c("loja_id")],
    )


def forecast_divergence(gerencial: DataFrame, ml: DataFrame) -> DataFrame:
    """First month ahead of both forecasts per store and their distance in percent of the managerial one."""
    primeiro_ml = ml.where("passo = 1").select(c("serie").alias("loja_id"), "previsao")
    distancia = pct(F.abs(c("previsao") - c("forecast_ajustado")), c("forecast_ajustado"))
    return (
        gerencial.where("passo = 1")
        .join(primeiro_ml, "loja_id")
        .select(
            "loja_id",
            "loja_nome",
            "forecast_ajustado",
            "previsao",
            F.coalesce(distancia, F.lit(0.0)).alias("divergencia_pct"),
        )
    )


def forecast_alerts(divergencia: DataFrame, params: Params = PADRAO) -> DataFrame:
    valor = c("divergencia_pct")
    return _alert(
        divergencia.where(valor >= params.divergencia_forecast),
        7,
        "FORECAST",
        F.lit("MEDIO"),
        _text("Forecast divergente em ", c("loja_nome")),
        _text("A previsão ML difere ", one_decimal(valor), "% do forecast gerencial do próximo mês."),
        ACAO_FORECAST,
        "Diferença máxima recomendada de 15%",
        valor,
        c("loja_nome"),
        [c("loja_id")],
    )


def calm_alert(alertas: DataFrame) -> DataFrame:
    """One informative row when no rule fired, none otherwise."""
    quantos = alertas.agg(F.count("*").alias("_q")).where("_q = 0")
    vazio = F.lit(None).cast("string")
    return _alert(
        quantos,
        8,
        "OPERACAO",
        F.lit("INFO"),
        F.lit("Nenhum alerta crítico identificado"),
        F.lit(DESCRICAO_OPERACAO),
        ACAO_OPERACAO,
        "",
        F.lit(None),
    ).withColumn("threshold", vazio)


def finish(alertas: DataFrame, competencia: str) -> DataFrame:
    """Id from the emission order, route, and urgency order. Every rule yields at most one row per store, so the
    ordering window is bounded by the stores."""
    emissao = F.row_number().over(Window.orderBy("regra", "sequencia"))
    urgencia = F.array_position(F.array(*[F.lit(s) for s in SEVERIDADES]), c("severity"))
    numerados = alertas.withColumns(
        {
            "emissao": emissao,
            "competencia": F.lit(competencia),
            "route": F.when(c("loja_id").isNotNull(), F.concat(F.lit("/lojas/"), c("loja_id").cast("string"))).otherwise(
                "/qualidade"
            ),
        }
    )
    ordem = Window.orderBy(urgencia, "type", "entity", "emissao")
    return (
        numerados.withColumn(
            "id",
            F.concat_ws(
                "-", "competencia", "type", F.coalesce(c("loja_id").cast("string"), F.lit("rede")), "emissao"
            ),
        )
        .withColumn("posicao", F.row_number().over(ordem))
        .select(
            "posicao", "id", "type", "severity", "entity", "loja_id", "title", "description", "action",
            "metric_value", "threshold", "route", "competencia",
        )
        .orderBy("posicao")
    )


def month_cancellations(wh: Warehouse, ano: int, mes: int) -> DataFrame:
    return snapshots.of_month(wh.shared().loja_mes_status(), ano, mes).join(wh.lojas(), "loja_id")


def alert_center(wh: Warehouse, params: Params = PADRAO) -> DataFrame:
    """All alerts of the newest loaded month, most urgent first."""
    wh = wh.shared().with_ledger()
    ano, mes = snapshots.latest_loaded_month(wh)
    resumo = quality_status.overview(wh)
    divergencia = forecast_divergence(
        forecast.store_projection(wh, 3, 0.0, params), forecast.ml_projection(wh, 3, params)
    )
    regras = [
        store_alerts(snapshots.store_table(wh, ano, mes), params),
        margin_alerts(snapshots.of_month(views.store_ranking(wh), ano, mes), params),
        cancellation_alerts(month_cancellations(wh, ano, mes), params),
        pipeline_alerts(resumo),
        rejection_alerts(resumo),
        coverage_alerts(quality_status.coverage(wh), params),
        forecast_alerts(divergencia, params),
    ]
    alertas = write_intermediate(reduce(DataFrame.unionByName, regras), "alertas")
    return finish(alertas.unionByName(calm_alert(alertas)), f"{ano:04d}-{mes:02d}")


def severity_counts(alertas: DataFrame) -> DataFrame:
    """Alerts per severity, zero where none exists."""
    niveis = F.explode(F.array(*[F.struct(F.lit(i).alias("ordem"), F.lit(s).alias("severity"))
                                 for i, s in enumerate(SEVERIDADES, 1)]))
    lista = alertas.sparkSession.range(1).select(niveis.alias("n")).select("n.*")
    contagem = alertas.groupBy("severity").agg(F.count("*").alias("alertas"))
    return lista.join(contagem, "severity", "left").na.fill(0, ["alertas"]).orderBy("ordem")


def filter_alerts(alertas: DataFrame, severidade: str = "TODOS", tipo: str = "TODOS") -> DataFrame:
    if severidade != "TODOS":
        alertas = alertas.where(c("severity") == severidade)
    if tipo != "TODOS":
        alertas = alertas.where(c("type") == tipo)
    return alertas
