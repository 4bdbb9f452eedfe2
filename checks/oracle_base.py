"""Shared SQL of the reference answers: the sample tables read as store sales, one named subquery per table."""

from __future__ import annotations

import re

PARTES: dict[str, str] = {}

PARTES["linhas"] = """
SELECT l.*, CAST(r_regionkey + 1 AS INTEGER) AS loja_id, r_name AS loja_nome,
       l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS data_venda
FROM lineitem l
JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey
JOIN region ON r_regionkey = n_regionkey
"""

PARTES["unicas"] = """
SELECT * FROM linhas
QUALIFY ROW_NUMBER() OVER (
  PARTITION BY l_orderkey, l_linenumber, loja_id
  ORDER BY l_shipdate DESC, l_suppkey DESC, l_partkey DESC, l_quantity DESC, l_extendedprice DESC,
           l_discount DESC, l_returnflag DESC, l_linestatus DESC) = 1
"""

_VENDA = """
SELECT 'VND-' || l_orderkey || '-' || l_linenumber AS id_venda, l_orderkey, l_linenumber, l_suppkey, l_tax,
       loja_id, loja_nome, data_venda,
       CAST(data_venda AS DATE) AS data,
       CAST(year(data_venda) AS INTEGER) AS ano, CAST(month(data_venda) AS INTEGER) AS mes,
       CAST(day(data_venda) AS INTEGER) AS dia,
       CASE WHEN hour(data_venda) BETWEEN 6 AND 11 THEN 'MANHA' WHEN hour(data_venda) BETWEEN 12 AND 17 THEN 'TARDE'
            WHEN hour(data_venda) BETWEEN 18 AND 22 THEN 'NOITE' ELSE 'MADRUGADA' END AS periodo,
       CASE WHEN hour(data_venda) < 12 THEN 'MANHA' WHEN hour(data_venda) < 18 THEN 'TARDE' ELSE 'NOITE' END AS turno,
       l_partkey AS produto_id, p_name AS produto_nome, p_type AS categoria, p_brand AS subcategoria,
       o_custkey AS cliente_id, o_orderpriority AS canal_venda, CASE l_linestatus WHEN 'F' THEN 'CARTAO' ELSE 'PIX' END AS forma_pagamento,
       CAST(l_quantity AS INTEGER) AS quantidade,
       CAST(floor(l_extendedprice * 100 / l_quantity) / 100 AS DECIMAL(12,2)) AS valor_unitario,
       CAST(ROUND(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(1.6 AS DECIMAL(2,1)), 2) AS DECIMAL(12,2))
         AS custo_unitario,
       CAST(l_discount AS DECIMAL(4,2)) AS taxa,
       CASE WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN 'CANCELADA'
            WHEN o_orderstatus = 'P' AND l_linenumber = 3 THEN 'PENDENTE' ELSE 'CONCLUIDA' END AS status
FROM {origem}
LEFT JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN part ON p_partkey = l_partkey
"""

_VALORES = """
SELECT v.*, valor_bruto - desconto_valor AS valor_liquido,
       valor_bruto - desconto_valor - custo_total AS margem_bruta,
       CASE WHEN valor_bruto > 0
            THEN R2(CAST(desconto_valor AS DOUBLE) / CAST(valor_bruto AS DOUBLE) * 100) ELSE 0 END AS desconto_pct
FROM (SELECT b.*, CAST(quantidade * valor_unitario AS DECIMAL(12,2)) AS valor_bruto,
             CAST(quantidade * custo_unitario AS DECIMAL(12,2)) AS custo_total,
             CAST(ROUND(CAST(quantidade * valor_unitario AS DECIMAL(12,2)) * taxa, 2) AS DECIMAL(12,2)) AS desconto_valor
      FROM ({venda}) b) v
"""

PARTES["fato"] = _VALORES.format(venda=_VENDA.format(origem="unicas"))
PARTES["bronze"] = _VALORES.format(venda=_VENDA.format(origem="linhas"))
PARTES["concluidas"] = "SELECT * FROM fato WHERE status = 'CONCLUIDA'"

PARTES["dim_loja"] = """
SELECT CAST(r_regionkey + 1 AS INTEGER) AS loja_id, r_name AS loja_nome, r_name AS cidade,
       left(r_name, 2) AS estado, r_name AS regiao, make_date(r_regionkey + 1991, 3, 1) AS data_abertura,
       CASE WHEN r_regionkey IN (0, 3) THEN 'PREMIUM' ELSE 'STANDARD' END AS tier, TRUE AS ativa
FROM region
"""

PARTES["dim_cliente"] = """
SELECT c_custkey AS cliente_id, c_name AS cliente_nome,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'VAREJO' WHEN 'FURNITURE' THEN 'VAREJO'
            WHEN 'BUILDING' THEN 'CORPORATIVO' WHEN 'MACHINERY' THEN 'CORPORATIVO'
            WHEN 'AUTOMOBILE' THEN 'VIP' ELSE c_mktsegment END AS segmento
FROM customer
"""

PARTES["loja_mes"] = """
SELECT ano, mes, loja_id, SUM(valor_liquido) AS faturamento, SUM(valor_bruto) AS receita_bruta,
       SUM(desconto_valor) AS descontos, SUM(custo_total) AS custo_total, SUM(margem_bruta) AS margem_bruta,
       SUM(quantidade) AS quantidade, COUNT(DISTINCT id_venda) AS pedidos, COUNT(DISTINCT data) AS dias
FROM concluidas GROUP BY ano, mes, loja_id
"""

PARTES["status_mes"] = """
SELECT ano, mes, loja_id, COUNT(*) FILTER (WHERE status = 'CANCELADA') AS canceladas, COUNT(*) AS registros
FROM fato GROUP BY ano, mes, loja_id
"""

PARTES["orcamento"] = """
SELECT loja_id, ano, CAST(m AS INTEGER) AS mes, receita_orcada FROM (
  SELECT loja_id, ano, CAST(R2(CAST(SUM(faturamento) AS DOUBLE) / COUNT(*)
           * ((80 + 10 * loja_id) / CAST(100 AS DOUBLE))) AS DECIMAL(15,2)) AS receita_orcada
  FROM loja_mes GROUP BY loja_id, ano) o, generate_series(1, 12) t(m)
"""

PARTES["dre_loja"] = """
SELECT loja_id, CAST(R2(CAST(SUM(faturamento) AS DOUBLE) / COUNT(*) * CAST(0.05 AS DOUBLE)) AS DECIMAL(15,2))
         AS despesas_fixas, CAST(2500 AS DECIMAL(15,2)) AS depreciacao
FROM loja_mes GROUP BY loja_id
"""

PARTES["dre_exato"] = """
SELECT e.*, CASE WHEN ebit > 0 THEN ebit * CAST(0.02 AS DECIMAL(2,2)) ELSE 0 END AS despesas_financeiras FROM (
  SELECT d.*, ebitda - depreciacao AS ebit FROM (
    SELECT c.*, lucro_bruto - despesas_variaveis - despesas_fixas AS ebitda FROM (
      SELECT b.*, receita_liquida - cmv AS lucro_bruto,
             receita_liquida * CAST(0.06 AS DECIMAL(2,2)) AS despesas_variaveis FROM (
        SELECT a.*, receita_bruta - descontos - impostos AS receita_liquida FROM (
          SELECT loja_id, ano, mes, receita_bruta, descontos, custo_total AS cmv,
                 receita_bruta * CAST(0.12 AS DECIMAL(2,2)) AS impostos, despesas_fixas, depreciacao
          FROM loja_mes LEFT JOIN dre_loja USING (loja_id)) a) b) c) d) e
"""

DRE_VALORES = (
    "receita_bruta", "descontos", "impostos", "receita_liquida", "cmv", "lucro_bruto", "despesas_variaveis",
    "despesas_fixas", "ebitda", "depreciacao", "ebit", "despesas_financeiras", "resultado_antes_ir",
)


def pct(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * 100)"


def rounded(valor: str, casas: int = 2) -> str:
    return f"CAST(ROUND(CAST({valor} AS DECIMAL(38,6)), {casas}) AS DOUBLE)"


def pct2(num: str, den: str) -> str:
    return rounded(pct(num, den))


PARTES["dre"] = f"""
SELECT loja_id, ano, mes, {", ".join(f"CAST(ROUND({v}, 2) AS DECIMAL(15,2)) AS {v}" for v in DRE_VALORES)},
       {pct2("lucro_bruto", "receita_liquida")} AS margem_bruta_pct,
       {pct2("ebitda", "receita_liquida")} AS margem_ebitda_pct,
       {pct2("resultado_antes_ir", "receita_liquida")} AS margem_liquida_pct
FROM (SELECT *, ebit - despesas_financeiras AS resultado_antes_ir FROM dre_exato)
"""

PARTES["arquivos"] = """
SELECT CAST(strftime(data_referencia, '%Y%m%d') AS BIGINT) * 100 + loja_id * 10 + ordem AS file_id,
       file_path, sha256(file_path || '|' || registros_lidos || '|' || registros_validos) AS checksum,
       data_referencia, loja_id, 'SILVER' AS camada_destino,
       CASE WHEN registros_validos = 0 THEN 'QUARANTINED'
            WHEN registros_validos >= 2 AND canceladas = registros_validos THEN 'FAILED'
            WHEN registros_lidos > registros_validos THEN 'REPROCESSED' ELSE 'PROCESSED' END AS status,
       registros_lidos, registros_validos, registros_lidos - registros_validos AS registros_invalidos,
       '1.0.0' AS pipeline_version,
       data_referencia + INTERVAL 20 HOUR AS processed_at,
       data_referencia + INTERVAL 20 HOUR + to_minutes(registros_lidos) AS updated_at
FROM (
  SELECT *, CASE turno WHEN 'MANHA' THEN 1 WHEN 'TARDE' THEN 2 ELSE 3 END AS ordem,
         'raw/vendas/loja=loja_' || loja_id || strftime(data_referencia, '/ano=%Y/mes=%m/dia=%d/vendas_')
           || loja_id || strftime(data_referencia, '_%Y%m%d_') || lower(turno) || '.json' AS file_path
  FROM (
    SELECT l.loja_id, l.data_referencia, l.turno, l.registros_lidos,
           COALESCE(v.validos, 0) AS registros_validos, v.canceladas
    FROM (SELECT loja_id, data AS data_referencia, turno, COUNT(*) AS registros_lidos FROM bronze GROUP BY ALL) l
    LEFT JOIN (SELECT loja_id, data AS data_referencia, turno, COUNT(*) AS validos,
                      COUNT(*) FILTER (WHERE status = 'CANCELADA') AS canceladas FROM fato GROUP BY ALL) v
      USING (loja_id, data_referencia, turno)))
"""

PARTES["auditoria"] = """
SELECT CAST(strftime(data_referencia, '%Y%m%d') AS BIGINT) * 10 + ordem AS audit_id, 'vendas_diario' AS dag_id,
       'diario_' || strftime(data_referencia, '%Y%m%d') AS run_id, task_id, data_referencia, status,
       lidos AS registros_lidos, validos AS registros_validos,
       CASE WHEN task_id = 'validar_qualidade' THEN invalidos ELSE 0 END AS registros_invalidos,
       CASE WHEN task_id = 'carregar_datawarehouse' THEN validos ELSE 0 END AS registros_inseridos,
       CASE WHEN task_id = 'carregar_datawarehouse' THEN invalidos ELSE 0 END AS registros_ignorados,
       CAST(lidos * ordem * CAST(0.25 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS duracao_segundos,
       'Tarefa ' || task_id || ' finalizada com status ' || status AS mensagem,
       data_referencia + INTERVAL 30 HOUR + to_minutes(ordem * 10) AS created_at
FROM (
  SELECT d.*, t.*, CASE WHEN task_id = 'carregar_datawarehouse' AND falhas > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
  FROM (SELECT data_referencia, CAST(SUM(registros_lidos) AS BIGINT) AS lidos,
               CAST(SUM(registros_validos) AS BIGINT) AS validos,
               CAST(SUM(registros_invalidos) AS BIGINT) AS invalidos,
               COUNT(*) FILTER (WHERE status = 'FAILED') AS falhas
        FROM arquivos GROUP BY data_referencia) d,
       (VALUES (1, 'extrair_bronze'), (2, 'validar_qualidade'), (3, 'transformar_silver'),
               (4, 'carregar_datawarehouse')) t(ordem, task_id))
"""

# Views

PARTES["v1"] = """
SELECT ano, mes, SUM(valor_bruto) AS receita_bruta, SUM(valor_liquido) AS receita_liquida,
       SUM(desconto_valor) AS desconto_total, COUNT(DISTINCT id_venda) AS total_pedidos,
       CAST(SUM(valor_liquido) AS DOUBLE) / COUNT(DISTINCT id_venda) AS ticket_medio
FROM concluidas GROUP BY ano, mes
"""

PARTES["v2"] = f"""
SELECT c.ano, c.mes, c.loja_id, l.loja_nome, c.faturamento,
       CAST(RANK() OVER (PARTITION BY c.ano, c.mes ORDER BY c.faturamento DESC) AS INTEGER) AS ranking,
       {pct2("c.faturamento", "c.total")} AS market_share_pct,
       {pct2("c.faturamento - c.anterior", "c.anterior")} AS crescimento_mom
FROM (SELECT *, SUM(faturamento) OVER (PARTITION BY ano, mes) AS total,
             LAG(faturamento) OVER (PARTITION BY loja_id ORDER BY ano, mes) AS anterior FROM loja_mes) c
JOIN dim_loja l USING (loja_id)
"""

PARTES["v3"] = f"""
SELECT ano, mes, loja_id, ticket_medio, ticket_anterior, loja_nome,
       {pct2("ticket_medio - ticket_anterior", "ticket_anterior")} AS variacao_pct
FROM (SELECT *, LAG(ticket_medio) OVER (PARTITION BY loja_id ORDER BY ano, mes) AS ticket_anterior
      FROM (SELECT ano, mes, loja_id, CAST(faturamento AS DOUBLE) / pedidos AS ticket_medio FROM loja_mes))
JOIN dim_loja USING (loja_id)
"""

PARTES["v4"] = f"""
SELECT ano, mes, loja_id, loja_nome, faturamento AS receita, R2(margem) AS margem_pct,
       {pct2("faturamento", "receita_orcada")} AS meta_atingida_pct,
       CAST(RANK() OVER (PARTITION BY ano, mes ORDER BY faturamento DESC) AS INTEGER) AS ranking_receita,
       CAST(RANK() OVER (PARTITION BY ano, mes ORDER BY margem DESC) AS INTEGER) AS ranking_margem
FROM (SELECT *, {pct("margem_bruta", "faturamento")} AS margem FROM loja_mes)
JOIN dim_loja USING (loja_id) JOIN orcamento USING (loja_id, ano, mes)
"""

PARTES["v5"] = f"""
SELECT ano, mes, loja_id, loja_nome, receita_orcada, realizada AS receita_realizada,
       realizada - receita_orcada AS variacao_absoluta,
       {pct2("realizada - receita_orcada", "receita_orcada")} AS variacao_pct,
       CASE WHEN CAST(realizada AS DOUBLE) / NULLIF(CAST(receita_orcada AS DOUBLE), 0) >= 0.95 THEN 'VERDE'
            WHEN CAST(realizada AS DOUBLE) / NULLIF(CAST(receita_orcada AS DOUBLE), 0) >= 0.80 THEN 'AMARELO'
            ELSE 'VERMELHO' END AS status_semaforo
FROM (SELECT o.ano, o.mes, o.loja_id, l.loja_nome, o.receita_orcada, COALESCE(m.faturamento, 0) AS realizada
      FROM orcamento o JOIN dim_loja l USING (loja_id) LEFT JOIN loja_mes m USING (loja_id, ano, mes))
"""

PARTES["v6"] = f"""
SELECT ano, mes, CAST(loja_id AS VARCHAR) AS unidade, {", ".join(DRE_VALORES)}, margem_bruta_pct, margem_ebitda_pct,
       margem_liquida_pct FROM dre
UNION ALL
SELECT ano, mes, 'REDE', {", ".join(f"SUM({v})" for v in DRE_VALORES)},
       {pct("SUM(lucro_bruto)", "SUM(receita_liquida)")}, {pct("SUM(ebitda)", "SUM(receita_liquida)")},
       {pct("SUM(resultado_antes_ir)", "SUM(receita_liquida)")}
FROM dre GROUP BY ano, mes
"""

PARTES["v7"] = f"""
SELECT ano, mes, loja_id, faturamento AS realizado, receita_orcada,
       {pct2("faturamento", "receita_orcada")} AS meta_atingida_pct,
       R2(CAST(faturamento AS DOUBLE) / dias * day(last_day(make_date(ano, mes, 1)))) AS forecast_mes,
       R2(CAST(faturamento AS DOUBLE) / dias * day(last_day(make_date(ano, mes, 1))) * 12) AS run_rate_anual
FROM loja_mes JOIN orcamento USING (loja_id, ano, mes)
"""

PARTES["produto_mes"] = """
SELECT ano, mes, produto_id, produto_nome, categoria, SUM(valor_liquido) AS receita,
       CAST(SUM(quantidade) AS BIGINT) AS volume
FROM concluidas GROUP BY ano, mes, produto_id, produto_nome, categoria
"""

PARTES["v8"] = """
SELECT * FROM (
  SELECT *, CAST(RANK() OVER (PARTITION BY ano, mes ORDER BY receita DESC) AS INTEGER) AS ranking_receita,
         CAST(RANK() OVER (PARTITION BY ano, mes ORDER BY volume DESC) AS INTEGER) AS ranking_volume
  FROM produto_mes)
WHERE ranking_receita <= 10 OR ranking_volume <= 10
"""

PARTES["v9"] = """
SELECT ano, mes, canal_venda, forma_pagamento, COUNT(DISTINCT id_venda) AS pedidos, SUM(valor_liquido) AS receita,
       CAST(SUM(valor_liquido) AS DOUBLE) / COUNT(DISTINCT id_venda) AS ticket_medio
FROM concluidas GROUP BY ano, mes, canal_venda, forma_pagamento
"""

PARTES["v10"] = """
SELECT data_referencia, task_id, status, COUNT(*) AS execucoes,
       CAST(SUM(registros_lidos) AS BIGINT) AS registros_lidos,
       CAST(SUM(registros_validos) AS BIGINT) AS registros_validos,
       CAST(SUM(registros_invalidos) AS BIGINT) AS registros_invalidos, MAX(created_at) AS ultima_execucao
FROM auditoria GROUP BY data_referencia, task_id, status
"""

# Series and forecasts

PARTES["ultimo_mes"] = "SELECT ano, mes FROM fato GROUP BY ano, mes ORDER BY ano DESC, mes DESC LIMIT 1"
PARTES["ultima"] = "SELECT MAX(make_date(ano, mes, 1)) AS ultima FROM loja_mes"

PARTES["dre_mes"] = f"""
SELECT ano, mes, SUM(ebitda) AS ebitda, {pct("SUM(ebitda)", "SUM(receita_liquida)")} AS margem_ebitda_pct
FROM dre GROUP BY ano, mes
"""

PARTES["rede_mes"] = f"""
SELECT strftime(make_date(f.ano, f.mes, 1), '%Y-%m') AS competencia, f.ano, f.mes, f.receita_liquida, f.ticket_medio,
       f.total_pedidos, COALESCE(d.ebitda, 0) AS ebitda, COALESCE(d.margem_ebitda_pct, 0) AS margem_ebitda_pct,
       COALESCE(s.cancelamento_pct, 0) AS cancelamento_pct
FROM v1 f LEFT JOIN dre_mes d USING (ano, mes)
LEFT JOIN (SELECT ano, mes, {pct("SUM(canceladas)", "SUM(registros)")} AS cancelamento_pct
           FROM status_mes GROUP BY ano, mes) s USING (ano, mes)
"""

PARTES["serie_loja"] = f"""
SELECT strftime(make_date(f.ano, f.mes, 1), '%Y-%m') AS competencia, f.ano, f.mes, f.loja_id, f.loja_nome,
       f.faturamento AS receita, f.market_share_pct, f.crescimento_mom, t.ticket_medio, r.margem_pct, m.receita_orcada,
       CASE WHEN m.receita_orcada = 0 THEN 0 ELSE {pct("f.faturamento", "m.receita_orcada")} END AS meta_atingida_pct,
       COALESCE(i.forecast_mes, CAST(f.faturamento AS DOUBLE)) AS forecast_mes
FROM v2 f JOIN v3 t USING (ano, mes, loja_id) JOIN v4 r USING (ano, mes, loja_id)
JOIN v5 m USING (ano, mes, loja_id) LEFT JOIN v7 i USING (ano, mes, loja_id)
"""

PARTES["tendencia"] = """
SELECT loja_id, COALESCE(GREATEST(-0.15, LEAST(0.15, AVG(variacao) FILTER (WHERE n <= 3))), 0) AS tendencia FROM (
  SELECT loja_id, variacao, ROW_NUMBER() OVER (PARTITION BY loja_id ORDER BY competencia DESC) AS n FROM (
    SELECT loja_id, competencia, CAST(receita AS DOUBLE)
             / LAG(CAST(receita AS DOUBLE)) OVER (PARTITION BY loja_id ORDER BY competencia) - 1 AS variacao
    FROM serie_loja, ultima WHERE receita > 0 AND competencia <> strftime(ultima, '%Y-%m'))
  WHERE variacao IS NOT NULL)
GROUP BY loja_id
"""

PARTES["gerencial"] = f"""
SELECT competencia, loja_id, loja_nome, passo, R2(base) AS forecast_base, R2(ajustado) AS forecast_ajustado,
       R2(orcado) AS receita_orcada, R2(ajustado - orcado) AS variacao_orcamento,
       {pct2("ajustado", "orcado")} AS meta_atingida_pct, R2(tendencia * 100) AS tendencia_pct
FROM (
  SELECT strftime(futuro, '%Y-%m') AS competencia, a.loja_id, loja_nome, passo, tendencia,
         valor_base * POW(1 + tendencia, decorridos) AS base,
         valor_base * POW(1 + tendencia, decorridos) * (1 + CAST(5 AS DOUBLE) / 100) AS ajustado,
         CAST(o.receita_orcada AS DOUBLE) AS orcado
  FROM (
    SELECT s.loja_id, loja_nome, COALESCE(tendencia, 0) AS tendencia, CAST(passo AS INTEGER) AS passo,
           CASE WHEN forecast_mes <> 0 THEN forecast_mes ELSE CAST(receita AS DOUBLE) END AS valor_base,
           CAST(ultima + to_months(CAST(passo AS INTEGER)) AS DATE) AS futuro,
           date_diff('month', make_date(ano, mes, 1), CAST(ultima + to_months(CAST(passo AS INTEGER)) AS DATE))
             AS decorridos
    FROM (SELECT * FROM serie_loja QUALIFY ROW_NUMBER() OVER (PARTITION BY loja_id ORDER BY competencia DESC) = 1) s
    LEFT JOIN tendencia t USING (loja_id), ultima, generate_series(1, 6) g(passo)) a
  LEFT JOIN orcamento o ON o.loja_id = a.loja_id AND o.ano = year(futuro) AND o.mes = month(futuro))
"""

PARTES["pontos"] = """
SELECT serie, competencia, y, CAST(ROW_NUMBER() OVER (PARTITION BY serie ORDER BY competencia) - 1 AS DOUBLE) AS x,
       COUNT(*) OVER (PARTITION BY serie) AS n
FROM (SELECT loja_id AS serie, competencia, CAST(receita AS DOUBLE) AS y FROM serie_loja
      UNION ALL
      SELECT 0, strftime(make_date(ano, mes, 1), '%Y-%m'), CAST(SUM(faturamento) AS DOUBLE)
      FROM loja_mes GROUP BY ano, mes)
"""

PARTES["ajuste"] = """
SELECT serie, COUNT(*) AS n, COALESCE(regr_slope(y, x), 0) AS inclinacao,
       COALESCE(regr_intercept(y, x), MAX(y)) AS intercepto,
       SQRT(GREATEST(0, regr_syy(y, x) - COALESCE(regr_sxy(y, x) ** 2 / NULLIF(regr_sxx(y, x), 0), 0)) / COUNT(*))
         AS rmse,
       GREATEST(0, LEAST(1, COALESCE(regr_r2(y, x), 1))) AS r2, arg_max(y, x) AS ultimo
FROM pontos GROUP BY serie
"""

PARTES["entidades"] = """
SELECT 0 AS serie, 'Rede' AS entidade UNION ALL SELECT loja_id, loja_nome FROM dim_loja
"""

PARTES["modelos"] = """
SELECT serie, entidade, R2(intercepto) AS intercepto, R2(inclinacao) AS coeficiente_mensal,
       R2(COALESCE(inclinacao / NULLIF(ultimo, 0) * 100, 0)) AS tendencia_mensal_pct, R2(rmse) AS rmse,
       CAST(ROUND(CAST(r2 AS DECIMAL(38,6)), 4) AS DOUBLE) AS r2, n AS observacoes_treino
FROM ajuste JOIN entidades USING (serie)
"""

PARTES["ml"] = """
SELECT serie, entidade, passo, competencia, R2(previsto) AS previsao,
       R2(GREATEST(0, previsto - margem)) AS limite_inferior, R2(previsto + margem) AS limite_superior
FROM (
  SELECT serie, entidade, CAST(passo AS INTEGER) AS passo,
         strftime(ultima + to_months(CAST(passo AS INTEGER)), '%Y-%m') AS competencia,
         GREATEST(0, intercepto + inclinacao * (n - 1 + passo)) AS previsto,
         CAST(1.96 AS DOUBLE) * rmse * SQRT(1 + CAST(passo AS DOUBLE) / n) AS margem
  FROM ajuste JOIN entidades USING (serie), ultima, generate_series(1, 6) g(passo))
"""

PARTES["teste"] = f"""
SELECT serie, entidade, competencia, R2(y) AS realizado, R2(previsto) AS previsto,
       R2(previsto - y) AS erro_absoluto, {pct2("abs(previsto - y)", "y")} AS erro_percentual_abs
FROM (
  SELECT p.serie, entidade, p.competencia, p.y, GREATEST(0, t.a + t.b * p.x) AS previsto
  FROM pontos p JOIN entidades USING (serie)
  JOIN (SELECT serie, COALESCE(regr_slope(y, x), 0) AS b, COALESCE(regr_intercept(y, x), MAX(y)) AS a
        FROM pontos WHERE n >= 3 AND x < n - 1 GROUP BY serie) t USING (serie)
  WHERE p.n >= 3 AND p.x = p.n - 1)
"""

PARTES["margem_rede"] = """
SELECT COALESCE(AVG(margem_ebitda_pct) FILTER (WHERE margem_ebitda_pct <> 0), 0) AS margem
FROM (SELECT COALESCE(margem_ebitda_pct, 0) AS margem_ebitda_pct FROM (SELECT DISTINCT ano, mes FROM loja_mes)
      LEFT JOIN dre_mes USING (ano, mes) ORDER BY ano DESC, mes DESC LIMIT 3)
"""

PARTES["gerencial_rede"] = f"""
SELECT competencia, passo, forecast_base, forecast_ajustado, receita_orcada,
       R2(forecast_ajustado - receita_orcada) AS variacao_orcamento,
       {pct2("forecast_ajustado", "receita_orcada")} AS meta_atingida_pct,
       R2(forecast_ajustado * margem / 100) AS ebitda_estimado, R2(margem) AS margem_ebitda_referencia_pct
FROM (SELECT competencia, passo, CAST(SUM(CAST(forecast_base AS DECIMAL(18,2))) AS DOUBLE) AS forecast_base,
             CAST(SUM(CAST(forecast_ajustado AS DECIMAL(18,2))) AS DOUBLE) AS forecast_ajustado,
             CAST(SUM(CAST(receita_orcada AS DECIMAL(18,2))) AS DOUBLE) AS receita_orcada
      FROM gerencial GROUP BY competencia, passo), margem_rede
"""

# Quality status

_TAXA = """CASE WHEN COALESCE({l}, 0) <= 0 THEN 100 ELSE R2(GREATEST(0, (CAST({l} AS DOUBLE) - {i}) / {l} * 100)) END"""


def aprovacao(lidos: str, ruins: str) -> str:
    return _TAXA.format(l=lidos, i=ruins)


PARTES["resumo_qualidade"] = f"""
SELECT *, CAST({aprovacao("registros_lidos", "registros_invalidos")} AS DOUBLE) AS taxa_aprovacao,
       CAST({aprovacao("total_execucoes", "execucoes_falha")} AS DOUBLE) AS taxa_sucesso_execucoes,
       GREATEST(registros_invalidos, rejeicoes_auditadas) AS total_rejeicoes
FROM (
  SELECT COUNT(*) AS total_arquivos, COUNT(*) FILTER (WHERE status = 'PROCESSED') AS processados,
         COUNT(*) FILTER (WHERE status = 'REPROCESSED') AS reprocessados,
         COUNT(*) FILTER (WHERE status = 'FAILED') AS falhas_arquivo,
         COUNT(*) FILTER (WHERE status = 'QUARANTINED') AS quarentenados,
         CAST(SUM(registros_lidos) AS BIGINT) AS registros_lidos,
         CAST(SUM(registros_validos) AS BIGINT) AS registros_validos,
         CAST(SUM(registros_invalidos) AS BIGINT) AS registros_invalidos,
         MAX(updated_at) AS ultima_atualizacao_arquivo, MAX(data_referencia) AS ultima_data_referencia
  FROM arquivos),
 (SELECT COUNT(*) AS total_execucoes, COUNT(*) FILTER (WHERE status = 'SUCCESS') AS execucoes_sucesso,
         COUNT(*) FILTER (WHERE status = 'FAILED') AS execucoes_falha,
         CAST(SUM(registros_lidos) AS BIGINT) AS registros_auditados,
         CAST(SUM(registros_invalidos) AS BIGINT) AS rejeicoes_auditadas,
         CAST(SUM(duracao_segundos) AS DOUBLE) / COUNT(*) AS duracao_media_segundos,
         MAX(created_at) AS ultima_execucao
  FROM auditoria)
"""

PARTES["cobertura"] = f"""
SELECT loja_id, loja_nome, arquivos, registros_lidos, registros_validos, registros_invalidos, atualizado_em,
       CAST({aprovacao("registros_lidos", "registros_invalidos")} AS DOUBLE) AS taxa_aprovacao
FROM (
  SELECT l.loja_id, l.loja_nome, COUNT(p.file_id) AS arquivos,
         CAST(COALESCE(SUM(p.registros_lidos), 0) AS BIGINT) AS registros_lidos,
         CAST(COALESCE(SUM(p.registros_validos), 0) AS BIGINT) AS registros_validos,
         CAST(COALESCE(SUM(p.registros_invalidos), 0) AS BIGINT) AS registros_invalidos,
         MAX(p.updated_at) AS atualizado_em
  FROM dim_loja l CROSS JOIN (SELECT MAX(data_referencia) AS fim FROM arquivos) u
  LEFT JOIN arquivos p ON p.loja_id = l.loja_id AND p.data_referencia = u.fim
  WHERE l.ativa GROUP BY l.loja_id, l.loja_nome)
"""


def expand(texto: str) -> str:
    """``R2(x)`` is short for rounding a floating value to cents."""
    while (inicio := texto.find("R2(")) >= 0:
        fim, nivel = inicio + 3, 1
        while nivel:
            nivel += {"(": 1, ")": -1}.get(texto[fim], 0)
            fim += 1
        texto = texto[:inicio] + rounded(texto[inicio + 3 : fim - 1]) + texto[fim:]
    return texto


def sql(corpo: str) -> str:
    """``corpo`` with every named subquery it needs, in dependency order."""
    ordem: list[str] = []

    def visitar(texto: str) -> None:
        for nome in PARTES:
            if nome not in ordem and re.search(rf"(?:FROM|JOIN|,)\s+\(?\s*{nome}\b", texto):
                visitar(PARTES[nome])
                ordem.append(nome)

    visitar(corpo)
    partes = ",\n".join(f"{n} AS ({PARTES[n].strip()})" for n in ordem)
    return expand(f"WITH {partes}\n{corpo.strip()}" if ordem else corpo)


def iso_date(coluna: str) -> str:
    return f"strftime({coluna}, '%Y-%m-%d') AS {coluna.split('.')[-1]}"


def iso_time(coluna: str) -> str:
    return f"strftime({coluna}, '%Y-%m-%dT%H:%M:%S') AS {coluna.split('.')[-1]}"


def dbl(*colunas: str) -> str:
    return ", ".join(f"CAST({x} AS DOUBLE) AS {x.split('.')[-1]}" for x in colunas)
