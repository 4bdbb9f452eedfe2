"""Times the headline queries and prints one JSON line.

Every run builds a new warehouse object and the cache is cleared, so no query profits from an earlier one.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from balcao.session import build_session  # noqa: E402
from checks.registry import run  # noqa: E402

HEADLINE = (
    "V1_faturamento_mensal",
    "V2_faturamento_por_loja",
    "V4_ranking_lojas",
    "V5_meta_vs_realizado",
    "V6_dre_consolidada",
    "V8_top10_produtos",
    "V9_cohort_canais",
    "V10_pipeline_health",
    "Q15_maior_desconto",
    "Q16_receita_por_segmento",
    "Q17_desempenho_periodo",
    "Q18_ano_contra_ano",
    "E1_kpis_vendas",
    "E3_top_produtos",
    "E5_indicadores_fpa",
    "M1_resumo_do_mes",
    "M11_serie_por_loja",
    "M14_forecast_rede",
    "M18_forecast_ml",
    "M19_resumo_qualidade",
    "K9_central_de_alertas",
    "B8_duplicatas_removidas",
    "C14_falhas_por_regra",
    "A6_vendas_achatadas",
    "L1_merge_de_fatos",
)


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeticoes = int(os.environ.get("BENCH_RUNS", "3"))
    escolhidas = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        app="bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("OFF")
    run("V1_faturamento_mensal", spark, sf_dir).write.format("noop").mode("overwrite").save()
    tempos = {}
    for nome in escolhidas:
        medidas = []
        for _ in range(repeticoes):
            spark.catalog.clearCache()
            inicio = time.perf_counter()
            run(nome, spark, sf_dir).write.format("noop").mode("overwrite").save()
            medidas.append(time.perf_counter() - inicio)
        tempos[nome] = round(statistics.median(medidas), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(tempos.values()), 3), "unit": "sec", "queries": tempos, "sf": sf}
        )
    )


if __name__ == "__main__":
    main()
