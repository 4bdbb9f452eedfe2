"""Runs registered queries and their reference SQL side by side: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

from balcao.session import build_session
from checks.registry import QUERIES, run

TABELAS = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABELAS.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows with columns in name order, NULLs unified, sorted."""
    linhas = []
    for linha in df[sorted(df.columns)].itertuples(index=False, name=None):
        linhas.append(tuple(None if pd.isna(v) else (f"{float(v):.9g}" if isinstance(v, float) else str(v)) for v in linha))
    return sorted(linhas, key=repr)


KINDS = {"int": "int32", "bigint": "int64", "double": "float64", "string": "object", "boolean": "bool"}


def types_differ(spark_df, oraculo: duckdb.DuckDBPyRelation) -> list[str]:
    nomes = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    lado = {n: nomes.get(str(t), str(t)) for n, t in zip(oraculo.columns, oraculo.types, strict=True)}
    meu = dict(spark_df.dtypes)
    return [f"{n}: {meu.get(n)} vs {lado.get(n)}" for n in sorted(set(meu) | set(lado)) if meu.get(n) != lado.get(n)]


def check(spark, con, nome: str, sf_dir: str) -> tuple[bool, str]:
    inicio = time.time()
    df = run(nome, spark, sf_dir)
    meu = df.toPandas()
    gasto = time.time() - inicio
    oraculo = QUERIES[nome].oracle
    if oraculo is None:
        return True, f"{len(meu)} rows, no SQL, {gasto:.1f}s"
    rel = con.sql(oraculo)
    esperado = rel.df()
    problemas = types_differ(df, rel)
    a, b = canonical(meu) if not set(meu.columns) ^ set(esperado.columns) else [], canonical(esperado)
    if a != b:
        so_a, so_b = sorted(set(a) - set(b))[:2] if a else [], sorted(set(b) - set(a))[:2]
        problemas.append(f"values differ: {len(meu)} vs {len(esperado)} rows\n   spark {so_a}\n   sql   {so_b}")
    return not problemas, f"{len(meu)} rows, {gasto:.1f}s " + "; ".join(problemas)


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session(
        master=f"local[{os.environ.get('BENCH_CPUS', '8')}]", spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    ruins = 0
    for nome in QUERIES:
        if args and not any(nome.startswith(a) for a in args):
            continue
        try:
            ok, texto = check(spark, con, nome, sf_dir)
        except Exception as erro:  # one broken query must not hide the others
            ok, texto = False, f"{type(erro).__name__}: {str(erro)[:600]}"
        ruins += not ok
        print(("ok   " if ok else "FAIL ") + nome, texto, flush=True)
    print(f"{ruins} failures")


if __name__ == "__main__":
    main()
