"""Dense numbers for text keys, kept by month behind a Bloom filter: the ground of mergeable exact distinct counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from balcao.functions.lineage import write_intermediate
from balcao.operators import bloom
from balcao.sources.lake import Lake

c = F.col
MES = ("ano", "mes")
_MESES = [T.StructField("ano", T.IntegerType()), T.StructField("mes", T.IntegerType())]
FILTRO = T.StructType([T.StructField("bloco", T.IntegerType()), T.StructField("bits", bloom.TIPO_BITS), *_MESES])
INDICE = T.StructType([T.StructField("chave", T.StringType()), T.StructField("numero", T.LongType()), *_MESES])


def months_of(df: DataFrame) -> list[tuple[int, int]]:
    """Distinct (year, month) pairs: a list of calendar months, whatever the size of the table."""
    return sorted((r["ano"], r["mes"]) for r in df.select(*MES).distinct().collect())


def consecutive(df: DataFrame, primeiro: int, nome: str = "numero") -> DataFrame:
    """Rows with consecutive numbers from ``primeiro`` on, without sorting them in one task.

    Rows are written with their task and their place in it, which no later failure can change; tasks are then offset by the
    rows before them.
    """
    # The identifier is unique and ascending inside a task; its upper bits are the task.
    escritas = write_intermediate(df.withColumn("_i", F.monotonically_increasing_id()).withColumn("_t", F.shiftright("_i", 33)), "numeradas")
    tarefas = escritas.groupBy("_t").agg(F.count("*").alias("_n"))
    antes = Window.orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    inicio = tarefas.select("_t", F.coalesce(F.sum("_n").over(antes), F.lit(0)).alias("_o"))
    no_lugar = c("_i") - F.shiftleft("_t", 33)
    # One row for each writing task.
    return escritas.join(F.broadcast(inicio), "_t").withColumn(nome, c("_o") + no_lugar + F.lit(primeiro)).drop("_t", "_i", "_o")


def numbered(lake: Lake, tabela: str, chaves: DataFrame, blocos: int) -> DataFrame:
    """(chave, numero) of the given keys: (chave, ano, mes) rows, the month telling where a new key is filed.

    A key keeps its number for ever. Only months whose filter may hold one of the keys are read; keys that none holds get the next
    numbers. Must run inside a transaction of the lake. Keys are always merged: their packed size in files says little about the memory
    that a broadcast of them would take.
    """
    chaves = write_intermediate(chaves.groupBy("chave").agg(F.min(F.struct(*MES)).alias("m")).select("chave", "m.ano", "m.mes"), "chaves")
    filtros = lake.read(f"{tabela}_filtro", FILTRO)
    candidatos = months_of(bloom.probe(chaves, ["chave"], filtros, MES, blocos))
    guardadas = lake.read_months(tabela, candidatos, INDICE).select("chave", "numero")
    conhecidas = write_intermediate(chaves.join(guardadas.hint("merge"), "chave"), "conhecidas")
    contadores = lake.manifest().setdefault("contadores", {})
    # Numbers follow the months, so a month's orders lie in few bitmaps instead of a bit or two in every one.
    ineditas = chaves.join(conhecidas.hint("merge"), "chave", "left_anti").repartitionByRange(*MES, "chave").sortWithinPartitions(*MES)
    novas = consecutive(ineditas, contadores.get(tabela, 0) + 1)
    novas = lake.append_partitions(novas.select(*INDICE.fieldNames()), tabela, MES)
    contadores[tabela] = contadores.get(tabela, 0) + novas.count()
    meses = months_of(novas)
    if meses:
        acrescimo = bloom.build(novas, ["chave"], MES, blocos)
        anteriores = lake.read_months(f"{tabela}_filtro", meses, FILTRO)
        lake.replace_months(bloom.merge(anteriores, acrescimo.select(*FILTRO.fieldNames()), MES).select(*FILTRO.fieldNames()), f"{tabela}_filtro", meses)
    return conhecidas.select("chave", "numero").unionByName(novas.select("chave", "numero"))


def by_bucket(vendas: DataFrame, *grupo: str) -> DataFrame:
    """Rows brought together by group and bitmap. A bitmap has 4 KB however few bits are set, so numbers are shuffled, never the
    bitmaps that each task would make of them."""
    return vendas.withColumn("balde", F.bitmap_bucket_number("numero")).repartition(*grupo, "balde")


def order_bits(vendas: DataFrame, *grupo: str) -> DataFrame:
    """Bitmaps of the numbers of each group, one row for each 32,768 of them that occur."""
    return by_bucket(vendas, *grupo).groupBy(*grupo, "balde").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("numero")).alias("numeros")
    )


def merged_bits(bits: DataFrame, *grupo: str) -> DataFrame:
    """Union of the bitmaps of each group."""
    return bits.groupBy(*grupo, "balde").agg(F.bitmap_or_agg("numeros").alias("numeros"))


def counted(bits: DataFrame, *grupo: str, nome: str = "pedidos") -> DataFrame:
    """Distinct numbers of each group."""
    return merged_bits(bits, *grupo).groupBy(*grupo).agg(F.sum(F.bitmap_count("numeros")).alias(nome))
