"""Bloom filters of keys: which groups of a large table can hold a key, without reading their keys.

A filter is a table (group columns, bloco, bits): a key marks one bit in each of the ``PALAVRAS`` words of one line, and only lines
that hold a key are stored, so a filter never has more rows than keys. A probe reads one short line for each group and key. A missing
bit proves that the key is not in the group; full filters cost reading, never results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

c = F.col
#: Bits of a block; a block is cut into lines of eight 32-bit words.
BITS = 32_768
PALAVRAS = 8
LINHAS = BITS // (32 * PALAVRAS)
TIPO_BITS = T.StructType([T.StructField(f"p{i}", T.IntegerType()) for i in range(PALAVRAS)])


def _line(chave: Sequence[str], blocos: int) -> Column:
    return F.pmod(F.xxhash64(*chave), F.lit(blocos * LINHAS)).cast("int")


def _mark(i: int) -> Column:
    """Bit of word ``i``: five bits of the second hash ``_h`` choose it."""
    return F.call_function("shiftleft", F.lit(1), F.shiftrightunsigned("_h", 5 * i).bitwiseAND(F.lit(31)).cast("int"))


def _hashed(df: DataFrame, chave: Sequence[str], blocos: int) -> DataFrame:
    return df.withColumns({"bloco": _line(chave, blocos), "_h": F.xxhash64(F.lit(1), *chave)})


def _united(df: DataFrame, grupo: Sequence[str], palavra: Sequence[Column]) -> DataFrame:
    palavras = [F.bit_or(p).alias(f"p{i}") for i, p in enumerate(palavra)]
    return df.groupBy(*grupo, "bloco").agg(*palavras).select(*grupo, "bloco", F.struct(*[f"p{i}" for i in range(PALAVRAS)]).alias("bits"))


def build(df: DataFrame, chave: Sequence[str], grupo: Sequence[str], blocos: int) -> DataFrame:
    """Filter rows of the keys of each group. Rows with equal keys may repeat."""
    return _united(_hashed(df, chave, blocos), grupo, [_mark(i) for i in range(PALAVRAS)])


def merge(filtros: DataFrame, novos: DataFrame, grupo: Sequence[str]) -> DataFrame:
    """Filter of the keys of both."""
    return _united(filtros.unionByName(novos), grupo, [c(f"bits.p{i}") for i in range(PALAVRAS)])


def probe(df: DataFrame, chave: Sequence[str], filtros: DataFrame, grupo: Sequence[str], blocos: int) -> DataFrame:
    """(key, group) of every key that a group may hold. Filters grow with the table and pack well in files, so their size there
    says little: they are always merged, never sent to the driver and to every executor."""
    procuradas = _hashed(df.select(*chave).distinct(), chave, blocos)
    pares = procuradas.join(filtros.hint("merge"), "bloco")
    for i in range(PALAVRAS):
        pares = pares.where(c(f"bits.p{i}").bitwiseAND(_mark(i)) != 0)
    return pares.select(*chave, *grupo)
