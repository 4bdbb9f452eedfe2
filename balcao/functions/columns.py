"""Column expressions used across the plans. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from balcao.params import PADRAO, Params


def ratio(num: Column, den: Column) -> Column:
    """Division that yields NULL for a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct(num: Column, den: Column) -> Column:
    return ratio(num, den) * F.lit(100.0)


def rounded(valor: Column, casas: int = 2) -> Column:
    """Half-up rounding of a floating value. Six decimal places are fixed first, so a binary error in the last digits
    cannot turn an exact half the wrong way."""
    return F.round(valor.cast("decimal(38,6)"), casas).cast("double")


def pct2(num: Column, den: Column) -> Column:
    return rounded(pct(num, den))


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0).cast("int"))


def money(col: Column) -> Column:
    """Half-up rounding to cents."""
    return F.round(col.cast("decimal(38,6)"), 2).cast("decimal(15,2)")


def percent_or_zero(num: Column, base: Column) -> Column:
    """Percentage with two decimals, zero when the base is not positive."""
    return F.when(base > 0, pct2(num, base)).otherwise(F.lit(0.0))


def approval_rate(read: Column, invalid: Column) -> Column:
    """Share of accepted records; an empty run counts as fully approved and the floor is zero."""
    lidos, ruins = F.coalesce(read, F.lit(0)).cast("double"), F.coalesce(invalid, F.lit(0)).cast("double")
    taxa = rounded(F.greatest(F.lit(0.0), F.try_divide(lidos - ruins, lidos) * 100.0))
    return F.when(lidos <= 0, F.lit(100.0)).otherwise(taxa)


def quality_score(total: Column, failed: Column) -> Column:
    """Approval percentage of a validation run; zero rows score zero."""
    return F.when(total == 0, F.lit(0.0)).otherwise(pct2(total - failed, total))


def traffic_light(atingido: Column, params: Params = PADRAO) -> Column:
    """A NULL attainment (no budget) is red."""
    return (
        F.when(atingido >= params.meta_verde, "VERDE")
        .when(atingido >= params.meta_amarela, "AMARELO")
        .otherwise("VERMELHO")
    )


def completed(valor: Column) -> Column:
    """Value of a completed sale, NULL otherwise."""
    return F.when(F.col("status") == "CONCLUIDA", valor)


# Calendar


def month_start(ano: Column, mes: Column) -> Column:
    return F.make_date(ano, mes, F.lit(1))


def month_label(ano: Column, mes: Column) -> Column:
    return F.date_format(month_start(ano, mes), "yyyy-MM")


def label_to_date(competencia: Column) -> Column:
    return F.to_date(F.concat(competencia, F.lit("-01")))


def shift_month(competencia: Column, meses: Column | int) -> Column:
    return F.date_format(F.add_months(label_to_date(competencia), meses), "yyyy-MM")


def month_distance(inicio: Column, fim: Column) -> Column:
    a, b = label_to_date(inicio), label_to_date(fim)
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def days_in_month(ano: Column, mes: Column) -> Column:
    return F.day(F.last_day(month_start(ano, mes)))


def day_period(ts: Column) -> Column:
    hora = F.hour(ts)
    return (
        F.when(hora.between(6, 11), "MANHA")
        .when(hora.between(12, 17), "TARDE")
        .when(hora.between(18, 22), "NOITE")
        .otherwise("MADRUGADA")
    )


def calendar_columns(df: DataFrame, origem: str = "data_venda") -> DataFrame:
    """Calendar attributes; the week is the ISO week, the year stays the calendar year."""
    ts = F.col(origem)
    mes = F.month(ts)
    return df.withColumns(
        {
            "data_sk": F.date_format(ts, "yyyyMMdd").cast("int"),
            "ano": F.year(ts),
            "mes": mes,
            "dia": F.day(ts),
            "trimestre": F.quarter(ts),
            "semestre": F.when(mes <= 6, 1).otherwise(2),
            "dia_semana": F.weekday(ts) + 1,
            "semana_ano": F.weekofyear(ts),
            "periodo": day_period(ts),
        }
    )


def window_start(as_of: Column, dias: int) -> Column:
    """First date of a window of ``dias`` days that ends on ``as_of``."""
    return F.date_sub(as_of, dias - 1)


def distinct_days(dia: Column) -> Column:
    """Distinct days of one month as a 31-bit mask: no extra shuffle, a four-byte partial buffer."""
    return F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1), dia - 1))).cast("long")


# Text and presentation


def file_name(path: Column) -> Column:
    nome = F.element_at(F.split(F.coalesce(path, F.lit("")), r"[\\/]"), -1)
    return F.when(nome != "", nome).otherwise(F.lit("Arquivo não identificado"))


def status_tone(status: Column) -> Column:
    s = F.lower(F.coalesce(status, F.lit("")))
    return (
        F.when(s.isin("success", "processed", "concluida"), "verde")
        .when(s.isin("reprocessed", "pendente"), "amarelo")
        .otherwise("vermelho")
    )


def one_decimal(col: Column) -> Column:
    """Text with one decimal, rounded half-up."""
    return F.round(col.cast("decimal(38,6)"), 1).cast("string")


def metric_label(tipo: Column, valor: Column) -> Column:
    """Percentages with one decimal and a comma; other numbers with up to three decimals and dots between thousands."""
    percentuais = ("META", "RECEITA", "MARGEM", "CANCELAMENTO", "FORECAST")
    return (
        F.when(valor.isNull(), "Monitoramento")
        .when(tipo.isin(*percentuais), F.concat(F.translate(one_decimal(valor), ".", ","), F.lit("%")))
        .otherwise(F.translate(F.call_function("format_number", valor, F.lit("#,##0.###")), ".,", ",."))
    )


#: Every character with the Unicode property White_Space.
ESPACOS = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def text(valor: Column) -> Column:
    """Text without white space of any kind at both ends."""
    return F.btrim(valor, F.lit(ESPACOS))


def once(df: DataFrame, nome: str, valor: Column) -> DataFrame:
    """Add a costly column that later filters and projections reuse: the optimizer does not copy an expression out of
    a generator, so it is evaluated one time per row."""
    return df.select("*", F.explode(F.array(valor)).alias(nome))


def serialize(df: DataFrame) -> DataFrame:
    """Interchange form: decimals as doubles, dates and timestamps as ISO text, with microseconds where there are any."""
    saida = []
    for campo in df.schema.fields:
        col = F.col(f"`{campo.name}`")
        if isinstance(campo.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(campo.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(campo.dataType, (T.TimestampType, T.TimestampNTZType)):
            inteiro = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
            col = F.when(F.date_format(col, "SSSSSS") == "000000", inteiro).otherwise(F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        saida.append(col.alias(campo.name))
    return df.select(*saida)
