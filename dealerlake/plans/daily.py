"""Today against yesterday and the last 30 days, and daily series."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealerlake import schemas as S
from dealerlake.functions.amounts import mean, or_zero, ratio, sum_where
from dealerlake.session import written
from dealerlake.sources.bronze import LINES, PECA, SERVICO, VEICULO, Bronze

# Fixed value: length of the comparison window before the day.
LOOKBACK_DAYS = 30


def last_days(b: Bronze, as_of: date) -> DataFrame:
    """Daily sums of all lines over the day and the 30 before it in one scan, written: at most 93 rows."""
    measures = ("QTD", "RECEITA", "LUCRO")
    rows = b.sums(["DT", *measures], (as_of - timedelta(days=LOOKBACK_DAYS), as_of))
    return written(rows.groupBy("ORIGEM", F.col("DT").cast("date").alias("DIA")).agg(*[F.sum(m).alias(m) for m in measures]))


def _daily(b: Bronze, origin: str, as_of: date, days: DataFrame | None = None) -> DataFrame:
    """Daily sums of one line over the day and the 30 before it, at most 31 rows; from ``last_days`` if given."""
    if days is not None:
        return days.filter(F.col("ORIGEM") == origin).drop("ORIGEM")
    line = LINES[origin]
    source = {m: line.columns[m] for m in ("DT", "QTD", "RECEITA", "LUCRO")}
    period = (as_of - timedelta(days=LOOKBACK_DAYS), as_of)
    return (
        b.table(line.table, list(source.values()), period)
        .groupBy(F.col(source["DT"]).cast("date").alias("DIA"))
        .agg(*[F.sum(or_zero(F.col(source[m]))).alias(m) for m in ("QTD", "RECEITA", "LUCRO")])
    )


def _on(day: date, measure: str) -> Column:
    return F.sum(F.when(F.col("DIA") == F.lit(day), F.col(measure)))


def _mean_before(as_of: date, value: Column) -> Column:
    """Mean over the earlier days that have rows."""
    earlier = F.col("DIA") < F.lit(as_of)
    return mean(sum_where(earlier, value), F.count(F.when(earlier, value)))


def daily_vehicles(b: Bronze, as_of: date, days: DataFrame | None = None) -> DataFrame:
    """Units and revenue of vehicles: the day, the day before, mean of the last 30 days with sales."""
    yesterday = as_of - timedelta(days=1)
    return _daily(b, VEICULO, as_of, days).agg(
        _on(as_of, "QTD").alias("QTD_HOJE"),
        _on(yesterday, "QTD").alias("QTD_ONTEM"),
        _mean_before(as_of, F.col("QTD")).alias("QTD_MEDIA_30D"),
        _on(as_of, "RECEITA").alias("RECEITA_HOJE"),
        _on(yesterday, "RECEITA").alias("RECEITA_ONTEM"),
        _mean_before(as_of, F.col("RECEITA")).alias("RECEITA_MEDIA_30D"),
    )


def daily_parts(b: Bronze, as_of: date, days: DataFrame | None = None) -> DataFrame:
    """Units, revenue and margin of parts: the day against the mean of the last 30 days with sales.

    The mean margin is the plain mean of the daily margins, each taken to 12 decimals so that the
    sum does not depend on the order of the days.
    """
    days = _daily(b, PECA, as_of, days).withColumn("MARGEM", ratio(F.col("LUCRO"), F.col("RECEITA")).cast("decimal(24,12)"))
    return days.agg(
        _on(as_of, "QTD").alias("QTD_HOJE"),
        _on(as_of, "RECEITA").alias("RECEITA_HOJE"),
        _on(as_of, "LUCRO").alias("LUCRO_HOJE"),
        _mean_before(as_of, F.col("QTD")).alias("QTD_MEDIA_30D"),
        _mean_before(as_of, F.col("RECEITA")).alias("RECEITA_MEDIA_30D"),
        _mean_before(as_of, F.col("MARGEM")).alias("MARGEM_MEDIA_30D"),
    ).select(
        "QTD_HOJE",
        "RECEITA_HOJE",
        ratio(F.col("LUCRO_HOJE"), F.col("RECEITA_HOJE")).alias("MARGEM_HOJE"),
        "QTD_MEDIA_30D",
        "RECEITA_MEDIA_30D",
        "MARGEM_MEDIA_30D",
    )


def top10_parts_today(b: Bronze, as_of: date, top_n: int = 10) -> DataFrame:
    """Best-selling parts of the day."""
    return (
        b.table(S.HIST_VENDAS_PECAS, ["DESCRICAO_PECA", "QTDE_VENDIDA", "VALOR_VENDA"], (as_of, as_of))
        .groupBy("DESCRICAO_PECA")
        .agg(
            F.sum(or_zero(F.col("QTDE_VENDIDA"))).alias("QTD"),
            F.sum(or_zero(F.col("VALOR_VENDA"))).alias("RECEITA"),
        )
        .orderBy(F.desc_nulls_last("QTD"), F.desc_nulls_last("RECEITA"), F.asc_nulls_last("DESCRICAO_PECA"))
        .limit(top_n)
    )


def daily_services(b: Bronze, as_of: date, days: DataFrame | None = None) -> DataFrame:
    """Services: the day against the mean of the last 30 days with services."""
    return _daily(b, SERVICO, as_of, days).agg(
        _on(as_of, "QTD").alias("QTD_HOJE"),
        _mean_before(as_of, F.col("QTD")).alias("QTD_MEDIA_30D"),
        _on(as_of, "RECEITA").alias("RECEITA_HOJE"),
        _mean_before(as_of, F.col("RECEITA")).alias("RECEITA_MEDIA_30D"),
    )


def _series(b: Bronze, origin: str, measure: str, dt_ini: date, dt_fim: date, keys: Sequence[str]) -> DataFrame:
    line = LINES[origin]
    day, value = line.columns["DT"], line.columns[measure]
    return (
        b.table(line.table, [*keys, day, value], (dt_ini, dt_fim))
        .groupBy(*keys, F.col(day).cast("date").alias("DIA"))
        .agg(F.sum(or_zero(F.col(value))).alias("Y"))
        .orderBy(*keys, "DIA")
    )


def series_vehicles_units(b: Bronze, dt_ini: date, dt_fim: date, keys: Sequence[str] = ()) -> DataFrame:
    """Vehicles sold per day, of all or by ``keys``."""
    return _series(b, VEICULO, "QTD", dt_ini, dt_fim, keys)


def series_parts_revenue(b: Bronze, dt_ini: date, dt_fim: date, keys: Sequence[str] = ()) -> DataFrame:
    """Part revenue per day, of all or by ``keys``."""
    return _series(b, PECA, "RECEITA", dt_ini, dt_fim, keys)


def series_services_revenue(b: Bronze, dt_ini: date, dt_fim: date, keys: Sequence[str] = ()) -> DataFrame:
    """Service revenue per day, of all or by ``keys``."""
    return _series(b, SERVICO, "RECEITA", dt_ini, dt_fim, keys)


def series_all_lines(b: Bronze, dt_ini: date, dt_fim: date, keys: Sequence[str] = ()) -> DataFrame:
    """The three series above in one scan, told apart by ORIGEM: units of vehicles, revenue of parts and services."""
    value = F.when(F.col("ORIGEM") == VEICULO, F.col("QTD")).otherwise(F.col("RECEITA"))
    rows = b.sums([*keys, "DT", "QTD", "RECEITA"], (dt_ini, dt_fim))
    return rows.groupBy("ORIGEM", *keys, F.col("DT").cast("date").alias("DIA")).agg(F.sum(value).alias("Y"))
