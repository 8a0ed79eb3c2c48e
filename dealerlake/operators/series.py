"""Daily series, many at once: gap filling and moving-average forecasts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealerlake.functions.amounts import ratio

AMOUNT = "decimal(38,4)"

# Fixed value: shortest history a forecast is fitted to.
MIN_HISTORY = 10
# Column and percentile of each interval bound.
BOUNDS = {"YHAT_80_LO": 0.10, "YHAT_80_HI": 0.90, "YHAT_95_LO": 0.025, "YHAT_95_HI": 0.975}


def densify_daily(df: DataFrame, dt_ini: date, dt_fim: date, keys: Sequence[str] = ()) -> DataFrame:
    """One row (keys, DIA, Y) per calendar day of the range and series, missing days as 0.

    Each row stretches over the empty days after it (the first one also over those before), so a
    series is filled in place. Without keys an empty input gives all zeros.
    """
    spark = df.sparkSession
    inside = df.filter(F.col("DIA").between(F.lit(dt_ini), F.lit(dt_fim))).select(
        *keys, "DIA", F.col("Y").cast(AMOUNT).alias("Y")
    )
    if not keys:
        zero_day = spark.range(1).select(F.lit(dt_ini).alias("DIA"), F.lit(0).cast(AMOUNT).alias("Y"))
        inside = inside.unionByName(zero_day)
    daily = inside.groupBy(*keys, "DIA").agg(F.sum("Y").cast(AMOUNT).alias("Y"))
    along = _partition(keys).orderBy("DIA")
    first = F.lag("DIA").over(along).isNull()
    until = F.coalesce(F.date_sub(F.lead("DIA").over(along), 1), F.lit(dt_fim))
    return (
        daily.withColumns({"since": F.when(first, F.lit(dt_ini)).otherwise(F.col("DIA")), "until": until})
        .select(*keys, F.col("DIA").alias("seen"), "Y", F.explode(F.sequence("since", "until")).alias("DIA"))
        .select(
            *keys, "DIA", F.when(F.col("DIA") == F.col("seen"), F.col("Y")).otherwise(F.lit(0).cast(AMOUNT)).alias("Y")
        )
    )


def _partition(keys: Sequence[str]):
    # Without keys there is one series: at most one row per day.
    return Window.partitionBy(*(keys or [F.lit(1)]))


def _fitted(df: DataFrame, ma_window: int, keys: Sequence[str]) -> DataFrame:
    """Each day with its one-step forecast and its series' length, last day, means."""
    whole = _partition(keys)
    ordered = whole.orderBy("DIA")
    previous = ordered.rowsBetween(-ma_window, -1)
    y = F.col("Y")
    marked = df.select(*keys, "DIA", F.col("Y").cast(AMOUNT).alias("Y")).withColumns(
        {
            "place": F.row_number().over(ordered),
            "n": F.count("*").over(whole),
            "rolling": F.sum(y).over(previous),
        }
    )
    head, tail = F.col("place") <= ma_window, F.col("place") > F.col("n") - ma_window
    stats = marked.withColumns(
        {
            "last_day": F.max("DIA").over(whole),
            "mean_all": ratio(F.sum(y).over(whole), F.col("n")),
            "mean_head": F.sum(F.when(head, y)).over(whole).cast("double") / F.lit(float(ma_window)),
            "mean_tail": F.sum(F.when(tail, y)).over(whole).cast("double") / F.lit(float(ma_window)),
        }
    )
    fitted = F.when(head, F.col("mean_head")).otherwise(F.col("rolling").cast("double") / F.lit(float(ma_window)))
    enough = F.col("n") >= max(MIN_HISTORY, ma_window + 2)
    return stats.select(
        *keys,
        "place",
        "last_day",
        "n",
        enough.alias("enough"),
        F.when(enough, F.col("mean_tail")).otherwise(F.col("mean_all")).alias("YHAT"),
        F.when(enough, y.cast("double") - fitted).otherwise(F.lit(0.0)).alias("residual"),
    )


def _draw(point: Column, residual: Column) -> Column:
    return F.greatest(F.lit(0.0), point + residual)


def _bound_columns(df: DataFrame, bounds: Column) -> dict[str, Column]:
    """Bounds from their percentile array; a series that is too short keeps its point."""
    return {
        name: F.when(F.col("enough"), bounds[i]).otherwise(F.col("YHAT")).alias(name) for i, name in enumerate(BOUNDS)
    }


def forecast_ma(df: DataFrame, horizon: int, ma_window: int, keys: Sequence[str] = ()) -> DataFrame:
    """Moving-average forecast of each daily series with 80% and 95% intervals.

    The point is the mean of the last ``ma_window`` days, the same for every step. The intervals are
    percentiles of point + residual, floored at 0, over the one-step residuals of the history: what
    a bootstrap of those residuals tends to as its draws grow. A series with fewer than
    max(10, ma_window + 2) days repeats its mean.
    """
    per_series = (
        _fitted(df, ma_window, keys)
        .groupBy(*keys)
        .agg(
            F.max("last_day").alias("last_day"),
            F.max("enough").alias("enough"),
            F.max("YHAT").alias("YHAT"),
            F.percentile(_draw(F.col("YHAT"), F.col("residual")), list(BOUNDS.values())).alias("bounds"),
        )
    )
    return _over_horizon(per_series.filter(F.col("last_day").isNotNull()), horizon).select(
        *keys, "T", _step_day(), "YHAT", *_bound_columns(per_series, F.col("bounds")).values()
    )


def _over_horizon(df: DataFrame, horizon: int) -> DataFrame:
    return df.withColumn("T", F.explode(F.sequence(F.lit(1), F.lit(horizon))))


def _step_day() -> Column:
    return F.date_add("last_day", F.col("T")).alias("DIA")


def forecast_ma_bootstrap(
    df: DataFrame, horizon: int, ma_window: int, keys: Sequence[str] = (), n_sim: int = 1000, seed: int = 42
) -> DataFrame:
    """As :func:`forecast_ma`, with the intervals of each step from ``n_sim`` drawn residuals.

    The residual of a draw is chosen by a hash of (seed, series, simulation, step), so a rerun and a
    retried task draw the same ones.
    """
    fitted = _fitted(df, ma_window, keys)
    # A series brings one residual per day of history.
    residuals = F.array_sort(F.collect_list(F.struct("place", "residual")))
    per_series = fitted.groupBy(*keys).agg(
        F.max("last_day").alias("last_day"),
        F.max("enough").alias("enough"),
        F.max("YHAT").alias("YHAT"),
        F.max("n").alias("n"),
        F.transform(residuals, lambda r: r["residual"]).alias("residuals"),
    )
    text = [F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]]

    def drawn(sim: Column) -> Column:
        draw_id = F.md5(F.concat_ws("|", *text, sim.cast("string"), F.col("T").cast("string")))
        index = F.conv(F.substring(draw_id, 1, 8), 16, 10).cast("bigint") % F.col("n")
        return _draw(F.col("YHAT"), F.element_at("residuals", (index + 1).cast("int")))

    # The draws of a step live in one array of fixed length, so nothing is exploded or shuffled for them.
    draws = F.sort_array(F.transform(F.sequence(F.lit(1), F.lit(n_sim)), drawn))
    per_step = _over_horizon(per_series.filter(F.col("last_day").isNotNull()), horizon).withColumn("draws", draws)
    bounds = F.array(*[_sorted_percentile(F.col("draws"), n_sim, p) for p in BOUNDS.values()])
    return per_step.select(*keys, "T", _step_day(), "YHAT", *_bound_columns(per_step, bounds).values())


def _sorted_percentile(values: Column, size: int, p: float) -> Column:
    """Percentile of a sorted array, linear between its two neighbours."""
    position = (size - 1) * p
    below, above = math.floor(position), math.ceil(position)
    lo, hi = F.element_at(values, below + 1), F.element_at(values, above + 1)
    between = F.lit(above - position) * lo + F.lit(position - below) * hi
    return F.when(lo == hi, lo).otherwise(between)


def forecast_frame(history: DataFrame, forecast: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """History and forecast in one long table, told apart by TIPO."""
    # The two labels.
    past = history.select(*keys, "DIA", F.col("Y").cast("double").alias("VALOR"), F.lit("Histórico").alias("TIPO"))
    future = forecast.select(*keys, "DIA", F.col("YHAT").alias("VALOR"), F.lit("Forecast").alias("TIPO"))
    return past.unionByName(future)


def forecast_intervals(forecast: DataFrame, horizon: int, keys: Sequence[str] = (), last: int = 15) -> DataFrame:
    """Point and interval bounds of the last steps."""
    return forecast.filter(F.col("T") > horizon - last).select(*keys, "DIA", "YHAT", *BOUNDS)
