"""Customer funnel, lifetime value, recency/frequency/monetary scores and segments."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.functions.amounts import mean
from dealerlake.functions.customers import normalized_name
from dealerlake.operators.ranks import row_numbers
from dealerlake.sources.bronze import PECA, SERVICO, VEICULO, Bronze


def _customer_rows(b: Bronze, columns: list[str], dt_ini: date, dt_fim: date) -> DataFrame:
    rows = b.transactions(["CLIENTE", *columns], (dt_ini, dt_fim)).filter(F.col("CLIENTE").isNotNull())
    return rows.withColumn("CLIENTE", normalized_name(F.col("CLIENTE")))


def customer_funnel(
    b: Bronze, dt_ini: date = date(2023, 1, 1), dt_fim_exclusive: date = date(2024, 1, 1)
) -> DataFrame:
    """Vehicle buyers of the period, and how many of them had a service or bought parts in it."""

    def has(origin: str):
        return F.max(F.when(F.col("ORIGEM") == origin, 1).otherwise(0))

    by_customer = (
        _customer_rows(b, [], dt_ini, dt_fim_exclusive - timedelta(days=1))
        .groupBy("CLIENTE")
        .agg(has(VEICULO).alias("v"), has(SERVICO).alias("s"), has(PECA).alias("p"))
    )
    bought = F.col("v") == 1
    known = F.col("CLIENTE").isNotNull()
    return by_customer.agg(
        F.count_if(bought).alias("CLIENTES_VEIC"),
        F.count_if(bought & known & (F.col("s") == 1)).alias("COM_SERVICO_POSTERIOR"),
        F.count_if(bought & known & (F.col("p") == 1)).alias("COM_COMPRA_PECAS"),
    )


def customer_ltv(b: Bronze, dt_ini: date, dt_fim: date, top_n: int = 50) -> DataFrame:
    """Transactions, first and last date, revenue and profit of the customers with most revenue."""
    return (
        _customer_rows(b, ["DT", "RECEITA", "LUCRO"], dt_ini, dt_fim)
        .groupBy("CLIENTE")
        .agg(
            F.count("*").alias("TRANSACOES"),
            F.min("DT").alias("PRIMEIRA_DATA"),
            F.max("DT").alias("ULTIMA_DATA"),
            F.sum("RECEITA").alias("RECEITA_TOTAL"),
            F.sum("LUCRO").alias("LUCRO_TOTAL"),
        )
        .orderBy(F.desc_nulls_last("RECEITA_TOTAL"), F.asc_nulls_last("CLIENTE"))
        .limit(top_n)
    )


def rfm_base(b: Bronze, dt_ini: date, dt_fim: date) -> DataFrame:
    """Last date, days since it, transactions and revenue per customer."""
    return (
        _customer_rows(b, ["DT", "RECEITA"], dt_ini, dt_fim)
        .groupBy("CLIENTE")
        .agg(
            F.max("DT").alias("ULTIMA_DATA"),
            F.datediff(F.lit(dt_fim), F.max("DT")).cast("long").alias("RECENCY_DIAS"),
            F.count("*").alias("FREQUENCY"),
            F.sum("RECEITA").alias("MONETARY"),
        )
    )


_METRICS = {"R": "RECENCY_DIAS", "F": "FREQUENCY", "M": "MONETARY"}


def rfm_scores(df: DataFrame) -> DataFrame:
    """Quintile 1..5 of each metric; equal values are told apart by customer name.

    With n customers, place r scores ceil(5 (r - 1) / (n - 1)), at least 1. Recency counts down:
    the most recent fifth scores 5.
    """
    places = row_numbers(df, "CLIENTE", _METRICS)
    score = {
        k: F.greatest(F.lit(1), F.ceil((F.col(f"{k}_PLACE") - 1) * 5 / F.greatest(F.col("n") - 1, F.lit(1)))).cast("int")
        for k in _METRICS
    }
    return places.select(
        *df.columns,
        (F.lit(6) - score["R"]).alias("R_SCORE"),
        score["F"].alias("F_SCORE"),
        score["M"].alias("M_SCORE"),
    )


def rfm_segments(df: DataFrame) -> DataFrame:
    """Segment of each scored customer."""
    recent, frequent, valuable = (F.col(f"{k}_SCORE") >= 4 for k in "RFM")
    # The segment names.
    segment = (
        F.when(recent & frequent & valuable, "VIP")
        .when(recent & frequent, "Crescimento")
        .when(~recent & (frequent | valuable), "Risco")
        .otherwise("Dorminte")
    )
    return df.withColumn("SEGMENTO", segment)


def rfm_segment_summary(df: DataFrame) -> DataFrame:
    """Customers, revenue, mean frequency and mean recency by segment."""
    n = F.count("*")
    return df.groupBy("SEGMENTO").agg(
        F.count("CLIENTE").alias("CLIENTES"),
        F.sum("MONETARY").alias("RECEITA"),
        mean(F.sum("FREQUENCY"), n).alias("FREQ_MEDIA"),
        mean(F.sum("RECENCY_DIAS"), n).alias("RECENCY_MEDIA"),
    )
