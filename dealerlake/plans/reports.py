"""What the dashboards derive from query results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealerlake.functions.amounts import or_zero, ratio
from dealerlake.functions.text import int_text, money_text, percent_text


def margins_period(kpis: DataFrame) -> DataFrame:
    """Margin in total and per line on the period KPIs; null where there is no revenue."""
    scopes = {"TOTAL": "MARGEM_TOTAL", "VEIC": "MARGEM_VEIC", "PEC": "MARGEM_PEC", "SRV": "MARGEM_SRV"}
    return kpis.withColumns(
        {name: ratio(or_zero(F.col(f"LUCRO_{k}")), or_zero(F.col(f"RECEITA_{k}"))) for k, name in scopes.items()}
    )


def pnl_vs_goal(pnl: DataFrame, goal: float) -> DataFrame:
    """Profit of the period against its goal, and the margin of each line over the period."""
    lines = ("VEIC", "PEC", "SRV")
    sums = pnl.agg(
        F.sum("LUCRO_TOTAL").alias("LUCRO_TOTAL"),
        *[F.sum(f"{k}_{m}").alias(f"{k}_{m}") for k in lines for m in ("RECEITA", "LUCRO")],
    )
    return sums.select(
        "LUCRO_TOTAL",
        F.lit(float(goal)).alias("META_LUCRO"),
        (F.col("LUCRO_TOTAL").cast("double") - F.lit(float(goal))).alias("DELTA_LUCRO"),
        *[ratio(F.col(f"{k}_LUCRO"), F.col(f"{k}_RECEITA")).alias(f"{k}_MARGEM") for k in lines],
    )


def stock_vs_goal(kpis: DataFrame, vehicle_goal: float, part_goal: float) -> DataFrame:
    """Both stock values against their goals."""

    def delta(name: str, goal: float) -> Column:
        return or_zero(F.col(name)).cast("double") - F.lit(float(goal))

    return kpis.select(
        "ESTOQUE_VEIC_VALOR",
        delta("ESTOQUE_VEIC_VALOR", vehicle_goal).alias("DELTA_ESTOQUE_VEIC"),
        "ESTOQUE_PEC_VALOR",
        delta("ESTOQUE_PEC_VALOR", part_goal).alias("DELTA_ESTOQUE_PEC"),
        or_zero(F.col("ESTOQUE_VEIC_DIAS_MEDIO_ATUAL")).alias("ESTOQUE_VEIC_DIAS_MEDIO_ATUAL"),
    )


def _top(df: DataFrame, metric: str, top_n: int, ties: Sequence[str]) -> DataFrame:
    ordered = df.filter(F.col(metric).isNotNull()).orderBy(F.desc(metric), *[F.asc_nulls_last(t) for t in ties])
    return ordered.limit(top_n)


def top_roi(roi: DataFrame, top_n: int = 20) -> DataFrame:
    """Branches with the highest ROI; those without capital are left out."""
    return _top(roi, "ROI_ESTOQUE", top_n, ["COD_FILIAL", "NOME_FILIAL"])


def top_turnover(turnover: DataFrame, top_n: int = 20) -> DataFrame:
    """Categories with the highest turnover; those without stock are left out."""
    return _top(turnover, "GIRO_PROXY", top_n, ["CATEGORIA_PECA"])


def stock_days_now_vs_history(history: DataFrame, kpis: DataFrame) -> DataFrame:
    """Monthly mean days in stock of sold vehicles beside the current mean, in long form."""
    now = kpis.select(F.lit(None).cast("date").alias("MES"), or_zero(F.col("ESTOQUE_VEIC_DIAS_MEDIO_ATUAL")).alias("now"))
    rows = history.select("MES", F.col("DIAS_MEDIO_VENDA").alias("then")).unionByName(now, allowMissingColumns=True)
    # One row per month of the period plus the current one, so this window is small.
    everywhere = Window.partitionBy(F.lit(1))
    both = rows.withColumn("now", F.max("now").over(everywhere)).filter(F.col("MES").isNotNull())
    # The series names.
    names = (F.lit("Histórico (vendidos)"), F.lit("Atual (estoque)"))
    return both.select(
        "MES", F.stack(F.lit(2), names[0], F.col("then"), names[1], F.col("now")).alias("SERIE", "DIAS")
    )


_BRANCH_TIES = ["COD_CONCESSIONARIA", "COD_FILIAL", "NOME_FILIAL"]


def top_branches_by_roi(performance: DataFrame, top_n: int = 20) -> DataFrame:
    return _top(performance, "ROI_ESTOQUE", top_n, _BRANCH_TIES)


def top_branches_by_profit(performance: DataFrame, top_n: int = 20) -> DataFrame:
    return _top(performance, "LUCRO_TOTAL", top_n, _BRANCH_TIES)


def branch_table(performance: DataFrame, top_n: int = 50) -> DataFrame:
    """Slim comparison table, highest ROI first, branches without capital last."""
    ordered = performance.orderBy(F.desc_nulls_last("ROI_ESTOQUE"), *[F.asc_nulls_last(t) for t in _BRANCH_TIES])
    return ordered.limit(top_n).select("NOME_FILIAL", "RECEITA_TOTAL", "LUCRO_TOTAL", "CAPITAL_ESTOQUE", "ROI_ESTOQUE")


def last_12_months(pnl: DataFrame, months: int = 12) -> DataFrame:
    """The last months that have rows."""
    return pnl.orderBy(F.desc("MES")).limit(months).orderBy("MES")


def yoy_by_month(pnl: DataFrame) -> DataFrame:
    """Revenue by year and month, empty unless two years are present."""
    by_month = pnl.groupBy(F.year("MES").alias("ANO"), F.month("MES").alias("MESNUM")).agg(
        F.sum("RECEITA_TOTAL").alias("RECEITA_TOTAL")
    )
    # One row per month of the period, so this window is small whatever the size of the facts.
    years = Window.partitionBy(F.lit(1))
    first_and_last = (F.min("ANO").over(years), F.max("ANO").over(years))
    return (
        by_month.withColumns({"first": first_and_last[0], "last": first_and_last[1]})
        .filter(F.col("first") < F.col("last"))
        .drop("first", "last")
        .orderBy("ANO", "MESNUM")
    )


def restock_recommendation(risk: DataFrame) -> DataFrame:
    """Raise, keep or lower the stock of each part at risk, by its days of cover."""
    # The limits and their labels.
    advice = (
        F.when(F.col("DIAS_COBERTURA") <= 10, "Aumentar").when(F.col("DIAS_COBERTURA") <= 30, "Manter").otherwise("Reduzir")
    )
    return risk.select(
        "CATEGORIA_PECA",
        "DESCRICAO_PECA",
        "ESTOQUE_ATUAL",
        "CONSUMO_MEDIO_DIA",
        "DIAS_COBERTURA",
        advice.alias("RECOMENDACAO"),
    )


def margin_uplift(integrated: DataFrame) -> DataFrame:
    """Sales by how much after-sales lift the margin."""
    delta = or_zero(F.col("MARGEM_INTEGRADA")) - or_zero(F.col("MARGEM_VEICULO"))
    return (
        integrated.withColumn("DELTA_MARGEM", delta)
        .orderBy(F.desc("DELTA_MARGEM"), F.desc("RECEITA_VEICULO"))
        .select(
            "DT_VENDA",
            "NOME_FILIAL",
            "NOME_COMPRADOR",
            "MARCA_VEICULO",
            "MODELO_VEICULO",
            "RECEITA_VEICULO",
            "MARGEM_VEICULO",
            "RECEITA_SERVICOS",
            "RECEITA_PECAS",
            "RECEITA_INTEGRADA",
            "MARGEM_INTEGRADA",
            "DELTA_MARGEM",
        )
    )


def integrated_totals(integrated: DataFrame) -> DataFrame:
    """Revenue, profit and margin over the sales shown, one row."""
    return integrated.agg(
        F.sum("RECEITA_INTEGRADA").alias("RECEITA_INTEGRADA"), F.sum("LUCRO_INTEGRADO").alias("LUCRO_INTEGRADO")
    ).withColumn("MARGEM_INTEGRADA", ratio(F.col("LUCRO_INTEGRADO"), F.col("RECEITA_INTEGRADA")))


def model_label(ranking: DataFrame) -> DataFrame:
    """Make and model as one label."""
    return ranking.withColumn("MODELO_LABEL", F.concat_ws(" - ", "MARCA_VEICULO", "MODELO_VEICULO"))


def branch_totals(performance: DataFrame) -> DataFrame:
    """Profit, capital and ROI over the branches shown, one row."""
    return performance.agg(
        F.sum("LUCRO_TOTAL").alias("LUCRO_TOTAL"), F.sum("CAPITAL_ESTOQUE").alias("CAPITAL_ESTOQUE")
    ).withColumn("ROI_ESTOQUE", ratio(F.col("LUCRO_TOTAL"), F.col("CAPITAL_ESTOQUE")))


# The metrics compared, their labels, and whether they are shares.
BENCHMARK_METRICS = (
    ("ROI (lucro/estoque)", "ROI_ESTOQUE", True),
    ("Lucro total", "LUCRO_TOTAL", False),
    ("Capital em estoque", "CAPITAL_ESTOQUE", False),
    ("Margem veículos", "VEIC_MARGEM", True),
    ("Margem peças", "PEC_MARGEM", True),
    ("Margem serviços", "SRV_MARGEM", True),
    ("Receita total", "RECEITA_TOTAL", False),
)


def branch_benchmark(performance: DataFrame, branch_a: str, branch_b: str, formatted: bool = False) -> DataFrame:
    """Seven metrics of two branches side by side; of a repeated name its best-ranked row counts."""
    figures = [column for _, column, _ in BENCHMARK_METRICS]
    best = Window.partitionBy("NOME_FILIAL").orderBy(
        F.desc_nulls_last("ROI_ESTOQUE"), F.desc_nulls_last("LUCRO_TOTAL"), *[F.asc_nulls_last(t) for t in _BRANCH_TIES]
    )
    rows = (
        performance.filter(F.col("NOME_FILIAL").isin(branch_a, branch_b))
        .withColumn("place", F.row_number().over(best))
        .filter("place = 1")
    )
    cells = [
        cell
        for label, column, share in BENCHMARK_METRICS
        for cell in (F.lit(label), F.lit(share), F.col(column).cast("double"))
    ]
    long = rows.select("NOME_FILIAL", F.stack(F.lit(len(figures)), *cells).alias("METRICA", "share", "value"))
    wide = long.groupBy("METRICA", "share").agg(
        F.max(F.when(F.col("NOME_FILIAL") == branch_a, F.col("value"))).alias("FILIAL_A"),
        F.max(F.when(F.col("NOME_FILIAL") == branch_b, F.col("value"))).alias("FILIAL_B"),
    )
    if formatted:
        wide = wide.withColumns(
            {
                side: F.when(F.col("share"), percent_text(F.col(side))).otherwise(money_text(F.col(side)))
                for side in ("FILIAL_A", "FILIAL_B")
            }
        )
    return wide.drop("share")


def daily_deltas(vehicles: DataFrame, parts: DataFrame, services: DataFrame) -> DataFrame:
    """Change of the day in long form: vehicles against the day before, the rest against the mean."""

    def delta(today: str, base: str) -> Column:
        return or_zero(F.col(today)).cast("double") - or_zero(F.col(base)).cast("double")

    def rows(df: DataFrame, line: str, quantity_base: str, revenue_base: str) -> DataFrame:
        return df.select(
            F.lit(line).alias("ORIGEM"),
            delta("QTD_HOJE", quantity_base).alias("DELTA_QTD"),
            delta("RECEITA_HOJE", revenue_base).alias("DELTA_RECEITA"),
        )

    return (
        rows(vehicles, "VEICULO", "QTD_ONTEM", "RECEITA_ONTEM")
        .unionByName(rows(parts, "PECA", "QTD_MEDIA_30D", "RECEITA_MEDIA_30D"))
        .unionByName(rows(services, "SERVICO", "QTD_MEDIA_30D", "RECEITA_MEDIA_30D"))
    )


def format_report(
    df: DataFrame, money: Sequence[str] = (), pct: Sequence[str] = (), ints: Sequence[str] = ()
) -> DataFrame:
    """Named columns as report text: ``R$ 1.234,56``, ``12,34%``, whole numbers."""
    return df.withColumns(
        {c: money_text(F.col(c)) for c in money}
        | {c: percent_text(F.col(c)) for c in pct}
        | {c: int_text(F.col(c)) for c in ints}
    )
