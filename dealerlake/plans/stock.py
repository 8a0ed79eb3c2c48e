"""Stock value, turnover, cover and obsolescence."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake import schemas as S
from dealerlake.functions.amounts import first_rows, mean, or_zero, ratio, sum_where
from dealerlake.plans.kpi import STOCK_PARTS, STOCK_VEHICLES, stock_as_facts
from dealerlake.sources.bronze import Bronze

# Fixed value: stock that lasts longer than this many days is no risk.
COVER_LIMIT_DAYS = 30
# Fixed value: days without movement from which a part counts as obsolete.
OBSOLETE_AFTER_DAYS = 60
# Spellings of a set obsolescence flag.
OBSOLETE_FLAGS = ("SIM", "S", "Y", "YES", "1", "TRUE")


def stock_kpis(b: Bronze) -> DataFrame:
    """Vehicle stock cost and mean days in stock (missing days as 0), part stock value, one row."""
    vehicles = stock_as_facts(
        b, S.ESTOQUE_VEICULOS, "CUSTO_VEICULO", STOCK_VEHICLES, [], {"DIAS": "TEMPO_TOTAL_ESTOQUE_DIAS"}
    )
    parts = stock_as_facts(b, S.ESTOQUE_PECAS, "VALOR_PECA_ESTOQUE", STOCK_PARTS, [])
    is_vehicle = F.col("ORIGEM") == STOCK_VEHICLES
    return (
        vehicles.unionByName(parts, allowMissingColumns=True)
        .agg(
            sum_where(is_vehicle, F.col("RECEITA")).alias("ESTOQUE_VEIC_VALOR"),
            sum_where(is_vehicle, or_zero(F.col("DIAS"))).alias("days"),
            F.count_if(is_vehicle).alias("n"),
            sum_where(~is_vehicle, F.col("RECEITA")).alias("ESTOQUE_PEC_VALOR"),
        )
        .select(
            "ESTOQUE_VEIC_VALOR",
            mean(F.col("days"), F.col("n")).alias("ESTOQUE_VEIC_DIAS_MEDIO_ATUAL"),
            "ESTOQUE_PEC_VALOR",
        )
    )


def top_parts_stock_value(b: Bronze, top_n: int = 20) -> DataFrame:
    """Parts holding the most stock value."""
    columns = ["DESCRICAO_PECA", "CATEGORIA_PECA", "QTDE_PECA_ESTOQUE", "VALOR_PECA_ESTOQUE"]
    return (
        b.table(S.ESTOQUE_PECAS, columns)
        .groupBy("DESCRICAO_PECA", "CATEGORIA_PECA")
        .agg(
            F.sum(or_zero(F.col("QTDE_PECA_ESTOQUE"))).alias("QTDE"),
            F.sum(or_zero(F.col("VALOR_PECA_ESTOQUE"))).alias("VALOR_ESTOQUE"),
        )
        .orderBy(
            F.desc_nulls_last("VALOR_ESTOQUE"),
            F.asc_nulls_last("DESCRICAO_PECA"),
            F.asc_nulls_last("CATEGORIA_PECA"),
        )
        .limit(top_n)
    )


def part_turnover_by_category(b: Bronze, dt_ini: date, dt_fim: date) -> DataFrame:
    """Revenue of the period over current stock value by part category.

    The missing category is listed but matches nothing, so its figures are 0 and its ratio null.
    """
    sales = b.table(S.HIST_VENDAS_PECAS, ["CATEGORIA_PECA", "VALOR_VENDA"], (dt_ini, dt_fim))
    stock = b.table(S.ESTOQUE_PECAS, ["CATEGORIA_PECA", "VALOR_PECA_ESTOQUE"])
    named = F.col("CATEGORIA_PECA").isNotNull()
    return (
        sales.unionByName(stock, allowMissingColumns=True)
        .groupBy("CATEGORIA_PECA")
        .agg(F.sum("VALOR_VENDA").alias("sold"), F.sum("VALOR_PECA_ESTOQUE").alias("held"))
        .select(
            "CATEGORIA_PECA",
            or_zero(F.when(named, F.col("sold"))).alias("RECEITA_PERIODO"),
            or_zero(F.when(named, F.col("held"))).alias("VALOR_ESTOQUE"),
        )
        .withColumn("GIRO_PROXY", ratio(F.col("RECEITA_PERIODO"), F.col("VALOR_ESTOQUE")))
        .orderBy(F.desc_nulls_last("GIRO_PROXY"), F.asc_nulls_last("CATEGORIA_PECA"))
    )


def stock_days_monthly(b: Bronze, dt_ini: date, dt_fim: date) -> DataFrame:
    """Mean days in stock of the vehicles sold, by month; missing days as 0."""
    return (
        b.table(S.HIST_VENDAS_VEICULOS, ["DT_VENDA", "DIAS_EM_ESTOQUE"], (dt_ini, dt_fim))
        .groupBy(F.trunc("DT_VENDA", "MM").alias("MES"))
        .agg(F.sum(or_zero(F.col("DIAS_EM_ESTOQUE"))).alias("days"), F.count("*").alias("n"))
        .select("MES", mean(F.col("days"), F.col("n")).alias("DIAS_MEDIO_VENDA"))
        .orderBy("MES")
    )


def stockout_risk(b: Bronze, as_of: date, window_days: int = 30, top_n: int | None = 30) -> DataFrame:
    """Parts in stock and selling whose stock covers at most 30 days of the daily sales of the window up to ``as_of``.

    The ``top_n`` with the shortest cover, or all with None.
    """
    part = ["CATEGORIA_PECA", "DESCRICAO_PECA"]
    sales = b.table(S.HIST_VENDAS_PECAS, [*part, "QTDE_VENDIDA"], (as_of - timedelta(days=window_days), as_of))
    stock = b.table(S.ESTOQUE_PECAS, [*part, "QTDE_PECA_ESTOQUE"])
    per_day = F.col("VENDAS_ND").cast("double") / F.lit(float(window_days))
    at_risk = (
        sales.unionByName(stock, allowMissingColumns=True)
        .filter(F.col(part[0]).isNotNull() & F.col(part[1]).isNotNull())
        .groupBy(*part)
        .agg(F.sum("QTDE_PECA_ESTOQUE").alias("ESTOQUE_ATUAL"), F.sum("QTDE_VENDIDA").alias("VENDAS_ND"))
        .filter((F.col("ESTOQUE_ATUAL") > 0) & (F.col("VENDAS_ND") > 0))
        .withColumn("CONSUMO_MEDIO_DIA", per_day)
        .withColumn("DIAS_COBERTURA", ratio(F.col("ESTOQUE_ATUAL"), F.col("CONSUMO_MEDIO_DIA")))
        .filter(F.col("DIAS_COBERTURA") <= COVER_LIMIT_DAYS)
        .orderBy(F.asc_nulls_last("DIAS_COBERTURA"), *part)
    )
    return first_rows(at_risk, top_n)


def obsolete_parts(b: Bronze, top_n: int = 50) -> DataFrame:
    """Stock lines flagged obsolete or without movement for 60 days, longest idle first."""
    columns = [
        "CATEGORIA_PECA",
        "DESCRICAO_PECA",
        "CODIGO_PECA_ESTOQUE",
        "QTDE_PECA_ESTOQUE",
        "VALOR_PECA_ESTOQUE",
        "PECA_OBSOLETA_FLAG",
        "TEMPO_OBSOLETA_DIAS",
        "DT_ULTIMA_VENDA_PECA",
    ]
    idle = or_zero(F.col("TEMPO_OBSOLETA_DIAS"))
    flagged = F.upper(F.trim("PECA_OBSOLETA_FLAG")).isin(*OBSOLETE_FLAGS)
    return (
        b.table(S.ESTOQUE_PECAS, columns)
        .filter(flagged | (idle >= OBSOLETE_AFTER_DAYS))
        .orderBy(
            idle.desc(),
            or_zero(F.col("VALOR_PECA_ESTOQUE")).desc(),
            F.asc_nulls_last("CODIGO_PECA_ESTOQUE"),
        )
        .limit(top_n)
    )
