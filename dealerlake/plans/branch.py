"""Branch performance and return on stock capital."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake import schemas as S
from dealerlake.functions.amounts import first_rows, or_zero, ratio, sum0_where
from dealerlake.plans.kpi import STOCK_PARTS, STOCK_VEHICLES, stock_as_facts
from dealerlake.session import written
from dealerlake.sources.bronze import PECA, SERVICO, VEICULO, Bronze

CODE = ["COD_CONCESSIONARIA", "COD_FILIAL"]


def branch_performance(
    b: Bronze,
    dt_ini: date,
    dt_fim: date,
    cod_concessionaria: str | None = None,
    top_n: int | None = 50,
    collapse_names: bool = False,
) -> DataFrame:
    """Quantity, revenue, profit and margin per branch and line, both stocks, capital and ROI.

    Branches come from any of the five tables. By default a branch whose name is spelled in several
    ways gives one row per spelling and combination of the lines' spellings (figures are grouped by
    code and name but matched by code); ``collapse_names`` gives one row per code instead. The ``top_n`` with
    the highest ROI, or all with None: totals and other rankings need all.
    """
    by_name = _line_totals(b, dt_ini, dt_fim, cod_concessionaria)
    wide = _one_row_per_code(by_name) if collapse_names else _one_row_per_spelling(by_name)
    profit = F.col("VEIC_LUCRO") + F.col("PEC_LUCRO") + F.col("SRV_LUCRO")
    revenue = F.col("VEIC_RECEITA") + F.col("PEC_RECEITA") + F.col("SRV_RECEITA")
    capital = F.col("ESTOQUE_VEICULOS") + F.col("ESTOQUE_PECAS")
    lines = [
        column
        for k in ("VEIC", "PEC", "SRV")
        for column in (
            F.col(f"{k}_QTD"),
            F.col(f"{k}_RECEITA"),
            F.col(f"{k}_LUCRO"),
            ratio(F.col(f"{k}_LUCRO"), F.col(f"{k}_RECEITA")).alias(f"{k}_MARGEM"),
        )
    ]
    ranked = (
        wide.select(
            *CODE,
            "NOME_FILIAL",
            *lines,
            profit.alias("LUCRO_TOTAL"),
            revenue.alias("RECEITA_TOTAL"),
            "ESTOQUE_VEICULOS",
            "ESTOQUE_PECAS",
            capital.alias("CAPITAL_ESTOQUE"),
            ratio(profit, capital).alias("ROI_ESTOQUE"),
        )
        .orderBy(
            F.desc_nulls_last("ROI_ESTOQUE"),
            F.desc_nulls_last("LUCRO_TOTAL"),
            *[F.asc_nulls_last(c) for c in (*CODE, "NOME_FILIAL")],
        )
    )
    return first_rows(ranked, top_n)


def _line_totals(b: Bronze, dt_ini: date, dt_fim: date, cod_concessionaria: str | None) -> DataFrame:
    """Sums by (line or stock, branch code, branch name): one scan of each table, one small shuffle."""
    keys = [*CODE, "NOME_FILIAL"]
    rows = (
        b.sums([*keys, "QTD", "RECEITA", "LUCRO"], (dt_ini, dt_fim))
        .unionByName(
            stock_as_facts(b, S.ESTOQUE_PECAS, "VALOR_PECA_ESTOQUE", STOCK_PARTS, keys), allowMissingColumns=True
        )
        .unionByName(
            stock_as_facts(b, S.ESTOQUE_VEICULOS, "CUSTO_VEICULO", STOCK_VEHICLES, keys), allowMissingColumns=True
        )
    )
    if cod_concessionaria is not None:
        rows = rows.filter(F.col("COD_CONCESSIONARIA") == cod_concessionaria)
    return rows.groupBy("ORIGEM", *keys).agg(F.sum("QTD").alias("QTD"), F.sum("RECEITA").alias("RECEITA"), F.sum("LUCRO").alias("LUCRO"))


# Output column -> (line or stock it comes from, its measure).
_FIGURES = {
    "VEIC_QTD": (VEICULO, "QTD"),
    "VEIC_RECEITA": (VEICULO, "RECEITA"),
    "VEIC_LUCRO": (VEICULO, "LUCRO"),
    "PEC_QTD": (PECA, "QTD"),
    "PEC_RECEITA": (PECA, "RECEITA"),
    "PEC_LUCRO": (PECA, "LUCRO"),
    "SRV_QTD": (SERVICO, "QTD"),
    "SRV_RECEITA": (SERVICO, "RECEITA"),
    "SRV_LUCRO": (SERVICO, "LUCRO"),
    "ESTOQUE_VEICULOS": (STOCK_VEHICLES, "RECEITA"),
    "ESTOQUE_PECAS": (STOCK_PARTS, "RECEITA"),
}


def _one_row_per_code(by_name: DataFrame) -> DataFrame:
    return by_name.groupBy(*CODE).agg(
        F.min("NOME_FILIAL").alias("NOME_FILIAL"),
        *[sum0_where(F.col("ORIGEM") == origin, F.col(m)).alias(name) for name, (origin, m) in _FIGURES.items()],
    )


def _one_row_per_spelling(by_name: DataFrame) -> DataFrame:
    # The totals (a few rows per branch) are used six times below; writing them keeps that to one
    # scan of the fact tables.
    by_name = written(by_name)
    wide = by_name.select(*CODE, "NOME_FILIAL").distinct()
    for origin in (VEICULO, PECA, SERVICO, STOCK_VEHICLES, STOCK_PARTS):
        figures = {name: m for name, (o, m) in _FIGURES.items() if o == origin}
        side = by_name.filter(F.col("ORIGEM") == origin).select(*CODE, *[F.col(m).alias(n) for n, m in figures.items()])
        wide = wide.join(side, CODE, "left")
    return wide.select(*CODE, "NOME_FILIAL", *[or_zero(F.col(n)).alias(n) for n in _FIGURES])


def roi_by_branch(b: Bronze, dt_ini: date, dt_fim: date, collapse_names: bool = False) -> DataFrame:
    """Profit of the period over current stock capital, by branch with sales.

    As in :func:`branch_performance` spellings multiply rows unless ``collapse_names``; stock is
    matched by the branch code alone, whatever the dealer.
    """
    names = [] if collapse_names else ["NOME_FILIAL"]

    def grouped(df: DataFrame, *aggregates) -> DataFrame:
        spelling = [F.min("NOME_FILIAL").alias("NOME_FILIAL")] if collapse_names else []
        return df.groupBy("COD_FILIAL", *names).agg(*spelling, *aggregates)

    profit = grouped(
        b.sums(["COD_FILIAL", "NOME_FILIAL", "LUCRO"], (dt_ini, dt_fim)), F.sum("LUCRO").alias("LUCRO_TOTAL")
    )
    stocks = []
    for table, value in ((S.ESTOQUE_VEICULOS, "CUSTO_VEICULO"), (S.ESTOQUE_PECAS, "VALOR_PECA_ESTOQUE")):
        stock = grouped(b.table(table, ["COD_FILIAL", "NOME_FILIAL", value]), F.sum(or_zero(F.col(value))).alias(value))
        stocks.append(stock.select("COD_FILIAL", value))
    capital = or_zero(F.col("CUSTO_VEICULO")) + or_zero(F.col("VALOR_PECA_ESTOQUE"))
    return (
        profit.join(stocks[0], "COD_FILIAL", "left")
        .join(stocks[1], "COD_FILIAL", "left")
        .select(
            "COD_FILIAL",
            "NOME_FILIAL",
            "LUCRO_TOTAL",
            capital.alias("CAPITAL_ESTOQUE"),
            ratio(F.col("LUCRO_TOTAL"), capital).alias("ROI_ESTOQUE"),
        )
        .orderBy(F.desc_nulls_last("ROI_ESTOQUE"), F.asc_nulls_last("COD_FILIAL"), F.asc_nulls_last("NOME_FILIAL"))
    )
