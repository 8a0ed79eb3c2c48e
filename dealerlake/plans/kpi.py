"""Period KPIs and monthly profit and loss over the three lines of business."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake import schemas as S
from dealerlake.functions.amounts import mean, or_zero, ratio, sum0_where, sum_where
from dealerlake.sources.bronze import PECA, SERVICO, VEICULO, Bronze

STOCK_PARTS, STOCK_VEHICLES = "ESTOQUE_PECA", "ESTOQUE_VEICULO"


def in_branch(df: DataFrame, cod_concessionaria: str | None, cod_filial: str | None) -> DataFrame:
    """Rows of one dealer and/or branch; None means any."""
    if cod_concessionaria is not None:
        df = df.filter(F.col("COD_CONCESSIONARIA") == cod_concessionaria)
    if cod_filial is not None:
        df = df.filter(F.col("COD_FILIAL") == cod_filial)
    return df


def branch_keys(cod_concessionaria: str | None, cod_filial: str | None) -> list[str]:
    """Columns a branch filter needs; a scan without a filter does not read them."""
    keys = []
    if cod_concessionaria is not None:
        keys.append("COD_CONCESSIONARIA")
    if cod_filial is not None:
        keys.append("COD_FILIAL")
    return keys


def stock_as_facts(b: Bronze, name: str, value: str, origin: str, keys: list[str], extra: dict | None = None) -> DataFrame:
    """Stock rows in the layout of the fact, so that one aggregate covers sales and stock."""
    extra = extra or {}
    return b.table(name, [*keys, value, *extra.values()]).select(
        F.lit(origin).alias("ORIGEM"),
        *keys,
        or_zero(F.col(value).cast(b.amount)).alias("RECEITA"),
        *[F.col(source).alias(target) for target, source in extra.items()],
    )


def kpis_period(
    b: Bronze, dt_ini: date, dt_fim: date, cod_concessionaria: str | None = None, cod_filial: str | None = None
) -> DataFrame:
    """Revenue and profit per line, totals and part-stock value, one row.

    A line without rows gives null, and so does the total over it.
    """
    keys = branch_keys(cod_concessionaria, cod_filial)
    sales = b.sums([*keys, "RECEITA", "LUCRO"], (dt_ini, dt_fim))
    stock = stock_as_facts(b, S.ESTOQUE_PECAS, "VALOR_PECA_ESTOQUE", STOCK_PARTS, keys)
    rows = in_branch(sales.unionByName(stock, allowMissingColumns=True), cod_concessionaria, cod_filial)
    origin = F.col("ORIGEM")
    lines = {"VEIC": VEICULO, "PEC": PECA, "SRV": SERVICO}
    sums = rows.agg(
        *[sum_where(origin == o, F.col("RECEITA")).alias(f"RECEITA_{k}") for k, o in lines.items()],
        *[sum_where(origin == o, F.col("LUCRO")).alias(f"LUCRO_{k}") for k, o in lines.items()],
        sum_where(origin == STOCK_PARTS, F.col("RECEITA")).alias("VALOR_ESTOQUE_PEC"),
    )
    return sums.select(
        (F.col("RECEITA_VEIC") + F.col("RECEITA_PEC") + F.col("RECEITA_SRV")).alias("RECEITA_TOTAL"),
        (F.col("LUCRO_VEIC") + F.col("LUCRO_PEC") + F.col("LUCRO_SRV")).alias("LUCRO_TOTAL"),
        "RECEITA_VEIC",
        "LUCRO_VEIC",
        "RECEITA_PEC",
        "LUCRO_PEC",
        "RECEITA_SRV",
        "LUCRO_SRV",
        "VALOR_ESTOQUE_PEC",
    )


def revenue_monthly(b: Bronze, dt_ini: date, dt_fim: date) -> DataFrame:
    """Total revenue by month."""
    return (
        b.sums(["DT", "RECEITA"], (dt_ini, dt_fim))
        .groupBy(F.trunc("DT", "MM").alias("MES"))
        .agg(F.sum("RECEITA").alias("RECEITA_TOTAL"))
        .orderBy("MES")
    )


def pnl_monthly(b: Bronze, dt_ini: date, dt_fim: date) -> DataFrame:
    """Revenue and profit by month and line; a line without rows in a month counts as 0."""
    origin = F.col("ORIGEM")
    lines = {"VEIC": VEICULO, "PEC": PECA, "SRV": SERVICO}
    return (
        b.sums(["DT", "RECEITA", "LUCRO"], (dt_ini, dt_fim))
        .groupBy(F.trunc("DT", "MM").alias("MES"))
        .agg(
            *[
                sum0_where(origin == o, F.col(measure)).alias(f"{k}_{measure}")
                for k, o in lines.items()
                for measure in ("RECEITA", "LUCRO")
            ],
            F.sum("LUCRO").alias("LUCRO_TOTAL"),
            F.sum("RECEITA").alias("RECEITA_TOTAL"),
        )
        .orderBy("MES")
    )


def profit_by_vendor(b: Bronze, dt_ini: date, dt_fim: date, top_n: int = 20) -> DataFrame:
    """Profit, revenue and margin per salesperson, best profit first."""
    return (
        b.transactions(["VENDEDOR", "RECEITA", "LUCRO"], (dt_ini, dt_fim))
        .filter(F.col("VENDEDOR").isNotNull())
        .groupBy("VENDEDOR")
        .agg(F.sum("LUCRO").alias("LUCRO_TOTAL"), F.sum("RECEITA").alias("RECEITA_TOTAL"))
        .withColumn("MARGEM", ratio(F.col("LUCRO_TOTAL"), F.col("RECEITA_TOTAL")))
        .orderBy(F.desc_nulls_last("LUCRO_TOTAL"), F.asc_nulls_last("VENDEDOR"))
        .limit(top_n)
    )


def cashflow_proxy(
    b: Bronze, dt_ini: date, dt_fim: date, cod_concessionaria: str | None = None, cod_filial: str | None = None
) -> DataFrame:
    """Capital tied up in both stocks against revenue of the three lines, five labelled rows."""
    keys = branch_keys(cod_concessionaria, cod_filial)
    rows = (
        b.sums([*keys, "RECEITA"], (dt_ini, dt_fim))
        .unionByName(stock_as_facts(b, S.ESTOQUE_VEICULOS, "CUSTO_VEICULO", STOCK_VEHICLES, keys))
        .unionByName(stock_as_facts(b, S.ESTOQUE_PECAS, "VALOR_PECA_ESTOQUE", STOCK_PARTS, keys))
    )
    # The report's row labels.
    labels = [
        (STOCK_VEHICLES, "Capital imobilizado (estoque)", "Veículos (custo)"),
        (STOCK_PARTS, "Capital imobilizado (estoque)", "Peças (valor)"),
        (VEICULO, "Entradas no período", "Receita veículos"),
        (PECA, "Entradas no período", "Receita peças"),
        (SERVICO, "Entradas no período", "Receita serviços"),
    ]
    sums = in_branch(rows, cod_concessionaria, cod_filial).agg(
        *[sum0_where(F.col("ORIGEM") == o, F.col("RECEITA")).alias(o) for o, _, _ in labels]
    )
    arguments = [a for o, kind, item in labels for a in (F.lit(kind), F.lit(item), F.col(o))]
    return sums.select(F.stack(F.lit(len(labels)), *arguments).alias("TIPO", "ITEM", "VALOR"))


def services_kpis(
    b: Bronze, dt_ini: date, dt_fim: date, cod_concessionaria: str | None = None, cod_filial: str | None = None
) -> DataFrame:
    """Count, quantity, revenue, profit, margin and means per record of the services, one row."""
    rows = _services(b, [], dt_ini, dt_fim, cod_concessionaria, cod_filial)
    return rows.agg(
        F.count("*").alias("REGISTROS"),
        F.sum(or_zero(F.col("QTDE_SERVICOS"))).alias("QTDE_SERVICOS"),
        F.sum(or_zero(F.col("VALOR_TOTAL_SERVICO"))).alias("RECEITA_SERVICOS"),
        F.sum(or_zero(F.col("LUCRO_SERVICO"))).alias("LUCRO_SERVICOS"),
    ).select(
        "*",
        ratio(F.col("LUCRO_SERVICOS"), F.col("RECEITA_SERVICOS")).alias("MARGEM_SERVICOS"),
        mean(F.col("RECEITA_SERVICOS"), F.col("REGISTROS")).alias("TICKET_MEDIO_POR_REGISTRO"),
        mean(F.col("QTDE_SERVICOS"), F.col("REGISTROS")).alias("QTDE_MEDIA_SERVICOS_POR_REGISTRO"),
    )


def services_by_department(
    b: Bronze,
    dt_ini: date,
    dt_fim: date,
    cod_concessionaria: str | None = None,
    cod_filial: str | None = None,
    top_n: int = 20,
) -> DataFrame:
    """Services by department, highest revenue first; a missing department is a group."""
    by = _services_by(b, "DEPARTAMENTO_SERVICO", dt_ini, dt_fim, cod_concessionaria, cod_filial)
    return by.orderBy(F.desc_nulls_last("RECEITA"), F.asc_nulls_last("DEPARTAMENTO_SERVICO")).limit(top_n)


def services_by_category(
    b: Bronze,
    dt_ini: date,
    dt_fim: date,
    cod_concessionaria: str | None = None,
    cod_filial: str | None = None,
    top_n: int = 20,
) -> DataFrame:
    """Services by category, highest profit first."""
    by = _services_by(b, "CATEGORIA_SERVICO", dt_ini, dt_fim, cod_concessionaria, cod_filial)
    return by.orderBy(F.desc_nulls_last("LUCRO"), F.asc_nulls_last("CATEGORIA_SERVICO")).limit(top_n)


def _services(b, extra, dt_ini, dt_fim, cod_concessionaria, cod_filial) -> DataFrame:
    columns = [
        *branch_keys(cod_concessionaria, cod_filial),
        *extra,
        "QTDE_SERVICOS",
        "VALOR_TOTAL_SERVICO",
        "LUCRO_SERVICO",
    ]
    return in_branch(b.table(S.HIST_SERVICOS, columns, (dt_ini, dt_fim)), cod_concessionaria, cod_filial)


def _services_by(b, key, dt_ini, dt_fim, cod_concessionaria, cod_filial) -> DataFrame:
    return (
        _services(b, [key], dt_ini, dt_fim, cod_concessionaria, cod_filial)
        .groupBy(key)
        .agg(
            F.sum(or_zero(F.col("QTDE_SERVICOS"))).alias("QTDE_SERVICOS"),
            F.sum(or_zero(F.col("VALOR_TOTAL_SERVICO"))).alias("RECEITA"),
            F.sum(or_zero(F.col("LUCRO_SERVICO"))).alias("LUCRO"),
        )
        .withColumn("MARGEM", ratio(F.col("LUCRO"), F.col("RECEITA")))
    )
