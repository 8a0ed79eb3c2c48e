"""Margin of a vehicle sale together with what the buyer spent afterwards."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake import schemas as S
from dealerlake.functions.amounts import or_zero, ratio
from dealerlake.operators.forward_sum import forward_sums
from dealerlake.plans.kpi import branch_keys, in_branch
from dealerlake.session import written
from dealerlake.sources.bronze import PECA, SERVICO, VEICULO, Bronze

# A buyer is the name as written, within a dealer.
_BUYER = ["COD_CONCESSIONARIA", "NOME_COMPRADOR"]
_AFTER = ["RECEITA_SERVICOS", "LUCRO_SERVICOS", "RECEITA_PECAS", "LUCRO_PECAS"]


def _vehicle_sales(b: Bronze, columns, dt_ini, dt_fim, cod_concessionaria, cod_filial) -> DataFrame:
    needed = dict.fromkeys([*columns, "VALOR_VENDA", "LUCRO_VENDA", *branch_keys(cod_concessionaria, cod_filial)])
    sales = b.table(S.HIST_VENDAS_VEICULOS, list(needed), (dt_ini, dt_fim))
    return in_branch(sales, cod_concessionaria, cod_filial).select(
        *columns,
        or_zero(F.col("VALOR_VENDA")).alias("RECEITA_VEICULO"),
        or_zero(F.col("LUCRO_VENDA")).alias("LUCRO_VEICULO"),
    )


def _measures() -> dict:
    """Service and part amounts of a fact row; a vehicle sale has none."""
    sides = {"SERVICOS": SERVICO, "PECAS": PECA}
    return {
        f"{m}_{side}": F.when(F.col("ORIGEM") == origin, F.col(m))
        for side, origin in sides.items()
        for m in ("RECEITA", "LUCRO")
    }


def _facts(b: Bronze, origins, dt_ini, dt_fim, window_days, cod_concessionaria, keys=()) -> DataFrame:
    """Fact rows that can be a sale of the period or fall in the window of one.

    After-sales may happen in any branch of the dealer, so only the dealer filter applies to all.
    """
    columns = dict.fromkeys(["COD_CONCESSIONARIA", "CLIENTE", "DT", "RECEITA", "LUCRO", *keys])
    rows = b.transactions(columns, (dt_ini, dt_fim + timedelta(days=window_days)), origins)
    return (
        in_branch(rows, cod_concessionaria, None)
        .withColumnsRenamed({"CLIENTE": "NOME_COMPRADOR", "DT": "DT_VENDA"})
        .withColumns(_measures())
    )


def _with_after_sales(sales: DataFrame, sums: DataFrame) -> DataFrame:
    """Sales with the sums of their buyer, dealer and day.

    A service in the window of several sales of the same buyer counts for each of them.
    """
    joined = sales.join(sums, [*_BUYER, "DT_VENDA"], "left")
    return joined.withColumns({c: or_zero(F.col(c)) for c in _AFTER}).withColumns(
        {
            "LUCRO_INTEGRADO": F.col("LUCRO_VEICULO") + F.col("LUCRO_SERVICOS") + F.col("LUCRO_PECAS"),
            "RECEITA_INTEGRADA": F.col("RECEITA_VEICULO") + F.col("RECEITA_SERVICOS") + F.col("RECEITA_PECAS"),
        }
    )


def integrated_margin(
    b: Bronze,
    dt_ini: date,
    dt_fim: date,
    window_days: int = 30,
    cod_concessionaria: str | None = None,
    cod_filial: str | None = None,
    limit: int | None = 200,
) -> DataFrame:
    """Margins of vehicle sales: the vehicle, services and parts in the window, all together.

    The ``limit`` newest sales, or all of the period with None: totals need all.
    """
    columns = [
        "ID_VENDA_VEICULO",
        "COD_CONCESSIONARIA",
        "COD_FILIAL",
        "NOME_FILIAL",
        "DT_VENDA",
        "NOME_COMPRADOR",
        "MARCA_VEICULO",
        "MODELO_VEICULO",
    ]
    newest = [F.desc_nulls_last("DT_VENDA"), F.asc("ID_VENDA_VEICULO")]
    # Order and limit depend on the sale alone, so they come before the window sums. The sales left
    # are used four times below; writing them keeps that to one scan. Their days bound the scan of the rest.
    sales = _vehicle_sales(b, columns, dt_ini, dt_fim, cod_concessionaria, cod_filial)
    sales = written(sales if limit is None else sales.orderBy(*newest).limit(limit))
    days = sales.agg(F.min("DT_VENDA"), F.max("DT_VENDA")).first()
    since, until = (days[0] or dt_ini, days[1] or dt_ini)
    # One row per buyer and day before anything is joined: a generic buyer with a third of all rows is a row per day then.
    daily = (
        _facts(b, (SERVICO, PECA), since, until, window_days, cod_concessionaria)
        .groupBy(*_BUYER, "DT_VENDA")
        .agg(*[F.sum(c).alias(c) for c in _AFTER])
    )
    after = daily.withColumn("is_anchor", F.lit(False)).join(sales.select(*_BUYER).distinct(), _BUYER, "left_semi")
    anchors = sales.select(*_BUYER, "DT_VENDA", F.lit(True).alias("is_anchor"))
    sums = forward_sums(
        after.unionByName(anchors, allowMissingColumns=True), _BUYER, "DT_VENDA", _AFTER, window_days
    )
    return (
        _with_after_sales(sales, sums)
        .orderBy(*newest)
        .select(
            *columns[1:],
            "RECEITA_VEICULO",
            "LUCRO_VEICULO",
            ratio(F.col("LUCRO_VEICULO"), F.col("RECEITA_VEICULO")).alias("MARGEM_VEICULO"),
            "RECEITA_SERVICOS",
            "LUCRO_SERVICOS",
            ratio(F.col("LUCRO_SERVICOS"), F.col("RECEITA_SERVICOS")).alias("MARGEM_SERVICOS"),
            "RECEITA_PECAS",
            "LUCRO_PECAS",
            ratio(F.col("LUCRO_PECAS"), F.col("RECEITA_PECAS")).alias("MARGEM_PECAS"),
            "LUCRO_INTEGRADO",
            "RECEITA_INTEGRADA",
            ratio(F.col("LUCRO_INTEGRADO"), F.col("RECEITA_INTEGRADA")).alias("MARGEM_INTEGRADA"),
        )
    )


def _sums_by(b: Bronze, keys: list[str], dt_ini, dt_fim, window_days, cod_concessionaria, cod_filial) -> DataFrame:
    """Vehicle sales and what followed them, summed by columns of the sale: QTD_VENDAS, amounts of vehicles, services and parts, and all together.

    Sales are reduced to one row per buyer, day and ``keys``, and after-sales to one per buyer and day, so a generic buyer's sales don't meet the
    sums one by one.
    """
    amounts = ["RECEITA_VEICULO", "LUCRO_VEICULO"]
    sales = (
        _vehicle_sales(b, [*_BUYER, "DT_VENDA", *keys], dt_ini, dt_fim, cod_concessionaria, cod_filial)
        .groupBy(*_BUYER, "DT_VENDA", *keys)
        .agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in amounts])
    )
    filters = branch_keys(None, cod_filial)
    facts = _facts(b, (VEICULO, SERVICO, PECA), dt_ini, dt_fim, window_days, cod_concessionaria, filters)
    is_sale = (F.col("ORIGEM") == VEICULO) & (F.col("DT_VENDA") <= F.lit(dt_fim))
    if cod_filial is not None:
        is_sale = is_sale & (F.col("COD_FILIAL") == cod_filial)
    after = forward_sums(facts.withColumn("is_anchor", is_sale), _BUYER, "DT_VENDA", _AFTER, window_days)
    # After-sales count for each of the sales.
    each = after.select(*_BUYER, "DT_VENDA", *_AFTER)
    joined = sales.join(each, [*_BUYER, "DT_VENDA"], "left").withColumns(
        {c: or_zero(F.col(c)) * F.col("n").cast("decimal(18,0)") for c in _AFTER}
    )
    integrated = {
        "RECEITA_INTEGRADA": F.col("RECEITA_VEICULO") + F.col("RECEITA_SERVICOS") + F.col("RECEITA_PECAS"),
        "LUCRO_INTEGRADO": F.col("LUCRO_VEICULO") + F.col("LUCRO_SERVICOS") + F.col("LUCRO_PECAS"),
    }
    return joined.groupBy(*keys).agg(F.sum("n").alias("QTD_VENDAS"), *[F.sum(c).alias(c) for c in [*amounts, *_AFTER]]).withColumns(integrated)


def integrated_totals(
    b: Bronze, dt_ini: date, dt_fim: date, window_days: int = 30, cod_concessionaria: str | None = None, cod_filial: str | None = None
) -> DataFrame:
    """Revenue, profit and margin over all sales of the period with what followed them, one row.

    The same as totals over ``integrated_margin`` without a limit, from sums per buyer and day: no row per sale is joined or sorted.
    """
    total = _sums_by(b, [], dt_ini, dt_fim, window_days, cod_concessionaria, cod_filial)
    return total.select("RECEITA_INTEGRADA", "LUCRO_INTEGRADO", ratio(F.col("LUCRO_INTEGRADO"), F.col("RECEITA_INTEGRADA")).alias("MARGEM_INTEGRADA"))


def model_ranking(
    b: Bronze,
    dt_ini: date,
    dt_fim: date,
    window_days: int = 30,
    cod_concessionaria: str | None = None,
    cod_filial: str | None = None,
    top_n: int = 15,
    min_revenue: float = 0,
) -> DataFrame:
    """Models by integrated margin, among those whose vehicle revenue reaches ``min_revenue``."""
    model = ["MARCA_VEICULO", "MODELO_VEICULO"]
    shown = ["QTD_VENDAS", "RECEITA_VEICULO", "RECEITA_SERVICOS", "RECEITA_PECAS", "RECEITA_INTEGRADA", "LUCRO_INTEGRADO"]
    return (
        _sums_by(b, model, dt_ini, dt_fim, window_days, cod_concessionaria, cod_filial)
        .select(*model, *shown)
        .filter(F.col("RECEITA_VEICULO") >= F.lit(min_revenue))
        .withColumn("MARGEM_INTEGRADA", ratio(F.col("LUCRO_INTEGRADO"), F.col("RECEITA_INTEGRADA")))
        .orderBy(
            F.desc_nulls_last("MARGEM_INTEGRADA"),
            F.desc_nulls_last("RECEITA_INTEGRADA"),
            *[F.asc_nulls_last(c) for c in model],
        )
        .limit(top_n)
    )
