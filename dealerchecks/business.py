"""Registered business queries and analytics: name -> DataFrame over the star tables in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealerchecks import params as P
from dealerlake.operators import series
from dealerlake.plans import branch, customers, daily, integrated, kpi, reports, stock
from dealerlake.functions.amounts import ratio
from dealerlake.session import written
from dealerlake.sources.bronze import Bronze
from dealerlake.sources.star import StarBronze, star_table
from dealerlake.sqlgate import safe_sql
from dealerlake import schemas as S

_PERIOD = (P.DT_INI, P.DT_FIM)
_BRANCH_KEYS = ["COD_CONCESSIONARIA", "COD_FILIAL"]


def bronze(spark: SparkSession, folder: str) -> Bronze:
    return StarBronze(spark, folder, P.AS_OF)


def _three_series(b: Bronze) -> DataFrame:
    """The daily series of all three lines under one key."""
    return daily.series_all_lines(b, *_PERIOD).withColumnRenamed("ORIGEM", "SERIE")


def _dense(b: Bronze) -> DataFrame:
    return series.densify_daily(_three_series(b), *_PERIOD, keys=["SERIE"])


def _frame(b: Bronze) -> DataFrame:
    """History and forecast of one table, which has a row per day and series and is written once."""
    dense = written(_dense(b))
    return series.forecast_frame(dense, series.forecast_ma(dense, P.HORIZON, P.MA_WINDOW, keys=["SERIE"]), keys=["SERIE"])


def _deltas(b: Bronze) -> DataFrame:
    days = daily.last_days(b, P.AS_OF)
    return reports.daily_deltas(*[f(b, P.AS_OF, days) for f in (daily.daily_vehicles, daily.daily_parts, daily.daily_services)])


def _dense_by_branch(b: Bronze) -> DataFrame:
    return series.densify_daily(
        daily.series_parts_revenue(b, *_PERIOD, keys=_BRANCH_KEYS), *_PERIOD, keys=_BRANCH_KEYS
    )


def _forecast(b: Bronze) -> DataFrame:
    return series.forecast_ma(_dense(b), P.HORIZON, P.MA_WINDOW, keys=["SERIE"])


def _risk(b: Bronze) -> DataFrame:
    return stock.stockout_risk(b, P.AS_OF, P.WINDOW_DAYS, top_n=None)


# With the dealer given and, as an optional bind, left out.
_BOUND = """SELECT :label AS DEALER, COD_FILIAL, count(*) AS REGISTROS, sum(coalesce(VALOR_TOTAL_SERVICO, 0)) AS RECEITA FROM {services}
WHERE DT_REALIZACAO_SERVICO BETWEEN :since AND :until AND (:dealer IS NULL OR COD_CONCESSIONARIA = :dealer) GROUP BY COD_FILIAL"""


def _bound(spark: SparkSession, folder: str) -> DataFrame:
    b = bronze(spark, folder)
    services = (S.HIST_SERVICOS, ["COD_CONCESSIONARIA", "COD_FILIAL", "DT_REALIZACAO_SERVICO", "VALOR_TOTAL_SERVICO"])
    binds = {"since": P.DT_INI, "until": P.AS_OF}
    one, every = (b.query(spark, _BOUND, binds | {"dealer": dealer, "label": dealer or "all"}, services=services) for dealer in (P.DEALER, None))
    return one.unionByName(every)


def _integrated(b: Bronze) -> DataFrame:
    return integrated.integrated_margin(b, *_PERIOD, window_days=P.WINDOW_DAYS, limit=None)


def _models(b: Bronze) -> DataFrame:
    return integrated.model_ranking(b, *_PERIOD, window_days=P.WINDOW_DAYS)


def _performance(b: Bronze) -> DataFrame:
    """All branches, for totals and for rankings by something else than the ROI."""
    return branch.branch_performance(b, *_PERIOD, top_n=None)


def _scores(b: Bronze) -> DataFrame:
    return customers.rfm_scores(customers.rfm_base(b, *_PERIOD))


def _vendor_report(b: Bronze) -> DataFrame:
    sales = b.table(S.HIST_VENDAS_VEICULOS, ["NOME_VENDEDOR", "QTDE_VENDIDA", "VALOR_VENDA", "LUCRO_VENDA"], _PERIOD)
    by_vendor = sales.groupBy(F.col("NOME_VENDEDOR").alias("VENDEDOR")).agg(
        F.sum("QTDE_VENDIDA").alias("QTD"), F.sum("VALOR_VENDA").alias("RECEITA"), F.sum("LUCRO_VENDA").alias("LUCRO")
    )
    by_vendor = by_vendor.withColumn("MARGEM", ratio(F.col("LUCRO"), F.col("RECEITA")))
    return reports.format_report(by_vendor, money=["RECEITA", "LUCRO"], pct=["MARGEM"], ints=["QTD"])


def _gated(spark: SparkSession, folder: str) -> DataFrame:
    for name in ("supplier", "nation"):
        star_table(spark, folder, name).createOrReplaceTempView(name)
    return safe_sql(
        spark,
        """```sql
        SELECT n_name AS NOME_FILIAL, count(*) AS FORNECEDORES
        FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY n_name;
        ```""",
    )


def _own_limit(spark: SparkSession, folder: str) -> DataFrame:
    star_table(spark, folder, "customer").createOrReplaceTempView("customer")
    return safe_sql(spark, "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 1000")


BUSINESS = {
    "kpis_period": lambda b: kpi.kpis_period(b, *_PERIOD),
    "revenue_monthly": lambda b: kpi.revenue_monthly(b, *_PERIOD),
    "pnl_monthly": lambda b: kpi.pnl_monthly(b, *_PERIOD),
    "roi_by_branch": lambda b: branch.roi_by_branch(b, *_PERIOD),
    "profit_by_vendor": lambda b: kpi.profit_by_vendor(b, *_PERIOD),
    "stock_kpis": stock.stock_kpis,
    "top_parts_stock_value": stock.top_parts_stock_value,
    "part_turnover_by_category": lambda b: stock.part_turnover_by_category(b, *_PERIOD),
    "stock_days_monthly": lambda b: stock.stock_days_monthly(b, *_PERIOD),
    "daily_vehicles": lambda b: daily.daily_vehicles(b, P.AS_OF),
    "daily_parts": lambda b: daily.daily_parts(b, P.AS_OF),
    "top10_parts_today": lambda b: daily.top10_parts_today(b, P.AS_OF),
    "daily_services": lambda b: daily.daily_services(b, P.AS_OF),
    "series_vehicles_units": lambda b: daily.series_vehicles_units(b, *_PERIOD),
    "series_parts_revenue": lambda b: daily.series_parts_revenue(b, *_PERIOD),
    "series_services_revenue": lambda b: daily.series_services_revenue(b, *_PERIOD),
    "branch_performance": lambda b: branch.branch_performance(b, *_PERIOD),
    "branch_performance_collapsed": lambda b: branch.branch_performance(b, *_PERIOD, collapse_names=True),
    "stockout_risk": lambda b: stock.stockout_risk(b, P.AS_OF, P.WINDOW_DAYS),
    "obsolete_parts": stock.obsolete_parts,
    "services_kpis": lambda b: kpi.services_kpis(b, *_PERIOD),
    "services_kpis_of_dealer": lambda b: kpi.services_kpis(b, *_PERIOD, cod_concessionaria=P.DEALER),
    "integrated_margin_of_dealer": lambda b: integrated.integrated_margin(
        b, *_PERIOD, window_days=P.WINDOW_DAYS, cod_concessionaria=P.DEALER
    ),
    "services_by_department": lambda b: kpi.services_by_department(b, *_PERIOD),
    "services_by_category": lambda b: kpi.services_by_category(b, *_PERIOD),
    "integrated_margin": lambda b: integrated.integrated_margin(b, *_PERIOD, window_days=P.WINDOW_DAYS),
    "model_ranking": _models,
    "cashflow_proxy": lambda b: kpi.cashflow_proxy(b, *_PERIOD),
    "customer_funnel": lambda b: customers.customer_funnel(b, P.DT_INI, P.DT_FIM.replace(year=P.DT_FIM.year + 1, month=1, day=1)),
    "customer_ltv": lambda b: customers.customer_ltv(b, *_PERIOD),
    "rfm_base": lambda b: customers.rfm_base(b, *_PERIOD),
    "margins_period": lambda b: reports.margins_period(kpi.kpis_period(b, *_PERIOD)),
    "pnl_vs_goal": lambda b: reports.pnl_vs_goal(kpi.pnl_monthly(b, *_PERIOD), P.PROFIT_GOAL),
    "stock_vs_goal": lambda b: reports.stock_vs_goal(stock.stock_kpis(b), P.VEHICLE_STOCK_GOAL, P.PART_STOCK_GOAL),
    "top_roi": lambda b: reports.top_roi(branch.roi_by_branch(b, *_PERIOD)),
    "top_turnover": lambda b: reports.top_turnover(stock.part_turnover_by_category(b, *_PERIOD)),
    "stock_days_now_vs_history": lambda b: reports.stock_days_now_vs_history(
        stock.stock_days_monthly(b, *_PERIOD), stock.stock_kpis(b)
    ),
    "top_branches_by_roi": lambda b: reports.top_branches_by_roi(_performance(b)),
    "top_branches_by_profit": lambda b: reports.top_branches_by_profit(_performance(b)),
    "branch_table": lambda b: reports.branch_table(_performance(b)),
    "last_12_months": lambda b: reports.last_12_months(kpi.pnl_monthly(b, *_PERIOD)),
    "yoy_by_month": lambda b: reports.yoy_by_month(kpi.pnl_monthly(b, *_PERIOD)),
    "densify_daily": _dense,
    "densify_daily_by_branch": _dense_by_branch,
    "forecast_ma": _forecast,
    "forecast_ma_by_branch": lambda b: series.forecast_ma(
        _dense_by_branch(b), P.HORIZON, P.MA_WINDOW, keys=_BRANCH_KEYS
    ),
    "forecast_ma_bootstrap": lambda b: series.forecast_ma_bootstrap(
        _dense(b), P.HORIZON, P.MA_WINDOW, keys=["SERIE"], n_sim=P.N_SIM, seed=P.SEED
    ),
    "forecast_frame": _frame,
    "forecast_intervals": lambda b: series.forecast_intervals(_forecast(b), P.HORIZON, keys=["SERIE"]),
    "restock_recommendation": lambda b: reports.restock_recommendation(_risk(b)),
    "margin_uplift": lambda b: reports.margin_uplift(_integrated(b)),
    "integrated_totals": lambda b: integrated.integrated_totals(b, *_PERIOD, window_days=P.WINDOW_DAYS),
    "model_label": lambda b: reports.model_label(_models(b)),
    "branch_totals": lambda b: reports.branch_totals(_performance(b)),
    "branch_benchmark": lambda b: reports.branch_benchmark(_performance(b), P.BRANCH_A, P.BRANCH_B),
    "branch_benchmark_formatted": lambda b: reports.branch_benchmark(
        _performance(b), P.BRANCH_A, P.BRANCH_B, formatted=True
    ),
    "rfm_scores": _scores,
    "rfm_segments": lambda b: customers.rfm_segments(_scores(b)),
    "rfm_segment_summary": lambda b: customers.rfm_segment_summary(customers.rfm_segments(_scores(b))),
    "daily_deltas": _deltas,
    "format_report": _vendor_report,
}


def business_queries() -> dict:
    def over_star(build):
        return lambda spark, folder: build(bronze(spark, folder))

    return {name: over_star(build) for name, build in BUSINESS.items()} | {
        "named_binds": _bound,
        "safe_sql": _gated,
        "safe_sql_own_limit": _own_limit,
    }
