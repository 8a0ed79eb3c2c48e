import os
from decimal import Decimal

import pytest

from dealerchecks.compare import connect, difference
from dealerlake import schemas as S
from dealerlake.plans import branch, customers, daily, integrated, kpi, reports, stock
from dealerlake.session import setting
from tests.frames import D0, bronze, day, rows

SMALL = "/root/testdata/sf0.001"
PERIOD = (D0, day(364))


@pytest.fixture(scope="module")
def entry():
    import __spark_entry__

    return __spark_entry__


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
def test_every_registered_query_equals_its_sql(spark, entry):
    con = connect(SMALL)
    built, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(built)
    problems = {name: difference(spark, con, built[name], sql[name], SMALL) for name in sql}
    assert {n: p for n, p in problems.items() if p} == {}


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
def test_figures_agree_across_queries(spark):
    from dealerchecks import params as P
    from dealerchecks.business import bronze as star

    b, period = star(spark, SMALL), (P.DT_INI, P.DT_FIM)
    kpis = kpi.kpis_period(b, *period).first()
    monthly = sum(r.RECEITA_TOTAL for r in kpi.revenue_monthly(b, *period).collect())
    pnl = sum(r.RECEITA_TOTAL for r in kpi.pnl_monthly(b, *period).collect())
    performance = branch.branch_performance(b, *period, top_n=1000).collect()
    assert kpis.RECEITA_TOTAL == monthly == pnl == sum(r.RECEITA_TOTAL for r in performance)
    base = customers.rfm_base(b, *period)
    scored = customers.rfm_segments(customers.rfm_scores(base))
    assert sum(r.CLIENTES for r in customers.rfm_segment_summary(scored).collect()) == base.count()
    wide = integrated.integrated_margin(b, *period, window_days=30, limit=10**6).collect()
    none = integrated.integrated_margin(b, *period, window_days=0, limit=10**6).collect()
    assert sum(r.RECEITA_PECAS for r in none) <= sum(r.RECEITA_PECAS for r in wide)


def test_total_is_null_when_a_line_has_no_rows(spark):
    b = bronze(spark, veic=[{"VALOR_VENDA": 10, "LUCRO_VENDA": 1}], pec=[{"VALOR_VENDA": 5}])
    kpis = kpi.kpis_period(b, *PERIOD)
    assert rows(kpis, "RECEITA_TOTAL", "RECEITA_VEIC", "RECEITA_PEC", "LUCRO_PEC", "RECEITA_SRV") == [
        (None, Decimal("10.0000"), Decimal("5.0000"), Decimal("0.0000"), None)
    ]
    assert rows(reports.margins_period(kpis), "MARGEM_VEIC", "MARGEM_PEC", "MARGEM_SRV") == [(0.1, 0.0, None)]


def test_branch_filter(spark):
    b = bronze(
        spark,
        veic=[{"VALOR_VENDA": 10}, {"VALOR_VENDA": 20, "COD_FILIAL": "1-2"}, {"VALOR_VENDA": 40, "COD_CONCESSIONARIA": "2"}],
        pec=[{"VALOR_VENDA": 1}],
        srv=[{"VALOR_TOTAL_SERVICO": 1}, {"VALOR_TOTAL_SERVICO": 2, "COD_FILIAL": "1-2", "QTDE_SERVICOS": 4}],
        ep=[{"VALOR_PECA_ESTOQUE": 7}],
    )
    one = kpi.kpis_period(b, *PERIOD, cod_concessionaria="1", cod_filial="1-1")
    assert rows(one, "RECEITA_VEIC", "VALOR_ESTOQUE_PEC") == [(Decimal("10.0000"), Decimal("7.0000"))]
    assert rows(kpi.services_kpis(b, *PERIOD, cod_filial="1-2"), "REGISTROS", "TICKET_MEDIO_POR_REGISTRO") == [(1, 2.0)]
    flow = kpi.cashflow_proxy(b, *PERIOD, cod_concessionaria="2")
    assert {r.ITEM: r.VALOR for r in flow.collect()}["Receita veículos"] == Decimal("40.0000")


def test_branch_spelled_two_ways(spark):
    b = bronze(
        spark,
        veic=[
            {"VALOR_VENDA": 10, "LUCRO_VENDA": 1},
            {"VALOR_VENDA": 20, "LUCRO_VENDA": 2, "NOME_FILIAL": "a"},
        ],
        pec=[{"VALOR_VENDA": 100, "LUCRO_VENDA": 10}],
        ep=[{"VALOR_PECA_ESTOQUE": 5, "COD_FILIAL": "9-9", "NOME_FILIAL": "Z"}],
    )
    spelled = branch.branch_performance(b, *PERIOD)
    found = sorted(rows(spelled, "COD_FILIAL", "NOME_FILIAL", "VEIC_RECEITA", "PEC_RECEITA", "ROI_ESTOQUE"))
    assert found == [
        ("1-1", "A", Decimal(10), Decimal(100), None),
        ("1-1", "A", Decimal(20), Decimal(100), None),
        ("1-1", "a", Decimal(10), Decimal(100), None),
        ("1-1", "a", Decimal(20), Decimal(100), None),
        ("9-9", "Z", Decimal(0), Decimal(0), 0.0),
    ]
    merged = branch.branch_performance(b, *PERIOD, collapse_names=True)
    assert sorted(rows(merged, "COD_FILIAL", "NOME_FILIAL", "VEIC_RECEITA", "LUCRO_TOTAL")) == [
        ("1-1", "A", Decimal(30), Decimal(13)),
        ("9-9", "Z", Decimal(0), Decimal(0)),
    ]
    assert rows(spelled.limit(1), "NOME_FILIAL") == [("Z",)]


def test_roi_matches_stock_by_branch_code_only(spark):
    b = bronze(
        spark,
        veic=[{"LUCRO_VENDA": 6, "COD_CONCESSIONARIA": "1"}],
        ev=[{"CUSTO_VEICULO": 2, "COD_CONCESSIONARIA": "2"}],
        ep=[{"VALOR_PECA_ESTOQUE": 1, "NOME_FILIAL": "x"}, {"VALOR_PECA_ESTOQUE": 4, "NOME_FILIAL": "y"}],
    )
    assert sorted(rows(branch.roi_by_branch(b, *PERIOD), "CAPITAL_ESTOQUE", "ROI_ESTOQUE")) == [
        (Decimal(3), 2.0),
        (Decimal(6), 1.0),
    ]
    assert rows(branch.roi_by_branch(b, *PERIOD, collapse_names=True), "CAPITAL_ESTOQUE") == [(Decimal(7),)]


def test_missing_category_matches_nothing(spark):
    b = bronze(
        spark,
        pec=[{"VALOR_VENDA": 9}, {"VALOR_VENDA": 8, "CATEGORIA_PECA": "X"}],
        ep=[{"VALOR_PECA_ESTOQUE": 3}, {"VALOR_PECA_ESTOQUE": 4, "CATEGORIA_PECA": "X"}],
    )
    turnover = stock.part_turnover_by_category(b, *PERIOD)
    assert rows(turnover, "CATEGORIA_PECA", "RECEITA_PERIODO", "VALOR_ESTOQUE", "GIRO_PROXY") == [
        ("X", Decimal(8), Decimal(4), 2.0),
        (None, Decimal(0), Decimal(0), None),
    ]
    assert rows(reports.top_turnover(turnover), "CATEGORIA_PECA") == [("X",)]


def test_stockout_counts_the_window_up_to_the_day(spark):
    part = {"DESCRICAO_PECA": "p", "CATEGORIA_PECA": "c"}
    b = bronze(
        spark,
        pec=[part | {"QTDE_VENDIDA": 15, "DT_VENDA": day(1)}, part | {"QTDE_VENDIDA": 15, "DT_VENDA": day(90)}, {"QTDE_VENDIDA": 99}],
        ep=[part | {"QTDE_PECA_ESTOQUE": 10}, {"QTDE_PECA_ESTOQUE": 1}],
    )
    risk = stock.stockout_risk(b, day(30))
    assert rows(risk, "VENDAS_ND", "CONSUMO_MEDIO_DIA", "DIAS_COBERTURA") == [(Decimal(15), 0.5, 20.0)]
    assert rows(reports.restock_recommendation(risk), "RECOMENDACAO") == [("Manter",)]
    assert stock.stockout_risk(b, day(32)).count() == 0 and stock.stockout_risk(b, day(130)).count() == 0
    assert stock.stockout_risk(b, day(100), top_n=None).count() == 1


def test_obsolete_parts(spark):
    b = bronze(
        spark,
        ep=[
            {"CODIGO_PECA_ESTOQUE": "flag", "PECA_OBSOLETA_FLAG": " sim"},
            {"CODIGO_PECA_ESTOQUE": "idle", "TEMPO_OBSOLETA_DIAS": 60},
            {"CODIGO_PECA_ESTOQUE": "moving", "TEMPO_OBSOLETA_DIAS": 59, "PECA_OBSOLETA_FLAG": "NAO"},
        ],
    )
    assert rows(stock.obsolete_parts(b), "CODIGO_PECA_ESTOQUE") == [("idle",), ("flag",)]


def test_daily_means_count_days_with_rows(spark):
    today = day(40)
    sales = [(today, 1, 100, 10), (day(39), 2, 50, 10), (day(10), 4, 150, 15), (day(9), 99, 999, 9)]
    line = [{"DT_VENDA": d, "QTDE_VENDIDA": q, "VALOR_VENDA": v, "LUCRO_VENDA": p} for d, q, v, p in sales]
    b = bronze(spark, veic=line, pec=line)
    assert rows(daily.daily_vehicles(b, today)) == [(1, 2, 3.0, Decimal(100), Decimal(50), 100.0)]
    found = rows(daily.daily_parts(b, today), "MARGEM_HOJE", "QTD_MEDIA_30D", "MARGEM_MEDIA_30D")
    assert found == [(0.1, 3.0, pytest.approx(0.15))]
    assert rows(daily.daily_services(b, today)) == [(None, None, None, None)]
    deltas = reports.daily_deltas(*[f(b, today) for f in (daily.daily_vehicles, daily.daily_parts, daily.daily_services)])
    assert rows(deltas) == [("VEICULO", -1.0, 50.0), ("PECA", -2.0, 0.0), ("SERVICO", 0.0, 0.0)]


def test_a_generic_buyer_is_a_row_per_day_before_any_join(spark):
    """A third of all rows have one buyer; with broadcasts off no task joins or sorts more than a row per buyer and day of after-sales."""
    n = 3000
    name = lambda i: "CONSUMIDOR" if i % 3 == 0 else f"B{i}"
    b = bronze(
        spark,
        veic=[{"VALOR_VENDA": 100, "LUCRO_VENDA": 10, "NOME_COMPRADOR": name(i), "DT_VENDA": day(i % 10)} for i in range(300)],
        srv=[{"VALOR_TOTAL_SERVICO": 7, "LUCRO_SERVICO": 3, "NOME_CLIENTE": name(i), "DT_REALIZACAO_SERVICO": day(i % 10)} for i in range(n)],
        pec=[{"VALOR_VENDA": 2, "LUCRO_VENDA": 1, "NOME_COMPRADOR": name(i), "DT_VENDA": day(i % 10)} for i in range(n)],
    )
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        every = integrated.integrated_margin(b, *PERIOD, limit=None)
        totals = integrated.integrated_totals(b, *PERIOD)
        assert rows(totals) == rows(reports.integrated_totals(every))
        for df in (every, totals):
            lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
            # Read upwards from the facts: they are summed within tasks before their first shuffle.
            for at, line in enumerate(lines):
                if "Union" in line:
                    above = [x for x in reversed(lines[:at]) if "Exchange" in x or "HashAggregate" in x]
                    assert "partial_sum" in above[0]


def test_after_sales_count_for_every_sale_they_follow(spark):
    sale = {"VALOR_VENDA": 100, "LUCRO_VENDA": 10, "NOME_COMPRADOR": "ANA"}
    b = bronze(
        spark,
        veic=[sale, sale | {"DT_VENDA": day(5)}, sale | {"NOME_COMPRADOR": None}, sale | {"NOME_COMPRADOR": "ana"}],
        srv=[
            {"VALOR_TOTAL_SERVICO": 7, "LUCRO_SERVICO": 3, "NOME_CLIENTE": "ANA", "DT_REALIZACAO_SERVICO": day(30), "COD_FILIAL": "1-9"},
            {"VALOR_TOTAL_SERVICO": 1, "NOME_CLIENTE": "ANA", "DT_REALIZACAO_SERVICO": day(31)},
            {"VALOR_TOTAL_SERVICO": 50, "NOME_CLIENTE": "ANA", "COD_CONCESSIONARIA": "2"},
            {"VALOR_TOTAL_SERVICO": 50, "NOME_CLIENTE": None},
        ],
        pec=[{"VALOR_VENDA": 2, "LUCRO_VENDA": 1, "NOME_COMPRADOR": "ANA", "DT_VENDA": day(5)}],
    )
    found = integrated.integrated_margin(b, *PERIOD)
    assert sorted(rows(found, "NOME_COMPRADOR", "DT_VENDA", "RECEITA_SERVICOS", "RECEITA_PECAS", "LUCRO_INTEGRADO"), key=str) == [
        ("ANA", D0, Decimal(7), Decimal(2), Decimal(14)),
        ("ANA", day(5), Decimal(8), Decimal(2), Decimal(14)),
        ("ana", D0, Decimal(0), Decimal(0), Decimal(10)),
        (None, D0, Decimal(0), Decimal(0), Decimal(10)),
    ]
    every = integrated.integrated_margin(b, *PERIOD, limit=None)
    assert rows(integrated.integrated_totals(b, *PERIOD)) == rows(reports.integrated_totals(every)) == [(Decimal(419), Decimal(48), pytest.approx(48 / 419))]
    one = integrated.integrated_totals(b, *PERIOD, cod_concessionaria="1", cod_filial="none")
    assert rows(one) == [(None, None, None)]
    # A branch filter narrows the sales, not the after-sales; the period neither cuts the window.
    narrow = integrated.model_ranking(b, D0, D0, cod_concessionaria="1", cod_filial="1-1")
    assert rows(narrow, "QTD_VENDAS", "RECEITA_VEICULO", "RECEITA_SERVICOS") == [(3, Decimal(300), Decimal(7))]
    assert integrated.model_ranking(b, *PERIOD, min_revenue=401).count() == 0
    assert rows(integrated.model_ranking(b, *PERIOD, min_revenue=400), "QTD_VENDAS") == [(4,)]


def test_funnel_and_normalized_names(spark):
    b = bronze(
        spark,
        veic=[{"NOME_COMPRADOR": " ana "}, {"NOME_COMPRADOR": "ANA"}, {"NOME_COMPRADOR": "BIA"}, {"NOME_COMPRADOR": None}],
        srv=[{"NOME_CLIENTE": "Ana", "VALOR_TOTAL_SERVICO": 3}, {"NOME_CLIENTE": "CAIO"}],
        pec=[{"NOME_COMPRADOR": "BIA", "DT_VENDA": day(365)}],
    )
    assert rows(customers.customer_funnel(b, D0, day(365))) == [(2, 1, 0)]
    assert rows(customers.customer_funnel(b, D0, day(366))) == [(2, 1, 1)]
    ltv = customers.customer_ltv(b, *PERIOD)
    assert rows(ltv, "CLIENTE", "TRANSACOES") == [("ANA", 3), ("BIA", 1), ("CAIO", 1)]
    assert rows(customers.rfm_base(b, *PERIOD).filter("CLIENTE = 'ANA'"), "RECENCY_DIAS", "FREQUENCY") == [(364, 3)]


def test_year_comparison_needs_two_years(spark):
    one = bronze(spark, veic=[{"VALOR_VENDA": 1}])
    two = bronze(spark, veic=[{"VALOR_VENDA": 1}, {"VALOR_VENDA": 2, "DT_VENDA": day(400)}])
    assert reports.yoy_by_month(kpi.pnl_monthly(one, D0, day(800))).count() == 0
    pnl = kpi.pnl_monthly(two, D0, day(800))
    assert rows(reports.yoy_by_month(pnl)) == [(2025, 1, Decimal(1)), (2026, 2, Decimal(2))]
    assert rows(reports.last_12_months(pnl, 1), "MES") == [(day(396),)]


def test_benchmark_takes_the_best_row_of_a_name(spark):
    b = bronze(
        spark,
        veic=[{"VALOR_VENDA": 10, "LUCRO_VENDA": 1, "COD_FILIAL": c} for c in ("1-1", "1-2")]
        + [{"VALOR_VENDA": 4, "LUCRO_VENDA": 1, "COD_FILIAL": "2-1", "NOME_FILIAL": "B"}],
        ev=[{"CUSTO_VEICULO": v, "COD_FILIAL": c} for c, v in (("1-1", 4), ("1-2", 2))],
    )
    performance = branch.branch_performance(b, *PERIOD)
    plain = {r.METRICA: (r.FILIAL_A, r.FILIAL_B) for r in reports.branch_benchmark(performance, "A", "B").collect()}
    assert plain["ROI (lucro/estoque)"] == (0.5, None) and plain["Receita total"] == (10.0, 4.0)
    text = {r.METRICA: (r.FILIAL_A, r.FILIAL_B) for r in reports.branch_benchmark(performance, "A", "B", formatted=True).collect()}
    assert text["ROI (lucro/estoque)"] == ("50,00%", "-") and text["Receita total"] == ("R$ 10,00", "R$ 4,00")
    assert rows(reports.branch_totals(performance)) == [(Decimal(3), Decimal(6), 0.5)]


def test_report_text(spark):
    numbers = [1234567.885, 0.12345, 3.9, -1234.5, -0.5, 0.125, 0.375, 1e9, -0.005]
    df = spark.createDataFrame([(x, x, x) for x in numbers] + [(None, None, None)], "a double, b double, c double")

    def swapped(x):
        return f"{x:,.2f}".translate(str.maketrans(",.", ".,"))

    expected = [(f"R$ {swapped(x)}", f"{swapped(x * 100)}%", str(int(x))) for x in numbers] + [("R$ 0,00", "-", "0")]
    assert rows(reports.format_report(df, money=["a"], pct=["b"], ints=["c"])) == expected


def test_scans_read_only_what_a_query_needs(spark):
    b = bronze(spark)
    assert b.table(S.HIST_SERVICOS, ["LUCRO_SERVICO"], PERIOD).columns == ["LUCRO_SERVICO"]
    assert b.transactions(["DT"], PERIOD, origins=["PECA"]).columns == ["ORIGEM", "DT"]
