"""What the plans must look like for the queries to hold at scale."""

import os

import pytest

from dealerlake import schemas as S
from dealerlake.operators import cleaning
from dealerlake.plans import kpi
from dealerlake.sources.bronze import Bronze
from dealerlake.sources.csv import detect_dialects
from tests.frames import D0, bronze, day

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
def test_no_python_no_products_in_any_registered_query(spark):
    import __spark_entry__

    for name, build in __spark_entry__.own_queries().items():
        text = plan(build(spark, SMALL))
        for forbidden in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
            assert forbidden not in text, (name, forbidden)


@needs_data
def test_period_reaches_the_files(spark):
    from dealerchecks.business import bronze as star

    text = plan(kpi.revenue_monthly(star(spark, SMALL), D0, day(30)))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
    assert "l_partkey" not in text and "orders" not in text


def test_period_prunes_months(spark, tmp_path):
    for name, table in S.TABLES.items():
        spark.createDataFrame([], table.schema.add(S.MONTH_PARTITION, "integer") if table.date else table.schema).write.parquet(
            f"{tmp_path}/{name}"
        )
    b = Bronze.from_path(spark, str(tmp_path))
    text = plan(b.table(S.HIST_VENDAS_PECAS, ["VALOR_VENDA"], (D0, day(30))))
    assert "ReadSchema: struct<DT_VENDA:date,VALOR_VENDA:decimal(18,2)" in text
    assert "ANO_MES" in text and "202501" in text


def test_one_pass_aggregates(spark):
    b = bronze(spark)
    assert plan(kpi.kpis_period(b, D0, day(1))).count("Exchange") == 1


@needs_data
def test_series_of_all_lines_scan_once(spark):
    from dealerchecks.business import BUSINESS
    from dealerchecks.business import bronze as star

    for name in ("densify_daily", "forecast_ma"):
        assert plan(BUSINESS[name](star(spark, SMALL))).count("lineitem.parquet") == 1, name
    # These two write the days they use first.
    for name in ("forecast_frame", "daily_deltas"):
        assert "lineitem.parquet" not in plan(BUSINESS[name](star(spark, SMALL))), name


@needs_data
def test_integrated_margin_scans_the_days_of_its_sales(spark):
    from dealerchecks import params as P
    from dealerchecks.business import bronze as star
    from dealerlake.plans import integrated

    text = plan(integrated.integrated_margin(star(spark, SMALL), P.DT_INI, P.DT_FIM, limit=5))
    assert "l_shipdate,1995" not in text.replace(" ", "") and "l_shipdate,2001" in text.replace(" ", "")


def test_dialects_hash_lines_instead_of_sorting_them(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n1;2\n")
    text = plan(detect_dialects(spark, str(tmp_path)))
    assert "ObjectHashAggregate" in text and "SortAggregate" not in text


def test_copies_collapse_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a", "x")], "ord int, k string, v string")
    text = plan(cleaning.dedupe_keep_first(df, "ord", ["k"]))
    assert "partial_min_by" in text and "Window" not in text


def test_database_options(spark):
    """Only the options: no database is at hand."""
    from dealerlake.sources.bronze import id_range_query, slice_options
    from dealerlake.sources.sink import Target, jdbc_options

    assert id_range_query(S.HIST_SERVICOS) == f"(SELECT min(ID_SERVICO) AS lo, max(ID_SERVICO) AS hi FROM {S.HIST_SERVICOS}) r"
    expected = {"partitionColumn": "ID_SERVICO", "lowerBound": "0", "upperBound": "99", "numPartitions": "4"}
    assert slice_options(S.HIST_SERVICOS, 4, (0, 99)) == expected
    assert slice_options(S.HIST_SERVICOS, 1, (0, 99)) == slice_options(S.HIST_SERVICOS, 4, (None, None)) == {}
    options = jdbc_options(S.HIST_SERVICOS, Target(jdbc={"url": "jdbc:x", "numPartitions": "3"}))
    assert options["numPartitions"] == "3" and options["dbtable"] == S.HIST_SERVICOS
    assert int(jdbc_options(S.HIST_SERVICOS, Target(jdbc={"url": "jdbc:x"}))["numPartitions"]) > 0
