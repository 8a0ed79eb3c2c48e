import math
import random
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealerlake.operators import cleaning, series
from dealerlake.operators.forward_sum import forward_sums
from dealerlake.operators.ranks import row_numbers
from dealerlake.plans import customers
from dealerlake.functions import clean
from tests.frames import D0, day, rows


def column(spark, values, expression, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    trimmed = df.withColumn("t", clean.text(F.col("v")))
    return [r[0] for r in trimmed.orderBy("i").select(expression(F.col("t"))).collect()]


def test_dates(spark):
    iso = ["2025-01-05", "2025-1-5", "05/01/2025", "2025-01-05 10:00", "nan", "", None, "2025-02-30", "12025-01-05"]
    assert column(spark, iso, clean.iso_date) == [date(2025, 1, 5)] * 2 + [None] * 7
    br = ["01/2/2025", "31/02/2025", "2025-01-05", " 1/1/2025 "]
    assert column(spark, br, clean.br_date) == [date(2025, 2, 1), None, None, date(2025, 1, 1)]


def test_numbers(spark):
    texts = ["1.234,56", "1234,5", "178139.58", "1.234", "1,234,567", "abc", "nan", "inf", "1d", "0x10", "", None, "-,5", "1e3"]
    found = [None if v is None else float(v) for v in column(spark, texts, clean.locale_number)]
    assert found == [1234.56, 1234.5, 178139.58, 1.23, None, None, None, None, None, None, None, None, -0.5, 1000.0]
    assert [None if v is None else float(v) for v in column(spark, ["1,5", " 1.5 ", "1e400"], clean.strict_number)] == [None, 1.5, None]
    assert column(spark, ["3,7", "-3.7", "1.234,5", "inf", "1e30"], clean.integer) == [3, -3, None, None, None]
    assert column(spark, ["3.7", "3,7"], clean.strict_integer) == [3, None]


def python_date(text, pattern):
    try:
        return datetime.strptime(text.strip(), pattern).date()
    except ValueError:
        return None


def python_number(text):
    try:
        number = float(text)
    except ValueError:
        return None
    return number if math.isfinite(number) else None


def python_locale(text):
    text = text.strip()
    return text.replace(".", "").replace(",", ".") if "," in text and "." in text else text.replace(",", ".")


def test_rules_on_random_text(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice("0123456789.,-+eE") for _ in range(rng.randrange(9))) for _ in range(4000)]
    texts = [rng.choice(["", "", " ", "\t"]) + t + rng.choice(["", "", " "]) for t in texts]
    dates = [
        f"{rng.choice(['', ' '])}{rng.randrange(3000):0{rng.choice([1, 4])}d}-{rng.randrange(15)}-{rng.randrange(34):02d}{rng.choice(['', '', ' ', 'x'])}"
        for _ in range(2000)
    ]
    assert column(spark, dates, clean.iso_date) == [python_date(t, "%Y-%m-%d") for t in dates]
    turned = ["/".join(reversed(t.strip().split("-"))) for t in dates]
    assert column(spark, turned, clean.br_date) == [python_date(t, "%d/%m/%Y") for t in turned]

    def money(number_text):
        if python_number(number_text) is None:
            return None
        exact = Decimal(number_text.strip()).quantize(Decimal("0.01"), ROUND_HALF_UP) if abs(python_number(number_text)) < 1e16 else None
        return exact

    def whole(number_text):
        number = python_number(number_text)
        return None if number is None or abs(number) >= 2**63 else int(number)

    assert column(spark, texts, clean.locale_number) == [money(python_locale(t)) for t in texts]
    assert column(spark, texts, clean.strict_number) == [money(t) for t in texts]
    assert column(spark, texts, clean.integer) == [whole(t.replace(",", ".")) for t in texts]


def test_flags_ages_and_lists(spark):
    assert column(spark, ["True", "1", "Y", "não", "0", "x", ""], clean.flag) == ["SIM"] * 3 + ["NAO"] * 2 + [None] * 2
    ages = ["MENOS DE 1 MES", "1 a 3 meses", "2 A 3 ANOS", "45", "MAIS DE 3 ANOS", None, "DE 9 A 12 MESES"]
    assert column(spark, ages, clean.age_days) == [15, 60, 900, 45, None, None, 315]
    assert column(spark, [" sp ", "XX", None], lambda c: clean.one_of(c, clean.STATES)) == ["SP", None, None]
    assert column(spark, ["Sudeste", "LESTE"], lambda c: clean.one_of(c, clean.REGIONS)) == ["SUDESTE", None]
    assert len(set(clean.STATES)) == 27


def test_codes(spark):
    df = spark.createDataFrame(
        [("CCM", "ccm autos 2"), ("5", "other"), (None, " other "), ("5", None), (" ", "x")], "d string, f string"
    )
    assert rows(cleaning.derive_branch_codes(df, "d", "f"), "COD_CONCESSIONARIA", "COD_FILIAL") == [
        ("0", "0-1-2"),
        ("5", "5-1-0"),
        (None, "other"),
        ("5", None),
        (None, "x"),
    ]


def test_mojibake(spark):
    texts = ["JOSÃ\u0089", "ANDRÉ", "ANDRÃ‰", "MARIA", "東京", "a\nÃ©", None]
    assert column(spark, texts, clean.fix_mojibake) == ["JOSÉ", "ANDRÉ", "ANDRÃ‰", "MARIA", "東京", "a\né", None]


def test_strings_and_tokens(spark):
    assert column(spark, [" a ", "\t", "", None], clean.text) == ["a", None, None, None]
    df = spark.createDataFrame([("NA",), (" NA",), ("null",), ("x",)], "v string")
    assert rows(cleaning.null_tokens(df)) == [(None,), (" NA",), (None,), ("x",)]
    df = spark.createDataFrame([(None,), ("nan",), (" None",), (" 0.5",)], "v string")
    assert rows(cleaning.default_zero(df, "v")) == [("0",), ("0",), ("0",), (" 0.5",)]


def test_dedupe_keeps_the_first_of_each(spark):
    data = [(3, "a", None, "third"), (1, "a", None, "first"), (2, "a", "x", "other"), (4, None, None, "null")]
    df = spark.createDataFrame(data, "ord int, k string, l string, v string")
    assert sorted(rows(cleaning.dedupe_keep_first(df, "ord", ["k", "l"]), "v")) == [("first",), ("null",), ("other",)]
    same = df.select("ord", "l")
    assert sorted(rows(cleaning.dedupe_keep_first(same, "ord"), "ord")) == [(1,), (2,)]


def test_dedupe_by_number_aggregates_no_whole_rows(spark, monkeypatch):
    data = [(3, "a", None, "third"), (1, "a", None, "first"), (2, "a", "x", "other"), (4, None, None, "null"), (5, None, None, "again")]
    df = spark.createDataFrame(data, "ord long, k string, l string, v string")
    plans, write = [], cleaning.written
    monkeypatch.setattr(cleaning, "written", lambda d: plans.append(d._jdf.queryExecution().executedPlan().toString()) or write(d))
    assert sorted(rows(cleaning.dedupe_numbered(df, "ord", ["k", "l", "absent"]), "v")) == [("first",), ("null",), ("other",)]
    assert "HashAggregate" in plans[0] and "SortAggregate" not in plans[0]
    assert sorted(rows(cleaning.dedupe_numbered(df.select("ord", "l"), "ord"), "ord")) == [(1,), (2,)]


def test_contract(spark):
    df = spark.createDataFrame([("1", None), (None, None), ("1", "longer")], "a string, b string")
    assert rows(cleaning.contract_rejects(df, ["a"], {"b": 5}), "REASON") == [("missing: a",), ("longer than 5: b",)]
    assert rows(cleaning.contract_valid(df, ["a"], {"b": 5})) == [("1", None)]


def test_forward_sums_with_a_hot_key_equals_brute_force(spark):
    rng = random.Random(7)
    data = []
    for _ in range(3000):
        key = "hot" if rng.random() < 0.4 else rng.choice("abcdefgh")
        data.append((key if rng.random() > 0.02 else None, day(rng.randrange(60)), rng.random() < 0.3, rng.randrange(100)))
    df = spark.createDataFrame(data, "k string, d date, is_anchor boolean, v int")
    expected = {
        (k, d): sum(v for k2, d2, _, v in data if k2 == k and d <= d2 <= d + timedelta(days=7))
        for k, d, anchor, _ in data
        if anchor and k is not None
    }
    found = forward_sums(df, ["k"], "d", ["v"], 7)
    assert {(r.k, r.d): r.v for r in found.collect()} == expected
    assert found.count() == len(expected)


def test_row_numbers_with_a_hot_value(spark):
    data = [(f"c{i:04d}", 1 if i % 3 == 0 else i % 50, i * 7919 % 1000) for i in range(2000)] + [(None, 1, 1)]
    df = spark.createDataFrame(data, "key string, f long, m long")
    found = {r.key: (r.F_PLACE, r.M_PLACE, r.n, r.f) for r in row_numbers(df, "key", {"F": "f", "M": "m"}).collect()}

    def order(i):
        ranked = sorted(data, key=lambda t: (t[i], t[0] is not None, t[0] or ""))
        return {t[0]: place for place, t in enumerate(ranked, 1)}

    by_f, by_m = order(1), order(2)
    assert found == {k: (by_f[k], by_m[k], 2001, f) for k, f, _ in data}


@pytest.mark.parametrize("n, scores", [(1, [1]), (2, [1, 5]), (7, [1, 1, 2, 3, 4, 5, 5])])
def test_quintiles(spark, n, scores):
    df = spark.createDataFrame([(f"c{i}", D0, 10 - i, i, i) for i in range(n)], "CLIENTE string, ULTIMA_DATA date, RECENCY_DIAS long, FREQUENCY long, MONETARY long")
    found = customers.rfm_scores(df).orderBy("CLIENTE")
    assert [r.F_SCORE for r in found.collect()] == scores
    assert [r.R_SCORE for r in found.collect()] == [6 - s for s in reversed(scores)]


def test_densify(spark):
    df = spark.createDataFrame([("a", day(2), 5), ("a", day(4), 1), ("b", day(0), 2), ("b", day(9), 3)], "k string, DIA date, Y int")
    dense = series.densify_daily(df, day(1), day(5), keys=["k"])
    assert [(r.k, r.DIA, int(r.Y)) for r in dense.orderBy("k", "DIA").collect()] == [
        ("a", day(1), 0), ("a", day(2), 5), ("a", day(3), 0), ("a", day(4), 1), ("a", day(5), 0),
    ]
    empty = series.densify_daily(df.filter("false"), day(1), day(3))
    assert [(r.DIA, int(r.Y)) for r in empty.orderBy("DIA").collect()] == [(day(1), 0), (day(2), 0), (day(3), 0)]
    assert [int(r.Y) for r in series.densify_daily(df, day(1), day(3)).orderBy("DIA").collect()] == [0, 5, 0]


def reference_bounds(y, window):
    """Point, residuals and exact percentiles of the floored draws, in plain numpy."""
    fitted = [np.mean(y[:window]) if i < window else np.mean(y[i - window : i]) for i in range(len(y))]
    point = np.mean(y[-window:])
    draws = np.clip(point + (np.array(y) - np.array(fitted)), 0, None)
    return point, np.percentile(draws, [10, 90, 2.5, 97.5])


def test_forecast(spark):
    rng = np.random.default_rng(3)
    histories = {"a": rng.poisson(4, 60).tolist(), "b": rng.poisson(90, 25).tolist(), "short": [1] * 8 + [10]}
    data = [(k, day(i), int(y)) for k, ys in histories.items() for i, y in enumerate(ys)]
    df = spark.createDataFrame(data, "k string, DIA date, Y int")
    forecast = series.forecast_ma(df, 30, 7, keys=["k"])
    by_key = {}
    for r in forecast.orderBy("T").collect():
        by_key.setdefault(r.k, []).append(r)
    for k in ("a", "b"):
        point, bounds = reference_bounds(histories[k], 7)
        for step, r in enumerate(by_key[k], 1):
            assert (r["T"], r.DIA) == (step, day(len(histories[k]) - 1 + step))
            assert r.YHAT == pytest.approx(point)
            assert [r.YHAT_80_LO, r.YHAT_80_HI, r.YHAT_95_LO, r.YHAT_95_HI] == pytest.approx(list(bounds))
    assert {tuple(r)[3:] for r in by_key["short"]} == {(2.0,) * 5}
    assert series.forecast_intervals(forecast, 30, keys=["k"]).count() == 45
    assert series.forecast_frame(df, forecast, keys=["k"]).count() == len(data) + 90
    assert series.forecast_ma(df.drop("k").filter("false"), 5, 7).count() == 0


def test_bootstrap_tends_to_the_exact_bounds(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(day(i), int(y)) for i, y in enumerate(rng.poisson(50, 120))], "DIA date, Y int")
    exact = series.forecast_ma(df, 2, 7).first()
    drawn = series.forecast_ma_bootstrap(df, 2, 7, n_sim=4000)
    assert drawn.count() == 2
    for r in drawn.collect():
        assert r.YHAT == exact.YHAT
        for c in series.BOUNDS:
            assert r[c] == pytest.approx(exact[c], abs=3)
    assert rows(drawn) == rows(series.forecast_ma_bootstrap(df.repartition(7), 2, 7, n_sim=4000))
