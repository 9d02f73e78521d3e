from decimal import Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendlens.operators import power

VALUES = (1, 1, 2, 3, 5, 8, 13, 21)


def frame(spark):
    return spark.createDataFrame([(float(v), 1.0) for v in VALUES], "AMT_A double, AMT_CONST double")


def test_skew_is_bias_adjusted(spark):
    got = {r["column"]: (r["n"], r["skew"]) for r in power.skew_table(frame(spark), ["AMT_A", "AMT_CONST"]).collect()}
    assert got["AMT_A"][0] == 8 and got["AMT_A"][1] == pytest.approx(1.4006474, abs=1e-6)
    assert got["AMT_CONST"][1] == 0.0
    four = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 9.0)], "x double")
    assert power.skew_table(four, ["x"]).first()["skew"] == pytest.approx(1.3309377, abs=1e-6)
    two = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert power.skew_table(two, ["x"]).first()["skew"] is None


def test_candidates_by_name_and_type(spark):
    df = spark.createDataFrame([(1.0, 2, "x", 3)], "DAYS_EMPLOYED double, INST_AMT_PAYMENT_min int, AMT_TEXT string, CNT int")
    assert power.candidates(df) == ["DAYS_EMPLOYED", "INST_AMT_PAYMENT_min"]


def test_grid_and_fit(spark):
    df = frame(spark)
    logs = power.signed_logs(df, ["AMT_A"])
    grid = {r["lambda"]: r["loglik"] for r in power.likelihood_grid(logs, {0: power.even_grid(-2, 2)}).collect()}
    best = max(grid, key=grid.get)
    assert best == pytest.approx(-0.2) and grid[best] == pytest.approx(-12.017760, abs=1e-6)
    lam = power.fit_power(df)
    assert lam.keys() == {"AMT_A"} and lam["AMT_A"] == pytest.approx(-0.248134, abs=1e-4)


def test_fit_leaves_the_first_interval(spark):
    # nearly constant amounts with a short left tail want a large lambda
    x = 100.0 - np.random.default_rng(1).exponential(3.0, 400)
    df = spark.createDataFrame([(float(v),) for v in x], "AMT_B double")
    lam = power.fit_lambdas(df, ["AMT_B"])["AMT_B"]
    near = power.likelihood_grid(power.signed_logs(df, ["AMT_B"]), {0: [lam - 0.01, lam, lam + 0.01]}).collect()
    assert lam > 2 and max(near, key=lambda r: r["loglik"])["lambda"] == lam


def test_constant_column_has_no_lambda(spark):
    assert power.fit_lambdas(frame(spark), ["AMT_CONST"]) == {}
    assert power.fit_lambdas(frame(spark), []) == {}


def test_apply_keeps_other_columns(spark):
    out = power.apply_power(frame(spark), {"AMT_A": 0.0})
    assert out.columns == ["AMT_A", "AMT_CONST"]
    assert out.agg(F.max("AMT_A")).first()[0] == pytest.approx(np.log1p(21))


def likelihood(values, lam):
    """The log-likelihood in 60 digits, by the definition."""
    with localcontext() as c:
        c.prec = 60
        lam, two = Decimal(lam), Decimal(2)
        y = []
        for v in map(Decimal, values):
            if v >= 0:
                y.append((((v + 1) ** lam) - 1) / lam)
            else:
                y.append(-(((1 - v) ** (two - lam)) - 1) / (two - lam))
        mean = sum(y) / len(y)
        var = sum((v - mean) ** 2 for v in y) / len(y)
        jacobian = sum((1 + abs(v)).ln() * (1 if v > 0 else -1) for v in map(Decimal, values))
        return -Decimal(len(y)) / 2 * var.ln() + (lam - 1) * jacobian


@pytest.mark.parametrize("shape", ["positive", "mixed", "negative"])
def test_any_unit_has_a_lambda(spark, shape):
    draw = np.random.default_rng(6)
    x = np.exp(draw.normal(size=80)) - (1.5 if shape == "mixed" else 0.0)
    x = -x if shape == "negative" else x
    units = [1e-12, 1e-9, 1e-3, 1.0, 1e3, 1e6, 1e12]
    cols = [f"AMT_{i}" for i in range(len(units))]
    df = spark.createDataFrame([tuple(float(v * u) for u in units) for v in x], ", ".join(f"{c} double" for c in cols))
    got = power.fit_lambdas(df, cols)
    assert list(got) == cols
    for c, u in zip(cols, units):
        values = [float(v * u) for v in x]
        near = 1e-3 / float(np.log1p(np.abs(values)).max())
        here, less, more = (likelihood(values, float(got[c] + d)) for d in (0.0, -near, near))
        assert here > less and here > more


def test_odd_columns(spark):
    rows = [(0.0, 1.0, None, -3.0, 1e300), (1.0, 1.0, None, -1.0, 0.0), (0.0, 1.0, 2.0, -2.0, 5.0)]
    df = spark.createDataFrame(rows, "two double, same double, one double, low double, wide double")
    got = power.fit_lambdas(df, df.columns)
    assert set(got) == {"two", "low", "wide"} and all(np.isfinite(v) for v in got.values())
    assert power.fit_lambdas(df.limit(0), df.columns) == {}


def test_a_pass_takes_each_power_once(spark, capsys):
    rows = spark.range(10).selectExpr("double(id) AS e", "double(id) / 7 AS a").persist()
    power._derivatives(rows).explain("extended")
    rows.unpersist()
    physical = capsys.readouterr().out.split("== Physical Plan ==")[1]
    assert physical.count("EXPM1(") == 1 and physical.count("EXP(") == 1
