"""Exact percentiles vs numpy (linear interpolation), with a hot group and edge values."""

import numpy as np
import pandas as pd

import pytest

from vigil.operators.quantile import exact_percentiles


@pytest.mark.parametrize("accuracy", [20, 1000])
def test_exact_percentiles_match_numpy(spark, accuracy):
    rng = np.random.default_rng(11)
    vals = np.concatenate([rng.lognormal(8, 2, 2000), -rng.lognormal(2, 3, 300), np.zeros(30),
                           np.full(100, 123.25), [1e-300, 5e-324, 1e300, -1e300, 2.0, 4.0, 0.5]])
    grp = np.where(np.arange(len(vals)) % 3 == 0, "b", "a")          # "a" holds two thirds
    pdf = pd.DataFrame({"g": grp, "x": vals})
    pdf.loc[3, "x"] = np.nan
    pdf = pd.concat([pdf, pd.DataFrame({"g": ["c"], "x": [3.5]})])
    probs = [0.0, 0.01, 0.05, 0.5, 0.95, 0.99, 1.0]
    res = exact_percentiles(spark.createDataFrame(pdf), ["g"], "x", probs,
                            accuracy=accuracy).toPandas().set_index("g")
    for g, sub in pdf.groupby("g"):
        x = sub["x"].dropna().to_numpy()
        assert res.loc[g, "n"] == len(x)
        for p in probs:
            exp = np.quantile(x, p)
            got = res.loc[g, f"p{int(round(p * 100))}"]
            assert got == exp or abs(got - exp) <= 1e-12 * max(1.0, abs(exp)), (g, p)


def test_extra_aggregates(spark):
    """Extra aggregates see every row; a group with no valid value keeps n = 0."""
    from pyspark.sql import functions as F
    pdf = pd.DataFrame({"g": ["a"] * 5 + ["z"] * 2,
                        "x": [1.0, 2.0, 3.0, np.nan, 4.0, np.nan, np.nan]})
    res = exact_percentiles(spark.createDataFrame(pdf), ["g"], "x", [0.5], ["p50"],
                            extra_aggs=[F.count(F.lit(1)).alias("rows")]).toPandas().set_index("g")
    assert list(res.columns) == ["n", "p50", "rows"]
    assert (res.loc["a", "n"], res.loc["a", "p50"], res.loc["a", "rows"]) == (4, 2.5, 5)
    assert res.loc["z", "n"] == 0 and pd.isna(res.loc["z", "p50"]) and res.loc["z", "rows"] == 2


def test_null_group_and_infinities(spark):
    rows = ([(None, float(i)) for i in range(334)] + [("i", float("inf"))] + [("i", float(i)) for i in range(50)]
            + [("n", float("-inf")), ("n", 1.0), ("n", float("nan")), ("n", None)] + [("z", None)])
    got = {r.g: r for r in exact_percentiles(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", [0.01, 0.5, 0.99, 1.0],
                                             ["a", "b", "c", "d"]).collect()}
    assert set(got) == {None, "i", "n"}
    assert (got[None].n, got[None].a, got[None].c) == (334, pytest.approx(3.33), pytest.approx(329.67))
    assert got["i"].b == 25.0 and got["i"].c == float("inf") and got["i"].d == float("inf")
    assert got["n"].n == 2 and got["n"].a == float("-inf") and got["n"].d == 1.0


def test_no_group_columns(spark):
    got = exact_percentiles(spark.range(101).selectExpr("1 as g", "cast(id as double) as x"), ["g"], "x", [0.25]).first()
    assert (got.n, got.p25) == (101, 25.0)


@pytest.mark.parametrize("most", [1, 20, 200])
def test_brackets_are_narrowed_by_counting(spark, most):
    """Brackets open at both ends hold all values; rounds narrow them and the results stay exact."""
    rng = np.random.default_rng(5)
    vals = np.concatenate([rng.normal(0, 1, 1500), np.full(700, 0.25), [np.inf, -np.inf]])
    pdf = pd.DataFrame({"g": np.where(np.arange(len(vals)) % 3 == 0, None, "a"), "x": vals})
    probs = [0.0, 0.013, 0.5, 0.77, 1.0]
    names = [f"q{k}" for k in range(len(probs))]
    got = {r.g: r for r in exact_percentiles(spark.createDataFrame(pdf, "g string, x double"), ["g"], "x", probs, names, most=most).collect()}
    assert set(got) == {None, "a"}
    for g, r in got.items():
        x = np.sort(pdf[pdf.g.isna() if g is None else pdf.g == g].x.to_numpy())
        for p, n in zip(probs, names):
            h = (len(x) - 1) * p
            lo, hi = x[int(np.floor(h))], x[int(np.ceil(h))]
            want = lo if lo == hi else (np.ceil(h) - h) * lo + (h - np.floor(h)) * hi
            assert r[n] == want or abs(r[n] - want) < 1e-12


def test_a_round_leaves_a_small_share_of_a_bracket(spark):
    from pyspark.sql import functions as F

    from vigil.operators.quantile import PIECES, _narrowed
    counted = spark.range(20000).select(F.lit("a").alias("_g0"), F.lit(0).alias("_i"), F.lit(9999.5).alias("_pos"),
                                        F.col("id").cast("double").alias("_x"), F.lit(1).cast("long").alias("_c"))
    left = _narrowed(counted, ["_g0"])
    assert left.count() <= 3 * 20000 / PIECES
    assert left.where("_x in (9999, 10000)").count() == 2
    assert left.where("_x < 9999 or _x is null").agg(F.sum("_c")).first()[0] == 9999


def test_no_groups_and_no_rows(spark):
    from pyspark.sql import functions as F

    from vigil.operators.profile import balance_profile
    empty = spark.createDataFrame([], "oldbalanceOrg double")
    assert exact_percentiles(empty, [], "oldbalanceOrg", [0.5]).collect() == [(0, None)]
    assert balance_profile(empty).count() == 0
    frame = spark.range(1, 2001).select(F.col("id").cast("double").alias("oldbalanceOrg"))
    got = exact_percentiles(frame, [], "oldbalanceOrg", [0.05, 0.5], most=10)
    assert (got.first().n, got.first().p5, got.first().p50) == (2000, 100.95, 1000.5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
