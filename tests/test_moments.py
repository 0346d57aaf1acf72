"""Correlations from matrix products, against pandas over the rows where both columns are present."""

import math

import numpy as np
import pandas as pd
import pytest

from tallyguard.operators import profile
from tallyguard.operators.moments import PairMoments, pearson


def as_table(spark, frame):
    rows = [tuple(None if pd.isna(v) else float(v) for v in row) for row in frame.itertuples(index=False)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in frame)).repartition(5)


@pytest.fixture(scope="module")
def wide():
    """Columns with different gaps, one far from zero, one constant where another is present."""
    rng = np.random.default_rng(11)
    n = 900
    base = rng.normal(size=(n, 3))
    frame = pd.DataFrame(base @ rng.normal(size=(3, 12)), columns=[f"c{k}" for k in range(12)])
    for k in range(0, 12, 2):
        frame.loc[rng.random(n) < 0.2, f"c{k}"] = np.nan
    frame["far"] = 1e9 + frame["c1"] * 1e-2
    frame["half"] = np.where(np.arange(n) < n // 2, 0.1, rng.normal(size=n))
    frame["first"] = np.where(np.arange(n) < n // 2, rng.normal(size=n), np.nan)
    frame["none"] = np.nan
    return frame


def test_every_pair_matches_pandas(spark, wide):
    got = {(r["x"], r["y"]): r["r"] for r in profile.corr_matrix(as_table(spark, wide), list(wide)).collect()}
    assert len(got) == wide.shape[1] ** 2
    for (a, b), r in got.items():
        both = wide[[a]].join(wide[[b]].rename(columns={b: "other"})).dropna()
        if both[a].nunique() < 2 or both["other"].nunique() < 2:
            assert r is None, (a, b)
        else:
            expected = np.corrcoef(both[a] - both[a].iloc[0], both["other"] - both["other"].iloc[0])[0, 1]
            assert r == pytest.approx(expected, abs=1e-6 if "far" in (a, b) else 1e-12), (a, b)
    assert got["half", "first"] is None and got["half", "half"] == pytest.approx(1)


def test_parts_merge_to_the_whole(wide):
    x = wide.to_numpy()
    has = ~np.isnan(x)
    x = np.where(has, x, 0.0)
    whole = PairMoments.of(x, has, x, has).correlation()
    for cuts in ([1, 2, 3], [0, 450], [899]):
        parts = [PairMoments.of(*[p[s] for p in (x, has, x, has)]) for s in np.split(np.arange(len(x)), cuts)]
        total = parts[0]
        for part in parts[1:]:
            total = total.plus(part)
        merged = total.correlation()
        assert (np.ma.getmaskarray(merged) == np.ma.getmaskarray(whole)).all()
        assert np.ma.allclose(merged, whole, atol=1e-6)


def test_odd_values_only_touch_their_pairs(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.0, math.nan), (3.0, None, math.inf), (4.0, 9.0, None), (5.0, 9.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, `c d` double")
    got = {(r["x"], r["y"]): r["r"] for r in profile.corr_matrix(df, ["a", "b", "c d"]).collect()}
    assert got["a", "b"] == pytest.approx(pd.Series([1.0, 2, 4, 5]).corr(pd.Series([2.0, 4, 9, 9])))
    assert math.isnan(got["a", "c d"]) and math.isnan(got["c d", "b"])


def test_hundred_columns_shuffle_one_state_a_task_and_column(spark):
    table = spark.range(0, 3000, 1, 4).selectExpr(*[f"pmod(id * {k + 3}, {101 + k}) AS c{k}" for k in range(100)])
    columns = table.columns
    states = pearson(table, columns, columns)
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Generate" not in plan
    got = np.full((100, 100), np.nan)
    for r in states.collect():
        got[r["i"], r["j"]] = r["r"]
    ids = np.arange(3000)
    expected = np.corrcoef(np.stack([ids * (k + 3) % (101 + k) for k in range(100)]))
    assert np.allclose(got, expected, atol=1e-12)


def test_empty_table_and_target(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert [tuple(r) for r in profile.corr_matrix(empty, ["a"]).collect()] == [("a", "a", None)]
    df = spark.createDataFrame([(1.0, 0.0, 7), (2.0, 1.0, 7), (3.0, 1.0, 7)], "a double, t double, k int")
    got = [tuple(r) for r in profile.feature_target_corr(df, ["k", "a", "t"], "t").collect()]
    assert got == [("t", pytest.approx(1.0)), ("a", pytest.approx(math.sqrt(3) / 2)), ("k", None)]
