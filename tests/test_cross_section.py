"""Cross-sectional operators against pandas, and the exact placing of values in groups of any size."""

from __future__ import annotations

import re
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from factorloom.operators import cross_section as xs
from factorloom.operators import groups
from factorloom.operators.groups import cells_of, group_quantiles, leading_bits, with_average_rank


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out = []
    for day, n in enumerate([300, 1, 2, 60, 7, 40, 25]):
        for code in range(n):
            v = float(np.round(rng.normal(), 1))
            if day == 3 and rng.random() < 0.6:
                v = 0.0
            if day == 5:
                v = 4.25
            out.append((day, f"s{code}", None if rng.random() < 0.08 else v))
    return out + [(7, f"s{c}", None) for c in range(3)]


@pytest.fixture(params=[groups.CELL, 9, 1])
def cell(request, monkeypatch):
    """Rows beyond which a cell is cut: none is, some are, all of several values are."""
    monkeypatch.setattr(groups, "CELL", request.param)


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "trade_date int, stock_code string, x double").cache()


def table(df):
    return df.toPandas().sort_values(["trade_date", "stock_code"]).reset_index(drop=True)


def test_scale_and_winsorize_against_pandas(df, cell):
    scaled, clipped = table(xs.scale(df, "x", "y", 2)), table(xs.winsorize(df, "x", "y", 0.1, 0.9))
    assert len(scaled) == len(clipped) == df.count()
    for _, g in scaled.groupby("trade_date"):
        total = g.x.abs().sum()
        np.testing.assert_allclose(g.y.astype(float), g.x.astype(float) / total * 2 if total else np.nan, atol=1e-12)
    for _, g in clipped.groupby("trade_date"):
        x = g.x.astype(float)
        np.testing.assert_allclose(g.y.astype(float), x.clip(x.quantile(0.1), x.quantile(0.9)), atol=1e-12)


def test_standardizing_is_clipping_then_zscore(df):
    once = table(xs.winsorize_and_standardize(df, "x", "y"))
    twice = table(xs.zscore(xs.winsorize(df, "x", "c"), "c", "y"))
    np.testing.assert_allclose(once.y.astype(float), twice.y.astype(float), rtol=1e-9, atol=1e-12)


def test_rank_against_pandas(df, cell):
    out = table(xs.rank01(df, "x", "y"))
    for _, g in out.groupby("trade_date"):
        want = (g.x.rank() - 1) / (len(g) - 1) if len(g) > 1 else pd.Series(0.0, index=g.index)
        np.testing.assert_allclose(g.y, want, atol=1e-12)


def test_standardize_against_pandas(df, cell):
    out = table(xs.winsorize_and_standardize(df, "x", "y"))
    for _, g in out.groupby("trade_date"):
        x = g.x.clip(g.x.quantile(0.01), g.x.quantile(0.99)) if g.x.notna().any() else g.x
        sd = x.std()
        want = (x - x.mean()) / sd if sd and not np.isnan(sd) and sd > 1e-10 else pd.Series(0.0, index=g.index)
        np.testing.assert_allclose(g.y, want, atol=1e-9)


def test_undefined_deviation_can_stay_null(df):
    out = table(xs.zscore(df, "x", "y", undefined="null"))
    assert out[out.trade_date == 5].y.isna().all()


def test_buckets_against_pandas(spark, cell):
    """Distinct values on dates whose edges fall between rows, where floating point leaves no doubt."""
    rng = np.random.default_rng(9)
    data = [(d, f"s{c}", float(v)) for d, n in enumerate([12, 23, 54, 77, 98]) for c, v in enumerate(rng.normal(size=n))]
    df = spark.createDataFrame(data, "trade_date int, stock_code string, x double")
    out = table(xs.quantile_bucket(df, "x", 10, "q"))
    for _, g in out.groupby("trade_date"):
        assert (pd.qcut(g.x, 10, labels=False, duplicates="drop") == g.q).all()


def test_equal_edges_are_merged(spark, cell):
    data = [(1, f"s{i}", v) for i, v in enumerate([0.0] * 6 + [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(data, "trade_date int, stock_code string, x double")
    want = pd.qcut(pd.Series([r[2] for r in data]), 5, labels=False, duplicates="drop").tolist()
    assert table(xs.quantile_bucket(df, "x", 5, "q")).q.tolist() == want


def test_quantiles_are_exact(df, cell):
    probs = [0.0, Fraction(1, 100), 0.37, 0.5, 0.99, 1.0]
    out = group_quantiles(df, cells_of(df, "x", ["trade_date"]), probs).toPandas()
    frame = table(df)
    assert len(out) == frame.dropna().trade_date.nunique()
    for _, r in out.iterrows():
        want = frame[frame.trade_date == r.trade_date].x.quantile([float(p) for p in probs])
        np.testing.assert_allclose(list(r.q), want, atol=1e-12)


NEAR_ONE = [1 + k * 2**-52 for k in range(300)]
SPREAD = [s * m * 10.0**e for s in (-1, 1) for m in (1, 1.5, 9.999) for e in (-320, -300, -9, 0, 9, 291, 300, 307)]


def test_leading_bits_never_fall(spark):
    rng = np.random.default_rng(2)
    x = sorted([*NEAR_ONE, *SPREAD, 0.0, *rng.normal(size=2000), *(rng.normal(size=2000) * 10.0 ** rng.integers(-30, 30, 2000))])
    cells = [leading_bits(F.col("x"), bits) for bits in (42, 21)]
    got = np.array(spark.createDataFrame([(float(v),) for v in x], "x double").coalesce(1).select(*cells).collect())
    assert (np.diff(got, axis=0) >= 0).all() and np.isfinite(got).all()
    assert len(set(got[:, 0])) < len(set(got[:, 1])) < len(set(x))


def test_values_that_share_leading_bits_are_ranked(spark, cell):
    """Values next to one another, huge, tiny, of both signs, and one that a third of the rows hold."""
    x = [*NEAR_ONE, *SPREAD, 0.0, -0.0, *[7.0] * 400]
    df = spark.createDataFrame([(g, float(v)) for g in (None, 1) for v in x] + [(1, None)], "g int, x double").repartition(7)
    out = with_average_rank(df, cells_of(df, "x", ["g"]), "r", "n").toPandas()
    assert len(out) == 2 * len(x) + 1
    for _, g in out.groupby("g", dropna=False):
        np.testing.assert_array_equal(g.r, (g.x + 0.0).rank())
        np.testing.assert_array_equal(g.n[g.x.notna()], g.groupby(g.x + 0.0).x.transform("count")[g.x.notna()])


def test_one_huge_group_of_ties(spark, cell):
    df = spark.range(6000).select(
        F.lit(1).alias("trade_date"),
        F.col("id").cast("string").alias("stock_code"),
        F.when(F.col("id") % 3 > 0, 7.0).otherwise((F.col("id") % 500).cast("double")).alias("x"),
    )
    got = table(xs.average_rank(df, "x", "r"))
    np.testing.assert_allclose(got.r, got.x.rank())
    np.testing.assert_array_equal(got._ties, got.groupby("x").x.transform("count"))


def test_no_task_gets_a_group(spark):
    """All windows are inside a cell, or over counts of cells."""
    df = spark.range(1000).select((F.col("id") % 3).alias("trade_date"), (1 + F.col("id") * 1e-13).alias("x"))
    cells = cells_of(df, "x", ["trade_date"], limit=3)
    assert len(cells.cut) == 3 and cells.table.agg(F.max("_n")).first()[0] == 1 and cells.table.count() == 1000
    plan = with_average_rank(df, cells_of(df, "x", ["trade_date"]), "r", "n")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan
    ordered = re.findall(r"Window \[rank.*", plan)
    assert ordered and all("_cell0" in w and "_spread" in w for w in ordered)


def test_ranked_rows_give_the_same_edges(spark, cell):
    """Edges and outer buckets looked up by rank are those of the ordered rows, and the limits of the outer buckets agree with them."""
    rng = np.random.default_rng(21)
    groups_ = {0: rng.normal(size=211), 1: rng.integers(0, 4, 90), 2: [3.0], 3: [1.0] * 8 + [2.0], 4: [1.0] + [2.0] * 8, 5: range(11), 6: [5.0] * 7, 7: rng.integers(0, 30, 60)}
    data = [(g, float(v)) for g, values in groups_.items() for v in values]
    df = spark.createDataFrame(data, "g int, x double").repartition(5)
    cells = cells_of(df, "x", ["g"])
    ranked = with_average_rank(df, cells, "r", "n").cache()
    plain, by_rank = groups.bucket_edges(df, cells, 10), groups.bucket_edges(ranked, cells, 10, ("r", "n"))
    assert sorted(map(str, plain.collect())) == sorted(map(str, by_rank.collect()))
    x = F.col("x")
    top, low = groups.in_outer(x)
    out = groups.join_keys(df, by_rank, ["g"]).withColumns({"q": groups.bucket_of(x), "top": top, "low": low})
    assert out.count() == len(data)
    assert out.where("not (top <=> (q = _top)) or not (low <=> (q = _low))").count() == 0


def test_moments_do_not_sort_rows(df):
    """A plain hash aggregation per group: no aggregate of the post-processing orders its rows."""
    plan = xs.winsorize_and_standardize(df, "x", "y", base=df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_rows_are_ordered_by_their_cells_number(df, cell):
    """What is moved to be ordered is the cell's number and the value, not the group's keys."""
    cells = cells_of(df, "x", ["trade_date"])
    plan = group_quantiles(df, cells, [0.5])._jdf.queryExecution().executedPlan().toString()
    ordered = re.findall(r"Window \[row_number.*", plan)
    assert ordered and all("_id" in w and "trade_date" not in w for w in ordered)
