"""Two-pass ordered operators against plain pandas, on data with ties, nulls and one hot key."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators import ordered as O
from riskframe.operators.quantiles import exact_quantiles

SLICES = 6


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            # one key holds about half of the rows
            "k": np.where(rng.random(n) < 0.5, "hot", rng.integers(0, 5, n).astype(str)),
            # a third of the order values are one value
            "t": np.where(rng.random(n) < 0.33, 50, rng.integers(0, 100, n)),
            "x": rng.integers(-20, 20, n).astype(float),
        }
    )
    pdf["x_null"] = pdf["x"].where(rng.random(n) > 0.4)
    df = spark.createDataFrame(
        pdf.astype(object).where(pdf.notna(), None).values.tolist(),
        "id long, k string, t long, x double, x_null double",
    )
    return df.repartition(5).cache(), pdf.sort_values(["t", "id"]).reset_index(drop=True)


def by_id(df, col):
    return df.select("id", col).toPandas().set_index("id")[col].sort_index()


def test_split_points_cut_a_hot_value(table):
    df, pdf = table
    cuts = O.Slices(df, [], ["t", "id"], O.split_points(df, ["t", "id"], SLICES))
    sliced = cuts.assign(df)
    sizes = sliced.groupBy(O.SLICE).count().toPandas()["count"]
    assert len(sizes) == SLICES
    assert sizes.max() < 3 * len(pdf) / SLICES


def test_small_table_needs_no_split(spark):
    assert O.split_points(spark.range(10), ["id"], 4) == []


def test_positions(table):
    df, pdf = table
    got = by_id(O.positions(df, ["t", "id"], slices=SLICES), "pos")
    want = pd.Series(np.arange(len(pdf)), index=pdf["id"]).sort_index()
    assert (got == want).all()


def test_positions_within_key(table):
    df, pdf = table
    got = by_id(O.positions(df, ["t", "id"], by=["k"], slices=SLICES), "pos")
    want = pdf.assign(p=pdf.groupby("k").cumcount()).set_index("id")["p"].sort_index()
    assert (got == want).all()


@pytest.mark.parametrize("by", [[], ["k"]])
def test_running_sum(table, by):
    df, pdf = table
    got = by_id(O.running_sum(df, "x", ["t", "id"], by, slices=SLICES), "running_sum")
    cum = pdf.groupby("k")["x"].cumsum() if by else pdf["x"].cumsum()
    want = pdf.assign(c=cum).set_index("id")["c"].sort_index()
    assert np.allclose(got, want)


@pytest.mark.parametrize("by", [[], ["k"]])
def test_difference(table, by):
    df, pdf = table
    got = by_id(O.difference(df, "x", ["t", "id"], by, slices=SLICES), "diff")
    d = pdf.groupby("k")["x"].diff() if by else pdf["x"].diff()
    want = pdf.assign(d=d).set_index("id")["d"].sort_index()
    assert np.allclose(got, want, equal_nan=True)


@pytest.mark.parametrize("by", [[], ["k"]])
def test_forward_fill(table, by):
    df, pdf = table
    got = by_id(O.forward_fill(df, "x_null", ["t", "id"], by, name="f", slices=SLICES), "f")
    f = pdf.groupby("k")["x_null"].ffill() if by else pdf["x_null"].ffill()
    want = pdf.assign(f=f).set_index("id")["f"].sort_index()
    assert np.allclose(got, want, equal_nan=True)


def test_longest_streak(table):
    df, pdf = table
    got = O.longest_streak(df, F.col("x") > -10, ["t", "id"], ["k"], slices=SLICES).toPandas()

    def brute(s):
        best = cur = 0
        for f in s > -10:
            cur = cur + 1 if f else 0
            best = max(best, cur)
        return best

    want = pdf.groupby("k")["x"].apply(brute)
    assert got.set_index("k")["longest"].to_dict() == want.to_dict()


def test_ecdf_and_average_ranks(table):
    df, pdf = table
    got = O.ecdf(df, "x", ["k"], slices=SLICES).toPandas().set_index(["k", "x"])
    for k, g in pdf.groupby("k"):
        for x in g["x"].unique():
            assert got.loc[(k, x), "ecdf"] == pytest.approx((g["x"] <= x).mean())
    ranks = O.average_ranks(df, "x", slices=SLICES).toPandas().set_index("x")["avg_rank"]
    want = pdf.assign(r=pdf["x"].rank()).groupby("x")["r"].first()
    assert np.allclose(ranks.sort_index(), want.sort_index())


@pytest.mark.parametrize("keys", [["k"], ["k", "j"]])
def test_many_hot_keys(spark, keys, monkeypatch):
    """More hot keys than are scanned linearly, one of them null."""
    monkeypatch.setattr(O, "LINEAR_KEYS", 2)
    df = spark.range(6000).select(
        "id", F.when(F.col("id") % 7 > 0, (F.col("id") % 7).cast("string")).alias("k"), F.lit("x").alias("j"),
        ((F.col("id") * 37) % 101).alias("t"),
    )
    points = O.split_points(df, [*keys, "t", "id"], 40)
    assert len(O.Slices(df, keys, ["t", "id"], points).cuts) == 7
    got = by_id(O.positions(df, ["t", "id"], keys, points=points), "pos")
    pdf = df.toPandas().sort_values(["t", "id"])
    want = pdf.assign(p=pdf.groupby("k", dropna=False).cumcount()).set_index("id")["p"].sort_index()
    assert (got == want).all()


def test_folds_and_batches(spark):
    df = spark.range(103)
    folds = O.folds(df, ["id"], 4).groupBy("fold").count().toPandas().sort_values("fold")
    assert folds["count"].tolist() == [26, 26, 26, 25]
    assert folds["fold"].tolist() == [1, 2, 3, 4]
    sizes = O.batches(df, ["id"], 10).groupBy("batch").count().toPandas().sort_values("batch")
    assert sizes["count"].tolist() == [10] * 10 + [3]


@pytest.mark.parametrize("by", [[], ["k"]])
@pytest.mark.parametrize("buffer", [0, 50_000])
def test_exact_quantiles(table, by, buffer):
    df, pdf = table
    probs = {"q1": 0.25, "med": 0.5, "p95": 0.95, "lo": 0.0, "hi": 1.0}
    got = exact_quantiles(df, "x_null", probs, by, buffer_values=buffer, slices=SLICES).toPandas()
    if by:
        want = pdf.groupby("k")["x_null"].quantile(list(probs.values())).unstack()
        got = got.set_index("k").loc[want.index]
        assert np.allclose(got[list(probs)].values, want.values)
    else:
        assert np.allclose(got[list(probs)].values[0], pdf["x_null"].quantile(list(probs.values())))


def test_exclusive_quartiles_golden(spark):
    balances = [500, 800, 1200, 1500, 2000, 3000, 5000, 8000, 12000, 20000]
    import statistics

    df = spark.createDataFrame([(float(b),) for b in balances], "b double")
    row = exact_quantiles(df, "b", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, method="exclusive").first()
    assert [row.q1, row.q2, row.q3] == pytest.approx(statistics.quantiles(balances, n=4))
    assert [row.q1, row.q2, row.q3] == [1100, 2500, 9000]
    lin = exact_quantiles(df, "b", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, buffer_values=0).first()
    assert [lin.q1, lin.q2, lin.q3] == [1275, 2500, 7250]
