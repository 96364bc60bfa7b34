"""Operators on small literal tables, invariants, and skewed data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.catalog import QUERIES, Tables
from riskframe.operators import aggregate as G
from riskframe.operators import columns as C
from riskframe.operators import joins as J
from riskframe.operators import missing as X
from riskframe.operators import profile as P
from riskframe.operators import quality as Q
from riskframe.operators import reshape as R
from riskframe.operators import sets as E
from riskframe.operators import stats as S
from riskframe.operators.ordered import longest_streak


def ids(spark, xs, name="k"):
    return spark.createDataFrame([(x,) for x in xs], f"{name} int")


def col(df, c):
    return sorted(r[c] for r in df.collect())


# ------------------------------------------------------------------ sets
def test_set_logic(spark):
    a, b, c = (ids(spark, s) for s in ([101, 102, 103, 104], [103, 104, 105, 106], [104, 106, 107]))
    assert col(E.in_at_least(2, a, b, c), "k") == [103, 104, 106]
    assert col(E.in_exactly(1, a, b, c), "k") == [101, 102, 105, 107]
    assert col(E.symmetric_difference(a, b), "k") == [101, 102, 105, 106]
    assert col(E.intersect(a, b, c), "k") == [104]
    assert E.subset_report(ids(spark, [103]), a).first().is_subset
    assert E.subset_report(ids(spark, [1]), a).first().is_disjoint


def test_repeat_new_recovered(spark):
    last, this = ids(spark, [102, 103, 105]), ids(spark, [101, 102, 105, 107])
    assert col(E.intersect(last, this), "k") == [102, 105]
    assert col(E.subtract(this, last), "k") == [101, 107]
    assert col(E.subtract(last, this), "k") == [103]


# ------------------------------------------------------------------ joins
def test_align_add(spark):
    a = spark.createDataFrame([("A101", 100), ("A102", 200), ("A103", 300)], "k string, v int")
    b = spark.createDataFrame([("A102", 10), ("A103", 20), ("A104", 30)], "k string, v int")
    got = {r.k: r.total for r in J.align_add(a, b, "k", "v").collect()}
    assert got == {"A101": None, "A102": 210, "A103": 320, "A104": None}


def test_full_join_counts_reconcile(spark):
    left = spark.range(0, 500).withColumnRenamed("id", "k").withColumn("l", F.lit(1))
    right = spark.range(30, 520).withColumnRenamed("id", "k").withColumn("r", F.lit(1))
    counts = {r.origin: r["count"] for r in J.full_join(left, right, ["k"], "origin").groupBy("origin").count().collect()}
    assert counts == {"both": 470, "left_only": 30, "right_only": 20}
    row = J.match_counts(left, right, ["k"]).first()
    assert (row.n_both, row.n_left_only, row.n_right_only) == (470, 30, 20)


def test_full_join_keeps_null_keys_apart(spark):
    a = spark.createDataFrame([(None, 1), (1, 2)], "k int, l int")
    b = spark.createDataFrame([(None, 3), (2, 4)], "k int, r int")
    rows = {tuple(r) for r in J.full_join(a, b, ["k"]).collect()}
    assert rows == {(None, 1, None), (1, 2, None), (None, None, 3), (2, None, 4)}


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows, many keys hold one or two."""
    df = spark.range(60_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise((F.col("id") * 7919) % 30_000).alias("k"),
        ((F.col("id") * 31) % 1000).cast("double").alias("x"),
    )
    return df.cache()


def test_key_profile_finds_the_heavy_key(spark, skewed):
    keys, heavy = J.key_profile(skewed, ["k"])
    want = spark.range(1).select(F.xxhash64(F.lit(-1).cast("long"))).first()[0]
    assert want in heavy
    assert keys > 10_000


@pytest.mark.parametrize("limit", [10**9, 0])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_group_join_paths_agree(skewed, monkeypatch, limit, how):
    monkeypatch.setattr(J, "BROADCAST_KEYS", limit)
    stats = skewed.groupBy("k").agg(F.sum("x").alias("s")).filter("k % 5 <> 0")
    got = J.group_join(skewed, stats, ["k"], how).agg(F.count("*"), F.count("s"), F.sum("s")).first()
    want = skewed.join(stats, "k", how).agg(F.count("*"), F.count("s"), F.sum("s")).first()
    assert got == want


def test_average_sources(spark):
    a = spark.createDataFrame([("Ines", 655), ("Tomas", 540), ("Yuki", 790)], "k string, v int")
    b = spark.createDataFrame([("Ines", 645), ("Yuki", 760), ("Omar", 702)], "k string, v int")
    common = {r.k: r.avg_value for r in J.average_sources([a, b], "k", "v", 2).collect()}
    assert common == {"Ines": 650, "Yuki": 775}
    assert J.average_sources([a, b], "k", "v").count() == 4


# ------------------------------------------------------------------ missing and quality
@pytest.fixture(scope="module")
def gaps(spark):
    rows = [(1, "a", 10.0, None), (2, "a", None, None), (3, "b", 30.0, None), (4, "b", 50.0, None), (5, None, None, None)]
    return spark.createDataFrame(rows, "id int, g string, x double, note string")


def test_missing_counts_and_drops(gaps):
    assert {r.column: r.nulls for r in X.null_counts(gaps).collect()} == {"id": 0, "g": 1, "x": 2, "note": 5}
    assert X.null_total(gaps).first()[0] == 8
    assert X.drop_empty_columns(gaps).columns == ["id", "g", "x"]
    assert X.drop_rows(gaps.drop("note")).count() == 3
    assert X.drop_rows(gaps, thresh=3).count() == 3
    assert gaps.filter(X.any_null(["g", "x"])).count() == 2


def test_fills(gaps):
    filled = {r.id: r.x for r in X.fill_median(gaps, "x").collect()}
    assert filled == {1: 10, 2: 30, 3: 30, 4: 50, 5: 30}
    grouped = {r.id: r.x for r in X.fill_group_median(gaps, "x", "g").collect()}
    assert grouped == {1: 10, 2: 10, 3: 30, 4: 50, 5: None}
    carried = {r.id: r.x for r in X.fill_forward(gaps, "x", ["id"]).collect()}
    assert carried == {1: 10, 2: 10, 3: 30, 4: 50, 5: 50}


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "b", 1), (4, "a", None)], "id int, t string, n int")
    flags = {r.id: (r.is_dup, r.has_copies) for r in Q.duplicate_flags(df, ["t", "n"], "id").collect()}
    assert flags == {1: (False, True), 2: (True, True), 3: (False, False), 4: (True, True)}
    once = Q.drop_duplicates(df, ["t", "n"])
    assert once.count() == Q.drop_duplicates(once, ["t", "n"]).count() == 2
    last = Q.keep_last(df, ["t"], ["id"])
    assert col(last, "id") == [3, 4]


def test_parse_with_quarantine(spark):
    raw = ["Ines,655,38200", "Tomas,n/a,27500", "Yuki,790,81000", "Omar,702", "Leila,618,0"]
    df = spark.createDataFrame([(r,) for r in raw], "raw string")
    good, bad = Q.split_valid(Q.parse_fields(df, "raw", {"name": "string", "score": "int", "income": "int"}))
    assert col(good, "name") == ["Ines", "Leila", "Yuki"]
    assert {r.raw: r.error for r in bad.collect()} == {"Tomas,n/a,27500": "not a number", "Omar,702": "2 fields instead of 3"}


def test_casts(spark):
    df = spark.createDataFrame([("5.72%",), ("N/A",), ("",), (None,)], "r string")
    assert [r[0] for r in df.select(Q.strip_number("r", "%")).collect()] == [5.72, None, None, None]
    scores = spark.createDataFrame([(s,) for s in ["720", "abc", "610", "", "800", "x", "590"]], "s string")
    assert [r[0] for r in scores.select(Q.try_int("s").alias("n")).filter("n is not null").collect()] == [720, 610, 800, 590]


def test_all_close(spark):
    a = spark.createDataFrame([(1, 0.1 + 0.2)], "k int, v double")
    b = spark.createDataFrame([(1, 0.3)], "k int, v double")
    assert Q.all_close(a, b, ["k"], "v").first().all_close
    assert not Q.all_close(a, b.withColumn("v", F.lit(0.31)), ["k"], "v").first().all_close


# ------------------------------------------------------------------ aggregates and reshape
def test_most_common_takes_the_first_seen(spark):
    words = ["kiln", "oven", "kiln", "forge", "oven", "kiln"]
    df = spark.createDataFrame(list(enumerate(words)), "i int, w string")
    assert tuple(G.most_common(df, "w", "i").first()) == ("kiln", 3)
    assert tuple(G.least_common(df, "w", "i").first()) == ("forge", 1)
    tie = spark.createDataFrame(list(enumerate(["b", "a", "a", "b"])), "i int, w string")
    assert G.most_common(tie, "w", "i").first()[0] == "b"


def test_collect_chunks_keeps_everyone(spark):
    df = spark.range(25).select((F.col("id") % 2).alias("g"), "id")
    chunks = G.collect_chunks(df, ["g"], "id", ["id"], 5).collect()
    assert max(len(r.members) for r in chunks) == 5
    members = {}
    for r in sorted(chunks, key=lambda r: (r.g, r.chunk)):
        members.setdefault(r.g, []).extend(r.members)
    assert members == {0: list(range(0, 25, 2)), 1: list(range(1, 25, 2))}


def test_bootstrap_interval_covers_the_mean(spark):
    df = spark.range(2000).select("id", F.lit("g").alias("g"), ((F.col("id") * 37) % 100).cast("double").alias("x"))
    row = G.bootstrap_ci(df, "id", "x", ["g"]).first()
    mean, se = 49.5, 28.9 / 2000**0.5
    assert row.ci_low < mean < row.ci_high
    assert row.ci_high - row.ci_low == pytest.approx(2 * 1.96 * se, rel=0.25)
    assert row == G.bootstrap_ci(df.repartition(7), "id", "x", ["g"]).first()


def test_pivot_margins_use_raw_rows(spark):
    df = spark.createDataFrame([("r", "a", 1.0), ("r", "a", 2.0), ("r", "b", 9.0), ("s", "b", 5.0)], "row string, c string, v double")
    got = {r.row: (r.a, r.b, r.All) for r in R.pivot_margins(df, "row", "c", ["a", "b"], F.avg("v")).collect()}
    assert got == {"r": (1.5, 9.0, 4.0), "s": (None, 5.0, 5.0), "All": (1.5, 7.0, 4.25)}


def test_crosstab_rows_sum_to_one(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    shares = R.crosstab_share(orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])
    assert all(r.F + r.O + r.P == pytest.approx(1) for r in shares.collect())


def test_fold_and_unfold(spark):
    df = spark.range(10).select("id", (F.col("id") * 10).alias("v"))
    wide = C.fold_rows(df, ["id"], "v", 4)
    assert sorted(tuple(r) for r in wide.collect())[2][1:] == (80, 90, None, None)
    flat = C.unfold_rows(wide, "row", ["c0", "c1", "c2", "c3"]).filter("value is not null")
    assert sorted(tuple(r) for r in flat.collect()) == [(i, i * 10) for i in range(10)]


def test_take_positions_repeats(spark):
    df = spark.range(10).select((F.col("id") * 2).alias("v"))
    rows = C.take_positions(df, ["v"], [1, 4, 4]).orderBy("slot").collect()
    assert [r.v for r in rows] == [2, 8, 8]


def test_streak_goldens(spark):
    flags = spark.createDataFrame(list(enumerate([0, 1, 1, 0, 1, 1, 1, 0, 1])), "i int, f int")
    assert longest_streak(flags, F.col("f") == 1, ["i"]).first()[0] == 3


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(1000)
    a, b = (col(P.sample_n(d, "id", 20, 42), "id") for d in (df, df.repartition(13)))
    assert a == b
    share = P.sample_fraction(df, 0.3, 7, "id").count()
    assert 240 < share < 360
    assert col(P.sample_fraction(df.repartition(9), 0.3, 7, "id"), "id") == col(P.sample_fraction(df, 0.3, 7, "id"), "id")


def test_describe_paths_agree(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    a = P.describe(orders, ["o_totalprice"], ["o_orderstatus"]).orderBy("o_orderstatus").toPandas()
    b = P.describe(orders, ["o_totalprice"], ["o_orderstatus"], buffer_values=0, slices=4).orderBy("o_orderstatus").toPandas()
    pd.testing.assert_frame_equal(a, b)


# ------------------------------------------------------------------ statistics
SCORES = [720, 610, 800, 590, 700]


@pytest.fixture(scope="module")
def scores(spark):
    incomes, defaults = [55000, 32000, 68000, 28000, 51000], [0, 1, 0, 1, 0]
    rows = [(float(s), float(i), float(d)) for s, i, d in zip(SCORES, incomes, defaults)]
    return spark.createDataFrame(rows, "score double, income double, defaulted double")


def test_moments_and_correlation(scores):
    row = scores.agg(F.avg("score"), F.var_samp("score"), F.stddev_samp("score")).first()
    assert list(row) == pytest.approx([684, 7330, 85.6154], abs=1e-4)
    pairs = {(r.a, r.b): r.r for r in S.correlation_pairs(scores, scores.columns).collect()}
    assert pairs[("score", "income")] == pytest.approx(0.997786, abs=1e-6)
    assert pairs[("score", "defaulted")] == pytest.approx(-0.895647, abs=1e-6)
    assert S.stronger_predictor(scores, "income", "defaulted", "score").first().stronger == "income"


def test_z_scores(scores):
    z = {r.score: r.score_z for r in S.z_scores(scores, ["score"]).collect()}
    assert z[800] == pytest.approx(1.3549, abs=1e-4)
    assert sorted(s for s, v in z.items() if abs(v) > 1) == [590, 800]


def test_exclusive_fences_find_no_outlier(spark):
    balances = [500, 800, 1200, 1500, 2000, 3000, 5000, 8000, 12000, 20000]
    df = spark.createDataFrame([(float(b),) for b in balances], "b double")
    assert S.iqr_outliers(df, "b", "exclusive").count() == 0
    assert S.iqr_outliers(df, "b", upper_only=True).count() == 1


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(50, 10, 700), np.full(300, 42.0)])
    pdf = pd.DataFrame({"x": x, "y": 3 + 0.5 * x - 0.02 * x**2 + rng.normal(0, 1, 1000), "g": rng.choice(["a", "b"], 1000)})
    return spark.createDataFrame(pdf), pdf


def test_fits(cloud):
    df, pdf = cloud
    quad = S.quadratic_fit(df, "x", "y").first()
    assert list(quad) == pytest.approx(list(np.polyfit(pdf.x, pdf.y, 2)[::-1]), rel=1e-6)
    line = S.linear_fit(df, "x", "y").first()
    assert [line.slope, line.intercept] == pytest.approx(list(np.polyfit(pdf.x, pdf.y, 1)))
    assert S.residuals(df, "x", "y").agg(F.avg("residual")).first()[0] == pytest.approx(0, abs=1e-9)


def test_spearman(cloud):
    df, pdf = cloud
    want = np.corrcoef(pdf.x.rank(), pdf.y.rank())[0, 1]
    assert S.spearman(df, "x", "y").first().rho == pytest.approx(want)


def test_histogram_covers_all_rows(cloud):
    df, pdf = cloud
    h = S.histogram(df, "x", 12).orderBy("bin").toPandas()
    assert h["cnt"].tolist() == np.histogram(pdf.x, 12)[0].tolist()
    log = df.select(F.log10("x").alias("lx"))
    assert S.histogram(log, "lx", 7).agg(F.sum("cnt")).first()[0] == 1000


def test_kde_close_to_exact(cloud):
    df, pdf = cloud
    curve = S.kde(df, "x", ["g"], points=50).orderBy("g", "i").toPandas()
    for g, part in curve.groupby("g"):
        x = pdf.loc[pdf.g == g, "x"].to_numpy()
        h = len(x) ** -0.2 * x.std(ddof=1)
        exact = np.exp(-0.5 * ((part["x"].to_numpy()[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
        assert np.abs(part["density"] - exact).max() < 1e-7 * exact.max()
    whole = S.kde(df, "x", points=50).toPandas().sort_values("x")
    assert np.trapezoid(whole["density"], whole["x"]) == pytest.approx(1, abs=0.01)


def test_box_stats(cloud):
    df, pdf = cloud
    got = S.box_stats(df, "x", ["g"]).toPandas().set_index("g")
    for g, x in pdf.groupby("g")["x"]:
        q1, med, q3 = x.quantile([0.25, 0.5, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        row = got.loc[g]
        assert [row.q1, row.med, row.q3, row.whisker_low, row.whisker_high] == pytest.approx([q1, med, q3, inside.min(), inside.max()])
        assert row.n_outliers == len(x) - len(inside)


def test_logistic_fit_separates(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=500)
    p = 1 / (1 + np.exp(-(0.5 + 2 * x)))
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, rng.random(500) < p)], "x double, y int")
    fit = {r.term: r.coefficient for r in S.logistic_fit(df, ["x"], "y").collect()}
    assert fit["x"] == pytest.approx(2, abs=0.5)


def test_unfolding_gives_the_folded_cells_back(spark):
    df = spark.range(23).select("id", (F.col("id") * 1.5).alias("v"))
    wide = C.fold_rows(df, ["id"], "v", 4)
    flat = C.unfold_rows(wide, "row", [f"c{i}" for i in range(4)])
    assert sorted((r.pos, r.value) for r in flat.collect() if r.value is not None) == [(i, i * 1.5) for i in range(23)]


def test_resh_fold_carries_the_cells_read_back_from_the_flat_positions(spark, tmp_path):
    values = [None if i % 7 == 5 else i * 1.5 for i in range(22)]
    spark.createDataFrame([(100 - i, values[21 - i]) for i in range(22)], "event_id long, value double").write.parquet(str(tmp_path / "events.parquet"))
    out = QUERIES["resh_fold"].run(Tables(spark, str(tmp_path)))
    assert out.columns == ["row", "c0", "c1", "c2", "c3", "back1"]
    padded = [*values, None, None]
    assert sorted(map(tuple, out.collect())) == [(i, *padded[4 * i : 4 * i + 4], padded[4 * i + 1]) for i in range(6)]


def test_too_many_levels_are_not_paired(spark, monkeypatch):
    df = spark.range(6).select((F.col("id") % 3).alias("k"), "id")
    assert J.pairs_of_levels(df, "k", F.sum("id"), "d").count() == 9
    monkeypatch.setattr(J, "PAIRED_LEVELS", 2)
    with pytest.raises(Exception, match="more than 2 levels"):
        J.pairs_of_levels(df, "k", F.sum("id"), "d").collect()
