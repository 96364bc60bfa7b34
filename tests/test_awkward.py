"""Labels, texts, ties and values that simple inputs do not show."""

import datetime as dt
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions import text as T
from riskframe.functions import udfs as U
from riskframe.operators import aggregate as A
from riskframe.operators import ordered as O
from riskframe.operators import profile as P
from riskframe.operators import quality as Q
from riskframe.operators import reshape as R
from riskframe.operators import stats as S
from riskframe.sources import files as io
from riskframe.streaming import monitors as M


def test_undeclared_labels_are_found_or_refused(spark):
    df = spark.createDataFrame([("r", "a"), ("r", "b"), ("s", "c"), ("s", None)], "k string, c string")
    assert {tuple(r) for r in R.crosstab(df, "k", "c").collect()} == {("r", 1, 1, 0), ("s", 0, 0, 1)}
    share = {r.k: (r.a, r.b, r.c) for r in R.crosstab_share(df, "k", "c").collect()}
    assert share == {"r": (0.5, 0.5, 0.0), "s": (0.0, 0.0, 1.0)}
    with pytest.raises(Exception, match="undeclared label: c"):
        R.crosstab(df, "k", "c", ["a", "b"]).collect()


def test_fingerprints_keep_every_digit(spark):
    at = dt.datetime(2024, 5, 1, 12, 0, 0, 1)
    rows = [(1, at, 0.1), (2, at + dt.timedelta(microseconds=1), 0.1), (3, at, 0.1), (4, at, 0.1 + 2**-54), (5, None, None), (6, None, None)]
    df = spark.createDataFrame(rows, "id int, t timestamp, x double")
    flags = {r.id: r.has_copies for r in Q.duplicate_flags(df, ["t", "x"], "id").collect()}
    assert flags == {1: True, 2: False, 3: True, 4: False, 5: True, 6: True} or rows[3][2] == 0.1


def test_extreme_with_text_ties_and_nan(spark):
    df = spark.createDataFrame([("g", 2.0, "q"), ("g", 2.0, "p"), ("g", float("nan"), "a"), ("g", 1.0, "z"), ("g", None, "b")], "g string, x double, t string")
    assert A.arg_extreme(df, "x", "t", ["g"]).first().t == "p"
    assert A.arg_extreme(df, "x", "t", ["g"], largest=False).first().t == "z"


def test_repeated_keys_keep_the_last_value(spark):
    got = spark.range(1).select(T.key_values(F.lit("a: 1 | b: 2 | a: 3")).alias("m")).first().m
    assert got == {"a": "3", "b": "2"}


def test_group_moments_of_large_values_and_single_rows(spark):
    xs = [1e9 + d for d in (1.0, 2.0, 4.0, 4.5)]
    df = spark.createDataFrame([("a", x) for x in xs] + [("b", 5.0)], "grp string, x double").repartition(3)
    got = {r.grp: (r.n, r.sd) for r in U.merge_moments(df.mapInPandas(U.batch_moments, U.MOMENTS_SCHEMA)).collect()}
    assert got["a"][0] == 4 and got["a"][1] == pytest.approx(statistics.stdev(xs)) and got["b"] == (1, None)


def test_csv_round_trip_and_header_names(spark, tmp_path):
    rows = [(1, 'say "hi", ok', 2.5), (2, "back\\slash", None), (3, "two\nlines", 0.0), (4, "", 1.0), (5, None, 3.0)]
    df = spark.createDataFrame(rows, "id long, note string, x double")
    io.write_csv(df.coalesce(1), str(tmp_path / "a"))
    back = io.read_csv(spark, str(tmp_path / "a"), df.schema)
    assert sorted(map(tuple, back.collect())) == rows
    (tmp_path / "b.csv").write_text("x,id,note\n7.5,1,one\nbad,2,two\n")
    found = io.read_csv(spark, str(tmp_path / "b.csv"), df.schema, corrupt="raw").cache()
    good, bad = io.split_corrupt(found, "raw")
    assert [tuple(r) for r in good.collect()] == [(1, "one", 7.5)]
    assert bad.first().raw.startswith("bad,2,two")
    with pytest.raises(ValueError, match="no column"):
        io.read_csv(spark, str(tmp_path / "b.csv"), "id long, missing string")


def test_split_points_need_no_sorted_sample(spark, monkeypatch):
    df = spark.range(100_000).select(F.xxhash64("id").alias("k"))
    points = O.split_points(df, ["k"], 50)
    assert 40 <= len(points) <= 60 and [p[0] for p in points] == sorted(p[0] for p in points)
    assert O.split_points(df.limit(100), ["k"], 50) == []


def test_density_of_a_long_tail(spark):
    x = np.random.default_rng(4).lognormal(0, 3, 4000)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    curve = S.kde(df, "x", points=400).orderBy("i").toPandas()
    h = len(x) ** -0.2 * x.std(ddof=1)
    exact = np.exp(-0.5 * ((curve["x"].to_numpy()[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert len(curve) == 400 and np.abs(curve["density"] - exact).max() < 1e-7 * exact.max()
    same = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert S.kde(same, "x").count() == 0


def test_histograms_keep_every_row(spark):
    for seed in range(5):
        x = np.random.default_rng(seed).random(60) * 0.3 + 0.1
        df = spark.createDataFrame([("g", float(v), float(v)) for v in x] + [("g", None, 1.0)], "g string, x double, y double")
        bins = 7 + seed
        assert S.histogram(df, "x", bins).agg({"cnt": "sum"}).first()[0] == 60
        assert S.histogram_by(df, "x", "g", bins).agg({"cnt": "sum"}).first()[0] == 60
        assert S.histogram_2d(df, "x", "y", bins, bins).agg({"cnt": "sum"}).first()[0] == 60


def test_rank_correlation_with_a_hot_value(spark, monkeypatch):
    from riskframe.operators import joins as J

    monkeypatch.setattr(J, "BROADCAST_KEYS", 10)
    rng = np.random.default_rng(1)
    x = np.where(rng.random(600) < 0.35, 0, rng.integers(1, 400, 600))
    y = x + rng.integers(0, 300, 600)
    rank = lambda v: np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(x, y)], "x int, y int")
    assert S.spearman(df, "x", "y").first().rho == pytest.approx(np.corrcoef(rank(x), rank(y))[0, 1])


def test_describe_numbers_and_text_together(spark):
    df = spark.createDataFrame([(1, "a", True), (2, "b", None), (3, "b", True), (None, None, False)], "n int, t string, b boolean")
    got = {r.column: r for r in P.describe_all(df).collect()}
    assert (got["n"]["count"], got["n"]["mean"], got["n"].top) == (3, 2.0, None)
    assert (got["t"]["count"], got["t"].unique, got["t"].top, got["t"].freq, got["t"]["mean"]) == (3, 2, "b", 2, None)
    assert got["b"].top == "true"


def test_streams_go_on_where_they_stopped(spark, tmp_path):
    folder, base, sums = str(tmp_path / "in"), str(tmp_path / "seq"), str(tmp_path / "sums")

    def arrive(low, high):
        spark.range(low, high).select("id", (F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v")).coalesce(1).write.mode("append").parquet(folder)

    def run():
        stream = M.read_parquet_stream(spark, folder, "*.parquet", files_per_trigger=1)
        items = M.flag_sequence(stream, F.col("id") != 3, "k", ["id"], base).collect()
        totals = M.drain_state_table(M.running_totals(stream, "k", "v"), ["k"], sums).collect()
        return sorted((r.k, r.seq, r.id) for r in items), {r.k: (r.total, r.n) for r in totals}

    def batch(n):
        seen = {k: [i for i in range(n) if i % 2 == k] for k in (0, 1)}
        kept = {k: [i for i in v if i != 3] for k, v in seen.items()}
        return sorted((k, j + 1, i) for k, v in kept.items() for j, i in enumerate(v)), {k: (float(sum(v)), len(v)) for k, v in seen.items()}

    arrive(0, 4)
    arrive(4, 9)
    assert run() == batch(9)
    assert run() == batch(9)  # nothing new
    arrive(9, 10)  # one key only
    arrive(10, 14)
    assert run() == batch(14)


def test_logistic_fit_says_when_it_has_not_converged(spark):
    df = spark.createDataFrame([(float(i), (i * 7) % 3, int((i * 13) % 5 < 2)) for i in range(60)], "a double, b int, y int")
    assert S.logistic_fit(df, ["a", "b"], "y").count() == 3
    with pytest.raises(ValueError, match="no convergence"):
        S.logistic_fit(df, ["a", "b"], "y", max_iter=1)
