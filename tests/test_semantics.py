"""The places where table libraries and SQL engines usually disagree, one test each."""

import math

from pyspark.sql import functions as F

from riskframe.functions import numbers as M
from riskframe.operators import aggregate as G
from riskframe.operators import profile as P
from riskframe.operators import reshape as R
from riskframe.operators.ordered import average_ranks, positions
from riskframe.sources import files as io


def test_nan_becomes_null_before_it_is_averaged(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (3.0,)], "x double")
    assert df.select(M.nan_to_null("x").alias("x")).agg(F.avg("x")).first()[0] == 2.0


def test_csv_blank_is_null_not_nan(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,x\n1,\n2,5.5\n")
    rows = io.read_csv(spark, str(tmp_path / "a.csv"), "k int, x double").orderBy("k").collect()
    assert [r.x for r in rows] == [None, 5.5]


def test_missing_keys_are_left_out_of_groups(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], "k string, v int")
    assert [tuple(r) for r in G.group_by(df, ["k"], F.sum("v").alias("s")).collect()] == [("a", 4)]
    assert [tuple(r) for r in P.value_counts(df, "k").collect()] == [("a", 2)]
    assert R.pivot(df.withColumn("c", F.lit("x")), "k", "c", ["x"], F.sum("v")).count() == 1


def test_positions_put_missing_first_only_in_ascending_key_order(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 2.0)], "id int, x double")
    # missing last: an explicit null flag leads the order key
    got = positions(df, [F.col("x").isNull(), "x", "id"]).orderBy("pos").collect()
    assert [r.id for r in got] == [3, 1, 2]


def test_share_is_rounded_before_scaling(spark):
    df = spark.createDataFrame([("a",)] * 1 + [("b",)] * 2, "k string")
    got = {r.k: round(r.pct, 6) for r in P.value_shares(df, "k").collect()}
    assert got == {"a": 33.33, "b": 66.67}


def test_ties_share_their_mean_rank(spark):
    df = spark.createDataFrame([(x,) for x in (10.0, 20.0, 20.0, 30.0)], "x double")
    assert {r.x: r.avg_rank for r in average_ranks(df, "x").collect()} == {10: 1, 20: 2.5, 30: 4}


def test_named_groups_and_back_references(spark):
    df = spark.createDataFrame([("term=36m; plate KX-204-LM",)], "s string")
    row = df.select(
        F.regexp_extract("s", r"(?<key>[a-z]+)=(?<months>\d+)m", 2), F.regexp_replace("s", r"([A-Z]{2})-\d{3}-([A-Z]{2})", "$2/$1")
    ).first()
    assert row[0] == "36" and row[1] == "term=36m; plate LM/KX"


def test_json_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "k int, s string")
    io.write_json(df, str(tmp_path / "j"))
    back = spark.read.schema("k int, s string").json(str(tmp_path / "j"))
    assert sorted(back.collect(), key=lambda r: r.k) == df.collect()
