"""Keyed state of streams, sketches, stratified samples, wide correlations and the table function."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions import udfs as U
from riskframe.operators import profile as P
from riskframe.operators import sketches as K
from riskframe.operators import stats as S
from riskframe.operators import wide as W
from riskframe.streaming import monitors as M

random.seed(23)
ITEM = "k string, at timestamp, id long, v double, tag array<string>, big long, empty int"


def items(n, first=0):
    out = []
    for i in range(first, first + n):
        v = random.choice([None, float("nan") if i % 97 == 0 else 0.1 * i, 1e-9 * i, -3.0 * i])
        out.append((random.choice(["a", "b", None, "hot", "hot", "hot"]), None if i % 11 == 0 else f"2024-01-01 00:00:{i % 50:02d}.123456", i, v, ["x", None][: i % 3], None if i % 5 else (1 << 60) + i, None))
    return out


def arrive(spark, folder, rows):
    df = spark.createDataFrame(rows, ITEM.replace("at timestamp", "at string")).withColumn("at", F.col("at").cast("timestamp")).select([c.split()[0] for c in ITEM.split(", ")])
    df.coalesce(1).write.mode("append").parquet(folder)


def brute(batches):
    """(id, seq, running) when batches of rows arrive one after the other."""
    state, out = {}, {}
    for rows in batches:
        for k, at, i, v, *_ in sorted(rows, key=lambda r: (r[1] is None, r[1] or "", r[2])):
            n, total = state.get(k, (0, 0.0))
            state[k] = n + 1, total + (v if v and v == v else 0.0)
            out[i] = state[k]
    return out


def test_every_row_is_numbered_once(spark, tmp_path):
    folder, base = str(tmp_path / "in"), str(tmp_path / "out")
    sent = [[r for r in items(40, 0)], [r for r in items(30, 100)]]

    def run():
        stream = M.read_parquet_stream(spark, folder, "*.parquet", files_per_trigger=1)
        out = M.running_rows(stream, "k", ["at", "id"], "v")

        def store(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{base}/items/batch={batch_id}")

        M.run_available(out, store, checkpoint=f"{base}/checkpoint")
        return {r.id: r for r in spark.read.parquet(f"{base}/items").drop("batch").collect()}

    for part in sent:
        arrive(spark, folder, part)
    got, want = run(), brute(sent)
    assert {i: (r.seq, r.running) for i, r in got.items()} == want
    # other columns come back as they were, nulls and large numbers included
    for k, at, i, v, tag, big, empty in (r for part in sent for r in part):
        assert (got[i].k, got[i].tag, got[i].big, got[i].empty) == (k, tag, big, None)
        assert got[i].v == v or (v != v and got[i].v != got[i].v)
        assert (got[i].at and got[i].at.strftime("%Y-%m-%d %H:%M:%S.%f")) == at
    # a restarted stream goes on where it was, and a batch writes only its own rows
    sent.append([("a", None, 500, 1.0, [], None, None)])
    arrive(spark, folder, sent[-1])
    got, want = run(), brute(sent)
    assert {i: (r.seq, r.running) for i, r in got.items()} == want
    assert spark.read.parquet(f"{base}/items/batch=2").count() == 1
    # a batch that is retried, because its commit was lost, gives the same rows again
    os.remove(f"{base}/checkpoint/commits/2")
    if os.path.exists(f"{base}/checkpoint/commits/.2.crc"):
        os.remove(f"{base}/checkpoint/commits/.2.crc")
    again = run()
    assert {i: r.seq for i, r in again.items()} == {i: r.seq for i, r in got.items()}


def test_state_of_a_hot_key(spark, tmp_path):
    # one key holds all rows of a batch: 60,000 rows pass through one task in order
    spark.range(60_000).select(F.lit("hot").alias("k"), (60_000 - F.col("id")).alias("id"), F.lit(1.0).alias("v")).write.parquet(str(tmp_path / "in"))
    stream = M.read_parquet_stream(spark, str(tmp_path / "in"), "*.parquet")
    out = M.drain_to_table(M.running_rows(stream, "k", ["id"], "v"))
    assert out.where((F.col("seq") != F.col("id")) | (F.col("running") != F.col("seq"))).count() == 0 and out.count() == 60_000


# ---------------------------------------------------------------- sketches
def test_quantiles_of_merged_sketches_keep_their_bound(spark):
    n = 60_000
    df = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(n)).cast("double").alias("v"), (F.col("id") % 3).alias("g"), (F.col("id") % 40).alias("day"))
    extra = spark.createDataFrame([(None, 0, 1), (float("nan"), 1, 2)], "v double, g long, day long")
    stored = K.quantile_sketches(df.unionByName(extra), "v", ["g", "day"], k=200)
    wanted = {f"p{p}": p / 100 for p in (1, 10, 25, 50, 75, 90, 99)}
    found = K.merged_quantiles(stored, wanted, ["g"])
    assert [(r.n, r.parts) for r in found.collect()] == [(20_000, 40)] * 3
    for name, p in wanted.items():
        bounds = K.rank_bounds(df, "v", found, name, ["g"])
        assert bounds.where(~K.within_rank(p, 2 * K.rank_error(200))).count() == 0
    # any part of the days, and the exact value where a sketch keeps all
    few = K.merged_quantiles(stored.where("day in (1, 5)"), {"top": 1.0, "low": 0.0}, ["g"])
    exact = df.where("day in (1, 5)").groupBy("g").agg(F.max("v").alias("top"), F.min("v").alias("low"))
    assert sorted(map(tuple, few.select("g", "top", "low").collect())) == sorted(map(tuple, exact.collect()))
    assert K.merged_quantiles(stored.limit(0), wanted).count() == 0
    assert K.quantile_sketches(extra, "v", ["g"]).count() == 0


def test_distinct_counts_of_any_days(spark):
    df = spark.range(50_000).select((F.col("id") % 20_011).alias("user"), F.when(F.col("id") % 7 > 0, (F.col("id") % 31)).alias("day"), (F.col("id") % 2).alias("g"))
    stored = K.distinct_sketches(df, "user", ["g", "day"])
    for chosen in (F.col("day") < 3, F.col("day").isNull(), F.lit(True)):
        got = {r.g: r for r in K.merged_distinct(stored.where(chosen), ["g"]).collect()}
        for r in df.where(chosen).groupBy("g").agg(F.countDistinct("user").alias("d"), F.count(F.lit(1)).alias("n")).collect():
            assert got[r.g].n == r.n and abs(got[r.g].n_distinct - r.d) <= 4 * K.distinct_error() * r.d + 1
    assert K.merged_distinct(stored.limit(0)).first().n_distinct == 0


# ---------------------------------------------------------------- strata
def test_strata_have_exact_numbers(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 10 < 6, "hot").when(F.col("id") % 10 < 9, "mid").when(F.col("id") == 19, "one").alias("s"))
    sizes = {r.s: r.n for r in df.groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}
    count = lambda out: {r.s: r.n for r in out.groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert count(P.sample_strata(df, "id", "s", 30, 1)) == {s: min(30, n) for s, n in sizes.items()}
    assert count(P.sample_strata(df, "id", "s", {"hot": 50, "one": 9, "none": 3}, 1)) == {"hot": 50, "one": 1}
    assert count(P.sample_strata_fraction(df, "id", "s", 0.25, 1)) == {s: int(n * 0.25 + 0.5) for s, n in sizes.items() if int(n * 0.25 + 0.5)}
    ids = lambda out: {r.id for r in out.collect()}
    assert ids(P.sample_strata(df, "id", "s", 30, 1)) == ids(P.sample_strata(df.repartition(5), "id", "s", 30, 1)) != ids(P.sample_strata(df, "id", "s", 30, 2))
    # tasks keep a bounded number per stratum before the shuffle
    assert "WindowGroupLimit" in P.sample_strata(df, "id", "s", 30, 1)._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- wide tables
def test_wide_correlations_equal_the_narrow_form(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 10)) * 10.0 ** rng.integers(-3, 6, 10) + 1e6
    x[:, 3] = x[:, 2] * 2 + rng.normal(size=300) * 1e-3
    x[:, 9] = 5.0
    rows = [[None if rng.random() < 0.1 else float(v) for v in r] for r in x]
    names = [f"c{i}" for i in range(9)] + ["odd name"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(6)
    got = {(r.a, r.b): (r.n, r.r) for r in W.correlation_long(df, names, width=4).collect()}
    assert len(got) == 45
    for i in range(10):
        for j in range(i + 1, 10):
            both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
            n, r = got[names[i], names[j]]
            assert n == len(both)
            assert r is None if j == 9 else r == pytest.approx(np.corrcoef(np.array(both).T)[0, 1], abs=1e-7)
    narrow = {(r.a, r.b): r.r for r in S.correlation_pairs(df, names[:9]).collect()}
    assert all(got[k][1] == pytest.approx(v, abs=1e-7) for k, v in narrow.items())


def test_two_thousand_columns(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 2000))
    df = spark.createDataFrame([(r.tolist(), 1) for r in x] + [([1.0], 1), (None, 1)], "v array<double>, n int").repartition(3)
    out = W.correlation_long(df, vector="v", size=2000)
    assert len(out._jdf.queryExecution().toString()) < 20_000
    want = np.corrcoef(x.T)
    got = out.where("a % 97 = 0 or b = 1999").collect()
    assert all(r.n == 200 and r.r == pytest.approx(want[r.a, r.b], abs=1e-9) for r in got) and len(got) > 20_000
    assert out.count() == 1999 * 1000
    with pytest.raises(ValueError, match="columns"):
        W.correlation_long(df, vector="v", size=W.MAX_COLUMNS + 1)
    assert W.correlation_long(df.limit(0), vector="v", size=3).count() == 0


# ---------------------------------------------------------------- table function
def test_entries_parse_in_batches(spark):
    rows = [(1, "ann,5,10;bob,x,3;;c,1"), (2, None), (3, ""), (4, "d, 7 ,+8;e,-1,2147483648;f,1.5,2"), (None, "g,99999999999999999999,1")]
    df = spark.createDataFrame(rows, "k long, raw string").repartition(2)
    parse = U.entry_parser({"name": "string", "score": "int", "income": "int"}, {"k": "long"})
    out = parse(df.asTable())
    assert out.columns == ["k", "name", "score", "income", "error"]
    got = sorted(map(tuple, out.collect()), key=str)
    wrong = lambda n: f"field {n} is not a number"
    width = lambda n: f"{n} fields instead of 3"
    assert got == sorted([
        (1, "ann", 5, 10, None), (1, None, None, None, wrong(2)), (1, None, None, None, width(1)), (1, None, None, None, width(2)),
        (2, None, None, None, width(1)), (3, None, None, None, width(1)), (4, "d", 7, 8, None), (4, None, None, None, wrong(3)),
        (4, None, None, None, wrong(2)), (None, None, None, None, wrong(2)),
    ], key=str)
    # other arguments, other columns
    two = U.entry_parser({"a": "int", "b": "string"}, {"k": "long"}, row_sep="|", field_sep=":")
    pairs = spark.createDataFrame([(7, "1:x|2:y|z:3")], "k long, raw string")
    assert sorted(map(tuple, two(pairs.asTable()).collect()), key=str) == sorted([(7, 1, "x", None), (7, 2, "y", None), (7, None, None, wrong(1))], key=str)
