"""Ordered functions, sorting, limits, top-k."""

from pyspark.sql import functions as F

from riskframe.catalog.registry import N, query, r
from riskframe.functions.recode import level_order
from riskframe.operators import ordered as O
from riskframe.operators import stats as S
from riskframe.operators.aggregate import rate


@query("""SELECT event_id, round(sum(value) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) AS running,
          round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 4) AS user_running FROM events""")
def win_cumsum(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    whole = O.running_sum(rows, "value", ["ts", "event_id"], name="running")
    both = O.running_sum(whole, "value", ["ts", "event_id"], ["user_id"], "user_running")
    return both.select("event_id", r("running", 4).alias("running"), r("user_running", 4).alias("user_running"))


@query("SELECT event_id, round(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 6) AS diff FROM events")
def win_diff(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    return O.difference(rows, "value", ["ts", "event_id"], ["user_id"]).select("event_id", r("diff").alias("diff"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity - avg(l_quantity) OVER (PARTITION BY l_suppkey), 9) AS dev FROM lineitem")
def win_group_mean_dev(t):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = t.lineitem.select(*keys, "l_quantity")
    return S.deviation_from_group(rows, "l_quantity", ["l_suppkey"]).select(*keys, r("dev", 9).alias("dev"))


@query("""SELECT c_custkey, round((c_acctbal - m) / s, 6) AS z, round((c_acctbal - m) / sp, 6) AS z_pop, abs((c_acctbal - m) / s) > 1 AS outlier
          FROM customer, (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS s, stddev_pop(c_acctbal) AS sp FROM customer)""")
def win_zscore(t):
    rows = t.customer.select("c_custkey", "c_acctbal")
    z = S.z_scores(S.z_scores(rows, ["c_acctbal"]), ["c_acctbal"], population=True, suffix="_zp")
    return z.select(
        "c_custkey", r("c_acctbal_z").alias("z"), r("c_acctbal_zp").alias("z_pop"), (F.abs("c_acctbal_z") > 1).alias("outlier")
    )


@query("SELECT l_quantity, round(max(cd) * 100, 6) AS pct_rank FROM (SELECT l_quantity, cume_dist() OVER (ORDER BY l_quantity) AS cd FROM lineitem) GROUP BY 1")
def win_percentile_rank(t):
    ranks = O.value_ranks(t.lineitem, "l_quantity")
    return ranks.select("l_quantity", r(F.col("at_or_below") / F.col("n") * 100).alias("pct_rank"))


@query("""SELECT DISTINCT event_type, value, round(cume_dist() OVER w, 6) AS ecdf, round(1 - cume_dist() OVER w, 6) AS complement,
          count(*) OVER (PARTITION BY event_type ORDER BY value RANGE UNBOUNDED PRECEDING) AS cum_count
          FROM events WINDOW w AS (PARTITION BY event_type ORDER BY value)""")
def win_ecdf(t):
    out = O.ecdf(t.events, "value", ["event_type"])
    return out.select("event_type", "value", r("ecdf").alias("ecdf"), r("complement").alias("complement"), "cum_count")


@query("SELECT c_mktsegment, round(avg((c_acctbal > 4000)::INT) * 100, 6) AS pct_above FROM customer GROUP BY 1")
def win_share_over(t):
    return t.customer.groupBy("c_mktsegment").agg(r(rate(F.col("c_acctbal") > 4000) * 100).alias("pct_above"))


@query("""WITH f AS (SELECT user_id, ts, event_id, value > 20 AS flag, sum((NOT value > 20)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id
          ROWS UNBOUNDED PRECEDING) AS island FROM events),
          up AS (SELECT user_id, ts, event_id, coalesce(value > lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), false) AS flag FROM events),
          u AS (SELECT *, sum((NOT flag)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM up)
          SELECT user_id, a.longest AS longest_flagged, b.longest AS longest_rise FROM
          (SELECT user_id, max(c) AS longest FROM (SELECT user_id, island, sum(flag::INT)::BIGINT AS c FROM f GROUP BY 1, 2) GROUP BY 1) a JOIN
          (SELECT user_id, max(c) AS longest FROM (SELECT user_id, island, sum(flag::INT)::BIGINT AS c FROM u GROUP BY 1, 2) GROUP BY 1) b USING (user_id)""")
def win_streak(t):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    order, by = ["ts", "event_id"], ["user_id"]
    points = O.split_points(rows, [*by, *order])
    flagged = O.longest_streak(rows, F.col("value") > 20, order, by, "longest_flagged", points=points)
    changes = O.difference(rows, "value", order, by, points=points)
    rises = O.longest_streak(changes, F.col("diff") > 0, order, by, "longest_rise", points=points)
    return flagged.join(rises, "user_id")


@query("""SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events WHERE value > 50""")
def win_running_flag(t):
    flagged = t.events.filter("value > 50").select("user_id", "event_id", "ts")
    return O.positions(flagged, ["ts", "event_id"], ["user_id"], "step").select("user_id", "event_id", (F.col("step") + 1).alias("step"))


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer")
def win_rank_order(t):
    rows = t.customer.select("c_custkey", (-F.col("c_acctbal")).alias("key"))
    return O.positions(rows, ["key", "c_custkey"], name="place").select("c_custkey", (F.col("place") + 1).alias("place"))


@query("""SELECT DISTINCT l_quantity, round(rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0::DOUBLE, 6) AS avg_rank FROM lineitem""")
def win_spearman_rank(t):
    return O.average_ranks(t.lineitem, "l_quantity").select("l_quantity", r("avg_rank").alias("avg_rank"))


# ------------------------------------------------------------------ sort, limit, top-k
@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey")
def sort_one(t):
    return t.customer.select("c_custkey", "c_acctbal").orderBy(F.col("c_acctbal").desc_nulls_last(), "c_custkey")


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey")
def sort_multi(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rows.orderBy(F.col("o_orderpriority").asc_nulls_last(), F.col("o_totalprice").desc_nulls_last(), "o_orderkey")


@query("""SELECT c_custkey, round(c_acctbal - c_nationkey / 1000.0, 6) AS score FROM customer ORDER BY score DESC, c_custkey""")
def sort_expr(t):
    score = r(F.col("c_acctbal") - F.col("c_nationkey") / 1000.0)
    return t.customer.select("c_custkey", score.alias("score")).orderBy(F.desc("score"), "c_custkey")


@query("""SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1 ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END""")
def sort_custom_order(t):
    counts = t.orders.groupBy("o_orderstatus").agg(N().alias("n"))
    return counts.orderBy(level_order("o_orderstatus", ["P", "O", "F"]))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def topk_largest(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25")
def topk_smallest(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey").limit(25)


@query("""SELECT c_custkey, dev FROM (SELECT c_custkey, round(c_acctbal - avg(c_acctbal) OVER (), 4) AS dev FROM customer)
          ORDER BY abs(dev) DESC, c_custkey LIMIT 20""")
def topk_abs(t):
    mean = t.customer.agg(F.avg("c_acctbal")).scalar()
    rows = t.customer.select("c_custkey", r(F.col("c_acctbal") - mean, 4).alias("dev"))
    return rows.orderBy(F.abs("dev").desc(), "c_custkey").limit(20)


@query("SELECT event_id, event_type FROM events WHERE event_type = 'error' ORDER BY ts, event_id LIMIT 30")
def limit_first_n(t):
    return t.events.filter("event_type = 'error'").orderBy("ts", "event_id").limit(30).select("event_id", "event_type")
