"""Statistics, model-style and risk jobs."""

import math

from pyspark.sql import functions as F

from riskframe.catalog.aggregates import KIND_SQL, accounts
from riskframe.catalog.registry import N, query, r
from riskframe.functions.bins import cut, digitize
from riskframe.functions.recode import flag
from riskframe.operators import stats as S
from riskframe.operators import wide as W
from riskframe.operators.quantiles import EXCLUSIVE
from riskframe.plans import risk

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PAIRS = [(a, b) for i, a in enumerate(LINE) for b in LINE[i + 1 :]]


# ------------------------------------------------------------------ correlation and regression
@query("""SELECT l_returnflag, round(covar_samp(l_quantity, l_extendedprice), 4) AS cov, round(corr(l_quantity, l_extendedprice), 6) AS r,
          round(corr(l_quantity, (l_linestatus = 'F')::INT), 6) AS r_flag FROM lineitem GROUP BY 1""")
def stat_cov_corr(t):
    closed = flag(F.col("l_linestatus") == "F")
    return t.lineitem.groupBy("l_returnflag").agg(
        r(F.covar_samp("l_quantity", "l_extendedprice"), 4).alias("cov"), r(F.corr("l_quantity", "l_extendedprice")).alias("r"),
        r(F.corr("l_quantity", closed)).alias("r_flag"),
    )


def pair_sql(a, b, extra=""):
    return f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r{extra} FROM lineitem"


@query(" UNION ALL ".join(pair_sql(a, b) for a, b in PAIRS))
def stat_corr_matrix(t):
    return S.correlation_pairs(t.lineitem, LINE).select("a", "b", r("r").alias("r"))


@query("""WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings WHERE len(embedding) = 64)
          SELECT a.i AS a, b.i AS b, count(*) AS n, round(corr(a.x, b.x), 5) AS r FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY 1, 2""")
def stat_corr_wide(t):
    return W.correlation_long(t.embeddings, vector="embedding", size=64).select("a", "b", "n", r("r", 5).alias("r"))


def rank_sql(col, name):
    return f"rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2.0::DOUBLE AS {name}"


@query(f"SELECT round(corr(a, b), 6) AS rho, count(*) AS n FROM (SELECT {rank_sql('l_quantity', 'a')}, {rank_sql('l_extendedprice', 'b')} FROM lineitem)")
def stat_corr_spearman(t):
    return S.spearman(t.lineitem, "l_quantity", "l_extendedprice").select(r("rho").alias("rho"), "n")


WIDE = ["quantity", "price", "net", "charge"]
WIDE_SQL = """(SELECT l_quantity AS quantity, l_extendedprice AS price, l_extendedprice * (1 - l_discount) AS net,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem)"""


@query("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM {WIDE_SQL}" for i, a in enumerate(WIDE) for b in WIDE[i + 1 :]
) + ") WHERE abs(r) > 0.7 ORDER BY abs(r) DESC")
def stat_corr_pairs(t):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    wide = t.lineitem.select(
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), net.alias("net"), (net * (1 + F.col("l_tax"))).alias("charge")
    )
    strong = S.correlation_pairs(wide, WIDE).filter(F.abs("r") > 0.7)
    return strong.select("a", "b", r("r").alias("r")).orderBy(F.abs("r").desc())


@query(" UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr({c}, l_extendedprice), 6) AS r FROM lineitem" for c in LINE if c != "l_extendedprice"))
def stat_corr_target(t):
    pairs = S.correlation_pairs(t.lineitem, LINE)
    target = "l_extendedprice"
    hits = pairs.filter((F.col("a") == target) | (F.col("b") == target))
    return hits.select(F.when(F.col("a") == target, F.col("b")).otherwise(F.col("a")).alias("feature"), r("r").alias("r")).orderBy(F.abs("r").desc())


@query("""SELECT round(ra, 6) AS r_a, round(rb, 6) AS r_b, CASE WHEN abs(ra) > abs(rb) THEN 'l_quantity' ELSE 'l_discount' END AS stronger
          FROM (SELECT corr(l_quantity, l_extendedprice) AS ra, corr(l_discount, l_extendedprice) AS rb FROM lineitem)""")
def stat_stronger_predictor(t):
    return S.stronger_predictor(t.lineitem, "l_quantity", "l_discount", "l_extendedprice").select(r("r_a").alias("r_a"), r("r_b").alias("r_b"), "stronger")


@query("""SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
          round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, count(*) AS n FROM lineitem GROUP BY 1""")
def stat_linfit(t):
    fit = S.linear_fit(t.lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"])
    return fit.select("l_returnflag", r("slope", 5).alias("slope"), r("intercept", 4).alias("intercept"), r("r2").alias("r2"), "n")


@query("""WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS m, regr_intercept(l_extendedprice, l_quantity) AS c, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
          SELECT i::INT AS i, round(lo + i * (hi - lo) / 99.0, 6) AS x, round(m * (lo + i * (hi - lo) / 99.0) + c, 4) AS y_hat FROM f, (SELECT unnest(range(100)) AS i)""")
def stat_linfit_line(t):
    return S.fitted_line(t.lineitem, "l_quantity", "l_extendedprice", 100).select("i", r("x").alias("x"), r("y_hat", 4).alias("y_hat"))


@query("""WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS m, regr_intercept(l_extendedprice, l_quantity) AS c FROM lineitem)
          SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice - (m * l_quantity + c), 2) AS residual FROM lineitem, f""")
def stat_residuals(t):
    out = S.residuals(t.lineitem, "l_quantity", "l_extendedprice")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r("residual", 2).alias("residual"))


@query("""WITH c AS (SELECT avg(l_quantity) AS mx, avg(l_quantity * l_quantity) AS mq, avg(l_extendedprice) AS my FROM lineitem),
          d AS (SELECT l_quantity - mx AS x, l_quantity * l_quantity - mq AS q, l_extendedprice - my AS y FROM lineitem, c),
          s AS (SELECT sum(x * x) AS xx, sum(x * q) AS xq, sum(q * q) AS qq, sum(x * y) AS xy, sum(q * y) AS qy FROM d),
          b AS (SELECT (xy * qq - qy * xq) / (xx * qq - xq * xq) AS a1, (qy * xx - xy * xq) / (xx * qq - xq * xq) AS a2 FROM s)
          SELECT round(my - a1 * mx - a2 * mq, 3) AS a0, round(a1, 4) AS a1, round(a2, 5) AS a2 FROM b, c""")
def stat_polyfit2(t):
    fit = S.quadratic_fit(t.lineitem, "l_quantity", "l_extendedprice")
    return fit.select(r("a0", 3).alias("a0"), r("a1", 4).alias("a1"), r("a2", 5).alias("a2"))


def logit_sql(x1, x2, y, table, steps=8):
    """Newton steps of a logistic fit with two features, each one a pass over the rows."""
    def det(a, b, c):
        return (f"({a[0]} * ({b[1]} * {c[2]} - {c[1]} * {b[2]}) - {b[0]} * ({a[1]} * {c[2]} - {c[1]} * {a[2]})"
                f" + {c[0]} * ({a[1]} * {b[2]} - {b[1]} * {a[2]}))")

    x = ["1.0", "x1", "x2"]
    h = [[f"h{min(i, j)}{max(i, j)}" for i in range(3)] for j in range(3)]  # columns of the Hessian
    g = ["g0", "g1", "g2"]
    sums = [f"sum(w * {x[i]} * {x[j]}) AS h{i}{j}" for i in range(3) for j in range(i, 3)]
    sums += [f"sum(e * {x[i]}) AS g{i}" for i in range(3)]
    better = [f"b{k} + {det(*[g if j == k else h[j] for j in range(3)])} / {det(*h)} AS b{k}" for k in range(3)]
    ctes = [f"d AS MATERIALIZED (SELECT {x1} AS x1, {x2} AS x2, ({y})::INT AS y FROM {table})",
            "s0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)"]
    for k in range(steps):
        p = f"SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM d, s{k}"
        ctes.append(f"t{k} AS MATERIALIZED (SELECT any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2, {', '.join(sums)}"
                    f" FROM (SELECT *, p * (1 - p) AS w, y - p AS e FROM ({p})))")
        ctes.append(f"s{k + 1} AS MATERIALIZED (SELECT {', '.join(better)} FROM t{k})")
    terms = " UNION ALL ".join(f"SELECT '{n}' AS term, round(b{k}, 4) AS coefficient FROM s{steps}" for k, n in enumerate(["intercept", x1, x2]))
    return f"WITH {', '.join(ctes)} {terms}"


@query(logit_sql("l_quantity", "l_discount", "l_returnflag = 'R'", "lineitem"))
def stat_logit(t):
    rows = t.lineitem.select("l_quantity", "l_discount", flag(F.col("l_returnflag") == "R").alias("returned"))
    return S.logistic_fit(rows, ["l_quantity", "l_discount"], "returned").select("term", r("coefficient", 4).alias("coefficient"))


# ------------------------------------------------------------------ box summaries and outliers
def box_sql(value, table, by):
    keys = ", ".join(by)
    sel = f"{keys}, " if by else ""
    join = "USING (" + keys + ")" if by else "ON true"
    return f"""WITH q AS (SELECT {sel}count(*) AS n, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS med,
      quantile_cont({value}, 0.75) AS q3 FROM {table} GROUP BY ALL)
      SELECT {sel}any_value(n) AS n, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS med, round(any_value(q3), 6) AS q3,
      min({value}) FILTER (WHERE {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
      max({value}) FILTER (WHERE {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
      count(*) FILTER (WHERE NOT ({value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers
      FROM {table} JOIN q {join} GROUP BY ALL"""


def rounded_box(df, by):
    return df.select(*by, "n", r("q1").alias("q1"), r("med").alias("med"), r("q3").alias("q3"), "whisker_low", "whisker_high", "n_outliers")


@query(box_sql("value", "events", ["event_type"]))
def stat_box(t):
    return rounded_box(S.box_stats(t.events, "value", ["event_type"]), ["event_type"])


def fences_sql(q1, q3):
    return f"value < {q1} - 1.5 * ({q3} - {q1}) OR value > {q3} + 1.5 * ({q3} - {q1})"


@query("""WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
          s AS (SELECT value, row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n FROM events),
          e AS (SELECT p, max(value) FILTER (WHERE i = floor(p * (n + 1))) AS a, max(value) FILTER (WHERE i = floor(p * (n + 1)) + 1) AS b, max(p * (n + 1) - floor(p * (n + 1))) AS f
                FROM s, (SELECT unnest([0.25::DOUBLE, 0.75::DOUBLE]) AS p) GROUP BY 1),
          x AS (SELECT max(a + (b - a) * f) FILTER (WHERE p = 0.25) AS q1, max(a + (b - a) * f) FILTER (WHERE p = 0.75) AS q3 FROM e)
          SELECT 'upper_linear' AS rule, event_id, value FROM events, q WHERE value > q3 + 1.5 * (q3 - q1)
          UNION ALL SELECT 'both_exclusive', event_id, value FROM events, x WHERE """ + fences_sql("q1", "q3"))
def stat_iqr_outliers(t):
    rows = t.events.select("event_id", "value")
    upper = S.iqr_outliers(rows, "value", upper_only=True).select(F.lit("upper_linear").alias("rule"), "event_id", "value")
    both = S.iqr_outliers(rows, "value", EXCLUSIVE).select(F.lit("both_exclusive").alias("rule"), "event_id", "value")
    return upper.unionByName(both)


@query("SELECT o_orderkey, o_totalprice, o_totalprice > 495000 AS extreme FROM orders")
def stat_extreme(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return rows.withColumn("extreme", F.col("o_totalprice") > 495000)


@query("""WITH s AS (SELECT event_type, count(*) AS n, min(value) AS lo, max(value) AS hi, pow(count(*), -0.2) * stddev_samp(value) AS h FROM events GROUP BY 1),
          g AS (SELECT *, lo - 3 * h + i * ((hi - lo + 6 * h) / 199.0) AS x FROM s, (SELECT unnest(range(200)) AS i)),
          k AS (SELECT event_type, i, any_value(x) AS x, any_value(n) AS n, sum(exp(-0.5 * pow((x - value) / h, 2)) / (n * h * sqrt(2 * pi()))) AS density
                FROM g JOIN (SELECT event_type, value FROM events) e USING (event_type) GROUP BY 1, 2)
          SELECT event_type, i::INT AS i, round(x, 5) AS x, round(density, 7) AS density, round(density * n / (SELECT count(*) FROM events), 8) AS joint_density FROM k""")
def stat_kde(t):
    out = S.kde(t.events, "value", ["event_type"])
    share = F.col("share")
    return out.select(
        "event_type", "i", r("x", 5).alias("x"), r("density", 7).alias("density"), r(F.col("density") * share, 8).alias("joint_density")
    )


@query(box_sql("l_extendedprice", "lineitem", ["l_returnflag", "l_linestatus"]))
def stat_facet(t):
    by = ["l_returnflag", "l_linestatus"]
    return rounded_box(S.box_stats(t.lineitem, "l_extendedprice", by), by)


@query(" UNION ALL ".join(f"SELECT l_returnflag, '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem GROUP BY 1" for a, b in PAIRS))
def stat_pair_moments(t):
    return S.correlation_pairs(t.lineitem, LINE, ["l_returnflag"]).select("l_returnflag", "a", "b", r("r").alias("r"))


@query("""SELECT o_orderpriority, o_orderstatus, count(*) AS cnt, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders), 6) AS pct FROM orders GROUP BY 1, 2""")
def stat_count_plot(t):
    counts = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(N().alias("cnt"))
    total = counts.agg(F.sum("cnt")).scalar()
    return counts.withColumn("pct", r(F.col("cnt") * F.lit(100.0) / total)).orderBy("o_orderpriority", F.desc("cnt"))


@query("""SELECT bracket, l_linestatus, round(avg(f), 6) AS avg_value, count(*) AS n FROM (SELECT l_linestatus, (l_returnflag = 'R')::INT AS f,
          CASE WHEN l_extendedprice > 0 AND l_extendedprice <= 20000 THEN '<20k' WHEN l_extendedprice > 20000 AND l_extendedprice <= 40000 THEN '20k-40k'
          WHEN l_extendedprice > 40000 THEN '40k+' END AS bracket FROM lineitem) WHERE bracket IS NOT NULL GROUP BY 1, 2""")
def stat_point_trend(t):
    rows = t.lineitem.select("l_linestatus", "l_extendedprice", flag(F.col("l_returnflag") == "R").alias("f"))
    bracket = cut("l_extendedprice", [0, 20000, 40000, math.inf], ["<20k", "20k-40k", "40k+"])
    return S.mean_by_bin(rows, bracket, "f", ["l_linestatus"]).withColumn("avg_value", r("avg_value"))


@query("SELECT l_quantity AS x, l_returnflag AS hue, round(avg(l_extendedprice), 6) AS y FROM lineitem GROUP BY 1, 2")
def stat_line_by_x(t):
    out = t.lineitem.groupBy(F.col("l_quantity").alias("x"), F.col("l_returnflag").alias("hue"))
    return out.agg(r(F.avg("l_extendedprice")).alias("y")).orderBy("x", "hue")


@query("""WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS volume, round(avg((o_orderstatus = 'F')::INT), 6) AS rate FROM orders GROUP BY 1)
          SELECT *, month = (SELECT month FROM m ORDER BY volume DESC, month LIMIT 1) AS is_peak FROM m""")
def stat_dual_series(t):
    by_month = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        N().alias("volume"), r(F.avg(flag(F.col("o_orderstatus") == "F"))).alias("rate")
    )
    peak = by_month.agg(F.min_by("month", F.struct((-F.col("volume")).alias("v"), "month"))).scalar()
    return by_month.withColumn("is_peak", F.col("month") == peak)


# ------------------------------------------------------------------ account scan
def scan_accounts(t):
    """Customers as scored accounts: balance against a 10,000 limit, missed payments from the nation key."""
    return t.customer.select(
        "c_custkey", "c_mktsegment", F.greatest("c_acctbal", F.lit(0.0)).alias("balance"), F.lit(10000.0).alias("credit_limit"),
        (F.lit(850) - F.col("c_nationkey") * 14).alias("score"), F.pmod("c_nationkey", F.lit(5)).alias("missed_payments"),
    )


SCAN_SQL = """WITH a AS (SELECT c_custkey, c_mktsegment, greatest(c_acctbal, 0.0) AS balance, 850 - c_nationkey * 14 AS score, c_nationkey % 5 AS missed FROM customer),
  e AS (SELECT *, round_even(balance / 10000, 3) AS utilization, CASE WHEN score >= 750 THEN 'Low' WHEN score >= 650 THEN 'Medium' ELSE 'High' END AS risk_tier FROM a)"""


@query(SCAN_SQL + """SELECT c_custkey, utilization, risk_tier, missed >= 2 OR utilization > 0.9 AS urgent, CASE WHEN missed >= 3 THEN 'Restrict credit'
          WHEN utilization > 0.85 THEN 'Monitor' WHEN risk_tier = 'Low' AND utilization < 0.5 THEN 'Approved for limit increase' ELSE 'Monitor' END AS decision FROM e""")
def risk_enrich(t):
    return risk.enrich_accounts(scan_accounts(t)).select("c_custkey", "utilization", "risk_tier", "urgent", "decision")


# ------------------------------------------------------------------ fraud
def transactions(t):
    """Events as transactions: whole units as hundreds, errors are foreign, before six is night."""
    return t.events.select(
        "event_id", "ts", F.col("user_id").alias("customer"), (F.floor("value") * 100.0).alias("amount"),
        (F.col("event_type") == "error").alias("is_foreign"), (F.hour("ts") < 6).alias("is_night"),
    )


FRAUD_SQL = """WITH x AS (SELECT event_id, ts, user_id AS customer, floor(value) * 100 AS amount, event_type = 'error' AS f, hour(ts) < 6 AS nt FROM events),
  s AS (SELECT *, round_even(amount / 1000 + 2 * f::INT + nt::INT, 2) AS risk_score FROM x),
  d AS (SELECT *, CASE WHEN risk_score > 8 THEN 'Block' WHEN risk_score > 5 THEN 'Review' WHEN f AND amount > 1000 THEN 'Verify' ELSE 'Allow' END AS action FROM s) """


@query(FRAUD_SQL + "SELECT event_id, risk_score, action, risk_score > 5 AS flagged FROM d")
def risk_fraud(t):
    return risk.score_transactions(transactions(t)).select("event_id", "risk_score", "action", "flagged")


@query(FRAUD_SQL + """SELECT customer, count(*) AS txn_count, round(sum(amount), 2) AS total_amount, max(risk_score) AS max_risk_score,
          sum((risk_score > 5)::INT)::BIGINT AS n_flagged FROM d GROUP BY 1 HAVING count(*) >= 3 AND sum((risk_score > 5)::INT) > 0""")
def risk_fraud_customers(t):
    out = risk.suspicious_customers(risk.score_transactions(transactions(t)))
    return out.withColumn("total_amount", r("total_amount", 2))


@query(FRAUD_SQL + """SELECT count(*) AS total_txns, sum((action = 'Block')::INT)::BIGINT AS n_block, sum((action = 'Review')::INT)::BIGINT AS n_review,
          sum((action = 'Verify')::INT)::BIGINT AS n_verify, sum((action = 'Allow')::INT)::BIGINT AS n_allow, round(sum(amount) FILTER (WHERE action <> 'Allow'), 2) AS flagged_amount,
          first(event_id ORDER BY risk_score DESC, event_id) AS top_txn, max(risk_score) AS top_score FROM d""")
def risk_fraud_report(t):
    out = risk.fraud_report(risk.score_transactions(transactions(t)), "event_id")
    return out.withColumn("flagged_amount", r("flagged_amount", 2))


# ------------------------------------------------------------------ standardised score
FEATURES = ["l_extendedprice", "l_discount", "l_quantity", "l_tax"]
Z_SQL = "WITH m AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES) + " FROM lineitem), " + \
    "z AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, " + " + ".join(
        f"({w}) * (({c} - m_{c}) / s_{c})" for c, w in zip(FEATURES, risk.RISK_WEIGHTS)) + " AS s FROM lineitem, m) "


@query(Z_SQL + "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(s, 6) AS risk_score FROM z ORDER BY s DESC, 1, 2, 3, 4 LIMIT 10")
def risk_standardize_score(t):
    scored = risk.standardized_score(t.lineitem, FEATURES)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return scored.orderBy(F.desc("risk_score"), *keys).limit(10).select(*keys, r("risk_score").alias("risk_score"))


AGE_EDGES = [1, 10, 20, 30, 40, 50]


@query(Z_SQL + "SELECT " + " + ".join(f"(l_quantity >= {e})::INT" for e in AGE_EDGES) + " AS bucket, count(*) AS n, round(avg(s), 6) AS avg_risk FROM z GROUP BY 1")
def risk_by_age_bucket(t):
    scored = risk.standardized_score(t.lineitem, FEATURES)
    return scored.groupBy(digitize("l_quantity", AGE_EDGES).alias("bucket")).agg(N().alias("n"), r(F.avg("risk_score")).alias("avg_risk"))


# ------------------------------------------------------------------ default probability and losses
PD_SQL = """SELECT c_custkey, tier, CASE tier WHEN 'Low' THEN 0.01 WHEN 'Medium' THEN 0.05 WHEN 'High' THEN 0.15 ELSE 0.35 END::DOUBLE AS pd, greatest(c_acctbal, 0.0) AS ead
  FROM (SELECT *, CASE WHEN c_acctbal >= 7400 THEN 'Low' WHEN c_acctbal >= 6700 THEN 'Medium' WHEN c_acctbal >= 5800 THEN 'High' ELSE 'Very High' END AS tier FROM customer)"""
TRIALS = 1000


def exposures(t):
    tier = risk.four_tier(F.col("c_acctbal") / 10)
    rows = t.customer.select("c_custkey", tier.alias("tier"), F.greatest("c_acctbal", F.lit(0.0)).alias("ead"))
    return rows.withColumn("pd", risk.default_probability("tier"))


@query(f"SELECT c_custkey, tier, pd FROM ({PD_SQL})")
def risk_default_prob(t):
    return exposures(t).select("c_custkey", "tier", "pd")


LOSS_SQL = f"""WITH e AS ({PD_SQL}), h AS (SELECT pd, ead, b, md5(c_custkey || '|' || b || '|99') AS h FROM e, (SELECT unnest(range({TRIALS // 4})) AS b)),
  d AS (SELECT b * 4 + i AS trial, pd, ead, ('0x' || substr(h, 1 + 8 * i, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM h, (SELECT unnest([0, 1, 2, 3]) AS i)),
  l AS (SELECT trial, sum(CASE WHEN u < pd THEN ead * 0.6 ELSE 0 END) AS loss FROM d GROUP BY 1) """


@query(LOSS_SQL + "SELECT trial::INT AS trial, round(loss, 4) AS loss FROM l")
def risk_loss_trials(t):
    return risk.loss_trials(exposures(t), "c_custkey", "pd", "ead", TRIALS).select("trial", r("loss", 4).alias("loss"))


@query(LOSS_SQL + "SELECT count(*) AS n_trials, round(avg(loss), 4) AS expected_loss, round(quantile_cont(loss, 0.95), 4) AS var_95 FROM l")
def risk_el_var(t):
    losses = risk.loss_trials(exposures(t), "c_custkey", "pd", "ead", TRIALS)
    return risk.expected_loss_and_var(losses).select("n_trials", r("expected_loss", 4).alias("expected_loss"), r("var_95", 4).alias("var_95"))


# ------------------------------------------------------------------ loans
AMORT_SQL = """WITH n AS (SELECT s_suppkey, s_acctbal AS b, CASE WHEN 0.005 * s_acctbal < 40 THEN greatest(ceil(round(-ln(1 - 0.005 * s_acctbal / 40) / ln(1.005), 9)), 0)::INT END AS n FROM supplier)"""


@query(AMORT_SQL + """SELECT s_suppkey, n AS n_months, mth::INT AS month,
          CASE WHEN mth IS NOT NULL THEN round(greatest(b * pow(1.005, mth) - 40 * (pow(1.005, mth) - 1) / 0.005, 0), 4) END AS remaining,
          CASE WHEN n IS NULL THEN 'never' WHEN n = 0 THEN 'settled' ELSE 'paying' END AS status
          FROM (SELECT s_suppkey, b, n, unnest(CASE WHEN n > 0 THEN range(1, n + 1) ELSE [NULL] END) AS mth FROM n)""")
def risk_amortize(t):
    loans = t.supplier.select("s_suppkey", F.col("s_acctbal").alias("b"), F.lit(40.0).alias("pay"))
    return risk.payoff_schedule(loans, "b", 0.06, "pay").select("s_suppkey", "n_months", "month", r("remaining", 4).alias("remaining"), "status")


@query("""SELECT o_orderkey, round(CASE o_orderstatus WHEN 'F' THEN o_totalprice * 1.08 / 24 + 25.0 / 24 WHEN 'O' THEN o_totalprice * 0.08 / 24
          ELSE o_totalprice * 1.08 / 24 END, 8) AS payment, round((o_totalprice + o_totalprice * 5 / 100.0) / 12, 8) AS installment,
          greatest(floor(round(ln(500000 / o_totalprice) / ln(1.05), 9)) + 1, 0)::INT AS years_to_target FROM orders""")
def risk_payment(t):
    product = F.when(F.col("o_orderstatus") == "F", "personal").when(F.col("o_orderstatus") == "O", "mortgage").otherwise("standard")
    return t.orders.select(
        "o_orderkey", r(risk.payment_by_product(product, "o_totalprice", 0.08, F.lit(24)), 8).alias("payment"),
        r(risk.installment("o_totalprice", F.lit(5), F.lit(12)), 8).alias("installment"),
        risk.periods_to_target("o_totalprice", 0.05, F.lit(500000.0)).alias("years_to_target"),
    )


def models():
    return {
        "balance": risk.balance_model("balance"),
        "utilization": risk.utilization_model("kind", "balance", "credit_limit"),
    }


MATRIX_SQL = f"""WITH a AS (SELECT c_custkey, {KIND_SQL} AS kind, c_acctbal AS balance FROM customer),
  m AS (SELECT c_custkey, greatest(0.0, 100 - balance / 100) AS s1, CASE WHEN kind = 'Credit Card' THEN balance / 8000 * 100 ELSE 0.0 END AS s2 FROM a) """


@query(MATRIX_SQL + """SELECT c_custkey, 'balance' AS model, round(s1, 6) AS score, s1 >= s2 AS is_best FROM m
          UNION ALL SELECT c_custkey, 'utilization', round(s2, 6), s2 > s1 FROM m""")
def risk_model_matrix(t):
    rows = accounts(t)
    best = risk.best_model(rows, "c_custkey", models()).select("c_custkey", F.col("model").alias("best"))
    matrix = risk.model_matrix(rows, "c_custkey", models()).join(best, "c_custkey")
    return matrix.select("c_custkey", "model", r("score").alias("score"), (F.col("model") == F.col("best")).alias("is_best"))


@query("""SELECT d.doc_id, round(quality * 0.7::DOUBLE + n_chars / 1000.0::DOUBLE * 0.3::DOUBLE, 6) AS score
          FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def risk_safe_score(t):
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")
    score = risk.safe_score(["quality", "n_chars"], risk.weighted_model("quality", "n_chars"))
    return rows.select("doc_id", r(score).alias("score"))


@query("""WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
          SELECT user_id, CASE WHEN n - 60 <= 0 THEN 0.0::DOUBLE ELSE (n - 60) * 5.0::DOUBLE END AS standard_fee, CASE WHEN n - 60 <= 0 THEN 0.0::DOUBLE ELSE (n - 60) * 2.0::DOUBLE END AS premium_fee,
          CASE WHEN n > 65 THEN 'BLOCK' ELSE 'OK' END AS strict FROM c""")
def risk_late_fee(t):
    n = F.col("n")
    counts = t.events.groupBy("user_id").agg(N().alias("n"))
    return counts.select(
        "user_id", risk.late_fee(5)(n - 60).alias("standard_fee"), risk.late_fee(2)(n - 60).alias("premium_fee"), risk.velocity_check(65)(n).alias("strict")
    )
