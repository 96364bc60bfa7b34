"""Aggregation and grouping."""

from pyspark.sql import functions as F

from riskframe.catalog.profiling import LABELLED, labelled_documents
from riskframe.catalog.quality import gappy_customers
from riskframe.catalog.registry import N, query, r
from riskframe.functions.recode import tiers
from riskframe.functions.temporal import month_key
from riskframe.operators import aggregate as A
from riskframe.operators import sketches as K
from riskframe.operators.missing import fill_median
from riskframe.operators.quantiles import EXCLUSIVE, exact_quantiles
from riskframe.plans import risk
from riskframe.session import materialize

P = "o_totalprice"


@query("""SELECT round(avg(o_totalprice), 6) AS mean, round(quantile_cont(o_totalprice, 0.5), 6) AS median,
          round(sum(o_totalprice), 2) AS total, round(stddev_samp(o_totalprice), 4) AS std, min(o_totalprice) AS lo,
          max(o_totalprice) AS hi, round(max(o_totalprice) - min(o_totalprice), 6) AS rng FROM orders""")
def agg_global(t):
    med = exact_quantiles(t.orders, "o_totalprice", {"m": 0.5}).select("m").scalar()
    return t.orders.agg(
        r(F.avg(P)).alias("mean"), r(F.sum(P), 2).alias("total"), r(F.stddev_samp(P), 4).alias("std"),
        F.min(P).alias("lo"), F.max(P).alias("hi"), r(F.max(P) - F.min(P)).alias("rng"),
    ).withColumn("median", r(med))


@query("SELECT c_mktsegment, round(stddev_pop(c_acctbal), 6) AS std_pop FROM customer GROUP BY 1")
def agg_std_pop(t):
    return t.customer.groupBy("c_mktsegment").agg(r(F.stddev_pop("c_acctbal")).alias("std_pop"))


@query("SELECT event_type, round(var_samp(value), 6) AS variance FROM events GROUP BY 1")
def agg_variance(t):
    return t.events.groupBy("event_type").agg(r(F.var_samp("value")).alias("variance"))


@query("SELECT o_orderpriority, round(avg((o_orderstatus = 'F')::INT), 6) AS finished_rate FROM orders GROUP BY 1")
def agg_rate(t):
    return t.orders.groupBy("o_orderpriority").agg(r(A.rate(F.col("o_orderstatus") == "F")).alias("finished_rate"))


@query("""SELECT count(*) FILTER (WHERE c_acctbal >= 7000) AS n_high, round(sum(c_acctbal) FILTER (WHERE c_acctbal >= 7000), 2) AS sum_high,
          round(avg(c_acctbal) FILTER (WHERE c_mktsegment = 'BUILDING'), 6) AS avg_building,
          round(sum(abs(c_acctbal)) FILTER (WHERE c_acctbal < 0), 2) AS debt FROM customer""")
def agg_filtered(t):
    b = F.col("c_acctbal")
    return t.customer.agg(
        F.count_if(b >= 7000).alias("n_high"), r(F.sum(F.when(b >= 7000, b)), 2).alias("sum_high"),
        r(F.avg(F.when(F.col("c_mktsegment") == "BUILDING", b))).alias("avg_building"),
        r(F.sum(F.when(b < 0, F.abs(b))), 2).alias("debt"),
    )


@query("SELECT o_orderstatus, round(avg(o_totalprice), 6) AS avg_price FROM orders GROUP BY 1")
def agg_group_one(t):
    return A.group_by(t.orders, ["o_orderstatus"], r(F.avg(P)).alias("avg_price"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def agg_group_size(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(N().alias("n"))


@query(f"SELECT lang, count(*) AS n_rows, count(quality) AS n_labelled, round(sum(n_chars)::DOUBLE, 2) AS chars FROM {LABELLED} GROUP BY 1")
def agg_group_count_col(t):
    return labelled_documents(t).groupBy("lang").agg(
        N().alias("n_rows"), F.count("quality").alias("n_labelled"), r(F.sum("n_chars").cast("double"), 2).alias("chars")
    )


@query("SELECT c_mktsegment, round(avg(c_acctbal), 6) AS avg_bal FROM customer GROUP BY 1 ORDER BY 2 DESC")
def agg_group_sorted(t):
    return t.customer.groupBy("c_mktsegment").agg(r(F.avg("c_acctbal")).alias("avg_bal")).orderBy(F.desc("avg_bal"))


@query("SELECT o_orderstatus, o_orderpriority, round(avg(o_totalprice), 6) AS avg_price FROM orders GROUP BY 1, 2")
def agg_group_multi_key(t):
    return A.group_by(t.orders, ["o_orderstatus", "o_orderpriority"], r(F.avg(P)).alias("avg_price"))


@query("""SELECT l_returnflag, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, round(avg(l_extendedprice), 6) AS mean
          FROM lineitem GROUP BY 1""")
def agg_group_multi_fn(t):
    c = "l_extendedprice"
    return t.lineitem.groupBy("l_returnflag").agg(F.min(c).alias("lo"), F.max(c).alias("hi"), r(F.avg(c)).alias("mean"))


def tiered_customers(t):
    """Customers with a risk tier; missing (negative) balances get the median first."""
    filled = fill_median(gappy_customers(t), "bal")
    tier = tiers("bal", [(7000, "Prime"), (6200, "Near-Prime")], "Subprime")
    return filled.select(F.col("c_custkey").alias("o_custkey"), "bal", tier.alias("risk_tier"))


NAMED_SQL = """WITH g AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS b FROM customer),
  f AS (SELECT c_custkey, coalesce(b, (SELECT quantile_cont(b, 0.5) FROM g)) AS b FROM g),
  tt AS (SELECT c_custkey, b, CASE WHEN b >= 7000 THEN 'Prime' WHEN b >= 6200 THEN 'Near-Prime' ELSE 'Subprime' END AS risk_tier FROM f)
  SELECT risk_tier, min(o_totalprice) AS min_loan, max(o_totalprice) AS max_loan, round(avg(o_totalprice), 6) AS avg_loan,
  round(avg(b), 6) AS avg_score, count(*) AS n FROM orders JOIN tt ON o_custkey = c_custkey GROUP BY 1"""


@query(NAMED_SQL)
def agg_named(t):
    # orders are reduced per customer before they meet the tiers: a customer with a third of the
    # orders is one row in the join
    per_customer = t.orders.groupBy("o_custkey").agg(
        F.min(P).alias("lo"), F.max(P).alias("hi"), F.sum(P).alias("s"), N().alias("n")
    )
    return A.group_by(
        per_customer.join(tiered_customers(t), "o_custkey"), ["risk_tier"],
        F.min("lo").alias("min_loan"), F.max("hi").alias("max_loan"), r(F.sum("s") / F.sum("n")).alias("avg_loan"),
        r(A.weighted_mean("bal", "n")).alias("avg_score"), F.sum("n").alias("n"),
    )


@query("""SELECT r_name, count(*) AS n, sum((c_acctbal >= 6500)::INT)::BIGINT AS approved, round(sum(c_acctbal), 2) AS total,
          round(avg(c_acctbal), 1) AS avg_bal FROM customer JOIN nation ON c_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def agg_region_summary(t):
    # reduce to nations before the lookup joins: 25 rows travel instead of the customers
    by_nation = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        N().alias("n"), F.count_if(F.col("c_acctbal") >= 6500).alias("approved"), F.sum("c_acctbal").alias("total")
    )
    named = by_nation.join(t.nation, "n_nationkey").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return named.groupBy("r_name").agg(
        F.sum("n").alias("n"), F.sum("approved").alias("approved"), r(F.sum("total"), 2).alias("total"),
        r(F.sum("total") / F.sum("n"), 1).alias("avg_bal"),
    )


@query("SELECT user_id, count(*) AS txn_count, round(sum(value), 2) AS total_amount, max(value) AS max_value FROM events GROUP BY 1")
def agg_customer_summary(t):
    return t.events.groupBy("user_id").agg(
        N().alias("txn_count"), r(F.sum("value"), 2).alias("total_amount"), F.max("value").alias("max_value")
    )


@query("""SELECT user_id, count(*) AS txn_count FROM events GROUP BY 1
          HAVING count(*) >= 3 AND user_id IN (SELECT user_id FROM events WHERE value > 200)""")
def agg_having(t):
    # the flag rides on the aggregate, so the table is read and shuffled once
    out = t.events.groupBy("user_id").agg(N().alias("txn_count"), F.count_if(F.col("value") > 200).alias("n_flagged"))
    return out.filter((F.col("txn_count") >= 3) & (F.col("n_flagged") > 0)).drop("n_flagged")


@query("""SELECT o_custkey, total, rank() OVER (ORDER BY total DESC) AS rnk FROM
          (SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) ORDER BY total DESC, o_custkey LIMIT 100""")
def agg_sum_by_key(t):
    totals = t.orders.groupBy("o_custkey").agg(r(F.sum(P), 2).alias("total"))
    top = totals.orderBy(F.desc("total"), "o_custkey").limit(100)
    from pyspark.sql import Window

    return top.withColumn("rnk", F.rank().over(Window.orderBy(F.desc("total"))).cast("long"))


@query("""SELECT l_suppkey, chunk, string_agg(k::VARCHAR, ',' ORDER BY rn) AS members FROM
          (SELECT l_suppkey, l_orderkey AS k, rn, rn // 100 AS chunk FROM (SELECT l_suppkey, l_orderkey,
           row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_partkey, l_linenumber) - 1 AS rn FROM lineitem))
          GROUP BY 1, 2""")
def agg_collect(t):
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_partkey", "l_linenumber")
    out = A.collect_chunks(rows, ["l_suppkey"], "l_orderkey", ["l_orderkey", "l_partkey", "l_linenumber"], 100)
    return out.select("l_suppkey", "chunk", F.array_join(F.col("members").cast("array<string>"), ",").alias("members"))


MODE_SQL = """SELECT p_type, p_brand, cnt FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY cnt {0}, seen) AS rn FROM
  (SELECT p_type, p_brand, count(*) AS cnt, min(p_partkey) AS seen FROM part GROUP BY 1, 2)) WHERE rn = 1"""


@query(MODE_SQL.format("DESC"))
def agg_mode(t):
    return A.most_common(t.part, "p_brand", "p_partkey", ["p_type"])


@query(MODE_SQL.format("ASC"))
def agg_least_common(t):
    return A.least_common(t.part, "p_brand", "p_partkey", ["p_type"])


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM (SELECT *, row_number() OVER
          (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def agg_argmax(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return A.arg_extreme(rows, "o_totalprice", "o_orderkey", ["o_orderstatus"])


@query("SELECT event_type, min(value) FILTER (WHERE value > 100) AS min_above FROM events GROUP BY 1")
def agg_min_above(t):
    return t.events.groupBy("event_type").agg(F.min(F.when(F.col("value") > 100, F.col("value"))).alias("min_above"))


@query("SELECT l_returnflag, round(sum(l_discount * l_extendedprice) / sum(l_extendedprice), 8) AS weighted FROM lineitem GROUP BY 1")
def agg_weighted_mean(t):
    return t.lineitem.groupBy("l_returnflag").agg(r(A.weighted_mean("l_discount", "l_extendedprice"), 8).alias("weighted"))


@query("""SELECT event_type, count(*) AS n, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.75), 6) AS q3,
          round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1""")
def agg_percentile(t):
    q = exact_quantiles(t.events, "value", {"q1": 0.25, "q3": 0.75, "p95": 0.95}, ["event_type"])
    return q.select("event_type", "n", r("q1").alias("q1"), r("q3").alias("q3"), r("p95").alias("p95"))


@query("""SELECT event_type, count(*) AS n, count(DISTINCT CAST(ts AS DATE)) AS parts, true AS q1_close, true AS q3_close, true AS p95_close
          FROM events GROUP BY 1""")
def agg_percentile_sketch(t):
    # one sketch per type and day is stored; quantiles of all days come from the sketches alone
    daily = materialize(K.quantile_sketches(t.events.withColumn("day", F.to_date("ts")), "value", ["event_type", "day"]), "daily-values")
    wanted = {"q1": 0.25, "q3": 0.75, "p95": 0.95}
    found = materialize(K.merged_quantiles(daily, wanted, ["event_type"]), "merged-values")
    out = found.select("event_type", "n", "parts")
    for name, p in wanted.items():
        # twice the bound of 99 % confidence
        close = K.within_rank(p, 2 * K.rank_error()).alias(f"{name}_close")
        out = out.join(K.rank_bounds(t.events, "value", found, name, ["event_type"]).select("event_type", close), "event_type")
    return out


def exclusive_sql(p):
    lo = f"least(greatest(floor({p} * (n + 1) - 1), 0), n - 2)"
    return f"round(max(v) FILTER (WHERE i = {lo}) + (max(v) FILTER (WHERE i = {lo} + 1) - max(v) FILTER (WHERE i = {lo})) * (max({p} * (n + 1) - 1 - {lo})), 6)"


@query(f"""SELECT seg, max(n) AS n, {exclusive_sql(0.25)} AS q1, {exclusive_sql(0.5)} AS q2, {exclusive_sql(0.75)} AS q3 FROM
          (SELECT c_mktsegment AS seg, c_acctbal AS v, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal) - 1 AS i,
           count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer) GROUP BY 1""")
def agg_quantiles_exclusive(t):
    q = exact_quantiles(
        t.customer.withColumnRenamed("c_mktsegment", "seg"), "c_acctbal", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, ["seg"], EXCLUSIVE
    )
    return q.select("seg", "n", r("q1").alias("q1"), r("q2").alias("q2"), r("q3").alias("q3"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_discount + l_tax + l_quantity, 6) AS total,
          round((l_discount + l_tax + l_quantity) / 3, 6) AS mean FROM lineitem""")
def agg_rows_total(t):
    total = F.col("l_discount") + F.col("l_tax") + F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r(total).alias("total"), r(total / 3).alias("mean"))


@query("""SELECT round(avg(l_quantity), 6) AS quantity, round(avg(l_extendedprice), 6) AS price, round(avg(l_discount), 6) AS discount,
          max(l_tax) AS max_tax FROM lineitem""")
def agg_cols_mean(t):
    return t.lineitem.agg(
        r(F.avg("l_quantity")).alias("quantity"), r(F.avg("l_extendedprice")).alias("price"),
        r(F.avg("l_discount")).alias("discount"), F.max("l_tax").alias("max_tax"),
    )


@query("SELECT vec_id, round((list_max(embedding) - list_min(embedding))::DOUBLE, 5) AS volatility FROM embeddings")
def agg_row_range(t):
    from riskframe.functions.arrays import value_range

    return t.embeddings.select("vec_id", r(value_range("embedding").cast("double"), 5).alias("volatility"))


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS volume, round(avg((o_orderstatus = 'F')::INT), 6) AS rate,
          round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def agg_period(t):
    return t.orders.groupBy(month_key("o_orderdate").alias("month")).agg(
        N().alias("volume"), r(A.rate(F.col("o_orderstatus") == "F")).alias("rate"), r(F.sum(P), 2).alias("total")
    )


KIND_SQL = "CASE c_mktsegment WHEN 'BUILDING' THEN 'Checking Account' WHEN 'AUTOMOBILE' THEN 'Credit Card' ELSE 'Savings Account' END"


def accounts(t):
    """Customers as accounts: kind from the segment, a credit limit of 8000."""
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "Checking Account").when(F.col("c_mktsegment") == "AUTOMOBILE", "Credit Card")
    return t.customer.select(
        "c_custkey", "c_nationkey", F.col("c_acctbal").alias("balance"), kind.otherwise("Savings Account").alias("kind"),
        F.lit(8000.0).alias("credit_limit"),
    )


@query(f"""SELECT kind, count(*) AS n, round(sum(balance), 2) AS total_balance, sum(fee)::BIGINT AS total_fees FROM
          (SELECT kind, balance, CASE WHEN kind = 'Checking Account' AND balance < 500 THEN 5
           WHEN kind = 'Credit Card' AND balance / 8000 > 0.9 THEN 15 ELSE 0 END AS fee
           FROM (SELECT {KIND_SQL} AS kind, c_acctbal AS balance FROM customer)) GROUP BY 1""")
def agg_portfolio(t):
    fee = risk.monthly_fee("kind", "balance", "credit_limit")
    return accounts(t).withColumn("fee", fee).groupBy("kind").agg(
        N().alias("n"), r(F.sum("balance"), 2).alias("total_balance"), F.sum("fee").alias("total_fees")
    )


@query("""SELECT c_mktsegment, round(avg(c_acctbal), 6) AS mean, round(stddev_samp(c_acctbal), 6) AS sd,
          round(avg(c_acctbal) - stddev_samp(c_acctbal), 6) AS low, round(avg(c_acctbal) + stddev_samp(c_acctbal), 6) AS high,
          round(quantile_cont(c_acctbal, 0.5), 6) AS med FROM customer GROUP BY 1""")
def agg_error_band(t):
    mean, sd = F.avg("c_acctbal"), F.stddev_samp("c_acctbal")
    bands = t.customer.groupBy("c_mktsegment").agg(
        r(mean).alias("mean"), r(sd).alias("sd"), r(mean - sd).alias("low"), r(mean + sd).alias("high")
    )
    med = exact_quantiles(t.customer, "c_acctbal", {"med": 0.5}, ["c_mktsegment"])
    return bands.join(med.select("c_mktsegment", r("med").alias("med")), "c_mktsegment")


@query(f"""WITH reps AS (SELECT c_mktsegment, c_acctbal AS v, rep, ('0x' || substr(md5(c_custkey || '|' || rep || '|11'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
          FROM customer, (SELECT unnest(range(1000)) AS rep)),
          w AS (SELECT *, {' + '.join(f"(u >= {b!r}::DOUBLE)::INT" for b in A.POISSON_1)} AS w FROM reps),
          m AS (SELECT c_mktsegment, rep, sum(v * w) / sum(w) AS m FROM w GROUP BY 1, 2)
          SELECT c_mktsegment, round(quantile_cont(m, 0.025), 4) AS ci_low, round(quantile_cont(m, 0.975), 4) AS ci_high FROM m GROUP BY 1""")
def agg_error_ci(t):
    ci = A.bootstrap_ci(t.customer, "c_custkey", "c_acctbal", ["c_mktsegment"])
    return ci.select("c_mktsegment", r("ci_low", 4).alias("ci_low"), r("ci_high", 4).alias("ci_high"))


@query("""SELECT count(*) AS n, round(avg(c_acctbal), 1) AS avg_balance, sum((c_acctbal / 8000 > 0.7)::INT)::BIGINT AS n_high,
          round(sum(c_acctbal), 2) AS exposure, (SELECT c_mktsegment FROM customer GROUP BY 1 ORDER BY avg(c_acctbal) DESC LIMIT 1) AS best_segment
          FROM customer""")
def agg_report(t):
    by_segment = t.customer.groupBy("c_mktsegment").agg(
        N().alias("n"), F.sum("c_acctbal").alias("s"), F.count_if(F.col("c_acctbal") / 8000 > 0.7).alias("h")
    )
    return by_segment.agg(
        F.sum("n").alias("n"), r(F.sum("s") / F.sum("n"), 1).alias("avg_balance"), F.sum("h").alias("n_high"),
        r(F.sum("s"), 2).alias("exposure"), F.max_by("c_mktsegment", F.col("s") / F.col("n")).alias("best_segment"),
    )
