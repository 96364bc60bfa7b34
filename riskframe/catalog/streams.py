"""Streaming jobs over the event files, and the Python extension surface."""

from pyspark.sql import functions as F

from riskframe.catalog.registry import N, query, r
from riskframe.catalog.statistics import FRAUD_SQL
from riskframe.functions import udfs as U
from riskframe.functions.recode import apply_batch, tiers
from riskframe.session import work_dir
from riskframe.streaming import monitors as M


def event_stream(t):
    events = M.read_parquet_stream(t.spark, t.sf_dir, "events.parquet")
    # watermarks need an instant, the files hold a wall-clock time
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def transaction_stream(t):
    return event_stream(t).select(
        "event_id", "ts", F.col("user_id").alias("customer"), (F.floor("value") * 100.0).alias("amount"),
        (F.col("event_type") == "error").alias("is_foreign"), (F.hour("ts") < 6).alias("is_night"),
    )


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS parsed FROM events WHERE value > 20")
def stream_filter(t):
    raw = event_stream(t).withColumn("raw", F.get_json_object("props", "$.k"))
    return M.drain_to_table(M.keep_parsable(raw, "raw", F.col("value") > 20).select("event_id", "parsed"))


@query("""SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events WHERE value > 50""")
def stream_flag_sequence(t):
    items = event_stream(t).select("user_id", "event_id", "ts", "value")
    out = M.flag_sequence(items, F.col("value") > 50, "user_id", ["ts", "event_id"], work_dir(t.spark, "sequence"))
    return out.select("user_id", "event_id", "seq")


@query("SELECT user_id, round(sum(value), 4) AS total, count(*) AS n FROM events GROUP BY 1")
def stream_running_total(t):
    out = M.drain_state_table(M.running_totals(event_stream(t), "user_id", "value"), ["user_id"])
    return out.withColumn("total", r("total", 4))


@query("""SELECT user_id, event_id, row_number() OVER w AS seq, round(sum(value) OVER (w ROWS UNBOUNDED PRECEDING), 4) AS running
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def stream_running_rows(t):
    items = event_stream(t).select("user_id", "event_id", "ts", "value")
    out = M.drain_to_table(M.running_rows(items, "user_id", ["ts", "event_id"], "value"))
    return out.select("user_id", "event_id", "seq", r("running", 4).alias("running"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def stream_batches(t):
    out = M.reduce_batches(event_stream(t), ["event_type"], {"n": (N(), F.sum), "total": (F.sum("value"), F.sum)})
    return out.withColumn("total", r("total", 4))


@query(FRAUD_SQL + "SELECT event_id, risk_score, action FROM d")
def stream_fraud_monitor(t):
    return M.drain_to_table(M.fraud_monitor(transaction_stream(t)).select("event_id", "risk_score", "action"))


@query(FRAUD_SQL + """SELECT customer, count(*) AS txn_count, round(sum(amount), 2) AS total_amount, max(risk_score) AS max_risk_score,
          sum((risk_score > 5)::INT)::BIGINT AS n_flagged FROM d GROUP BY 1""")
def stream_fraud_summary(t):
    out = M.drain_state_table(M.fraud_summary(transaction_stream(t)), ["customer"])
    return out.withColumn("total_amount", r("total_amount", 2))


@query("""SELECT strftime(ts, '%Y-%m') AS month, count(*) AS n, round(sum(value), 4) AS total, round(avg((event_type = 'error')::INT), 6) AS rate
          FROM events GROUP BY 1""")
def stream_monthly(t):
    days = M.windowed_volume(event_stream(t), "ts", "value", hit=F.col("event_type") == "error")
    out = M.monthly(M.drain_state_table(days, ["window_start"]))
    return out.select("month", "n", r("total", 4).alias("total"), r("rate").alias("rate"))


@query("SELECT event_id FROM events")
def stream_dedupe(t):
    doubled = event_stream(t).select("event_id", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    return M.drain_to_table(M.dedupe(doubled, "event_id", "ts", "30 days").select("event_id"))


# ------------------------------------------------------------------ Python functions
@query("SELECT p_partkey, CASE WHEN p_size + 20 < 35 THEN 'Young' WHEN p_size + 20 < 55 THEN 'Mid-Career' ELSE 'Senior' END AS grp, round(p_retailprice * 1.05, 6) AS marked_up FROM part")
def udf_scalar(t):
    markup = U.scalar(lambda s: s * 1.05)
    return t.part.select("p_partkey", U.age_band(F.col("p_size") + 20).alias("grp"), r(markup("p_retailprice")).alias("marked_up"))


@query("SELECT vec_id, round(list_max(embedding)::DOUBLE - list_min(embedding)::DOUBLE, 5) AS volatility FROM embeddings")
def udf_row_array(t):
    return t.embeddings.select("vec_id", r(U.row_volatility("embedding"), 5).alias("volatility"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_discount >= 0.07 THEN 'high' WHEN l_discount >= 0.03 THEN 'mid' ELSE 'low' END AS l_discount_band,
          CASE WHEN l_tax >= 0.07 THEN 'high' WHEN l_tax >= 0.03 THEN 'mid' ELSE 'low' END AS l_tax_band FROM lineitem""")
def udf_batch_fn(t):
    band = lambda c: tiers(c, [(0.07, "high"), (0.03, "mid")], "low")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *apply_batch(["l_discount", "l_tax"], band, "_band"))


@query("""SELECT c_mktsegment AS grp, count(*) AS n, round(avg(c_acctbal), 6) AS mean, round(stddev_samp(c_acctbal), 4) AS sd, min(c_acctbal) AS lo, max(c_acctbal) AS hi
          FROM customer GROUP BY 1""")
def udf_group(t):
    pairs = t.customer.select(F.col("c_mktsegment").alias("grp"), F.col("c_acctbal").alias("x"))
    partial = pairs.mapInPandas(U.batch_moments, U.MOMENTS_SCHEMA)
    merged = U.merge_moments(partial)
    return merged.select("grp", "n", r("mean").alias("mean"), r("sd", 4).alias("sd"), "lo", "hi")


@query("""SELECT o_custkey AS name, o_orderkey::INT AS score, 1 AS income, NULL AS error FROM orders WHERE false
          UNION ALL SELECT c_custkey, NULL, NULL, '2 fields instead of 3' FROM customer
          UNION ALL SELECT c_custkey, c_nationkey, c_custkey::INT, NULL FROM customer
          UNION ALL SELECT c_custkey, NULL, NULL, 'field 2 is not a number' FROM customer""")
def udtf_parse(t):
    text = F.format_string("%s,%d,%d;%s,5;%s,abc,9", "c_name", "c_nationkey", "c_custkey", "c_name", "c_name")
    parse = U.entry_parser({"name": "string", "score": "int", "income": "int"}, {"c_custkey": "long"})
    raw = t.customer.select("c_custkey", text.alias("raw"))
    return parse(raw.asTable()).select(F.col("c_custkey").alias("name"), "score", "income", "error")
