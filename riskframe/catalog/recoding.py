"""Conditional mapping, recoding, binning."""

import math

from pyspark.sql import functions as F

from riskframe.catalog.profiling import LABELLED, labelled_documents
from riskframe.catalog.registry import N, query, r
from riskframe.functions import bins as B
from riskframe.functions import recode as R
from riskframe.operators import stats as S

def bal():
    return F.col("c_acctbal")


SEGMENT_CODES = {"BUILDING": 0, "AUTOMOBILE": 1, "MACHINERY": 2}
SEGMENT_CASE = "CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'AUTOMOBILE' THEN 1 WHEN 'MACHINERY' THEN 2 END"
STATUS_SHORT = {"F": "Finished", "O": "Open"}
EDGES = [0, 1000, 2500, 5000, 7500]


@query(f"SELECT doc_id, CASE WHEN quality < 1 THEN 1 ELSE 0 END AS low_quality FROM {LABELLED}")
def cond_flag(t):
    return labelled_documents(t).select("doc_id", R.flag(F.col("quality") < 1).alias("low_quality"))


@query("SELECT event_id, CASE WHEN value > 50 THEN 'FLAG' ELSE 'OK' END AS label FROM events")
def cond_label(t):
    return t.events.select("event_id", R.choose(F.col("value") > 50, "FLAG", "OK").alias("label"))


@query("SELECT c_custkey, CASE WHEN c_acctbal >= 6700 THEN 0 WHEN c_acctbal >= 5800 THEN 1 ELSE 2 END AS risk_level FROM customer")
def cond_nested(t):
    return t.customer.select("c_custkey", F.when(bal() >= 6700, 0).otherwise(F.when(bal() >= 5800, 1).otherwise(2)).alias("risk_level"))


@query("SELECT c_custkey, CASE WHEN c_acctbal >= 7000 THEN 'Prime' WHEN c_acctbal >= 6200 THEN 'Near-Prime' ELSE 'Subprime' END AS risk_tier FROM customer")
def cond_select(t):
    return t.customer.select("c_custkey", R.tiers("c_acctbal", [(7000, "Prime"), (6200, "Near-Prime")], "Subprime").alias("risk_tier"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
          CASE WHEN l_discount > 0.04 AND l_quantity < 10 THEN 1 ELSE 0 END AS flag FROM lineitem""")
def cond_multi_flag(t):
    cond = (F.col("l_discount") > 0.04) & (F.col("l_quantity") < 10)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", R.flag(cond).alias("flag"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'Declined' WHEN c_acctbal >= 7000 AND c_nationkey >= 5 THEN 'Approved'
          WHEN c_acctbal >= 6500 AND c_nationkey <= 15 THEN 'Approved with conditions' ELSE 'Review Needed' END AS decision FROM customer""")
def cond_decision_chain(t):
    nation = F.col("c_nationkey")
    rules = [
        (bal() < 0, "Declined"), ((bal() >= 7000) & (nation >= 5), "Approved"),
        ((bal() >= 6500) & (nation <= 15), "Approved with conditions"),
    ]
    return t.customer.select("c_custkey", R.first_match(rules, "Review Needed").alias("decision"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'Has prior defaults' WHEN c_acctbal < 650 THEN 'Score too low'
          ELSE 'Approved' END AS outcome FROM customer""")
def cond_rule_list(t):
    rules = [F.when(bal() < 0, "Has prior defaults"), F.when(bal() < 650, "Score too low")]
    return t.customer.select("c_custkey", R.first_rule(rules, "Approved").alias("outcome"))


@query("SELECT event_id, (value > 50)::INT + (event_type = 'error')::INT + (hour(ts) < 6)::INT AS n_checks FROM events")
def cond_rule_count(t):
    checks = [F.col("value") > 50, F.col("event_type") == "error", F.hour("ts") < 6]
    return t.events.select("event_id", R.rules_passed(checks).alias("n_checks"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
          round(CASE WHEN l_returnflag = 'A' THEN (l_discount + l_tax) / 2 ELSE l_discount END, 6) AS effective FROM lineitem""")
def cond_effective(t):
    eff = F.when(F.col("l_returnflag") == "A", (F.col("l_discount") + F.col("l_tax")) / 2).otherwise(F.col("l_discount"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r(eff).alias("effective"))


@query(f"SELECT c_custkey, {SEGMENT_CASE} AS code FROM customer")
def map_dict(t):
    return t.customer.select("c_custkey", R.lookup("c_mktsegment", SEGMENT_CODES).alias("code"))


@query(f"SELECT c_custkey, coalesce({SEGMENT_CASE}, -1) AS code FROM customer")
def map_dict_default(t):
    return t.customer.select("c_custkey", R.lookup_or("c_mktsegment", SEGMENT_CODES, -1).alias("code"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS status FROM orders")
def map_replace(t):
    return t.orders.select("o_orderkey", R.replace_values("o_orderstatus", STATUS_SHORT).alias("status"))


@query("SELECT p_partkey, CASE WHEN p_size + 20 < 35 THEN 'Young' WHEN p_size + 20 < 55 THEN 'Mid-Career' ELSE 'Senior' END AS grp FROM part")
def map_func(t):
    age = F.col("p_size") + 20
    return t.part.select("p_partkey", R.first_match([(age < 35, "Young"), (age < 55, "Mid-Career")], "Senior").alias("grp"))


@query("""SELECT conv_id, turn, coalesce(nullif(trim(regexp_extract(text, '[0-9]+')), ''), 'N/A') AS number FROM conversations""")
def map_default_text(t):
    return t.conversations.select("conv_id", "turn", R.text_or(F.regexp_extract("text", "[0-9]+", 0), "N/A").alias("number"))


@query("SELECT c_custkey, " + " + ".join(f"(c_acctbal >= {e})::INT" for e in EDGES) + " AS bucket FROM customer")
def bin_digitize(t):
    return t.customer.select("c_custkey", B.digitize("c_acctbal", EDGES).alias("bucket"))


@query("SELECT p_partkey, " + " + ".join(f"(p_size > {e})::INT" for e in (10, 20, 30, 40)) + " AS bucket FROM part")
def bin_searchsorted(t):
    return t.part.select("p_partkey", B.search_sorted("p_size", [10, 20, 30, 40]).alias("bucket"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal > 0 AND c_acctbal <= 4000 THEN '<4k' WHEN c_acctbal > 4000 AND c_acctbal <= 7000 THEN '4k-7k'
          WHEN c_acctbal > 7000 THEN '7k+' END AS bracket FROM customer""")
def bin_cut(t):
    return t.customer.select("c_custkey", B.cut("c_acctbal", [0, 4000, 7000, math.inf], ["<4k", "4k-7k", "7k+"]).alias("bracket"))


@query("""WITH s AS (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS w FROM events),
          c AS (SELECT least(floor((value - lo) / w), 29)::INT AS bin, count(*) AS cnt FROM events, s GROUP BY 1)
          SELECT g.bin::INT AS bin, round(lo + g.bin * w, 6) AS low, round(lo + (g.bin + 1) * w, 6) AS high, coalesce(cnt, 0) AS cnt
          FROM (SELECT unnest(range(30)) AS bin) g CROSS JOIN s LEFT JOIN c ON c.bin = g.bin""")
def bin_hist_fixed(t):
    return S.histogram(t.events, "value", 30).select("bin", r("low").alias("low"), r("high").alias("high"), "cnt")


@query("""WITH c AS (SELECT least(floor((c_acctbal + 1000) / 500), 21)::INT AS bin, count(*) AS cnt FROM customer
          WHERE c_acctbal BETWEEN -1000 AND 10000 GROUP BY 1)
          SELECT g.bin::INT AS bin, (-1000.0 + g.bin * 500.0)::DOUBLE AS low, coalesce(cnt, 0) AS cnt
          FROM (SELECT unnest(range(22)) AS bin) g LEFT JOIN c ON c.bin = g.bin""")
def bin_hist_edges(t):
    return S.histogram(t.customer, "c_acctbal", 22, -1000, 500).select("bin", r("low").alias("low"), "cnt")


@query("""WITH x AS (SELECT 'log10' AS scale, log10(value + 1) AS x FROM events WHERE value > -1
                     UNION ALL SELECT 'log1p', ln(1 + value) FROM events WHERE value > -1),
          s AS (SELECT scale, min(x) AS lo, (max(x) - min(x)) / 10 AS w FROM x GROUP BY 1)
          SELECT scale, g.bin::INT AS bin, round(lo + g.bin * w, 6) AS low, coalesce(cnt, 0) AS cnt
          FROM s CROSS JOIN (SELECT unnest(range(10)) AS bin) g
          LEFT JOIN (SELECT scale, least(floor((x - lo) / w), 9)::INT AS bin, count(*) AS cnt FROM x JOIN s USING (scale) GROUP BY 1, 2) c USING (scale, bin)""")
def bin_hist_log(t):
    rows = t.events.filter("value > -1")
    logs = {"log10": F.log10(F.col("value") + 1), "log1p": F.log1p("value")}
    parts = [
        S.histogram(rows.select(x.alias("x")), "x", 10).select(F.lit(scale).alias("scale"), "bin", r("low").alias("low"), "cnt")
        for scale, x in logs.items()
    ]
    return parts[0].unionByName(parts[1])


@query("""WITH s AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 50 AS w FROM events),
          c AS (SELECT event_type, least(floor((value - lo) / w), 49)::INT AS bin, any_value(w) AS w, count(*) AS cnt FROM events, s GROUP BY 1, 2)
          SELECT event_type, bin, cnt, round(cnt * 100.0 / sum(cnt) OVER (PARTITION BY event_type), 6) AS pct,
          round(cnt / w / sum(cnt) OVER (PARTITION BY event_type), 8) AS density FROM c""")
def bin_hist_norm(t):
    return S.histogram_by(t.events, "value", "event_type", 50).select(
        "event_type", "bin", "cnt", r("pct").alias("pct"), r("density", 8).alias("density")
    )


@query("""WITH s AS (SELECT min(l_quantity) AS xl, (max(l_quantity) - min(l_quantity)) / 10 AS xw,
                            min(l_extendedprice) AS yl, (max(l_extendedprice) - min(l_extendedprice)) / 20 AS yw FROM lineitem)
          SELECT least(floor((l_quantity - xl) / xw), 9)::INT AS x_bin, least(floor((l_extendedprice - yl) / yw), 19)::INT AS y_bin,
          count(*) AS cnt FROM lineitem, s GROUP BY 1, 2""")
def bin_hist_2d(t):
    return S.histogram_2d(t.lineitem, "l_quantity", "l_extendedprice", 10, 20)
