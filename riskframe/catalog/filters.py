"""Filters and predicates."""

from functools import reduce

from pyspark.sql import functions as F

from riskframe.catalog.profiling import LABELLED, labelled_documents
from riskframe.catalog.registry import query, r
from riskframe.functions.recode import all_rules
from riskframe.operators import columns as C
from riskframe.operators.ordered import positions, previous_value

ORDER_COLS = ["o_orderkey", "o_custkey", "o_totalprice"]


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 77")
def filt_key_lookup(t):
    return t.orders.select(*ORDER_COLS).filter("o_orderkey = 77")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P'")
def filt_eq(t):
    return t.orders.filter("o_orderstatus = 'P'").select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def filt_threshold(t):
    return t.orders.select(*ORDER_COLS).filter("o_totalprice > 300000")


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
          WHERE (o_totalprice < 50000 AND o_orderstatus = 'F') OR NOT (o_orderpriority <> '1-URGENT')""")
def filt_and_or(t):
    cond = ((F.col("o_totalprice") < 50000) & (F.col("o_orderstatus") == "F")) | ~(F.col("o_orderpriority") != "1-URGENT")
    return t.orders.filter(cond).select(*ORDER_COLS)


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal BETWEEN 650 AND 2750")
def filt_between(t):
    return t.customer.filter(F.col("c_acctbal").between(650, 2750)).select("c_custkey", "c_acctbal")


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
          AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def filt_isin(t):
    watchlist = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    listed = t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return listed.join(watchlist, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query(f"SELECT doc_id, quality IS NULL AS missing FROM {LABELLED}")
def filt_is_null(t):
    return labelled_documents(t).select("doc_id", F.col("quality").isNull().alias("missing"))


@query("""SELECT doc_id, contains(text, 'the') AS has_the, starts_with(text, 'The') AS starts_the,
          ends_with(text, '.') AS ends_dot FROM documents""")
def filt_contains(t):
    c = F.col("text")
    return t.documents.select(
        "doc_id", c.contains("the").alias("has_the"), c.startswith("The").alias("starts_the"), c.endswith(".").alias("ends_dot")
    )


@query(f"SELECT doc_id, coalesce(toxic < 1, false) AND NOT (toxic IS NULL) AS clean FROM {LABELLED}")
def filt_null_safe_flag(t):
    never = F.col("toxic").isNull()
    return labelled_documents(t).select("doc_id", (F.coalesce(F.col("toxic") < 1, F.lit(False)) & ~never).alias("clean"))


@query("""SELECT pos FROM (SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, value FROM events)
          WHERE value > 100""")
def filt_positions(t):
    rows = positions(t.events.select("ts", "event_id", "value"), ["ts", "event_id"])
    return rows.filter("value > 100").select("pos")


@query("""SELECT slot::INT AS slot, p.event_id FROM
          (SELECT unnest([0, 3, 3, 17]) AS pos, unnest([0, 1, 2, 3]) AS slot) w
          JOIN (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events) p ON p.pos = w.pos""")
def filt_take_positions(t):
    return C.take_positions(t.events.select("ts", "event_id"), ["ts", "event_id"], [0, 3, 3, 17]).select("slot", "event_id")


@query("""SELECT vec_id, col::INT AS col, round(x::DOUBLE, 6) AS x FROM
          (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS col FROM embeddings)
          WHERE label IN (1, 3) AND col IN (0, 5, 9)""")
def filt_submatrix(t):
    rows = t.embeddings.filter(F.col("label").isin(1, 3))
    # only the wanted columns are ever expanded
    cells = F.array(*[F.struct(F.lit(c).alias("col"), F.get("embedding", F.lit(c)).alias("x")) for c in (0, 5, 9)])
    return rows.select("vec_id", F.inline(cells)).select("vec_id", "col", r(F.col("x").cast("double")).alias("x"))


@query("""SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events)
          WHERE pos % 4 = 0""")
def filt_step(t):
    return C.every_kth(t.events.select("ts", "event_id"), ["ts", "event_id"], 4).select("event_id")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount > 0.05 OR l_tax > 0.05 AS any_high,
          l_discount > 0.05 AND l_tax > 0.05 AS all_high FROM lineitem""")
def filt_any_all(t):
    high = [F.col(c) > 0.05 for c in ("l_discount", "l_tax")]
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        reduce(lambda a, b: a | b, high).alias("any_high"), F.forall(F.array(*high), lambda x: x).alias("all_high"),
    )


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 650 AND c_acctbal < 8000 AND c_nationkey > 3")
def filt_all_rules(t):
    rules = [F.col("c_acctbal") >= 650, F.col("c_acctbal") < 8000, F.col("c_nationkey") > 3]
    return t.customer.filter(all_rules(rules)).select("c_custkey", "c_acctbal")


@query("""(SELECT 'first_below' AS what, o_orderkey FROM orders WHERE o_totalprice < 2000 ORDER BY o_orderkey LIMIT 1)
          UNION ALL (SELECT 'first_increase', o_orderkey FROM
          (SELECT o_orderkey, o_totalprice, lag(o_totalprice) OVER (ORDER BY o_orderkey) AS p FROM orders)
          WHERE o_totalprice > p ORDER BY o_orderkey LIMIT 1)""")
def filt_first_match(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    below = rows.filter("o_totalprice < 2000").orderBy("o_orderkey").limit(1)
    rising = previous_value(rows, "o_totalprice", ["o_orderkey"], name="p").filter("o_totalprice > p")
    rising = rising.orderBy("o_orderkey").limit(1)
    return below.select(F.lit("first_below").alias("what"), "o_orderkey").unionByName(
        rising.select(F.lit("first_increase").alias("what"), "o_orderkey")
    )


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)")
def filt_above_mean(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return rows.filter(F.col("o_totalprice") > rows.agg(F.avg("o_totalprice")).scalar())
