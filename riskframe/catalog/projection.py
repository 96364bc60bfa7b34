"""Projection, derived columns, renaming."""

from pyspark.sql import functions as F

from riskframe.catalog.registry import iso, query, r
from riskframe.functions import numbers as M
from riskframe.functions.recode import flag
from riskframe.operators import columns as C
from riskframe.operators.ordered import positions


@query("SELECT c_custkey, c_name FROM customer")
def proj_select(t):
    return t.customer.select("c_custkey", "c_name")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice / l_quantity, 9) AS unit_price,
          round((l_tax + l_discount) / l_quantity, 9) AS load, round(l_extendedprice / (l_linenumber + 1), 9) AS per_line
          FROM lineitem""")
def proj_ratio(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        r(M.ratio("l_extendedprice", "l_quantity"), 9).alias("unit_price"),
        r(M.ratio(F.col("l_tax") + F.col("l_discount"), "l_quantity"), 9).alias("load"),
        r(M.ratio("l_extendedprice", F.col("l_linenumber") + 1), 9).alias("per_line"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
          CASE WHEN l_discount = 0 THEN NULL ELSE round(l_tax / l_discount, 6) END AS or_null,
          CASE WHEN l_discount = 0 THEN 0.0::DOUBLE ELSE round(l_tax / l_discount, 6) END AS or_zero,
          CASE WHEN l_discount = 0 AND l_tax = 0 THEN '0' WHEN l_discount = 0 THEN 'inf' ELSE 'finite' END AS kind
          FROM lineitem""")
def proj_safe_divide(t):
    inf = M.ratio_or_inf("l_tax", "l_discount")
    zero_by_zero = (F.col("l_discount") == 0) & (inf == 0)
    kind = F.when(inf == float("inf"), "inf").when(zero_by_zero, "0").otherwise("finite")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        r(M.ratio("l_tax", "l_discount")).alias("or_null"),
        r(M.ratio_or("l_tax", "l_discount")).alias("or_zero"), kind.alias("kind"),
    )


@query("SELECT o_orderkey, round_even(o_totalprice / 100, 0) * 100 AS rounded FROM orders")
def proj_round_neg(t):
    return t.orders.select("o_orderkey", M.round_half_even("o_totalprice", -2).alias("rounded"))


@query("""SELECT o_orderkey, o_totalprice > 250000 AS is_large, o_orderstatus = 'F' AS is_closed,
          round(o_totalprice / 1000, 6) AS price_k FROM orders""")
def proj_assign(t):
    out = C.assign(
        t.orders, is_large=F.col("o_totalprice") > 250000, is_closed=F.col("o_orderstatus") == "F",
        price_k=r(F.col("o_totalprice") / 1000),
    )
    return out.select("o_orderkey", "is_large", "is_closed", "price_k")


@query("SELECT o_orderkey AS application_id, o_totalprice AS loan_amount, o_orderstatus AS loan_status FROM orders")
def proj_rename(t):
    names = {"o_orderkey": "application_id", "o_totalprice": "loan_amount", "o_orderstatus": "loan_status"}
    return C.rename(t.orders.select(*names), names)


@query("SELECT n_nationkey AS N_NATIONKEY, n_name AS N_NAME, n_regionkey AS N_REGIONKEY FROM nation")
def proj_rename_all(t):
    return C.rename_all(t.nation, str.upper)


@query("SELECT s_suppkey, s_acctbal FROM supplier")
def proj_drop(t):
    return t.supplier.drop("s_name", "s_nationkey")


@query("""SELECT o_orderkey, o_orderkey + o_custkey AS a_sum, o_orderkey - o_custkey AS a_diff,
          o_orderkey * o_custkey AS a_prod, floor((o_orderkey - 7000) / 7.0)::BIGINT AS a_floor,
          (((o_orderkey - 7000) % 7) + 7) % 7 AS a_mod, round(pow(o_custkey, 2), 2) AS a_pow FROM orders""")
def proj_arith(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return t.orders.select(
        k, (k + c).alias("a_sum"), (k - c).alias("a_diff"), (k * c).alias("a_prod"),
        M.floor_div(k - 7000, F.lit(7)).alias("a_floor"), M.floor_mod(k - 7000, F.lit(7)).alias("a_mod"),
        r(F.pow(c, F.lit(2)), 2).alias("a_pow"),
    )


@query("""SELECT c_custkey, round(c_acctbal * 5 / 100.0, 6) AS simple, round(c_acctbal * pow(1.05, 3), 6) AS compound,
          round(c_acctbal * 1.025, 6) AS with_fee FROM customer""")
def proj_interest(t):
    return t.customer.select(
        "c_custkey", r(M.simple_interest("c_acctbal", F.lit(5))).alias("simple"),
        r(M.compound_amount("c_acctbal", F.lit(0.05), F.lit(3))).alias("compound"),
        r(F.col("c_acctbal") * 1.025).alias("with_fee"),
    )


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS pos FROM orders")
def proj_reset_pos(t):
    return positions(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"]).select("o_orderkey", "pos")


@query("""SELECT vec_id, i::INT AS i, round(x::DOUBLE, 6) AS x FROM
          (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)""")
def proj_enumerate(t):
    cells = t.embeddings.select("vec_id", F.posexplode("embedding").alias("i", "x"))
    return cells.select("vec_id", "i", r(F.col("x").cast("double")).alias("x"))


@query("""SELECT c_custkey, least(greatest(c_acctbal, 0), 5000) AS clipped, greatest(c_acctbal, 500) AS floored FROM customer""")
def proj_clip(t):
    return t.customer.select(
        "c_custkey", M.clip("c_acctbal", 0.0, 5000.0).alias("clipped"), M.clip("c_acctbal", low=500.0).alias("floored")
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_discount = 0 AND l_tax = 0 THEN 0.0::DOUBLE
          WHEN l_discount = 0 THEN 1000000.0::DOUBLE ELSE round(l_tax / l_discount, 6) END AS cleaned FROM lineitem""")
def proj_nan_to_num(t):
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    raw = F.when((F.col("l_discount") == 0) & (F.col("l_tax") == 0), nan).when(F.col("l_discount") == 0, inf)
    raw = raw.otherwise(M.ratio("l_tax", "l_discount"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r(M.nan_to_num(raw)).alias("cleaned")
    )


@query("""SELECT o_orderkey, TRY_CAST(o_orderkey AS INTEGER) AS small,
          TRY_CAST(o_orderkey * 1000000 AS INTEGER) AS overflowed FROM orders""")
def proj_cast_narrow(t):
    return t.orders.select(
        "o_orderkey", M.narrow_int("o_orderkey").alias("small"),
        M.narrow_int(F.col("o_orderkey") * 1000000).alias("overflowed"),
    )


@query("""SELECT c_custkey, c_mktsegment || '=' || c_acctbal::VARCHAR AS pair, c_acctbal AS from_map FROM customer""")
def proj_zip_cols(t):
    pair = F.struct("c_mktsegment", "c_acctbal")
    zipped = F.map_from_entries(F.array(pair))
    return t.customer.select(
        "c_custkey",
        F.concat_ws("=", pair["c_mktsegment"], pair["c_acctbal"].cast("string")).alias("pair"),
        F.element_at(zipped, F.col("c_mktsegment")).alias("from_map"),
    )


@query("""SELECT event_id, round(value / 1000 + 2 * (event_type = 'error')::INT + (hour(ts) < 6)::INT, 6) AS score,
          round(value * 0.7 + event_id / 1000.0 * 0.3, 6) AS blend FROM events""")
def proj_weighted_score(t):
    night = flag(F.hour("ts") < 6)
    return t.events.select(
        "event_id",
        r(F.col("value") / 1000 + 2 * flag(F.col("event_type") == "error") + night).alias("score"),
        r(M.linear_score([(F.col("value"), 0.7), (F.col("event_id") / 1000.0, 0.3)])).alias("blend"),
    )
