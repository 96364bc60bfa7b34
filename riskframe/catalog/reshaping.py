"""Pivot, cross-tab, reshape."""

from pyspark.sql import functions as F

from riskframe.catalog.registry import N, query, r
from riskframe.operators import columns as C
from riskframe.operators import reshape as R
from riskframe.operators.ordered import positions
from riskframe.operators.stats import correlation_matrix
from riskframe.session import materialize

STATUS = ["F", "O", "P"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def cells(expr, as_fmt, levels=STATUS, col="o_orderstatus"):
    return ", ".join(f"{expr.format(f'{col} = {chr(39)}{s}{chr(39)}')} AS {as_fmt.format(s)}" for s in levels)


def rounded(df, key, cols, digits=6):
    return df.select(key, *[r(c, digits).alias(c) for c in cols])


@query("SELECT o_orderpriority, " + cells("round(avg(o_totalprice) FILTER (WHERE {}), 6)", '"{}"') + " FROM orders GROUP BY 1")
def piv_mean(t):
    return rounded(R.pivot(t.orders, "o_orderpriority", "o_orderstatus", None, F.avg("o_totalprice")), "o_orderpriority", STATUS)


@query("SELECT o_orderpriority, " + cells("count(o_orderkey) FILTER (WHERE {})", '"{}"') + " FROM orders GROUP BY 1")
def piv_count(t):
    return R.pivot(t.orders, "o_orderpriority", "o_orderstatus", None, F.count("o_orderkey"), fill=0)


@query("SELECT coalesce(o_orderpriority, 'All') AS o_orderpriority, " + cells("round(avg(o_totalprice) FILTER (WHERE {}), 6)", '"{}"')
       + ', round(avg(o_totalprice), 6) AS "All" FROM orders GROUP BY GROUPING SETS ((orders.o_orderpriority), ())')
def piv_margins(t):
    out = R.pivot_margins(t.orders, "o_orderpriority", "o_orderstatus", None, F.avg("o_totalprice"))
    return rounded(out, "o_orderpriority", [*STATUS, "All"])


@query("SELECT o_orderpriority, " + cells("round(avg(o_totalprice) FILTER (WHERE {}), 6)", '"{}_price"') + ", "
       + cells("round(avg(o_custkey) FILTER (WHERE {}), 6)", '"{}_cust"') + " FROM orders GROUP BY 1")
def piv_multi_values(t):
    out = R.pivot(t.orders, "o_orderpriority", "o_orderstatus", None, F.avg("o_totalprice").alias("price"), F.avg("o_custkey").alias("cust"))
    return rounded(out, "o_orderpriority", [f"{s}_{v}" for s in STATUS for v in ("price", "cust")])


@query("SELECT p_brand || '/' || p_size AS line, " + cells("coalesce(round(avg(p_retailprice) FILTER (WHERE {}), 6), 0)", '"{}"', TYPES, "p_type")
       + " FROM part GROUP BY 1")
def piv_fill(t):
    # a fine row key leaves many cells empty
    lines = t.part.withColumn("line", F.concat_ws("/", "p_brand", F.col("p_size").cast("string")))
    return rounded(R.pivot(lines, "line", "p_type", None, F.avg("p_retailprice"), fill=0), "line", TYPES)




@query("SELECT p_brand, " + cells("count(*) FILTER (WHERE {})", '"{}"', TYPES, "p_type") + " FROM part GROUP BY 1")
def xtab_count(t):
    return R.crosstab(t.part, "p_brand", "p_type")


@query("SELECT o_orderpriority, " + cells("round(count(*) FILTER (WHERE {}) * 100.0::DOUBLE / count(*), 6)", '"{}"') + " FROM orders GROUP BY 1")
def xtab_row_pct(t):
    return rounded(R.crosstab_share(t.orders, "o_orderpriority", "o_orderstatus", None, 100.0), "o_orderpriority", STATUS)


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, " + ("1.0::DOUBLE AS r" if a == b else f"round(corr({a}, {b}), 6) AS r FROM lineitem") for a in LINE for b in LINE))
def resh_unpivot(t):
    return correlation_matrix(t.lineitem, LINE).select("a", "b", r("r").alias("r"))


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS field, " + ", ".join(f"""(round(avg({c}) FILTER (WHERE l_returnflag = '{f}'), 6)) AS "{f}" """ for f in "ANR") + " FROM lineitem"
    for c in LINE))
def resh_transpose(t):
    means = t.lineitem.groupBy("l_returnflag").agg(*[r(F.avg(c)).alias(c) for c in LINE])
    return R.transpose_small(means, "l_returnflag", LINE)


@query("""SELECT pos // 4 AS row, """ + ", ".join(f"max(value) FILTER (WHERE pos % 4 = {i}) AS c{i}" for i in range(4))
       + """, max(value) FILTER (WHERE pos % 4 = 1) AS back1 FROM
          (SELECT value, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events) GROUP BY 1""")
def resh_fold(t):
    wide = materialize(C.fold_rows(t.events.select("event_id", "value"), ["event_id"], "value", 4), "folded")
    # and back: the flattened positions must give the same cells again
    flat = C.unfold_rows(wide, "row", [f"c{i}" for i in range(4)])
    second = flat.filter(F.pmod("pos", F.lit(4)) == 1).select(F.floor(F.col("pos") / 4).alias("row"), F.col("value").alias("back1"))
    return wide.join(second, "row")


@query("""WITH n AS (SELECT count(*) AS n FROM supplier), p AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS pos FROM supplier)
          SELECT s_suppkey, copy::INT AS copy, pos * 3 + copy AS pos_repeat, copy * n + pos AS pos_tile FROM p, n, (SELECT unnest([0, 1, 2]) AS copy)""")
def resh_repeat(t):
    rows = positions(t.supplier.select("s_suppkey"), ["s_suppkey"])
    n = t.supplier.agg(N()).scalar()
    out = C.repeat_rows(rows, 3)
    return out.select(
        "s_suppkey", "copy", (F.col("pos") * 3 + F.col("copy")).alias("pos_repeat"), (F.col("copy") * n + F.col("pos")).alias("pos_tile")
    )
