"""Inspection and profiling."""

from pyspark.sql import functions as F

from riskframe.catalog.registry import N, query, r
from riskframe.operators import profile as P
from riskframe.operators import sketches as K
from riskframe.session import materialize

ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def labelled_documents(t):
    """Documents with their (partly missing) labels: the table with real gaps."""
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id", "left")


LABELLED = "(SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def describe_sql(columns, table, by=""):
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"""SELECT {keys}'{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS "min", round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25,
        round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50, round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75,
        max({c})::DOUBLE AS "max" FROM {table} {group}"""
        for c in columns
    )


def rounded_describe(df, keys):
    return df.select(
        *keys, "count", r("mean").alias("mean"), r("std").alias("std"), "min", r("p25").alias("p25"),
        r("p50").alias("p50"), r("p75").alias("p75"), "max",
    )


@query("SELECT count(*) AS n_rows, 11 AS n_cols, count(*) * 11 AS n_cells FROM lineitem")
def prof_shape(t):
    return P.shape(t.lineitem)


@query("""SELECT 'o_orderkey' AS "column", 'bigint' AS type UNION ALL SELECT 'o_custkey', 'bigint'
          UNION ALL SELECT 'o_orderstatus', 'string' UNION ALL SELECT 'o_totalprice', 'double'
          UNION ALL SELECT 'o_orderdate', 'timestamp' UNION ALL SELECT 'o_orderpriority', 'string'""")
def prof_schema(t):
    schema = P.schema_table(t.orders)
    # a timestamp without zone is still a timestamp to the report
    return schema.withColumn("type", F.regexp_replace("type", "_ntz$", ""))


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def prof_numeric_cols(t):
    return P.select_numeric(t.lineitem)


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS non_null FROM {LABELLED}"""
    for c in ("doc_id", "lang", "source", "n_chars", "quality", "toxic")))
def prof_nonnull(t):
    return P.non_null_counts(labelled_documents(t))


@query(describe_sql(LINE, "lineitem"))
def prof_describe(t):
    return rounded_describe(P.describe(t.lineitem, LINE), ["column"])


TEXTS = ("c_mktsegment", "c_name")


@query(describe_sql(["c_custkey", "c_nationkey", "c_acctbal"], "customer").replace(
    " FROM customer", """, NULL::BIGINT AS "unique", NULL AS top, NULL::BIGINT AS freq FROM customer""") + " UNION ALL " + " UNION ALL ".join(
    f"""SELECT '{c}', sum(freq)::BIGINT, NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*),
    first({c} ORDER BY freq DESC, {c}), max(freq)
    FROM (SELECT {c}, count(*) AS freq FROM customer WHERE {c} IS NOT NULL GROUP BY 1)"""
    for c in TEXTS))
def prof_describe_all(t):
    rows = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", *TEXTS)
    return rounded_describe(P.describe_all(rows), ["column", "unique", "top", "freq"])


@query(describe_sql(["o_totalprice"], "orders", "o_orderstatus"))
def prof_describe_group(t):
    return rounded_describe(P.describe(t.orders, ["o_totalprice"], ["o_orderstatus"]), ["o_orderstatus", "column"])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def prof_head(t):
    return P.head(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"], 5)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def prof_tail(t):
    return P.tail(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"], 5)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey || '|42'), o_orderkey LIMIT 50")
def prof_sample_n(t):
    return P.sample_n(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 50, 42)


@query("""SELECT o_orderkey, o_totalprice FROM orders
          WHERE ('0x' || substr(md5(o_orderkey || '|7'), 1, 8))::BIGINT / 4294967296.0 < 0.1""")
def prof_sample_frac(t):
    return P.sample_fraction(t.orders.select("o_orderkey", "o_totalprice"), 0.1, 7, "o_orderkey")


DRAWN = "row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey || '|11'), o_orderkey) AS i"


@query(f"SELECT o_orderkey, o_orderpriority FROM (SELECT *, {DRAWN} FROM orders) WHERE i <= 25")
def prof_sample_strata(t):
    return P.sample_strata(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey", "o_orderpriority", 25, 11)


@query(f"""SELECT o_orderkey, o_orderpriority FROM (SELECT *, {DRAWN}, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
           WHERE i <= floor(n * 0.1 + 0.5)""")
def prof_sample_strata_frac(t):
    return P.sample_strata_fraction(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey", "o_orderpriority", 0.1, 11)


@query("SELECT o_orderpriority, count(*) AS cnt FROM orders GROUP BY 1 ORDER BY 2 DESC, 1")
def prof_value_counts(t):
    return P.value_counts(t.orders, "o_orderpriority").orderBy(F.desc("cnt"), "o_orderpriority")


@query("""SELECT quality, round(round(count(*) / sum(count(*)) OVER (), 4) * 100, 4) AS pct
          FROM labels WHERE quality IS NOT NULL GROUP BY 1""")
def prof_value_counts_pct(t):
    return P.value_shares(t.labels, "quality").select("quality", r("pct", 4).alias("pct"))


@query("SELECT DISTINCT event_type, (SELECT count(DISTINCT event_type) FROM events) AS n_unique FROM events")
def prof_unique(t):
    counts = P.value_counts(t.events, "event_type")
    return counts.select("event_type", counts.agg(N()).scalar().alias("n_unique"))


@query("""SELECT event_type, count(*) AS n, count(DISTINCT CAST(ts AS DATE)) AS parts, true AS close FROM events
          WHERE extract(day FROM ts) <= 20 GROUP BY 1""")
def prof_unique_sketch(t):
    # one sketch per type and day is stored; the days asked for are merged without their rows
    daily = materialize(K.distinct_sketches(t.events.withColumn("day", F.to_date("ts")), "user_id", ["event_type", "day"]), "daily-users")
    asked = K.merged_distinct(daily.where(F.dayofmonth("day") <= 20), ["event_type"])
    exact = t.events.where(F.dayofmonth("ts") <= 20).groupBy("event_type").agg(F.countDistinct("user_id").alias("exact"))
    error = F.abs(F.col("n_distinct") - F.col("exact")) / F.col("exact")
    return asked.join(exact, "event_type").select("event_type", "n", "parts", (error <= 4 * K.distinct_error()).alias("close"))


@query("SELECT l_quantity, count(*) AS cnt FROM lineitem GROUP BY 1")
def prof_unique_counts(t):
    return P.value_counts(t.lineitem, "l_quantity")


@query("""SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys,
          count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS is_unique FROM lineitem""")
def key_is_unique(t):
    return P.key_is_unique(t.lineitem, "l_orderkey", "l_linenumber")
