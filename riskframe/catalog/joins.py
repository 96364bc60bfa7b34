"""Joins, set operations, concatenation."""

from pyspark.sql import functions as F

from riskframe.catalog.registry import N, query, r
from riskframe.operators import columns as C
from riskframe.operators import joins as J
from riskframe.operators import sets as E
from riskframe.operators import stats as S
from riskframe.operators.ordered import batches, folds


def applications(t):
    """Vectors stand for the applications, labels for the bureau: either has keys of its own."""
    return t.embeddings.select(F.col("vec_id").alias("doc_id"), F.col("label").alias("cluster"))


APPS = "(SELECT vec_id AS doc_id, label AS cluster FROM embeddings)"


def key_sets(t):
    """Three overlapping bags of customer keys, one per order status."""
    return [t.orders.filter(F.col("o_orderstatus") == s).select("o_custkey") for s in "FOP"]


def key_set_sql(s):
    return f"(SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = '{s}')"


SF, SO, SP = (key_set_sql(s) for s in "FOP")


@query(f"SELECT a.doc_id, cluster, quality, toxic FROM {APPS} a JOIN labels l ON a.doc_id = l.doc_id")
def join_inner(t):
    return applications(t).join(t.labels, "doc_id").select("doc_id", "cluster", "quality", "toxic")


@query(f"SELECT a.doc_id, cluster, quality, quality IS NULL AS missed FROM {APPS} a LEFT JOIN labels l ON a.doc_id = l.doc_id")
def join_left(t):
    out = applications(t).join(t.labels, "doc_id", "left")
    return out.select("doc_id", "cluster", "quality", F.col("quality").isNull().alias("missed"))


@query(f"SELECT l.doc_id, cluster, quality, cluster IS NULL AS missed FROM {APPS} a RIGHT JOIN labels l ON a.doc_id = l.doc_id")
def join_right(t):
    out = applications(t).join(t.labels, "doc_id", "right")
    return out.select("doc_id", "cluster", "quality", F.col("cluster").isNull().alias("missed"))


@query(f"SELECT doc_id, cluster, quality FROM {APPS} a FULL JOIN labels l USING (doc_id)")
def join_outer(t):
    return J.full_join(applications(t), t.labels, ["doc_id"]).select("doc_id", "cluster", "quality")


@query(f"""SELECT CASE WHEN a.doc_id IS NULL THEN 'right_only' WHEN l.doc_id IS NULL THEN 'left_only' ELSE 'both' END AS origin,
          count(*) AS n FROM {APPS} a FULL JOIN labels l ON a.doc_id = l.doc_id GROUP BY 1""")
def join_indicator(t):
    return J.full_join(applications(t), t.labels, ["doc_id"], "origin").groupBy("origin").agg(N().alias("n"))


@query("SELECT o_orderkey, o_totalprice, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def join_pruned(t):
    left = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    right = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return left.join(right, "o_custkey").select("o_orderkey", "o_totalprice", "c_mktsegment")


@query(f"""SELECT sum((a.doc_id IS NOT NULL AND l.doc_id IS NOT NULL)::INT)::BIGINT AS n_both,
          sum((l.doc_id IS NULL)::INT)::BIGINT AS n_left_only, sum((a.doc_id IS NULL)::INT)::BIGINT AS n_right_only
          FROM {APPS} a FULL JOIN labels l ON a.doc_id = l.doc_id""")
def join_match_counts(t):
    return J.match_counts(applications(t), t.labels, ["doc_id"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def join_semi(t):
    big = t.orders.filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(big, "c_custkey", "left_semi")


@query("""SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS
          (SELECT 1 FROM orders WHERE o_custkey = c.c_custkey AND o_totalprice > 450000)""")
def join_anti(t):
    big = t.orders.filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(big, "c_custkey", "left_anti")


@query("""SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey""")
def join_lookup(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    return t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")


@query("""SELECT k, round(avg(v), 6) AS avg_value, count(DISTINCT src)::INT AS n_sources FROM
          (SELECT c_custkey AS k, c_acctbal AS v, 0 AS src FROM customer UNION ALL SELECT s_suppkey, s_acctbal, 1 FROM supplier)
          GROUP BY 1""")
def join_avg_sources(t):
    a = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    b = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v"))
    return J.average_sources([a, b], "k", "v").select("k", r("avg_value").alias("avg_value"), "n_sources")


@query("""SELECT coalesce(c_custkey, s_suppkey) AS k, round(c_acctbal + s_acctbal, 6) AS total
          FROM customer FULL JOIN supplier ON c_custkey = s_suppkey""")
def align_add(t):
    a = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    b = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v"))
    return J.align_add(a, b, "k", "v").select("k", r("total").alias("total"))


@query("""SELECT coalesce(a.pos, b.pos) AS pos, c_custkey, s_suppkey FROM
          (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS pos FROM customer) a FULL JOIN
          (SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal, s_suppkey) - 1 AS pos FROM supplier) b ON a.pos = b.pos""")
def join_position(t):
    left, right = t.customer.select("c_custkey", "c_acctbal"), t.supplier.select("s_suppkey", "s_acctbal")
    out = J.join_by_position(left, ["c_acctbal", "c_custkey"], right, ["s_acctbal", "s_suppkey"])
    return out.select("pos", "c_custkey", "s_suppkey")


@query("""SELECT c_custkey, rate_pct, months, round(c_acctbal * rate_pct / 100.0 / months, 9) AS installment
          FROM customer, (SELECT unnest([5, 10]) AS rate_pct), (SELECT unnest([12, 24, 36]) AS months)""")
def cross_pairs(t):
    grid = C.expand_levels(t.customer.select("c_custkey", "c_acctbal"), rate_pct=[5, 10], months=[12, 24, 36])
    cost = F.col("c_acctbal") * F.col("rate_pct") / F.lit(100.0) / F.col("months")
    return grid.select("c_custkey", "rate_pct", "months", r(cost, 9).alias("installment"))


@query("""WITH m AS (SELECT o_orderpriority AS l, avg(o_totalprice) AS s FROM orders GROUP BY 1)
          SELECT a.l AS level_a, b.l AS level_b, round(a.s - b.s, 4) AS diff FROM m a, m b""")
def cross_pairwise_diff(t):
    out = J.pairs_of_levels(t.orders, "o_orderpriority", F.avg("o_totalprice"), "diff")
    return out.select("level_a", "level_b", r("diff", 4).alias("diff"))


@query("""WITH cells AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS col, unnest(embedding)::DOUBLE AS x FROM embeddings),
          m AS (SELECT col, max(x) AS mx FROM cells GROUP BY 1)
          SELECT vec_id, c.col::INT AS col, round(x / mx, 6) AS scaled FROM cells c JOIN m ON c.col = m.col""")
def cross_broadcast_row(t):
    scaled = S.scale_vectors(t.embeddings.select("vec_id", "embedding"), "embedding", F.max)
    return scaled.select("vec_id", F.posexplode("embedding").alias("col", "x")).select("vec_id", "col", r("x").alias("scaled"))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')")
def set_concat(t):
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    return E.concat(*[t.orders.filter(F.col("o_orderstatus") == s).select(*cols) for s in "FOP"])


@query("SELECT o_orderkey, 'batch_' || lower(o_orderstatus) AS batch FROM orders")
def set_concat_tagged(t):
    parts = {f"batch_{s.lower()}": t.orders.filter(F.col("o_orderstatus") == s).select("o_orderkey") for s in "FOP"}
    return E.concat_tagged(parts, "batch")


@query(f"SELECT * FROM {SF} UNION SELECT * FROM {SO}")
def set_union(t):
    f, o, _ = key_sets(t)
    return E.union(f, o)


@query(f"SELECT * FROM {SF} INTERSECT SELECT * FROM {SO} INTERSECT SELECT * FROM {SP}")
def set_intersect(t):
    return E.intersect(*key_sets(t))


@query(f"SELECT * FROM {SF} EXCEPT SELECT * FROM {SO}")
def set_except(t):
    f, o, _ = key_sets(t)
    return E.subtract(f, o)


@query(f"(SELECT * FROM {SF} EXCEPT SELECT * FROM {SO}) UNION (SELECT * FROM {SO} EXCEPT SELECT * FROM {SF})")
def set_symdiff(t):
    f, o, _ = key_sets(t)
    return E.symmetric_difference(f, o)


THREE = f"(SELECT *, 'f' AS s FROM {SF} UNION ALL SELECT *, 'o' FROM {SO} UNION ALL SELECT *, 'p' FROM {SP})"


@query(f"SELECT o_custkey FROM {THREE} GROUP BY 1 HAVING count(DISTINCT s) >= 2")
def set_at_least_k(t):
    return E.in_at_least(2, *key_sets(t))


@query(f"SELECT o_custkey FROM {THREE} GROUP BY 1 HAVING count(DISTINCT s) = 1")
def set_exactly_one(t):
    return E.in_exactly(1, *key_sets(t))


@query(f"""SELECT (SELECT count(*) FROM (SELECT * FROM {SF} EXCEPT SELECT c_custkey FROM customer)) = 0 AS is_subset,
          (SELECT count(*) FROM (SELECT * FROM {SF} INTERSECT SELECT c_custkey FROM customer)) = 0 AS is_disjoint""")
def set_subset(t):
    return E.subset_report(key_sets(t)[0], t.customer.select("c_custkey"))


@query("SELECT o_orderkey, ntile(7) OVER (ORDER BY o_totalprice, o_orderkey)::INT AS fold FROM orders")
def set_split_folds(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return folds(rows, ["o_totalprice", "o_orderkey"], 7).select("o_orderkey", "fold")


@query("SELECT event_id, ((row_number() OVER (ORDER BY ts, event_id) - 1) // 250)::BIGINT AS batch FROM events")
def set_batches(t):
    return batches(t.events.select("ts", "event_id"), ["ts", "event_id"], 250).select("event_id", "batch")
