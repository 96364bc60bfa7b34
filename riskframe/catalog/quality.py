"""Missing data, duplicates, typing and validation."""

from pyspark.sql import functions as F

from riskframe.catalog.profiling import LABELLED, labelled_documents
from riskframe.catalog.registry import query, r
from riskframe.operators import missing as X
from riskframe.operators import quality as Q
from riskframe.functions.text import VALID_EMAIL, find_all
from riskframe.session import work_dir
from riskframe.sources.snapshots import write_reconciled

COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


def gappy_customers(t):
    """Customers whose negative balance counts as not reported."""
    return t.customer.select(
        "c_custkey", "c_nationkey", "c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal")
    )


GAPPY = "(SELECT c_custkey, c_nationkey, c_mktsegment, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal FROM customer)"


@query(f"SELECT doc_id, quality IS NULL AS quality, toxic IS NULL AS toxic, lang IS NULL AS lang FROM {LABELLED}")
def miss_mask(t):
    return X.null_mask(labelled_documents(t), ["quality", "toxic", "lang"], ["doc_id"])


@query(" UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls FROM {LABELLED}""" for c in COLS))
def miss_per_col(t):
    return X.null_counts(labelled_documents(t))


@query("SELECT " + " + ".join(f"(count(*) - count({c}))" for c in COLS) + f" AS total_nulls FROM {LABELLED}")
def miss_total(t):
    return X.null_total(labelled_documents(t))


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round_even((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS pct_null FROM {LABELLED}"""
    for c in COLS))
def miss_pct(t):
    return X.null_pct(labelled_documents(t))


@query(f"SELECT doc_id, lang FROM {LABELLED} WHERE quality IS NULL OR toxic IS NULL")
def miss_any_row(t):
    return labelled_documents(t).filter(X.any_null(["quality", "toxic"])).select("doc_id", "lang")


@query("SELECT doc_id, lang FROM documents")
def drop_empty_cols(t):
    df = t.documents.select("doc_id", "lang").withColumn("internal_notes", F.lit(None).cast("string"))
    return X.drop_empty_columns(df)


@query(f"SELECT doc_id, quality, toxic FROM {LABELLED} WHERE quality IS NOT NULL AND toxic IS NOT NULL AND lang IS NOT NULL")
def drop_any(t):
    return X.drop_rows(labelled_documents(t)).select("doc_id", "quality", "toxic")


@query(f"SELECT doc_id, lang, quality FROM {LABELLED} WHERE quality IS NOT NULL")
def drop_subset(t):
    return X.drop_rows(labelled_documents(t), subset=["quality"]).select("doc_id", "lang", "quality")


@query(f"""SELECT doc_id FROM {LABELLED} WHERE (doc_id IS NOT NULL)::INT + (lang IS NOT NULL)::INT + (source IS NOT NULL)::INT
          + (n_chars IS NOT NULL)::INT + (quality IS NOT NULL)::INT + (toxic IS NOT NULL)::INT >= 5""")
def drop_thresh(t):
    return X.drop_rows(labelled_documents(t), thresh=5).select("doc_id")


@query(f"SELECT c_custkey, round(coalesce(bal, (SELECT quantile_cont(bal, 0.5) FROM {GAPPY})), 6) AS bal FROM {GAPPY}")
def fill_median(t):
    return X.fill_median(gappy_customers(t), "bal").select("c_custkey", r("bal").alias("bal"))


@query(f"SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic FROM {LABELLED}")
def fill_const(t):
    return labelled_documents(t).na.fill({"quality": -1, "toxic": 0}).select("doc_id", "quality", "toxic")


@query(f"""SELECT c_custkey, round(coalesce(bal, m), 6) AS bal FROM {GAPPY} LEFT JOIN
          (SELECT c_mktsegment AS s, quantile_cont(bal, 0.5) AS m FROM {GAPPY} GROUP BY 1) ON s = c_mktsegment""")
def fill_group_median(t):
    return X.fill_group_median(gappy_customers(t), "bal", "c_mktsegment").select("c_custkey", r("bal").alias("bal"))


@query("""SELECT event_id, last_value(CASE WHEN value > 30 THEN value END IGNORE NULLS)
          OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS carried FROM events""")
def fill_ffill(t):
    rows = t.events.select("event_id", "user_id", "ts", F.when(F.col("value") > 30, F.col("value")).alias("carried"))
    return X.fill_forward(rows, "carried", ["ts", "event_id"], ["user_id"]).select("event_id", "carried")


@query("SELECT event_id, coalesce(json_extract(props, '$.k')::INT, 0) AS k, coalesce(json_extract(props, '$.income')::INT, 0) AS income FROM events")
def fill_missing_field(t):
    rec = F.from_json("props", "k int, income int")
    return t.events.select("event_id", F.coalesce(rec["k"], F.lit(0)).alias("k"), F.coalesce(rec["income"], F.lit(0)).alias("income"))


@query("SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS is_dup FROM documents")
def dup_flag(t):
    return Q.duplicate_flags(t.documents, ["text"], "doc_id").select("doc_id", "is_dup")


@query("SELECT doc_id FROM (SELECT doc_id, count(*) OVER (PARTITION BY text) AS c FROM documents) WHERE c > 1")
def dup_all_copies(t):
    return Q.duplicate_flags(t.documents, ["text"], "doc_id").filter("has_copies").select("doc_id")


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_tax, l_discount FROM lineitem")
def dup_drop_exact(t):
    return Q.drop_duplicates(t.lineitem.select("l_returnflag", "l_linestatus", "l_tax", "l_discount"))


@query("SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_keys FROM lineitem")
def dup_key_count(t):
    return Q.duplicate_key_count(t.lineitem, "l_orderkey", "l_linenumber")


@query("""SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
          FROM events) WHERE rn = 1""")
def dup_keep_last(t):
    rows = t.events.select("user_id", "event_id", "ts", "value")
    return Q.keep_last(rows, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@query("SELECT l_orderkey, count(*) AS cnt FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def dup_values(t):
    return Q.repeated_values(t.lineitem, "l_orderkey")


@query("""SELECT o_orderkey, TRY_CAST(replace(split_part(o_orderpriority, '-', 1) || '.5%', '%', '') AS DOUBLE) AS rate,
          TRY_CAST(replace(o_orderpriority, '%', '') AS DOUBLE) AS junk FROM orders""")
def cast_strip_num(t):
    pct = F.concat(F.split_part("o_orderpriority", F.lit("-"), F.lit(1)), F.lit(".5%"))
    return t.orders.select("o_orderkey", Q.strip_number(pct, "%").alias("rate"), Q.strip_number("o_orderpriority", "%").alias("junk"))


@query(f"SELECT doc_id, quality::DOUBLE::BIGINT AS quality FROM {LABELLED}")
def cast_nullable_int(t):
    return labelled_documents(t).select("doc_id", F.col("quality").cast("double").cast("long").alias("quality"))


@query("""SELECT c_custkey, c_mktsegment, (SELECT count(DISTINCT c_mktsegment) FROM customer c2
          WHERE c2.c_mktsegment < c1.c_mktsegment) AS code FROM customer c1""")
def cast_category(t):
    codes = Q.category_codes(t.customer, "c_mktsegment")
    return t.customer.join(codes, "c_mktsegment", "left").select("c_custkey", "c_mktsegment", "code")


@query("""SELECT conv_id, turn, TRY_CAST(trim(regexp_extract(text, '[0-9]+')) AS BIGINT) AS num,
          TRY_CAST(trim(regexp_extract(text, '[0-9]+')) AS BIGINT) IS NULL AS skipped FROM conversations""")
def cast_try_int(t):
    num = Q.try_int(F.regexp_extract("text", "[0-9]+", 0))
    return t.conversations.select("conv_id", "turn", num.alias("num"), num.isNull().alias("skipped"))


@query("SELECT o_orderkey, o_orderstatus = 'F' AS finished FROM orders")
def cast_bool_text(t):
    text = F.when(F.col("o_orderstatus") == "F", "True").otherwise("False")
    return t.orders.select("o_orderkey", Q.text_bool(text).alias("finished"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'below range' WHEN c_acctbal > 9000 THEN 'above range' END AS problem,
          c_acctbal BETWEEN 0 AND 9000 AS ok FROM customer""")
def valid_range(t):
    b = F.col("c_acctbal")
    problem = F.when(b < 0, "below range").when(b > 9000, "above range")
    return t.customer.select("c_custkey", problem.alias("problem"), Q.in_range(b, 0, 9000).alias("ok"))


@query("""WITH raw AS (SELECT o_orderkey, string_split(o_orderpriority, '-') AS p FROM orders),
          lines AS (SELECT o_orderkey, CASE WHEN len(p) <> 2 THEN 'expected 2 fields, got ' || len(p)
                    WHEN TRY_CAST(trim(p[1]) AS INTEGER) IS NULL THEN 'bad number' END AS error,
                    TRY_CAST(trim(p[1]) AS INTEGER) AS rank, p[2] AS label FROM raw)
          SELECT o_orderkey, rank, label, error FROM lines""")
def valid_rows_split(t):
    parsed = Q.parse_fields(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", {"rank": "int", "label": "string"}, "-")
    good, bad = Q.split_valid(parsed.drop("o_orderpriority"))
    return good.withColumn("error", F.lit(None).cast("string")).unionByName(bad)


@query("""SELECT doc_id, word, regexp_matches(word, '^[A-Za-z0-9_.]+@[A-Za-z0-9_]+\\.[a-z]+$') AS is_email
          FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^ \\n]*@[^ \\n]*')) AS word FROM documents)""")
def valid_email(t):
    words = t.documents.select("doc_id", F.explode(find_all("text", r"[^ \n]*@[^ \n]*")).alias("word"))
    return words.withColumn("is_email", F.col("word").rlike(VALID_EMAIL))


@query("""SELECT sum((o_orderstatus = 'F')::INT)::BIGINT AS n_f, sum((o_orderstatus = 'O')::INT)::BIGINT AS n_o,
          sum((o_orderstatus = 'P')::INT)::BIGINT AS n_p, count(*) AS n_all, true AS reconciled FROM orders""")
def valid_rowcount(t):
    batches = [t.orders.filter(F.col("o_orderstatus") == s).select("o_orderkey", "o_orderstatus") for s in "FOP"]
    stacked = batches[0].unionByName(batches[1]).unionByName(batches[2])
    counts = stacked.agg(*[F.count_if(F.col("o_orderstatus") == s).alias(f"n_{s.lower()}") for s in "FOP"], F.count(F.lit(1)).alias("n_all"))
    source = t.orders.agg(F.count(F.lit(1))).scalar()
    parts = F.col("n_f") + F.col("n_o") + F.col("n_p")
    return counts.withColumn("reconciled", (parts == F.col("n_all")) & (F.col("n_all") == source))


@query("""SELECT count(*) AS n_source, count(*) FILTER (WHERE o_totalprice > 100000) AS n_written, count(*) FILTER (WHERE NOT o_totalprice > 100000) AS n_rejected,
          count(*) FILTER (WHERE o_totalprice > 100000 AND o_orderstatus = 'F') AS n_f, count(*) FILTER (WHERE o_totalprice > 100000 AND o_orderstatus <> 'F') AS n_open,
          count(*) FILTER (WHERE o_totalprice > 100000) AS n_read FROM orders""")
def valid_rowcount_write(t):
    path = work_dir(t.spark, "reconciled")
    parts = {"n_f": F.col("o_orderstatus") == "F", "n_open": F.col("o_orderstatus") != "F"}
    counts = write_reconciled(t.orders, F.col("o_totalprice") > 100000, path, parts)
    return t.spark.read.parquet(path).agg(*[F.lit(n).cast("long").alias(k) for k, n in counts.items()], F.count(F.lit(1)).alias("n_read"))


@query("SELECT true AS all_close, count(*) AS n_rows FROM orders")
def approx_equal(t):
    a = t.orders.select("o_orderkey", "o_totalprice")
    b = a.withColumn("o_totalprice", F.col("o_totalprice") * (1 + 1e-9))
    return Q.all_close(a, b, ["o_orderkey"], "o_totalprice")
