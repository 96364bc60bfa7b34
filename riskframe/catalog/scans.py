"""Sources and sinks: every file format is written from the tables and read back."""

from pyspark.sql import functions as F

from riskframe.catalog.registry import iso, query
from riskframe.operators.profile import key_is_unique
from riskframe.session import work_dir
from riskframe.sources import files as io
from riskframe.sources import inference, records
from riskframe.sources.snapshots import SnapshotStore

CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query(CUSTOMER_SQL)
def scan_csv(t):
    path = work_dir(t.spark, "csv")
    io.write_csv(t.customer, path)
    return io.read_csv(t.spark, path, CUSTOMER)


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day, year(o_orderdate)::INT AS yr FROM orders")
def scan_csv_dates(t):
    path = work_dir(t.spark, "csv-dates")
    io.write_csv(t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d")), path)
    df = io.read_csv(t.spark, path, "o_orderkey long, d date")
    return df.select("o_orderkey", iso("d").alias("order_day"), F.year("d").alias("yr"))


ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"


def orders_file(t, purpose):
    path = work_dir(t.spark, purpose)
    io.write_csv(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority"), path)
    return path


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def scan_csv_columns(t):
    # the parser fills the named columns alone
    return io.read_csv(t.spark, orders_file(t, "csv-columns"), ORDERS, columns=["o_orderkey", "o_totalprice", "o_orderstatus"], line_breaks=False)


@query("""SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys,
          count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders""")
def scan_csv_key(t):
    return key_is_unique(io.read_csv(t.spark, orders_file(t, "csv-key"), ORDERS, line_breaks=False), "o_orderkey")


@query("SELECT doc_id, sha256(text) AS digest, length(text) AS n_chars, lang FROM documents")
def scan_csv_line_breaks(t):
    # texts with line breaks, separators and quotes; every file is read by as many tasks as it has ranges
    path = work_dir(t.spark, "csv-breaks")
    io.write_csv(t.documents.select("doc_id", "text", "lang"), path)
    df = io.read_csv(t.spark, path, "doc_id long, text string, lang string", whole_files=False)
    return df.select("doc_id", F.sha2("text", 256).alias("digest"), F.length("text").cast("long").alias("n_chars"), "lang")


def type_sql(column, place):
    text = f"CAST({column} AS VARCHAR)"
    kinds = {
        "boolean": f"regexp_full_match({text}, '(?i:true|false)')", "bigint": f"regexp_full_match({text}, '[+-]?[0-9]+')",
        "double": f"regexp_full_match({text}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')", "date": f"try_cast({text} AS DATE) IS NOT NULL",
    }
    chosen = " ".join(f"WHEN bool_and({hit}) THEN '{kind}'" for kind, hit in kinds.items())
    return f"""SELECT '{column}' AS "column", {place} AS "position", CASE WHEN count({column}) = 0 THEN 'string' {chosen} ELSE 'string' END AS "type",
               count({column}) AS filled FROM o"""


@query("WITH o AS (SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders) " + " UNION ALL ".join(
    type_sql(c.split()[0], i) for i, c in enumerate(ORDERS.split(", "))))
def scan_csv_inferred(t):
    texts = inference.read_texts(t.spark, orders_file(t, "csv-types"), line_breaks=False)
    return inference.with_types(inference.column_states(texts)).select("column", "position", "type", "filled")


@query(CUSTOMER_SQL)
def scan_csv_delim(t):
    path = work_dir(t.spark, "csv-pipe")
    t.customer.write.option("header", True).option("sep", "|").csv(path)
    return io.read_csv(t.spark, path, CUSTOMER, sep="|")


@query("""SELECT c_custkey, c_name || ', "' || c_mktsegment || '", ' || c_nationkey AS label FROM customer""")
def scan_csv_quoted(t):
    path = work_dir(t.spark, "csv-quoted")
    label = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('", '), F.col("c_nationkey").cast("string"))
    t.customer.select("c_custkey", label.alias("label")).write.option("header", True).option(
        "quote", '"'
    ).option("escape", '"').csv(path)
    return io.read_csv(t.spark, path, "c_custkey long, label string")


@query("""SELECT l_returnflag, count(*) AS n, sum(l_linenumber)::BIGINT AS lines,
          round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY 1""")
def scan_csv_typed_records(t):
    path = work_dir(t.spark, "csv-typed")
    io.write_csv(t.lineitem.select("l_returnflag", "l_linenumber", "l_quantity"), path)
    df = io.read_csv(t.spark, path, "l_returnflag string, l_linenumber int, l_quantity double")
    return df.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"),
        F.round(F.sum("l_quantity"), 2).alias("qty"),
    )


@query(CUSTOMER_SQL)
def scan_missing_path(t):
    path = work_dir(t.spark, "csv-present")
    io.write_csv(t.customer, path)
    missing = io.read_or_empty(t.spark, path + "-not-there", CUSTOMER)
    return io.read_or_empty(t.spark, path, CUSTOMER).unionByName(missing)


@query("SELECT c_custkey || ',' || c_name || ',' || c_mktsegment AS line FROM customer")
def scan_lines(t):
    path = work_dir(t.spark, "lines")
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    t.customer.select(line.alias("value")).write.text(path)
    return io.read_lines(t.spark, path).select(F.col("value").alias("line"))


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS filled, min({c})::DOUBLE AS low, max({c})::DOUBLE AS high, NULL AS remark FROM orders"""
    for c in ("o_orderkey", "o_custkey", "o_totalprice")))
def from_records(t):
    # one Python record per column, taken from a one-row report, and back as a table
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    row = t.orders.agg(
        *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("filled", F.count), ("low", F.min), ("high", F.max))]
    ).first()
    report = [
        {"column": c, "filled": row[f"filled_{c}"], "low": float(row[f"low_{c}"]), "high": float(row[f"high_{c}"])} for c in columns
    ]
    return records.from_records(t.spark, report, "column string, filled long, low double, high double, remark string")


@query("SELECT event_id, json_extract(props, '$.k')::INT AS k FROM events")
def scan_json(t):
    return io.parse_json(t.events, "props", "k int").select("event_id", "rec.k")


@query("""SELECT doc_id, entry_no::INT AS entry_no, trim(p[1]) AS first, trim(p[2]) AS second, trim(p[3]) AS third
          FROM (SELECT doc_id, entry_no, string_split(line, ' ') AS p FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                       generate_subscripts(string_split(text, chr(10)), 1) - 1 AS entry_no FROM documents))""")
def scan_mem_delimited(t):
    return io.explode_delimited(t.documents.select("doc_id", "text"), "text", "\n", " ", ["first", "second", "third"])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def sink_csv(t):
    path = work_dir(t.spark, "sink-csv")
    io.write_csv(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), path)
    return io.read_csv(t.spark, path, "o_orderkey long, o_custkey long, o_totalprice double")


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def sink_csv_append(t):
    path = work_dir(t.spark, "sink-append")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    io.write_csv(rows.filter("o_orderstatus = 'O'"), path)
    io.append_csv(rows.filter("o_orderstatus <> 'O'"), path)
    return io.read_csv(t.spark, path, "o_orderkey long, o_orderstatus string")


@query(CUSTOMER_SQL + " WHERE c_acctbal >= 7000")
def sink_csv_filtered(t):
    path = work_dir(t.spark, "sink-filtered")
    io.filter_to_csv(t.customer, F.col("c_acctbal") >= 7000, path)
    return io.read_csv(t.spark, path, CUSTOMER)


@query("SELECT p_partkey, p_brand, p_retailprice FROM part")
def sink_snapshot(t):
    path = work_dir(t.spark, "snapshot")
    io.save_snapshot(t.part, path)
    return io.load_snapshot(t.spark, path, ["p_partkey", "p_brand", "p_retailprice"])


@query("""SELECT to_json({'c_custkey': c_custkey, 'c_nationkey': c_nationkey, 'c_mktsegment': c_mktsegment})::VARCHAR AS json
          FROM customer""")
def sink_json(t):
    return io.to_json_rows(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"))


@query("""SELECT c_custkey, c_nationkey, c_mktsegment, '{' || chr(10) || '  "c_custkey" : ' || c_custkey || ',' || chr(10) || '  "c_nationkey" : ' || c_nationkey || ','
          || chr(10) || '  "c_mktsegment" : "' || c_mktsegment || '"' || chr(10) || '}' AS pretty FROM customer""")
def sink_json_file(t):
    path = work_dir(t.spark, "sink-json")
    io.write_json(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), path)
    back = t.spark.read.schema("c_custkey long, c_nationkey int, c_mktsegment string").json(path)
    return back.withColumn("pretty", io.to_json_rows(back, pretty=True, column=True))


@query("""SELECT 'part' AS key, 1::BIGINT AS version, count(*) AS n_rows, sum(p_size)::BIGINT AS check_sum FROM part
          UNION ALL SELECT 'supplier', 2, count(*), sum(s_nationkey)::BIGINT FROM supplier
          UNION ALL SELECT 'nation', 2, count(*), sum(n_regionkey)::BIGINT FROM nation""")
def sink_snapshot_keys(t):
    store = SnapshotStore(t.spark, work_dir(t.spark, "store"))
    store.publish({"part": t.part, "supplier": t.supplier.limit(0)})
    store.publish({"supplier": t.supplier, "nation": t.nation})
    sums = [store.read(k).agg(F.sum(c).cast("long").alias("check_sum")).withColumn("key", F.lit(k)) for k, c in (("part", "p_size"), ("supplier", "s_nationkey"), ("nation", "n_regionkey"))]
    return store.keys().join(sums[0].unionByName(sums[1]).unionByName(sums[2]), "key")
