"""Scalar functions: text, regex, dates, math, arrays, maps."""

import datetime as dt

from pyspark.sql import functions as F

from riskframe.catalog.registry import iso, query, r
from riskframe.functions import arrays as A
from riskframe.functions import temporal as D
from riskframe.functions import text as T
from riskframe.functions.numbers import round_half_even
from riskframe.operators.stats import per_position
from riskframe.operators.textstats import char_counts, word_counts

REF_DATE = dt.date(2002, 1, 1)
PRIO = "o_orderpriority"


# ------------------------------------------------------------------ text
@query("""SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low,
          array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title FROM part""")
def str_case(t):
    return t.part.select("p_partkey", F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"), F.initcap("p_name").alias("title"))


@query("""SELECT s_suppkey, upper(s_name[1]) || lower(s_name[2:]) AS clean FROM supplier""")
def str_trim_title(t):
    padded = F.concat(F.lit("  "), F.upper("s_name"), F.lit(" "))
    return t.supplier.select("s_suppkey", T.clean_name(padded).alias("clean"))


@query("SELECT doc_id, length(text)::INT AS n, length(text) > 2000 AS is_long FROM documents")
def str_len(t):
    return t.documents.select("doc_id", F.length("text").alias("n"), (F.length("text") > 2000).alias("is_long"))


@query("SELECT c_custkey, c_name || ' (' || c_mktsegment || '): nation ' || c_nationkey AS summary, concat_ws('-', c_name, c_mktsegment) AS joined FROM customer")
def str_concat(t):
    return t.customer.select(
        "c_custkey", F.format_string("%s (%s): nation %d", "c_name", "c_mktsegment", "c_nationkey").alias("summary"),
        F.concat_ws("-", "c_name", "c_mktsegment").alias("joined"),
    )


@query("SELECT c_custkey, c_name[1:4] AS head4, right(c_name, 4) AS tail4, substr(c_name, 7, 5) AS mid FROM customer")
def str_slice(t):
    return t.customer.select(
        "c_custkey", F.substring("c_name", 1, 4).alias("head4"), F.right("c_name", F.lit(4)).alias("tail4"), F.substring("c_name", 7, 5).alias("mid")
    )


@query("""SELECT p_partkey, array_to_string(list_filter(string_split(p_name, ''), lambda c, i: (i - 1) % 2 = 0), '') AS every2, reverse(p_name) AS rev FROM part""")
def str_step_reverse(t):
    return t.part.select("p_partkey", T.every_nth_char("p_name").alias("every2"), F.reverse("p_name").alias("rev"))


@query("SELECT c_custkey, repeat('*', length(c_name) - 4) || right(c_name, 4) AS masked FROM customer")
def str_mask(t):
    return t.customer.select("c_custkey", T.mask_keep_last("c_name").alias("masked"))


@query("""SELECT doc_id, (instr(text, 'the') - 1)::INT AS first_the, ((length(text) - length(replace(text, 'the', ''))) / 3)::INT AS n_the FROM documents""")
def str_find_count(t):
    return t.documents.select("doc_id", T.index_of("text", "the").alias("first_the"), T.count_of("text", "the").alias("n_the"))


@query("""SELECT o_orderkey, regexp_full_match(split_part(o_orderpriority, '-', 1), '[0-9]+') AS digits,
          regexp_full_match(o_orderpriority, '[A-Za-z0-9]+') AS alnum FROM orders""")
def str_is_class(t):
    head = F.split_part("o_orderpriority", F.lit("-"), F.lit(1))
    return t.orders.select("o_orderkey", T.is_digits(head).alias("digits"), T.is_alnum("o_orderpriority").alias("alnum"))


@query("""SELECT page_id, array_to_string(list_filter(string_split(url, '/'), lambda x: trim(x) <> ''), '|') AS parts FROM pages""")
def str_split_join(t):
    return t.pages.select("page_id", F.array_join(T.split_nonempty("url", "/"), "|").alias("parts"))


@query("SELECT page_id, replace(url, 'http', 'HTTP') AS url FROM pages")
def str_replace(t):
    return t.pages.select("page_id", F.replace("url", F.lit("http"), F.lit("HTTP")).alias("url"))


@query("SELECT c_custkey, c_custkey::INT AS id, c_nationkey::INT AS nation, NULL::INT AS seg FROM customer")
def str_kv_map(t):
    line = F.format_string("id: %d | nation: %d | seg: %s", "c_custkey", "c_nationkey", "c_mktsegment")
    m = T.int_values(T.key_values(line))
    return t.customer.select("c_custkey", *[F.element_at(m, k).alias(k) for k in ("id", "nation", "seg")])


@query("SELECT c_custkey, c_name AS name, c_nationkey AS nation, c_mktsegment AS region FROM customer")
def str_header_zip(t):
    line = F.concat_ws(",", "c_name", F.col("c_nationkey").cast("string"), "c_mktsegment")
    rec = F.from_csv(line, "name string, nation int, region string")
    return t.customer.select("c_custkey", rec.alias("r")).select("c_custkey", "r.*")


@query("""SELECT 'char' AS kind, c AS token, count(*) AS cnt FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) WHERE c <> '' GROUP BY 2
          UNION ALL SELECT 'word', w, count(*) FROM (SELECT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS w FROM documents) WHERE w <> '' GROUP BY 2""")
def str_char_count(t):
    chars, words = char_counts(t.documents, "text"), word_counts(t.documents, "text")
    return chars.withColumn("kind", F.lit("char")).unionByName(words.withColumn("kind", F.lit("word")))


@query("""SELECT p_partkey, count(*) FILTER (WHERE c % 2 = 1) <= 1 AS can_be_palindrome FROM
          (SELECT p_partkey, ch, count(*) AS c FROM (SELECT p_partkey, unnest(string_split(p_name, '')) AS ch FROM part) GROUP BY 1, 2) GROUP BY 1""")
def str_pal_perm(t):
    return t.part.select("p_partkey", T.can_be_palindrome("p_name").alias("can_be_palindrome"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '$-' ELSE '$' END || format('{:,.2f}', abs(c_acctbal)) AS money,
          format('{:.2f}%', c_nationkey::DOUBLE) AS pct, format('{:,}', c_custkey * 1000) AS thousands FROM customer""")
def str_format_num(t):
    return t.customer.select(
        "c_custkey", T.money("c_acctbal").alias("money"), T.percent(F.col("c_nationkey").cast("double")).alias("pct"),
        T.thousands(F.col("c_custkey") * 1000).alias("thousands"),
    )


# ------------------------------------------------------------------ regular expressions
@query("SELECT doc_id, nullif(regexp_extract(text, '[0-9]+'), '') AS number FROM documents")
def re_extract(t):
    return t.documents.select("doc_id", T.search("text", "[0-9]+").alias("number"))


@query("""SELECT page_id, regexp_matches(url, '^https') AS starts, regexp_matches(url, '[0-9]$') AS ends,
          regexp_matches(url, '^(?:http.?://m[.])') AS full_start FROM pages""")
def re_anchor(t):
    u = F.col("url")
    return t.pages.select("page_id", u.rlike("^https").alias("starts"), u.rlike("[0-9]$").alias("ends"), T.starts_with_pattern(u, "http.?://m[.]").alias("full_start"))


@query("""SELECT doc_id, array_to_string(regexp_extract_all(text, '[0-9]{3,5}'), ',') AS found, len(regexp_extract_all(text, '[A-Z]'))::INT AS capitals FROM documents""")
def re_findall(t):
    return t.documents.select(
        "doc_id", F.array_join(T.find_all("text", "[0-9]{3,5}"), ",").alias("found"), F.size(T.find_all("text", "[A-Z]")).alias("capitals")
    )


@query("SELECT doc_id, regexp_matches(text, 't.e') AS wildcard, regexp_matches(text, 'thi?n') AS optional FROM documents")
def re_optional(t):
    return t.documents.select("doc_id", F.col("text").rlike("t.e").alias("wildcard"), F.col("text").rlike("thi?n").alias("optional"))


@query("""SELECT o_orderkey, regexp_extract(o_orderpriority, '([0-9]+)-([A-Z ]+)', 1) AS rank, regexp_extract(o_orderpriority, '([0-9]+)-([A-Z ]+)', 2) AS label FROM orders""")
def re_groups(t):
    pattern = r"(?<rank>\d+)-(?<label>[A-Z ]+)"
    return t.orders.select("o_orderkey", F.regexp_extract(PRIO, pattern, 1).alias("rank"), F.regexp_extract(PRIO, pattern, 2).alias("label"))


@query("SELECT c_custkey, c_custkey::VARCHAR AS id, c_nationkey::VARCHAR AS nation FROM customer")
def re_pairs_map(t):
    m = T.pairs_to_map(F.format_string("id=%d;nation=%d", "c_custkey", "c_nationkey"), r"(\w+)=(\d+)")
    return t.customer.select("c_custkey", F.element_at(m, "id").alias("id"), F.element_at(m, "nation").alias("nation"))


@query("""SELECT doc_id, md5(regexp_replace(text, '[0-9]', '*', 'g')) AS masked, md5(regexp_replace(text, '[0-9]{3}([0-9]{4})', '***\\1', 'g')) AS kept,
          md5(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')) AS squeezed FROM documents""")
def re_sub(t):
    return t.documents.select(
        "doc_id", F.md5(F.regexp_replace("text", r"\d", "*")).alias("masked"),
        F.md5(F.regexp_replace("text", r"\d{3}(\d{4})", r"***$1")).alias("kept"), F.md5(T.squeeze_spaces("text")).alias("squeezed"),
    )


@query("SELECT page_id, array_to_string(regexp_split_to_array(url, '[/?&=.]'), '|') AS parts FROM pages")
def re_split(t):
    return t.pages.select("page_id", F.array_join(F.split("url", "[/?&=.]"), "|").alias("parts"))


ENTITY_SQL = """SELECT '{0}' AS src, {1} AS id, nullif(regexp_extract(text, '[0-9]{{3}}[-.]?[0-9]{{3}}[-.]?[0-9]{{4}}'), '') AS phone,
  nullif(regexp_extract(text, '\\$[0-9,]+\\.[0-9]{{2}}'), '') AS amount, nullif(regexp_extract(text, '[A-Za-z0-9_.]+@[A-Za-z0-9_]+\\.[a-z]+'), '') AS email,
  nullif(regexp_extract(text, 'AC[0-9]+'), '') AS account FROM {0}"""


@query(ENTITY_SQL.format("documents", "doc_id") + " UNION ALL " + ENTITY_SQL.format("conversations", "conv_id * 1000 + turn"))
def re_extract_entities(t):
    notes = t.documents.select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"), "text").unionByName(
        t.conversations.select(F.lit("conversations").alias("src"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    )
    return notes.select("src", "id", *[c.alias(n) for n, c in T.entities("text").items()])


# ------------------------------------------------------------------ dates
@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso_day, strftime(o_orderdate, '%Y-%m-%d') AS custom_day FROM orders")
def dt_parse(t):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    custom = F.date_format("o_orderdate", "dd/MM/yyyy")
    return t.orders.select("o_orderkey", iso(D.parse_date(text)).alias("iso_day"), iso(D.parse_date(custom, "dd/MM/yyyy")).alias("custom_day"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders")
def dt_parse_mixed(t):
    mixed = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "MM-dd-yyyy"))
        .otherwise("not a date")
    )
    return t.orders.select("o_orderkey", iso(D.parse_mixed(mixed)).alias("parsed"))


@query("""SELECT o_orderkey, year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, day(o_orderdate)::INT AS d, dayname(o_orderdate) AS weekday FROM orders""")
def dt_parts(t):
    c = "o_orderdate"
    return t.orders.select("o_orderkey", F.year(c).alias("y"), F.month(c).alias("m"), F.day(c).alias("d"), F.date_format(c, "EEEE").alias("weekday"))


@query("SELECT o_orderkey, datediff('day', CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END, DATE '2002-01-01')::INT AS days FROM orders")
def dt_diff_days(t):
    known = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate"))
    return t.orders.select("o_orderkey", D.days_since(REF_DATE, known).alias("days"))


@query("SELECT o_orderkey, strftime(o_orderdate::DATE + 30, '%Y-%m-%d') AS due FROM orders")
def dt_add_days(t):
    return t.orders.select("o_orderkey", iso(F.date_add(F.to_date("o_orderdate"), 30)).alias("due"))


LATE_SQL = """WITH first_ship AS (SELECT l_orderkey, min(l_shipdate)::DATE AS paid FROM lineitem GROUP BY 1),
  d AS (SELECT o_orderkey, greatest(datediff('day', o_orderdate::DATE, paid), 0) AS late FROM orders JOIN first_ship ON l_orderkey = o_orderkey)"""


@query(LATE_SQL + """SELECT o_orderkey, late::INT AS days_late, CASE WHEN late <= 0 THEN 'On Time' WHEN late <= 15 THEN 'Minor Delay' WHEN late <= 30 THEN 'Late'
          ELSE 'Severely Delinquent' END AS band, CASE WHEN late <= 0 THEN 'On Time' WHEN late <= 30 THEN 'Late' ELSE 'Severely Delinquent' END AS status FROM d""")
def dt_days_late(t):
    paid = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.to_date(F.min("l_shipdate")).alias("paid"))
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("due")).join(paid, "o_orderkey")
    late = rows.select("o_orderkey", D.days_late("paid", "due").alias("days_late"))
    return late.withColumns({"band": D.delay_status("days_late"), "status": D.payment_status("days_late")})


@query("SELECT o_orderkey, ((2002 - year(o_orderdate)) * 12 + (1 - month(o_orderdate)))::INT AS age_months FROM orders")
def dt_age_months(t):
    return t.orders.select("o_orderkey", D.age_months(REF_DATE, "o_orderdate").alias("age_months"))


@query("SELECT o_orderkey, round_even(datediff('day', o_orderdate::DATE, DATE '2002-01-01') / 365.0, 1)::DOUBLE AS age_years FROM orders WHERE round_even(datediff('day', o_orderdate::DATE, DATE '2002-01-01') / 365.0, 1) < 2")
def dt_age_years(t):
    aged = t.orders.select("o_orderkey", D.age_years(REF_DATE, F.to_date("o_orderdate")).alias("age_years"))
    return aged.filter("age_years < 2")


@query("SELECT o_orderkey, strftime(o_orderdate, '%B %d, %Y') AS long_date FROM orders")
def dt_format(t):
    return t.orders.select("o_orderkey", D.long_date("o_orderdate").alias("long_date"))


@query("SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day FROM orders GROUP BY 1")
def dt_minmax(t):
    return t.orders.groupBy("o_custkey").agg(iso(F.min("o_orderdate")).alias("first_day"), iso(F.max("o_orderdate")).alias("last_day"))


# ------------------------------------------------------------------ math
@query("""SELECT event_id, round(sqrt(value), 6) AS root, floor(value)::BIGINT AS fl, ceil(value)::BIGINT AS ce, round(pi() * value, 6) AS times_pi,
          round_even(value, 0) AS half_even, abs(value - 50) AS dist, round(ln(1 + value), 6) AS log1p FROM events""")
def math_basic(t):
    v = F.col("value")
    return t.events.select(
        "event_id", r(F.sqrt(v)).alias("root"), F.floor(v).alias("fl"), F.ceil(v).alias("ce"), r(F.pi() * v).alias("times_pi"),
        round_half_even(v).alias("half_even"), F.abs(v - 50).alias("dist"), r(F.log1p(v)).alias("log1p"),
    )


# ------------------------------------------------------------------ arrays and maps
def joined(a):
    return F.array_join(a.cast("array<string>"), ",")


@query("""SELECT p_partkey, array_to_string(list_transform(range(3), lambda x: '0'), ',') AS zeros, array_to_string(range(0, p_size, 5), ',') AS steps,
          round(p_retailprice * 0.75 + p_size * 0.25, 6) AS second FROM part""")
def arr_vector(t):
    line = A.linspace(F.col("p_retailprice"), F.col("p_size").cast("double"), 5)
    steps = A.arange(0, F.col("p_size"), 5)
    return t.part.select(
        "p_partkey", joined(F.array_repeat(F.lit(0), 3)).alias("zeros"), joined(steps).alias("steps"), r(F.get(line, F.lit(1))).alias("second")
    )


WEIGHTS = [((i * 37) % 11 - 5) / 10 for i in range(64)]


@query(f"""SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: embedding[i]::DOUBLE * ({WEIGHTS}::DOUBLE[])[i])), 5) AS score FROM embeddings""")
def arr_dot(t):
    return t.embeddings.select("vec_id", r(A.dot_weights("embedding", WEIGHTS), 5).alias("score"))


@query("""WITH c AS (SELECT list(m ORDER BY i) AS centre FROM (SELECT i, avg(x) AS m FROM (SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1))
          SELECT vec_id, round(sqrt(list_sum(list_transform(range(1, 65), lambda i: pow(embedding[i]::DOUBLE - centre[i], 2)))), 5) AS dist,
          round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 5) AS norm FROM embeddings, c""")
def arr_distance(t):
    rows = t.embeddings.withColumn("centre", per_position(t.embeddings, "embedding", F.avg))
    return rows.select("vec_id", r(A.distance("embedding", "centre"), 5).alias("dist"), r(A.norm("embedding"), 5).alias("norm"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity + l_extendedprice + l_discount + l_tax, 6) AS total FROM lineitem""")
def arr_stack_cols(t):
    v = A.vector("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r(A.total(v)).alias("total"))


@query("""SELECT vec_id, len(list_filter(embedding, lambda x: x > 0))::INT AS n_pos, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * 2)), 5) AS doubled,
          len(list_filter(list_transform(embedding, lambda x: CASE WHEN x > 0.1 THEN 'H' ELSE 'L' END), lambda s: s = 'H'))::INT AS n_high FROM embeddings""")
def arr_comprehension(t):
    e = F.col("embedding")
    labels = F.transform(e, lambda x: F.when(x > 0.1, "H").otherwise("L"))
    return t.embeddings.select(
        "vec_id", F.size(F.filter(e, lambda x: x > 0)).alias("n_pos"),
        r(A.total(F.transform(e, lambda x: x.cast("double") * 2)), 5).alias("doubled"), A.count_in(labels, "H").alias("n_high"),
    )


@query("""SELECT page_id, array_to_string(list_filter(flatten(list_transform(string_split(url, '/'), lambda p: string_split(p, '.'))), lambda x: x <> ''), '|') AS flat FROM pages""")
def arr_flatten(t):
    nested = F.transform(F.split("url", "/"), lambda p: F.split(p, "[.]"))
    return t.pages.select("page_id", F.array_join(F.filter(F.flatten(nested), lambda x: x != ""), "|").alias("flat"))


WORDS_SQL = "list_filter(string_split(p_name, ''), lambda c: c <> '')"


@query(f"""SELECT p_partkey, array_to_string(list_sort(list_distinct({WORDS_SQL})), '') AS letters, list_contains({WORDS_SQL}, 'a') AS has_a,
          coalesce(list_position({WORDS_SQL}, 'e') - 1, -1)::BIGINT AS first_e, len(list_filter({WORDS_SQL}, lambda c: c = 'l'))::INT AS n_l FROM part""")
def arr_set(t):
    c = T.characters("p_name")
    return t.part.select(
        "p_partkey", F.array_join(F.array_sort(F.array_distinct(c)), "").alias("letters"), F.array_contains(c, "a").alias("has_a"),
        A.index_in(c, "e").alias("first_e"), A.count_in(c, "l").alias("n_l"),
    )


@query("""SELECT p_partkey, array_to_string(list_append(string_split(p_name, ' '), 'x'), ',') AS appended, array_to_string(['y'] || string_split(p_name, ' '), ',') AS inserted,
          array_to_string(list_filter(string_split(p_name, ' '), lambda w: w <> 'red'), ',') AS removed, array_to_string(string_split(p_name, ' ') || [p_type], ',') AS joined,
          string_split(p_name, ' ')[-1] AS popped FROM part""")
def arr_edit(t):
    w = F.split("p_name", " ")
    return t.part.select(
        "p_partkey", F.array_join(F.array_append(w, "x"), ",").alias("appended"), F.array_join(F.array_insert(w, 1, "y"), ",").alias("inserted"),
        F.array_join(F.array_remove(w, "red"), ",").alias("removed"), F.array_join(F.concat(w, F.array("p_type")), ",").alias("joined"),
        F.element_at(w, -1).alias("popped"),
    )


@query("SELECT vec_id, round(list_avg(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS mean FROM embeddings")
def arr_mean(t):
    return t.embeddings.select("vec_id", r(A.mean("embedding")).alias("mean"))


@query("""SELECT vec_id, len(list_filter(embedding, lambda x: x > 0.05))::INT AS n_high, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * 2)), 5) AS doubled_sum FROM embeddings""")
def arr_matrix_map(t):
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, 8))
    m = t.embeddings.select("vec_id", rows.alias("m"))
    labelled = A.matrix_map("m", lambda x: F.when(x > 0.05, "High").otherwise("Low"))
    doubled = A.matrix_map("m", lambda x: x.cast("double") * 2)
    return m.select("vec_id", A.count_in(F.flatten(labelled), "High").alias("n_high"), r(A.total(F.flatten(doubled)), 5).alias("doubled_sum"))


def event_map(t):
    """Every event's fields as a string map."""
    m = F.create_map(F.lit("type"), "event_type", F.lit("user"), F.col("user_id").cast("string"))
    return t.events.select("event_id", "event_type", "user_id", m.alias("m"))


@query("""SELECT event_id, event_type AS type, 'none' AS absent, true AS has_user, 'type,user' AS ks, event_type || ',' || user_id AS vs FROM events""")
def map_access(t):
    m = F.col("m")
    return event_map(t).select(
        "event_id", A.map_get(m, "type").alias("type"), A.map_get(m, "plan", "none").alias("absent"), F.map_contains_key(m, "user").alias("has_user"),
        F.array_join(F.map_keys(m), ",").alias("ks"), F.array_join(F.map_values(m), ",").alias("vs"),
    )


@query("""SELECT event_id, 'new:' || user_id AS user_after, event_type AS type_after, 'x' AS added, 2 AS size_after_drop FROM events""")
def map_edit(t):
    update = F.create_map(F.lit("user"), F.concat(F.lit("new:"), F.col("user_id").cast("string")), F.lit("extra"), F.lit("x"))
    merged = A.merge_maps("m", update)
    return event_map(t).select(
        "event_id", A.map_get(merged, "user").alias("user_after"), A.map_get(merged, "type").alias("type_after"),
        A.map_get(merged, "extra").alias("added"), F.size(A.drop_key(merged, "extra")).alias("size_after_drop"),
    )


@query("""SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS n_large, round(c_acctbal * 2, 6) AS doubled, 'nation' AS inverted FROM customer""")
def map_comprehension(t):
    balances = F.create_map(F.lit("bal"), "c_acctbal")
    codes = F.create_map(F.lit("nation"), "c_nationkey")
    return t.customer.select(
        "c_custkey", F.size(F.map_filter(balances, lambda k, v: v > 5000)).alias("n_large"),
        r(A.map_get(F.transform_values(balances, lambda k, v: v * 2), "bal")).alias("doubled"),
        F.element_at(A.invert_map(codes), F.col("c_nationkey")).alias("inverted"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'charge' AS grp, 'discount' AS item, l_discount AS amount FROM lineitem
          UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'charge', 'tax', l_tax FROM lineitem
          UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'size', 'quantity', l_quantity FROM lineitem""")
def map_flatten(t):
    charge = F.create_map(F.lit("discount"), "l_discount", F.lit("tax"), "l_tax")
    nested = F.create_map(F.lit("charge"), charge, F.lit("size"), F.create_map(F.lit("quantity"), "l_quantity"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    outer = t.lineitem.select(*keys, F.explode(nested).alias("grp", "inner"))
    return outer.select(*keys, "grp", F.explode("inner").alias("item", "amount"))


@query("SELECT c_custkey, c_name AS owner, c_acctbal AS balance, c_mktsegment AS segment FROM customer")
def struct_access(t):
    account = F.struct(F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("owner"), F.col("c_acctbal").alias("balance"))
    rows = t.customer.select("c_custkey", account.alias("account"))
    return rows.select("c_custkey", F.col("account.owner.name").alias("owner"), "account.balance", "account.owner.segment")
