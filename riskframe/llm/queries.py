"""The operators bound to the standard tables with production parameters, and SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import (
    ann, bpe, lsh_forest, mixing, periodic_runs, pii, simhash, source_audit, substring_dedup,
    token_files, topk, toxicity, url_filter,
)

#: (host, path, verdict) of the URL rules.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_block_matrix_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(), end=1)


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def url_rules(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS r(host, path, verdict)")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_rules(spark))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.extract(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "added")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=13)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3, seed=42)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")), threshold=0.3)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), cap=3)
    parts = F.transform("shards", lambda s: F.concat_ws(":", s["shard"], s["words"]))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.array_join(parts, ",").alias("shards"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())


def looped(documents: DataFrame) -> DataFrame:
    """(doc_id, text), where the ending of every tenth document, by a hash of its id, repeats itself.

    With h = crc32(doc_id), g = h div 10 and n words: if h ends in 0, word i >= a = g mod n becomes
    word a + (i - a) mod p, where p = 1 + (n - a) div (3 + g mod 8). Words are joined by a blank.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = documents.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    n = F.size("w").cast("long")
    chosen = chosen.select("doc_id", "text", "w", "g", n.alias("n"), (F.col("g") % n).alias("a"))
    chosen = chosen.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, w[cast(a + (i - a) % p as int)])), ' ')")
    return chosen.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.find_runs(looped(table(spark, sf_dir, "documents")), exponent=4, least=6)


def op12_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, shape=lsh_forest.shape((80, 100)))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergence(table(spark, sf_dir, "documents"), min_docs=3, scale=10**9, alpha=1, top=200)


QUERIES = {
    f.__name__: f
    for f in (
        op1_block_matrix_ann, op2_token_files, op3_exact_top_k, op4_url_filter, op5_pii, op6_substring_dedup,
        op7_simhash, op8_toxicity, op9_mixing, op10_bpe, op11_periodic_runs,
        op12_lsh_forest, op13_source_audit,
    )
}

_USABLE = "len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_TOP = """
WITH v AS (SELECT vec_id, {vector} AS v FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND {usable}),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, {score} AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL = {
    "op1_block_matrix_ann": _TOP.format(
        vector="embedding",
        usable=_USABLE + " AND len(list_filter(embedding, lambda x: x <> 0)) > 0",
        # the double sum in the order of the components
        score="list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: CAST(q.v[i] AS DOUBLE) * CAST(c.v[i] AS DOUBLE)), lambda a, b: a + b)",
    ),
    "op3_exact_top_k": _TOP.format(
        vector="list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT))",
        usable=_USABLE,
        score="CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT)",
    ),
    "op4_url_filter": f"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(map(str, RULES))}),
p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
m AS (SELECT p.host, p.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
      FROM (SELECT DISTINCT host, path FROM p) p JOIN rules r
        ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
      GROUP BY p.host, p.path)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.host = m.host AND p.path = m.path
""",
    "op6_substring_dedup": r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
m AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM g) WHERE least < doc_id),
x AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM m)),
c AS (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id),
k AS (SELECT u.doc_id, string_agg(u.word, ' ' ORDER BY u.p) AS kept
      FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) u
      LEFT JOIN x ON x.doc_id = u.doc_id AND x.p = u.p WHERE x.p IS NULL GROUP BY u.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
""",
    "op11_periodic_runs": r"""
WITH RECURSIVE t AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w, row_number() OVER () AS k FROM documents),
-- crc32 by its bytes: 0xEDB88320 in eight steps a byte
c AS (SELECT k, 4294967295::BIGINT AS c, 0 AS i, encode(CAST(doc_id AS VARCHAR)) AS b FROM t WHERE doc_id IS NOT NULL
      UNION ALL
      SELECT k, list_reduce(list_prepend(xor(c, ('0x' || hex(b[i + 1 : i + 1]))::BIGINT), range(8)), lambda x, y: xor(x >> 1, (x & 1) * 3988292384)), i + 1, b
      FROM c WHERE i < octet_length(b)),
h AS (SELECT k, xor(c, 4294967295) AS h FROM c WHERE i = octet_length(b)),
g AS (SELECT t.k, doc_id, w, len(w) AS n, h, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM t LEFT JOIN h ON h.k = t.k),
d AS (SELECT k, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w FROM g),
u AS (SELECT k, n, unnest(w) AS x, unnest(range(n)) AS i FROM d),
-- places that equal the one q later, and their stretches
e AS (SELECT a.k, a.n, b.i - a.i AS q, a.i FROM u a JOIN u b ON a.k = b.k AND a.x = b.x AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
s AS (SELECT k, q, min(i) AS s, max(i) + 1 + q AS e FROM (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS o FROM e) GROUP BY k, q, o HAVING count(*) >= 3 * q),
r AS (SELECT k, s, q, e - s AS l FROM s x WHERE e - s >= 6 AND NOT EXISTS
      (SELECT 1 FROM s y WHERE y.k = x.k AND y.q < x.q AND x.q % y.q = 0 AND y.s <= x.s AND y.e >= x.e)),
b AS (SELECT k, count(*) AS n, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS runs,
             min_by({'s': s, 'l': l, 'q': q}, (-(l::DOUBLE / q), s, q)) AS top FROM r GROUP BY k),
o AS (SELECT DISTINCT k, unnest(range(s + q, s + l)) AS i FROM r),
j AS (SELECT u.k, string_agg(u.x, ' ' ORDER BY u.i) AS kept FROM u LEFT JOIN o ON o.k = u.k AND o.i = u.i WHERE o.i IS NULL GROUP BY u.k)
SELECT d.doc_id, coalesce(b.n, 0) AS n_runs, b.top.s AS start, b.top.l AS length, b.top.q AS period, 1000 * b.top.l // b.top.q AS exponent_milli,
       sha256(coalesce(b.runs, '')) AS runs_sha256, sha256(coalesce(j.kept, '')) AS collapsed_sha256
FROM d LEFT JOIN b ON b.k = d.k LEFT JOIN j ON j.k = d.k
""",
    "op12_lsh_forest": rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT k, doc_id, CASE WHEN len(w) = 1 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d),
g AS (SELECT k, len(s) AS n, unnest(s) AS g FROM s),
e AS (SELECT a.k AS a, b.k AS b FROM g a JOIN g b ON a.g = b.g AND a.k <> b.k AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
      GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT k AS a, k AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT r.a AS k, min(d.doc_id) AS component_id FROM r JOIN d ON d.k = r.b GROUP BY r.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id IS NOT DISTINCT FROM c.component_id AS kept
FROM s JOIN c ON c.k = s.k
""",
    "op13_source_audit": rf"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (SELECT k, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
v AS (SELECT lang, term, count(*) AS c FROM t GROUP BY ALL HAVING count(DISTINCT k) >= 3),
c AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN v USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, CAST(sum(c) AS HUGEINT) AS n, count(*) AS v FROM v GROUP BY lang),
n AS (SELECT lang, source, CAST(sum(c) AS HUGEINT) AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, v.term, coalesce(c.c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(c.c, 0) + 1) // (coalesce(n.n, 0) + l.v) AS p,
             1 + 1000000000::HUGEINT * (v.c + 1) // (l.n + l.v) AS q
      FROM g JOIN v USING (lang) JOIN l USING (lang) LEFT JOIN n USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE c > 0 AND p > q),
x AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM x WHERE part = 'pair' OR rank <= 200
""",
}
