"""URL rules through a blocked Bloom filter and an exact hash join; built-in expressions only.

A rule is a canonical URL prefix: a lower-case host, which stands for itself and its subdomains, and
a path prefix. A URL is looked up under every (host suffix, path prefix) that has the *shape* of
some rule, that is as many labels and as many path characters. Most look-ups miss: each probes a
blocked Bloom filter (one 64-bit block per key, four bits in it), whose size is bounded, so it is
broadcast. What passes goes to an exact hash join with the rules, which removes false positives.

Defined results: a null URL, an empty one or one without ``://`` has an empty host and path; a URL
without a matching rule gets ``default``; of rules of equal length the one with the longer host
wins; a rule listed twice with both verdicts blocks. Repeated rows are each judged. No rules: every
URL gets ``default``. Only the key and URL columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the broadcast filter: 2^17 blocks of 8 bytes with their numbers, 2 MB. A longer list
#: only lets more false positives through to the join.
MAX_BLOCKS = 1 << 17
URL_PARTS = r"://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 2)


def _block(host: str, path: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(host, path), F.lit(blocks))


def _mask(host: str, path: str) -> Column:
    # seeded apart from the block number
    bits = F.xxhash64(F.lit("bits"), host, path)
    mask = F.lit(0).cast("long")
    for i in range(4):
        place = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def bloom_filter(rules: DataFrame, blocks: int) -> DataFrame:
    """(block, bits) of the listed (rule_host, rule_path); at most ``blocks`` rows."""
    return rules.groupBy(_block("rule_host", "rule_path", blocks).alias("block")).agg(
        F.bit_or(_mask("rule_host", "rule_path")).alias("bits")
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """``key``, host, path, rule (``host + path`` of the longest that fits, or null) and verdict.

    ``rules`` has host, path and verdict (``allow`` or ``block``).
    """
    parts = pages.select(F.col(key), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    rules = (
        rules.where("host is not null and path is not null")
        .groupBy(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"))
        .agg(F.max("verdict").alias("rule_verdict"))
    )
    listed = rules.count()
    blocks = 64
    while blocks < MAX_BLOCKS and blocks * 4 < listed:
        blocks *= 2
    # as many shapes as the longest rule has labels times characters, however long the list is
    shapes = [
        (r.labels, r.chars)
        for r in rules.select(
            F.size(F.split("rule_host", r"\.", -1)).alias("labels"), F.length("rule_path").alias("chars")
        )
        .distinct()
        .collect()
    ]
    if not shapes:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    shape = F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(b).alias("chars")) for a, b in sorted(shapes)])
    probes = (
        parts.select("host", "path")
        .distinct()
        .withColumn("s", F.explode(shape))
        .where("s.labels <= size(split(host, '[.]', -1)) and s.chars <= length(path)")
        .withColumn("rule_host", F.expr("substring_index(host, '.', -s.labels)"))
        .withColumn("rule_path", F.expr("left(path, s.chars)"))
        .drop("s")
    )
    possible = (
        probes.withColumn("block", _block("rule_host", "rule_path", blocks))
        .join(F.broadcast(bloom_filter(rules, blocks)), "block")
        .where(F.col("bits").bitwiseAND(_mask("rule_host", "rule_path")) == _mask("rule_host", "rule_path"))
        .drop("block", "bits")
    )
    best = (
        possible.join(rules, ["rule_host", "rule_path"])
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    F.length(F.concat("rule_host", "rule_path")).alias("n"),
                    F.length("rule_host").alias("h"),
                    F.concat("rule_host", "rule_path").alias("rule"),
                    F.col("rule_verdict").alias("verdict"),
                )
            ).alias("best")
        )
    )
    return parts.join(best, ["host", "path"], "left").select(
        key, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
