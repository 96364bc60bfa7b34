"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Built-in expressions only. The steps:

1. Documents of a source are laid out on one word axis in a seeded order. Offsets come from windows
   over bins of a few thousand documents plus the offsets of the bins, so a source that holds a
   third of all rows is never sorted in one task.
2. The axis is cut into blocks of equal words; a block may begin or end inside a document. A source
   whose target is T words and whose blocks have B words gets the exact quota round(T / B) of block
   draws. Blocks are permuted by an affine map, so no sort is needed: draw d takes the block of
   rank d mod n, and ranks repeat only after every block had its turn.
3. The vector of quotas is the root of a binary tree whose leaves are the output shards. A node
   gives its left child a multivariate-hypergeometric part: source by source a hypergeometric
   number, drawn by inversion from a hash of (seed, node, source), given what earlier sources took.
   Shares are exact at every node, and leaves sum to the quotas.
4. A shard takes a consecutive, hence disjoint, range of each source's draws, and orders its pieces
   by a hash. What a document contributes is read off its shards.

The depth of the tree follows from the words: a shard holds ``SHARD_WORDS`` at most.

Defined results: a null text has size 0; the null source is a source of its own, after all others;
empty documents and sources are never taken; repeated rows are separate documents; an empty table
gives an empty mix. Hashes decide everything, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import materialize

WORDS = r"[^\x20\x09-\x0D]+"
#: A source is cut into at least this many blocks (if it has the words), of at most MAX_BLOCK words.
BLOCKS, MAX_BLOCK = 256, 16384
#: Documents per bin of the word axis.
BIN = 4096
#: Shards there are at least, as a power of two, and words a shard is meant to hold at most.
LEAST_DEPTH, SHARD_WORDS = 4, 1 << 25
#: Numbers in the plan of all sources (one for each shard, a few more) up to which it is broadcast.
BROADCAST_NUMBERS = 1_000_000
#: Multipliers of the block permutation: primes, so one that does not divide n is coprime to it.
PRIMES = (2654435761, 2246822519, 3266489917, 668265263, 374761393)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple, cap: float) -> DataFrame:
    """Each source with its words, weight and target; ``sizes`` has source and size.

    The target is ``min(cap * words, weight * level)``. With sources in order of the level at which
    they fill up, the common level is the largest of (what is left) / (weights left).
    """
    listed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    listed = listed.withColumn("place", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    whole = Window.partitionBy()
    fill = Window.orderBy(F.col("most") / F.col("weight"), "place")
    return (
        listed.withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(cap)))
        .withColumn("total", F.sum("source_size").over(whole).cast("double"))
        .withColumn("filled", F.sum("most").over(fill.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("open", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.coalesce("filled", F.lit(0.0))) / F.col("open"))
        .withColumn("target", F.least("most", F.col("weight") * F.max("level").over(whole)))
        .select("source", "place", "source_size", "docs", "weight", "target")
    )


def hypergeometric(n: Column, marked: Column, total: Column, u: Column) -> Column:
    """How many of ``n`` items, drawn without replacement from ``total``, are among the ``marked``.

    Inversion of ``u`` in [0, 1) over the support within 12 standard deviations and 12 steps of the
    mode; what lies outside is below the resolution of a double.
    """
    to = lambda c: c.cast("double")
    share = to(marked) / F.greatest(to(total), F.lit(1.0))
    spread = F.sqrt(to(n) * share * (1 - share)) * 12 + 12
    middle = F.floor(to(n + 1) * to(marked + 1) / to(total + 2))
    low = F.greatest(F.lit(0), n - (total - marked), F.least(middle - F.ceil(spread), n, marked)).cast("long")
    high = F.greatest(low, F.least(n, marked, middle + F.ceil(spread)).cast("long"))
    # weight of k + 1 from that of k, with the lowest k at 1
    ratio = lambda k: to(marked - k) * to(n - k) / (to(k + 1) * to(total - marked - n + k + 1))
    start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("t"))
    weigh = lambda s, k: F.struct((s["w"] * ratio(k)).alias("w"), (s["t"] + s["w"]).alias("t"))
    sum_of = F.aggregate(F.sequence(low, high), start, weigh)["t"]
    seek = F.struct(F.lit(1.0).alias("w"), (u * sum_of).alias("t"), low.alias("at"), F.lit(False).alias("done"))
    step = lambda s, k: F.when(s["done"], s).otherwise(
        F.struct(
            (s["w"] * ratio(k)).alias("w"), (s["t"] - s["w"]).alias("t"), k.alias("at"), (s["t"] < s["w"]).alias("done")
        )
    )
    return F.aggregate(F.sequence(low, high), seek, step)["at"]


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0**-53)


def split_quotas(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """Exact quotas per shard: (shard, quotas) for the 2^depth leaves of the splitting tree.

    ``quotas`` is one row with an array of quotas, one per source in order.
    """
    nodes = quotas.select(F.lit(0).cast("long").alias("shard"), "quotas")
    for level in range(depth):
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda s, q: s + q)
        start = F.struct(
            F.floor(total / 2).cast("long").alias("n"),
            total.alias("total"),
            F.array().cast("array<bigint>").alias("out"),
        )

        def draw(s, q):
            u = _uniform(F.lit(seed), F.lit(level), F.col("shard"), F.size(s["out"]))
            x = hypergeometric(s["n"], q, s["total"], u)
            return F.transform(
                F.array(x),
                lambda v: F.struct(
                    (s["n"] - v).alias("n"), (s["total"] - q).alias("total"), F.concat(s["out"], F.array(v)).alias("out")
                ),
            )[0]

        nodes = (
            nodes.withColumn("left", F.aggregate("quotas", start, draw)["out"])
            .withColumn("right", F.zip_with("quotas", "left", lambda q, x: q - x))
            .select(
                F.explode(
                    F.array(
                        F.struct((F.col("shard") * 2).alias("shard"), F.col("left").alias("quotas")),
                        F.struct((F.col("shard") * 2 + 1).alias("shard"), F.col("right").alias("quotas")),
                    )
                ).alias("n")
            )
            .select("n.shard", "n.quotas")
        )
    return nodes


def plan_mix(sizes: DataFrame, weights=(5, 2, 1), cap: float = 3.0, depth: int = LEAST_DEPTH, seed: int = 9) -> DataFrame:
    """One row per source: target, block size, number of blocks, quota, permutation, and ``ends``,
    the running quotas of the shards."""
    plan = (
        targets(sizes, weights, cap)
        .withColumn("block", F.expr(f"greatest(1L, least({MAX_BLOCK}L, source_size div {BLOCKS}L))"))
        .withColumn("blocks", F.expr("(source_size + block - 1) div block"))
        .withColumn("quota", F.least(F.round(F.col("target") / F.col("block")).cast("long"), F.col("blocks") * int(cap)))
    )
    prime = F.coalesce(*[F.when(F.col("blocks") % p != 0, F.lit(p).cast("long")) for p in PRIMES], F.lit(1).cast("long"))
    plan = plan.withColumn("factor", prime).withColumn(
        "shift", F.pmod(F.xxhash64(F.lit(seed), F.col("place")), F.greatest("blocks", F.lit(1)))
    )
    plan = materialize(plan, "mix-plan")
    root = plan.agg(F.array_sort(F.collect_list(F.struct("place", "quota"))).alias("a")).select(
        F.transform("a", lambda s: s["quota"]).alias("quotas")
    )
    per_shard = split_quotas(root, depth, seed).select("shard", F.posexplode("quotas").alias("place", "part"))
    ends = (
        per_shard.withColumn(
            "end", F.sum("part").over(Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))
        )
        .groupBy("place")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "end"))), lambda s: s["end"]).alias("ends"))
    )
    return plan.join(ends, "place")


def mix(
    documents: DataFrame, weights=(5, 2, 1), cap: float = 3.0, depth: int | None = None, seed: int = 9, key: str = "doc_id"
) -> DataFrame:
    """Every document with its size, source_size, target, taken words, ``shards`` and ``pieces``.

    A piece is (shard, order, epoch, first, words): ``words`` words from the one numbered ``first``
    (0-based) go to ``shard``, in place ``order``. ``shards`` has (shard, words) in order of shards, and
    ``taken`` is their sum. ``row`` tells rows of the same key apart.
    """
    sizes = materialize(
        documents.select(
            F.col(key).alias("doc"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
            F.xxhash64(F.lit(seed), F.col(key), F.col("text")).alias("row"),
        ),
        "mix-sizes",
    )
    if depth is None:
        words = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        depth = max(LEAST_DEPTH, (-(-words // SHARD_WORDS) - 1).bit_length())
    plan = materialize(plan_mix(sizes, weights, cap, depth, seed), "mix-plan")
    small = plan.count() * ((1 << depth) + 16) <= BROADCAST_NUMBERS
    plan = F.broadcast(plan) if small else plan
    docs = sizes.withColumnRenamed("source", "own")
    binned = docs.join(plan, F.col("own").eqNullSafe(F.col("source"))).withColumn(
        "bin", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("row")), F.ceil(F.col("docs") / BIN).cast("long"))
    )
    within = Window.partitionBy("place", "bin").orderBy("row", "doc", "size").rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.groupBy("place", "bin").agg(F.sum("size").alias("words"))
    along = Window.partitionBy("place").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select("place", "bin", F.coalesce(F.sum("words").over(along), F.lit(0)).alias("before"))
    laid = binned.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(bins, ["place", "bin"])
    laid = laid.withColumn("at", F.col("before") + F.col("inside"))

    rank = lambda b: F.pmod(b * F.col("factor") + F.col("shift"), F.col("blocks"))


    def shard(d: Column) -> Column:
        """How many of the 2^depth running quotas lie at or below draw ``d``, by binary search."""
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(depth))]) if depth else F.array().cast("array<int>")
        # the last of them is the quota itself, which no draw reaches
        return F.aggregate(steps, F.lit(0), lambda at, n: F.when(F.get("ends", at + n - 1) <= d, at + n).otherwise(at))

    touched = F.expr("case when size > 0 then sequence(at div block, (at + size - 1) div block) else array() end")

    def drawn(b: Column) -> Column:
        """The pieces of the document in block ``b``, one for each time the block is drawn."""
        first = F.greatest(F.col("at"), b * F.col("block")) - F.col("at")
        words = F.least(F.col("at") + F.col("size"), (b + 1) * F.col("block")) - F.col("at") - first
        epochs = F.expr("sequence(0L, quota div blocks)")
        draws = F.filter(
            F.transform(epochs, lambda e: e * F.col("blocks") + rank(b)), lambda d: d < F.col("quota")
        )
        return F.transform(
            draws,
            lambda d: F.struct(
                shard(d).alias("shard"),
                F.xxhash64(F.lit(seed + 2), F.col("place"), d).alias("order"),
                F.floor(d / F.col("blocks")).cast("int").alias("epoch"),
                first.alias("first"),
                words.alias("words"),
            ),
        )

    held = F.array_sort(F.array_distinct(F.transform("pieces", lambda p: p["shard"])))
    total = lambda pieces: F.aggregate(pieces, F.lit(0).cast("long"), lambda s, p: s + p["words"])
    by_shard = F.transform(
        held, lambda h: F.struct(h.alias("shard"), total(F.filter("pieces", lambda p: p["shard"] == h)).alias("words"))
    )
    laid = laid.withColumn("pieces", F.flatten(F.transform(touched, drawn))).withColumn("shards", by_shard)
    return laid.select(
        F.col("doc").alias(key),
        F.col("own").alias("source"),
        "row",
        "size",
        "source_size",
        "target",
        total(F.col("shards")).alias("taken"),
        "shards",
        "pieces",
    )


def shards(mixed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The pieces in shard order: a shard's rows share a partition and are shuffled within it."""
    pieces = mixed.select(key, "source", "row", F.explode("pieces").alias("p")).select(key, "source", "row", "p.*")
    return pieces.repartition("shard").sortWithinPartitions("shard", "order", "row", "first")
