"""SimHash near duplicates: a binary-trie self-join over fingerprints, and connected components.

A fingerprint has bit i set if more than half of the hashes of the text's word shingles have it.
Equal fingerprints are grouped first, so copies cost one fingerprint however many there are. Two
distinct fingerprints within ``distance`` <= 3 bits agree in at least one of four 16-bit blocks, so
four rotations, each dealt by its leading block, meet every pair. Within a block the fingerprints
form a binary trie. The join traverses pairs of its nodes together: a pair of nodes splits into the
pairs of their children, differing bits add up, and a pair beyond the budget is pruned.

Tries too large for a task take their next six levels as a Spark job (``_deal``): node pairs become
tasks of their own with the budget that is left, until every task is small. A task links each
fingerprint to the smallest one it reaches, so a dense group yields as many links as members, never
all pairs. Components over these links come from alternating large-star and small-star steps, each
written to the shared folder; nothing but row counts reaches the driver.

Defined results: a null or empty text has fingerprint 0 and links like any other; texts with fewer
words than a shingle are one shingle; repeated rows and ids all return; a component without an id
has a null ``component_id``; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import frugal, materialize, ship_package

#: Members of a node pair beyond which it is split by a Spark job rather than in a task.
TASK_MEMBERS = 200_000
#: Fingerprints aimed at for each partition of the trie join.
PARTITION_MEMBERS = 100_000
#: Trie levels that one splitting job takes.
LEVELS = 6
#: Node pairs with at most this many fingerprint pairs are compared directly.
LEAF = 64


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash over XXH64 of space-joined word shingles, A-Z lower-cased."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    starts = [0, *(ends[: -shingle] + 1).tolist()]
    ends = ends[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends)], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(documents: DataFrame, shingle: int = 3, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """(key, fp) for every document; ``fp`` is the fingerprint as a signed long."""
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)]
            column = pa.array(np.array(fps, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], [key, "fp"])

    chosen = documents.select(key, F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(frugal(run), f"`{key}` {chosen.schema[key].dataType.simpleString()}, fp long")


def _deal(classes: DataFrame, distance: int, limit: int) -> DataFrame:
    """Members of the node pairs to join in tasks: (task, depth, budget, side, fp, turned).

    ``side`` is 0 in a pair of a node with itself, 1 and 2 in a pair of two nodes. ``turned`` is
    the rotated fingerprint, whose first ``depth`` bits the traversal has behind it.
    """
    turn = F.explode(F.sequence(F.lit(0), F.lit(48), F.lit(16))).alias("turn")
    tasks = (
        classes.select("fp", turn)
        .withColumn("turned", F.expr("shiftleft(fp, turn) | (case when turn = 0 then 0L else shiftrightunsigned(fp, 64 - turn) end)"))
        .select(
            F.xxhash64("turn", F.shiftrightunsigned("turned", 48)).alias("task"),
            F.lit(16).alias("depth"), F.lit(distance).alias("budget"), F.lit(0).alias("side"), "fp", "turned",
        )
    )
    done = []
    while True:
        sizes = tasks.groupBy("task").count().where(F.col("count") > limit).select("task")
        depth = 16 + LEVELS * len(done)
        if depth + LEVELS > 64 or not sizes.take(1):
            break
        large = materialize(sizes, "simhash-large")
        done.append(tasks.join(large, "task", "left_anti"))
        masks = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(m.bit_count()).alias("n")) for m in range(1 << LEVELS) if m.bit_count() <= distance])
        chunk = F.shiftrightunsigned("turned", 64 - depth - LEVELS).bitwiseAND(F.lit((1 << LEVELS) - 1))
        split = (
            tasks.join(large, "task", "left_semi")
            .withColumn("c", chunk.cast("int"))
            .withColumn("x", F.explode(F.filter(masks, lambda s: s["n"] <= F.col("budget"))))
            .withColumn("o", F.col("c").bitwiseXOR(F.col("x.m")))
            .withColumn(
                "to",
                F.expr("case when side = 0 then 0 when side = 1 then 1 else 2 end"),
            )
        )
        tasks = materialize(
            split.select(
                F.expr(
                    "case when side = 0 then xxhash64(task, least(c, o), greatest(c, o))"
                    " when side = 1 then xxhash64(task, c, o) else xxhash64(task, o, c) end"
                ).alias("task"),
                F.lit(depth + LEVELS).alias("depth"),
                (F.col("budget") - F.col("x.n")).cast("int").alias("budget"),
                F.expr("case when side > 0 then side when c = o then 0 when c < o then 1 else 2 end").alias("side"),
                "fp", "turned",
            ),
            "simhash-tasks",
        )
    for part in done:
        tasks = tasks.unionByName(part)
    return tasks


def _settle(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Give linked members the smallest label they reach, in place."""
    while len(u):
        a, b = labels[u], labels[v]
        open_ = a != b
        if not open_.any():
            return
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(labels, high, low)
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels[:] = jumped


def trie_links(task, depth, budget, side, fp, distance: int, chunk: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Links (fp, smallest fp reached) among the members of node pairs; ``fp`` rotated, unsigned."""
    order = np.lexsort((fp, side, task))
    task, depth, budget, side, fp = (x[order] for x in (task, depth, budget, side, fp))
    n = len(fp)
    labels = np.arange(n)
    # a member may stand in several tasks: these share a label
    by_value = np.argsort(fp, kind="stable")
    same = fp[by_value][1:] == fp[by_value][:-1]
    _settle(labels, by_value[1:][same], by_value[:-1][same])
    # neighbours in the order of the trie are often close: labels early on save most of the traversal
    near = np.flatnonzero(np.bitwise_count(fp[1:] ^ fp[:-1]) <= distance)
    _settle(labels, near, near + 1)

    head = np.flatnonzero(np.r_[True, task[1:] != task[:-1]])
    tail = np.r_[head[1:], n]
    middle = head + np.add.reduceat((side <= 1).astype(np.int64), head)
    selfs = side[head] == 0
    a_low, a_high = head, np.where(selfs, tail, middle)
    b_low, b_high = np.where(selfs, head, middle), tail
    stack = []
    for d in np.unique(depth[head]):
        own = depth[head] == d
        stack.append((int(d), a_low[own], a_high[own], b_low[own], b_high[own], budget[head][own].astype(np.int64)))
    ones: dict[int, np.ndarray] = {}

    def middle_of(bit: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if bit not in ones:
            ones[bit] = np.r_[0, np.cumsum((fp >> np.uint64(63 - bit)) & np.uint64(1), dtype=np.int64)]
        return high - (ones[bit][high] - ones[bit][low])

    while stack:
        bit, al, ah, bl, bh, left = stack.pop()
        if len(al) > chunk:
            half = len(al) // 2
            stack.append((bit, *(x[half:] for x in (al, ah, bl, bh, left))))
            stack.append((bit, *(x[:half] for x in (al, ah, bl, bh, left))))
            continue
        keep = (ah > al) & (bh > bl) & (left >= 0) & ~((al == bl) & (ah - al == 1))
        # nodes that are one component already, the same one, have nothing to add
        change = np.r_[0, np.cumsum(labels[1:] != labels[:-1])]
        safe = lambda x: np.minimum(x, n - 1)
        uniform = (change[safe(ah - 1)] == change[safe(al)]) & (change[safe(bh - 1)] == change[safe(bl)])
        keep &= ~(uniform & (labels[safe(al)] == labels[safe(bl)]))
        al, ah, bl, bh, left = (x[keep] for x in (al, ah, bl, bh, left))
        if not len(al):
            continue
        small = ((ah - al) * (bh - bl) <= LEAF) | (bit >= 64)
        for i in np.array_split(np.flatnonzero(small), max(1, int(((ah - al) * (bh - bl))[small].sum() >> 20))):
            na, nb = ah[i] - al[i], bh[i] - bl[i]
            each = na * nb
            place = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
            wide = np.repeat(nb, each)
            u, v = np.repeat(al[i], each) + place // wide, np.repeat(bl[i], each) + place % wide
            linked = np.bitwise_count(fp[u] ^ fp[v]) <= distance
            _settle(labels, u[linked], v[linked])
        al, ah, bl, bh, left = (x[~small] for x in (al, ah, bl, bh, left))
        if not len(al):
            continue
        am, bm = middle_of(bit, al, ah), middle_of(bit, bl, bh)
        own = (al == bl) & (ah == bh)  # of a node with itself, one mixed pair of children is enough
        stack.append((bit + 1, np.r_[al, am[~own]], np.r_[am, ah[~own]], np.r_[bm, bl[~own]], np.r_[bh, bm[~own]], np.r_[left, left[~own]] - 1))
        stack.append((bit + 1, np.r_[al, am], np.r_[am, ah], np.r_[bl, bm], np.r_[bm, bh], np.r_[left, left]))
    linked = labels != np.arange(n)
    return order[linked], order[labels[linked]]


def links(classes: DataFrame, distance: int = 3, limit: int = TASK_MEMBERS) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints ``fp`` within ``distance`` bits."""
    if not 0 <= distance <= 3:
        raise ValueError("four blocks serve distances up to 3")
    ship_package(classes.sparkSession)
    tasks = _deal(classes, distance, limit)
    partitions = max(
        int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-4 * classes.count() // PARTITION_MEMBERS)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not len(table):
            return
        cols = {c: table.column(c).to_numpy() for c in table.column_names}
        mine, root = trie_links(
            cols["task"], cols["depth"], cols["budget"], cols["side"], cols["turned"].view(np.uint64), distance
        )
        a, b = cols["fp"][mine], cols["fp"][root]
        apart = a != b
        yield pa.RecordBatch.from_arrays([pa.array(a[apart]), pa.array(b[apart])], ["a", "b"])

    return tasks.repartition(partitions, "task").mapInArrow(frugal(run), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b) but the roots, the smallest nodes.

    Alternating large-star and small-star steps; a step's minimum is aggregated before it is joined
    back, so a node with very many links is no single task's work.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "star")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = materialize(small.distinct(), "star")
        if not edges.select("v").distinct().join(edges.select(F.col("u").alias("v")), "v", "left_semi").take(1):
            manifold = edges.groupBy("u").count().where("count > 1").take(1)
            if not manifold:
                return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(
    documents: DataFrame, shingle: int = 3, distance: int = 3, seed: int = 42, key: str = "doc_id"
) -> DataFrame:
    """(key, fingerprint, component_id): 16 hex digits, and the smallest id that links lead to."""
    prints = materialize(fingerprints(documents, shingle, seed, key), "simhash-prints")
    classes = materialize(prints.groupBy("fp").agg(F.min(key).alias("first")), "simhash-classes")
    roots = components(links(classes.select("fp"), distance))
    labelled = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("label")
    )
    named = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    of = labelled.join(named, "label").select("fp", "component_id")
    return prints.join(of, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
