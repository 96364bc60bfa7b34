"""MinHash near duplicates by an LSH forest: sorted signature orders, neighbours by longest common prefix.

A document's set holds its distinct word shingles. Equal sets are one class from the start. Each
tree of the forest orders the classes by its own sequence of MinHash values; classes that agree in
the first ``depth`` values of a tree are a region of it. Two sets of similarity s share a region of
at least one tree but for a chance of (1 - s^depth)^trees; ``shape`` takes as many trees as ``MISS``
asks for at the similarity wanted. Before texts are compared, a pair must agree in as many values as
all but ``MISS`` of such pairs do.

1. *Neighbours.* The rows of all trees are range partitioned in their order, whatever a region holds,
   and cut into blocks of at most ``block`` neighbours. All pairs of a block are estimated. A block
   with few likely pairs yields them all; a crowded one yields a spanning forest of its likeliest
   pairs, so a group of copies yields links in proportion to its members. A large region thereby is
   compared at the depth at which its neighbours agree, the others at the least depth.
2. *Confirmation* on whole texts: pairs are dealt to the cells of a grid by their two ends, each cell
   reads its texts once and intersects the shingle sets. First each class's best pair, then pairs
   that are not connected yet.
3. *The rest, exactly.* Crowded regions, and those that were cut, come back if they hold several
   components. All their pairs of members in different components are estimated, members outside the
   largest component in blocks against all members, and likely ones compared by the hashes of their
   shingles; similar ones are confirmed, two for each member and tree first, then all that are left.
   A pair is taken up by the first tree whose region has it.

So each pair above the similarity is confirmed, connected by confirmed pairs, or missed with
probability below 2 * MISS, whatever sizes regions have. Only row counts reach the driver.

Defined results: a text with fewer words than a shingle is one shingle; one without words, or null,
is linked with nothing and its component is its own id; repeated rows and ids all return; null ids
stand for themselves, a component without an id has a null ``component_id``; an empty table gives
an empty result. Other columns are not read. Shingles are compared by their words, not by hashes,
where links are confirmed; equal sets are recognised by 128-bit digests of their 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.simhash import _settle, components
from riskframe.llm.words import mix64, stream, word_bounds, word_hashes
from riskframe.session import materialize, ship_package

#: Chance that a pair at the similarity wanted shares no region, and that it fails the estimate.
MISS = 1e-7
#: MinHash values of which a row of a tree carries one byte each.
SKETCH = 64


@dataclass(frozen=True)
class Shape:
    """What the forest looks like, and how large its pieces of work are."""

    part: int
    whole: int
    #: trees, values that a region shares, and values in which sketches and signatures of likely pairs agree
    trees: int
    depth: int
    in_sketch: int
    in_signature: int
    #: classes of a block, pairs for each of them beyond which it is crowded, rows of a partition
    block: int = 512
    crowded: int = 4
    partition_rows: int = 200_000
    #: members that a block is compared with at a time, pairs aimed at for a cell of the grid
    side: int = 4096
    cell_pairs: int = 2000

    @property
    def values(self) -> int:
        return self.trees * self.depth


def shape(similarity: tuple[int, int] = (80, 100), depth: int = 4, **pieces: int) -> Shape:
    part, whole = similarity
    if not 0 < part < whole:
        raise ValueError("the similarity lies between 0 and 1")
    s = part / whole
    trees = max(math.ceil(math.log(MISS) / math.log1p(-(s**depth))), -(-SKETCH // depth))

    def least(n: int) -> int:
        below, k = 0.0, 0
        while True:
            below += math.comb(n, k) * s**k * (1 - s) ** (n - k)
            if below > MISS:
                return k
            k += 1

    return Shape(part, whole, trees, depth, least(SKETCH), least(trees * depth), **pieces)


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles."""
    names = word_hashes(*word_bounds(text.lower()))
    if not len(names):
        return names
    size = min(shingle, len(names))
    out = names[: len(names) - size + 1]
    for i in range(1, size):
        out = mix64(out * np.uint64(3) + names[i : len(names) - size + 1 + i])
    return np.unique(out)


def shingle_set(text: str | None, shingle: int) -> set[tuple[bytes, ...]]:
    words = (text or "").encode("utf-8", "replace").lower().split()
    size = min(shingle, len(words))
    return set(zip(*(words[i:] for i in range(size)))) if size else set()


def signature(hashes: np.ndarray, values: int) -> np.ndarray:
    """The least of each of ``values`` 32-bit hash functions over a set."""
    factors = (stream(77, values) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    turns = stream(78, values).astype(np.uint32)
    folded = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(values, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(folded), 2048):
        x = (folded[at : at + 2048, None] ^ turns) * factors
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        np.minimum(out, x.min(axis=0), out=out)
    return out


def _fixed(column: pa.Array, dtype, width: int) -> np.ndarray:
    """A binary column of equal lengths as a table of numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def sketches(documents: DataFrame, shingle: int, values: int, key: str) -> DataFrame:
    """(key, row, cls, n, sig, text): a row's number, digest and size of its set, and its signature."""
    chosen = documents.select(key, F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, n, sig = [], [], []
            for text in batch.column(2).to_pylist():
                hashes = shingle_hashes((text or "").encode("utf-8", "replace"), shingle)
                cls.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                n.append(len(hashes))
                sig.append(signature(hashes, values).tobytes())
            columns = [batch.column(0), batch.column(1), pa.array(cls, pa.binary()), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, [key, "row", "cls", "n", "sig", "text"])

    kind = chosen.schema[key].dataType.simpleString()
    return materialize(chosen.mapInArrow(run, f"`{key}` {kind}, row long, cls binary, n long, sig binary, text string"), "forest-sketches")


def forest_rows(classes: DataFrame, shape: Shape) -> DataFrame:
    """A row of each tree for each class: (tree, region, path, id, n, sketch)."""
    trees, depth = shape.trees, shape.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2000):
                batch = whole.slice(at, 2000)
                sig = _fixed(batch.column(2), np.uint32, trees * depth)
                sketch = pa.array([x.tobytes() for x in sig[:, :SKETCH].astype(np.uint8)], pa.binary())
                for t in range(trees):
                    region = np.full(len(sig), t, np.uint64)
                    for d in range(depth):
                        region = mix64(region * np.uint64(3) + sig[:, t * depth + d])
                    # the order within a region: bytes of the values that follow
                    path = np.zeros(len(sig), np.int64)
                    for d in range(depth, depth + 7):
                        path = (path << 8) | (sig[:, (t * depth + d) % (trees * depth)] & np.uint32(255)).astype(np.int64)
                    columns = [pa.array(np.full(len(sig), t, np.int32)), pa.array(region.view(np.int64)), pa.array(path), batch.column(0), batch.column(1), sketch]
                    yield pa.RecordBatch.from_arrays(columns, ["tree", "region", "path", "id", "n", "sketch"])

    return classes.select("id", "n", "sig").mapInArrow(run, "tree int, region long, path long, id long, n long, sketch binary")


def spanning(u: np.ndarray, v: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The edges of a spanning forest of greatest weight (Boruvka's steps)."""
    order = np.lexsort((v, u, -weight))
    labels, chosen = np.arange(n), []
    while True:
        a, b = labels[u[order]], labels[v[order]]
        order = order[a != b]
        if not len(order):
            return np.unique(np.concatenate(chosen)) if chosen else np.zeros(0, np.int64)
        # in this order, the first edge of each component is its best
        best = np.full(n, len(order))
        place = np.arange(len(order))
        np.minimum.at(best, labels[u[order]], place)
        np.minimum.at(best, labels[v[order]], place)
        picked = order[np.unique(best[best < len(order)])]
        chosen.append(picked)
        _settle(labels, u[picked], v[picked])


def neighbours(region, n, sketch, shape: Shape) -> tuple[np.ndarray, ...]:
    """Likely pairs (i, j, agreeing values) of sorted rows, and the rows whose regions stay open."""
    part, whole, block = shape.part, shape.whole, shape.block
    rows = len(region)
    new = np.r_[True, region[1:] != region[:-1]]
    heads = np.flatnonzero(new)
    ends = np.r_[heads[1:], rows]
    of = np.cumsum(new) - 1
    offset = np.arange(rows) - heads[of]
    block_end = np.minimum(heads[of] + (offset // block + 1) * block, ends[of])
    found = []
    active = np.arange(rows)
    for d in range(1, block):
        active = active[active + d < block_end[active]]
        if not len(active):
            break
        for at in range(0, len(active), 1 << 16):
            i = active[at : at + (1 << 16)]
            j = i + d
            fits = whole * np.minimum(n[i], n[j]) >= part * np.maximum(n[i], n[j])
            i, j = i[fits], j[fits]
            agree = (sketch[i] == sketch[j]).sum(axis=1)
            likely = agree >= shape.in_sketch
            found.append((i[likely], j[likely], agree[likely]))
    i, j, agree = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    # crowded blocks keep a spanning forest; they, cut regions and those at the borders stay open
    begin = np.arange(rows) - offset % block
    likely = np.bincount(begin[i], minlength=rows)[begin] if len(i) else np.zeros(rows, np.int64)
    crowded = likely > shape.crowded * (block_end - begin)
    open_ = (of == 0) | (of == of[-1]) | (ends - heads > block)[of] | np.bincount(of, weights=crowded, minlength=len(heads)).astype(bool)[of]
    many = crowded[i]
    picked = spanning(i[many], j[many], agree[many], rows)
    keep = np.r_[np.flatnonzero(~many), np.flatnonzero(many)[picked]]
    return i[keep], j[keep], agree[keep], np.flatnonzero(open_)


def candidates(classes: DataFrame, shape: Shape) -> DataFrame:
    """Likely pairs (a, b, agree), and open rows (tree, region, a): the two kinds tell apart by ``b``."""
    spark = classes.sparkSession
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-classes.count() * shape.trees // shape.partition_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        table = pa.Table.from_batches(parts).combine_chunks()
        tree, region, ids, n = (table.column(c).to_numpy() for c in ("tree", "region", "id", "n"))
        i, j, agree, open_ = neighbours(region, n, _fixed(table.column("sketch"), np.uint8, SKETCH), shape)
        a, b = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
        names = ["tree", "region", "a", "b", "agree"]
        none = pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([*none, pa.array(a), pa.array(b), pa.array(agree.astype(np.int32))], names)
        k = len(open_)
        columns = [pa.array(tree[open_]), pa.array(region[open_]), pa.array(ids[open_]), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names)

    order = ["region", "path", "id"]
    rows = forest_rows(classes, shape).repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return materialize(rows.mapInArrow(run, "tree int, region long, a long, b long, agree int"), "forest-candidates")


def confirm(pairs: DataFrame, texts: DataFrame, shingle: int, shape: Shape) -> DataFrame:
    """Those pairs (a, b) whose shingle sets are similar; ``texts`` has (row, text)."""
    pairs = materialize(pairs.select("a", "b"), "forest-pairs")
    side = max(1, math.isqrt(-(-pairs.count() // shape.cell_pairs)))
    cell = F.pmod(F.xxhash64("a"), F.lit(side)) * F.lit(side) + F.pmod(F.xxhash64("b", F.lit(1)), F.lit(side))
    pairs = pairs.withColumn("cell", cell)
    nodes = materialize(pairs.select("cell", F.col("a").alias("row")).unionByName(pairs.select("cell", F.col("b").alias("row"))).distinct(), "forest-nodes")

    def similar(one: int, two: int, both: int) -> bool:
        return shape.whole * both >= shape.part * (one + two - both)

    def check(pairs_: pa.Table, texts_: pa.Table) -> pa.Table:
        of = {r: i for i, r in enumerate(texts_.column("row").to_pylist())}
        text = texts_.column("text")
        hashes = [shingle_hashes((t.as_py() or "").encode("utf-8", "replace"), shingle) for t in text]
        out = []
        for a, b in zip(pairs_.column("a").to_pylist(), pairs_.column("b").to_pylist()):
            x, y = hashes[of[a]], hashes[of[b]]
            # hashes of 8 bytes rule most out; the words themselves decide on the others
            if similar(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))):
                x, y = (shingle_set(text[of[r]].as_py(), shingle) for r in (a, b))
                if similar(len(x), len(y), len(x & y)):
                    out.append((a, b))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    needed = nodes.join(texts, "row")
    return materialize(pairs.groupBy("cell").cogroup(needed.groupBy("cell")).applyInArrow(check, "a long, b long"), "forest-links")


def labelled(rows: DataFrame, roots: DataFrame, column: str, label: str) -> DataFrame:
    """Rows with the component of the class in ``column``."""
    own = roots.select(F.col("node").alias(column), F.col("root").alias("__root"))
    return rows.join(own, column, "left").withColumn(label, F.coalesce("__root", column)).drop("__root")


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of classes that are not in the same component."""
    return labelled(labelled(pairs, roots, "a", "__la"), roots, "b", "__lb").where("__la <> __lb").select("a", "b")


def shared_counts(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many members of a sorted set each other set has."""
    sizes = np.fromiter(map(len, others), np.int64, len(others))
    flat = np.concatenate(others)
    there = one[np.searchsorted(one, flat).clip(0, len(one) - 1)] == flat
    return np.add.reduceat(there.astype(np.int64), np.cumsum(sizes) - sizes)


def mixed_rows(opened: DataFrame, roots: DataFrame, shape: Shape) -> DataFrame:
    """The rows of open regions that hold several components: (tree, region, id, label, most, lefts,
    rights) with the label of most members and the numbers of blocks to compare."""
    rows = labelled(opened.select("tree", "region", F.col("a").alias("id")), roots, "id", "label")
    sizes = rows.groupBy("region", "label").count()
    mixed = sizes.groupBy("region").agg(F.max(F.struct("count", "label")).alias("top"), F.sum("count").alias("members"))
    mixed = mixed.where(F.col("members") > F.col("top.count")).select(
        "region", F.col("top.label").alias("most"),
        F.ceil((F.col("members") - F.col("top.count")) / shape.block).alias("lefts"), F.ceil(F.col("members") / shape.side).alias("rights"),
    )
    return materialize(rows.join(materialize(mixed, "forest-mixed"), "region"), "forest-open")


def sets_of(ids: DataFrame, texts: DataFrame, shingle: int, shape: Shape) -> DataFrame:
    """(id, n, sig, hashes) of some classes: their shingle hashes, sorted, and signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes((t.as_py() or "").encode("utf-8", "replace"), shingle) for t in batch.column(1)]
            columns = [
                batch.column(0), pa.array(list(map(len, sets)), pa.int64()),
                pa.array([signature(x, shape.values).tobytes() for x in sets], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "sig", "hashes"])

    # written, so that its size tells how to join it
    ids = materialize(ids.select(F.col("id").alias("row")).distinct(), "forest-open-ids")
    wanted = texts.join(ids, "row", "left_semi").select("row", "text")
    return materialize(wanted.mapInArrow(run, "id long, n long, sig binary, hashes binary"), "forest-open-sets")


def rest(rows: DataFrame, sets: DataFrame, shape: Shape, each: int | None) -> DataFrame:
    """Pairs (a, b) of ``mixed_rows`` in different components whose sets, by the hashes of their
    shingles, are similar; with ``each`` no more than that for each left member."""
    part, whole = shape.part, shape.whole
    rows = rows.join(sets, "id")
    to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    left = rows.where(F.col("label") != F.col("most")).withColumn("l", own("lefts")).withColumn("r", to("rights")).withColumn("left", F.lit(True))
    right = rows.withColumn("r", own("rights")).withColumn("l", to("lefts")).withColumn("left", F.lit(False))

    def match(table: pa.Table) -> pa.Table:
        sig = _fixed(table.column("sig").combine_chunks(), np.uint32, shape.values)
        ids, n, label, tree = (table.column(c).to_numpy() for c in ("id", "n", "label", "tree"))
        is_left = table.column("left").to_numpy(zero_copy_only=False)
        mine, other = np.flatnonzero(is_left), np.flatnonzero(~is_left)
        known = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("hashes")]
        out = []
        for i in mine.tolist():
            j = other[(label[other] != label[i]) & (whole * np.minimum(n[other], n[i]) >= part * np.maximum(n[other], n[i]))]
            same = sig[j] == sig[i]
            agree = same.sum(axis=1)
            # the first tree in whose region both are takes the pair up
            first = same.reshape(len(j), shape.trees, shape.depth).all(axis=2)[:, : tree[i]].any(axis=1) if tree[i] else np.zeros(len(j), bool)
            good = (agree >= shape.in_signature) & ~first
            j, agree = j[good], agree[good]
            if not len(j):
                continue
            both = shared_counts(known[i], [known[x] for x in j.tolist()])
            linked = whole * both >= part * (n[i] + n[j] - both)
            j, agree = j[linked], agree[linked]
            if each is not None:
                j = j[np.lexsort((ids[j], -agree))[:each]]
            out.append(np.stack([np.minimum(ids[j], ids[i]), np.maximum(ids[j], ids[i])], axis=1))
        pairs = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    groups = left.unionByName(right).select("region", "l", "r", "left", "tree", "id", "n", "sig", "label", "hashes").groupBy("region", "l", "r")
    return groups.applyInArrow(match, "a long, b long").distinct()


def near_duplicates(documents: DataFrame, shingle: int = 2, shape: Shape = shape(), key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id, kept): documents link if their shingle sets have an
    intersection of at least the share ``shape`` was made for of their union.

    ``component_id`` is the smallest id that links lead to, ``kept`` tells that it is the own one.
    """
    ship_package(documents.sparkSession)
    prints = sketches(documents, shingle, shape.values, key)
    classes = materialize(
        prints.where("n > 0").groupBy("cls").agg(F.min("row").alias("id"), F.min(key).alias("first"), F.first("n").alias("n"), F.first("sig").alias("sig")),
        "forest-classes",
    )
    texts = prints.select("row", "text")
    found = candidates(classes, shape)
    likely = materialize(found.where("b is not null").groupBy("a", "b").agg(F.first("agree").alias("agree")), "forest-likely")
    both = likely.unionByName(likely.select(F.col("b").alias("a"), F.col("a").alias("b"), "agree"))
    best = both.groupBy("a").agg(F.max(F.struct("agree", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    best = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = confirm(best, texts, shingle, shape)
    roots = components(links)

    links = links.unionByName(confirm(apart(likely.join(best, ["a", "b"], "left_anti"), roots), texts, shingle, shape))
    roots = components(links)

    tested = likely.select("a", "b")
    opened, sets = found.where("b is null"), None
    for each in (2, None):
        rows = mixed_rows(opened, roots, shape)
        if sets is None:  # later rounds have rows of the same classes
            sets = sets_of(rows, texts, shingle, shape)
        pairs = rest(rows, sets, shape, each)
        pairs = materialize(pairs.join(tested, ["a", "b"], "left_anti"), "forest-rest")
        if pairs.take(1):
            links = links.unionByName(confirm(pairs, texts, shingle, shape))
            roots = components(links)
            tested = tested.unionByName(pairs)

    named = labelled(classes.select("cls", "id", "first"), roots, "id", "label")
    ids = named.groupBy("label").agg(F.min("first").alias("component_id"))
    of = named.join(ids, "label").select("cls", "component_id")
    out = prints.select(key, "cls", F.col("n").alias("n_shingles")).join(of, "cls", "left")
    out = out.withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col(key)).otherwise(F.col("component_id")))
    return out.select(key, "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col(key)).alias("kept"))
