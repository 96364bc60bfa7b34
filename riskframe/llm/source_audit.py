"""How the term distribution of each source departs from that of other sources and of its language.

*Counting.* A task takes the terms of some documents at once: a table makes letters lower case and
everything that is no term a zero, so terms are the stretches without zeros. Terms are packed by
length. Up to 8 bytes are one big-endian uint64, up to 16 bytes two; these are sorted by a radix sort
of 16-bit digits (numpy's stable sort of uint16). Longer terms go to buckets of fixed widths, powers
of two, whose rows are sorted as bytes. Documents stand in the order of their group and the sorts
are stable, so within a term the occurrences are in order of group and document: one count of runs
gives occurrences and documents for each (language, source, term). Spark adds these up.

*Comparing.* Each language keeps the terms of at least ``min_docs`` of its documents. With V kept
terms, of which N occurrences stand in a group, a term with a count has the integer probability
p = 1 + floor(scale * (count + alpha) / (N + alpha * V)) there, and f = floor((p - q)^2 / q) against
another probability q. Pairs of sources are summed over all kept terms, those that neither has
included: kept terms are dealt to tasks by language and a hash of the term, each task makes tables
of terms by sources and adds up all pairs of columns. Nothing is collected to the driver; totals of
groups travel to the tasks as rows. All arithmetic is in integers.

Defined results: null texts, languages and sources are empty ones; a group without terms has zero
counts; a language without kept terms has value 0 for all pairs and no terms; repeated rows and ids
count each; ties go by the item's UTF-8 bytes; an empty table gives an empty result. Other columns
are not read. A language's sources are compared in all ordered pairs, as the report asks, so their
number must be moderate; the tables of a task are cut to ``CELLS`` whatever it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import materialize, ship_package

#: Bytes of text counted at a time.
CHUNK_BYTES = 2 << 20
#: Counts aimed at for a task that compares sources, and cells of its tables.
TASK_COUNTS, CELLS = 200_000, 1 << 20

#: Each byte in lower case; zero where it belongs to no term.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[: ord("A")] = 0
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[ord("Z") + 1 : ord("a")] = 0
_FOLD[ord("z") + 1 : 0x80] = 0
#: For 0 to 8 bytes, the bits of a big-endian word that they fill.
_MASK = np.array([(1 << 64) - (1 << (64 - 8 * n)) for n in range(9)], dtype=np.uint64)


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows by their words, the first the most significant."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit[0] != digit).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _count(changes: np.ndarray, doc: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First row, rows and distinct documents of each (term, group), given where the term changes."""
    new_doc, new_group = changes.copy(), changes.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    new_group[1:] |= group[1:] != group[:-1]
    heads = np.flatnonzero(new_group)
    return heads, np.diff(np.r_[heads, len(doc)]), np.add.reduceat(new_doc.astype(np.int64), heads)


def count_terms(texts: list[bytes], groups: np.ndarray) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """(terms, group, occurrences, documents) of texts given in the order of their groups."""
    joined = b"\0".join([*texts, b"\0" * 16])
    raw = _FOLD[np.frombuffer(joined, np.uint8)]
    edges = np.flatnonzero(np.diff(np.r_[False, raw != 0].astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sizes = ends - starts
    borders = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    doc = np.searchsorted(borders, starts, side="right")
    eight = np.ndarray(len(raw) - 7, dtype=">u8", buffer=raw, strides=(1,))
    width = 1  # in words of 8 bytes
    while len(starts):
        fits = sizes <= 8 * width
        at, size, own = starts[fits], sizes[fits], doc[fits]
        if len(at) and width <= 2:
            words = [eight[at + 8 * i].astype(np.uint64) & _MASK[np.clip(size - 8 * i, 0, 8)] for i in range(width)]
            order = radix_order(words)
            words, own = [w[order] for w in words], own[order]
            changes = np.ones(len(order), bool)
            changes[1:] = np.logical_or.reduce([w[1:] != w[:-1] for w in words])
            heads, n, docs = _count(changes, own, groups[own])
            packed = np.stack([w[heads] for w in words], axis=1).astype(">u8")
            yield packed.view(f"S{8 * width}").ravel().tolist(), groups[own[heads]], n, docs
        elif len(at):
            names = np.array([raw[a : a + s].tobytes() for a, s in zip(at.tolist(), size.tolist())], dtype=f"S{8 * width}")
            order = np.argsort(names, kind="stable")
            names, own = names[order], own[order]
            heads, n, docs = _count(np.r_[True, names[1:] != names[:-1]], own, groups[own])
            yield names[heads].tolist(), groups[own[heads]], n, docs
        starts, sizes, doc = starts[~fits], sizes[~fits], doc[~fits]
        width *= 2


def term_counts(documents: DataFrame, chunk: int = CHUNK_BYTES) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term, of each group."""
    ship_package(documents.sparkSession)
    names = ("lang", "source", "term", "n", "docs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, sources = (batch.column(i).to_pylist() for i in (0, 1))
            lengths = pc.binary_length(batch.column(2)).to_pylist()
            order = sorted(range(len(lengths)), key=lambda i: (langs[i], sources[i]))
            at = 0
            while at < len(order):
                end, size = at, 0
                while end < len(order) and (end == at or size + lengths[order[end]] < chunk):
                    size += lengths[order[end]]
                    end += 1
                part = order[at:end]
                keys = sorted({(langs[i], sources[i]) for i in part})
                number = {k: j for j, k in enumerate(keys)}
                groups = np.array([number[langs[i], sources[i]] for i in part])
                both = [pa.array(x, pa.string()) for x in zip(*keys)]
                for terms, group, n, docs in count_terms([t.encode("utf-8", "replace") for t in batch.column(2).take(pa.array(part)).to_pylist()], groups):
                    of = pa.array(group)
                    columns = [both[0].take(of), both[1].take(of), pa.array(terms, pa.string()), pa.array(n), pa.array(docs)]
                    yield pa.RecordBatch.from_arrays(columns, names)
                at = end

    chosen = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = chosen.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _probability(count: Column, total: Column, terms: Column, scale: int, alpha: int) -> Column:
    wide = lambda c: c.cast("decimal(20,0)")
    share = F.call_function("div", wide(count + F.lit(alpha)) * F.lit(scale).cast("decimal(11,0)"), wide(total + F.lit(alpha) * terms))
    return F.lit(1) + share.cast("long")


def _compare(lang: str, table: pa.Table, scale: int, alpha: int, most: int) -> pa.Table:
    """Sums of f over some kept terms for all ordered pairs of a language's sources."""
    terms = table.column("term")
    heads = table.filter(pc.is_null(terms))
    rows = table.filter(pc.is_valid(terms))
    sources = sorted(set(heads.column("source").to_pylist()))
    number = {s: i for i, s in enumerate(sources)}
    total = np.zeros(len(sources), np.int64)
    total[[number[s] for s in heads.column("source").to_pylist()]] = heads.column("n").to_numpy()
    coded = rows.column("term").combine_chunks().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    code = coded.indices.to_numpy()
    column = np.array([number[s] for s in rows.column("source").to_pylist()], np.int64)
    count = rows.column("n").to_numpy()
    order = np.argsort(code, kind="stable")
    code, column, count = code[order], column[order], count[order]
    below = total + alpha * int(heads.column("terms")[0].as_py())
    sums = np.zeros((len(sources), len(sources)), np.int64)
    step = max(1, most // max(1, len(sources)))
    high, low = 10**5, scale // 10**5
    for first in range(0, len(coded.dictionary), step):
        a, b = np.searchsorted(code, (first, first + step))
        cells = np.full((min(step, len(coded.dictionary) - first), len(sources)), alpha, np.int64)
        cells[code[a:b] - first, column[a:b]] += count[a:b]
        # scale * cells // below, in two steps of a long division so that nothing overflows
        whole, rest = np.divmod(cells * high, below)
        p = 1 + whole * low + rest * low // below
        for i in range(len(sources)):
            apart = p[:, i, None] - p
            sums[i] += (apart * apart // p).sum(axis=0)
    i, j = np.nonzero(~np.eye(len(sources), dtype=bool))
    name = np.array(sources, dtype=object)
    return pa.table(
        {
            "lang": pa.array([lang] * len(i), pa.string()),
            "source": pa.array(name[i].tolist(), pa.string()),
            "item": pa.array(name[j].tolist(), pa.string()),
            "value": pa.array(sums[i, j], pa.int64()),
        }
    )


def divergence(
    documents: DataFrame, min_docs: int = 3, scale: int = 10**9, alpha: int = 1, top: int = 200,
    chunk: int = CHUNK_BYTES, task_counts: int = TASK_COUNTS, cells: int = CELLS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has every other source of the language
    with the sum of f against it, part ``term`` the ``top`` terms that the source has more often
    than its language, each part ranked by value within its group.
    """
    if scale % 10**5 or not 0 < scale <= 10**9:
        raise ValueError("scale is a multiple of 100,000 up to 1,000,000,000")
    of_term = Window.partitionBy("lang", "term")
    kept = materialize(
        term_counts(documents, chunk)
        .withColumn("all_docs", F.sum("docs").over(of_term))
        .withColumn("in_lang", F.sum("n").over(of_term))
        .withColumn("leads", (F.col("source") == F.min("source").over(of_term)).cast("long"))
        .where(F.col("all_docs") >= min_docs)
        .select("lang", "source", "term", "n", "in_lang", "leads"),
        "audit-kept",
    )
    groups = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("leads").alias("terms"))
    totals = materialize(
        groups.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left").select(
            "lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "lang_total", "terms")]
        ),
        "audit-totals",
    )

    # pairs of sources
    buckets = max(1, -(-kept.count() // task_counts))
    parted = kept.select("lang", F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket"), "source", "term", "n", F.lit(0).cast("long").alias("terms"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("bucket")
    heads = totals.where("terms > 0").select("lang", each, "source", F.lit(None).cast("string").alias("term"), F.col("total").alias("n"), "terms")

    def compare(key, table):
        return _compare(key[0].as_py(), table, scale, alpha, cells)

    sums = parted.unionByName(heads).groupBy("lang", "bucket").applyInArrow(compare, "lang string, source string, item string, value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    others = totals.select("lang", F.col("source").alias("item"))
    pairs = totals.select("lang", "source").join(others, "lang").where("source <> item")
    pairs = pairs.join(sums, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))

    # terms of a source against its language
    p = _probability(F.col("n"), F.col("total"), F.col("terms"), scale, alpha)
    q = _probability(F.col("in_lang"), F.col("lang_total"), F.col("terms"), scale, alpha)
    high = kept.join(totals, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    high = high.select("lang", "source", F.lit("term").alias("part"), "item", F.expr("((p - q) * (p - q)) div q").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = high.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(ranked)
