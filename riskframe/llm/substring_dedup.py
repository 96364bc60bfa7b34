"""Removing repeated word windows by recompression.

Words become 64-bit names, and rounds rewrite each document's sequence of names: *pairs* first (a
hash of the name and the round puts every name left or right; a left name followed by a right one
becomes one symbol), then *runs* of the same symbol. A new symbol's name is a hash of its parts, so
it is global: equal parts have equal names in all documents, without a dictionary to pass around.
Every symbol carries its context, the words that determine that it stands there. Hence a repeated
window contains, wherever it occurs, the same symbols whose context lies inside it.

1. *Reveal.* Names of symbols whose context fits a window are dealt by name, a batch of documents
   sending each of its names once, and one bit per name comes back: in several documents or not. A
   window that contains a symbol of a single document cannot repeat; that rules out most windows.
2. *Verify.* Of the remaining windows 96-bit hashes of all their words are dealt the same way, with
   the smallest document of the batch, and one bit comes back: in a smaller document or not.

Documents are dealt to batches by a hash of their row; one exchange of the texts serves all three
passes. A very frequent passage or a large group of copies sends one entry per batch and window.

Defined results: a null or empty text has no words; texts shorter than a window lose nothing; rows
with the same id are not smaller than each other, so they do not remove from each other; a null id
counts as larger than all; windows are judged on the input; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.words import mix64, stream, word_bounds, word_hashes
from riskframe.session import ship_package

#: Bytes of text in a batch of documents, and documents in one.
BATCH_BYTES, BATCH_DOCS = 16 << 20, 40_000
#: Bytes of text whose names fill one bucket.
BUCKET_BYTES = 32 << 20
#: Bytes of text whose words are worked on together.
CHUNK_BYTES = 1 << 20
FAR = 1 << 40
NO_ID = np.iinfo(np.int64).max


def recompress(words: np.ndarray, rounds: int) -> tuple[np.ndarray, ...]:
    """Symbols after some rounds: names, the words they cover (start, end), and their contexts.

    A context reaches beyond the text where the text's own border decided something.
    """
    n = len(words)
    names, start = words, np.arange(n)
    end = start + 1
    first, last = start.copy(), end.copy()
    for r in range(rounds if n else 0):
        # pairs: a left name takes a right one that follows it
        side = (mix64(names + np.uint64(2 * r + 1)) >> np.uint64(63)).astype(bool)
        heads = np.r_[~side[:-1] & side[1:], False]
        tails = np.r_[False, heads[:-1]]
        # a single name depends on the neighbour it might have paired with
        high = np.where(heads | (~side & ~tails), np.r_[last[1:], FAR], last)
        low = np.where(side & ~tails, np.r_[-FAR, first[:-1]], first)
        joined = mix64(names * np.uint64(3) + mix64(np.r_[names[1:], names[:1]] + np.uint64(2 * r + 2)))
        names = np.where(heads, joined, names)
        end = np.where(heads, np.r_[end[1:], n], end)
        names, start, end, first, last = (x[~tails] for x in (names, start, end, low, high))
        # runs: equal neighbours become one symbol; that a neighbour differs shows at its nearest
        # word or, if that is the same, in its whole context
        begins = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
        stops = np.r_[begins[1:], len(names)] - 1
        length = stops - begins + 1
        low, high = first[begins], last[stops]
        before, after = begins - 1, stops + 1
        inner = before >= 0
        b = before[inner]
        near = words[start[b + 1] - 1] != words[end[b + 1] - 1]
        low[inner] = np.minimum(low[inner], np.where(near, start[b + 1] - 1, first[b]))
        low[~inner] = -FAR
        inner = after < len(names)
        a = after[inner]
        near = words[end[a - 1]] != words[start[a - 1]]
        high[inner] = np.maximum(high[inner], np.where(near, end[a - 1] + 1, last[a]))
        high[~inner] = FAR
        run = mix64(names[begins] + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        names = np.where(length > 1, run, names[begins])
        start, end, first, last = start[begins], end[stops], low, high
    return names, start, end, first, last


class Chunk:
    """Some documents of a batch as one sequence of names, with a name of its own before each.

    These separators occur once, so nothing that reaches over a border is ever shared.
    """

    def __init__(self, data: list[bytes], begin: int):
        joined = b" ".join(data)
        sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(data)) + 1
        raw, starts, ends = word_bounds(joined)
        self.bounds = raw, starts, ends
        of = np.searchsorted(np.cumsum(sizes), starts, side="right")
        counts = np.bincount(of, minlength=len(data))
        self.heads = np.cumsum(counts + 1) - counts - 1  # places of the separators
        self.counts, self.begin = counts, begin
        self.place = np.arange(len(starts)) + of + 1
        self.doc = np.repeat(np.arange(len(data)), counts + 1)
        self.words = self.names(1)

    def names(self, seed: int) -> np.ndarray:
        out = np.empty(len(self.doc), dtype=np.uint64)
        out[self.heads] = stream(seed + 40 + self.begin, len(self.heads))
        out[self.place] = word_hashes(*self.bounds, seed)
        return out


class Batch:
    """The documents of a batch in a fixed order, as chunks, with their symbols."""

    def __init__(self, table: pa.Table, window: int, rounds: int, least: int):
        self.window = window
        rows = sorted(
            zip(table.column("doc").to_pylist(), table.column("text").to_pylist()),
            key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""),
        )
        self.keys = [k for k, _ in rows]
        self.ids = np.array([NO_ID if k is None else k for k in self.keys], dtype=np.int64)
        self.data = [(t or "").encode("utf-8", "replace") for _, t in rows]
        self.chunks: list[Chunk] = []
        self.symbols: list[tuple] = []
        at = 0
        while at < len(self.data):
            end, size = at, 0
            while end < len(self.data) and (end == at or size + len(self.data[end]) < CHUNK_BYTES):
                size += len(self.data[end])
                end += 1
            chunk = Chunk(self.data[at:end], at)
            names, start, stop, first, last = recompress(chunk.words, rounds)
            use = (last - first <= window) & (stop - start >= least)
            # none that covers or depends on a separator
            mark = np.zeros(len(chunk.words) + 1, dtype=np.int64)
            mark[chunk.heads + 1] = 1
            mark = np.cumsum(mark)
            use &= mark[np.minimum(last, len(mark) - 1)] == mark[np.maximum(first, 0)]
            self.chunks.append(chunk)
            self.symbols.append((names[use] >> np.uint64(1), first[use], last[use]))
            at = end

    def shared_names(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct names in the batch, and whether two of its documents have them."""
        if not self.chunks:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        names = np.concatenate([s[0] for s in self.symbols])
        docs = np.concatenate([c.doc[s[1]] + c.begin for c, s in zip(self.chunks, self.symbols)])
        order = np.argsort(names, kind="stable")  # documents ascend within a name
        names, docs = names[order], docs[order]
        begins = np.flatnonzero(np.r_[True, names[1:] != names[:-1]]) if len(names) else np.zeros(0, np.int64)
        ends = np.r_[begins[1:], len(names)] - 1 if len(names) else begins
        return names[begins], docs[begins] != docs[ends]

    def windows(self, shared: np.ndarray) -> tuple[np.ndarray, ...]:
        """Windows without a symbol of one document: document, place, and two hashes."""
        out = []
        k = self.window
        for chunk, (names, first, last) in zip(self.chunks, self.symbols):
            n = len(chunk.words)
            # places where a window of the document begins
            left = np.repeat(chunk.heads + chunk.counts, chunk.counts + 1) - np.arange(n)
            fits = left >= k - 1
            fits[chunk.heads] = False
            if len(shared):
                at = np.searchsorted(shared, names).clip(0, len(shared) - 1)
                alone = shared[at] != names
            else:
                alone = np.ones(len(names), bool)
            edge = np.zeros(n + 1, dtype=np.int64)
            np.add.at(edge, np.maximum(last[alone] - k, 0), 1)
            np.add.at(edge, first[alone] + 1, -1)
            place = np.flatnonzero(fits & (np.cumsum(edge[:n]) == 0))
            if not len(place):
                continue
            second = chunk.names(2)
            one, two = np.zeros(len(place), np.uint64), np.zeros(len(place), np.uint64)
            for j, (a, b) in enumerate(zip(stream(21, k), stream(22, k))):
                one += chunk.words[place + j] * (a | np.uint64(1))
                two += second[place + j] * (b | np.uint64(1))
            doc = chunk.doc[place]
            out.append((doc + chunk.begin, place - chunk.heads[doc] - 1, mix64(one), mix64(two).astype(np.uint32)))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        return tuple(np.concatenate(x) for x in zip(*out))

    def entries(self, shared: np.ndarray) -> dict[str, np.ndarray]:
        """Distinct windows in order with the smallest id that has each, and each window's entry."""
        doc, place, one, two = self.windows(shared)
        # documents ascend, so a stable order has the smallest first
        order = np.lexsort((two, one))
        new = np.r_[True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])] if len(order) else np.zeros(0, bool)
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        head = order[new]
        return {"doc": doc, "place": place, "entry": entry, "one": one[head], "two": two[head], "least": self.ids[doc[head]]}


def _bits_of(table: pa.Table, kind: int, buckets: np.ndarray, count: int) -> np.ndarray:
    """The bits that came back for a batch's entries, which were dealt by ``buckets``."""
    out = np.zeros(len(buckets), dtype=bool)
    order = np.argsort(buckets, kind="stable")
    begin = np.searchsorted(buckets[order], np.arange(count + 1))
    for k, bucket, bits in zip(*(table.column(c).to_pylist() for c in ("kind", "bucket", "bits"))):
        if k == kind:
            own = order[begin[bucket] : begin[bucket + 1]]
            out[own] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(own)).astype(bool)
    return out


def _parted(buckets: np.ndarray):
    """Each bucket that has entries, with their places in order."""
    order = np.argsort(buckets, kind="stable")
    if not len(order):
        return
    cuts = np.flatnonzero(np.r_[True, buckets[order][1:] != buckets[order][:-1], True])
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(buckets[order[a]]), order[a:b]


def remove_repeats(
    documents: DataFrame, window: int = 13, rounds: int = 2, least: int = 2, key: str = "doc_id", text: bool = False
) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256), with the kept text if ``text``.

    Words of windows that also stand in a document with a smaller id go; the others are joined by
    one blank.
    """
    spark = documents.sparkSession
    ship_package(spark)
    chosen = documents.select(F.col(key).cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    size = chosen.agg(F.sum(F.octet_length("text")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    # as many batches as partitions, unless they would be small, so that all tasks have work
    spread = min(int(spark.conf.get("spark.sql.shuffle.partitions")), (size.b or 0) >> 20)
    batches = max(1, spread, -(-(size.b or 0) // BATCH_BYTES), -(-size.n // BATCH_DOCS))
    buckets = max(1, -(-(size.b or 0) // BUCKET_BYTES))
    docs = chosen.withColumn("batch", F.pmod(F.xxhash64("doc", "text"), F.lit(batches)).cast("int"))
    many = np.uint64(buckets)

    def reveal(key, table):
        batch = Batch(table, window, rounds, least)
        names, multi = batch.shared_names()
        rows = [(b, ((names[i] << np.uint64(1)) | multi[i].astype(np.uint64)).tobytes()) for b, i in _parted((names % many).astype(np.int64))]
        n = len(rows)
        return pa.table(
            {
                "batch": pa.array([key[0].as_py()] * n, pa.int32()),
                "bucket": pa.array([b for b, _ in rows], pa.int32()),
                "names": pa.array([x for _, x in rows], pa.binary()),
            }
        )

    def judge_names(key, table):
        parts = [np.frombuffer(x, np.uint64) for x in table.column("names").to_pylist()]
        packed = np.concatenate(parts)
        _, inverse, counts = np.unique(packed >> np.uint64(1), return_inverse=True, return_counts=True)
        shared = counts > 1
        shared[inverse[(packed & np.uint64(1)).astype(bool)]] = True
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        bits = [np.packbits(x).tobytes() for x in np.split(shared[inverse], cuts)]
        return answer(1, table, bits)

    def answer(kind, table, bits):
        return pa.table(
            {
                "batch": table.column("batch"),
                "kind": pa.array([kind] * len(bits), pa.int32()),
                "bucket": table.column("bucket"),
                "bits": pa.array(bits, pa.binary()),
            }
        )

    def known(batch: Batch, bits: pa.Table) -> np.ndarray:
        names, _ = batch.shared_names()
        return names[_bits_of(bits, 1, (names % many).astype(np.int64), buckets)]

    def verify(docs, bits):
        empty = pa.table({"batch": pa.array([], pa.int32()), "bucket": pa.array([], pa.int32()), "hashes": pa.array([], pa.binary()), "docs": pa.array([], pa.binary())})
        if not len(docs):
            return empty
        batch = Batch(docs, window, rounds, least)
        e = batch.entries(known(batch, bits))
        rows = []
        for b, i in _parted((e["one"] % many).astype(np.int64)):
            ids, of = np.unique(e["least"][i], return_inverse=True)
            kind = np.uint16 if len(ids) <= 1 << 16 else np.uint32
            rows.append((b, e["one"][i].tobytes() + e["two"][i].tobytes(), len(ids).to_bytes(4, "little") + ids.tobytes() + of.astype(kind).tobytes()))
        number = docs.column("batch")[0].as_py()
        columns = [pa.array([number] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int32())]
        return pa.table([*columns, *(pa.array([r[j] for r in rows], pa.binary()) for j in (1, 2))], schema=empty.schema)

    def judge_windows(key, table):
        ones, twos, ids = [], [], []
        for hashes, packed in zip(table.column("hashes").to_pylist(), table.column("docs").to_pylist()):
            n, m = len(hashes) // 12, int.from_bytes(packed[:4], "little")
            ones.append(np.frombuffer(hashes, np.uint64, n))
            twos.append(np.frombuffer(hashes, np.uint32, n, 8 * n))
            of = np.frombuffer(packed, np.uint16 if m <= 1 << 16 else np.uint32, n, 4 + 8 * m)
            ids.append(np.frombuffer(packed, np.int64, m, 4)[of])
        cuts = np.cumsum([len(x) for x in ones])[:-1]
        one, two, doc = (np.concatenate(x) for x in (ones, twos, ids))
        order = np.lexsort((doc, two, one))
        new = np.r_[True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])]
        least_id = np.empty(len(order), np.int64)
        least_id[order] = doc[order][new][np.cumsum(new) - 1]
        return answer(2, table, [np.packbits(x).tobytes() for x in np.split(least_id < doc, cuts)])

    fields = [("doc", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + [("text", pa.string())] * text)

    def remove(docs, bits):
        if not len(docs):
            return schema.empty_table()
        batch = Batch(docs, window, rounds, least)
        e = batch.entries(known(batch, bits))
        smaller = _bits_of(bits, 2, (e["one"] % many).astype(np.int64), buckets)
        # the batch's own smallest document counts as well
        gone = smaller[e["entry"]] | (e["least"][e["entry"]] < batch.ids[e["doc"]])
        doc, place = e["doc"][gone], e["place"][gone]
        cuts = np.searchsorted(doc, np.arange(len(batch.data) + 1))
        rows = []
        for i, data in enumerate(batch.data):
            words, n = data.split(), 0
            if cuts[i] < cuts[i + 1]:
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(edge, place[cuts[i] : cuts[i + 1]], 1)
                np.add.at(edge, place[cuts[i] : cuts[i + 1]] + window, -1)
                keep = np.cumsum(edge[:-1]) == 0
                n = int(len(words) - keep.sum())
                kept = b" ".join([w for w, k in zip(words, keep.tolist()) if k])
            else:
                kept = b" ".join(words)
            rows.append((batch.keys[i], len(words), n, hashlib.sha256(kept).hexdigest()) + (kept.decode(),) * text)
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)

    # pyarrow functions that take two tables are recognised by their number of arguments
    names = docs.groupBy("batch").applyInArrow(reveal, "batch int, bucket int, names binary")
    reply = "batch int, kind int, bucket int, bits binary"
    bits = names.groupBy("bucket").applyInArrow(judge_names, reply)
    by_batch = docs.groupBy("batch")
    hashes = by_batch.cogroup(bits.groupBy("batch")).applyInArrow(verify, "batch int, bucket int, hashes binary, docs binary")
    second = hashes.groupBy("bucket").applyInArrow(judge_windows, reply)
    out = by_batch.cogroup(bits.unionByName(second).groupBy("batch")).applyInArrow(
        remove, "doc long, n_words long, n_removed long, kept_sha256 string" + ", text string" * text
    )
    return out.withColumnRenamed("doc", key)
