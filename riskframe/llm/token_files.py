"""Token-id files of patched frame-of-reference blocks.

A shard holds the documents of one range of ids, in ascending order, as numbered segments of whole
documents. A segment's token ids are cut into blocks of ``BLOCK``. A block stores its minimum and,
packed to ``width`` bits each, the distances to it. The width is the cheapest of those that hold a
given percentile of the distances; ids that need more bits are exceptions: their places and full
values follow the packed bits. An index gives the start of every block, so that any range of ids can
be read without the rest.

    magic "PFR1" | ids in a block, u32 | ids, u64 | blocks, u64
    starts of the blocks in the body, u64 each
    body: per block minimum u32, width u8, exceptions u16, packed bits, places u16, values u32

Segments are rows of a Parquet table (shard, segment, keys, lengths, body), since only Spark's own
writers reach every store, commit a task once, and survive a lost executor.

Defined results: null and empty texts hold just the end id; a null id comes first; rows with the
same id are ordered by text; repeated rows are stored each; an empty table gives an empty one.
Other columns are not read. A document longer than a segment is a segment of its own.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm import bpe
from riskframe.session import ship_package, work_dir

BLOCK = 128
#: Percentiles of a block's distances that its width may be chosen for.
PERCENTILES = (0.75, 0.9, 0.97, 1.0)
#: Ids after which a segment is closed.
SEGMENT = 1 << 18
#: Bytes of text encoded together.
PART = 16 << 20
#: Segments up to which their positions, 16 bytes each, are broadcast.
BROADCAST_SEGMENTS = 100_000
HEAD = struct.Struct("<4sIQQ")
BLOCK_HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("exceptions", "<u2")])


def bit_length(x: np.ndarray) -> np.ndarray:
    """Bits that each non-negative integer below 2^32 needs."""
    return np.where(x > 0, np.frexp(x.astype(np.float64))[1], 0)


def encode_blocks(ids: np.ndarray) -> bytes:
    """One segment of token ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.empty(blocks * BLOCK, dtype=np.uint32)
    padded[:n] = ids
    padded[n:] = ids[-1] if n else 0
    table = padded.reshape(blocks, BLOCK)
    low = table.min(axis=1) if blocks else np.zeros(0, np.uint32)
    apart = table - low[:, None]
    bits = bit_length(apart)
    ordered = np.sort(bits, axis=1)
    width = np.zeros(blocks, dtype=np.int64)
    least = np.full(blocks, np.iinfo(np.int64).max)
    for p in PERCENTILES:
        w = ordered[:, int(np.ceil(p * BLOCK)) - 1]
        cost = w * BLOCK // 8 + (bits > w[:, None]).sum(axis=1) * 6
        width, least = np.where(cost < least, w, width), np.minimum(cost, least)
    odd = bits > width[:, None]
    counts = odd.sum(axis=1)
    packed_size = width * BLOCK // 8
    size = BLOCK_HEAD.itemsize + packed_size + counts * 6
    starts = np.cumsum(size) - size
    body = np.zeros(int(size.sum()), dtype=np.uint8)
    heads = np.zeros(blocks, dtype=BLOCK_HEAD)
    heads["low"], heads["width"], heads["exceptions"] = low, width, counts
    put = lambda at, data: body.__setitem__(at[:, None] + np.arange(data.shape[1]), data)
    put(starts, heads.view(np.uint8).reshape(blocks, BLOCK_HEAD.itemsize))
    for w in np.unique(width[width > 0]):
        own = np.flatnonzero(width == w)
        for part in np.array_split(own, -(-len(own) // 4096)):
            plane = (apart[part][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)
            put(starts[part] + BLOCK_HEAD.itemsize, np.packbits(plane.astype(np.uint8).reshape(len(part), -1), axis=1, bitorder="little"))
    row, place = np.nonzero(odd)
    first = np.cumsum(counts) - counts
    nth = np.arange(len(row)) - first[row]
    after = starts[row] + BLOCK_HEAD.itemsize + packed_size[row]
    put(after + nth * 2, place.astype("<u2").view(np.uint8).reshape(-1, 2))
    put(after + counts[row] * 2 + nth * 4, table[row, place].astype("<u4").view(np.uint8).reshape(-1, 4))
    return HEAD.pack(b"PFR1", BLOCK, n, blocks) + starts.astype("<u8").tobytes() + body.tobytes()


def decode_blocks(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` (exclusive) of a segment; only their blocks are touched."""
    magic, block, n, blocks = HEAD.unpack_from(data)
    if magic != b"PFR1":
        raise ValueError("not a token-id segment")
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, dtype=np.uint32)
    b0, b1 = first // block, -(-last // block)
    starts = np.frombuffer(data, "<u8", blocks, HEAD.size)[b0:b1].astype(np.int64)
    body = np.frombuffer(data, np.uint8, offset=HEAD.size + 8 * blocks)
    take = lambda at, k: np.ascontiguousarray(body[at[:, None] + np.arange(k)])
    heads = take(starts, BLOCK_HEAD.itemsize).view(BLOCK_HEAD).ravel()
    width, counts = heads["width"].astype(np.int64), heads["exceptions"].astype(np.int64)
    table = np.repeat(heads["low"][:, None], block, axis=1)
    for w in np.unique(width[width > 0]):
        own = np.flatnonzero(width == w)
        for part in np.array_split(own, -(-len(own) // 4096)):
            bits = np.unpackbits(take(starts[part] + BLOCK_HEAD.itemsize, int(w) * block // 8), axis=1, bitorder="little")
            table[part] += bits.reshape(len(part), block, w).astype(np.uint32) @ (np.uint32(1) << np.arange(w, dtype=np.uint32))
    row = np.repeat(np.arange(len(starts)), counts)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    after = (starts + BLOCK_HEAD.itemsize + width * block // 8)[row]
    place = take(after + nth * 2, 2).view("<u2").ravel()
    table[row, place] = take(after + counts[row] * 2 + nth * 4, 4).view("<u4").ravel()
    return table.ravel()[first - b0 * block : last - b0 * block]


class LibraryRuns(bpe.Runs):
    """The cache filled by the tokenizers library: its model for a word, else its whole pipeline."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        merges = self.tokenizer.model

        def tokens(model, word):
            # ASCII letters and digits stand for themselves
            name = word.decode("ascii") if word.isalnum() else word.decode("latin-1").translate(model.letters)
            return [t.id for t in merges.tokenize(name)]

        super().__init__(bpe.model_at(path), tokens)

    def fresh(self, run: bytes) -> bytes:
        special = self.model.special_bytes.search(run)
        if special or not run.isascii() and max(run.decode("utf-8", "replace").lower()) >= bpe.LATIN_END:
            ids = self.tokenizer.encode(run.decode("utf-8", "replace"), add_special_tokens=False).ids
            return np.array(ids, dtype=self.type).tobytes()
        return super().fresh(run)


_LIBRARY: dict[str, LibraryRuns] = {}


def parts_of(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``PART`` bytes; a text longer than that is alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(batch):
        n = max(1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART, "right")) - at)
        yield batch.slice(at, n)
        at += n


def encode_texts(runs: bpe.Runs, texts: pa.Array) -> pa.Array:
    """Packed ids of each text. A run that the texts share is looked up once; Arrow puts the ids together."""
    if len(texts) == 1:
        return pa.array([runs.encode((texts[0].as_py() or "").encode("utf-8", "replace")).tobytes()], pa.binary())
    runs.renew()
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = split.flatten().dictionary_encode()
    ids = pa.array(list(map(runs.__getitem__, words.dictionary.cast(pa.binary()).to_pylist())), pa.binary())
    return pc.binary_join(pa.ListArray.from_arrays(split.offsets, ids.take(words.indices)), b"")


def tokenise(documents: DataFrame, path: str, end: int, key: str = "doc_id") -> DataFrame:
    """(key, tie, ids): packed little-endian ids of every document with ``end`` appended."""
    chosen = documents.select(key, F.xxhash64("text").alias("tie"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LIBRARY:
            _LIBRARY[path] = LibraryRuns(path)
        runs = _LIBRARY[path]
        stop = np.array([end], dtype=runs.type).tobytes()
        for batch in batches:
            for part in parts_of(batch, 2):
                ids = pc.binary_join_element_wise(encode_texts(runs, part.column(2)), stop, b"")
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), ids], [key, "tie", "ids"])

    kind = chosen.schema[key].dataType.simpleString()
    return chosen.mapInArrow(run, f"`{key}` {kind}, tie long, ids binary")


def write_tokens(documents: DataFrame, path: str, to: str, end: int = 1, key: str = "doc_id", shards: int | None = None) -> None:
    """Encode every document and write the segments to ``to``."""
    spark = documents.sparkSession
    ship_package(spark)
    shards = shards or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # bounds from the ids alone; the texts are read once
    points = documents.agg(
        F.percentile_approx(key, [i / shards for i in range(1, shards)], 100 * shards).alias("p")
    ).first()["p"]
    points = sorted(set(points or []))
    shard = F.size(F.filter(F.array(*[F.lit(p) for p in points]), lambda p: p < F.col(key))) if points else F.lit(0)
    wide = bpe.model_at(path)
    kind = np.dtype("<u2" if len(wide.names) <= 1 << 16 else "<u4")
    if end >= 1 << 8 * kind.itemsize:
        raise ValueError("the end id does not fit the vocabulary's type")
    type_of = documents.schema[key].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "segment", "keys", "lengths", "body"]
        at, segment, keys, held, total = None, 0, [], [], 0

        def close() -> pa.RecordBatch:
            lengths = [len(x) // kind.itemsize for x in held]
            body = encode_blocks(np.frombuffer(b"".join(held), dtype=kind))
            columns = [pa.array([at], pa.int32()), pa.array([segment], pa.int32()), pa.array([keys], pa.list_(key_type)), pa.array([lengths], pa.list_(pa.int64())), pa.array([body], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            key_type = batch.schema.field(1).type
            for s, k, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if held and (s != at or total + len(ids) // kind.itemsize > SEGMENT):
                    yield close()
                    segment, keys, held, total = segment + 1 if s == at else 0, [], [], 0
                at = s
                keys.append(k)
                held.append(ids)
                total += len(ids) // kind.itemsize
        if held:
            yield close()

    dealt = (
        tokenise(documents, path, end, key)
        .select(F.when(F.col(key).isNull(), 0).otherwise(shard).cast("int").alias("shard"), key, "tie", "ids")
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard", F.col(key).asc_nulls_first(), "tie", "ids")
    )
    dealt.mapInArrow(pack, f"shard int, segment int, keys array<{type_of}>, lengths array<long>, body binary").write.option(
        "compression", "none"
    ).parquet(to)


def read_tokens(spark, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every stored document, from the files.

    ``start`` counts the ids of all documents before; ids_crc32 is of the ids as little-endian
    unsigned 32-bit integers.
    """
    files = spark.read.parquet(path)
    sizes = files.select("shard", "segment", F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x).alias("n"))
    of_shard = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    # one row per shard, then one per segment of a shard
    ahead = of_shard.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("ahead"))
    within = F.sum("n").over(Window.partitionBy("shard").orderBy("segment")) - F.col("n")
    begins = sizes.withColumn("within", within).join(F.broadcast(ahead), "shard").select(
        "shard", "segment", (F.col("ahead") + F.col("within")).alias("begin")
    )
    small = begins.count() <= BROADCAST_SEGMENTS
    placed = files.join(F.broadcast(begins) if small else begins, ["shard", "segment"])
    placed = placed.select("begin", "keys", "lengths", "body")
    type_of = files.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                begin, body = batch.column(0)[i].as_py(), batch.column(3)[i].as_py()
                lengths = batch.column(2)[i].values.to_numpy()
                ids = decode_blocks(body).astype("<u4", copy=False)
                ends = np.cumsum(lengths)
                sums = [zlib.crc32(ids[e - n : e].tobytes()) for n, e in zip(lengths.tolist(), ends.tolist())]
                columns = [batch.column(1)[i].values, pa.array(begin + ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [key, "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(run, f"`{key}` {type_of}, start long, n_tokens long, ids_crc32 long")


def round_trip(documents: DataFrame, path: str, end: int = 1, key: str = "doc_id", base: str | None = None) -> DataFrame:
    """Write the token files to a fresh folder and read them back."""
    to = work_dir(documents.sparkSession, "tokens", base)
    write_tokens(documents, path, to, end, key)
    return read_tokens(documents.sparkSession, to, key)
