"""Quoted CSV files of any size, read by many tasks.

A line break inside quotes does not end a record, so a byte range alone does not tell where its
records begin: that depends on whether the number of quotes before it is even. Spark's text reader
cuts files into ranges, each task reading the lines that begin in its own.

1. Quotes are counted per range, a running sum over a file's ranges gives the parity at which each begins.
2. With that parity a task knows which of its lines begin outside quotes: these begin records. The
   others continue the line before. What a range holds of records that begin in an earlier or end in a
   later range comes out as fragments, at most two for each range, which are put together by a grouping.
3. Records are parsed by the built-in ``from_csv``.

Nothing but the range table (path, start, parity) is sent to all tasks, and only if it has at most
``BROADCAST_RANGES`` rows; callers read whole files beyond that.

Records end at a line feed, or a carriage return and line feed. As in RFC 4180, quotes stand around
a whole field, and a quote inside is doubled. Empty lines are no records. Both passes must see the
same ranges, which follow from the session's ``spark.sql.files`` settings and, unless
``spark.sql.files.minPartitionNum`` is set, its number of cores; a task that meets an unknown range fails.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.session import materialize, ship_package

#: Ranges up to which their table, about 150 bytes each, is broadcast.
BROADCAST_RANGES = 1_000_000
#: Kinds of rows: whole records, what a range holds of a record from an earlier one, and what begins
#: in it and ends in a later one.
WHOLE, CONTINUED, BEGUN = 0, 1, 2


class Records:
    """Lines of one range after another to records and fragments; fed with batches in order."""

    def __init__(self, quote: str, names: Sequence[str] | None, sep: str):
        self.quote, self.names, self.sep = quote, names, sep
        self.range: int | None = None
        self.pending: list[str] = []
        self.inside = self.begun = self.at_header = False

    def feed(self, lines: pa.Array, number: int, odd: bool, first: bool) -> Iterator[tuple[pa.Array, int, int]]:
        """(texts, kind, range) of the next lines of range ``number``."""
        if number != self.range:
            yield from self.end()
            self.range, self.inside, self.begun = number, odd, False
            self.at_header = first and self.names is not None
        quotes = pc.count_substring(lines, self.quote).to_numpy(zero_copy_only=False)
        after = ((np.cumsum(quotes) + self.inside) & 1).astype(bool)
        begins = np.flatnonzero(~np.r_[self.inside, after[:-1]])
        head = int(begins[0]) if len(begins) else len(lines)
        if head:  # the record before goes on here
            self.pending.append(joined(lines.slice(0, head), [0, head])[0].as_py())
        self.inside = bool(after[-1])
        if not len(begins):
            if not self.inside:
                yield from self.close()
            return
        yield from self.close()
        ends = np.r_[begins[1:], len(lines)]
        if self.inside:
            self.pending, self.begun = [joined(lines.slice(begins[-1]), [0, len(lines) - begins[-1]])[0].as_py()], True
            begins, ends = begins[:-1], ends[:-1]
        if len(begins):
            part = lines.slice(head, ends[-1] - head)
            records = part if len(part) == len(begins) else joined(part, np.r_[begins, ends[-1]] - head)
            yield from self.out(records, WHOLE)

    def out(self, texts: pa.Array, kind: int) -> Iterator[tuple[pa.Array, int, int]]:
        if self.at_header and kind == WHOLE:
            # the first record that is not empty
            place = next((i for i, t in enumerate(texts) if t.as_py().strip("\r")), None)
            if place is None:
                return
            found = next(csv.reader([texts[place].as_py().removesuffix("\r")], delimiter=self.sep, quotechar=self.quote))
            if found != list(self.names):
                raise ValueError(f"header {found} where {list(self.names)} was expected")
            self.at_header, texts = False, texts.slice(place + 1)
        yield texts, kind, self.range

    def close(self) -> Iterator[tuple[pa.Array, int, int]]:
        """The record that goes on from an earlier batch or range ends."""
        if self.pending:
            yield from self.out(pa.array(["\n".join(self.pending)], pa.string()), WHOLE if self.begun else CONTINUED)
        self.pending, self.begun = [], False

    def end(self) -> Iterator[tuple[pa.Array, int, int]]:
        """What is left of the range's last record, if it goes on in the next range."""
        if self.pending:
            yield pa.array(["\n".join(self.pending)], pa.string()), BEGUN if self.begun else CONTINUED, self.range
        self.pending = []


def joined(lines: pa.Array, cuts) -> pa.Array:
    """Lines from one cut to the next as one text each."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.asarray(cuts, np.int32)), lines), "\n")


def _ranges(lines: DataFrame, quote: str) -> DataFrame:
    """(path, start, number, odd, cut) of the ranges of all files."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit(quote)))
    counted = lines.groupBy("path", "start").agg(F.sum(quotes).alias("quotes"))
    before = F.sum("quotes").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    odd = F.coalesce(before % 2 == 1, F.lit(False))
    # a range that begins or ends inside quotes holds fragments
    ends_inside = (F.coalesce(before, F.lit(0)) + F.col("quotes")) % 2 == 1
    counted = counted.select("path", "start", odd.alias("odd"), (odd | ends_inside).alias("cut"))
    return materialize(counted.withColumn("number", F.monotonically_increasing_id()), "csv-ranges")


def csv_records(
    spark: SparkSession, paths: Sequence[str], names: Sequence[str] | None = None, sep: str = ",", quote: str = '"'
) -> DataFrame | None:
    """(record) for every record of the files but their headers, which must be ``names`` if given.

    None if there are more ranges than may be broadcast.
    """
    ship_package(spark)
    source = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select("value", *source)
    ranges = _ranges(lines, quote)
    if ranges.count() > BROADCAST_RANGES:
        return None

    def pieces(own: DataFrame, whole: bool) -> DataFrame:
        """Whole records of all ranges, or the fragments of some, as (record, kind, number)."""
        unknown = F.raise_error(F.lit("the files were cut differently when their quotes were counted")).cast("long")
        placed = lines.join(F.broadcast(own), ["path", "start"], "left" if whole else "inner").select(
            "value", F.coalesce("number", unknown).alias("number"), "odd", (F.col("start") == 0).alias("first")
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state = Records(quote, names, sep)

            def rows(found) -> Iterator[pa.RecordBatch]:
                for texts, kind, number in found:
                    if (kind == WHOLE) == whole and len(texts):
                        columns = [texts, pa.array(np.full(len(texts), kind, np.int32)), pa.array(np.full(len(texts), number))]
                        yield pa.RecordBatch.from_arrays(columns, ["record", "kind", "number"])

            for batch in batches:
                numbers = batch.column("number").to_numpy()
                cuts = np.r_[0, np.flatnonzero(numbers[1:] != numbers[:-1]) + 1, len(numbers)].tolist()
                for a, b in zip(cuts[:-1], cuts[1:]):
                    if a < b:
                        part = batch.slice(a, b - a)
                        odd, first = (part.column(c)[0].as_py() for c in ("odd", "first"))
                        yield from rows(state.feed(part.column("value"), int(numbers[a]), odd, first))
            yield from rows(state.end())

        return placed.mapInArrow(run, "record string, kind int, number long")

    whole = pieces(ranges, True).select("record")
    cut = ranges.where("cut")
    if cut.take(1):
        order = Window.partitionBy("path").orderBy("start", "kind")
        nth = F.sum((F.col("kind") == BEGUN).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
        fragments = pieces(cut, False).join(ranges, "number").select("path", nth.alias("nth"), "start", "kind", "record")
        piece = F.sort_array(F.collect_list(F.struct("start", "kind", "record")))
        joined = fragments.groupBy("path", "nth").agg(F.array_join(F.transform(piece, lambda p: p["record"]), "\n").alias("record"))
        whole = whole.unionByName(joined.select("record"))
    record = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return whole.select(record.alias("record")).where(F.col("record") != "")


def parsed(records: DataFrame, schema, options: dict[str, str]) -> DataFrame:
    """The columns of ``schema`` (a StructType in the order of the file) from records."""
    row = F.from_csv("record", ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema), options)
    return records.select(row.alias("row")).select("row.*")
