"""The batch rules on Structured Streaming sources.

Each function takes a streaming DataFrame and returns a streaming DataFrame; sinks are chosen by
the caller. ``run_available`` drains a bounded source into a table, which is how the batch results
are reproduced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskframe.plans.risk import customer_summary, score_transactions
from riskframe.session import work_dir
from riskframe.streaming.keyed import number_rows


def read_parquet_stream(spark: SparkSession, folder: str, file_glob: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream the parquet files of a folder that match a pattern."""
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def keep_parsable(stream: DataFrame, column: str, condition: Column | None = None, name: str = "parsed") -> DataFrame:
    """Drop items that do not parse as integers, then apply an optional condition."""
    out = stream.withColumn(name, F.trim(column).try_cast("long")).filter(F.col(name).isNotNull())
    return out if condition is None else out.filter(condition)


def running_totals(stream: DataFrame, key: str, value: str) -> DataFrame:
    """Current total per key, updated as items arrive."""
    return stream.groupBy(key).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))


def flag_sequence(stream: DataFrame, condition: Column, key: str, order: Sequence[str], base: str) -> DataFrame:
    """Items that meet the condition, numbered 1, 2, 3, ... per key across micro-batches.

    Counts are in the stream's state store (``keyed.number_rows``), so a batch touches only the keys it
    has items of. Items are written under ``base`` by batch id, next to the stream's checkpoint: a
    retried batch overwrites its own output, and a later call with the same ``base`` goes on after the
    last batch, with the items that are new.
    """
    spark = stream.sparkSession
    numbered = number_rows(stream.filter(condition), key, order)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/items/batch={batch_id}")

    run_available(numbered, store, checkpoint=f"{base}/checkpoint")
    items = read_or_none(spark, f"{base}/items", numbered.schema)
    return spark.createDataFrame([], numbered.schema) if items is None else items


def running_rows(stream: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """Every item as it arrives, with its number (``seq``) and the total up to it (``running``) within its key."""
    return number_rows(stream, key, order, value)


def fraud_monitor(stream: DataFrame) -> DataFrame:
    """Score and action per arriving transaction: the batch rules, unchanged."""
    return score_transactions(stream)


def fraud_summary(stream: DataFrame, customer: str = "customer") -> DataFrame:
    return customer_summary(score_transactions(stream), customer)


def windowed_volume(
    stream: DataFrame, ts: str, value: str, length: str = "1 day", delay: str = "1 hour", hit: Column | None = None
) -> DataFrame:
    """Count and total per event-time window, and how many rows are a ``hit``.

    Late items beyond ``delay`` are dropped, and so is the state of windows they would fall in.
    """
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")]
    aggs += [] if hit is None else [F.count_if(hit).alias("hits")]
    out = stream.withWatermark(ts, delay).groupBy(F.window(ts, length)).agg(*aggs)
    return out.select(F.col("window.start").alias("window_start"), *out.columns[1:])


def monthly(days: DataFrame) -> DataFrame:
    """Volume, total and hit rate per month from daily windows."""
    return days.groupBy(F.date_format("window_start", "yyyy-MM").alias("month")).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), (F.sum("hits") / F.sum("n")).alias("rate")
    )


def dedupe(stream: DataFrame, key: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """First item per key; state for a key is dropped once the watermark passes it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def run_available(
    stream: DataFrame, on_batch: Callable[[DataFrame, int], Any], mode: str = "append", checkpoint: str | None = None
) -> None:
    """Process everything available, handing each micro-batch to ``on_batch``, then stop.

    With a ``checkpoint`` folder of an earlier run only what is new since then is processed.
    """
    spark = stream.sparkSession
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint or work_dir(spark, "stream"))
        .trigger(availableNow=True)
        .foreachBatch(on_batch)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()


def drain_to_table(stream: DataFrame) -> DataFrame:
    """Append-mode result of everything available, through an exactly-once file sink."""
    spark = stream.sparkSession
    path = work_dir(spark, "stream-out")
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", work_dir(spark, "stream"))
        .trigger(availableNow=True).start()
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return spark.read.schema(stream.schema).parquet(path)


def drain_state_table(stream: DataFrame, keys: Sequence[str], base: str | None = None) -> DataFrame:
    """Current state of an aggregate, one row per ``keys``, from update mode.

    A batch writes just the groups it changed, to a folder named by its batch id, so a retried batch
    overwrites its own; a group's last write counts. A ``base`` used before goes on after its last
    batch.
    """
    spark = stream.sparkSession
    base = base or work_dir(spark, "stream-state")

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/state/batch={batch_id}")

    run_available(stream, store, "update", f"{base}/checkpoint")
    schema = StructType([*stream.schema.fields, StructField("batch", LongType())])
    states = read_or_none(spark, f"{base}/state", schema)
    if states is None:  # nothing has arrived yet
        return spark.createDataFrame([], stream.schema)
    values = [c for c in stream.columns if c not in keys]
    last = states.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("__s"))
    return last.select(*keys, "__s.*").select(stream.columns)


def read_or_none(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def reduce_batches(stream: DataFrame, by: list[str], aggs: dict) -> DataFrame:
    """Fixed-size input batches reduced one at a time, then merged.

    ``aggs`` maps a name to (partial aggregate, function merging the partials). Each micro-batch
    (its size set by the reader's ``files_per_trigger``) leaves one small partial table behind;
    nothing else is kept between batches, and a retried batch overwrites its own folder.
    """
    spark = stream.sparkSession
    base = work_dir(spark, "stream-batches")
    schema = stream.groupBy(*by).agg(*[p.alias(n) for n, (p, _) in aggs.items()]).schema

    def store(batch: DataFrame, batch_id: int) -> None:
        partial = batch.groupBy(*by).agg(*[p.alias(n) for n, (p, _) in aggs.items()])
        partial.write.mode("overwrite").parquet(f"{base}/batch={batch_id}")

    run_available(stream, store)
    partials = read_or_none(spark, base, schema)
    if partials is None:
        partials = spark.createDataFrame([], schema)
    return partials.groupBy(*by).agg(*[merge(F.col(n)).alias(n) for n, (_, merge) in aggs.items()])
