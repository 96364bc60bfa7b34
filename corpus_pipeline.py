"""A corpus pipeline over ``documents``: each stage calls one operator of ``riskframe.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
back as the next stage's docs. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import bpe, mixing, pii, simhash, toxicity
from riskframe.llm.queries import table, tokenizer_path
from riskframe.session import work_dir

#: Rows up to which a list of decisions, about 20 bytes each, is broadcast to the texts.
BROADCAST_ROWS = 100_000
#: Draws of copies of one row that a task writes out together.
LOT = 64


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__id``, a digest of id and text that tells null from empty."""
    tag = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    return docs.withColumn("__id", F.unhex(F.sha2(F.concat_ws(" ", tag("doc_id"), tag("text")), 256)))


def keep_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Identified ``docs`` without the ``__id``s in ``dropped``, the smaller side of every decision here."""
    small = dropped.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(dropped) if small else dropped, "__id", "left_anti")


def saved(df: DataFrame, purpose: str) -> DataFrame:
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go, row by row, with or without an id."""
    scorer = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    rows = identified(docs)
    rejected = toxicity.score(rows, scorer, key="__id", threshold=0.3).where("predicted = 1")
    return keep_rows(rows, saved(rejected.select("__id").distinct(), "toxic")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of near duplicates the document with the smallest id stays; rows of the group that
    repeat its id are one document. Of a group without ids one row stays."""
    rows = identified(docs)
    named = rows.withColumn("__name", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__id"))
    groups = simhash.near_duplicates(named.select("__name", "text"), shingle=3, distance=3, seed=42, key="__name")
    own, first = F.col("__name"), F.col("component_id")
    stays = F.when(own["none"], own["__id"] == first["__id"]).otherwise(own["doc_id"].eqNullSafe(first["doc_id"]))
    dropped = groups.where(~stays).select(own["__id"].alias("__id")).distinct()
    kept = keep_rows(rows, saved(dropped, "near-duplicates"))
    # copies without an id share their digest
    alone = kept.where("doc_id is null").groupBy("__id").agg(F.min(F.struct(*docs.columns)).alias("r")).select("r.*")
    return kept.where("doc_id is not null").select(docs.columns).unionByName(alone)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; n_chars follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time a document is taken, with the words that are taken then.

    A document that is taken whole keeps its text as it is; of another one the words of its drawn
    blocks are joined by blanks. Of rows that repeat id, text and source each drawn copy comes out as
    often as it was drawn, with the other columns of the least. Rows come out shard by shard, in the
    shuffled order of the shard; a document with pieces in several shards goes to the first of them.
    """
    taken = mixing.mix(docs, weights=(5, 2, 1), cap=3).where("taken > 0")
    epochs = taken.select(
        F.col("row").alias("__row"), F.col("source").alias("__source"), "size",
        F.explode(F.array_distinct(F.transform("pieces", lambda p: p["epoch"]))).alias("__epoch"), "pieces",
    )
    parts = epochs.withColumn("__parts", F.array_sort(F.transform(
        F.filter("pieces", lambda p: p["epoch"] == F.col("__epoch")),
        lambda p: F.struct(p["first"].alias("first"), p["words"].alias("words")),
    ))).withColumn("__place", F.array_min(F.transform(
        F.filter("pieces", lambda p: p["epoch"] == F.col("__epoch")),
        lambda p: F.struct(p["shard"].alias("shard"), p["order"].alias("order")),
    ))).withColumn("__n", F.aggregate("__parts", F.lit(0).cast("long"), lambda s, p: s + p["words"]))
    what = ["__row", "__source", "__epoch", "__parts", (F.col("__n") == F.col("size")).alias("__whole"), F.col("__place.shard").alias("__shard")]
    grouped = parts.select(*what, F.col("__place.order").alias("__order")).groupBy("__row", "__source", "__epoch", "__parts", "__whole", "__shard")
    parts = saved(grouped.agg(F.count(F.lit(1)).alias("__times"), F.min("__order").alias("__order")), "mixed")
    rows = docs.withColumn("__row", F.xxhash64(F.lit(9), "doc_id", "text")).withColumn("__source", F.col("source").cast("string"))
    repeated = rows.groupBy("__row", "__source").count().where("count > 1").select(F.col("__row").alias("__r"), F.col("__source").alias("__s"))
    repeated = saved(repeated, "mixed-repeated")
    small = repeated.count() <= BROADCAST_ROWS
    repeated = F.broadcast(repeated) if small else repeated
    same = (F.col("__row") == F.col("__r")) & F.col("__source").eqNullSafe(F.col("__s"))
    drawn = parts.withColumnsRenamed({"__row": "__r", "__source": "__s"})
    once = rows.join(repeated, same, "left_anti").join(drawn, same)
    # one row stands for its copies; its draws are dealt to tasks in lots, then written out
    least = rows.join(repeated, same, "left_semi").groupBy("__row", "__source").agg(F.min(F.struct(*docs.columns)).alias("r"))
    least = least.select("__row", "__source", "r.*").join(drawn, same)
    lots = least.withColumn("__lot", F.explode(F.expr(f"sequence(1L, __times, {LOT}L)")))
    lots = lots.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    again = lots.withColumn("__lot", F.explode(F.expr(f"sequence(__lot, least(__lot + {LOT - 1}, __times))"))).drop("__lot")
    rows = once.unionByName(again)
    words = F.regexp_extract_all("text", F.lit(f"({mixing.WORDS})"), 1)
    cut = F.array_join(F.flatten(F.transform("__parts", lambda p: F.slice(F.col("__words"), (p["first"] + 1).cast("int"), p["words"].cast("int")))), " ")
    rows = rows.withColumn("__words", F.when(~F.col("__whole"), words))
    rows = rows.withColumn("text", F.when(F.col("__whole"), F.col("text")).otherwise(cut))
    rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.repartition("__shard").sortWithinPartitions("__shard", "__order", "__row").select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the decoded text."""
    return bpe.encode_decode(docs, tokenizer_path(), ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("pii", personal_data),
    ("mixing", mixed),
    ("bpe", encoded),
]

#: No stage of this pipeline has an equivalent in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
