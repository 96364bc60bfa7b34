"""Word and character frequencies over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def token_counts(df: DataFrame, text: str, sep: str = " ") -> DataFrame:
    """Pieces between separators (empty ones included) with their counts."""
    pieces = df.filter(F.col(text).isNotNull()).select(F.explode(F.split(text, sep)).alias("token"))
    return pieces.groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """Words separated by spaces or line breaks; lines are taken apart after equal tokens combine."""
    words = token_counts(df, text).select(F.explode(F.split("token", "\n")).alias("token"), "cnt")
    return words.filter("token <> ''").groupBy("token").agg(F.sum("cnt").alias("cnt"))


def char_counts(df: DataFrame, text: str) -> DataFrame:
    """Characters of all texts, from distinct tokens weighted by their counts.

    Only tokens are taken apart into characters, not texts. A piece that is not the first of its text
    follows a separator, so one pass over the texts counts these as well.
    """
    pieces = df.filter(F.col(text).isNotNull()).select(F.posexplode(F.split(text, " ")).alias("place", "token"))
    tokens = pieces.groupBy("token").agg(F.count(F.lit(1)).alias("cnt"), F.count_if(F.col("place") > 0).alias("after"))
    letters = F.transform(F.split("token", ""), lambda c: F.struct(c.alias("token"), F.col("cnt").alias("cnt")))
    blank = F.struct(F.lit(" ").alias("token"), F.col("after").alias("cnt"))
    parts = tokens.select(F.inline(F.array_append(letters, blank)))
    return parts.filter("token <> '' and cnt > 0").groupBy("token").agg(F.sum("cnt").alias("cnt"))
