"""Source quality: a score per graph from the metadata statements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadweld.functions.terms import as_number
from quadweld.model import LITERAL
from quadweld.operators.stage import attach, is_small


def source_scores(
    metadata: DataFrame,
    score: str,
    publisher: str,
    publisher_score: str,
    publisher_weight: float,
) -> DataFrame:
    """Score of every graph that the metadata knows something about.

    The graph's own average score and the average score of its publishers are
    mixed by ``publisher_weight``; one alone counts fully.
    """
    number = as_number(F.col("o_kind"), F.col("o"))
    known = metadata.select("s", "p", "o_kind", "o", number.alias("x"))
    own = (
        known.where((F.col("p") == score) & F.col("x").isNotNull())
        .groupBy(F.col("s").alias("g"))
        .agg(F.avg("x").alias("own"))
    )
    rated = (
        known.where((F.col("p") == publisher_score) & F.col("x").isNotNull())
        .groupBy(F.col("s").alias("publisher"))
        .agg(F.avg("x").alias("rate"))
    )
    published = known.where((F.col("p") == publisher) & (F.col("o_kind") != LITERAL)).select(
        F.col("s").alias("g"), F.col("o").alias("publisher")
    )
    by_publisher = (
        attach(published.distinct(), rated, ["publisher"], "inner")
        .groupBy("g")
        .agg(F.avg("rate").alias("pub"))
    )
    weight = F.lit(float(publisher_weight))
    mixed = (F.lit(1.0) - weight) * F.col("own") + weight * F.col("pub")
    return own.join(by_publisher, "g", "full").select(
        "g", F.coalesce(mixed, "own", "pub").alias("score")
    )


def scored_in_place(scores: DataFrame | None) -> bool:
    """Whether ``score_graphs`` leaves the rows in their tasks."""
    return scores is None or is_small(scores)


def score_graphs(df: DataFrame, scores: DataFrame | None, unknown: float) -> DataFrame:
    """Add the score ``w`` of each row's graph; graphs without one get ``unknown``."""
    if scores is None:
        return df.withColumn("w", F.lit(float(unknown)))
    joined = attach(df, scores, ["g"])
    return joined.withColumn("w", F.coalesce("score", F.lit(float(unknown)))).drop("score")
