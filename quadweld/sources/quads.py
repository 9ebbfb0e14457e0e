"""Reading quads, identity links and source metadata."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quadweld.model import BNODE, LITERAL, OWL_SAME_AS, QUAD, QUADS_SCHEMA
from quadweld.operators.stage import attach


def empty_quads(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], QUADS_SCHEMA)


def scan_quads(quads: DataFrame, graphs: DataFrame | Sequence[str]) -> DataFrame:
    """Quads of the declared graphs only.

    A list of names becomes an IN filter, which Parquet can use to skip row
    groups; a table with a column ``g`` becomes a semi join.
    """
    if isinstance(graphs, DataFrame):
        return attach(quads, graphs.select("g").distinct(), ["g"], "left_semi")
    return quads.where(F.col("g").isin(list(graphs)))


def _own_label(term: Column, number: int) -> Column:
    return F.concat(F.lit(f"_:{number}:"), F.substring(term, 3, 1 << 30))


def number_input(quads: DataFrame, number: int) -> DataFrame:
    """Record the input number and keep blank nodes of different inputs apart."""
    return quads.withColumns(
        {
            "src": F.lit(number),
            "s": F.when(F.col("s").startswith("_:"), _own_label(F.col("s"), number)).otherwise(
                F.col("s")
            ),
            "o": F.when(F.col("o_kind") == BNODE, _own_label(F.col("o"), number)).otherwise(
                F.col("o")
            ),
        }
    ).select(*QUADS_SCHEMA.names)


def concat_inputs(*inputs: DataFrame | None) -> DataFrame:
    """All quads of all given inputs, repeats included; absent inputs are skipped."""
    given = [q for q in inputs if q is not None]
    if not given:
        raise ValueError("at least one input is required")
    merged = number_input(given[0], 1)
    for number, quads in enumerate(given[1:], start=2):
        merged = merged.unionByName(number_input(quads, number))
    return merged


def distinct_quads(quads: DataFrame) -> DataFrame:
    """Set of quads; a quad found in several inputs keeps the first input number."""
    return quads.groupBy(*QUAD).agg(F.min("src").alias("src")).select(*QUADS_SCHEMA.names)


def union_inputs(*inputs: DataFrame | None) -> DataFrame:
    return distinct_quads(concat_inputs(*inputs))


def scan_links(quads: DataFrame, types: Iterable[str] = (OWL_SAME_AS,)) -> DataFrame:
    """Identity links of every graph; literal objects and self-links are dropped."""
    return quads.where(
        F.col("p").isin(list(types))
        & (F.col("o_kind") != LITERAL)
        & (F.col("s") != F.col("o"))
    ).select("s", "o")


def scan_metadata(quads: DataFrame | None, spark: SparkSession | None = None) -> DataFrame:
    """Every metadata statement once; no input gives an empty table."""
    if quads is None:
        return empty_quads(spark or SparkSession.active())
    return quads.dropDuplicates(QUAD)


def default_graph(graphs: DataFrame | Sequence[str]) -> str | None:
    """Smallest declared graph, or None when none is declared."""
    if isinstance(graphs, DataFrame):
        return graphs.agg(F.min("g")).first()[0]
    return min(graphs, default=None)


def fill_graph(quads: DataFrame, default: str | None) -> DataFrame:
    return quads.withColumn("g", F.coalesce("g", F.lit(default).cast("string")))


def load_stats(quads: DataFrame) -> DataFrame:
    """Number of loaded quads per graph."""
    return quads.groupBy("g").agg(F.count(F.lit(1)).alias("n"))


def observe_loaded(quads: DataFrame, name: str = "loaded") -> tuple[DataFrame, Observation]:
    """Total row count gathered while another action runs, without a second pass."""
    seen = Observation(name)
    return quads.observe(seen, F.count(F.lit(1)).alias("n")), seen
