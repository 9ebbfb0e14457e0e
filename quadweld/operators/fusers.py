"""Further resolution functions of the registry.

All of them end in partial aggregates (``min`` of a struct, sums, counts), group
limits or filters, so a cluster of any size is reduced where its rows are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadweld.functions.terms import as_decimal, as_seconds, quantise
from quadweld.model import LITERAL
from quadweld.operators import stage
from quadweld.operators.members import MEMBER, judge_values, without_nulls
from quadweld.operators.quality import CLUSTER, VALUE, value_stats
from quadweld.operators.resolve import (
    STATEMENT,
    Clusters,
    Resolution,
    computed_number,
    first_value,
    mediate,
    number,
    number_totals,
    register,
    written,
)
from quadweld.operators.running import cumulate
from quadweld.operators.stage import grouped, heavy_keys, key_hash, keyed_lookup, lookup, materialize


def _decided(clusters: Clusters, usable: Column, *order: Column) -> Resolution:
    """The first usable value, and the rest by the error strategy."""
    best = first_value(clusters.values.where(usable), *order)
    rest = clusters.unusable(usable)
    chosen = clusters.of_values(best)
    return chosen if rest is None else chosen.plus(rest)


def _always() -> Column:
    return F.lit(True)


@register("ANY")
def resolve_any(clusters: Clusters) -> Resolution:
    """One value; always the least term, so that reruns agree."""
    return _decided(clusters, _always())


@register("MIN")
def resolve_min(clusters: Clusters) -> Resolution:
    """The value with the least number."""
    return _decided(clusters, number().isNotNull(), number())


@register("MAX")
def resolve_max(clusters: Clusters) -> Resolution:
    """The value with the greatest number."""
    return _decided(clusters, number().isNotNull(), -number())


@register("LONGEST")
def resolve_longest(clusters: Clusters) -> Resolution:
    return _decided(clusters, _always(), -F.length("o"))


@register("SHORTEST")
def resolve_shortest(clusters: Clusters) -> Resolution:
    return _decided(clusters, _always(), F.length("o"))


@register("VOTE")
def resolve_vote(clusters: Clusters) -> Resolution:
    """The value with most sources."""
    return _decided(clusters, _always(), -F.col("n_sources"))


@register("WEIGHTED_VOTE")
def resolve_weighted_vote(clusters: Clusters) -> Resolution:
    """The value whose sources have the greatest total score."""
    return _decided(clusters, _always(), -quantise(F.col("w_sum")))


@register("MOST_RECENT")
def resolve_most_recent(clusters: Clusters) -> Resolution:
    """The value with the latest date."""
    seconds = as_seconds(F.col("o_kind"), F.col("o"))
    return _decided(clusters, seconds.isNotNull(), -seconds)


@register("SUM")
def resolve_sum(clusters: Clusters) -> Resolution:
    """Sum over the numeric members."""
    exact = F.col("sum_d").cast("decimal(38,10)")
    double = F.coalesce(F.col("sum_d").cast("double"), F.col("sum_x"))
    computed = computed_number(clusters, number_totals(clusters), exact, double, opposed=False)
    return mediate(clusters, computed, number().isNotNull())


def _middle(clusters: Clusters) -> DataFrame:
    """The middle number, or the two middle numbers, of each cluster."""
    counted = (
        clusters.members.where(number().isNotNull())
        .groupBy(*CLUSTER, number().alias("x"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(as_decimal(F.col("o"))).alias("d"),
        )
    )
    placed = cumulate(counted, CLUSTER, ["x"], "n", "upto", clusters.heavy_clusters)
    totals = counted.groupBy(*CLUSTER).agg(F.sum("n").alias("all"))
    met = lookup(placed, totals, CLUSTER, clusters.heavy_clusters, "inner")

    def holds(position: Column) -> Column:
        return (F.col("upto") >= position) & (F.col("upto") - F.col("n") < position)

    low = holds(F.floor((F.col("all") + 1) / 2))
    high = holds(F.floor(F.col("all") / 2) + 1)
    return met.groupBy(*CLUSTER).agg(
        *[
            F.max(F.when(side, F.col(c))).alias(f"{c}_{name}")
            for name, side in (("low", low), ("high", high))
            for c in ("x", "d")
        ]
    )


@register("MEDIAN")
def resolve_median(clusters: Clusters) -> Resolution:
    """Median over the numeric members."""
    totals = number_totals(clusters).join(_middle(clusters), CLUSTER)
    half = F.lit(2).cast("decimal(1,0)")
    # Exact only where every literal is a plain decimal, as in the sum.
    exact = F.when(
        F.col("sum_d").isNotNull(), (F.col("d_low") + F.col("d_high")) / half
    ).cast("decimal(38,10)")
    double = (F.col("x_low") + F.col("x_high")) / F.lit(2.0)
    computed = computed_number(clusters, totals, exact, double)
    return mediate(clusters, computed, number().isNotNull())


@register("TOP_N")
def resolve_top_n(clusters: Clusters) -> Resolution:
    """The ``n`` values of the highest quality (parameter ``n``, 1 by default).

    A row number compared with a constant becomes a group limit, which drops the
    other rows before the shuffle.
    """
    ranked = Window.partitionBy(*CLUSTER).orderBy(
        F.desc("quality"), F.desc("n_sources"), "o", "o_dt", "o_lang", "o_kind"
    )
    parts = [
        clusters.values.where(has)
        .withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") <= int(n))
        .drop("_rank")
        for n, has in clusters.parameter("n", "1").items()
    ]
    return clusters.of_values(reduce(DataFrame.unionByName, parts))


@register("THRESHOLD")
def resolve_threshold(clusters: Clusters) -> Resolution:
    """Values whose quality reaches the parameter ``threshold`` (0 by default)."""
    reached = F.lit(False)
    for threshold, has in clusters.parameter("threshold", "0").items():
        reached = reached | (has & (F.col("quality") >= F.lit(float(threshold))))
    return clusters.of_values(clusters.values.where(reached))


@register("CHOOSE_SOURCE")
def resolve_choose_source(clusters: Clusters) -> Resolution:
    """Values claimed by the graph named in the parameter ``source``."""
    claimed = F.lit(False)
    for source, has in clusters.parameter("source", "").items():
        claimed = claimed | (has & (F.col("g") == source))
    keys = clusters.members.where(claimed).select(*VALUE).distinct()
    return clusters.of_values(lookup(clusters.values, keys, VALUE, None, "left_semi"))


@register("BEST_SOURCE")
def resolve_best_source(clusters: Clusters) -> Resolution:
    """Values claimed by the best-scored graph of the cluster.

    A graph has one weight. So each value keeps the best graph that claims it, and the values whose best one is the cluster's stay.
    """
    lead = F.min(F.struct((-F.col("w")).alias("rank"), "g")).alias("_lead")
    values = judge_values(value_stats(clusters.members, lead), clusters.rules, clusters.agree, clusters.span, clusters.even)
    if clusters.heavy_clusters:
        values = without_nulls(materialize(values.select(*STATEMENT, "_lead"), "leads"))
        best = values.groupBy(*CLUSTER).agg(F.min("_lead").alias("_best"))
        met = keyed_lookup(values, best, CLUSTER, clusters.heavy_clusters, "inner")
    else:
        met = values.withColumn("_key", key_hash(CLUSTER)).withColumn(
            "_best", F.min("_lead").over(Window.partitionBy("_key", *CLUSTER))
        )
    # A term that is null in part equals none, and neither does a graph without a name.
    same = (F.col("_lead.rank") == F.col("_best.rank")) & (F.col("_lead.g") == F.col("_best.g"))
    return clusters.of_values(met.where(same).dropna(subset=VALUE))


#: Characters of a concatenation in one row, unless the parameter ``block`` says otherwise.
CONCAT_BLOCK = 10_000


def _parameter(clusters: Clusters, name: str, default: str) -> Column:
    value = F.lit(default)
    for given, has in clusters.parameter(name, default).items():
        value = F.when(has, F.lit(given)).otherwise(value)
    return value


def concat_places(clusters: Clusters) -> DataFrame:
    """Distinct texts of each cluster with the place that each takes in their concatenation.

    Texts stand in rising order with the parameter ``separator`` (a space by default) between them. ``start``
    counts the characters before a text, ``part`` the full blocks of ``block`` characters before that. Totals of heavy clusters go over sorted ranges.
    """
    size = F.length("o") + F.length(_parameter(clusters, "separator", " "))
    texts = clusters.members.select(*CLUSTER, "o").distinct().withColumn("_size", size.cast("double"))
    placed = cumulate(texts, CLUSTER, ["o"], "_size", "_upto", clusters.heavy_clusters)
    start = (F.col("_upto") - F.col("_size")).cast("long")
    block = _parameter(clusters, "block", str(CONCAT_BLOCK)).cast("long")
    return placed.select(*CLUSTER, "o", start.alias("start"), F.floor(start / block).alias("part"))


def concat_parts(clusters: Clusters, places: DataFrame) -> DataFrame:
    """Consecutive pieces of each concatenation, keyed by cluster and ``part``; nothing is cut.

    A piece holds the texts that start in one block, so its length is at most a block and one text. The whole is
    the pieces by ``start`` with the separator between them.
    """
    texts = F.transform(F.sort_array(F.collect_list(F.struct("start", "o"))), lambda t: t["o"])
    pieces = grouped(places, [*CLUSTER, "part"]).agg(F.min("start").alias("start"), texts.alias("_texts"))
    separator = _parameter(clusters, "separator", " ")
    return pieces.select(*CLUSTER, "part", "start", F.call_function("array_join", F.col("_texts"), separator).alias("text"))


@register("CONCAT")
def resolve_concat(clusters: Clusters) -> Resolution:
    """The distinct texts of a cluster as one literal; beyond ``block`` characters as several, one per piece.

    A piece has the mean weight of its members as quality, since nothing contradicts it, and their sources.
    """
    if clusters.even:
        return _concat_in_place(clusters)
    places = materialize(concat_places(clusters), "places")
    text, piece = [*CLUSTER, "o"], [*CLUSTER, "part"]
    often = heavy_keys(clusters.members, text) if clusters.large else []
    backed = keyed_lookup(clusters.members, places, text, often, "inner")
    graphs = materialize(
        backed.groupBy(*piece, "g").agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("w")), "graphs"
    )
    totals = graphs.groupBy(*piece).agg(
        F.count(F.lit(1)).alias("n_sources"), quantise(F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("quality")
    )
    pieces = concat_parts(clusters, places).join(totals, piece)
    nothing = F.lit("")
    computed = pieces.select(
        *CLUSTER, F.lit(LITERAL).alias("o_kind"), F.col("text").alias("o"), nothing.alias("o_dt"), nothing.alias("o_lang"),
        "quality", "n_sources", "part",
    )
    computed = written(computed, "resolved")
    often = heavy_keys(graphs, piece) if clusters.large else []
    support = keyed_lookup(graphs.select(*piece, "g"), computed.select(*VALUE, "part"), piece, often, "inner")
    heavy = []
    if clusters.heavy_clusters:
        large = computed.where(key_hash(CLUSTER).isin(clusters.heavy_clusters) & (F.col("n_sources") > stage.HEAVY_FLOOR))
        heavy = [r["h"] for r in large.select(key_hash(VALUE).alias("h")).collect()]
    return Resolution(computed.select(*STATEMENT), support.select(*MEMBER), heavy)


def _concat_in_place(clusters: Clusters) -> Resolution:
    """``resolve_concat`` where no resource is too large for one task: members that lie by resource stay where they are.

    Equal texts stand together in the order of a cluster, and the first of them counts; the places are those of ``concat_places``.
    """
    size = (F.length("o") + F.length(_parameter(clusters, "separator", " "))).cast("double")
    rising = Window.partitionBy("_key", *CLUSTER).orderBy("o")
    # A term that is null in part equals none.
    rows = clusters.members.dropna(subset=[*CLUSTER, "o"]).withColumns({"_key": key_hash(CLUSTER), "_size": size})
    rows = rows.withColumn("_first", ~F.col("o").eqNullSafe(F.lag("o").over(rising)))
    upto = F.sum(F.when(F.col("_first"), F.col("_size"))).over(rising.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("start", (upto - F.col("_size")).cast("long"))
    block = _parameter(clusters, "block", str(CONCAT_BLOCK)).cast("long")
    placed = rows.withColumn("part", F.floor(F.col("start") / block))
    piece = [*CLUSTER, "part"]
    graphs = placed.groupBy("_key", *piece, "g").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("w").alias("w"),
        F.collect_list(F.when(F.col("_first"), F.struct("start", "o"))).alias("_texts"),
    )
    texts = F.transform(F.sort_array(F.flatten(F.collect_list("_texts"))), lambda t: t["o"])
    pieces = graphs.groupBy("_key", *piece).agg(
        F.count(F.lit(1)).alias("n_sources"),
        quantise(F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("quality"),
        texts.alias("_texts"),
    )
    nothing, separator = F.lit(""), _parameter(clusters, "separator", " ")
    computed = pieces.select(
        *CLUSTER, F.lit(LITERAL).alias("o_kind"), F.call_function("array_join", F.col("_texts"), separator).alias("o"),
        nothing.alias("o_dt"), nothing.alias("o_lang"), "quality", "n_sources", "part",
    )
    computed = written(computed, "resolved")
    support = keyed_lookup(placed.select(*piece, "g").distinct(), computed.select(*VALUE, "part"), piece, how="inner")
    return Resolution(computed.select(*STATEMENT), support.select(*MEMBER))


@register("NONE")
def resolve_none(clusters: Clusters) -> Resolution:
    """Every value with the best score of its sources; nothing is weighed up."""
    values = value_stats(clusters.members).withColumn("quality", quantise(F.col("w_max")))
    return clusters.of_values(values)
