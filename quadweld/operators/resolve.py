"""Conflict resolution: one or more result statements per cluster.

A resolution is two tables. ``statements`` has one row per result statement with its
quality and number of sources; ``support`` has one row per statement and source
graph. Keeping the sources as rows means that a statement backed by millions of
graphs never becomes one giant array; ``source_lists`` builds lists on request.

Inside a resolution an absent datatype or language is '' (see ``without_nulls``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadweld.functions.terms import as_decimal, as_number, number_distance, quantise, short_decimal
from quadweld.model import (
    IGNORE,
    IRI,
    LITERAL,
    MAX_DATE_DIFFERENCE,
    NESTED,
    SINGLEVALUED,
    XSD_DECIMAL,
    XSD_DOUBLE,
)
from quadweld.operators.lists import bounded_lists
from quadweld.operators.members import MEMBER, judge_values, with_nulls, without_nulls
from quadweld.operators.policy import Rules
from quadweld.operators.quality import CLUSTER, VALUE, agreement_quality, unopposed_quality, value_stats
from quadweld.operators.stage import grouped, heavy_keys, key_hash, keyed_lookup, lookup, materialize

STATEMENT = [*VALUE, "quality", "n_sources"]
#: Properties that a filter may name.
MOST_PROPERTIES = 1_000


def written(df: DataFrame, label: str) -> DataFrame:
    """A copy of rows whose datatype and language are never null; the copy forgets that."""
    return without_nulls(materialize(df, label))


class Resolution(NamedTuple):
    """Result statements, their source rows, and the hashes of those statements
    that may have very many sources. ``sourced`` is what ``source_rows`` gives, where that takes less than
    joining the two."""

    statements: DataFrame
    support: DataFrame
    heavy: list[int] = []
    sourced: DataFrame | None = None

    def plus(self, other: Resolution) -> Resolution:
        both = None
        if self.sourced is not None or other.sourced is not None:
            both = source_rows(self).unionByName(source_rows(other))
        return Resolution(
            self.statements.unionByName(other.statements),
            self.support.unionByName(other.support),
            [*self.heavy, *other.heavy],
            both,
        )


@dataclass(frozen=True)
class Clusters:
    """What a resolution function works on.

    ``members`` holds the (value, graph, weight) rows of the function's properties.
    ``large`` says that they are many enough for heavy keys to matter; they should
    then be a written table. ``even`` is not 0 if no resource among them is too large
    for one task, as ``dealt_members`` finds. ``near`` says that they are then a copy that lies by resource, so that
    reading and grouping them again takes no exchange.
    """

    members: DataFrame
    rules: Rules
    agree: float = 4.0
    span: float = MAX_DATE_DIFFERENCE
    large: bool = False
    even: int = 0
    near: bool = False

    @cached_property
    def values(self) -> DataFrame:
        """Distinct values with weights, strategy fields and quality."""
        return judge_values(value_stats(self.members), self.rules, self.agree, self.span, self.even)

    @cached_property
    def heavy_clusters(self) -> list[int]:
        return heavy_keys(self.members, CLUSTER) if self.large else []

    @cached_property
    def heavy_values(self) -> list[int]:
        return heavy_keys(self.members, VALUE) if self.large else []

    def of_values(self, chosen: DataFrame) -> Resolution:
        """The chosen values as statements, supported by the sources that claim them.

        The statements are written, so that support and lists don't choose again.
        """
        kept = written(chosen.select(*STATEMENT), "resolved")
        support = keyed_lookup(self.members, kept.select(*VALUE), VALUE, self.heavy_values, "left_semi")
        sourced = keyed_lookup(self.members.select(*MEMBER), kept, VALUE, self.heavy_values, "inner")
        return Resolution(kept, support.select(*MEMBER), self.heavy_values, sourced)

    def of_clusters(self, computed: DataFrame, usable: Column) -> Resolution:
        """One computed statement per cluster, supported by its usable members."""
        computed = written(computed.select(*STATEMENT), "resolved")
        graphs = self.members.where(usable).select(*CLUSTER, "g").distinct()
        sourced = keyed_lookup(graphs, computed, CLUSTER, self.heavy_clusters, "inner").select(*MEMBER, *STATEMENT[len(VALUE):])
        support = keyed_lookup(
            graphs, computed.select(*VALUE), CLUSTER, self.heavy_clusters, "inner"
        ).select(*MEMBER)
        heavy = []
        if self.heavy_clusters:
            large = computed.where(key_hash(CLUSTER).isin(self.heavy_clusters))
            heavy = [r["h"] for r in large.select(key_hash(VALUE).alias("h")).collect()]
        return Resolution(computed, support, heavy, sourced)

    def parameter(self, name: str, default: str) -> dict[str, Column]:
        """Values of a strategy parameter, each with its condition on ``p``."""
        return {v: self.rules.having_param(name, v, default) for v in self.rules.params(name, default)}

    def unusable(self, usable: Column) -> Resolution | None:
        """What a mediating function cannot use, kept as by ALL unless IGNOREd.

        The usual case, nothing unusable, is found by a filter on the members, and
        then no quality has to be computed; else it is that of the properties with something unusable alone.
        """
        left = ~self.rules.having("agg_error", IGNORE) & ~usable
        found = self.members.where(left).select("p").distinct().limit(MOST_PROPERTIES + 1).collect()
        if not found:
            return None
        if len(found) > MOST_PROPERTIES:
            return self.of_values(self.values.where(left))
        names = [r["p"] for r in found if r["p"] is not None]
        concerned = F.col("p").isin(names) if len(names) == len(found) else F.col("p").isin(names) | F.col("p").isNull()
        return self.of_values(replace(self, members=self.members.where(concerned)).values.where(left))


Resolver = Callable[[Clusters], Resolution]
REGISTRY: dict[str, Resolver] = {}


def register(name: str) -> Callable[[Resolver], Resolver]:
    """Add a resolution function under a name that policies can use."""

    def add(function: Resolver) -> Resolver:
        REGISTRY[name] = function
        return function

    return add


@register("ALL")
def resolve_all(clusters: Clusters) -> Resolution:
    """Every distinct value."""
    statements = clusters.values.select(*STATEMENT)
    opposed = SINGLEVALUED in clusters.rules.used("cardinality")
    # One grouping of a copy is no more work than a copy of its own.
    if opposed or not clusters.near:
        statements = written(statements, "resolved")
    sourced = None
    if clusters.even and not opposed:
        # Without conflicts the other sources of a value are all that counts, and they lie beside each other.
        rows = clusters.members.dropna(subset=VALUE).withColumn("_key", key_hash(VALUE))
        alike = Window.partitionBy("_key", *VALUE)
        stats = {"n_sources": F.count(F.lit(1)), "w_max": F.max("w"), "w_sum": F.sum("w")}
        judged = unopposed_quality(rows.withColumns({name: total.over(alike) for name, total in stats.items()}), clusters.agree)
        sourced = judged.select(*MEMBER, *STATEMENT[len(VALUE):])
    return Resolution(statements, clusters.members.select(*MEMBER), clusters.heavy_values, sourced)


def first_value(values: DataFrame, *order: Column) -> DataFrame:
    """The value that comes first per cluster; all ties end at the term itself.

    ``min`` of a struct is a partial aggregate, so no cluster is gathered or sorted.
    """
    ranks = [c.alias(f"r{i}") for i, c in enumerate(order)]
    rank = F.struct(*ranks, "o", "o_dt", "o_lang", "o_kind", "quality", "n_sources")
    best = grouped(values, CLUSTER).agg(F.min(rank).alias("best"))
    return best.select(*CLUSTER, *[F.col(f"best.{c}").alias(c) for c in STATEMENT[2:]])


@register("BEST")
def resolve_best(clusters: Clusters) -> Resolution:
    """The value of the highest quality; then most sources, then smallest value."""
    return clusters.of_values(
        first_value(clusters.values, -F.col("quality"), -F.col("n_sources"))
    )


def number() -> Column:
    """Double value of a numeric object, else null."""
    return as_number(F.col("o_kind"), F.col("o"))


def exact_or_double(exact: Column, double: Column) -> tuple[Column, Column]:
    """Text and datatype of a computed number: a decimal where that is exact, else the double."""
    text = F.coalesce(short_decimal(exact), double.cast("string"))
    return text, F.when(exact.isNotNull(), F.lit(XSD_DECIMAL)).otherwise(F.lit(XSD_DOUBLE))


def number_totals(clusters: Clusters) -> DataFrame:
    """Totals over the numeric members of each cluster, by way of totals per graph.

    ``n`` members from ``n_sources`` graphs, their sum as a double (``sum_x``) and,
    if every literal fits, as a decimal (``sum_d``), and their mean weight (``base``). No sum depends on the order.
    """
    numbers = clusters.members.where(number().isNotNull()).withColumns({"x": number(), "d": as_decimal(F.col("o"))})
    per_graph = numbers.groupBy(*CLUSTER, "g").agg(
        F.count(F.lit(1)).alias("n"),
        F.when(F.count("d") == F.count(F.lit(1)), F.try_sum("d")).alias("d"),
        F.max("w").alias("w"),
    )
    # A graph with several values counts once per value in the mean weight.
    totals = per_graph.groupBy(*CLUSTER).agg(
        F.count(F.lit(1)).alias("n_sources"),
        F.sum("n").alias("n"),
        F.when(F.count("d") == F.count(F.lit(1)), F.try_sum("d")).alias("sum_d"),
        (F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("base"),
    )
    # Decimals of this size always fit together, and then no double is needed.
    fits = F.col("d").isNotNull() & (F.abs("d") < F.lit(SURELY_SUMMED))
    if numbers.where(~fits).isEmpty():
        return totals.withColumn("sum_x", F.col("sum_d").cast("double"))
    return totals.join(exact_sums(numbers), CLUSTER)


#: With this many digits before the point, a decimal holds the sum of ten trillion numbers.
SURELY_SUMMED = 10**15
#: Numbers are summed as whole numbers of 10 to a multiple of this power.
LIMB = 9


def exact_sums(numbers: DataFrame) -> DataFrame:
    """Per cluster the sum ``sum_x`` of the doubles ``x``, the same in any order.

    The digits of a double are a whole number times a power of ten. Those of about the same power are added as
    whole numbers; the few sums of a cluster, by falling power, make the double.
    """
    text = F.abs("x").cast("string")
    mantissa, fraction = F.substring_index(text, "E", 1), F.substring_index(F.substring_index(text, "E", 1), ".", -1)
    digits = F.replace(mantissa, F.lit("."), F.lit("")).cast("decimal(20,0)")
    power = F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).cast("int")).otherwise(F.lit(0)) - F.length(fraction)
    limb = F.floor(power / F.lit(LIMB)).cast("int")
    lifted = F.lit(1).cast("decimal(9,0)")
    for k in range(1, LIMB):
        lifted = F.when(F.col("_power") - F.col("_limb") * LIMB == k, F.lit(10**k).cast("decimal(9,0)")).otherwise(lifted)
    whole = (F.col("_digits") * lifted).cast("decimal(29,0)") * F.signum("x").cast("decimal(1,0)")
    parts = numbers.select(*CLUSTER, "x", digits.alias("_digits"), power.alias("_power"), limb.alias("_limb"))
    sums = parts.groupBy(*CLUSTER, "_limb").agg(F.sum(whole.cast("decimal(28,0)")).alias("_sum"))
    falling = F.sort_array(F.collect_list(F.struct("_limb", "_sum")), asc=False)

    def added(total: Column, part: Column) -> Column:
        return total + F.concat(part["_sum"].cast("string"), F.lit("E"), part["_limb"] * LIMB).cast("double")

    return sums.groupBy(*CLUSTER).agg(F.aggregate(falling, F.lit(0.0), added).alias("sum_x"))


def computed_number(
    clusters: Clusters, totals: DataFrame, exact: Column, double: Column, opposed: bool = True
) -> DataFrame:
    """Statements with a number derived from the totals of each cluster.

    The conflict is measured from that number to each contributing member, unless
    the number is not on the members' scale (``opposed=False``).
    """
    text, datatype = exact_or_double(exact, double)
    single = clusters.rules.having("cardinality", SINGLEVALUED)
    result = totals.withColumns({"mid": double, "text": text, "dt": datatype})
    conf = F.lit(0.0)
    if opposed and SINGLEVALUED in clusters.rules.used("cardinality"):
        weights = (
            clusters.members.where(number().isNotNull() & single)
            .groupBy(*CLUSTER, number().alias("x"))
            .agg(F.sum("w").alias("w"))
        )
        gaps = keyed_lookup(
            weights, result.select(*CLUSTER, "mid"), CLUSTER, clusters.heavy_clusters, "inner"
        )
        conflict = gaps.groupBy(*CLUSTER).agg(
            F.sum(F.col("w") * number_distance(F.col("mid"), F.col("x"))).alias("gap"),
            F.sum("w").alias("mass"),
        )
        result = result.join(conflict, CLUSTER, "left")
        conf = F.when(F.col("mass") > 0, F.col("gap") / F.col("mass")).otherwise(F.lit(0.0))
    return result.select(
        *CLUSTER,
        F.lit(LITERAL).alias("o_kind"),
        F.col("text").alias("o"),
        F.col("dt").alias("o_dt"),
        F.lit("").alias("o_lang"),
        agreement_quality(F.col("base"), conf, F.lit(0.0), clusters.agree).alias("quality"),
        "n_sources",
    )


def mediate(clusters: Clusters, computed: DataFrame, usable: Column) -> Resolution:
    """A computed statement per cluster, and the rest by the error strategy."""
    result = clusters.of_clusters(computed, usable)
    rest = clusters.unusable(usable)
    return result if rest is None else result.plus(rest)


@register("AVG")
def resolve_avg(clusters: Clusters) -> Resolution:
    """Mean over the numeric members, a decimal where ten digits hold it exactly."""
    # These types leave quotient and remainder all their digits.
    n, total = F.col("n").cast("decimal(12,0)"), F.col("sum_d").try_cast("decimal(28,10)")
    unit = F.lit("0.0000000001").cast("decimal(10,10)")
    exact = F.when(total % (n * unit) == 0, (total / n).try_cast("decimal(28,10)"))
    mean = F.coalesce(F.col("sum_d").cast("double"), F.col("sum_x")) / F.col("n")
    totals = materialize(number_totals(clusters), "totals")
    computed = computed_number(clusters, totals, exact, mean)
    return mediate(clusters, computed, number().isNotNull())


@register(NESTED)
def resolve_nested(clusters: Clusters) -> Resolution:
    """Values as by ALL; their quality is settled by ``nested_quality`` afterwards."""
    return resolve_all(clusters)


def nested_quality(
    nested: DataFrame,
    statements: DataFrame,
    heavy: list[int] | None = None,
    heavy_resources: list[int] | None = None,
) -> DataFrame:
    """Quality of a nested IRI value: the mean quality of its own statements.

    Values without statements of their own keep the quality they have.
    """
    children = nested.where(F.col("o_kind") == IRI).select(F.col("o").alias("res")).distinct()
    mean = (
        lookup(statements, children, ["res"], heavy_resources, "left_semi")
        .groupBy(F.col("res").alias("o"))
        .agg(quantise(F.avg("quality")).alias("_mean"))
    )
    met = lookup(nested, mean, ["o"], heavy)
    inner = F.when(F.col("o_kind") == IRI, F.col("_mean"))
    return met.withColumn("quality", F.coalesce(inner, F.col("quality"))).select(*nested.columns)


def resolve(
    members: DataFrame,
    rules: Rules,
    agree: float,
    span: float = MAX_DATE_DIFFERENCE,
    large: bool = False,
    even: int = 0,
    near: bool = False,
) -> Resolution:
    """Apply each property's resolution function and put the results together.

    Every function reads only the members of its own properties. ``large``, ``even`` and ``near``: see ``Clusters``.
    """
    functions = sorted(rules.used("function"))
    missing = [f for f in functions if f not in REGISTRY]
    if missing:
        raise ValueError(f"unknown resolution function: {', '.join(missing)}")
    done: dict[str, Resolution] = {}
    for name in functions:
        own = members.where(rules.having("function", name))
        done[name] = REGISTRY[name](
            Clusters(own, rules.only("function", name), agree, span, large, even, near)
        )
    if NESTED in done:
        # Children can be resolved by any function, so all statements are read again.
        everything = None
        for part in done.values():
            rows = part.statements
            everything = rows if everything is None else everything.unionByName(rows)
        nested = done[NESTED]
        heavy = heavy_keys(nested.statements, ["o"]) if large else []
        heavy_resources = heavy_keys(everything, ["res"]) if large else []
        done[NESTED] = nested._replace(
            statements=written(
                nested_quality(nested.statements, everything, heavy, heavy_resources), "nested"
            ),
            sourced=None,
        )
    parts = list(done.values())
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.plus(part)
    return whole


def as_statements(df: DataFrame) -> DataFrame:
    """Result rows under their outside names, with nulls for absent term parts."""
    return with_nulls(df.withColumnRenamed("res", "s"))


def source_rows(resolution: Resolution) -> DataFrame:
    """Statements with one row per source graph ``g``."""
    if resolution.sourced is not None:
        return resolution.sourced
    return keyed_lookup(resolution.support, resolution.statements, VALUE, resolution.heavy, "inner")


def source_lists(resolution: Resolution, limit: int) -> DataFrame:
    """Statements with sorted source names, keyed by the statement and ``part``.

    Takes the inside form. The join and the grouping share one partitioning.
    """
    rows = keyed_lookup(
        resolution.support, resolution.statements, VALUE, resolution.heavy, "inner", keep=True
    )
    lists = bounded_lists(
        rows, ["_key", *resolution.statements.columns], "g", "sources", limit, size="n_sources"
    )
    return as_statements(lists.drop("_key"))


def with_result_graph(statements: DataFrame, prefix: str, infix: str) -> DataFrame:
    """Name of the result graph: prefix, infix and a slash."""
    return statements.withColumn("g", F.lit(f"{prefix}{infix}/"))
