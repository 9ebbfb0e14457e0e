"""One query per operator, over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from quadweld.functions.terms import distance
from quadweld.model import IGNORE, MANYVALUED, NESTED, QUALITY_PROPERTY, RETURN_ALL, SINGLEVALUED
from quadweld.operators import describe as describing
from quadweld.operators import identity, sinks
from quadweld.operators import policy as policies
from quadweld.operators.fusers import concat_parts, concat_places
from quadweld.operators.members import conflict_members, dealt_members, mapped_by_exchange, to_cluster_rows, with_nulls, without_nulls
from quadweld.operators.resolve import (
    REGISTRY,
    Clusters,
    Resolution,
    as_statements,
    source_rows,
    with_result_graph,
)
from quadweld.operators.scores import score_graphs, scored_in_place, source_scores
from quadweld.operators.policy import Rules
from quadweld.operators.stage import materialize, scratch_dir
from quadweld.plans.config import FusionConfig, Strategy
from quadweld.plans.fuse import fuse
from quadweld.sources import canonical, quads as sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

P = "http://ex/p/"
META = "http://ex/meta/"
UNKNOWN_SCORE, PUBLISHER_WEIGHT, AGREE = 1.0, 0.2, 4.0

# How the properties of the claims are resolved in the checks that need a policy.
SINGLE = ("price", "flag", "qty", "shipped")
EVERY = ("price", "discount", "flag", "qty", "shipped")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(value: Column) -> Column:
    """Six digits; the offset keeps short decimals off the rounding edge."""
    return F.floor(value * F.lit(1e6) + F.lit(0.50005)) / F.lit(1e6)


def number_text(column: str) -> Column:
    """Millionths of a number as text; other texts as they are."""
    number = F.col(column).try_cast("double")
    millionths = F.floor(number * F.lit(1e6) + F.lit(0.50005)).cast("bigint").cast("string")
    return F.coalesce(millionths, F.col(column))


def scratch(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/quadweld/check-{uuid.uuid4().hex}"


def claims(spark, sf) -> DataFrame:
    return fx.claims(spark, sf)


def metadata(spark, sf) -> DataFrame:
    return fx.quads(spark, sf, fx.SCORES)


def scores(spark, sf) -> DataFrame:
    return source_scores(
        sources.scan_metadata(metadata(spark, sf)),
        f"{META}score",
        f"{META}publishedBy",
        f"{META}publisherScore",
        PUBLISHER_WEIGHT,
    )


def mapping(spark, sf) -> DataFrame:
    links = sources.scan_links(fx.quads(spark, sf, fx.LINKS))
    return identity.canonical_map(links, fx.run(spark, sf, fx.PREFERRED))


def strategies(**functions: Strategy) -> FusionConfig:
    return FusionConfig(properties={f"{P}{k}": v for k, v in functions.items()})


def rules_for(spark, **functions: Strategy) -> Rules:
    return Rules.read(strategies(**functions).policy(spark))


def single_rules(spark) -> Rules:
    return rules_for(spark, **{p: Strategy(cardinality=SINGLEVALUED) for p in SINGLE})


def members(spark, sf, quads: DataFrame, merged: bool) -> tuple[DataFrame, int]:
    """Weighed claims, and over how many tasks they lie by resource (see ``distinct_dealt``)."""
    found = mapping(spark, sf) if merged else None
    rows, even = dealt_members(to_cluster_rows(quads, found), once=mapped_by_exchange(found))
    known = scores(spark, sf)
    return score_graphs(rows, known, UNKNOWN_SCORE), even if scored_in_place(known) else min(even, 1)


def clusters(spark, sf, rules: Rules, merged: bool) -> Clusters:
    rows, even = members(spark, sf, claims(spark, sf), merged)
    if merged and even > 1:
        rows = without_nulls(materialize(rows, "members", "res", even))
        return Clusters(rows, rules, AGREE, even=even, near=True)
    return Clusters(rows, rules, AGREE, even=even)


# Sources ------------------------------------------------------------------------


@query
def a1_scan_quads(spark, sf):
    quads = claims(spark, sf).unionByName(fx.quads(spark, sf, fx.CLASSES))
    declared = fx.run(
        spark,
        sf,
        "SELECT 'http://ex/g/' || cast(s_suppkey AS string) AS g FROM {supplier} WHERE s_acctbal > 0",
    )
    return sources.scan_quads(quads, declared).select("s", "p", "o", "g")


@query
def a2_union_inputs(spark, sf):
    odd = fx.claims(spark, sf, "l_linenumber % 2 = 1")
    even = fx.claims(spark, sf, "l_linenumber % 2 = 0")
    return sources.union_inputs(odd, None, even).select("s", "p", "o", "g")


@query
def a3_scan_links(spark, sf):
    quads = fx.quads(spark, sf, fx.LINKS).unionByName(fx.quads(spark, sf, fx.CLASSES))
    return sources.scan_links(quads)


@query
def a4_scan_metadata(spark, sf):
    return sources.scan_metadata(metadata(spark, sf)).select("s", "p", "o", "g")


@query
def a5_scan_canonical(spark, sf):
    path = scratch(spark)
    saved = fx.run(spark, sf, fx.PREFERRED).select(F.col("uri").alias("canonical"))
    canonical.save_canonical(saved, path)
    return canonical.scan_canonical(spark, path)


@query
def a6_fill_graph(spark, sf):
    sql = fx.CLASSES.replace(
        "'http://ex/g/catalog' AS g",
        "CASE WHEN p_size % 2 = 0 THEN 'http://ex/g/catalog' END AS g",
    )
    default = sources.default_graph(["http://ex/g/other", "http://ex/g/first"])
    return sources.fill_graph(fx.quads(spark, sf, sql), default).select("s", "o", "g")


@query
def a7_load_stats(spark, sf):
    return sources.load_stats(claims(spark, sf))


# Policy -------------------------------------------------------------------------


@query
def b1_expand_prefix(spark, sf):
    short = claims(spark, sf).withColumn(
        "p",
        F.when(F.col("p") == f"{P}flag", F.lit("zz:flag")).otherwise(
            F.replace(F.col("p"), F.lit(P), F.lit("ex:"))
        ),
    )
    prefixes = spark.createDataFrame(
        [("ex", "http://old/", 1), ("ex", P, 2), ("rdf", "http://rdf/", 3)],
        "prefix string, namespace string, position int",
    )
    return policies.expand_prefix(short, "p", prefixes).select("s", "p", "o")


@query
def b3_property_policy(spark, sf):
    rows = fx.run(
        spark,
        sf,
        "SELECT p_partkey AS position, "
        "array('http://ex/p/' || p_brand, 'http://ex/p/' || p_type) AS properties, "
        "CASE WHEN p_size > 25 THEN 'BEST' ELSE 'AVG' END AS function, "
        "CASE WHEN p_size > 10 THEN 'SINGLEVALUED' END AS cardinality, "
        "cast(null AS string) AS agg_error, 'http://ex/p/' || p_name AS depends_on, "
        "map('size', cast(p_size AS string)) AS params FROM {part}",
    )
    return policies.property_policy(rows).select(
        "property", "function", "cardinality", "depends_on", F.col("params")["size"].alias("size")
    )


@query
def b8_validate_policy(spark, sf):
    prefixes = fx.run(
        spark,
        sf,
        "SELECT n_name AS prefix, 'http://ex/n/' || cast(n_nationkey AS string) AS namespace FROM {nation} "
        "UNION ALL SELECT s_name, 'http://ex/s/' || cast(s_suppkey AS string) FROM {supplier} "
        "UNION ALL SELECT 'p' || cast(p_partkey AS string), 'http://ex/' || p_name FROM {part} "
        "UNION ALL SELECT '', '' FROM {nation}",
    )
    return policies.invalid_prefixes(prefixes)


# Identity -----------------------------------------------------------------------


@query
def c1_preferred_uris(spark, sf):
    table = strategies(price=Strategy("AVG"), flag=Strategy("BEST")).policy(spark)
    saved = fx.run(spark, sf, fx.PREFERRED)
    return identity.preferred_uris(spark, table, saved, ["http://ex/part/0", f"{P}flag"])


@query
def c2_canonical_map(spark, sf):
    return mapping(spark, sf)


@query
def c2_canonical_map_chains(spark, sf):
    return identity.canonical_map(fx.run(spark, sf, fx.CHAINS))


@query
def c3_save_canonical(spark, sf):
    path = scratch(spark)
    canonical.save_canonical(mapping(spark, sf), path)
    return canonical.scan_canonical(spark, path)


@query
def c4_map_terms(spark, sf):
    quads = claims(spark, sf).unionByName(fx.quads(spark, sf, fx.ORDERS))
    return identity.map_terms(quads, mapping(spark, sf)).select("s", "p", "o", "g")


@query
def c5_alternatives(spark, sf):
    members = identity.cluster_members(mapping(spark, sf))
    sizes = members.groupBy("canonical").agg(F.count(F.lit(1)).alias("n"))
    return members.join(sizes, "canonical").select("canonical", "uri", "n")


# Descriptions -------------------------------------------------------------------


def described(spark, sf, found: DataFrame) -> DataFrame:
    quads = claims(spark, sf).unionByName(fx.quads(spark, sf, fx.CLASSES))
    return describing.describe(quads, found)


def description_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("res").agg(
        F.count(F.lit(1)).alias("n_quads"), F.countDistinct("g").alias("n_graphs")
    )


@query
def d1_describe(spark, sf):
    return description_sizes(described(spark, sf, mapping(spark, sf)))


@query
def d2_nest(spark, sf):
    found = mapping(spark, sf)
    rows = describing.describe(fx.quads(spark, sf, fx.ORDERS), found)
    return describing.nest(rows, [f"{P}placedBy"], found).select("res", "s", "p", "o")


@query
def d3_require_class(spark, sf):
    found = mapping(spark, sf)
    rows = described(spark, sf, found)
    return description_sizes(describing.require_class(rows, "http://ex/class/ECONOMY", found))


@query
def d4_mapped_only(spark, sf):
    found = mapping(spark, sf)
    return description_sizes(describing.mapped_only(described(spark, sf, found), found))


@query
def d5_all_filters(spark, sf):
    found = mapping(spark, sf)
    filters = [
        lambda d: describing.require_class(d, "http://ex/class/ECONOMY", found),
        lambda d: describing.mapped_only(d, found),
    ]
    return description_sizes(describing.all_filters(described(spark, sf, found), filters))


@query
def d6_max_output(spark, sf):
    quads = sources.distinct_quads(claims(spark, sf))
    return describing.max_output(quads, 1000).select("s", "p", "o", "g")


@query
def d6_max_output_large(spark, sf):
    quads = sources.distinct_quads(claims(spark, sf))
    return describing.max_output(quads, describing.TOP_ROWS + 1).select("s", "p", "o", "g")


# Resolution ---------------------------------------------------------------------


@query
def e1_assign_policy(spark, sf):
    config = strategies(
        price=Strategy("AVG", SINGLEVALUED, IGNORE, f"{P}price"),
        flag=Strategy("BEST"),
        shipped=Strategy(cardinality=SINGLEVALUED, agg_error=RETURN_ALL),
    ).with_options(default=Strategy(cardinality=SINGLEVALUED))
    ruled = policies.assign_policy(claims(spark, sf), config.policy(spark))
    return ruled.groupBy("p", "function", "cardinality", "agg_error", "depends_on").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def e2_conflict_clusters(spark, sf):
    found = mapping(spark, sf)
    rows, _ = dealt_members(to_cluster_rows(claims(spark, sf), found), once=mapped_by_exchange(found))
    return rows.groupBy(F.col("res").alias("s"), "p").agg(
        F.count(F.lit(1)).alias("n_members"), F.countDistinct("o").alias("n_values")
    )


@query
def e2_tagged_values(spark, sf):
    """Values that differ by language or datatype alone, and blank nodes of two inputs."""
    inputs = [fx.run(spark, sf, fx.TAGGED).withColumn("src", F.lit(0)).select(*fx.QUADS_SCHEMA.names)] * 2
    rows = conflict_members(to_cluster_rows(sources.concat_inputs(*inputs), None))
    return with_nulls(rows).groupBy(F.col("res").alias("s"), "p", "o", "o_dt", "o_lang").agg(
        F.count(F.lit(1)).alias("n_sources")
    )


def all_resolved(spark, sf, merged: bool = True) -> Resolution:
    return REGISTRY["ALL"](clusters(spark, sf, rules_for(spark), merged))


def statements(spark, sf, merged: bool = True) -> DataFrame:
    return as_statements(all_resolved(spark, sf, merged).statements)


@query
def e3_sources(spark, sf):
    return as_statements(all_resolved(spark, sf).support).select("s", "p", "o", "g")


@query
def e3_source_lists(spark, sf):
    return as_statements(source_rows(all_resolved(spark, sf))).select("s", "p", "o", "n_sources", "g")


@query
def e6_depends_on(spark, sf):
    config = strategies(
        price=Strategy(cardinality=SINGLEVALUED, depends_on=f"{P}price"),
        discount=Strategy(depends_on=f"{P}price"),
    )
    return fused(spark, sf, config).statements.select("s", "p", "o", "n_sources")


@query
def e7_result_graph(spark, sf):
    return with_result_graph(statements(spark, sf), "http://ex/result/", "fused").select("s", "p", "o", "g")


@query
def e9_source_quality(spark, sf):
    graphs = fx.run(
        spark, sf, "SELECT 'http://ex/g/' || cast(s_suppkey AS string) AS g FROM {supplier}"
    )
    return score_graphs(graphs, scores(spark, sf), UNKNOWN_SCORE).select(
        "g", rounded(F.col("w")).alias("score")
    )


def judged(spark, sf, merged: bool) -> DataFrame:
    return clusters(spark, sf, single_rules(spark), merged).values.select(
        F.col("res").alias("s"), "p", "o", rounded(F.col("quality")).alias("quality")
    )


@query
def e10_value_quality(spark, sf):
    return judged(spark, sf, merged=False)


@query
def e10_value_quality_merged(spark, sf):
    return judged(spark, sf, merged=True)


@query
def e11_distance(spark, sf):
    """Distance of every claimed value to the least value of its cluster."""
    values = claims(spark, sf).select("s", "p", "o_kind", "o").distinct()
    least = values.groupBy("s", "p").agg(F.min("o").alias("b"))
    gap = distance(F.col("o_kind"), F.col("o"), F.col("o_kind"), F.col("b"))
    return values.join(least, ["s", "p"]).select(
        "s", "p", F.col("o").alias("a"), "b", rounded(gap).alias("d")
    )


@query
def e12_all(spark, sf):
    return statements(spark, sf).select(
        "s", "p", "o", "n_sources", rounded(F.col("quality")).alias("quality")
    )


@query
def e13_best(spark, sf):
    best = REGISTRY["BEST"](clusters(spark, sf, single_rules(spark), merged=False)).statements
    return as_statements(best).select(
        "s", "p", "o", "n_sources", rounded(F.col("quality")).alias("quality")
    )


def averaged(spark, sf, agg_error: str) -> DataFrame:
    rows, even = members(spark, sf, claims(spark, sf), merged=False)
    rows = materialize(rows, "members", "res", even)
    strategy = Strategy("AVG", SINGLEVALUED, agg_error)
    rules = rules_for(spark, **dict.fromkeys(EVERY, strategy)).only("function", "AVG")
    found = REGISTRY["AVG"](Clusters(without_nulls(rows), rules, AGREE, even=even)).statements
    return as_statements(found).select(
        "s", "p", number_text("o").alias("o"), "n_sources", rounded(F.col("quality")).alias("quality")
    )


@query
def e14_avg_ignore(spark, sf):
    return averaged(spark, sf, IGNORE)


@query
def e14_avg_return_all(spark, sf):
    return averaged(spark, sf, RETURN_ALL)


@query
def e15_nested(spark, sf):
    config = strategies(placedBy=Strategy(NESTED)).with_options(unknown_score=0.5)
    config = config.with_options(preferred=["http://ex/customer/3"])
    result = fuse([fx.quads(spark, sf, fx.ORDERS)], fx.quads(spark, sf, fx.LINKS), config=config)
    return result.statements.select("s", "p", "o", rounded(F.col("quality")).alias("quality"))


# Sinks --------------------------------------------------------------------------


@query
def f1_write_data(spark, sf):
    return sinks.write_data(statements(spark, sf), scratch(spark)).select(
        "s", "p", "o", "g"
    )


@query
def f2_write_with_metadata(spark, sf):
    found = all_resolved(spark, sf)
    plain = fx.quads(spark, sf, fx.CLASSES)
    rows = found.statements.withColumnRenamed("res", "s")
    support = found.support.withColumnRenamed("res", "s")
    saved = sinks.write_with_metadata(rows, support, scratch(spark), plain=plain)
    # The quality is a double of full length; only the comparison rounds it.
    text = F.when(F.col("p") == QUALITY_PROPERTY, number_text("o")).otherwise(F.col("o"))
    return saved.select("s", "p", text.alias("o"), "g")


@query
def f4_noop(spark, sf):
    counted, seen = sources.observe_loaded(statements(spark, sf), uuid.uuid4().hex)
    sinks.write_nothing(counted)
    rows = claims(spark, sf).select("s", "p").distinct().agg(F.count(F.lit(1)).alias("clusters"))
    return rows.withColumn("n", F.lit(seen.get["n"]))


@query
def f6_graph_override(spark, sf):
    return sinks.write_data(
        statements(spark, sf, merged=False), scratch(spark), data_graph="http://ex/out"
    ).select("s", "p", "o", "g")


# Whole job ----------------------------------------------------------------------


def fused(spark, sf, config: FusionConfig, with_classes: bool = False):
    """Fuse the claims; preferred parts come from the file of an earlier run."""
    path = scratch(spark)
    saved = fx.run(spark, sf, fx.PREFERRED).select(F.col("uri").alias("canonical"))
    canonical.save_canonical(saved, path)
    config = config.with_options(
        score_property=f"{META}score",
        publisher_property=f"{META}publishedBy",
        publisher_score_property=f"{META}publisherScore",
    )
    inputs = [
        fx.claims(spark, sf, "l_linenumber % 2 = 1"),
        fx.claims(spark, sf, "l_linenumber % 2 = 0"),
    ]
    if with_classes:
        inputs.append(fx.quads(spark, sf, fx.CLASSES))
    links = fx.quads(spark, sf, fx.LINKS)
    return fuse(inputs, links, metadata(spark, sf), config, canonical_path=path)


FUSE_CONFIG = strategies(
    price=Strategy("AVG", SINGLEVALUED),
    flag=Strategy("BEST", SINGLEVALUED),
    shipped=Strategy("ALL", MANYVALUED),
)


@query
def g1_fuse(spark, sf):
    return fused(spark, sf, FUSE_CONFIG).with_sources().select(
        "s",
        "p",
        number_text("o").alias("o"),
        rounded(F.col("quality")).alias("quality"),
        "g",
    )


@query
def g1_fuse_filtered(spark, sf):
    config = FUSE_CONFIG.with_options(required_class="http://ex/class/ECONOMY", mapped_only=True)
    return fused(spark, sf, config, with_classes=True).statements.select(
        "s", "p", number_text("o").alias("o"), "n_sources", rounded(F.col("quality")).alias("quality")
    )


# Further functions ----------------------------------------------------------------


def _fused_by(name: str, **params: str) -> Query:
    """A registered function over all claims; what it cannot use is ignored by policy."""

    def run(spark, sf):
        strategy = Strategy(name, agg_error=IGNORE, params=params)
        rules = rules_for(spark, **dict.fromkeys(EVERY, strategy)).only("function", name)
        found = as_statements(REGISTRY[name](clusters(spark, sf, rules, merged=False)).statements)
        value = number_text("o") if name in ("SUM", "MEDIAN") else F.col("o")
        return found.select(
            "s", "p", value.alias("o"), "n_sources", rounded(F.col("quality")).alias("quality")
        )

    return run


SOME_SOURCE = "http://ex/g/3"

for _name, _params in (
    ("ANY", {}),
    ("MIN", {}),
    ("MAX", {}),
    ("MEDIAN", {}),
    ("SUM", {}),
    ("LONGEST", {}),
    ("SHORTEST", {}),
    ("VOTE", {}),
    ("WEIGHTED_VOTE", {}),
    ("TOP_N", {"n": "3"}),
    ("THRESHOLD", {"threshold": "0.8"}),
    ("CHOOSE_SOURCE", {"source": SOME_SOURCE}),
    ("BEST_SOURCE", {}),
    ("MOST_RECENT", {}),
    ("NONE", {}),
    ("CONCAT", {}),
):
    QUERIES[f"e18_{_name.lower()}"] = _fused_by(_name, **_params)


@query
def e18_concat_parts(spark, sf):
    """Concatenations in pieces of small blocks."""
    rows, even = members(spark, sf, claims(spark, sf), merged=False)
    rows = materialize(rows, "members", "res", even)
    strategy = Strategy("CONCAT", params={"separator": "|", "block": "24"})
    clusters = Clusters(without_nulls(rows), rules_for(spark, **dict.fromkeys(EVERY, strategy)), AGREE, even=even)
    return concat_parts(clusters, concat_places(clusters)).withColumnRenamed("res", "s")
