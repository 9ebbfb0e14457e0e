"""Identity resolution: clusters of linked URIs and their canonical members."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadweld.model import BNODE, IRI, URI_SCHEMA
from quadweld.operators import stage
from quadweld.operators.lists import bounded_lists
from quadweld.operators.stage import heavy_columns, is_small, key_hash, lookup, materialize, spread

MAX_ROUNDS = 60


def preferred_uris(
    spark: SparkSession,
    policy: DataFrame | None = None,
    saved: DataFrame | None = None,
    configured: Iterable[str] = (),
) -> DataFrame:
    """Union of properties with a strategy, saved canonical URIs and configured URIs."""
    uris = spark.createDataFrame([(u,) for u in configured], URI_SCHEMA)
    if policy is not None:
        named = policy.where("property IS NOT NULL")
        uris = uris.unionByName(named.select(F.col("property").alias("uri")))
    if saved is not None:
        uris = uris.unionByName(saved.select("uri"))
    return uris.distinct()


def _degrees(edges: DataFrame) -> DataFrame:
    """Nodes with the number of edges up and down, and whether they are ``open``.

    Edges form stars when no root is also a child and no child has two roots.
    """
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return nodes.withColumn("open", (F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))


def _node_report(nodes: DataFrame) -> tuple[float, list[int]]:
    """Share of open nodes, and the nodes with very many edges, at most ``2 / HEAVY_SHARE`` hashes."""
    degree = F.col("up") + F.col("down")
    report = nodes.agg(
        F.avg(F.col("open").cast("int")).alias("open"),
        F.sum("up").alias("edges"),
        F.max(degree).alias("most"),
    ).first()
    limit = max(stage.HEAVY_FLOOR, int((report["edges"] or 0) * stage.HEAVY_SHARE))
    heavy = []
    if (report["most"] or 0) > limit:
        rows = nodes.where(degree > limit).select(key_hash(["node"]).alias("h")).collect()
        heavy = [r["h"] for r in rows]
    return report["open"] or 0.0, heavy


# Finished stars leave the rounds once open nodes are at most this share of all.
OPEN_SHARE = 0.25


def _split_finished(edges: DataFrame, nodes: DataFrame, heavy: list[int]) -> tuple[DataFrame, DataFrame]:
    """Edges of components that are stars, and all others.

    A component is unfinished if its root is open or has an open child.
    """
    unfinished = nodes.where("open").select("node")
    roots = edges.join(unfinished.withColumnRenamed("node", "a"), "a", "left_semi").select("b")
    bad = materialize(roots.union(unfinished).distinct().withColumnRenamed("node", "b"), "open")
    if is_small(bad):
        bad, heavy = F.broadcast(bad), []
    finished = lookup(edges, bad, ["b"], heavy, "left_anti")
    return finished, lookup(edges, bad, ["b"], heavy, "left_semi").select(*edges.columns)


def _link_to_least_neighbour(edges: DataFrame, heavy: list[int]) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour."""
    ends = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    both = ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        lookup(ends, least, ["u"], heavy, "inner")
        .select(F.col("v").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _link_smaller_neighbours(edges: DataFrame, heavy: list[int]) -> DataFrame:
    """A node and its smaller neighbours all move to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = (
        lookup(edges, least, ["a"], heavy, "inner")
        .where(F.col("b") != F.col("m"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def star_forest(links: DataFrame, max_rounds: int = MAX_ROUNDS) -> tuple[DataFrame, list[int]]:
    """Connected components as edges ``a`` (member) to ``b`` (least member).

    Alternates the two relinking steps until every component is a star; each round
    is written to the shared folder, so lineage stays one round long. Components that are
    stars are left out of further rounds, so a few long chains don't rewrite all the others.
    """
    edges = materialize(
        links.where("s <> o")
        .select(F.greatest("s", "o").alias("a"), F.least("s", "o").alias("b"))
        .distinct(),
        "links",
    )
    done: list[DataFrame] = []
    hubs: set[int] = set()
    for _ in range(max_rounds):
        nodes = _degrees(edges)
        unfinished, heavy = _node_report(nodes)
        hubs.update(heavy)
        if not unfinished:
            return reduce(DataFrame.unionByName, [*done, edges]), sorted(hubs)
        if unfinished <= OPEN_SHARE:
            finished, rest = _split_finished(edges, nodes, heavy)
            done.append(materialize(finished.select(*edges.columns), "stars"))
            edges = materialize(rest, "links")
        relinked = _link_smaller_neighbours(_link_to_least_neighbour(edges, heavy), heavy)
        edges = materialize(relinked, "links")
    raise RuntimeError(f"links did not converge in {max_rounds} rounds")


def canonical_map(
    links: DataFrame, preferred: DataFrame | None = None, max_rounds: int = MAX_ROUNDS
) -> DataFrame:
    """Non-canonical URIs with their canonical URI.

    The canonical member is the least preferred URI of the cluster, else its least
    URI, in binary string order.
    """
    stars, heavy = star_forest(links, max_rounds)
    members = stars.select(F.col("a").alias("uri"), F.col("b").alias("root")).unionByName(
        stars.select(F.col("b").alias("uri"), F.col("b").alias("root")).distinct()
    )
    if preferred is None:
        return stars.select(F.col("a").alias("uri"), F.col("b").alias("canonical"))
    chosen = (
        members.join(preferred.select("uri").distinct(), "uri", "left_semi")
        .groupBy("root")
        .agg(F.min("uri").alias("chosen"))
    )
    mapped = lookup(members, chosen, ["root"], heavy).select(
        "uri", F.coalesce("chosen", "root").alias("canonical")
    )
    return materialize(mapped.where("uri <> canonical"), "mapping")


def _term(column: str) -> Column:
    """What the mapping may rename: a literal is no name."""
    return F.when(F.col("o_kind").isin(IRI, BNODE), F.col("o")) if column == "o" else F.col(column)


def _map_by_broadcast(quads: DataFrame, names: DataFrame, column: str) -> DataFrame:
    names = F.broadcast(names.select(F.col("uri").alias("_o"), F.col("canonical").alias("_c")))
    joined = quads.join(names, _term(column) == F.col("_o"), "left")
    return joined.withColumn(column, F.coalesce("_c", column)).drop("_o", "_c")


def _terms_used(quads: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct tuples of what the mapping may rename in ``columns``, with the number of quads that have them."""
    keyed = quads.select(*[F.coalesce(_term(c), F.lit("")).alias(f"_k_{c}") for c in columns])
    return materialize(keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("_n")), "tuples")


def _map_by_exchange(quads: DataFrame, names: DataFrame, columns: list[str], tuples: DataFrame) -> DataFrame:
    """Several columns in one exchange of the quads.

    The distinct tuples of terms are mapped first, column by column; quads meet only those tuples that change, by
    all their terms, so neither a hot subject nor a hot object brings its quads into one task. Which tuples are
    heavy is told by their counts, so the quads are read once.
    """
    keys = {c: f"_k_{c}" for c in columns}
    heavy = heavy_columns(tuples, {c: [k] for c, k in keys.items()})
    mapped = tuples
    for c, k in keys.items():
        renamed = names.select(F.col("uri").alias(k), F.col("canonical").alias(f"_c_{c}"))
        mapped = lookup(mapped, renamed, [k], heavy[c])
    changes = [f"_c_{c}" for c in columns]
    changed = materialize(mapped.where(F.coalesce(*changes).isNotNull()).select(*keys.values(), *changes), "changed")
    # What differs between quads made from one row travels last, so the rest packs well.
    last = [c for c in ("p", "o") if c in quads.columns]
    terms = [F.coalesce(_term(c), F.lit("")).alias(k) for c, k in keys.items()]
    keyed = quads.select(*terms, *[c for c in quads.columns if c not in last], *last)
    on = list(keys.values())
    if is_small(changed):
        met = keyed.join(F.broadcast(changed), on, "left")
    else:
        n, often = _heavy_tuples(tuples, on)
        met = lookup(keyed, changed, on, often) if often else spread(keyed, on, n).join(changed, on, "left")
    found = {c: F.when(_term(c).isNotNull(), F.coalesce(f"_c_{c}", c)).otherwise(F.col(c)) for c in columns}
    return met.withColumns(found).select(*quads.columns)


def _heavy_tuples(tuples: DataFrame, on: list[str]) -> tuple[int, list[int]]:
    """Number of quads, and the hashes of the tuples that too many of them have; at most ``MOST_HEAVY``."""
    n = tuples.agg(F.sum("_n").alias("n")).first()["n"] or 0
    if n < stage.HEAVY_FLOOR:
        return n, []
    limit = max(1, int(n * max(min(stage.HEAVY_SHARE, stage.TASK_ROWS / n), 1 / stage.MOST_HEAVY)))
    return n, [r["h"] for r in tuples.where(F.col("_n") > limit).select(key_hash(on).alias("h")).collect()]


def map_terms(
    quads: DataFrame, mapping: DataFrame, columns: Iterable[str] = ("s", "p", "o")
) -> DataFrame:
    """Replace mapped URIs by their canonical URI; everything else stays.

    A mapping of checked small size is broadcast. Of a large one, what the quads use is looked up first, each distinct
    term once, from the distinct tuples of terms, which are written. That dictionary is broadcast if it is small; beyond that the predicates still are, being
    few, and the quads meet the other terms in one exchange, however large the mapping is.
    """
    columns = list(columns)
    if not is_small(mapping):
        together = [c for c in columns if c != "p"]
        tuples = _terms_used(quads, together) if together else None
        terms = [tuples.select(F.explode(F.array(*[c for c in tuples.columns if c != "_n"])).alias("uri"))] if together else []
        if "p" in columns:
            used = materialize(quads.select(F.col("p").alias("uri")).distinct(), "predicates")
            terms.append(used)
        # An absent term is '' among the tuples; a name that is empty has no canonical URI but by a link of its own.
        whole = reduce(DataFrame.unionByName, terms).where("uri IS NOT NULL").distinct()
        dictionary = materialize(mapping.join(whole, "uri", "left_semi"), "dictionary")
        if not is_small(dictionary):
            if "p" in columns:
                renamed = materialize(dictionary.join(used, "uri", "left_semi"), "predicates")
                if is_small(renamed):
                    quads = _map_by_broadcast(quads, renamed, "p")
                else:
                    together.append("p")
                    tuples = _terms_used(quads, together)
            return _map_by_exchange(quads, dictionary, together, tuples) if together else quads
        mapping = dictionary
    for column in columns:
        quads = _map_by_broadcast(quads, mapping, column)
    return quads


def cluster_members(mapping: DataFrame) -> DataFrame:
    """Every member of every cluster, the canonical one included, one per row."""
    return mapping.select("canonical", "uri").unionByName(
        mapping.select("canonical", F.col("canonical").alias("uri")).distinct()
    )


def alternatives(mapping: DataFrame, limit: int) -> DataFrame:
    """Sorted member lists, keyed by canonical URI and part; ``cluster_members`` has them as rows."""
    return bounded_lists(cluster_members(mapping), ["canonical"], "uri", "uris", limit)
