"""Conflict clusters: the distinct claims about one property of one resource."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadweld.model import MAX_DATE_DIFFERENCE, SINGLEVALUED
from quadweld.operators.identity import map_terms
from quadweld.operators.policy import Rules, assign_policy
from quadweld.operators.quality import (
    CLUSTER,
    VALUE,
    opposed_quality,
    unopposed_quality,
)
from quadweld.operators.stage import distinct_dealt, grouped, is_small, keyed_lookup, materialize

MEMBER = [*VALUE, "g"]
#: Columns in the order in which rows travel: what differs between rows made from one row comes last, so the rest packs well.
TRAVEL = ["res", "g", "o_kind", "o_dt", "o_lang", "p", "o"]


def without_nulls(df: DataFrame) -> DataFrame:
    """Absent datatype and language as '' so that terms compare with plain equality."""
    return df.withColumns({c: F.coalesce(c, F.lit("")) for c in ("o_dt", "o_lang")})


def with_nulls(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in ("o_dt", "o_lang")})


def to_cluster_rows(quads: DataFrame, mapping: DataFrame | None) -> DataFrame:
    """Quads in canonical terms, keyed by ``res``; ``s`` stays the original subject."""
    rows = without_nulls(quads.withColumn("res", F.col("s")))
    return rows if mapping is None else map_terms(rows, mapping, ("res", "p", "o"))


def mapped_by_exchange(mapping: DataFrame | None) -> bool:
    """Whether ``to_cluster_rows`` may take an exchange of the quads."""
    return mapping is not None and not is_small(mapping)


def conflict_members(rows: DataFrame, per_subject: Column | None = None) -> DataFrame:
    """Distinct (value, graph) rows of every cluster; where ``per_subject`` holds, per original subject ``s``."""
    return dealt_members(rows, per_subject)[0]


def dealt_members(rows: DataFrame, per_subject: Column | None = None, once: bool = False) -> tuple[DataFrame, int]:
    """``conflict_members``, and over how many tasks they lie by resource; 0 if a resource is too large for one task.

    The rows are read by a first pass over the resources and again by every use of the members. ``once`` writes what
    these need of them first, for rows that take an exchange to make.
    """
    subject = [] if per_subject is None else [F.when(per_subject, F.col("s")).alias("s")]
    needed = rows.select(*subject, *TRAVEL)
    dealt, even = distinct_dealt(without_nulls(materialize(needed, "terms")) if once else needed, "res")
    return dealt.select(*MEMBER, *[c for c in dealt.columns if c not in MEMBER]), even


def judge_values(
    values: DataFrame, rules: Rules, agree: float, span: float = MAX_DATE_DIFFERENCE, even: bool = False
) -> DataFrame:
    """Values with the strategy of their property and their quality.

    SINGLEVALUED and other properties are told apart by ``p``, so each side reads
    only its own rows. ``even``: see ``opposed_quality``.
    """
    used = rules.used("cardinality")
    is_single = rules.having("cardinality", SINGLEVALUED)
    if SINGLEVALUED not in used:
        judged = unopposed_quality(values, agree)
    elif len(used) == 1:
        judged = opposed_quality(values, agree, span, even=even)
    else:
        judged = unopposed_quality(values.where(~is_single), agree).unionByName(
            opposed_quality(values.where(is_single), agree, span, even=even)
        )
    return assign_policy(judged, rules.table)


def anchor_picks(
    weighed: DataFrame, rules: Rules, agree: float, span: float = MAX_DATE_DIFFERENCE, even: int = 0
) -> DataFrame:
    """The one (subject, graph) per resource that its anchor property selects.

    The best-scored claim of the anchor's best value, by ordinary aggregates: the
    smallest ordering struct per value, then per cluster. ``even``: see ``dealt_members``.
    """
    anchors = sorted(rules.used("depends_on"))
    claims = grouped(weighed.where(F.col("p").isin(anchors)), [*MEMBER, "w"]).agg(F.min("s").alias("s"))
    values = grouped(claims.drop("_key"), VALUE).agg(
        F.count(F.lit(1)).alias("n_sources"),
        F.max("w").alias("w_max"),
        F.sum("w").alias("w_sum"),
        F.min(F.struct((-F.col("w")).alias("rank"), "g", "s")).alias("lead"),
    )
    judged = judge_values(values.drop("_key"), rules, agree, span, even)
    first = F.min(F.struct((-F.col("quality")).alias("rank"), F.col("lead"))).alias("first")
    return (
        grouped(judged, CLUSTER)
        .agg(first)
        .select(
            "res",
            F.col("p").alias("depends_on"),
            F.col("first.lead.s").alias("_s"),
            F.col("first.lead.g").alias("_g"),
        )
    )


BOUND = ["res", "depends_on"]


def is_bound(rules: Rules) -> Column:
    """Condition on ``p``: the property follows an anchor."""
    found = F.lit(False)
    for name in sorted(rules.used("depends_on")):
        found = found | rules.having("depends_on", name)
    return found


def by_subject(rules: Rules) -> Column:
    """Condition on ``p``: the original subject of its claims matters, as it is an anchor or follows one."""
    return F.col("p").isin(sorted(rules.used("depends_on"))) | is_bound(rules)


def _anchor(rules: Rules) -> Column:
    """The anchor that a property follows, else null."""
    anchor = F.lit(None).cast("string")
    for name in sorted(rules.used("depends_on")):
        anchor = F.when(rules.having("depends_on", name), F.lit(name)).otherwise(anchor)
    return anchor


def bound_rows(weighed: DataFrame, rules: Rules) -> DataFrame:
    """Claims about properties that follow an anchor, and which anchor."""
    return weighed.withColumn("depends_on", _anchor(rules)).where(F.col("depends_on").isNotNull())


def follow_anchors(
    weighed: DataFrame, rules: Rules, picks: DataFrame, heavy: list[int] | None = None
) -> DataFrame:
    """Distinct claims about dependent properties, as far as they come from the anchor's pick.

    A resource without any anchor claim keeps all its claims. ``heavy`` are hashes of the
    columns ``BOUND``. Which claims are bound shows in ``p``, so no policy is joined. The claims of a
    pick have one subject and are distinct without it; only those without a pick meet again.
    """
    met = keyed_lookup(bound_rows(weighed, rules), picks, BOUND, heavy)
    agrees: Column = (F.col("s") == F.col("_s")) & (F.col("g") == F.col("_g"))
    columns = [*MEMBER, "w"]
    return met.where(agrees).select(*columns).unionByName(met.where(F.col("_s").isNull()).select(*columns).distinct())


def follow_in_place(weighed: DataFrame, rules: Rules, picks: DataFrame) -> DataFrame:
    """``free_rows`` and ``follow_anchors`` together, where no resource is too large for one task.

    A resource meets all its picks as one row, of which it has no more than there are anchors; claims and picks that lie by
    resource stay where they are.
    """
    of_resource = picks.groupBy("res").agg(F.collect_list(F.struct("depends_on", "_s", "_g")).alias("_picks"))
    met = weighed.withColumn("depends_on", _anchor(rules)).join(of_resource, "res", "left")
    pick = F.get(F.filter("_picks", lambda x: x["depends_on"] == F.col("depends_on")), 0)
    met = met.withColumn("_pick", pick)
    agrees = (F.col("s") == F.col("_pick._s")) & (F.col("g") == F.col("_pick._g"))
    follows = F.col("depends_on").isNotNull() & (agrees | F.col("_pick._s").isNull())
    return met.where(~is_bound(rules) | follows).select(*MEMBER, "w").distinct()


def free_rows(weighed: DataFrame, rules: Rules) -> DataFrame:
    """Distinct claims about properties that follow no anchor; an anchor that follows none is told apart by subject."""
    free = weighed.where(~is_bound(rules)).select(*MEMBER, "w")
    alone = F.col("p").isin(sorted(rules.used("depends_on")))
    return free.where(~alone).unionByName(free.where(alone).distinct())
