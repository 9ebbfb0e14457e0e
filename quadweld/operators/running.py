"""Running totals and row numbers over globally sorted data.

A plain ``Window.partitionBy(group)`` puts a whole group into one task, and a
window without a partition puts everything there. Here the rows are range
partitioned first, every range keeps its own totals, and only one total per
range (and group) is carried over to the ranges after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadweld.operators.stage import key_hash, materialize

# monotonically_increasing_id keeps the row position in the low 33 bits.
_POSITION_BITS = 33


def number_rows(df: DataFrame, order: list[str], name: str = "k") -> DataFrame:
    """Dense numbers from 1 in the order of the columns ``order``."""
    placed = materialize(
        df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered"
    )
    # _POSITION_BITS splits the id into the range and the position within it.
    part = F.shiftright("_at", _POSITION_BITS)
    position = F.col("_at") - F.shiftleft(part, _POSITION_BITS)
    placed = placed.withColumn("_part", part).withColumn("_pos", position)
    # One row per range, so the ungrouped window sees as many rows as there are tasks.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_pos") + 1)
        .drop("_at", "_part", "_pos", "_before")
    )


def running_totals(
    df: DataFrame,
    group: list[str],
    order: list[str],
    up: dict[str, str],
    down: dict[str, str],
    parts: int | None = None,
) -> DataFrame:
    """Add inclusive totals along ``order`` (``up``) and against it (``down``).

    ``up`` and ``down`` map a new column to the column it sums. A group may span
    any number of ranges. Meant for few, very large groups: one carried total per
    group and range is broadcast.
    """
    keys = [*group, *order]
    ranged = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    placed = materialize(ranged.withColumn("_part", F.spark_partition_id()), "running")

    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*group).orderBy(F.desc("_part")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = {**up, **down}
    carried = (
        placed.groupBy(*group, "_part")
        .agg(*[F.sum(src).alias(f"_t_{dst}") for dst, src in sums.items()])
        .select(
            *group,
            "_part",
            *[
                F.coalesce(F.sum(f"_t_{dst}").over(earlier if dst in up else later), F.lit(0.0)).alias(
                    f"_c_{dst}"
                )
                for dst in sums
            ],
        )
    )
    along = Window.partitionBy(*group, "_part").orderBy(*order)
    against = Window.partitionBy(*group, "_part").orderBy(*[F.desc(c) for c in order])
    upto = (Window.unboundedPreceding, Window.currentRow)
    totals = placed
    for dst, src in sums.items():
        window = (along if dst in up else against).rowsBetween(*upto)
        totals = totals.withColumn(dst, F.sum(src).over(window))
    totals = totals.join(F.broadcast(carried), [*group, "_part"])
    for dst in sums:
        totals = totals.withColumn(dst, F.col(dst) + F.col(f"_c_{dst}"))
    return totals.drop("_part", *[f"_c_{dst}" for dst in sums])


def cumulate(
    df: DataFrame,
    group: list[str],
    order: list[str],
    column: str,
    out: str,
    heavy: list[int] | None = None,
) -> DataFrame:
    """Inclusive running total of ``column``; heavy groups are summed over ranges."""
    upto = (
        Window.partitionBy(*group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    total = F.sum(column).over(upto).cast("double")
    if not heavy:
        return df.withColumn(out, total)
    is_heavy = key_hash(group).isin(heavy)
    ranged = running_totals(df.where(is_heavy), group, order, {out: column}, {})
    return df.where(~is_heavy).withColumn(out, total).unionByName(ranged)
