"""Lists per key whose length stays bounded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadweld.operators.stage import attach


def bounded_lists(
    rows: DataFrame,
    keys: list[str],
    item: str,
    out: str,
    limit: int,
    size: str | None = None,
) -> DataFrame:
    """Sorted lists of ``item``, about ``limit`` items at most in a row; rows are keyed by (key, part).

    A key with more items gets several rows with disjoint shares of its list, so no task ever
    gathers an unbounded list. The caller chooses the limit and so knows the form. ``size``
    names a column that already holds the number of items of the key.
    """
    if size is None:
        large = (
            rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > limit)
        )
        rows, size = attach(rows, large, keys), "_size"
    shares = F.ceil(F.coalesce(F.col(size), F.lit(1)) / F.lit(limit))
    return (
        rows.withColumn("part", F.pmod(F.xxhash64(item), shares).cast("int"))
        .groupBy(*keys, "part")
        .agg(F.sort_array(F.collect_list(item)).alias(out))
    )
