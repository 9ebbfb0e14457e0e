"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are queued in the order of a digest, the whole queue
``passes`` times over. A copy of a document finishes at its source's words so far divided by
the source's target; all copies are sorted by that virtual time, and the mix ends before
the first copy with which its words would exceed the budget.

Running totals never put a source into one task: digests are cut into buckets by their
leading hex digits, a bucket holds about ``BUCKET_ROWS`` rows (rows of one doc_id are cut by a digest of
the whole row), and only bucket totals are carried on. The same holds for the global order, cut by virtual time. All sums are whole
numbers, so reruns agree.

Null texts have size 0 and take part; a null source is a source of its own, last in
order. Sources are taken to be few (thousands): one row of each goes through one window. Rows with equal doc_id, text size and source are told apart by a running number,
so that repeated rows queue one after the other. An empty table gives an empty mix. Other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadweld.llm.tables import WORD, fresh, hex_digits, materialize
from quadweld.operators.stage import attach

#: Weights in the order of the sources, budget and largest number of passes.
WEIGHTS = (5, 2, 1)
BUDGET = (3, 2)
PASSES = 2
BUCKET_ROWS = 1_000
#: A bucket of more than so many times its rows (one doc_id that many rows share) is dealt again, by a digest of the whole row.
CROWDED = 8


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget=BUDGET, passes=PASSES) -> DataFrame:
    """Per source its words, weight and target. One row per source goes through one window.

    Sources are ordered by what they need for each unit of weight until they are exhausted;
    those that reach ``passes`` times their size are the first in that order, and the others share
    the rest by weight.
    """
    up, down = budget
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = (F.row_number().over(in_order) - 1) % len(weights)
    weighed = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), rank + 1).cast("long"))
    by_need = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_need.rowsBetween(Window.unboundedPreceding, -1)
    later = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.lit(up) * F.sum("source_size").over(everything)
        - F.lit(passes * down) * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))
    ).cast("double") / (F.lit(down) * F.sum("weight").over(later)).cast("double")
    full = F.lit(passes) * F.col("source_size") <= F.col("level") * F.col("weight")
    leveled = weighed.withColumn("level", level).withColumn("full", full)
    # The first source that isn't exhausted sets the level of all after it.
    first_open = F.min(F.when(~F.col("full"), F.struct("ratio", "source", "level"))).over(everything)
    leveled = leveled.withColumn("ratio", F.col("source_size") / F.col("weight"))
    opened = leveled.withColumn("open", first_open["level"])
    return opened.select(
        "source",
        "source_size",
        "weight",
        F.when(F.col("full"), (F.lit(passes) * F.col("source_size")).cast("double"))
        .otherwise(F.col("open") * F.col("weight"))
        .alias("target"),
    )


def _running(group: list[str], bucket: str, order: list[Column], size: str) -> Column:
    return F.sum(size).over(
        Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _before(df: DataFrame, group: list[str], bucket: str, size: str) -> DataFrame:
    """What earlier buckets of the group hold."""
    window = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.groupBy(*group, bucket)
        .agg(F.sum(size).alias("_held"))
        .select(*group, bucket, F.coalesce(F.sum("_held").over(window), F.lit(0)).alias("_before"))
    )


def _uncrowded(named: DataFrame) -> DataFrame:
    """Buckets of many rows get further digits, of a digest of id, size and text; only rows equal in all of them stay together."""
    held = named.groupBy("source_key", "bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWDED * BUCKET_ROWS)
    digits = F.ceil(F.log(F.col("n") / BUCKET_ROWS) / math.log(16)).cast("int")
    crowded = materialize(held.select("source_key", "bucket", digits.alias("digits")), "crowded")
    if crowded.isEmpty():
        return named
    whole = F.md5(F.to_json(F.struct("doc_id", "size", "text_key")))
    further = F.coalesce(F.substring(whole, F.lit(1), F.col("digits")), F.lit(""))
    return attach(named, crowded, ["source_key", "bucket"]).withColumn("bucket", F.concat("bucket", further)).drop("digits")


def queue(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents with the words of their source up to and including them, in queue order."""
    rows = sizes.count()
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    keyed = sizes.withColumn("digest", digest).withColumn(
        "bucket", F.substring("digest", 1, hex_digits(rows, BUCKET_ROWS))
    )
    named = keyed.withColumn("source_key", F.struct(F.col("source").isNull(), F.coalesce("source", F.lit(""))))
    named = _uncrowded(named)
    before = _before(named, ["source_key"], "bucket", "size")
    order = [F.col(c) for c in ("digest", "doc_id", "size", "text_key")]
    # The place in the bucket tells equal rows apart.
    within = named.withColumn(
        "place", F.row_number().over(Window.partitionBy("source_key", "bucket").orderBy(*order))
    )
    order.append(F.col("place"))
    within = within.withColumn("_within", _running(["source_key"], "bucket", order, "size"))
    goals = targets.withColumn(
        "source_key", F.struct(F.col("source").isNull(), F.coalesce("source", F.lit("")))
    ).drop("source")
    return (
        within.join(before, ["source_key", "bucket"])
        .withColumn("upto", F.col("_before") + F.col("_within"))
        .join(goals, "source_key")
        .drop("_before", "_within", "bucket", "source_key")
    )


def mixed_documents(docs: DataFrame, weights=WEIGHTS, budget=BUDGET, passes=PASSES) -> DataFrame:
    """The documents that the mix takes, range-sorted by the virtual time of their first copy.

    Columns of ``docs`` with ``size``, ``copies``, ``finish`` of the first copy and ``taken`` words. Rows with equal
    doc_id, source and text come back as one, with the copies of all of them.
    """
    named = ("size", "copies", "finish", "taken")
    rows = docs.drop(*named)
    held, *made = fresh(rows.columns, "_key", "_size", "_copies", "_finish", "_taken")
    key = lambda size, text: F.md5(F.to_json(F.struct(F.col("doc_id").alias("d"), F.col("source").alias("s"), size.alias("n"), text.alias("t"))))
    taken = (
        mix(docs, weights, budget, passes)
        .where("taken")
        .groupBy(key(F.col("size"), F.col("text_key")).alias(held))
        .agg(F.count(F.lit(1)).alias(made[1]), F.min("finish").alias(made[2]), F.sum("size").alias(made[3]))
    )
    sized = rows.withColumn(made[0], _size_of(F.col("text")))
    met = sized.withColumn(held, key(F.col(made[0]), _text_key())).join(taken, held).dropDuplicates([held])
    return met.select(*rows.columns, *[F.col(m).alias(n) for m, n in zip(made, named, strict=True)]).orderBy("finish", "doc_id")


def _text_key() -> Column:
    return F.coalesce(F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 32), F.lit("none"))


def _size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(docs: DataFrame, weights=WEIGHTS, budget=BUDGET, passes=PASSES) -> DataFrame:
    """One row per copy in the queues: doc_id, source, size, target, pass, finish, and whether the mix takes it.

    Also a digest of the text, which orders rows that are equal otherwise.
    """
    sizes = materialize(
        docs.select("doc_id", "source", _size_of(F.col("text")).alias("size"), _text_key().alias("text_key")),
        "sizes",
    )
    targets = materialize(source_targets(sizes, weights, budget, passes), "targets")
    queued = materialize(queue(sizes, targets), "queued")
    copies = queued.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1)))).withColumn(
        "finish",
        F.when(
            F.col("target") > 0,
            (F.col("upto") + F.col("pass") * F.col("source_size")).cast("double") / F.col("target"),
        ).otherwise(0.0),
    )
    # Slices of virtual time: all sources advance evenly in it, so slices hold about equal numbers of rows.
    slices = 16 ** hex_digits(queued.count(), BUCKET_ROWS)
    sliced = copies.withColumn("slice", F.least(F.floor(F.col("finish") * slices), F.lit(4 * slices)).cast("long"))
    total = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    allowed = total * budget[0] // budget[1]
    starts = _before(sliced, [], "slice", "size")
    # The one slice in which the budget ends is the last that starts within it.
    last = starts.where(F.col("_before") <= allowed).agg(F.max(F.struct("slice", "_before")).alias("last")).first()["last"]
    if last is None:
        return sliced.withColumn("taken", F.lit(False)).drop("slice")
    order = [F.col(c) for c in ("finish", "digest", "doc_id", "size", "place", "pass")]
    closing = sliced.where(F.col("slice") == last["slice"])
    ended = closing.withColumn("taken", _running([], "slice", order, "size") + F.lit(last["_before"]) <= allowed)
    earlier = sliced.where(F.col("slice") < last["slice"]).withColumn("taken", F.lit(True))
    after = sliced.where(F.col("slice") > last["slice"]).withColumn("taken", F.lit(False))
    return earlier.unionByName(ended).unionByName(after).drop("slice")


def op9_mixing(docs: DataFrame) -> DataFrame:
    """Words that the mix takes from every document."""
    taken = F.sum(F.when(F.col("taken"), F.col("size")).otherwise(F.lit(0)))
    return (
        mix(docs)
        .groupBy("digest", "doc_id", "source", "size", "text_key", "place", "upto", "source_size", "target")
        .agg(taken.alias("taken"))
        .select("doc_id", "size", "source_size", "target", "taken")
    )


ORACLE = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS r FROM sizes GROUP BY source
), weighed AS (
  SELECT *, CASE r WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM per
), leveled AS (
  SELECT *, (3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (2 * sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM weighed
), targets AS (
  SELECT source, source_size, CASE WHEN 2 * source_size <= level * weight THEN (2 * source_size)::DOUBLE
    ELSE (SELECT level FROM leveled x WHERE NOT 2 * x.source_size <= x.level * x.weight ORDER BY x.source_size / x.weight, x.source LIMIT 1) * weight END AS target
  FROM leveled
), queued AS (
  SELECT doc_id, size, source_size, target, md5(doc_id::VARCHAR) AS digest,
         sum(size) OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM sizes JOIN targets USING (source)
), copies AS (
  SELECT *, CASE WHEN target > 0 THEN (upto + pass * source_size)::DOUBLE / target ELSE 0 END AS finish
  FROM queued, (VALUES (0), (1)) p(pass)
), summed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, digest, doc_id, size, pass ROWS UNBOUNDED PRECEDING) <= (SELECT sum(size) * 3 // 2 FROM sizes) AS within FROM copies
)
SELECT doc_id, size, source_size, target, (sum(CASE WHEN within THEN size ELSE 0 END))::BIGINT AS taken
FROM summed GROUP BY doc_id, size, source_size, target
"""
