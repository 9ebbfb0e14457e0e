"""Value quality: how far the sources of a value support it or contradict it.

For a value ``v`` with source weights ``w``::

    base(v)  = max w
    clash(v) = sum over the other values u of W(u) * distance(v, u)
    conf(v)  = clash(v) / sum of all weights of the cluster   (0 if MANYVALUED)
    q1       = base * (1 - conf)
    quality  = q1 + (1 - q1) * min(1, (sum w - max w) / agree)

``clash`` never pairs up the values of a cluster where a closed form exists:

* positive numbers have distance ``1 - min/max``, so two running totals over the
  sorted values give the sum; the same holds for negative numbers by magnitude;
* dates have distance ``|a - b| / span`` up to 1, so running totals at ``t - span``,
  ``t`` and ``t + span`` give it;
* distinct IRIs, and values of different classes, have distance 1;
* texts have distance one minus the cosine of their character pairs. Vectors of length one
  are summed over the cluster, pair of characters by pair, and each text meets that sum.

Numbers are scaled by the greatest of their cluster and class first, which changes no distance and keeps
reciprocals and products in range; what is over 1e290 times smaller counts as 1e-290.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadweld.functions.terms import as_number, as_seconds, character_pairs, quantise
from quadweld.model import LITERAL, MAX_DATE_DIFFERENCE, SINGLEVALUED, TERM
from quadweld.operators.running import running_totals
from quadweld.operators.stage import heavy_columns, heavy_keys, key_hash, lookup, materialize, spread

CLUSTER = ["res", "p"]
VALUE = [*CLUSTER, *TERM]


def value_stats(weighed: DataFrame, *more: Column) -> DataFrame:
    """Distinct values of every cluster with the weights of their sources, and ``more`` aggregates.

    ``weighed`` holds distinct (value, graph) rows, so the count is the number of
    sources; the aggregate is partial, so a popular value costs one row per task.
    """
    return weighed.groupBy(*VALUE).agg(
        F.count(F.lit(1)).alias("n_sources"),
        F.max("w").alias("w_max"),
        F.sum("w").alias("w_sum"),
        *more,
    )


def agreement_quality(base: Column, conf: Column, others: Column, agree: float) -> Column:
    first = base * (F.lit(1.0) - conf)
    share = F.least(F.lit(1.0), others / F.lit(float(agree)))
    return quantise(first + (F.lit(1.0) - first) * share)


def unopposed_quality(values: DataFrame, agree: float) -> DataFrame:
    """Quality of MANYVALUED values: other values are no conflict."""
    others = F.col("w_sum") - F.col("w_max")
    return values.withColumn(
        "quality", agreement_quality(F.col("w_max"), F.lit(0.0), others, agree)
    )


def opposed_quality(
    values: DataFrame,
    agree: float,
    span: float = MAX_DATE_DIFFERENCE,
    heavy: list[int] | None = None,
    parts: int | None = None,
    even: bool = False,
) -> DataFrame:
    """Quality of SINGLEVALUED values: distant values of the cluster lower it.

    ``even`` says that no cluster is too large for one task; the values are then judged where they stand. Else the
    classed values are written once, and clusters that hold a large share of them
    (``heavy``, found when not given) are summed over sorted ranges instead of one
    window per cluster.
    """
    single = _classed(values, span)
    if even:
        clashing = _clash_by_window(single)
    else:
        single = materialize(single, "single")
        classes = {r["cls"] for r in single.select("cls").distinct().collect()}
        if heavy is None:
            found = heavy_columns(single, {"cluster": CLUSTER, "res": ["res"]})
            heavy = found["cluster"]
            # The window needs whole clusters; all of a resource together pack better.
            single = spread(single, CLUSTER if found["res"] else ["res"], single.count())
        clashing = with_clash(single, classes, heavy, parts)
    conf = F.when(F.col("mass") > 0, F.col("clash") / F.col("mass")).otherwise(F.lit(0.0))
    others = F.col("w_sum") - F.col("w_max")
    quality = agreement_quality(F.col("w_max"), conf, others, agree)
    # The copy has forgotten which columns are never null; later joins rely on it.
    return clashing.withColumn("quality", quality).select(
        *[
            F.coalesce(c, F.lit("")).alias(c) if c in ("o_dt", "o_lang") else F.col(c)
            for c in [*values.columns, "quality"]
        ]
    )


def value_quality(
    values: DataFrame,
    agree: float,
    span: float = MAX_DATE_DIFFERENCE,
    heavy: list[int] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Add ``quality`` to the rows of ``value_stats`` by their ``cardinality``."""
    is_single = F.col("cardinality") == SINGLEVALUED
    return unopposed_quality(values.where(~is_single), agree).unionByName(
        opposed_quality(values.where(is_single), agree, span, heavy, parts)
    )


def _classed(values: DataFrame, span: float) -> DataFrame:
    """Class of each value and its position ``at`` (magnitude, or time in spans)."""
    x = as_number(F.col("o_kind"), F.col("o"))
    # What is a number is no date.
    t = F.when(F.col("_x").isNull(), as_seconds(F.col("o_kind"), F.col("o")))
    return (
        values.withColumn("_x", x)
        .withColumn("_t", t)
        .withColumn(
            "cls",
            F.when(F.col("o_kind") != LITERAL, F.lit("node"))
            .when(F.col("_x") > 0, F.lit("plus"))
            .when(F.col("_x") < 0, F.lit("minus"))
            .when(F.col("_x") == 0, F.lit("zero"))
            .when(F.col("_t").isNotNull(), F.lit("time"))
            .otherwise(F.lit("text")),
        )
        .withColumn("at", F.coalesce(F.abs("_x"), F.col("_t") / F.lit(float(span))))
        .drop("_x", "_t")
    )


def _signed(cls: Column) -> Column:
    return cls.isin("plus", "minus")


def _number_clash() -> Column:
    at = F.col("at")
    return (F.col("w_up") - F.col("wx_up") / at) + (F.col("w_dn") - at * F.col("wi_dn"))


def _time_clash(within: Column) -> Column:
    """From totals up to t - 1, t and t + 1 (times in spans)."""
    at = F.col("at")
    before = at * (F.col("w_up") - F.col("w_lo")) - (F.col("wx_up") - F.col("wx_lo"))
    after = (F.col("wx_hi") - F.col("wx_up")) - at * (F.col("w_hi") - F.col("w_up"))
    return before + after + F.col("w_lo") + (within - F.col("w_hi"))


def _closed_clash() -> Column:
    """Clash within the class for every class but text."""
    return (
        F.when(_signed(F.col("cls")), _number_clash())
        .when(F.col("cls") == "time", _time_clash(F.col("cmass")))
        .when(F.col("cls") == "node", F.col("cmass") - F.col("w_sum"))
        .otherwise(F.lit(0.0))
    )


def with_clash(
    single: DataFrame, classes: set[str], heavy: list[int] | None = None, parts: int | None = None
) -> DataFrame:
    """Add ``mass`` (weight of the cluster) and ``clash`` (weighted distance).

    ``classes`` are the classes of values that occur; pairs of characters are left out of the plan where there is no text.
    """
    texts = "text" in classes
    if not heavy:
        return _clash_by_window(single, texts)
    is_heavy, is_text = key_hash(CLUSTER).isin(heavy), F.col("cls") == "text"
    large = _clash_by_ranges(single.where(is_heavy), parts)
    large = large.where(~is_text).unionByName(_clash_of_texts(large.where(is_text)))
    return _clash_by_window(single.where(~is_heavy), texts).unionByName(_whole_clash(large, single.columns))


def _whole_clash(rows: DataFrame, columns: list[str]) -> DataFrame:
    """From the clash within the class to that with all of the cluster."""
    total = F.greatest(F.lit(0.0), F.col("inner")) + (F.col("mass") - F.col("cmass"))
    return rows.withColumn("clash", total).select(*columns, "mass", "clash")


def _scaled(rows: DataFrame, top: Column) -> DataFrame:
    """Magnitudes of numbers as shares of ``top``, and their products with the weight."""
    share = F.greatest(F.col("at") / top, F.lit(1e-290))
    return rows.withColumn("at", F.when(_signed(F.col("cls")), share).otherwise(F.col("at"))).withColumns(
        {
            "_wx": F.when(F.col("at").isNotNull(), F.col("w_sum") * F.col("at")),
            "_wi": F.when(_signed(F.col("cls")), F.col("w_sum") / F.col("at")).otherwise(F.lit(0.0)),
        }
    )


def _with_pairs(rows: DataFrame) -> DataFrame:
    """Every row, and for a text one more for each of its pairs of characters.

    Those have the pair in ``_pair``, its share of a vector of length one in ``_x`` and a digest of the value in ``_text``, never the text.
    """
    pairs = character_pairs(F.col("o"))
    nothing = F.struct(F.lit("").alias("pair"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))

    def counted(now: Column, pair: Column) -> Column:
        # The k-th of equal ones takes their number's square from that of k - 1 to that of k.
        run = F.when(now["pair"] == pair, now["run"] + 1.0).otherwise(F.lit(1.0))
        return F.struct(pair.alias("pair"), run.alias("run"), (now["sum"] + 2.0 * run - 1.0).alias("sum"))

    is_text = F.col("cls") == "text"
    squares = F.aggregate(F.array_sort(pairs), nothing, counted, lambda now: now["sum"])
    itself = F.array(F.lit(None).cast("string"))
    told = rows.withColumns(
        {
            "_text": F.when(is_text, _digest("o_kind", "o", "o_dt", "o_lang")),
            "_length": F.when(is_text, F.sqrt(squares)),
            "_all": F.when(is_text, F.concat(itself, pairs)).otherwise(itself),
        }
    )
    # No list is empty; an outer explode keeps Catalyst from asking that of all rows before they are dealt.
    every = told.select(*rows.columns, "_text", "_length", F.explode_outer("_all").alias("_pair"))
    long = [c for c in TERM if c in rows.columns]
    alone = F.col("_pair").isNull()
    return every.withColumns({c: F.when(alone, F.col(c)) for c in long}).withColumn("_x", F.when(~alone, 1.0 / F.col("_length")))


def _clash_by_window(single: DataFrame, texts: bool = True) -> DataFrame:
    """Clusters of bounded size: ``mass`` and ``clash`` from running totals, in one pass over the rows.

    All windows are of one resource's rows, so rows that lie by resource or cluster stay where they are, and those
    that need the same order share a sort. Sorted by a hash first, see ``grouped``.
    """
    rows = single.withColumn("_key", key_hash(CLUSTER))
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    cluster = ["_key", *CLUSTER]
    # The weighted vectors of a cluster's texts are summed pair by pair, and each text meets that sum.
    if texts:
        of_pair = Window.partitionBy(*cluster, "cls", "_pair").orderBy("_text").rowsBetween(*whole)
        summed = F.when(F.col("_x").isNotNull(), F.sum(F.col("w_sum") * F.col("_x")).over(of_pair))
        of_text = Window.partitionBy(*cluster, "cls", "at", "_text").rowsBetween(*whole)
        cosines = F.sum(F.col("_x") * F.col("_sum")).over(of_text)
        rows = _with_pairs(rows).withColumn("_sum", summed).withColumn("_cosines", cosines).where(F.col("_pair").isNull())
    else:
        rows = rows.withColumn("_cosines", F.lit(0.0))

    same = Window.partitionBy(*cluster, "cls").orderBy("at")
    rows = rows.withColumns({"cmass": F.sum("w_sum").over(same.rowsBetween(*whole)), "_top": F.max("at").over(same.rowsBetween(*whole))})
    rows = rows.withColumn("mass", F.sum("w_sum").over(Window.partitionBy(*cluster).orderBy("cls", "at").rowsBetween(*whole)))
    rows = _scaled(rows, F.col("_top"))
    upto, nil = Window.unboundedPreceding, F.lit(0.0)
    up, down = (w.rowsBetween(upto, Window.currentRow) for w in (same, same.orderBy(F.desc("at"))))
    low, high = same.rangeBetween(upto, -1), same.rangeBetween(upto, 1)
    sums = {
        "w_up": F.sum("w_sum").over(up),
        "wx_up": F.sum("_wx").over(up),
        "w_lo": F.coalesce(F.sum("w_sum").over(low), nil),
        "wx_lo": F.coalesce(F.sum("_wx").over(low), nil),
        "w_hi": F.sum("w_sum").over(high),
        "wx_hi": F.sum("_wx").over(high),
        "w_dn": F.sum("w_sum").over(down),
        "wi_dn": F.sum("_wi").over(down),
    }
    rows = rows.withColumns(sums)
    inner = F.when(F.col("cls") == "text", F.col("cmass") - F.coalesce("_cosines", nil)).otherwise(_closed_clash())
    # A value without any text weighs in its cluster, but is no value to be judged.
    judged = rows.where((F.col("cls") != "text") | F.col("o").isNotNull())
    return _whole_clash(judged.withColumn("inner", inner), single.columns)


def _clash_by_ranges(rows: DataFrame, parts: int | None) -> DataFrame:
    """Clusters too large for one task: totals over sorted ranges.

    The per-cluster totals are broadcast; there is one row per heavy cluster and
    class, a number bounded by the share that makes a cluster heavy.
    """
    by_class = rows.groupBy(*CLUSTER, "cls").agg(
        F.sum("w_sum").alias("cmass"), F.max("at").alias("_top")
    )
    by_cluster = by_class.groupBy(*CLUSTER).agg(F.sum("cmass").alias("mass"))
    sized = rows.join(F.broadcast(by_class), [*CLUSTER, "cls"]).join(
        F.broadcast(by_cluster), CLUSTER
    )
    sized = materialize(_scaled(sized, F.col("_top")), "heavy")
    kept = sized.columns

    # A time also asks for the totals one span before and after it.
    probe = F.when(F.col("cls") == "time", F.array(F.lit(-1), F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    probes = (
        sized.where(_signed(F.col("cls")) | (F.col("cls") == "time"))
        .withColumn("_probe", F.explode(probe))
        .withColumns(
            {
                "_place": F.col("at") + F.col("_probe"),
                "_w0": F.when(F.col("_probe") == 0, F.col("w_sum")).otherwise(F.lit(0.0)),
                "_wx0": F.when(F.col("_probe") == 0, F.col("_wx")).otherwise(F.lit(0.0)),
            }
        )
    )
    totals = running_totals(
        probes,
        [*CLUSTER, "cls"],
        ["_place", *TERM, "_probe"],
        up={"_up": "_w0", "_xup": "_wx0"},
        down={"_dn": "_w0", "_idn": "_wi"},
        parts=parts,
    )

    def at_probe(column: str, which: int) -> Column:
        return F.max(F.when(F.col("_probe") == which, F.col(column)))

    ordered = totals.groupBy(*kept).agg(
        at_probe("_up", 0).alias("w_up"),
        at_probe("_xup", 0).alias("wx_up"),
        at_probe("_up", -1).alias("w_lo"),
        at_probe("_xup", -1).alias("wx_lo"),
        at_probe("_up", 1).alias("w_hi"),
        at_probe("_xup", 1).alias("wx_hi"),
        at_probe("_dn", 0).alias("w_dn"),
        at_probe("_idn", 0).alias("wi_dn"),
    )
    by_total = ordered.withColumn("inner", _closed_clash())
    flat = sized.where(F.col("cls").isin("node", "zero", "text")).withColumn(
        "inner",
        F.when(F.col("cls") == "node", F.col("cmass") - F.col("w_sum")).otherwise(F.lit(0.0)),
    )
    columns = [*rows.columns, "mass", "cmass", "inner"]
    return by_total.select(*columns).unionByName(flat.select(*columns))


def _digest(*columns: str) -> Column:
    """128 bits that stand for the values of some columns."""
    return F.md5(F.concat(*[F.md5(F.coalesce(F.col(c), F.lit("")).cast("binary")) for c in columns]).cast("binary"))


def _clash_of_texts(texts: DataFrame) -> DataFrame:
    """``inner`` of texts: the weight of the others less the weighted cosines with them.

    Work grows with the characters of the texts. Their pairs carry digests of the value and of the cluster, never the
    text, and are counted where they are made. A cluster's sum of vectors is made by partial sums and has one row per pair of characters;
    pairs that many texts of a cluster share are salted when they meet it.
    """
    keyed = texts.withColumns({"_value": _digest(*VALUE), "_cluster": _digest(*CLUSTER)})
    pairs = keyed.select("_value", "_cluster", "w_sum", F.explode(character_pairs(F.col("o"))).alias("_pair"))
    counts = pairs.groupBy("_value", "_cluster", "w_sum", "_pair").agg(F.count(F.lit(1)).cast("double").alias("_n"))
    # A window holds the pairs of one text.
    length = F.sqrt(F.sum(F.col("_n") * F.col("_n")).over(Window.partitionBy("_value")))
    vectors = materialize(counts.withColumn("_x", F.col("_n") / length).drop("_n"), "pairs")
    shared = ["_cluster", "_pair"]
    sums = vectors.groupBy(*shared).agg(F.sum(F.col("w_sum") * F.col("_x")).alias("_sum"))
    met = lookup(vectors, sums, shared, heavy_keys(vectors, shared), "inner")
    cosines = met.groupBy("_value").agg(F.sum(F.col("_x") * F.col("_sum")).alias("_cosines"))
    return (
        keyed.join(cosines, "_value")
        .withColumn("inner", F.col("cmass") - F.col("_cosines"))
        .select(*texts.columns)
    )
