"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Counts over whole texts give every document a vector of transformed statistics. For each
language and source the determinant of a covariance over ``SUPPORT`` of the rows is made least by
concentration steps: location and scatter of the rows kept, squared Mahalanobis distances
of all rows, then the rows with the least distances are kept next. Steps begin at three starts, the rows
nearest to the medians by three measures of distance; after ``TRIAL_STEPS`` the start with the least determinant goes on, until no
determinant falls. Documents far from what remains are rejected. DataFrame functions only.

A step is one aggregation with partial sums over a written table of numbers. Statistics are whole
numbers of thousandths, so sums are exact and reruns agree. The cut between kept and other rows falls between slices of distance, whose counts are
summed; no group is sorted or brought together. A whole slice is kept, so a few more rows than ``SUPPORT`` may be, and a step
need not lower the determinant; then the estimate before it stands. Scatter gets a floor on its diagonal, so groups of few
or equal rows are judged by distance to their own centre in floor units.

A null text has no words; such a document fails the base rule and takes no part in the estimates.
A null language or source is a group of its own. Repeated rows are rows like any other. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadweld.llm.tables import WORD, materialize, maybe_broadcast

MIN_WORDS, MAX_REPEATED, SPAN = 20, 30, 8
#: Share of a group's rows that the estimate rests on, steps of concentration from every start, and most steps from the best.
SUPPORT, TRIAL_STEPS, STEPS = 0.75, 2, 12
#: Fall of the logarithm of a determinant that is worth another step.
FALL = 1e-6
#: Squared distance beyond which a document is an outlier: the 1 - 1e-6 quantile of chi-square with five degrees, doubled for the smaller scatter of the kept rows.
CUTOFF = 2 * 35.9
#: Least standard deviation of a statistic, in thousandths.
FLOOR = 60
#: Estimates of up to this many groups are sent to every task.
BROADCAST_GROUPS = 100_000
#: Slices of distance in a factor of e.
SLICES = 64

STATS = ("x1", "x2", "x3", "x4", "x5")
_DIMS = range(len(STATS))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated(hashes: Column) -> Column:
    """Words inside windows of which the document has another; ``hashes`` are those of all words."""
    windows = F.transform(
        F.sequence(F.lit(1), F.size(hashes) - (SPAN - 1)),
        lambda i: F.xxhash64(F.slice(hashes, i, SPAN)),
    )

    def covered(found: Column) -> Column:
        # Places of windows whose neighbour in the order by hash is equal, put back in order of place.
        placed = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = _let(
            placed,
            lambda p: F.array_sort(
                F.transform(
                    F.filter(
                        F.transform(
                            p,
                            lambda x, k: F.struct(
                                x["i"].alias("i"),
                                (
                                    ((k > 0) & (F.get(p, k - 1)["h"] == x["h"]))
                                    | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False))
                                ).alias("again"),
                            ),
                        ),
                        lambda x: x["again"],
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        return _let(
            twice,
            lambda t: F.aggregate(
                F.transform(t, lambda i, k: F.least(F.coalesce(F.get(t, k + 1) - i, F.lit(SPAN)), F.lit(SPAN))),
                F.lit(0).cast("long"),
                lambda a, x: a + x.cast("long"),
            ),
        )

    none = F.lit(0).cast("long")
    return F.when(F.size(hashes) < SPAN + 1, none).otherwise(
        _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), none).otherwise(covered(w)))
    )


def counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts that rules and statistics rest on."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    word_chars = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))
    n_symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))
    return docs.select(
        "doc_id",
        "lang",
        "source",
        word_chars.cast("long").alias("word_chars"),
        n_symbols.cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _let(
            F.transform(words, lambda w: F.xxhash64(w)),
            lambda h: F.struct(
                F.size(h).cast("long").alias("n_words"),
                _repeated(h).alias("n_repeat_words"),
                # Words that only say the one before again.
                F.size(F.filter(h, lambda x, i: (i > 0) & (F.get(h, i - 1) == x))).cast("long").alias("n_stutters"),
            ),
        ).alias("_w"),
    ).select("doc_id", "lang", "source", "_w.n_words", "word_chars", "n_symbols", "n_dup_lines", "_w.n_repeat_words", "_w.n_stutters")


def statistics(counted: DataFrame) -> DataFrame:
    """Thousandths of transformed statistics; shrunk towards plain prose where a text is short."""
    words = F.col("n_words")
    mean_length = F.log((F.col("word_chars") + 275) / (words + 50))
    # One line said twice is no fault even of a short text; what is mostly repeats fails the base rule.
    share = lambda c, weight, plain: F.asinh(F.lit(weight) * F.col(c) / (words + plain))
    made = (
        mean_length,
        share("n_symbols", 10.0, 50),
        share("n_dup_lines", 5.0, 200),
        share("n_repeat_words", 2.0, 150),
        share("n_stutters", 4.0, 50),
    )
    return counted.withColumns({name: F.round(1000 * x).cast("long") for name, x in zip(STATS, made, strict=True)})


_GROUP = ["lang", "source"]
_START = ["group", "start"]
_ESTIMATE = [*[f"m{i}" for i in _DIMS], *[f"l{i}{j}" for i in _DIMS for j in range(i + 1)]]


def _named(group: list[str]) -> Column:
    return F.concat_ws("\x1f", *[F.concat(F.when(F.col(c).isNull(), "0").otherwise("1"), F.coalesce(c, F.lit(""))) for c in group])


def _estimate(kept: DataFrame) -> DataFrame:
    """Location, the lower triangle of the scatter's Cholesky factor and the logarithm of its determinant, per group and start."""
    sums = {f"s{i}": F.sum(x).cast("decimal(38,0)") for i, x in enumerate(STATS)}
    sums |= {
        f"q{i}{j}": F.sum((F.col(STATS[i]) * F.col(STATS[j])).cast("decimal(20,0)")) for i in _DIMS for j in range(i + 1)
    }
    per = kept.groupBy(*_START).agg(F.count(F.lit(1)).alias("n"), *[v.alias(k) for k, v in sums.items()])
    per = per.select(*_START, "n", *[F.col(k).cast("double").alias(k) for k in sums])
    n = F.col("n")
    per = per.withColumns({f"m{i}": F.col(f"s{i}") / n for i in _DIMS})
    per = per.withColumns(
        {
            f"c{i}{j}": F.col(f"q{i}{j}") / n
            - F.col(f"m{i}") * F.col(f"m{j}")
            + (F.lit(float(FLOOR**2)) if i == j else F.lit(0.0))
            for i in _DIMS
            for j in range(i + 1)
        }
    )
    for i in _DIMS:
        for j in range(i + 1):
            left = F.col(f"c{i}{j}")
            for k in range(j):
                left = left - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # The floor keeps every pivot positive but for rounding.
            per = per.withColumn(f"l{i}{j}", F.sqrt(F.greatest(left, F.lit(1.0))) if i == j else left / F.col(f"l{j}{j}"))
    log_det = 2 * sum((F.log(f"l{i}{i}") for i in _DIMS[1:]), F.log("l00"))
    return per.select(*_START, log_det.alias("log_det"), *_ESTIMATE)


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    z: list[Column] = []
    for i, x in enumerate(STATS):
        left = F.col(x) - F.col(f"m{i}")
        for k in range(i):
            left = left - F.col(f"l{i}{k}") * z[k]
        z.append(left / F.col(f"l{i}{i}"))
    return sum((v * v for v in z[1:]), z[0] * z[0])


def _slice(distance: Column) -> Column:
    return F.floor(F.log(distance + 0.01) * SLICES).cast("int")


def _least_of(estimates: DataFrame, *keys: str) -> DataFrame:
    """Per key the estimate with the least determinant."""
    fields = [c for c in ("log_det", "start", *_ESTIMATE) if c not in keys]
    best = estimates.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in fields])


def _concentrated(rows: DataFrame, estimate: DataFrame, support: float) -> DataFrame:
    """Estimates after one step from each of the given ones, or those given where the determinant doesn't fall."""
    measured = rows.join(_per_group(estimate), "group").withColumn("slice", _slice(_distance()))
    within = _per_group(materialize(_least(measured, support), "within"))
    kept = measured.join(within, _START).where(F.col("slice") <= F.col("most"))
    both = estimate.select(*_START, "log_det", *_ESTIMATE).unionByName(_estimate(kept))
    return materialize(_least_of(both, *_START), "estimate")


def _fell(before: DataFrame, after: DataFrame) -> bool:
    old = before.select("group", F.col("log_det").alias("was"))
    return not after.join(old, "group").where(F.col("log_det") < F.col("was") - FALL).isEmpty()


def robust_estimates(rows: DataFrame, support: float = SUPPORT, trial_steps: int = TRIAL_STEPS, steps: int = STEPS) -> DataFrame:
    """Per group of ``rows`` the estimate of the least determinant that was found."""
    estimate = materialize(_first(rows, support), "estimate")
    for _ in range(trial_steps):
        estimate = _concentrated(rows, estimate, support)
    estimate = materialize(_least_of(estimate, "group"), "estimate")
    for _ in range(steps):
        before, estimate = estimate, _concentrated(rows, estimate, support)
        if not _fell(before, estimate):
            break
    return estimate


def distances(stats: DataFrame) -> DataFrame:
    """``stats`` with the squared distance ``d2`` to the robust centre of its group."""
    rows = stats.withColumn("group", _named(_GROUP))
    estimate = robust_estimates(rows)
    return rows.join(_per_group(estimate), "group").withColumn("d2", _distance()).select(*stats.columns, "d2")


def _per_group(table: DataFrame) -> DataFrame:
    """A written table with a row or three per group, sent to every task if there are few groups.

    Rows of a hot group then stay where they are; beyond the bound the join is a shuffle.
    """
    return maybe_broadcast(table, BROADCAST_GROUPS)


def _least(rows: DataFrame, support: float) -> DataFrame:
    """Per group and start the slice with which ``support`` of the rows are reached. Slices are few, rows many."""
    held = rows.groupBy(*_START, "slice").agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy(*_START).orderBy("slice")
    total = F.sum("n").over(Window.partitionBy(*_START))
    reached = held.withColumn("reached", F.sum("n").over(along) >= F.ceil(total * F.lit(support)))
    return reached.where("reached").groupBy(*_START).agg(F.min("slice").alias("most"))


def _first(rows: DataFrame, support: float) -> DataFrame:
    """Estimates from the rows nearest to the medians: by plain distances added up, by scaled ones added up, and by the largest scaled one."""
    long = rows.select("group", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(x).alias("x")) for i, x in enumerate(STATS)])).alias("v"))
    held = long.groupBy("group", F.col("v.i").alias("i"), F.floor(F.col("v.x") / 5).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("group", "i").orderBy("bin")
    reached = F.sum("n").over(along) / F.sum("n").over(Window.partitionBy("group", "i"))
    quarter = lambda q: F.min(F.when(F.col("reached") >= q / 4, F.col("bin"))) * 5
    quarters = held.withColumn("reached", reached).groupBy("group", "i").agg(*[quarter(q).alias(f"q{q}") for q in (1, 2, 3)])
    scale = F.greatest(F.col("q3") - F.col("q1"), F.lit(FLOOR))
    of = lambda i, c: F.max(F.when(F.col("i") == i, c))
    centre = quarters.groupBy("group").agg(*[of(i, F.col("q2")).alias(f"m{i}") for i in _DIMS], *[of(i, scale).alias(f"w{i}") for i in _DIMS])
    centre = _per_group(materialize(centre, "centre"))
    plain = [F.abs(F.col(x) - F.col(f"m{i}")) for i, x in enumerate(STATS)]
    scaled = [1_000 * d / F.col(f"w{i}") for i, d in enumerate(plain)]
    far = (sum(plain[1:], plain[0]).cast("double"), sum(scaled[1:], scaled[0]), F.greatest(*scaled))
    starts = F.array(*[F.struct(F.lit(k).alias("start"), _slice(d).alias("slice")) for k, d in enumerate(far)])
    placed = rows.join(centre, "group").select("group", *STATS, F.inline(starts))
    within = _per_group(materialize(_least(placed, support), "within"))
    return _estimate(placed.join(within, _START).where(F.col("slice") <= F.col("most")))


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Counts, base rule, distance (null where the base rule fails) and verdict of every document."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    stats = materialize(statistics(counts(docs)).withColumn("base_failed", failed), "statistics")
    base = stats.where("base_failed").withColumn("d2", F.lit(None).cast("double"))
    judged = distances(stats.where("NOT base_failed")).unionByName(base)
    return judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(False)))


def op8_quality_rules(docs: DataFrame) -> DataFrame:
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2"
    )
