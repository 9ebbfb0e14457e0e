import itertools
import math
import random
import re
from collections import Counter, defaultdict
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from quadweld import FusionConfig, Strategy
from quadweld.functions import terms
from quadweld.model import RETURN_ALL, SINGLEVALUED
from quadweld.operators import quality as judging
from quadweld.operators import resolve as resolving
from quadweld.operators.members import (
    anchor_picks,
    by_subject,
    conflict_members,
    dealt_members,
    follow_anchors,
    follow_in_place,
    free_rows,
    to_cluster_rows,
    without_nulls,
)
from quadweld.operators.policy import Rules
from quadweld.operators.quality import CLUSTER, VALUE, opposed_quality, value_quality, value_stats
from quadweld.operators.scores import score_graphs, source_scores
from quadweld.operators.stage import key_hash, materialize
from tests.helpers import as_list, as_set, quads

NUMBER = re.compile(r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?")


def apart(a, b):
    x, y = (Counter(map("".join, itertools.pairwise(f"^{t}$"))) for t in (a, b))
    dot = sum(n * y[g] for g, n in x.items())
    return 1 - dot / math.sqrt(sum(n * n for n in x.values()) * sum(n * n for n in y.values()))


def seconds(text):
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?)?", text):
        return None
    try:
        when = datetime.fromisoformat(text)
    except ValueError:
        return None
    return (when if when.tzinfo else when.replace(tzinfo=UTC)).timestamp()


def gap(a, b):
    (ka, ta), (kb, tb) = a, b
    if a == b:
        return 0.0
    if ka == kb == "lit":
        na, nb = bool(NUMBER.fullmatch(ta)), bool(NUMBER.fullmatch(tb))
        da, db = seconds(ta), seconds(tb)
        if na and nb:
            x, y = float(ta), float(tb)
            return 0.0 if x == y == 0 else min(1.0, abs(x - y) / max(abs(x), abs(y)))
        if da is not None and db is not None:
            return min(1.0, abs(da - db) / 31622400)
        if not na and not nb and da is None and db is None:
            return apart(ta, tb)
    return 1.0


def expected(rows, agree):
    """Quality of every value by comparing all pairs."""
    clusters = defaultdict(lambda: defaultdict(dict))
    for res, p, kind, o, g, w in rows:
        clusters[res, p][kind, o][g] = w
    out = {}
    for key, values in clusters.items():
        mass = {v: sum(ws.values()) for v, ws in values.items()}
        total = sum(mass.values())
        for v, ws in values.items():
            clash = sum(mass[u] * gap(v, u) for u in values)
            best = max(ws.values())
            first = best * (1 - (clash / total if total else 0))
            out[(*key, *v)] = first + (1 - first) * min(1, (mass[v] - best) / agree)
    return out


def random_members(seed):
    pick = random.Random(seed)
    pool = (
        [("lit", f"{pick.uniform(-50, 900):.3f}") for _ in range(25)]
        + [("lit", x) for x in ("0", "0.0", "-0", "5", "5.0", "+5", ".5", "1e3", "1e-9", "-7", "-7.0")]
        + [("lit", f"{1960 + pick.randrange(50)}-0{1 + pick.randrange(9)}-1{pick.randrange(9)}") for _ in range(25)]
        + [("lit", "2001-02-03T04:05:06Z"), ("lit", "2001-02-03 04:05:06"), ("lit", "2001-02-03T04:05:06+02:00")]
        + [("lit", "".join(pick.choice("abcd") for _ in range(pick.randrange(1, 9)))) for _ in range(25)]
        + [("lit", x) for x in ("n/a", "NaN", "1d", " 1.5 ", "2001-13-45", "Infinity")]
        + [("iri", f"http://x/{i}") for i in range(6)]
        + [("iri", "5"), ("bnode", "_:1:b")]
    )
    rows = set()
    weights = {f"g{i}": pick.choice([0.0, 0.1, 0.37, 0.5, 0.8, 1.0]) for i in range(12)}
    for c in range(6):
        for _ in range(90 if c else 400):
            kind, o = pick.choice(pool)
            g = pick.choice(list(weights))
            rows.add((f"r{c % 3}", f"p{c // 3}", kind, o, g, weights[g]))
    return sorted(rows)


def member_table(spark, rows):
    full = [(res, p, kind, o, "", "", g, w) for res, p, kind, o, g, w in rows]
    return spark.createDataFrame(
        full,
        "res string, p string, o_kind string, o string, o_dt string, o_lang string, g string, w double",
    )


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("heavy", ["none", "some", "all"])
def test_quality_matches_all_pairs(spark, seed, heavy):
    rows = random_members(seed)
    values = value_stats(member_table(spark, rows))
    hashes = []
    if heavy != "none":
        keys = values.select(*CLUSTER).distinct().select("res", key_hash(CLUSTER).alias("h"))
        hashes = [r["h"] for r in keys.collect() if heavy == "all" or r["res"] == "r0"]
    judged = opposed_quality(values, 4.0, heavy=hashes, parts=7).collect()
    wanted = expected(rows, 4.0)
    assert len(judged) == len(wanted)
    for r in judged:
        key = (r["res"], r["p"], r["o_kind"], r["o"])
        assert math.isclose(r["quality"], wanted[key], abs_tol=2e-9), (key, r["quality"], wanted[key])


def test_worked_example(spark):
    rows = [
        ("s", "p", "lit", "A", "g1", 1.0),
        ("s", "p", "lit", "A", "g2", 0.8),
        ("s", "p", "lit", "B", "g3", 0.5),
    ]
    values = value_stats(member_table(spark, rows))
    single = value_quality(values.withColumn("cardinality", F.lit("SINGLEVALUED")), 4.0)
    found = {r["o"]: round(r["quality"], 6) for r in single.collect()}
    assert found == {"A": 0.826087, "B": 0.108696}
    many = value_quality(values.withColumn("cardinality", F.lit("MANYVALUED")), 4.0)
    assert {r["o"]: round(r["quality"], 6) for r in many.collect()} == {"A": 1.0, "B": 0.5}


def test_agreeing_sources_reach_full_quality(spark):
    rows = [("s", "p", "lit", "A", f"g{i}", 1.0) for i in range(5)] + [("s", "p", "lit", "B", "h", 1.0)]
    values = value_stats(member_table(spark, rows))
    judged = {r["o"]: r["quality"] for r in opposed_quality(values, 4.0).collect()}
    assert judged["A"] == 1.0 and judged["B"] < 0.2


def test_worthless_sources_have_no_conflict(spark):
    rows = [("s", "p", "lit", x, f"g{x}", 0.0) for x in "AB"]
    judged = opposed_quality(value_stats(member_table(spark, rows)), 4.0)
    assert [r["quality"] for r in judged.collect()] == [0.0, 0.0]


def test_distance_of_single_pairs(spark):
    pairs = [
        ("lit", "10", "lit", "8", 0.2),
        ("lit", "-1", "lit", "1", 1.0),
        ("lit", "0", "lit", "0.0", 0.0),
        ("lit", "2000-01-01", "lit", "2000-07-02", 183 / 366),
        ("lit", "1990-01-01", "lit", "2000-01-01", 1.0),
        ("lit", "kitten", "lit", "sitting", 1 - 2 / math.sqrt(7 * 8)),
        ("lit", "", "lit", "", 0.0),
        ("lit", "5", "lit", "five", 1.0),
        ("iri", "http://a", "iri", "http://b", 1.0),
        ("iri", "a", "lit", "a", 1.0),
        ("iri", "a", "iri", "a", 0.0),
        ("lit", "NaN", "lit", "NaN", 0.0),
    ]
    table = spark.createDataFrame(pairs, "ak string, a string, bk string, b string, want double")
    c = F.col
    found = table.select(terms.distance(c("ak"), c("a"), c("bk"), c("b")).alias("d"), "want", "a", "b")
    for r in found.collect():
        assert math.isclose(r["d"], r["want"], abs_tol=1e-12), r


def test_numbers_of_any_size_are_compared(spark):
    rows = [("s", "p", "lit", x, f"g{x}", 1.0) for x in ("1e-305", "4e-305", "2e-305")]
    rows += [("t", "p", "lit", x, f"g{x}", 1.0) for x in ("1e308", "-1e308", "5e307", "5e-324")]
    judged = opposed_quality(value_stats(member_table(spark, rows)), 4.0).collect()
    wanted = expected(rows, 4.0)
    for r in judged:
        assert math.isclose(r["quality"], wanted[r["res"], "p", "lit", r["o"]], abs_tol=2e-9), r


def test_number_gate(spark):
    texts = ["1", "1.", ".5", "+1e5", "-0", "NaN", " 1", "1d", "", "1e", "1e400", "--1", "1_0"]
    table = spark.createDataFrame([(t,) for t in texts], "o string")
    good = table.where(terms.is_finite_number(F.lit("lit"), F.col("o")))
    assert {r["o"] for r in good.collect()} == {"1", "1.", ".5", "+1e5", "-0"}
    assert table.where(terms.is_finite_number(F.lit("iri"), F.col("o"))).isEmpty()


def test_source_scores(spark):
    rows = quads(
        spark,
        [
            ("g1", "score", "lit", "0.4", "m"),
            ("g1", "score", "lit", "0.8", "m"),
            ("g1", "by", "pub", "m"),
            ("g2", "score", "lit", "0.5", "m"),
            ("g3", "by", "pub", "m"),
            ("g3", "by", "other", "m"),
            ("g4", "score", "lit", "unknown", "m"),
            ("g5", "by", "nobody", "m"),
            ("pub", "rate", "lit", "1.0", "m"),
            ("other", "rate", "lit", "0.2", "m"),
        ],
    )
    scores = source_scores(rows, "score", "by", "rate", 0.25)
    graphs = spark.createDataFrame([(f"g{i}",) for i in range(1, 7)], "g string")
    found = dict(as_list(score_graphs(graphs, scores, 0.9), "g", "w"))
    wanted = {"g1": 0.75 * 0.6 + 0.25, "g2": 0.5, "g3": 0.6, "g4": 0.9, "g5": 0.9, "g6": 0.9}
    assert found == pytest.approx(wanted)
    assert score_graphs(graphs, None, 0.3).where("w <> 0.3").isEmpty()


def test_quality_does_not_depend_on_partitions(spark):
    members = member_table(spark, random_members(5))
    one = opposed_quality(value_stats(members.coalesce(1)), 4.0)
    many = opposed_quality(value_stats(members.repartition(9)), 4.0)
    assert as_list(one, *VALUE, "quality") == as_list(many, *VALUE, "quality")


def test_values_of_even_resources_are_judged_where_they_stand(spark, monkeypatch):
    """One exchange, and no copy, from the members to the qualities; the same rows as by the written copy."""
    values = value_stats(member_table(spark, random_members(5)).repartition(4, "res"))
    written = as_list(opposed_quality(values, 4.0), *VALUE, "quality")
    monkeypatch.setattr(judging, "materialize", None)
    judged = opposed_quality(values, 4.0, even=True)
    assert as_list(judged, *VALUE, "quality") == written
    assert judged._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


@pytest.mark.parametrize("even", [False, True])
def test_values_without_text_weigh_but_are_not_judged(spark, even):
    rows = [("s", "p", "lit", o, f"g{i}", 0.5) for i, o in enumerate(("1", None, "a"))]
    values = value_stats(member_table(spark, rows))
    judged = {r["o"]: r["quality"] for r in opposed_quality(values, 4.0, even=even).collect()}
    assert judged == pytest.approx({"1": 0.5 * (1 - 2 / 3), "a": 0.5 * (1 - 2 / 3)}, abs=1e-8)


def test_long_texts_meet_by_their_pairs(spark):
    draw = random.Random(3)
    texts = ["".join(draw.choices("abcdefghé 漢", k=200_000)) for _ in range(4)]
    rows = [("s", "p", "lit", t, f"g{i}", 0.5) for i, t in enumerate(texts)]
    values = value_stats(member_table(spark, rows))
    found = {r["o"]: r["quality"] for r in opposed_quality(values, 4.0).collect()}
    mass = 4 * 0.5
    for text in texts:
        clash = sum(0.5 * apart(text, other) for other in texts if other != text)
        assert found[text] == pytest.approx(0.5 * (1 - clash / mass), abs=2e-9)


def test_pairs_that_many_texts_share_are_salted(spark, everything_heavy):
    rows = [("s", "p", "lit", f"a{chr(97 + i % 26)}{i}x", f"g{i % 3}", 0.5) for i in range(40)] + [("t", "p", "lit", "ab", "g0", 1.0)]
    values = value_stats(member_table(spark, rows))
    got = {(r["res"], r["o"]): r["quality"] for r in opposed_quality(values, 4.0, heavy=[]).collect()}
    mass = 40 * 0.5
    for _, _, _, text, _, _ in rows[:-1]:
        clash = sum(0.5 * apart(text, r[3]) for r in rows[:-1] if r[3] != text)
        assert got["s", text] == pytest.approx(0.5 * (1 - clash / mass), abs=2e-9)


@pytest.mark.parametrize(("a", "b"), [("", "a"), ("", ""), ("aé😀b", "aéxb"), ("abab", "baba"), ("x" * 300, "xy" * 100)])
def test_distance_of_texts_of_any_characters(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(terms.text_distance(F.col("a"), F.col("b"))).first()[0] == pytest.approx(0.0 if a == b else apart(a, b), abs=1e-12)


def test_distance_of_long_texts(spark):
    df = spark.createDataFrame([("ab" * 100_000, "ba" * 100_000)], "a string, b string")
    assert df.select(terms.text_distance(F.col("a"), F.col("b"))).first()[0] < 1e-6


@pytest.mark.parametrize("subjects", [40, 2])
def test_members_of_even_resources_meet_in_one_exchange(spark, everything_heavy, subjects):
    rows = [(f"s{i % subjects}", "p", "lit", str(i % 80), f"g{i % 3}") for i in range(160)] + [(None, "p", "lit", None, "g")] * 2
    found = conflict_members(to_cluster_rows(quads(spark, rows), None))
    assert Counter(map(tuple, found.collect())) == Counter({(s, p, k, o, "", "", g) for s, p, k, o, g in rows})
    plan = value_stats(found.withColumn("w", F.lit(1.0)))._jdf.queryExecution().executedPlan().toString()
    # Two subjects are too heavy for one task each, so their rows are dealt by all columns.
    assert (plan.count("Exchange") == 1) == (subjects == 40)


def test_rows_that_take_an_exchange_are_made_once(spark, everything_heavy, monkeypatch):
    """However often the members are read, the rows come from one copy; the members are the same."""
    rows = to_cluster_rows(quads(spark, [(f"s{i % 40}", "p", "lit", str(i % 80), f"g{i % 3}") for i in range(160)] + [(None, "p", "lit", None, "g")] * 2), None)
    made = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda g: made.add(1) or g, "string").asNondeterministic()
    plain, even = dealt_members(rows)
    members, as_even = dealt_members(rows.withColumn("g", seen("g")), once=True)
    assert Counter(map(tuple, members.collect())) == Counter(map(tuple, plain.collect()))
    members.count()
    assert (even, made.value) == (as_even, 162)


def test_a_copy_stays_dealt(spark, everything_heavy):
    """Groupings, windows and judging of members written by resource need no exchange; the rows are the same."""
    rows = [(f"s{i % 40}", "p", "lit", str(i % 80), f"g{i % 3}") for i in range(160)]
    found, tasks = dealt_members(to_cluster_rows(quads(spark, rows), None))
    copy = materialize(found, "members", "res", tasks)
    assert tasks > 1 and Counter(map(tuple, copy.collect())) == Counter(map(tuple, found.collect()))
    values = opposed_quality(value_stats(copy.withColumn("w", F.lit(1.0))), 4.0, even=tasks)
    assert values._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0
    assert spark.catalog.listTables() == []


def test_source_rows_of_a_dealt_copy_need_no_exchange(spark, everything_heavy):
    rows = [(f"s{i % 40}", "p", "lit", str(i % 80), f"g{i % 3}") for i in range(160)] + [("s1", "p", "lit", None, "g")]
    found, tasks = dealt_members(to_cluster_rows(quads(spark, rows), None))
    copy = without_nulls(materialize(found, "members", "res", tasks)).withColumn("w", F.length("g") / F.lit(4.0))
    rules = Rules.read(FusionConfig().policy(spark))
    near = resolving.resolve(copy, rules, 4.0, even=tasks, near=True)
    apart = resolving.resolve(copy, rules, 4.0)
    columns = [*VALUE, "g", "quality", "n_sources"]
    assert as_set(resolving.source_rows(near), *columns) == as_set(resolving.source_rows(apart), *columns)
    assert as_set(near.statements, *VALUE, "quality") == as_set(apart.statements, *VALUE, "quality")
    assert resolving.source_rows(near)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0


def test_anchors_are_followed_in_place(spark, everything_heavy):
    """Claims and picks that lie by resource meet without an exchange; the members are those of the other way."""
    rows = [(f"{'ab'[i % 2]}{i % 80 // 2}", f"p{i % 7 % 3}", "lit", str(i % 5), f"g{i % 3}") for i in range(480)]
    rows += [("a1", None, "lit", "1", "g"), ("a2", "p1", "lit", None, None), ("c", "p1", "lit", "1", "g0"), ("c", "p1", "lit", "1", None)]
    mapping = spark.createDataFrame([(f"b{i}", f"a{i}") for i in range(40)], "uri string, canonical string")
    config = FusionConfig(properties={p: Strategy(cardinality=SINGLEVALUED, depends_on="p0") for p in ("p0", "p1")})
    rules = Rules.read(config.policy(spark))
    found, tasks = dealt_members(to_cluster_rows(quads(spark, rows), mapping), by_subject(rules))
    weighed = without_nulls(materialize(found.withColumn("w", F.lit(1.0)), "members", "res", tasks))
    picks = materialize(anchor_picks(weighed, rules, 4.0, even=tasks), "picks", "res", tasks)
    assert tasks > 1 and as_set(picks, "res", "_s", "_g") == as_set(anchor_picks(weighed, rules, 4.0), "res", "_s", "_g")
    columns = [*VALUE, "g", "w"]
    apart = free_rows(weighed, rules).unionByName(follow_anchors(weighed, rules, picks))
    met = follow_in_place(weighed, rules, picks)
    assert Counter(map(tuple, met.select(*columns).collect())) == Counter(map(tuple, apart.select(*columns).collect()))
    # A few picks may be broadcast.
    assert "Exchange hash" not in met._jdf.queryExecution().executedPlan().toString()


def test_only_properties_with_something_unusable_are_judged(spark, monkeypatch):
    rows = [("s", p, "lit", x, g, 1.0) for p, x, g in (("p", "1", "a"), ("p", "2", "b"), ("q", "1", "a"), ("q", "n/a", "b"))]
    seen, judge = [], resolving.judge_values
    monkeypatch.setattr(resolving, "judge_values", lambda values, *a: seen.append(values) or judge(values, *a))
    config = FusionConfig(default=Strategy("AVG", SINGLEVALUED, RETURN_ALL))
    found = resolving.resolve(member_table(spark, rows), Rules.read(config.policy(spark)), 4.0)
    assert as_set(found.statements, "p", "o") == {("p", "1.5"), ("q", "1"), ("q", "n/a")}
    assert as_set(seen[0], "p") == {("q",)}
