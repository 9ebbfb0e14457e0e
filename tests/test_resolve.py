import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quadweld import FusionConfig, Strategy
from quadweld.model import IGNORE, NESTED, RETURN_ALL, SINGLEVALUED
from quadweld.operators import fusers  # noqa: F401
from quadweld.operators import resolve as resolving
from quadweld.operators.resolve import (
    REGISTRY,
    Clusters,
    Resolution,
    exact_sums,
    register,
    resolve,
    source_lists,
    with_result_graph,
)
from quadweld.operators.policy import Rules
from tests.helpers import as_list
from tests.test_quality import member_table

CLAIMS = [
    ("s", "p", "lit", "10", "g1", 1.0),
    ("s", "p", "lit", "10", "g2", 0.8),
    ("s", "p", "lit", "13", "g3", 0.5),
    ("s", "p", "lit", "13", "g1", 1.0),
    ("s", "p", "lit", "oops", "g4", 0.9),
    ("t", "p", "lit", "none", "g1", 1.0),
]


def run(spark, rows, strategy, large=False, default=Strategy()):
    config = FusionConfig(default=default, properties={"p": strategy} if strategy else {})
    members = member_table(spark, rows)
    return resolve(members, Rules.read(config.policy(spark)), 4.0, large=large)


def objects(resolution):
    return {(r["res"], r["o"]) for r in resolution.statements.collect()}


def test_all_keeps_every_value_with_its_sources(spark):
    found = run(spark, CLAIMS, None)
    assert objects(found) == {("s", "10"), ("s", "13"), ("s", "oops"), ("t", "none")}
    lists = {(r["s"], r["o"]): r["sources"] for r in source_lists(found, 1_000).collect()}
    assert lists["s", "10"] == ["g1", "g2"] and lists["s", "oops"] == ["g4"]


def test_long_source_lists_are_split_and_stay_whole(spark):
    rows = [("s", "p", "lit", "1", f"g{i:02}", 1.0) for i in range(50)]
    parts = source_lists(run(spark, rows, None), limit=10).collect()
    assert len(parts) > 1 and {r["n_sources"] for r in parts} == {50}
    assert sorted(g for r in parts for g in r["sources"]) == [f"g{i:02}" for i in range(50)]


@pytest.mark.parametrize("large", [False, True])
def test_best_by_quality_then_sources_then_value(spark, large, everything_heavy):
    rows = [("s", "p", "lit", "A", "g1", 1.0), ("s", "p", "lit", "A", "g2", 0.8), ("s", "p", "lit", "B", "g3", 0.5)]
    tie = [("t", "p", "lit", x, f"g{x}", 0.5) for x in "ZXY"]
    found = run(spark, rows + tie, Strategy("BEST", SINGLEVALUED), large)
    assert objects(found) == {("s", "A"), ("t", "X")}
    assert {(r["o"], r["g"]) for r in found.support.collect()} == {("A", "g1"), ("A", "g2"), ("X", "gX")}
    assert round(found.statements.where("o = 'A'").first()["quality"], 6) == 0.826087


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize("error", [IGNORE, RETURN_ALL, None])
def test_average_and_what_it_cannot_use(spark, error, large, everything_heavy):
    found = run(spark, CLAIMS, Strategy("AVG", SINGLEVALUED, error), large)
    passed = {("s", "oops"), ("t", "none")} if error != IGNORE else set()
    # Two claims of 10 and two of 13.
    assert objects(found) == {("s", "11.5")} | passed
    mean = found.statements.where("o LIKE '11%'").first()
    assert mean["n_sources"] == 3
    base = (1.0 + 0.8 + 0.5 + 1.0) / 4
    conf = (1.8 * 1.5 / 11.5 + 1.5 * 1.5 / 13) / 3.3
    assert mean["quality"] == pytest.approx(base * (1 - conf), abs=1e-8)
    support = {r["g"] for r in found.support.where("o LIKE '11%'").collect()}
    assert support == {"g1", "g2", "g3"}
    assert found.support.count() == 3 + len(passed)


def test_average_falls_back_to_doubles(spark):
    rows = [("s", "p", "lit", "1e30", "g1", 1.0), ("s", "p", "lit", "3e30", "g2", 1.0)]
    row = run(spark, rows, Strategy("AVG")).statements.first()
    assert float(row["o"]) == 2e30 and row["o_dt"].endswith("double")


def test_exact_average_keeps_every_digit(spark):
    rows = [("s", "p", "lit", x, f"g{i}", 1.0) for i, x in enumerate(["0.000001", "0.000002"])]
    assert run(spark, rows, Strategy("AVG")).statements.first()["o"] == "0.0000015"


@pytest.mark.parametrize(
    ("name", "params", "wanted"),
    [
        ("ANY", {}, {"10"}),
        ("MIN", {}, {"10"}),
        ("MAX", {}, {"13"}),
        ("MEDIAN", {}, {"11.5"}),
        ("SUM", {}, {"46"}),
        ("LONGEST", {}, {"oops"}),
        ("SHORTEST", {}, {"10"}),
        ("VOTE", {}, {"10"}),
        ("WEIGHTED_VOTE", {}, {"10"}),
        ("TOP_N", {"n": "2"}, {"10", "13"}),
        ("TOP_N", {}, {"10"}),
        ("THRESHOLD", {"threshold": "0.95"}, {"10", "13"}),
        ("CHOOSE_SOURCE", {"source": "g1"}, {"10", "13"}),
        ("BEST_SOURCE", {}, {"10", "13"}),
        ("NONE", {}, {"10", "13", "oops"}),
        ("CONCAT", {"separator": "; "}, {"10; 13; oops"}),
        ("CONCAT", {"separator": "", "block": "4"}, {"1013", "oops"}),
    ],
)
def test_further_functions(spark, name, params, wanted, everything_heavy):
    strategy = Strategy(name, agg_error=IGNORE, params=params)
    found = run(spark, [r for r in CLAIMS if r[0] == "s"], strategy, large=True)
    assert {o for _, o in objects(found)} == wanted
    supported = {r["o"] for r in found.support.select("o").distinct().collect()}
    assert supported == wanted


def test_best_source_reads_its_members_once(spark, monkeypatch):
    plans, write = [], resolving.materialize
    monkeypatch.setattr(resolving, "materialize", lambda df, label: plans.append(df) or write(df, label))
    rows = [*CLAIMS, ("u", "p", "lit", "1", None, 1.0), ("u", "p", "lit", "2", "g5", 0.5), ("v", "p", "lit", None, "g1", 1.0)]
    found = run(spark, rows, Strategy("BEST_SOURCE"))
    # A best graph without a name claims nothing, and a value without a text is none.
    assert objects(found) == {("s", "10"), ("s", "13"), ("t", "none")}
    plan = plans[-1]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD [res") == 1


@pytest.mark.parametrize("large", [False, True])
def test_concatenation_loses_no_text(spark, large, everything_heavy):
    texts = ["", "a", "a ", "b" * 500, "c", "\u00fcber", "zz"] + [f"t{i:03}" for i in range(60)]
    rows = [("s", "p", "lit", x, f"g{i % 7}", 0.5) for i, x in enumerate(texts)] + [("t", "p", "lit", "alone", "g", 1.0)]
    found = run(spark, rows, Strategy("CONCAT", params={"separator": "+", "block": "100"}), large=large)
    parts = [r for r in found.statements.collect() if r["res"] == "s"]
    assert len(parts) > 3
    assert "+".join(sorted(r["o"] for r in parts)) == "+".join(sorted(texts))
    assert {r["quality"] for r in parts} == {0.5}
    backed = {(r["o"], r["g"]) for r in found.support.where("res = 's'").collect()}
    for r in parts:
        graphs = {f"g{texts.index(t) % 7}" for t in r["o"].split("+")}
        assert {g for o, g in backed if o == r["o"]} == graphs and r["n_sources"] == len(graphs)
    assert ("t", "alone") in objects(found)


def test_concatenation_reads_the_members_once(spark):
    """Members that lie by resource are read once for the statements; those and their sources are the same."""
    rows = [("s", "p", "lit", f"t{i % 30:03}", f"g{i % 7}", 0.1 * (i % 7)) for i in range(90)] + [(None, "p", "lit", "x", "g", 1.0), ("t", "p", "lit", None, "g", 1.0)]
    made = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda g: made.add(1) or g, "string").asNondeterministic()
    members = member_table(spark, rows)
    rules = Rules.read(FusionConfig(properties={"p": Strategy("CONCAT", params={"block": "20"})}).policy(spark))
    apart = REGISTRY["CONCAT"](Clusters(members, rules))
    found = REGISTRY["CONCAT"](Clusters(members.withColumn("g", seen("g")), rules, even=1))
    assert as_list(found.statements, *found.statements.columns) == as_list(apart.statements, *apart.statements.columns)
    assert made.value == members.count()
    assert as_list(found.support, *found.support.columns) == as_list(apart.support, *apart.support.columns)


def test_most_recent_date(spark):
    rows = [("s", "p", "lit", x, "g", 1.0) for x in ("2001-05-01", "2001-05-02T00:00:00Z", "soon")]
    found = run(spark, rows, Strategy("MOST_RECENT", agg_error=IGNORE))
    assert objects(found) == {("s", "2001-05-02T00:00:00Z")}


def test_each_property_follows_its_own_strategy(spark):
    rows = CLAIMS + [("s", "q", "lit", x, "g1", 1.0) for x in "ab"]
    found = run(spark, rows, Strategy("AVG", SINGLEVALUED, IGNORE), default=Strategy("BEST"))
    assert objects(found) == {("s", "11.5"), ("s", "a")}


def test_nested_value_takes_the_mean_quality_of_its_statements(spark):
    rows = [
        ("s", "p", "iri", "child", "g1", 0.9),
        ("s", "p", "iri", "stranger", "g1", 0.9),
        ("child", "q", "lit", "1", "g1", 0.4),
        ("child", "q", "lit", "2", "g2", 0.8),
    ]
    found = run(spark, rows, Strategy(NESTED))
    quality = {r["o"]: r["quality"] for r in found.statements.collect()}
    assert quality == pytest.approx({"child": 0.6, "stranger": 0.9, "1": 0.4, "2": 0.8})


def test_registry_takes_new_functions_and_rejects_unknown_ones(spark):
    @register("FIRST_TWO")
    def first_two(clusters: Clusters) -> Resolution:
        return clusters.of_values(clusters.values.where("o IN ('10', '13')"))

    try:
        assert objects(run(spark, CLAIMS, Strategy("FIRST_TWO"))) == {("s", "10"), ("s", "13")}
    finally:
        del REGISTRY["FIRST_TWO"]
    with pytest.raises(ValueError, match="FIRST_TWO"):
        run(spark, CLAIMS, Strategy("FIRST_TWO"))


def test_result_graph_name(spark):
    found = with_result_graph(run(spark, CLAIMS, None).statements, "http://x/", "result")
    assert found.first()["g"] == "http://x/result/"


@pytest.mark.parametrize(("name", "want"), [("AVG", "0.0000002"), ("SUM", "0.0000004"), ("MEDIAN", "0.0000002")])
def test_small_numbers_keep_their_digits(spark, name, want):
    rows = [("s", "p", "lit", "0.0000001", "g1", 1.0), ("s", "p", "lit", "0.0000003", "g2", 1.0)]
    assert objects(run(spark, rows, Strategy(name))) == {("s", want)}


def test_means_without_an_end_are_doubles(spark):
    rows = [("s", "p", "lit", x, f"g{x}", 1.0) for x in ("1", "1.5", "2.25")]
    found = run(spark, rows, Strategy("AVG")).statements.first()
    assert float(found["o"]) == 4.75 / 3 and found["o_dt"].endswith("double")
    fine = [("s", "p", "lit", x, f"g{x}", 1.0) for x in ("0.123456789012", "0.123456789014")]
    assert float(next(iter(objects(run(spark, fine, Strategy("AVG")))))[1]) == pytest.approx(0.123456789013, rel=1e-12)


def test_tiny_numbers_are_numbers(spark):
    rows = [("s", "p", "lit", x, f"g{x}", 1.0) for x in ("1e-305", "3e-305")]
    assert objects(run(spark, rows, Strategy("MIN", agg_error=IGNORE))) == {("s", "1e-305")}
    (mean,) = objects(run(spark, rows, Strategy("AVG", SINGLEVALUED, IGNORE)))
    assert float(mean[1]) == pytest.approx(2e-305)


@pytest.mark.parametrize("name", ["SUM", "AVG"])
def test_sums_of_any_numbers_do_not_depend_on_the_order(spark, name):
    draw = random.Random(6)
    numbers = [f"{draw.choice('-+')}{draw.randrange(1, 10**15)}e{draw.randrange(-30, 30)}" for _ in range(300)] + ["1.5", "-7", "1E300", "-1E300"]
    found = set()
    for parts in (1, 4, 7):
        draw.shuffle(numbers)
        rows = [("s", "p", "lit", o, f"g{k}", 1.0) for k, o in enumerate(numbers)]
        members = member_table(spark, rows).repartition(parts, "o")
        config = FusionConfig(properties={"p": Strategy(name)})
        (row,) = resolve(members, Rules.read(config.policy(spark)), 4.0).statements.collect()
        found.add(row["o"])
    (text,) = found
    exact = sum(Fraction(o.replace("+", "")) for o in numbers) / (1 if name == "SUM" else len(numbers))
    assert float(text) == pytest.approx(float(exact), rel=1e-12)


def test_exact_sums_of_extreme_numbers(spark):
    numbers = [1e300, -1e300, 1.5, -2.25, 1e-5, 5e-324, 123456789.123, 1e22, 0.1, 1e7, 9999999.999]
    rows = [("r", "p", x) for x in numbers] + [("q", "p", 0.1)] * 10 + [("z", "p", -1e-320), ("n", "p", -0.001)]
    df = spark.createDataFrame(rows, "res string, p string, x double").repartition(3)
    found = {r["res"]: r["sum_x"] for r in exact_sums(df).collect()}
    assert found.pop("r") == pytest.approx(math.fsum(numbers), rel=1e-15)
    assert found == {"q": 1.0, "z": -1e-320, "n": -0.001}
