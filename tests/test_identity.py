import random

import pytest

from quadweld.model import BNODE, IRI, LITERAL
from quadweld.operators import stage
from quadweld.operators.identity import (
    alternatives,
    canonical_map,
    cluster_members,
    map_terms,
    preferred_uris,
    star_forest,
)
from quadweld.plans.config import FusionConfig, Strategy
from tests.helpers import as_list, as_set, quads

LINKS = [("koeln", "cologne"), ("koln", "koeln"), ("wien", "vienna"), ("size", "area"), ("area", "extent"), ("extent", "size")]


def links(spark, pairs):
    return spark.createDataFrame(pairs, "s string, o string")


def uris(spark, names):
    return spark.createDataFrame([(n,) for n in names], "uri string")


def expected_components(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {(x, find(x)) for x in parent if find(x) != x}


def test_preference_from_three_places(spark):
    table = FusionConfig(properties={"size": Strategy()}).policy(spark)
    preferred = preferred_uris(spark, table, uris(spark, ["wien", "elsewhere"]), ["koln"])
    assert as_set(preferred, "uri") == {("size",), ("wien",), ("elsewhere",), ("koln",)}
    mapping = canonical_map(links(spark, LINKS), preferred)
    assert as_list(mapping, "uri", "canonical") == [
        ("area", "size"),
        ("cologne", "koln"),
        ("extent", "size"),
        ("koeln", "koln"),
        ("vienna", "wien"),
    ]


def test_least_uri_without_or_among_preferences(spark):
    mapping = canonical_map(links(spark, LINKS), uris(spark, ["size", "extent"]))
    assert as_set(mapping.where("uri LIKE 'k%'"), "canonical") == {("cologne",)}
    assert as_set(mapping.where("uri IN ('area', 'size')"), "canonical") == {("extent",)}
    assert canonical_map(links(spark, [])).isEmpty()
    assert canonical_map(links(spark, []), uris(spark, [])).isEmpty()


def chain(n):
    return [(f"c{i:03}", f"c{i + 1:03}") for i in range(n)]


def hub(n):
    return [(f"h{i:03}", "m") for i in range(n)] + [("m", "z1"), ("z1", "z2"), ("z3", "z2")]


@pytest.mark.parametrize("shape", [chain(40), hub(60), "random"], ids=["chain", "hub", "random"])
@pytest.mark.parametrize("heavy", [False, True], ids=["plain", "salted"])
def test_components_match_union_find(spark, shape, heavy, request):
    if heavy:
        request.getfixturevalue("everything_heavy")
    if shape == "random":
        pick = random.Random(7)
        shape = [(f"n{pick.randrange(80)}", f"n{pick.randrange(80)}") for _ in range(70)]
        shape = [(a, b) for a, b in shape if a != b]
    pick = random.Random(3)
    shuffled = [(a, b) if pick.random() < 0.5 else (b, a) for a, b in shape]
    pick.shuffle(shuffled)
    forest, _ = star_forest(links(spark, shuffled))
    assert as_set(forest, "a", "b") == expected_components(shape)


def test_finished_stars_leave_the_rounds(spark, tmp_path):
    pairs = [(f"p{i:03}", f"q{i:03}") for i in range(200)] + chain(30)
    with stage.writing_to(str(tmp_path)):
        forest, _ = star_forest(links(spark, pairs))
        assert as_set(forest, "a", "b") == expected_components(pairs)
    written = sorted(tmp_path.glob("links-*"), key=lambda p: p.stat().st_mtime)
    counts = [spark.read.parquet(str(p)).count() for p in written]
    assert counts[0] == 230 and max(counts[1:]) <= 60


def test_too_few_rounds_is_an_error(spark):
    with pytest.raises(RuntimeError):
        star_forest(links(spark, chain(40)), max_rounds=1)


@pytest.mark.parametrize("large", [False, True], ids=["broadcast", "shuffled"])
def test_terms_are_mapped_and_literals_are_not(spark, large, request):
    if large:
        request.getfixturevalue("everything_heavy")
    mapping = spark.createDataFrame([("a2", "a1"), ("p2", "p1")], "uri string, canonical string")
    rows = quads(
        spark,
        [
            ("a2", "p2", "a2", "a2"),
            ("a1", "p1", "lit", "a2", "g"),
            ("x", "q", "y", "g"),
        ]
        + [("a2", "q", f"o{i}", "g") for i in range(30)],
    )
    mapped = map_terms(rows, mapping)
    assert mapped.columns == rows.columns
    assert as_set(mapped.where("s <> 'a1' OR p <> 'q'"), "s", "p", "o", "g") == {
        ("a1", "p1", "a1", "a2"),
        ("a1", "p1", "a2", "g"),
        ("x", "q", "y", "g"),
    }
    assert mapped.count() == rows.count()


def test_quads_meet_the_terms_they_use_in_one_exchange(spark, monkeypatch):
    """By what is small: the terms in use, else only the predicates among them, else nothing."""
    pick = random.Random(11)
    names = {f"n{i}": f"c{i % 40}" for i in range(300)} | {"p1": "p0", "": "never"}
    mapping = spark.createDataFrame(list(names.items()), "uri string, canonical string").repartition(3)
    given = [("n7" if i % 3 else f"n{i % 90}", f"p{i % 3}", pick.choice(["n5", f"n{i % 70}", f"x{i}"]), "g") for i in range(240)]
    given += [("n1", "p1", LITERAL, "n1", f"g{i % 2}") for i in range(6)]
    rows = quads(spark, given)
    kinds = rows.select("s", "p", "o", "o_kind", "g").collect()
    want = sorted(
        (names.get(r.s, r.s), names.get(r.p, r.p), names.get(r.o, r.o) if r.o_kind in (IRI, BNODE) else r.o, r.g) for r in kinds
    )
    monkeypatch.setattr(stage, "HEAVY_FLOOR", 1)
    monkeypatch.setattr(stage, "HEAVY_SHARE", 0.1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for limit, most in ((1_000, 0), (200, 0), (1, 2), (0, 2)):
        monkeypatch.setattr(stage, "BROADCAST_ROWS", limit)
        mapped = map_terms(rows, mapping).select("s", "p", "o", "g")
        assert sorted(map(tuple, mapped.collect())) == want
        plan = mapped._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == most
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_alternatives_hold_the_canonical_member(spark):
    mapping = canonical_map(links(spark, LINKS))
    assert as_set(cluster_members(mapping).where("canonical = 'area'"), "uri") == {
        ("area",),
        ("extent",),
        ("size",),
    }
    lists = {r["canonical"]: r["uris"] for r in alternatives(mapping, 100).collect()}
    assert lists["cologne"] == ["cologne", "koeln", "koln"]
    # Beyond the limit a cluster takes several rows, and no member is lost.
    mapping = canonical_map(links(spark, hub(40)))
    parts = alternatives(mapping, limit=10).collect()
    assert len(parts) > 1
    members = [u for r in parts for u in r["uris"]]
    assert sorted(members) == sorted({x for pair in hub(40) for x in pair})
