import importlib
from concurrent.futures import ThreadPoolExecutor

import pytest

from quadweld import FusionConfig, Strategy, fuse
from quadweld.model import NESTED, OWL_SAME_AS, RDF_TYPE, SINGLEVALUED, TRIPLE
from quadweld.operators import sinks, stage
from quadweld.sources.canonical import scan_canonical
from tests.helpers import as_list, as_set, literals, quads

INPUT = [
    ("a1", "price", "10", "g1"),
    ("a2", "price", "12", "g2"),
    ("a2", "cost", "14", "g3"),
    ("b1", "label", "x", "g1"),
    ("b2", "label", "x", "g2"),
    ("b2", "label", "y", "g3"),
]
LINKS = [("a1", OWL_SAME_AS, "a2", "l"), ("b1", OWL_SAME_AS, "b2", "l"), ("price", OWL_SAME_AS, "cost", "l")]
CONFIG = FusionConfig(
    properties={"cost": Strategy("AVG", SINGLEVALUED), "label": Strategy("BEST", SINGLEVALUED)}
)


def triples(result):
    return as_set(result.statements, "s", "p", "o")


def test_whole_job_maps_subjects_and_properties(spark):
    result = fuse([literals(spark, INPUT), None], quads(spark, LINKS), config=CONFIG)
    # The property with a strategy is the canonical one.
    assert triples(result) == {("a1", "cost", "12"), ("b1", "label", "x")}
    assert as_list(result.with_sources(), "s", "g") == [
        ("a1", "g1"), ("a1", "g2"), ("a1", "g3"), ("b1", "g1"), ("b1", "g2")
    ]
    assert (result.loaded, result.linked) == ((6, 0), 3)
    assert as_set(result.statements.where("s = 'b1'"), "o_dt", "o_lang") == {(None, None)}


def test_without_links_or_policy_the_input_comes_back(spark):
    result = fuse([literals(spark, INPUT + INPUT[:2])])
    assert triples(result) == {r[:3] for r in INPUT}
    again = fuse([result.quads()])
    assert triples(again) == triples(result)


def test_declared_graphs_limit_the_input(spark):
    result = fuse([literals(spark, INPUT)], graphs=[["g1"]])
    assert triples(result) == {("a1", "price", "10"), ("b1", "label", "x")}


def test_class_and_mapping_filters(spark):
    rows = literals(spark, INPUT).unionByName(
        quads(spark, [("a2", RDF_TYPE, "k", "g"), ("z", RDF_TYPE, "k", "g")])
    )
    links = quads(spark, LINKS)
    by_class = fuse([rows], links, config=CONFIG.with_options(required_class="k"))
    assert {s for s, _, _ in triples(by_class)} == {"a1", "z"}
    both = fuse([rows], links, config=CONFIG.with_options(required_class="k", mapped_only=True))
    assert {s for s, _, _ in triples(both)} == {"a1"}


def test_children_of_kept_resources_stay(spark):
    rows = quads(
        spark,
        [("order", RDF_TYPE, "k", "g"), ("order", "by", "customer", "g"), ("customer", "in", "x", "g"),
         ("other", "in", "x", "g")],
    )
    config = FusionConfig(properties={"by": Strategy(NESTED)}, required_class="k")
    assert {s for s, _, _ in triples(fuse([rows], config=config))} == {"order", "customer"}


@pytest.mark.parametrize("heavy", [False, True])
def test_dependent_properties_come_from_one_source(spark, heavy, request):
    if heavy:
        request.getfixturevalue("everything_heavy")
    meta = quads(
        spark, [(f"g{i}", "urn:quality:score", "lit", str(w), "m") for i, w in ((1, 0.9), (2, 0.4), (3, 0.5))]
    )
    rows = literals(
        spark,
        [
            ("a1", "lat", "1.0", "g2"),
            ("a2", "lat", "5.0", "g1"),
            ("a1", "long", "2.0", "g2"),
            ("a2", "long", "6.0", "g1"),
            ("a1", "long", "7.0", "g1"),
            ("c", "long", "3.0", "g3"),
            ("d", "lat", "8.0", "g1"),
            ("d", "long", "9.0", "g2"),
        ],
    )
    links = quads(spark, [("a1", OWL_SAME_AS, "a2", "l")])
    ruled = Strategy("AVG", SINGLEVALUED, depends_on="lat")
    config = FusionConfig(properties={"lat": ruled, "long": ruled}, unknown_score=0.1)
    result = fuse([rows], links, meta, config)
    assert triples(result) == {
        # The best latitude of a is a2's in g1, so only a2's longitude in g1 counts.
        ("a1", "lat", "5"),
        ("a1", "long", "6"),
        # Without an anchor the property is resolved alone.
        ("c", "long", "3"),
        # The picked pair has no longitude.
        ("d", "lat", "8"),
    }


def test_output_cap_keeps_support_whole(spark):
    result = fuse([literals(spark, INPUT)], config=FusionConfig(max_output=2))
    assert triples(result) == {("a1", "price", "10"), ("a2", "cost", "14")}
    assert as_set(result.support, "s", "g") == {("a1", "g1"), ("a2", "g3")}


def test_canonical_uris_of_a_run_are_preferred_by_the_next(spark, tmp_path):
    path = str(tmp_path / "canonical")
    rows, links = literals(spark, INPUT), quads(spark, LINKS[:1])
    first = fuse([rows], links, config=FusionConfig(preferred=("a2",)), canonical_path=path)
    assert as_list(first.mapping, "uri", "canonical") == [("a1", "a2")]
    second = fuse([rows], links, canonical_path=path)
    assert as_list(second.mapping, "uri", "canonical") == [("a1", "a2")]
    assert as_set(scan_canonical(spark, path), "uri") == {("a2",)}


def test_plain_output(spark, tmp_path):
    result = fuse([literals(spark, INPUT)], config=FusionConfig(data_graph="out"))
    result.write(str(tmp_path / "out"))
    saved = spark.read.parquet(str(tmp_path / "out"))
    assert as_set(saved, "s", "p", "o", "g") == {(*r[:3], "out") for r in INPUT}
    result.write(None)


def test_output_with_quality_and_sources(spark, tmp_path):
    rows = spark.createDataFrame(
        [("s", "p", "iri", "o", None, None, 0.5)],
        "s string, p string, o_kind string, o string, o_dt string, o_lang string, quality double",
    )
    support = spark.createDataFrame(
        [("s", "p", "iri", "o", None, None, g) for g in ("source1", "source2")],
        "s string, p string, o_kind string, o string, o_dt string, o_lang string, g string",
    )
    plain = quads(spark, [("x", "y", "z", "anywhere")])
    saved = sinks.write_with_metadata(rows, support, str(tmp_path / "out"), plain=plain)
    assert as_set(saved, "s", "p", "o", "g") == {
        ("s", "p", "o", "data-1"),
        ("data-1", sinks.QUALITY_PROPERTY, "0.5", "metadata"),
        ("data-1", sinks.SOURCE_PROPERTY, "source1", "metadata"),
        ("data-1", sinks.SOURCE_PROPERTY, "source2", "metadata"),
        ("x", "y", "z", "data"),
    }


@pytest.mark.parametrize("heavy", [False, True])
def test_statement_numbers_are_dense_and_ordered(spark, heavy, request):
    if heavy:
        request.getfixturevalue("everything_heavy")
    rows = literals(spark, [(f"s{i:03}", "p", "v", f"g{j}") for i in range(60) for j in range(i % 3 + 1)])
    result = fuse([rows.repartition(7)], config=FusionConfig(write_metadata=True))
    out = result.quads()
    data = {r["g"]: r["s"] for r in out.where("g LIKE 'data-%'").collect()}
    assert data == {f"data-{i + 1}": f"s{i:03}" for i in range(60)}
    sources = out.where(f"p = '{sinks.SOURCE_PROPERTY}'")
    assert sources.count() == rows.count() and sources.where("s = 'data-3'").count() == 3


def test_result_does_not_depend_on_order_or_partitions(spark, everything_heavy):
    rows = literals(
        spark, [(f"a{i % 5}", f"p{i % 3}", f"{(i * 7) % 11}.{i % 4}", f"g{i % 6}") for i in range(200)]
    )
    config = FusionConfig(
        properties={"p0": Strategy("AVG", SINGLEVALUED), "p1": Strategy("BEST", SINGLEVALUED)}
    )
    columns = [*TRIPLE, "quality", "n_sources"]
    links = quads(spark, [("a0", OWL_SAME_AS, "a1", "l")])
    one = fuse([rows.coalesce(1)], links, config=config).statements
    two = fuse([rows.orderBy("o").repartition(6)], links, config=config).statements
    key = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert key(one) == key(two)
    assert one.where("quality < 0 OR quality > 1").isEmpty()


def test_invalid_prefixes_stop_the_job(spark):
    with pytest.raises(ValueError, match="prefix"):
        fuse([literals(spark, INPUT)], config=FusionConfig(prefixes={"1x": "http://a/"}))


def test_a_linked_type_property_is_found(spark):
    rows = quads(spark, [("x", RDF_TYPE, "k", "g"), ("y", "kind", "k", "g"), ("z", "kind", "other", "g")])
    links = quads(spark, [(RDF_TYPE, OWL_SAME_AS, "kind", "l")])
    for preferred in ((), ("kind",)):
        config = FusionConfig(required_class="k", preferred=preferred)
        assert {s for s, _, _ in triples(fuse([rows], links, config=config))} == {"x", "y"}


def test_anchor_of_the_default_strategy_is_mapped(spark):
    rows = literals(
        spark,
        [("a", "lat", "1", "g1"), ("a", "lat", "2", "g2"), ("a", "name", "x", "g1"), ("a", "name", "y", "g2")],
    )
    links = quads(spark, [("lat", OWL_SAME_AS, "aaa", "l")])
    config = FusionConfig(default=Strategy("ALL", depends_on="lat"))
    assert triples(fuse([rows], links, config=config)) == {("a", "aaa", "1"), ("a", "name", "x")}


def test_hot_resources_are_salted(spark, everything_heavy):
    from quadweld.operators.members import BOUND, bound_rows
    from quadweld.operators.policy import Rules
    from quadweld.operators.stage import heavy_keys, key_hash

    rules = Rules.read(FusionConfig(properties={"p": Strategy(depends_on="lat")}).policy(spark))
    rows = literals(spark, [("hot", "p", str(i), "g") for i in range(40)] + [(f"s{i}", "p", "1", "g") for i in range(40)])
    bound = bound_rows(rows.withColumnRenamed("s", "res"), rules)
    assert heavy_keys(bound, BOUND) == [bound.where("res = 'hot'").select(key_hash(BOUND)).first()[0]]


def test_quads_without_a_graph_get_one(spark):
    rows = literals(spark, [("a", "p", "1", "g1"), ("a", "p", "1", None), ("b", "p", "2", None)])
    result = fuse([rows], config=FusionConfig(default_graph="mine"))
    assert as_set(result.support, "s", "g") == {("a", "g1"), ("a", "mine"), ("b", "mine")}
    declared = fuse([rows], graphs=[["g1", "g2"]])
    assert as_list(declared.with_sources(), "s", "n_sources", "g") == [("a", 1, "g1"), ("b", 1, "g1")]


def test_an_empty_run_replaces_the_one_before(spark, tmp_path):
    path = str(tmp_path / "canonical")
    rows, links = literals(spark, INPUT), quads(spark, LINKS)
    fuse([rows], links, canonical_path=path)
    assert scan_canonical(spark, path).count() == 3
    fuse([rows], canonical_path=path)
    assert scan_canonical(spark, path).count() == 0
    (tmp_path / "plain").write_text("u1\n\n u2 \n")
    assert as_set(scan_canonical(spark, str(tmp_path / "plain")), "uri") == {("u1",), ("u2",)}


def test_nothing_is_left_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stage, "scratch_dir", lambda _: str(tmp_path))
    with fuse([literals(spark, INPUT)], quads(spark, LINKS), config=CONFIG.with_options(write_metadata=True)) as result:
        assert result.quads().count() > 6
        assert list((tmp_path / "quadweld").iterdir())
    assert not list((tmp_path / "quadweld").iterdir())
    with pytest.raises(ValueError, match="unknown resolution function"):
        fuse([literals(spark, INPUT)], config=FusionConfig(default=Strategy("GUESS")))
    assert not list((tmp_path / "quadweld").iterdir())


def test_policy_table_and_plain_triples(spark, tmp_path):
    config = FusionConfig(quality_property="q:ality", source_property="q:source", write_metadata=True)
    policy = FusionConfig(properties={"label": Strategy("BEST", SINGLEVALUED)}).policy(spark)
    result = fuse([literals(spark, INPUT[3:])], quads(spark, LINKS), config=config, policy=policy)
    assert triples(result) == {("b1", "label", "x")}
    result.write(str(tmp_path / "out"), plain=quads(spark, [("x", "y", "z", "anywhere")]))
    saved = spark.read.parquet(str(tmp_path / "out"))
    assert as_set(saved, "p", "g") == {
        ("label", "data-1"), ("q:ality", "metadata"), ("q:source", "metadata"), ("y", "data")
    }


def test_with_default_planning(spark):
    """The plans of production: adaptive execution and generated code."""
    changed = {"spark.sql.adaptive.enabled": "true", "spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        test_whole_job_maps_subjects_and_properties(spark)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_two_runs_at_once_keep_their_tables_apart(spark):
    def run(k):
        rows = quads(spark, [(f"s{k}", "p", "lit", f"v{i}", "g") for i in range(20)])
        with fuse([rows], config=FusionConfig(default=Strategy("BEST"))) as result:
            return result.folder, {r["s"] for r in result.statements.collect()}

    with ThreadPoolExecutor(2) as pool:
        found = list(pool.map(run, range(4)))
    assert [s for _, s in found] == [{f"s{k}"} for k in range(4)]
    assert len({folder for folder, _ in found}) == 4


def test_filters_drop_quads_before_terms_are_mapped(spark, monkeypatch):
    kind = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
    rows = [("a2", kind, "C2", "g"), ("a1", "part", "b2", "g"), ("b1", "p", "lit", "1", "g"), ("a1", "p", "lit", "2", "g")]
    rows += [(f"x{i}", "p", "lit", "3", "g") for i in range(50)] + [("x1", kind, "other", "g")]
    links = quads(spark, [("a1", OWL_SAME_AS, "a2", "l"), ("b1", OWL_SAME_AS, "b2", "l"), ("C1", OWL_SAME_AS, "C2", "l"), ("part", OWL_SAME_AS, "apart", "l")])
    config = FusionConfig(properties={"part": Strategy(NESTED)}, required_class="C1")
    plan = importlib.import_module("quadweld.plans.fuse")
    mapped = []
    plain = plan.to_cluster_rows
    monkeypatch.setattr(plan, "to_cluster_rows", lambda q, m: mapped.append(q.count()) or plain(q, m))
    with fuse([quads(spark, rows)], links, config=config) as result:
        assert {(r["s"], r["o"]) for r in result.statements.collect()} >= {("a1", "2"), ("b1", "1")}
        assert {r["s"] for r in result.statements.collect()} == {"a1", "b1"}
        assert result.loaded == (len(rows),)
    assert mapped == [4]
