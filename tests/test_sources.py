import pytest

from quadweld.sources import canonical
from quadweld.sources.quads import (
    default_graph,
    fill_graph,
    load_stats,
    observe_loaded,
    scan_links,
    scan_metadata,
    scan_quads,
    union_inputs,
)
from quadweld.model import OWL_SAME_AS
from tests.helpers import as_list, as_set, literals, quads


def test_only_declared_graphs_are_read(spark):
    rows = quads(spark, [(f"s{i}", "p", "o", f"g{i}") for i in range(1, 6)])
    declared = spark.createDataFrame([("g1",), ("g3",)], "g string")
    expected = {("s1", "g1"), ("s3", "g3")}
    assert as_set(scan_quads(rows, ["g1", "g3"]), "s", "g") == expected
    assert as_set(scan_quads(rows, declared), "s", "g") == expected
    assert scan_quads(rows, ["g0"]).isEmpty()


def test_declared_graphs_as_a_large_table(spark, everything_heavy):
    rows = quads(spark, [(f"s{i}", "p", "o", f"g{i % 3}") for i in range(60)])
    declared = spark.createDataFrame([("g1",), ("g1",)], "g string")
    assert scan_quads(rows, declared).count() == 20


def test_graph_list_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "q")
    quads(spark, [("s", "p", "o", "g1")]).write.parquet(path)
    plan = scan_quads(spark.read.parquet(path), ["g1", "g2"]).select("s")
    text = plan._jdf.queryExecution().toString()
    assert "PushedFilters: [In(g, [g1,g2])]" in text
    assert "ReadSchema: struct<s:string,g:string>" in text


def test_union_is_a_set_and_skips_absent_inputs(spark):
    one = quads(spark, [("a", "p", "o", "g"), ("a", "p", "o", "g")])
    two = quads(spark, [("a", "p", "o", "g"), ("a", "p", "o", "h")])
    merged = union_inputs(one, None, two)
    assert as_list(merged, "src", "s", "g") == [(1, "a", "g"), (2, "a", "h")]
    with pytest.raises(ValueError):
        union_inputs(None)


def test_blank_nodes_of_two_inputs_stay_apart(spark):
    one = quads(spark, [("_:x", "p", "bnode", "_:y", "g")])
    merged = union_inputs(one, one)
    assert as_set(merged, "s", "o") == {("_:1:x", "_:1:y"), ("_:2:x", "_:2:y")}


def test_null_term_parts_do_not_break_the_set(spark):
    rows = quads(
        spark,
        [
            ("s", "p", "lit", "1", None, None, "g"),
            ("s", "p", "lit", "1", None, None, "g"),
            ("s", "p", "lit", "1", None, "en", "g"),
        ],
    )
    assert union_inputs(rows).count() == 2


def test_links_come_from_every_graph(spark):
    rows = quads(
        spark,
        [
            ("a", OWL_SAME_AS, "b", "g1"),
            ("b", OWL_SAME_AS, "c", "g2"),
            ("c", OWL_SAME_AS, "c", "g2"),
            ("c", OWL_SAME_AS, "lit", "text", "g2"),
            ("c", "other", "d", "g2"),
        ],
    )
    assert as_list(scan_links(rows), "s", "o") == [("a", "b"), ("b", "c")]
    assert as_list(scan_links(rows, ["other"]), "s", "o") == [("c", "d")]


def test_metadata_is_a_set_and_may_be_absent(spark):
    rows = quads(spark, [("a", "p", "b", "g"), ("a", "p", "b", "g"), ("a", "p", "b", "h")])
    assert scan_metadata(rows).count() == 2
    empty = scan_metadata(None, spark)
    assert empty.isEmpty() and empty.columns == rows.columns


def test_default_graph_fills_gaps(spark):
    graphs = spark.createDataFrame([("g2",), ("g1",)], "g string")
    assert default_graph(graphs) == default_graph(["g2", "g1"]) == "g1"
    assert default_graph([]) is None
    rows = quads(spark, [("a", "p", "b", None), ("c", "p", "b", "g9")])
    assert as_list(fill_graph(rows, "g1"), "s", "g") == [("a", "g1"), ("c", "g9")]


def test_load_statistics(spark):
    rows = literals(spark, [("a", "p", "1", "g1"), ("a", "p", "2", "g1"), ("b", "p", "1", "g2")])
    assert as_list(load_stats(rows), "g", "n") == [("g1", 2), ("g2", 1)]
    counted, seen = observe_loaded(rows)
    counted.write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 3


def test_canonical_uris_survive_between_runs(spark, tmp_path):
    path = str(tmp_path / "canonical")
    assert canonical.scan_canonical(spark, None).isEmpty()
    assert canonical.scan_canonical(spark, path).isEmpty()
    mapping = spark.createDataFrame(
        [("u2", "u1"), ("v2", "v1"), ("v3", "v1")], "uri string, canonical string"
    )
    canonical.save_canonical(mapping, path)
    first = canonical.scan_canonical(spark, path)
    assert as_set(first, "uri") == {("u1",), ("v1",)}
    canonical.save_canonical(mapping.where("uri = 'u2'"), path)
    assert as_set(canonical.scan_canonical(spark, path), "uri") == {("u1",)}
    # A plan made before the second run still reads the first.
    assert as_set(first, "uri") == {("u1",), ("v1",)}


def test_nothing_is_written_without_a_path(spark, tmp_path):
    mapping = spark.createDataFrame([("a2", "a1")], "uri string, canonical string")
    canonical.save_canonical(mapping, None)
    assert list(tmp_path.iterdir()) == []


def test_a_plain_text_file_is_read(spark, tmp_path):
    file = tmp_path / "uris.txt"
    file.write_text("http://a\n http://b \n\nhttp://a\n")
    assert as_set(canonical.scan_canonical(spark, str(file)), "uri") == {
        ("http://a",),
        ("http://b",),
    }
