"""WARC, main text and URL filters."""

import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from quadweld.llm import html_text, url_filters, warc

BIG = "x" * 150
PAGES = [
    (1, "http://a/1", BIG),
    (5, "u\r\n5", BIG),
    (3, None, BIG),
    (3, "http://a/3", BIG),
    (2, "b", "short"),
    (4, "c", "short"),
    (None, "d", BIG),
    (7, "e", None),
    (6, "", ""),
    (8, "é%0A", "<p>é</p>" * 40),
    (9, "f", BIG + "y"),
    (9, "f", BIG + "y"),
    (10, "long", "lorem ipsum " * 20_000),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, shard int")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return f"file://{tmp_path_factory.mktemp('warc')}"


def test_archive_gives_back_what_was_written(spark, folder):
    where = f"{folder}/{uuid.uuid4().hex}"
    warc.write_archive(pages(spark, PAGES).repartition(3), where)
    got = warc.read_archive(spark, where).collect()
    assert len(got) == len(PAGES)
    html = {p: (h or "").encode() for p, _, h in PAGES}
    for r in got:
        assert r.payload_digest == hashlib.sha256(html[r.page_id]).hexdigest()
        assert r.payload_bytes == len(html[r.page_id])
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == html[r.page_id]
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got)
    revisits = [k for k in kinds if k[1] == "revisit"]
    assert revisits == [("3", "revisit", 1), ("3", "revisit", 1), ("5", "revisit", 1), ("9", "revisit", 9), ("None", "revisit", 1)]
    assert sorted(str(r.url) for r in got) == sorted(str(u) for _, u, _ in PAGES)


def test_the_same_pages_give_the_same_files(spark, folder):
    made = []
    for parts in (1, 4):
        where = f"{folder}/{uuid.uuid4().hex}"
        warc.write_archive(pages(spark, PAGES).repartition(parts), where, roll_bytes=500, min_shards=3)
        made.append(sorted(tuple(r) for r in spark.read.parquet(f"{where}/_manifest").select("name", "records", "bytes", "sha256").collect()))
        store, top = warc.opened(where)
        assert not [f for f in store.get_file_info(warc.fs.FileSelector(top)) if "_temporary-" in f.path]
    assert made[0] == made[1]
    assert len(made[0]) > 3
    # Rolled files are closed at the first record beyond the limit.
    assert all(r[2] < 500 + 3_000 for r in made[0])


def test_shards_are_even_however_the_ids_lie(spark, folder):
    far = [2**63 - 1, -(2**63), None]
    rows = [(k if k % 3 else None, f"u{k}", f"{k} " * (20 + k % 50)) for k in range(1, 400)] + [(k, "far", "far away") for k in far]
    table = pages(spark, rows).withColumn("size", F.octet_length("html").cast("long")).withColumn("digest", F.sha2("html", 256))
    firsts = warc.shard_firsts(table.select("page_id", "digest", "size"), 4_000, 3)
    dealt = table.withColumn("place", warc._place()).withColumn("at", warc._shard(firsts))
    held = [(r.at, r.low, r.high, r.weight) for r in dealt.groupBy("at").agg(F.min("place").alias("low"), F.max("place").alias("high"), F.sum(F.col("size") + warc.HEAD_BYTES).alias("weight")).orderBy("at").collect()]
    assert [h[0] for h in held] == list(range(len(firsts))) and [h[1] for h in held] == firsts
    assert all(a[2] < b[1] for a, b in zip(held, held[1:]))
    weights = sorted(h[3] for h in held)
    assert len(held) > 20 and weights[-1] <= 2 * weights[len(weights) // 2]
    ids = [r.page_id for r in dealt.orderBy("place").collect()]
    assert ids == sorted(ids, key=lambda i: (i is None, i or 0))
    where = f"{folder}/{uuid.uuid4().hex}"
    warc.write_archive(pages(spark, rows), where, shard_bytes=4_000, min_shards=3)
    assert sorted(str(r.url) for r in warc.read_archive(spark, where).collect()) == sorted(r[1] for r in rows)


def test_files_no_manifest_names_are_not_read(spark, folder):
    where = f"{folder}/{uuid.uuid4().hex}"
    warc.write_archive(pages(spark, PAGES[:3]), where)
    store, top = warc.opened(where)
    with store.open_output_stream(f"{top}/_temporary-lost-part-000000-00000.warc.gz") as out:
        out.write(b"half a file")
    assert warc.read_archive(spark, where).count() == 3


def test_a_changed_archive_is_noticed(spark, folder):
    where = f"{folder}/{uuid.uuid4().hex}"
    warc.write_archive(pages(spark, [(1, "u", BIG)]), where)
    store, top = warc.opened(where)
    name = spark.read.parquet(f"{where}/_manifest").first()["name"]
    import zlib

    with store.open_input_stream(f"{top}/{name}", compression=None) as f:
        members = list(warc._members(f))
    with store.open_output_stream(f"{top}/{name}", compression=None) as out:
        for m in members:
            press = zlib.compressobj(6, zlib.DEFLATED, 31)
            out.write(press.compress(m.replace(b"xxx", b"xyx")) + press.flush())
    with pytest.raises(Exception, match="digest differs"):
        warc.read_archive(spark, where).collect()


def test_no_pages_make_an_empty_archive(spark):
    assert warc.op1_warc(pages(spark, [])).count() == 0


@pytest.fixture(scope="module")
def tree(spark):
    return html_text.learn(pages(spark, []))


LONG = "This is a paragraph of the text, and it goes on for quite a while, with commas and a full stop."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        (None, ""),
        (f"<nav><a href=x>Home</a></nav><article><h1>Head</h1><p>{LONG}<p>Two &amp; &lt;b&gt;</article><footer>f</footer>", f"Head\n{LONG}\nTwo & <b>"),
        (f"<div class='cookie-notice'>We use cookies.</div><main><p><b>A\n b</b>  c.<br><p>{LONG}</main>", f"A b c.\n{LONG}"),
        (f"<article><p>{LONG}</p><div class=comments><p>I say {LONG}</p></div></article>", LONG),
        (f"<script>if (a<b) x('</p>')</script><style>p{{}}</style><div id=content><p>{LONG}</p><form><p>Sign up</p></form></div>", LONG),
        (f"<div id=content><p>{LONG}<!-- <p>no</p> --></p></div><aside><p>{LONG}</p></aside>", LONG),
        (f"<article><p>{LONG}</p><script>unclosed", LONG),
    ],
)
def test_main_text(tree, page, text):
    assert html_text.main_texts(tree, [page]) == [text]


@pytest.mark.parametrize(
    "top",
    [
        "<!DOCTYPE html><html><head><title>T</title><meta charset=utf-8><style>p{}</style><body>",
        "<html><head><title>T</title><link rel=x href=y>",
        "<head><script>var a = '<p>';</script></body>",
        "<head><template><p>not this</p></template><title>T</title><body>",
    ],
)
def test_an_open_head_ends_where_the_body_starts(tree, top):
    assert html_text.main_texts(tree, [f"{top}<article><h1>Head</h1><p>{LONG}</article>"]) == [f"Head\n{LONG}"]


def test_text_ends_an_open_head():
    assert html_text.parsed(f"<head><title>T</title> {LONG}")[1] == [LONG]
    assert html_text.parsed(f"<head><title>T</title>{LONG}<b>more</b>")[1] == [f"{LONG}more"]
    assert html_text.parsed("<head><meta name=x> <noscript>n</noscript></head>")[1] == []


def test_whole_pages_of_any_size(spark, tree):
    words = "<p>" + " ".join(["word"] * 200_000) + ".</p>"
    rows = [(1, "u", f"<article>{words}</article>"), (1, "u", f"<article>{words}</article>"), (2, None, None), (None, "v", "")]
    got = html_text.extract(pages(spark, rows), tree).collect()
    assert sorted(len(r.text) for r in got) == [0, 0, 1_000_000, 1_000_000]
    assert html_text.op5_html_text(pages(spark, [])).count() == 0


def test_marginals_are_those_of_all_labelings():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    parent = np.array([-1, 0, 0, 1, 1, 2])
    levels = [np.array([0]), np.array([1, 2]), np.array([3, 4, 5])]
    tree = html_text.Tree(3)
    tree.w, tree.t, x = rng.normal(size=3), rng.normal(size=(2, 2)), rng.normal(size=(6, 3))
    u, total, good = x @ tree.w, 0.0, np.zeros(6)
    for labels in itertools.product((0, 1), repeat=6):
        s = sum(u[i] * (labels[i] - 0.5) for i in range(6)) + sum(tree.t[labels[parent[i]], labels[i]] for i in range(1, 6))
        total += np.exp(s)
        good += np.exp(s) * np.array(labels)
    assert np.allclose(tree.marginals(x, parent, levels)[0], good / total)


def test_rules_and_verdicts(spark):
    urls = [
        "http://a.net/x", "http://NET/", "http://net", "http://inet/x", "https://example.net/en/a?b", "https://m.example.net/en", "//x.net/a",
        "ftp://x.example.com/de/1", "http://example.com/de", "http://w.org/fr/", "http://org/fr/x#y", "http://z.org/", "http://z.org/casino/1",
        "http://net?x/", "http://x.net/en/\nnet/", None, "", "http://a.net/x", "http://xcasino.org/",
    ]
    rows = spark.createDataFrame([(k, u, "h", "t") for k, u in enumerate(urls)], "page_id long, url string, host string, token string")
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in url_filters.op7_url_filters(rows).collect()}
    assert got == {
        0: ("a.net", "net/", "block"), 1: ("net", "net/", "block"), 2: ("net", None, "allow"), 3: ("inet", None, "allow"),
        4: ("example.net", "example.net/en/", "allow"), 5: ("m.example.net", "net/", "block"), 6: ("", None, "allow"),
        7: ("x.example.com", "example.com/de/", "block"), 8: ("example.com", None, "allow"), 9: ("w.org", "org/fr/", "allow"),
        10: ("org", "org/fr/", "allow"), 11: ("z.org", None, "allow"), 12: ("z.org", None, "block"), 13: ("net", None, "allow"),
        14: ("x.net", "net/", "block"), 15: ("", None, "allow"), 16: ("", None, "allow"), 17: ("a.net", "net/", "block"),
        18: ("xcasino.org", None, "allow"),
    }
    assert url_filters.op7_url_filters(rows.limit(0)).count() == 0


def test_rules_are_found_by_their_rarest_token(spark):
    rules = spark.createDataFrame(
        [url_filters.site_rule("block", "example.net/en/").row(), url_filters.Rule("any", "allow", ".", ()).row()],
        url_filters.RULE_SCHEMA,
    )
    tokens = spark.createDataFrame([(t,) for t in ["net"] * 5 + ["example"] * 2 + ["en"] * 3], "token string")
    assert {r.rule: r.token for r in url_filters._indexed(rules, tokens).collect()} == {"example.net/en/": "example", "any": ""}
