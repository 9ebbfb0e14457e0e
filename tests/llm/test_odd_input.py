"""Very long odd texts: work that grows in proportion to them."""

import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quadweld.llm import decontaminate, html_text, line_quality, tables, toxicity

MILLION = 1_000_000


def seconds(run, *given):
    started = time.process_time()
    run(*given)
    return time.process_time() - started


@pytest.mark.parametrize("text", ["1" * MILLION, "_" * MILLION + "1", "a" * MILLION + " 1", "a." * MILLION, "1_" * MILLION, "@ " * MILLION])
def test_folding_of_odd_texts(text):
    assert seconds(toxicity.fold, text) < 10


@settings(max_examples=300, deadline=None)
@given(st.text("ab1@_ .", max_size=12))
def test_signs_before_or_behind_letters_are_written_out(text):
    mixed = re.compile(
        r"(?=[\w@$]*[^\W\d_])(?=[\w@$]*[0-9@$])[\w@$]*[0-9@$][\w@$]*[^\W\d_]|[^\W\d_][\w@$]*[0-9@$][\w@$]*"
    )
    assert toxicity._SIGNED.sub(toxicity._written_out, text) == mixed.sub(lambda m: m[0].translate(toxicity.DIGITS), text)


def brute_total(lexicon, text):
    padded = " " + " ".join(re.findall(r"[^\W_]+", toxicity.fold(text))) + " "
    covered = [(m.start(), m.start() + len(p) + 2) for p in lexicon.exceptions for m in re.finditer(f"(?= {re.escape(p)} )", padded)]
    total = 0.0
    for term, weight in lexicon.terms.items():
        word = " " + (term[:-1] + " " if term.endswith("$") else term)
        for m in re.finditer(f"(?={re.escape(word)})", padded):
            total += 0 if any(a <= m.start() and m.start() + len(word) <= b for a, b in covered) else weight
    return total


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["pond", "scum", "scums", "soap", "sc", "trash", "can", "x"]), max_size=15))
def test_hits_are_those_of_a_plain_search(words):
    lexicon = toxicity.Lexicon({"scum": 1.0, "scum$": 2.0, "trash": 4.0, "pond$": 8.0})
    assert lexicon.features(lexicon.automaton(), " ".join(words))[0] == brute_total(lexicon, " ".join(words))


def test_many_exception_phrases():
    lexicon = toxicity.Lexicon({"pond": 1.0, "scum$": 2.0})
    assert seconds(lexicon.features, lexicon.automaton(), "pond scum " * 100_000) < 10


N = 100_000


@pytest.mark.parametrize("page", ["<div>" * N + "</x>" * N, "<b>" * N + "<p>" * N, "<b><p>" * N, "<a " * N, '<a "' * N, "<!-- " * N, "<b>x</i>" * N, "<table><tr><td>" * N])
def test_parsing_of_odd_pages(page):
    assert seconds(html_text.parsed, page) < 20


def test_levels_of_a_deep_page():
    nodes, _ = html_text.parsed("<div>" * N + "x")
    assert seconds(html_text.forest, [nodes]) < 10


def test_only_line_breaks_part_words():
    texts = lambda page: html_text.parsed(page)[1]
    assert texts("super<wbr>cali fo<img>o a<br>b <b>bo</b>ld") == ["supercali foo a b bold"]
    assert texts("<p>x<!-- y <p>z") == ["x"] and texts("<p>x > <!-- y") == ["x >"] and texts("<p>x < y <") == ["x < y <"]


def test_items_of_one_repeated_word():
    automaton = decontaminate.SuffixAutomaton()
    automaton.add("a", [b"a"] * N)
    assert seconds(automaton.finish) < 10
    assert seconds(automaton.hits, [b"a"] * MILLION) < 20
    assert automaton.hits([b"a"] * 12 + [b"b"] + [b"a"] * 9)[0] == [(0, 12)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=12), min_size=1, max_size=4), st.text("abc", max_size=40))
def test_hits_for_few_words(items, text):
    automaton = decontaminate.SuffixAutomaton(4)
    for k, item in enumerate(items):
        automaton.add(str(k), [c.encode() for c in item])
    found, names = automaton.finish().hits([c.encode() for c in text])
    hit, expected = set(), set()
    for k, item in enumerate(items):
        for w in {item[i : i + 4] for i in range(max(1, len(item) - 3))}:
            for i in range(len(text) - len(w) + 1):
                if text[i : i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    expected.add(str(k))
    assert {i for a, b in found for i in range(a, b)} == hit and names == expected


def test_short_items_leave_the_texts(spark):
    docs = spark.createDataFrame([(1, "So tell me what is two plus two now, and go on for a while with other words."), (2, "Yes.")], "doc_id long, text string")
    items = spark.createDataFrame([("a", "What is two plus two"), ("b", "yes"), ("c", None)], "item_id string, text string")
    kept = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, items).collect()}
    assert kept == {1: "So tell me  now, and go on for a while with other words."}


def test_many_lines_and_long_ones():
    chain = line_quality.Chain(3 * line_quality.WIDTH + 1)
    chain.w[:] = np.linspace(-1, 1, len(chain.w))
    text = ("one line. \nANOTHER 1 line\n" * 6_000).encode()
    whole, lengths = line_quality.all_lines(text)
    lines = [x for x in text.split(b"\n") if x.split()]
    times = Counter(lines)
    own = np.array([line_quality.line_features(x, times[x]) for x in lines])
    assert (whole[:, : line_quality.WIDTH] == own).all() and (whole[1:, line_quality.WIDTH : 2 * line_quality.WIDTH] == own[:-1]).all()
    assert (whole[:-1, 2 * line_quality.WIDTH : -1] == own[1:]).all() and lengths.tolist() == [len(x) for x in lines]
    some = [text, None, b"", b"x", text[:500], b"\n"]
    together = list(line_quality.qualities(chain, some))
    assert np.allclose(together, [next(line_quality.qualities(chain, [t])) for t in some])
    assert seconds(lambda: list(line_quality.qualities(chain, [b"x\n" * 300_000, b"y " * MILLION]))) < 60


def test_parts_hold_every_row_once():
    texts = ["a" * 10, None, "", "b" * 100, "c"] * 7
    batch = pa.record_batch([pa.array(range(35)), pa.array(texts)], ["n", "t"])
    for rows, size in ((1, 1), (3, 50), (1_000, 1 << 20)):
        parts = list(tables.parts_of([batch, batch.slice(0, 0)], 1, rows, size))
        assert pa.Table.from_batches(parts).column("n").to_pylist() == list(range(35))
        assert all(p.num_rows <= rows for p in parts)
