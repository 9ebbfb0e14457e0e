"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every word sequence of the test items. The words of a document are
streamed through it; after each word it knows the longest sequence ending there that
also stands in an item. A sequence of ``window`` words or more (or a whole item that is
shorter) makes its words hits, and the states passed name the items.

Items are taken in blocks of at most ``BLOCK_WORDS`` words, one automaton each, so an
automaton has a bounded size, and a task unpacks one at a time; items longer than a block are cut into pieces that overlap by a
window less one word. Documents pass the automata one after another within one task, without a
shuffle. Texts are read whole. A null text or one without words has no hits. Items
without words match nothing; a null item_id is written as an empty string. Repeated
rows are judged alike. Columns of the input other than the asked ones are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quadweld.llm.tables import fresh, parts_of, tidy

WINDOW = 10
#: Words of test items in one automaton.
BLOCK_WORDS = 100_000
#: Words of a passage that is cut out of a text.
LEAST_SPAN = 5

#: Letters, digits and everything beyond ASCII are parts of words; A-Z becomes a-z.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class SuffixAutomaton:
    """All sequences of some items; ``add`` every item, then ``finish``."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.pieces: list[tuple[str, list[int]]] = []
        self.n_words = 0

    def add(self, name: str, words: list[bytes]) -> None:
        ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
        self.pieces.append((name, ids))
        self.n_words += len(ids)
        last = 0
        for w in ids:
            last = self._extend(last, w)

    def _state(self, length: int, link: int, nexts: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(nexts)
        return len(self.next) - 1

    def _split(self, p: int, w: int) -> int:
        """The state for the sequence of ``p`` and ``w``, split off if it stands for longer ones too."""
        q = self.next[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w)
        made = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = made
            p = self.link[p]
        if p >= 0:
            self.link[made] = self._split(p, w)
        return made

    def finish(self) -> SuffixAutomaton:
        """Note at the state of every window which items hold it."""
        self.held: dict[int, set[str]] = {}
        self.whole: dict[int, list[tuple[int, str]]] = {}
        least = self.window
        for name, ids in self.pieces:
            v = 0
            for at, w in enumerate(ids, 1):
                v = self._of_length(self.next[v][w], min(at, self.window))
                if at >= self.window:
                    self.held.setdefault(v, set()).add(name)
            if ids and len(ids) < self.window:
                self.whole.setdefault(v, []).append((len(ids), name))
                least = min(least, len(ids))
        # The nearest state along the links that stands for a whole short item.
        self.short = [-1] * len(self.next)
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.short[v] = v if v in self.whole else self.short[self.link[v]]
        self.least = least
        self.pieces = []
        return self

    def _of_length(self, v: int, n: int) -> int:
        """The state for the last ``n`` words of what ``v`` stands for."""
        while self.length[self.link[v]] >= n:
            v = self.link[v]
        return v

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Disjoint ranges of hit words, in order, and the names of the items found."""
        known = np.fromiter(map(self.vocabulary.get, words, [0] * len(words)), np.int64, len(words))
        # Only stretches of known words, as long as the shortest window, can hold a hit.
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known != 0, [0]))))
        found: list[tuple[int, int]] = []
        names: set[str] = set()
        for first, end in zip(edges[::2], edges[1::2], strict=True):
            if end - first >= self.least:
                self._stream(known[first:end].tolist(), int(first), found, names)
        return merged(found), names

    def _stream(self, ids: list[int], offset: int, found: list, names: set[str]) -> None:
        following, link, length, window = self.next, self.link, self.length, self.window
        v = matched = 0
        # ``near`` follows ``v``, but stands for a window at most: it never has far to go along the links.
        near = 0
        for at, w in enumerate(ids, offset + 1):
            while v and w not in following[v]:
                v = link[v]
                matched = length[v]
            # A shorter match ends in the same words.
            near = near if matched >= window else v
            v = following[v].get(w, 0)
            matched = matched + 1 if v else 0
            near = self._of_length(following[near].get(w, 0), min(matched, window)) if v else 0
            if matched >= window:
                found.append((at - matched, at))
                names |= self.held[near]
            u = self.short[v]
            while u > 0:
                for n, name in self.whole[u]:
                    if n <= matched:
                        found.append((at - n, at))
                        names.add(name)
                u = self.short[link[u]]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(ranges):
        if out and first <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((first, end))
    return out


def automata(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[SuffixAutomaton]:
    """One automaton per block of items; items come to the driver one partition at a time."""
    block = SuffixAutomaton(window)
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.col("text").cast("binary").alias("text")
    )
    for row in items.toLocalIterator():
        words = words_of(bytes(row["text"]) if row["text"] is not None else None)
        for start in range(0, max(1, len(words) - window + 1), block_words):
            piece = words[start : start + block_words + window - 1]
            if block.n_words and block.n_words + len(piece) > block_words:
                yield block.finish()
                block = SuffixAutomaton(window)
            block.add(row["name"], piece)
    yield block.finish()


_FOUND = "n_words long, spans array<struct<first:int,last:int>>, items array<string>"


def match(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Columns ``keep`` and text of ``docs`` with the number of words, hit word ranges (last excluded) and item names.

    These three come last; they are named _n_words, _spans and _items unless ``docs`` has such columns.
    """
    kept = [*dict.fromkeys([*keep, "text"])]
    rows = docs.select(*kept)
    found = StructType.fromDDL(_FOUND)
    added = fresh(kept, *["_" + field.name for field in found])
    for field, name in zip(found, added, strict=True):
        field.name = name
    matched = _matches(docs, benchmark, kept.index("text"), window, block_words)

    def run(batches):
        for part, counts, spans, items in matched(batches):
            spans = [[{"first": a, "last": b} for a, b in ranges] for ranges in spans]
            span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
            made = [pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*kept, *added])

    return rows.mapInArrow(tidy(run), StructType([*rows.schema.fields, *found.fields]))


def _matches(docs: DataFrame, benchmark: DataFrame, at: int, window: int, block_words: int):
    """A function over record batches: parts of them with the number of words, hit ranges and item names of every text.

    A task holds one automaton at a time; of several, each is unpacked for every part.
    """
    context = docs.sparkSession.sparkContext
    blocks = [context.broadcast(pickle.dumps(a)) for a in automata(benchmark, window, block_words)]

    def run(batches):
        only = pickle.loads(blocks[0].value) if len(blocks) == 1 else None
        for part in parts_of(batches, at, *([] if only else [100_000, 32 << 20])):
            words = [words_of(t.as_buffer().to_pybytes() if t.is_valid else None) for t in part.column(at)]
            spans, items = [[] for _ in words], [set() for _ in words]
            for block in blocks:
                matcher = only or pickle.loads(block.value)
                for i, text in enumerate(words):
                    ranges, names = matcher.hits(text)
                    spans[i] = merged(spans[i] + ranges)
                    items[i] |= names
            yield part, [len(w) for w in words], spans, [sorted(x) for x in items]

    return run


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` less the words of ``spans`` and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text)]
    parts, at = [], 0
    for first, last in spans:
        parts.append(text[at : places[first][0]])
        at = places[last - 1][1]
    return b"".join([*parts, text[at:]])


def _n_hit(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"]).cast("long"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, least_span: int = LEAST_SPAN, max_coverage: float = 0.5, window: int = WINDOW
) -> DataFrame:
    """Documents without leaked passages.

    Hit ranges of ``least_span`` words or more are cut out of the text, so whole items of fewer words than a window too, but not
    those of one or two words, which clean texts hold as well; a document with more than ``max_coverage`` of its words hit goes altogether.
    Texts without a cut stay byte for byte, null ones null. Returns the columns of ``docs``, n_chars updated if it exists.
    """
    columns, at = docs.columns, docs.columns.index("text")
    matched = _matches(docs, benchmark, at, window, BLOCK_WORDS)

    def run(batches):
        for part, counts, spans, _ in matched(batches):
            hit = [sum(b - a for a, b in ranges) for ranges in spans]
            stays = [h <= n * max_coverage for h, n in zip(hit, counts, strict=True)]
            texts = part.column(at)
            if any(hit):
                cuts = [[r for r in ranges if r[1] - r[0] >= least_span] for ranges in spans]
                left = [without_spans(t.as_buffer().to_pybytes(), c).decode() if c else t.as_py() for t, c in zip(texts, cuts, strict=True)]
                texts = pa.array(left, pa.string())
            made = [texts if i == at else column for i, column in enumerate(part.columns)]
            yield pa.RecordBatch.from_arrays(made, names=columns).filter(pa.array(stays))

    cleaned = docs.mapInArrow(tidy(run), docs.schema)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in columns else cleaned


def op3_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """What of every document stands in the benchmark."""
    items = F.array_sort("_items")
    hit = _n_hit("_spans")
    return match(docs, benchmark, ["doc_id"]).select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH item AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i:i + 9])) AS win FROM item WHERE len(w) > 0
), doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), lengths AS (
  SELECT DISTINCT len(win) AS n FROM windows
), places AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM doc, lengths WHERE len(w) >= n
), found AS (
  SELECT doc_id, i, n, item_id FROM (SELECT doc_id, i, n, w[i:i + n - 1] AS win FROM places) p JOIN windows USING (win)
), hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM found GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
