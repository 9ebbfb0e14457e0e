"""Substring dedup by recompression.

Rounds name token runs and then, again and again, pairs of neighbours: symbols are
dealt into left and right ones by a hash that changes with the round, and each
left symbol followed by a right one becomes one symbol. A name is a hash of what it names, so
every task gives equal substrings the same names, and a round of naming needs no exchange. With every
symbol goes the stretch of words on which its forming depends; a symbol is interior to a
window of ``WINDOW`` words if that stretch lies within, and equal windows have equal interior symbols.

1. Every window is filed under its longest interior symbol. Neighbouring windows with the same
   one form an occurrence, known by the symbol and a hash of all its words. Windows
   without an interior symbol (inside a run of one word, say) are filed under themselves.
2. Occurrences that share symbol and content repeat: all but the first are removed. Those
   that come again within a batch are settled in the task that made them, so a hot passage sends one
   row per batch; the others are sorted by symbol and read through with constant memory.
3. Symbols that stand in different contents may hide windows that repeat in part: their first
   occurrences alone are compared window by window, in the same way.
4. Documents meet their spans once and lose the words covered.

"First" goes by doc_id, then by start; a null doc_id comes after all others. Rows with the same doc_id
count as the same document: words that start at the same place in two of them don't
remove each other. Spans belong to rows, not to ids: a hash of id and text tells rows of one id apart, and equal
rows share their spans. A span carries the hash of its words and is applied only to texts that have them there. Null,
empty and short texts have no window and stay as they are. Whole texts are read. Other columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from quadweld.llm.tables import fresh, materialize, tidy

WINDOW = 20
#: Pair rounds; with four, some symbol of about six words is interior to nearly every window.
ROUNDS = 4
#: Words handled at once in a task.
CHUNK_WORDS = 300_000

LAST = (1 << 63) - 1
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Odd constants of common 64-bit mixers.
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_INVERSE = np.uint64(pow(int(_A), -1, 1 << 64))
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _B
    x = (x ^ (x >> _U(27))) * _C
    return x ^ (x >> _U(31))


def named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of an ordered pair."""
    return mix(a * _A + mix(b + _A))


class Contents:
    """Hashes of any stretch of words, the same wherever the stretch stands."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        powers, self.back = np.full(n + 1, _A), np.full(n + 1, _INVERSE)
        powers[0] = self.back[0] = 1
        powers, self.back = np.cumprod(powers), np.cumprod(self.back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(words) * powers[:-1], out=self.sums[1:])

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """``last`` is excluded; the length counts."""
        held = (self.sums[last] - self.sums[first]) * self.back[first]
        return named(held, (last - first).astype(np.uint64))


def parse(words: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS):
    """Symbols after all rounds: names, ends (last excluded) and the words that each depends on.

    At the edge of a document a symbol depends on a place outside of it, so no window holds it.
    """
    n = len(words)
    new = np.ones(n, bool)
    new[1:] = (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(new)
    run = np.diff(np.append(start, n))
    name = np.where(run > 1, named(words[start], run.astype(np.uint64)), words[start])
    end, doc = start + run, doc[start]
    # A run ends where another word is seen.
    lo, hi = start - 1, end + 1
    for k in range(1, rounds + 1):
        is_left = (mix(name + _U(k * int(_A) % (1 << 64))) & _U(1)).astype(bool)
        inside = doc[1:] == doc[:-1]
        opens = np.zeros(len(name), bool)
        opens[:-1] = is_left[:-1] & ~is_left[1:] & inside
        closes = np.zeros(len(name), bool)
        closes[1:] = opens[:-1]
        # A right symbol stays single because of what is before it, a left one because of what follows.
        before = np.where(np.append(False, inside), np.append(lo[:1], lo[:-1]), start - 1)
        after = np.where(np.append(inside, False), np.append(hi[1:], hi[-1:]), end + 1)
        lo = np.where(~is_left & ~closes, np.minimum(lo, before), lo)
        hi = np.where(is_left & ~opens, np.maximum(hi, after), hi)
        left = np.flatnonzero(~closes)
        right = np.minimum(left + 1, len(name) - 1)
        pair = opens[left]
        name = np.where(pair, named(name[left], name[right]), name[left])
        end = np.where(pair, end[right], end[left])
        hi = np.where(pair, hi[right], hi[left])
        start, lo, doc = start[left], lo[left], doc[left]
    return name, start, end, lo, hi


def anchors(name, start, end, lo, hi, windows: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """For each window start the number of its longest interior symbol, -1 without any."""
    first = np.searchsorted(lo, windows)
    count = np.searchsorted(hi, windows + width, "right") - first
    some = count > 0
    # Least is best: longest first, then by hash; of equal ones the first.
    rank = (_U(255) - np.minimum(end - start, 255).astype(np.uint64)) << _U(56) | mix(name ^ _A) >> _U(8)
    level = np.zeros(len(windows), np.int64)
    level[some] = np.log2(count[some]).astype(np.int64)
    out = np.full(len(windows), -1, np.int64)
    best = np.arange(len(name))
    for k in range(int(level.max(initial=0)) + 1):
        if k:
            ahead = best[np.minimum(np.arange(len(best)) + (1 << (k - 1)), len(best) - 1)]
            best = np.where(rank[ahead] < rank[best], ahead, best)
        here = np.flatnonzero(some & (level == k))
        a = best[first[here]]
        b = best[first[here] + count[here] - (1 << k)]
        out[here] = np.where(rank[b] < rank[a], b, a)
    return out


class Chunk:
    """Some documents as one sequence of word hashes."""

    def __init__(self, texts: list[list[bytes]], ids: np.ndarray, rows: np.ndarray):
        self.sizes = np.array([len(w) for w in texts], np.int64)
        total = int(self.sizes.sum())
        digest = xxhash.xxh3_64_intdigest
        self.words = np.fromiter((digest(w) for t in texts for w in t), np.uint64, total)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        self.ids, self.rows = ids, rows
        self.contents = Contents(self.words)

    def windows(self, width: int = WINDOW) -> np.ndarray:
        return np.flatnonzero(np.arange(len(self.words)) + width <= self.ends[self.doc])


def occurrences(chunk: Chunk, width: int = WINDOW, rounds: int = ROUNDS):
    """Columns key, content, doc_id, row, place and number of windows less one of all occurrences."""
    windows = chunk.windows(width)
    if not len(windows):
        return [np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64)]
    name, start, end, lo, hi = parse(chunk.words, chunk.doc, rounds)
    anchor = anchors(name, start, end, lo, hi, windows, width)
    new = np.ones(len(windows), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1) | (anchor[1:] < 0)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(windows)) - 1
    s, e = windows[first], windows[last]
    content = chunk.contents.of(s, e + width)
    held = anchor[first]
    key = np.where(held >= 0, name[held], content)
    return [key, content, chunk.ids[chunk.doc[s]], chunk.rows[chunk.doc[s]], s - chunk.starts[chunk.doc[s]], e - s]


def packed(place: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Place and number of windows less one in one number that sorts by place."""
    return place << 8 | more


#: kind 0: to be compared, 1: known to repeat, 2: the first of one of several contents, or at the place of a first.
_ROW = "slot long, key long, content long, doc long, row long, place long, kind long"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def _batch(columns: list[np.ndarray], names: list[str] = _NAMES) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=names)


def settled(key, content, doc, row, place, by_key: bool = True) -> pa.RecordBatch:
    """All but the first of equal occurrences of a batch are known to repeat.

    The slot deals rows out: by key where contents of a key have to meet, else by key and content.
    """
    order = np.lexsort((place, doc, content, key))
    key, content, doc, row, place = key[order], content[order], doc[order], row[order], place[order]
    again = np.zeros(len(key), bool)
    again[1:] = (key[1:] == key[:-1]) & (content[1:] == content[:-1])
    # Of rows at one and the same place none is earlier.
    head = np.flatnonzero(~again)
    group = np.cumsum(~again) - 1
    again &= (doc != doc[head][group]) | (place >> 8 != (place >> 8)[head][group]) if len(key) else again
    together = key if by_key else named(key.view(np.uint64), content.view(np.uint64))
    slot = np.where(again, mix(row.view(np.uint64) ^ place.view(np.uint64)), together.view(np.uint64))
    return _batch([slot, key, content, doc, row, place, again.astype(np.int64)])


def _chunks(column: pa.Array, ids: np.ndarray, rows: np.ndarray):
    """The documents of a batch in chunks of about ``CHUNK_WORDS`` words; one chunk is split into words at a time."""
    texts, size, at = [], 0, 0
    for i, text in enumerate(column.cast(pa.binary())):
        texts.append((text.as_py() or b"").split())
        size += len(texts[-1])
        if size >= CHUNK_WORDS:
            yield Chunk(texts, ids[at : i + 1], rows[at : i + 1])
            texts, size, at = [], 0, i + 1
    if texts:
        yield Chunk(texts, ids[at:], rows[at:])


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)


def _file(batches):
    for batch in batches:
        found = [occurrences(chunk) for chunk in _chunks(batch.column(1), _ids(batch.column(0)), batch.column(2).to_numpy())]
        if found:
            key, content, doc, row, place, more = (np.concatenate(c) for c in zip(*found, strict=True))
            yield settled(key, content, doc, row, packed(place, more))


def _compare(batches):
    """Reads rows sorted by key, content, doc and place; keeps the last first occurrence back."""
    held = None  # key, content, doc, row, place, whether it is known that its key has several contents
    for batch in batches:
        rows = [batch.column(i).to_numpy() for i in range(1, 7)]
        known = rows[5] > 0
        if known.any():
            out = [c[known] for c in rows[:5]]
            yield _batch([np.zeros(len(out[0]), np.int64), *out, np.ones(len(out[0]), np.int64)])
        key, content, doc, row, place = (c[~known] for c in rows[:5])
        if not len(key):
            continue
        several = np.zeros(len(key), bool)
        if held is not None:
            key, content, doc, row, place = (
                np.append(np.array([h], np.int64), c) for h, c in zip(held[:5], (key, content, doc, row, place), strict=True)
            )
            several = np.append(np.array([held[5]]), several)
        new_key = np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        new = new_key.copy()
        new[1:] |= content[1:] != content[:-1]
        head = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        later = ~new & ((doc != doc[head][group]) | (place >> 8 != (place >> 8)[head][group]))
        # A first occurrence has company if the one before or after it has the same key.
        mates = np.zeros(len(head), bool)
        same = ~new_key[head][1:]
        mates[1:] |= same
        mates[:-1] |= same
        mates |= several[head]
        if later.any():
            out = [c[later] for c in (key, content, doc, row, place)]
            yield _batch([np.zeros(len(out[0]), np.int64), *out, np.ones(len(out[0]), np.int64)])
        h = head[-1]
        held = (key[h], content[h], doc[h], row[h], place[h], bool(mates[-1]))
        # Other rows of the same id have the first at the same place; its windows are looked for in them as well.
        give = np.concatenate([head[:-1][mates[:-1]], np.flatnonzero(~new & ~later & (row != row[head][group]))])
        if len(give):
            out = [c[give] for c in (key, content, doc, row, place)]
            yield _batch([np.zeros(len(give), np.int64), *out, np.full(len(give), 2, np.int64)])
    if held is not None and held[5]:
        yield _batch([np.array([x], np.int64) for x in (0, *held[:5], 2)])


def _compared(rows: DataFrame) -> DataFrame:
    spread = rows.repartition("slot").sortWithinPartitions("key", "content", "doc", "place")
    return spread.mapInArrow(tidy(_compare), _ROW).drop("slot")


def _pack(docs: DataFrame) -> DataFrame:
    """``docs`` with compressed texts, so that less goes through the exchange."""
    columns = docs.columns
    at = columns.index("text")
    fields = [StructField("text", BinaryType()) if f.name == "text" else f for f in docs.schema]

    def run(batches):
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            made = list(batch.columns)
            texts = [press(t.as_buffer()) if t.is_valid else None for t in batch.column(at)]
            made[at] = pa.array(texts, pa.binary())
            yield pa.RecordBatch.from_arrays(made, names=columns)

    return docs.mapInArrow(tidy(run), StructType(fields))


def _open(blobs: pa.Array) -> Iterator[bytes | None]:
    """The texts of packed ones, one at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    for blob in blobs:
        packed_text = blob.as_py()
        yield None if packed_text is None else unpack(packed_text)


def _row_key() -> Column:
    """Tells rows of different ids or texts apart, the same wherever it is made."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("doc_id").isNull(), F.col("text"))


def _met(docs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """Documents with all their spans; a row has no more of them than words, as equal rows share theirs."""
    row, held, mine = fresh(docs.columns, "_row", "_spans", "_mine")
    listed = spans.groupBy(F.col("row").alias(row)).agg(F.collect_set(F.struct("place", "content", "key")).alias(held))
    # The text is packed before the exchange; the key to the spans is made of the text itself.
    return _pack(docs.withColumn(mine, _row_key())).join(listed, F.col(mine) == F.col(row), how).drop(mine, row)


def _apply(spans: list[dict], chunk: Chunk, width: int, start: int = 0):
    """Places, last places and contents of the spans that fit the text."""
    place = np.array([s["place"] for s in spans], np.int64)
    first, more = place >> 8, place & 255
    content = np.array([s["content"] for s in spans], np.int64).view(np.uint64)
    last = np.minimum(first + more + width, len(chunk.words))
    fits = (first + more + width <= len(chunk.words)) & (chunk.contents.of(np.minimum(first, last), last) == content)
    return first[fits], more[fits], fits


def _in_part(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Windows of the first occurrences whose symbol stands in other contents too."""
    rows = docs.select("doc_id", "text")
    met = _met(rows.withColumn("row", _row_key()), firsts, "inner")

    def run(batches):
        for batch in batches:
            ids, found = _ids(batch.column(0)), []
            for doc, text, row, listed in zip(ids, _open(batch.column(1)), batch.column(2).to_numpy(), batch.column(3), strict=True):
                spans = listed.as_py()
                chunk = Chunk([text.split() if text else []], np.array([doc]), np.array([row]))
                first, more, fits = _apply(spans, chunk, WINDOW)
                keys = np.array([s["key"] for s in spans], np.int64)[fits]
                each = np.repeat(np.arange(len(first)), more + 1)
                start = first[each] + np.arange(len(each)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
                content = chunk.contents.of(start, start + WINDOW).view(np.int64)
                found.append((keys[each], content, np.full(len(start), doc), np.full(len(start), row), start))
            if found:
                key, content, doc, row, place = (np.concatenate(c) for c in zip(*found, strict=True))
                yield settled(key, content, doc, row, packed(place, np.zeros_like(place)), by_key=False)

    return met.mapInArrow(tidy(run), _ROW)


def repeats(docs: DataFrame) -> DataFrame:
    """Spans of rows whose words stand earlier too: row, place, content, key."""
    compared = materialize(_compared(docs.select("doc_id", "text", _row_key().alias("row")).mapInArrow(tidy(_file), _ROW)), "occurrences")
    partial = _compared(_in_part(docs, compared.where("kind = 2")))
    columns = ["row", "place", "content", "key"]
    return compared.where("kind = 1").select(*columns).unionByName(partial.where("kind = 1").select(*columns))


def covered(text: bytes | None, spans: list[dict] | None, width: int = WINDOW) -> tuple[list[bytes], np.ndarray]:
    """The words and which of them are to go."""
    words = text.split() if text else []
    gone = np.zeros(len(words) + 1, np.int64)
    if spans and words:
        first, more, _ = _apply(spans, Chunk([words], np.zeros(1, np.int64), np.zeros(1, np.int64)), width)
        np.add.at(gone, first, 1)
        np.add.at(gone, first + more + width, -1)
    return words, np.cumsum(gone[:-1]) > 0


def without_repeats(docs: DataFrame) -> DataFrame:
    """Documents less the words of repeated windows; the columns of ``docs``, n_chars updated if it exists.

    A text that loses nothing stays byte for byte. Documents of which nothing is left go.
    """
    columns, at = docs.columns, docs.columns.index("text")
    met = _met(docs, repeats(docs), "left")

    def run(batches):
        for batch in batches:
            texts, kept = [], []
            for i, (text, spans) in enumerate(zip(_open(batch.column(at)), batch.column(len(columns)), strict=True)):
                if spans.is_valid:
                    words, gone = covered(text, spans.as_py())
                    if len(words) and gone.all():
                        continue
                    if gone.any():
                        text = _cut(text, gone)
                kept.append(i)
                texts.append(text)
            made = [batch.column(i).take(pa.array(kept, pa.int64())) for i in range(len(columns))]
            made[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(made, names=columns)

    cleaned = met.mapInArrow(tidy(run), docs.schema)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in columns else cleaned


def _cut(text: bytes, gone: np.ndarray) -> bytes:
    """``text`` less stretches of lost words and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
    parts, at = [], 0
    for first, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        parts.append(text[at : places[first][0]])
        at = places[end - 1][1]
    return b"".join([*parts, text[at:]]).strip()


def op10_recompression(docs: DataFrame) -> DataFrame:
    """What is left of every document: numbers of words and a digest of the kept ones."""
    rows = docs.select("doc_id", "text")
    met = _met(rows, repeats(rows), "left")
    schema = StructType(
        [
            rows.schema["doc_id"],
            StructField("n_words", LongType()),
            StructField("n_removed", LongType()),
            StructField("kept_sha256", StringType()),
        ]
    )

    def run(batches):
        for batch in batches:
            counts, removed, digests = [], [], []
            for text, spans in zip(_open(batch.column(1)), batch.column(2), strict=True):
                words, gone = covered(text, spans.as_py())
                counts.append(len(words))
                removed.append(int(gone.sum()))
                kept = [w for w, lost in zip(words, gone.tolist(), strict=True) if not lost] if removed[-1] else words
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            made = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=schema.names)

    return met.mapInArrow(tidy(run), schema)
