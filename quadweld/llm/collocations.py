"""Phrases of two to four words that belong together, per language, from a weighted de Bruijn graph.

Every word of a piece starts one record: the next four words, or what is left before the piece ends. Counted records of
four words are the edges of the graph, its nodes are phrases of three words; records of fewer words are the corrections
at the ends of pieces. The count of a shorter phrase is its flow: the sum of all records that begin with it. Nodes
through which all flow goes from one edge to one other are compacted, so that a passage that is repeated as a whole is
one path with one count.

Only phrases of ``min_count`` matter, and no phrase counts more than the words and pairs in it. First passes therefore count
hashes of words, then of pairs of frequent words, then of three words whose pairs are frequent. Pieces end wherever a pair is rare, and
records before a third word that makes three rare; rare words are counted together. The sets of
frequent words, pairs and threes are filters of fixed size: what they let through wrongly costs time, never exactness. All counts are
those of whole records.

Null texts are empty, a null language is ``und``; rows without words give nothing, equal rows count each time, other
columns are ignored. An empty table gives no phrases. Long texts are walked in slices, so memory does not grow with them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadweld.llm.tables import materialize

#: Longest phrase, least count, share of a longer phrase that drops a shorter one, phrases per language.
LONGEST = 4
MIN_COUNT = 30
DROP_SHARE = (80, 100)
FIRST = 2_000
SCALE = 2_000_000

#: Bytes of text whose words are held at once, words whose hashes are kept, hashes that are counted at once, bits of a filter.
SLICE = 4 << 20
KEPT_WORDS = 200_000
HELD_HASHES = 4 << 20
SIEVE_BITS = 1 << 26
#: Bits of a hash that are counted; all but the last 32 of them name its bucket.
HASH_BITS = 44

# All separators become a full stop, which no word can hold.
_SEPARATOR = b"."
_STOPS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", _SEPARATOR * 9)
_GAP = re.compile(rb"[ \t.]")


class _Hashes(dict):
    """Hash of a word, odd; that of the separator is zero."""

    def __missing__(self, word: bytes) -> int:
        value = 0 if word == _SEPARATOR else xxhash.xxh3_64_intdigest(word) | 1
        self[word] = value
        return value


class _Numbers(dict):
    """Numbers from 1 in the order in which words are met; that of the separator is zero."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = 0 if word == _SEPARATOR else len(self) + 1
        return value


def _slices(text: bytes) -> Iterator[tuple[list[bytes], int, bool]]:
    """Words and separators of a text, slice by slice; its bytes; whether it is the last one. Slices end between words."""
    text, at = text.lower().translate(_STOPS), 0
    while True:
        end = at + SLICE
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.start() if gap else len(text)
        yield text[at:end].replace(_SEPARATOR, b" . ").split(), min(end, len(text)) - at, end >= len(text)
        at = end
        if at >= len(text):
            return


def _stretches(batches) -> Iterator[tuple[list[bytes], np.ndarray, list[str]]]:
    """Many words in a row, the index of each one's language (-1: stands there as context only), the languages."""
    words: list[bytes] = []
    marks: list[tuple[int, int]] = []
    langs: dict[str, int] = {}
    size = 0

    def flush():
        index = np.repeat([m[0] for m in marks], [m[1] for m in marks]).astype(np.int64)
        return words, index, list(langs)

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            if not text.is_valid:
                continue
            code = langs.setdefault(lang.as_py(), len(langs))
            carried: list[bytes] = []
            for found, taken, last in _slices(text.as_buffer().to_pybytes()):
                found = carried + found
                context = 0 if last else min(LONGEST - 1, len(found))
                carried = found[len(found) - context :]
                words += found
                words.append(_SEPARATOR)
                marks += [(code, len(found) - context), (-1, context + 1)]
                size += taken
                if size >= SLICE:
                    yield flush()
                    words, marks, langs, size = [], [], {}, 0
                    code = langs.setdefault(lang.as_py(), len(langs))
    if words:
        yield flush()


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Hashed(NamedTuple):
    """Per word of a stretch: its hash in its language, whether it is a word, the hash of it and the next one, whether they are two words."""

    word: np.ndarray
    is_word: np.ndarray
    pair: np.ndarray
    is_pair: np.ndarray


def _hashed(words: list[bytes], index: np.ndarray, langs: list[str], hashes: _Hashes) -> Hashed:
    if len(hashes) > KEPT_WORDS:
        hashes.clear()
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    of_lang = np.array([xxhash.xxh3_64_intdigest(lang.encode()) for lang in langs], np.uint64)
    # Context words belong to the language of the words before them.
    known = np.maximum.accumulate(np.where(index >= 0, np.arange(len(index)), 0))
    word = _mixed(of_lang[np.maximum(index[known], 0)], codes)
    after = np.append(codes[1:], np.uint64(0))
    return Hashed(word, codes != 0, _mixed(word, after), (codes != 0) & (after != 0))


def _places(hashed: np.ndarray) -> Iterator[np.ndarray]:
    """The two bits of a filter that stand for a hash, by the part of it that is counted."""
    counted = hashed & np.uint64((1 << HASH_BITS) - 1)
    yield counted & np.uint64(SIEVE_BITS - 1)
    yield (counted * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32) & np.uint64(SIEVE_BITS - 1)


def _frequent(hashed: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Which hashes a filter lets through: both of their places are set."""
    out = np.ones(len(hashed), bool)
    for bit in _places(hashed):
        out &= (cells[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0
    return out


def _pairs_of_frequent(hashed: Hashed, words: np.ndarray) -> np.ndarray:
    """Where two frequent words follow each other."""
    frequent = hashed.is_word & _frequent(hashed.word, words)
    return hashed.is_pair & frequent & np.append(frequent[1:], False)


def _frequent_pairs(hashed: Hashed, words: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Where a frequent pair begins."""
    return _pairs_of_frequent(hashed, words) & _frequent(hashed.pair, pairs)


def _threes(hashed: Hashed) -> np.ndarray:
    """The hash of each word and the two next ones."""
    return _mixed(hashed.pair, np.append(hashed.pair[1:], np.uint64(0)))


def _chosen(hashed: Hashed, cells: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes to count, and where: of words; with the filter of words, of pairs of frequent words; with that of pairs too, of threes of frequent pairs."""
    if not cells:
        return hashed.word, hashed.is_word
    if len(cells) == 1:
        return hashed.pair, _pairs_of_frequent(hashed, cells[0])
    follows = _frequent_pairs(hashed, *cells)
    return _threes(hashed), follows & np.append(follows[1:], False)


def _count_hashes(min_count: int, *filters):
    """A function that counts hashes, see ``_chosen``.

    A row has the sorted hashes of a bucket, 32 bits each, and their counts. Counts over ``min_count`` are as good as that.
    """
    narrow = np.min_scalar_type(max(1, min_count))

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(held) & np.uint64((1 << HASH_BITS) - 1), return_counts=True)
        of = found >> np.uint64(32)
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1])[: len(of)])
        low, n = found.astype("<u4"), np.minimum(n, max(1, min_count)).astype(narrow)
        columns = [[x.tobytes() for x in np.split(whole, first[1:])] if len(first) else [] for whole in (low, n)]
        arrays = [pa.array(of[first].astype(np.int32)), *[pa.array(c, pa.binary()) for c in columns]]
        return pa.RecordBatch.from_arrays(arrays, ["bucket", "hashes", "counts"])

    def apply(batches) -> Iterator[pa.RecordBatch]:
        hashes, cells = _Hashes(), [np.frombuffer(x.value, np.uint64) for x in filters]
        held, n = [], 0
        for words, index, langs in _stretches(batches):
            found, where = _chosen(_hashed(words, index, langs, hashes), cells)
            held.append(found[where & (index >= 0)])
            n += len(held[-1])
            if n >= HELD_HASHES:
                yield counted(held)
                held, n = [], 0
        if n:
            yield counted(held)

    return apply


def _bits_of_frequent(min_count: int):
    """A function that adds up the counts of a bucket and has the bits of the hashes that occur ``min_count`` times."""
    narrow = np.min_scalar_type(max(1, min_count))

    def apply(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        low, n = (
            np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in rows[name]]) for name, kind in (("hashes", "<u4"), ("counts", narrow))
        )
        order = np.argsort(low, kind="stable")
        low = low[order]
        first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
        frequent = low[first][np.add.reduceat(n[order], first, dtype=np.int64) >= min_count].astype(np.uint64)
        bits = np.concatenate([*_places(frequent | np.uint64(key[0].as_py() << 32))])
        return pa.table({"bit": pa.array(bits.astype(np.int64))})

    return apply


def _filter(docs: DataFrame, min_count: int, *filters):
    """A broadcast filter of the hashes that occur ``min_count`` times; its size is fixed, whatever the corpus holds."""
    counted = docs.mapInArrow(_count_hashes(min_count, *filters), "bucket int, hashes binary, counts binary")
    bits_of_frequent = counted.groupBy("bucket").applyInArrow(_bits_of_frequent(min_count), "bit long")
    # Bits are put together in the tasks: the driver gets a row for each 64 bits of the filter at most.
    cells = (
        bits_of_frequent.groupBy(F.shiftright("bit", 6).alias("cell"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits"))
        .toArrow()
    )
    bits = np.zeros(SIEVE_BITS // 64, np.uint64)
    bits[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy().view(np.uint64)
    return docs.sparkSession.sparkContext.broadcast(bits.tobytes())


def _records(word_filter, pair_filter, three_filter):
    """A function that counts the records of a partition, stretch by stretch."""

    def apply(batches) -> Iterator[pa.RecordBatch]:
        of_words, of_pairs, of_threes = (np.frombuffer(x.value, np.uint64) for x in (word_filter, pair_filter, three_filter))
        hashes = _Hashes()
        for words, index, langs in _stretches(batches):
            hashed = _hashed(words, index, langs, hashes)
            follows = _frequent_pairs(hashed, of_words, of_pairs)
            threes = _frequent(_threes(hashed), of_threes)
            yield from _counted(words, index, langs, follows, _frequent(hashed.word, of_words), threes)

    return apply


def _counted(
    words: list[bytes], index: np.ndarray, langs: list[str], follows: np.ndarray, frequent: np.ndarray, threes: np.ndarray | None = None
) -> Iterator[pa.RecordBatch]:
    """Records of a stretch with their counts, and rare words as records of none. Equal records are found by numbers, not by hashes.

    A record goes on after ``follows``, and to a third or fourth word if the last three are among ``threes`` (none: all are).
    """
    numbers = _Numbers()
    codes = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    started = (index >= 0) & (codes != 0)
    rare = np.bincount(index[started & ~frequent], minlength=len(langs))
    yield _batch([(lang, "", 0, n) for lang, n in zip(langs, rare.tolist(), strict=True) if n])
    at = np.flatnonzero(started & frequent)
    ids = index[at]
    for length in range(1, LONGEST + 1):
        # What is told apart so far, and the next word.
        keys, first, ids = np.unique(ids << 32 | codes[at + length - 1], return_index=True, return_inverse=True)
        goes_on = follows[at + length - 1] if length < LONGEST else np.zeros(len(at), bool)
        if threes is not None and 1 < length < LONGEST:
            goes_on = goes_on & threes[at + length - 2]
        n = np.bincount(ids[~goes_on], minlength=len(keys))
        ending = np.flatnonzero(n)
        starts = at[first[ending]]
        grams = (b" ".join(words[i : i + length]).decode() for i in starts)
        yield _batch([(langs[i], gram, length, c) for i, gram, c in zip(index[starts], grams, n[ending].tolist(), strict=True)])
        at, ids = at[goes_on], ids[goes_on]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    types = (pa.string(), pa.string(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["lang", "gram", "k", "c"])


def records(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """Lang, gram, its number of words k and how many words of the corpus start it; k is 0 for all rare words. Written once."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text"))
    words = _filter(texts, min_count)
    pairs = _filter(texts, min_count, words)
    threes = _filter(texts, min_count, words, pairs)
    counted = texts.mapInArrow(_records(words, pairs, threes), "lang string, gram string, k int, c long")
    written = materialize(counted.groupBy("lang", "gram", "k").agg(F.sum("c").alias("c")), "records")
    for sieve in (words, pairs, threes):
        sieve.destroy()
    return written


def _first(gram: str | Column, words: int | Column) -> Column:
    return F.substring_index(gram, " ", words)


def flows(found: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """Phrases of one to four words with their counts f, those of ``min_count``: records that begin with them, summed.

    Only a record of four words itself begins with a phrase of four.
    """
    whole = found.where(F.col("k") == LONGEST).select("lang", "gram", "k", F.col("c").alias("f"))
    prefixes = F.sequence(F.lit(1), F.least("k", F.lit(LONGEST - 1)))
    begun = found.where("k > 0").select("lang", "gram", "k", "c", F.explode(prefixes).alias("words"))
    summed = (
        begun.select("lang", F.when(F.col("words") == F.col("k"), F.col("gram")).otherwise(F.expr("substring_index(gram, ' ', words)")).alias("gram"), F.col("words").alias("k"), "c")
        .groupBy("lang", "gram", "k")
        .agg(F.sum("c").alias("f"))
    )
    return materialize(summed.unionByName(whole).where(F.col("f") >= min_count), "flows")


def compacted(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths (lang, words, f) of edges between nodes with all flow in one edge and out of one other; the other nodes.

    All edges of a path have one count. A path lies within one piece of a text, which bounds its length; there
    are no rings, since the first node of a piece has less flow in than out.
    """
    edges = counts.where("k = 4").select(
        "lang", "gram", "f", _first("gram", 3).alias("tail"), _first("gram", -3).alias("head")
    )
    nodes = counts.where("k = 3").select("lang", F.col("gram").alias("node"), "f")

    def side(end: str, name: str) -> DataFrame:
        one = edges.groupBy("lang", F.col(end).alias("node")).agg(
            F.count(F.lit(1)).alias("n"), F.max("f").alias("f"), F.max("gram").alias(name)
        )
        return one.where("n = 1").drop("n")

    # The join on f as well: all of the node's flow comes in by one edge and leaves by one.
    inner = materialize(
        nodes.join(side("head", "before"), ["lang", "node", "f"]).join(side("tail", "after"), ["lang", "node", "f"]), "inner"
    )
    reach = materialize(inner.select("lang", F.col("after").alias("gram"), F.col("before").alias("start"), F.lit(1).alias("steps")), "reach")
    # Each round doubles how far an edge looks back.
    while True:
        back = reach.select("lang", F.col("gram").alias("start"), F.col("start").alias("further"), F.col("steps").alias("more"))
        reach = materialize(
            reach.join(back, ["lang", "start"], "left").select(
                "lang",
                "gram",
                F.coalesce("further", "start").alias("start"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "reach",
        )
        if reach.where("moved").isEmpty():
            break
        reach = reach.drop("moved")
    placed = (
        edges.select("lang", "gram", "f")
        .join(reach.select("lang", "gram", "start", "steps"), ["lang", "gram"], "left")
        .select("lang", F.coalesce("start", "gram").alias("start"), F.coalesce("steps", F.lit(0)).alias("steps"), _first("gram", -1).alias("last"), "f")
    )
    steps = F.sort_array(F.collect_list(F.struct("steps", "last")))
    paths = placed.groupBy("lang", "start", "f").agg(steps.alias("along"))
    words = F.concat(F.slice(F.split("start", " "), 1, LONGEST - 1), F.col("along.last"))
    junctions = nodes.join(inner.select("lang", "node"), ["lang", "node"], "left_anti")
    return materialize(paths.select("lang", words.alias("words"), "f"), "paths"), junctions


def _windows(paths: DataFrame, k: int) -> DataFrame:
    """Phrases of k words along the paths."""
    starts = F.sequence(F.lit(1), F.size("words") - (k - 1))
    return paths.select("lang", "f", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("words", i, k), " "))).alias("gram"))


def candidates(counts: DataFrame) -> DataFrame:
    """Phrases (lang, gram, k, a) that no longer one replaces.

    The count of a longer phrase is at most that of what it holds, so those of one word more decide. A node within a path
    counts as its edges do and is always replaced.
    """
    paths, junctions = compacted(counts)
    part, whole = DROP_SHARE
    ends = [F.array_join(F.slice("words", i, 3), " ") for i in (F.lit(1), F.size("words") - 2)]
    around_three = paths.select("lang", "f", F.explode(F.array(*ends)).alias("gram"))
    around_two = junctions.select("lang", "f", F.explode(F.array(_first("node", 2), _first("node", -2))).alias("gram"))

    def left(shorter: DataFrame, longer: DataFrame) -> DataFrame:
        most = longer.groupBy("lang", "gram").agg(F.max("f").alias("most"))
        replaced = F.col("most") * whole >= F.col("a") * part
        return shorter.join(most, ["lang", "gram"], "left").where(~F.coalesce(replaced, F.lit(False))).drop("most")

    four = _windows(paths, 4).select("lang", "gram", F.lit(4).alias("k"), F.col("f").alias("a"))
    three = junctions.select("lang", F.col("node").alias("gram"), F.lit(3).alias("k"), F.col("f").alias("a"))
    two = counts.where("k = 2").select("lang", "gram", "k", F.col("f").alias("a"))
    return four.unionByName(left(three, around_three)).unionByName(left(two, around_two.unionByName(_windows(paths, 2))))


def scored(counts: DataFrame) -> DataFrame:
    """Candidates with the counts l and r and the score of their weakest cut."""
    cut = candidates(counts).select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("at"))
    parts = cut.select(
        "lang",
        "gram",
        "a",
        "at",
        F.expr("substring_index(gram, ' ', at)").alias("first"),
        F.expr("substring_index(gram, ' ', at - k)").alias("rest"),
    )
    known = counts.select("lang", F.col("gram").alias("first"), F.col("f").alias("l"))
    with_first = parts.join(known, ["lang", "first"])
    with_both = with_first.join(known.withColumnsRenamed({"first": "rest", "l": "r"}), ["lang", "rest"])
    # Whole numbers of 38 digits.
    score = F.expr(
        f"(cast(a as decimal(19,0)) * cast({SCALE} as decimal(10,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"
    ).cast("long")
    weakest = F.min(F.struct(score.alias("score"), "at", "l", "r")).alias("cut")
    return with_both.groupBy("lang", F.col("gram").alias("phrase"), "a").agg(weakest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, first: int = FIRST) -> DataFrame:
    """The ``first`` phrases of each language by score, count and bytes: lang, rank, phrase, a, l, r, n, score."""
    found = records(docs, min_count)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(flows(found, min_count)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= first)
    sizes = found.groupBy("lang").agg(F.sum("c").alias("n"))
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(docs: DataFrame) -> DataFrame:
    return collocations(docs)


ORACLE = r"""
WITH pieces AS (
  SELECT COALESCE(lang, 'und') AS lang,
    UNNEST(regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), starts AS (
  SELECT lang, w, UNNEST(range(1, len(w) + 1)) AS i FROM words
), grams AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS gram, count(*) AS f
  FROM starts, (SELECT UNNEST([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)
  GROUP BY ALL HAVING count(*) >= 30
), candidates AS MATERIALIZED (
  SELECT lang, k, gram, string_split(gram, ' ') AS w, f AS a FROM grams WHERE k > 1
), inside AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS gram, max(a) AS most
  FROM (SELECT *, UNNEST(range(1, k + 1)) AS i FROM candidates), (SELECT UNNEST([2, 3]) AS m)
  WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inside n ON n.lang = c.lang AND n.gram = c.gram
  WHERE n.most IS NULL OR 100 * n.most < 80 * c.a
), cuts AS (
  SELECT c.lang, c.gram, c.a, c.cut, l.f AS l, r.f AS r,
    CAST((2000000::HUGEINT * c.a) // (l.f::HUGEINT + r.f) AS BIGINT) AS score
  FROM (SELECT *, UNNEST(range(1, k)) AS cut FROM kept) c
  JOIN grams l ON l.lang = c.lang AND l.gram = array_to_string(c.w[1 : c.cut], ' ')
  JOIN grams r ON r.lang = c.lang AND r.gram = array_to_string(c.w[c.cut + 1 : c.k], ' ')
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, gram) AS rank FROM weakest
), totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang)
SELECT lang, rank, gram AS phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
