"""Packing documents into sequences of 4,096 tokens: cutting stock by column generation.

Whole sequences are cut off a document from its start; what is left, its rest, has 1 to 4,095 tokens. Rests are counted by
length classes of ``STEP`` tokens. Patterns (how many rests of which classes share a sequence) come from a linear
program over that histogram: a knapsack by dynamic programming prices new patterns until none lowers the number of sequences.
Counts of patterns are rounded down, and the ranked rests of each class are dealt out to the places of its patterns.

What rounding leaves over, and as many further rests as are needed, form one long row of tokens that is cut to fill the gaps of the
patterns exactly; the end of that row makes whole sequences and sequences of powers of two. Hence hardly any
padding, and only rests in that row are cut.

The program has one row for each class, 256 at most, so it is solved on the driver whatever the corpus holds; if it is stopped
after ``ROUNDS`` patterns, sequences are filled less well before the gaps are. Everything else are joins on row numbers.

A null or empty text has one token, the end mark. Equal rows and repeated or null ids are packed each for itself; other
columns are ignored; an empty table has no pieces. A text is held by the task that tokenises it, word by word, and
only its rest is kept as tokens.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quadweld.llm.tables import materialize
from quadweld.operators.running import number_rows, running_totals

#: Tokens of a sequence, id at the end of a document.
LENGTH = 4096
END = 2
TOKENIZER = "word_bpe_49k.json"

#: Tokens of a length class; most patterns that are tried; words and pieces whose tokens are kept; tokens of a stretch of the row of cut rests.
STEP = 16
ROUNDS = 4_000
KEPT_WORDS, KEPT_PIECES = 100_000, 400_000
STRETCH = 4 * LENGTH
_ENOUGH = 1e-7


# ---- tokens -------------------------------------------------------------------------------------


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Recent(dict):
    """Values by key. ``turn`` forgets what was not asked for while the last ``most`` keys came in."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key: bytes | str) -> bytes:
        value = self.before.get(key)
        self[key] = value = self.make(key) if value is None else value
        return value

    def turn(self) -> None:
        if len(self) > self.most:
            self.before = dict(self)
            self.clear()


class _Words:
    """Tokens of words as bytes.

    The tokenizer never joins what white space parts, nor letters with other signs, nor two digits; so the tokens of a
    text are those of its words, and those of a word are those of such pieces, of which a corpus has far fewer. A stretch
    of ASCII and western letters is split into pieces at once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces, self.words = _Recent(self._encoded, KEPT_PIECES), _Recent(self._joined, KEPT_WORDS)

    def _encoded(self, piece: str) -> bytes:
        if _SMALL_LETTERS.fullmatch(piece):
            # Small letters are what the tokenizer's own normalising and splitting would leave; only its merges are needed.
            ids = [token.id for token in self.tokenizer.model.tokenize(piece if piece.isascii() else piece.translate(_AS_BYTES))]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def of(self, stretch: bytes) -> bytes:
        text = stretch.decode()
        if _WESTERN.fullmatch(text):
            return b"".join(map(self.pieces.__getitem__, _PIECE_OF_TEXT.findall(text.lower())))
        return b"".join(map(self.words.__getitem__, stretch.split()))

    def _joined(self, word: bytes) -> bytes:
        text = word.decode()
        if _WESTERN.fullmatch(text):
            return b"".join(map(self.pieces.__getitem__, _PIECE_OF_TEXT.findall(text.lower())))
        # Beyond that the tokenizer tells letters; only signs behind a letter are taken off here.
        core = text.rstrip(_SIGNS)
        if len(core) < len(text) and core[-1:].lower()[-1:].isalpha():
            return self.pieces[core] + self.pieces[text[len(core) :]]
        return self.pieces[text]

    def turn(self) -> None:
        self.pieces.turn()
        self.words.turn()


@lru_cache(maxsize=1)
def _words(path: str) -> _Words:
    return _Words(path)


#: Text of ASCII and the letters from U+00C0 to U+00FF, which composing leaves as they are; small letters; the pieces that the
#: tokenizer's own rule makes of such text in lower case, contractions first; signs of ASCII.
_WESTERN = re.compile(r"[\x00-\x7F\xC0-\xD6\xD8-\xF6\xF8-\xFF]*")
_SMALL_LETTERS = re.compile(r"[a-z\xDF-\xF6\xF8-\xFF]+")
_PIECE_OF_TEXT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xDF-\xF6\xF8-\xFF]+|[0-9]|[^ \t-\ra-z0-9\xDF-\xF6\xF8-\xFF]+")
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_signs() -> dict[int, str]:
    """Letters from U+00C0 to U+00FF as the tokenizer's model has them: a sign for each of their bytes, those that cannot be printed from U+0100 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    signs = {b: chr(b) for b in printed} | {b: chr(0x100 + i) for i, b in enumerate(b for b in range(0x100) if b not in printed)}
    return {c: "".join(signs[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


_AS_BYTES = _byte_signs()
_REST_OF_WORD = re.compile(rb"[^ \t-\r]*")


def tokens(text: bytes, words: _Words, at_once: int = 1 << 20) -> np.ndarray:
    """Ids of a text and the end mark; a stretch of the text at a time is split into words or pieces."""
    parts, at = [], 0
    while at < len(text):
        end = _REST_OF_WORD.match(text, min(at + at_once, len(text))).end()
        parts.append(words.of(text[at:end]))
        at = end
        words.turn()
    parts.append(np.array([END], "<u4").tobytes())
    return np.frombuffer(b"".join(parts), "<u4")


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").data)


def _tokenised(path: str, schema: pa.Schema):
    """A function that counts tokens, and has the checksums of whole sequences and of the rest, and the rest's ids."""

    def apply(batches) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        for batch in batches:
            n, crcs, rests = [], [], []
            for text in batch.column(1):
                ids = tokens(text.as_buffer().to_pybytes() if text.is_valid else b"", words)
                n.append(len(ids))
                crcs.append([_crc(ids[at : at + LENGTH]) for at in range(0, len(ids), LENGTH)])
                rest = ids[len(ids) - len(ids) % LENGTH :]
                # Two bytes are enough for most vocabularies.
                rests.append((rest.astype("<u2") if rest.max(initial=0) < 1 << 16 else rest).tobytes())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(rests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return apply


def tokenised(docs: DataFrame, path: str) -> DataFrame:
    """Doc_id, its tokens ``n``, ``crcs`` of its pieces of 4,096 ids, ids of its ``rest`` and a row number ``uid``; written once."""
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL("n long, crcs array<long>, rest binary").fields])
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_tokenised(path, to_arrow_schema(schema)), schema)
    return materialize(found.withColumn("uid", F.monotonically_increasing_id()), "tokens")


# ---- patterns -----------------------------------------------------------------------------------


def priced(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: knapsack with any number of each class, by dynamic programming over the capacity."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fit = int(np.searchsorted(sizes, room, side="right"))
        worth = best[room - sizes[:fit]] + values[:fit]
        best[room], took[room] = best[room - 1], -1
        if fit and worth[k := int(worth.argmax())] > best[room]:
            best[room], took[room] = worth[k], k
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            pattern[took[room]] += 1
            room -= int(sizes[took[room]])
    return float(best[capacity]), pattern


def patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one a column) and how often each is used at best, fractions included, so that demands are met exactly.

    Revised simplex method: the basis starts with patterns of one class each; the duals of the demands price new patterns.
    """
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / (capacity // sizes))
    for k in range(rounds):
        duals = inverse.sum(axis=0)
        value, pattern = priced(duals, sizes, capacity)
        if value <= 1 + _ENOUGH:
            break
        used, move = inverse @ demand, inverse @ pattern
        ratios = np.divide(used, move, out=np.full(m, np.inf), where=move > _ENOUGH)
        leaving = int(ratios.argmin())
        basis[:, leaving] = pattern
        row = inverse[leaving] / move[leaving]
        inverse -= np.outer(move, row)
        inverse[leaving] = row
        if k % 64 == 63:
            inverse = np.linalg.inv(basis)
    return basis.astype(np.int64), np.maximum(inverse @ demand, 0.0)


class Plan(NamedTuple):
    """Stretches of the ranked rests: those from ``first`` on go to sequences from ``sequence`` on, ``each`` to a sequence
    (0: into the row that is cut). ``sequences``: how many the patterns make."""

    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    sequences: int


def planned(sizes: np.ndarray, demand: np.ndarray, held: np.ndarray, length: int = LENGTH, step: int = STEP, rounds: int = ROUNDS) -> Plan:
    """Patterns for classes of ``sizes`` steps, ``demand`` rests and ``held`` tokens each, ranks counted from 0 class by class."""
    nothing = np.zeros(0, np.int64)
    if not len(sizes):
        return Plan(nothing, nothing, nothing, 0)
    columns, uses = patterns(sizes, demand.astype(float), length // step, rounds)
    mean = held / demand
    filled = mean @ columns
    # The row that is cut must fill all gaps; patterns are given up for it evenly.
    counts = np.floor(uses + _ENOUGH)
    for _ in range(8):
        gaps = (length - filled) @ counts
        row = held.sum() - filled @ counts
        if row >= gaps or not counts.any():
            break
        share = 1.02 * (gaps - row) / (length * counts.sum())
        counts = np.floor(counts * (1 - min(1.0, share)))
    counts = np.minimum(counts, uses + _ENOUGH).astype(np.int64)
    # Rounding may not promise more rests than there are.
    bases = np.cumsum(counts) - counts
    first, sequence, each, rank = [], [], [], 0
    for c in range(len(sizes)):
        left = int(demand[c])
        for j in np.flatnonzero((columns[c] > 0) & (counts > 0)):
            n = min(left, int(counts[j] * columns[c, j]))
            first.append(rank + int(demand[c]) - left)
            sequence.append(int(bases[j]))
            each.append(int(columns[c, j]))
            left -= n
        if left:
            first.append(rank + int(demand[c]) - left)
            sequence.append(-1)
            each.append(0)
        rank += int(demand[c])
    # Stretches without rests share their first rank with the next one.
    keep = np.append(np.diff(first) > 0, True)
    pick = lambda x: np.array(x, np.int64)[keep]
    return Plan(pick(first), pick(sequence), pick(each), int(counts.sum()))


def _dealt(plan: Plan):
    """A function that gives each ranked rest its sequence, null if it is to be cut."""

    def apply(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            at = np.searchsorted(plan.first, rank, side="right") - 1
            each = plan.each[at]
            sequence = plan.sequence[at] + (rank - plan.first[at]) // np.maximum(each, 1)
            yield batch.append_column("sequence_id", pa.array(sequence, pa.int64(), mask=each == 0))

    return apply


# ---- sequences ----------------------------------------------------------------------------------


def _totals(df: DataFrame, order: list[str], column: str, out: str) -> DataFrame:
    """Running total of ``column`` over all rows, before each row, as a long."""
    summed = running_totals(df.withColumn("all", F.lit(0)), ["all"], order, {out: column}, {})
    return summed.withColumn(out, (F.col(out) - F.col(column)).cast("long")).drop("all")


def _power_of_two(column: Column) -> Column:
    return column.bitwiseAND(column - 1) == 0


def _gaps(spark, placed: DataFrame, first: int) -> tuple[DataFrame, int]:
    """Rooms (sequence_id, room, used, begin) along the row of cut rests: the gaps of the patterns; how many tokens they hold."""
    used = placed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    open_ = used.where((F.col("used") < LENGTH) & ~_power_of_two(F.col("used"))).withColumn("room", LENGTH - F.col("used"))
    found = materialize(_totals(open_, ["sequence_id"], "room", "begin"), "gaps").select("sequence_id", "used", "room", "begin")
    return found, found.agg(F.coalesce(F.sum("room"), F.lit(0))).first()[0]


def _end_rooms(spark, begin: int, end: int, first: int) -> DataFrame:
    """New sequences for the row from ``begin`` to ``end``: whole ones, then one for each power of two of what is left."""
    whole, left = divmod(max(0, end - begin), LENGTH)
    full = spark.range(whole).select(
        (F.col("id") + first).alias("sequence_id"),
        F.lit(0).cast("long").alias("used"),
        F.lit(LENGTH).cast("long").alias("room"),
        (F.col("id") * LENGTH + begin).alias("begin"),
    )
    rows, at = [], begin + whole * LENGTH
    for bit in reversed(range(LENGTH.bit_length())):
        if left >> bit & 1:
            rows.append((first + whole + len(rows), 0, 1 << bit, at))
            at += 1 << bit
    return full.unionByName(spark.createDataFrame(rows, "sequence_id long, used long, room long, begin long"))


def _cut(rests: DataFrame, rooms: DataFrame) -> DataFrame:
    """Pieces of the rests in the row: each stretch of the row that lies in one rest and in one room.

    Starts of rests and rooms are sorted within stretches of fixed length, so no rest meets more than what begins there.
    """

    def points(df: DataFrame, size: str, name: str, columns: list[str]) -> DataFrame:
        stretches = F.sequence(F.expr(f"begin div {STRETCH}"), F.expr(f"(begin + {size} - 1) div {STRETCH}"))
        what = F.struct(F.col("begin"), F.col(size).alias("size"), *columns).alias(name)
        spread = df.select(what, F.explode(stretches).alias("stretch"))
        return spread.withColumn("at", F.greatest(F.col(f"{name}.begin"), F.col("stretch") * STRETCH))

    both = points(rests, "length", "rest", ["uid", "start"]).unionByName(
        points(rooms, "room", "room", ["sequence_id", "used"]), allowMissingColumns=True
    )
    along = Window.partitionBy("stretch").orderBy("at")
    held = both.select(
        "at",
        F.last("rest", ignorenulls=True).over(along).alias("rest"),
        F.last("room", ignorenulls=True).over(along).alias("room"),
        F.coalesce(F.lead("at").over(along), (F.col("stretch") + 1) * STRETCH).alias("next"),
    )
    end = F.least("next", F.col("rest.begin") + F.col("rest.size"), F.col("room.begin") + F.col("room.size"))
    pieces = held.withColumn("length", end - F.col("at")).where("length > 0")
    # A rest and a room share one stretch of the row; borders between stretches may have split it.
    return (
        pieces.groupBy("rest.uid", "room.sequence_id")
        .agg(
            F.min(F.col("rest.start") + F.col("at") - F.col("rest.begin")).alias("start"),
            F.min(F.col("room.used") + F.col("at") - F.col("room.begin")).alias("offset"),
            F.sum("length").alias("length"),
        )
        .select("uid", "sequence_id", "start", "offset", "length")
    )


def _checksums(schema: pa.Schema):
    """A function that has the checksums of the pieces of each rest."""

    def apply(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, whole, rest, cuts = (batch.column(i) for i in range(4))
            out = []
            for i in range(batch.num_rows):
                raw, n = rest[i].as_py(), whole[i].as_py() % LENGTH
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                for cut in cuts[i].as_py():
                    begin = cut["start"] - (whole[i].as_py() - n)
                    out.append({"uid": uid[i].as_py(), **cut, "ids_crc32": _crc(ids[begin : begin + cut["length"]])})
            yield pa.RecordBatch.from_pylist(out, schema)

    return apply


_PIECE = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: doc_id, uid (a number for the document's row), start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    found = tokenised(docs, path or tokenizer_path())
    rest = F.col("n") % LENGTH
    rests = found.where(rest > 0).select(
        "uid",
        "doc_id",
        "n",
        rest.alias("length"),
        F.ceil(rest / STEP).cast("int").alias("size"),
        F.element_at("crcs", -1).alias("ids_crc32"),
    )
    classes = rests.groupBy("size").agg(F.count(F.lit(1)).alias("demand"), F.sum("length").alias("held")).orderBy("size").toPandas()
    plan = planned(*(classes[c].to_numpy(np.int64) for c in ("size", "demand", "held")), rounds=rounds)

    by_digest = rests.withColumn("digest", F.xxhash64("doc_id", "n", "ids_crc32"))
    ranked = number_rows(by_digest, ["size", "digest", "uid"], "rank").withColumn("rank", F.col("rank") - 1).drop("digest")
    schema = StructType([*ranked.schema.fields]).add("sequence_id", "long")
    dealt = materialize(ranked.mapInArrow(_dealt(plan), schema), "dealt")

    # A sequence holds 4,096 pieces at most.
    along = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "rank")
    placed = dealt.where("sequence_id IS NOT NULL").withColumn("offset", F.sum("length").over(along) - F.col("length"))
    start = (F.col("n") - F.col("length")).alias("start")
    uncut = placed.select("doc_id", "uid", start, "length", "ids_crc32", F.col("n").alias("doc_tokens"), "sequence_id", "offset")

    row = _totals(dealt.where("sequence_id IS NULL").select("rank", "uid", start, "length"), ["rank"], "length", "begin")
    row = materialize(row, "row")
    in_row = row.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    gaps, in_gaps = _gaps(spark, placed, plan.sequences)
    ends = _end_rooms(spark, in_gaps, in_row, plan.sequences)
    last = plan.sequences + ends.count()
    cuts = _cut(row, gaps.unionByName(ends))
    by_rest = cuts.groupBy("uid").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("cuts"))
    with_ids = found.select("uid", "n", "rest").join(by_rest, "uid")
    piece = StructType.fromDDL("uid long, start long, length long, sequence_id long, offset long, ids_crc32 long")
    cut_pieces = with_ids.mapInArrow(_checksums(to_arrow_schema(piece)), piece)
    cut_rests = cut_pieces.join(found.select("uid", "doc_id", F.col("n").alias("doc_tokens")), "uid")

    # Whole sequences, numbered after all others.
    long = found.where(F.col("n") >= LENGTH).select("uid", "doc_id", "n", "crcs", F.expr(f"n div {LENGTH}").alias("whole"))
    full = _totals(long, ["uid"], "whole", "before").select(
        "doc_id", "uid", "n", "before", F.posexplode(F.slice("crcs", F.lit(1), F.col("whole").cast("int"))).alias("nth", "ids_crc32")
    )
    whole = full.select(
        "doc_id",
        "uid",
        (F.col("nth").cast("long") * LENGTH).alias("start"),
        F.lit(LENGTH).cast("long").alias("length"),
        "ids_crc32",
        F.col("n").alias("doc_tokens"),
        (F.col("before") + F.col("nth") + last).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return uncut.unionByName(cut_rests.select(*uncut.columns)).unionByName(whole)


def op11_packing(docs: DataFrame) -> DataFrame:
    return pack(docs).select("doc_id", *_PIECE)
