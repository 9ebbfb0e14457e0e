"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are compared tile against tile with numpy: exclusive-or, bit counts, and no
look at pairs of tiles whose population counts differ by more than the radius. Equal
fingerprints are one. So that the work does not grow with the square of the corpus, tiles are
cut inside cells: 64 bits fall into ``blocks`` blocks, and fingerprints that differ in
at most ``radius`` bits agree in at least ``blocks - radius`` of them, so every such pair
meets in a cell of fingerprints that share those blocks. No link is lost. The number of blocks
follows from the number of fingerprints and changes the plan only. Cells of more than
``TILE`` fingerprints are dealt into tiles by population count and a salt, and pairs of tiles become
units of work of their own.

Each unit emits links along a spanning forest, at most one a fingerprint; components
are then found by relinking rounds over written tables.

A null text or one without words has fingerprint zero and links like any other. Rows with a null
doc_id get a fingerprint; the component_id ignores them unless a component has no other.
Repeated rows come back as often as they came in. Other columns are ignored.

``deduplicate`` has a measure of its own: texts are linked whose sets of five-word shingles have a Jaccard
similarity of 0.8 or more. Fingerprints of 256 bits tell such texts apart; they differ in about 39 bits at 0.8, and the radius is ``WIDE_RADIUS``.
For it cells of shared bits would hold nearly everything, so the cells are bands of minima of the same shingle hashes:
a pair of similarity 0.8 shares none of the bands with a chance of 6e-5. In each cell, tile against tile, a least spanning
forest by the number of differing bits is grown, and its links, fewer than fingerprints in the cell, are checked on the texts.
That joins large groups without a look at all their pairs, but bits are no measure of the similarity: a pair can lie beyond the radius, meet in no band,
or hang on a link that the check refuses. An exact pass follows, over texts that are not yet joined. Under any order of the shingles two texts of
similarity 0.8 share one of the first fifth of theirs, so the cells are those shingles, frequent ones last. Pairs in a cell are judged by
their sizes, by the places of the shingle, and by parities of the shingles in 512 classes, which differ in no more classes than the sets differ in shingles;
what that leaves, by parities in as many classes as the texts need.
These bounds refuse no pair of the similarity; what they leave is checked on the texts. The components are those of both passes.
Texts are told apart by 64 bits of a digest of their words.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from quadweld.llm.tables import fresh, materialize, maybe_broadcast, parts_of, tidy
from quadweld.operators.identity import star_forest
from quadweld.operators.stage import BROADCAST_ROWS, heavy_keys, lookup

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Fingerprints in a tile, and the side of a block of comparisons within it.
TILE, SIDE = 2_048, 1_024
#: Shingles counted at once.
CHUNK = 1 << 16
#: Near duplicates of the pipeline: words of a shingle and least Jaccard similarity, as a fraction.
NEAR_SHINGLE, NEAR = 5, (4, 5)
#: Bands of that many minima each.
BANDS, DEPTH = 32, 6
#: 64-bit words of a wide fingerprint, most differing bits of a candidate pair, fingerprints in a tile of a band.
WIDE, WIDE_RADIUS, WIDE_TILE = 4, 56, 1_024
#: Texts of the sample that shows which shingles are frequent, in how many of them such a shingle stands, and most of such shingles.
SAMPLE, OFTEN, MOST = 20_000, 5, 100_000
#: Classes of shingles whose parities are kept, as a power of two; pairs judged at once.
PARITY_BITS, PAIRS = 9, 1 << 19

_SHIFTS = np.arange(8, dtype=np.uint64)
_LOW_BITS = np.uint64(0x0101010101010101)


def _joined(text: bytes | None) -> bytes:
    return b" ".join(text.lower().split()) if text else b""


def _shingles(joined: bytes, width: int) -> np.ndarray:
    """Hashes of the word shingles, repeats included; of all words if they are fewer than a shingle has."""
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32).tolist()
    starts, ends = [0, *[s + 1 for s in spaces]], [*spaces, len(joined)]
    digest = xxhash.xxh64_intdigest
    if len(starts) < width:
        return np.array([digest(joined, SEED)], np.uint64)
    pairs = zip(starts, ends[width - 1 :], strict=False)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64, len(starts) - width + 1)


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """SimHash of the word shingles, repeats included; zero without words."""
    joined = _joined(text)
    if not joined:
        return 0
    hashes = _shingles(joined, width)
    return int(_majority(hashes))


def _majority(hashes: np.ndarray) -> np.uint64:
    """The bits that are set in over half the hashes."""
    counts = np.zeros((8, 8), np.int64)
    for at in range(0, len(hashes), CHUNK):
        # Eight byte-wide counters in a word hold up to 255 each.
        lanes = (hashes[at : at + CHUNK, None] >> _SHIFTS) & _LOW_BITS
        sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        counts += sums.astype("<u8").view(np.uint8).reshape(-1, 8, 8).sum(axis=0, dtype=np.int64)
    # counts[k, j] belongs to bit 8 j + k.
    bits = (2 * counts.T.reshape(-1) > len(hashes)).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view("<u8")[0]


def wide_fingerprint(hashes: np.ndarray) -> list[int]:
    """SimHash of a set of shingle hashes in ``WIDE`` signed words, each from other bits of theirs."""
    words = []
    for k in range(1, WIDE + 1):
        x = hashes * np.uint64(0x9E3779B97F4A7C15 + 2 * k) + np.uint64(k)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        words.append(int(_majority(x ^ (x >> np.uint64(27))).view(np.int64)))
    return words


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of every row."""
    rows = docs.select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in parts_of(batches, 1):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "fp"])

    return rows.mapInArrow(tidy(run), f"doc_id {id_type}, fp long")


def cell_masks(n: int, radius: int = RADIUS, bits: int = 64) -> list[int]:
    """Masks of the bits that the fingerprints of a cell share, for about ``n`` fingerprints."""

    def cost(blocks: int) -> float:
        shared = bits * (blocks - radius) // blocks
        # A row costs about as much as some hundred comparisons.
        return comb(blocks, radius) * (200 + n / 2**shared)

    blocks = min(range(radius + 1, radius + 6), key=cost)
    edges = [bits * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def units(nodes: DataFrame, n: int, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Units of comparison: ``own`` fingerprints of a tile and the ``other`` tile's, if it is another."""
    masks = F.array(*[F.lit(_signed(m)) for m in cell_masks(n, radius)])
    keyed = nodes.select(
        "fp", F.bit_count("fp").cast("int").alias("pop"), F.posexplode(masks).alias("k", "mask")
    ).select("fp", "pop", "k", F.col("fp").bitwiseAND(F.col("mask")).alias("cell"))
    counts = keyed.groupBy("k", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keyed = keyed.join(counts, ["k", "cell"])
    small = keyed.where(F.col("n") <= tile).select(
        "k", "cell", "fp", F.lit("").alias("a"), F.lit("").alias("b"), F.lit(0).alias("side")
    )
    # One population count holds about a tenth of a cell.
    large = keyed.where(F.col("n") > tile).withColumn("salts", F.ceil(F.col("n") / (8 * tile)).cast("int"))
    large = large.withColumn("salt", F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int"))
    name = lambda pop, salt: F.concat_ws("/", F.lpad(pop.cast("string"), 2, "0"), F.lpad(salt.cast("string"), 9, "0"))
    mine = name(F.col("pop"), F.col("salt"))
    near = F.sequence(F.greatest(F.col("pop") - radius, F.lit(0)), F.least(F.col("pop") + radius, F.lit(64)))
    met = large.withColumn("mine", mine).withColumn("p", F.explode(near)).withColumn(
        "s", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    )
    theirs = name(F.col("p"), F.col("s"))
    paired = met.select(
        "k",
        "cell",
        "fp",
        F.least("mine", theirs).alias("a"),
        F.greatest("mine", theirs).alias("b"),
        (F.col("mine") > theirs).cast("int").alias("side"),
    )
    # The size of a unit is bounded by how the tiles are dealt.
    return (
        small.unionByName(paired)
        .groupBy("k", "cell", "a", "b")
        .agg(
            F.collect_list(F.when(F.col("side") == 0, F.col("fp"))).alias("own"),
            F.collect_list(F.when(F.col("side") == 1, F.col("fp"))).alias("other"),
            (F.col("a") == F.col("b")).alias("alone"),
        )
        .where("size(own) > 0 AND (alone OR size(other) > 0)")
        .select("own", "other")
    )


def tile_links(own: np.ndarray, other: np.ndarray, radius: int = RADIUS, side: int = SIDE) -> list[tuple[int, int]]:
    """A spanning forest of the links in a tile, or between two."""
    nodes = np.concatenate([own, other])
    pops = np.bitwise_count(nodes)
    order = np.lexsort((nodes, pops))
    nodes, pops, left = nodes[order], pops[order], (order < len(own))
    root = np.arange(len(nodes))
    for i in range(0, len(nodes), side):
        for j in range(i, len(nodes), side):
            if int(pops[j]) - int(pops[min(i + side, len(nodes)) - 1]) > radius:
                break
            near = np.bitwise_count(nodes[i : i + side, None] ^ nodes[None, j : j + side]) <= radius
            if len(other):
                near &= left[i : i + side, None] != left[None, j : j + side]
            a, b = np.nonzero(near)
            a, b = a + i, b + j
            a, b = a[a < b], b[a < b]
            while len(a):
                low = np.minimum(root[a], root[b])
                np.minimum.at(root, root[a], low)
                np.minimum.at(root, root[b], low)
                while (root[root] != root).any():
                    root = root[root]
                apart = root[a] != root[b]
                a, b = a[apart], b[apart]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return list(zip(nodes[moved].tolist(), nodes[root[moved]].tolist(), strict=True))


def links(nodes: DataFrame, n: int, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (s, o) between fingerprints that connect whatever is within the radius."""

    def run(batches):
        for batch in batches:
            found = []
            for own, other in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own, other = (np.array(x, np.int64).view(np.uint64) for x in (own, other))
                found += tile_links(own, other, radius)
            ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], names=["s", "o"]
            )

    return units(nodes, n, radius, tile).mapInArrow(tidy(run), "s long, o long").distinct()


def _rooted(nodes: DataFrame, found: DataFrame, name: str = "fp") -> DataFrame:
    """``nodes`` with the root of their component under the links ``found``."""
    stars, _ = star_forest(found)
    return nodes.join(stars.select(F.col("a").alias(name), F.col("b").alias("up")), name, "left").withColumn(
        "root", F.coalesce("up", name)
    )


def components(marked: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """doc_id, fp and component_id for every row of doc_id and fp."""
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    rooted = _rooted(nodes, links(nodes.select("fp"), nodes.count(), radius, tile))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(rooted.join(least, "root").select("fp", "component_id"), "components")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id of every document."""
    return components(materialize(fingerprints(docs), "marked"))


def _row_key(docs: DataFrame) -> Column:
    """A digest of the whole row; rows of one key are equal."""
    others = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]))
    text = F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("none"))
    return F.sha2(F.concat_ws("/", text, others).cast("binary"), 256)


def bands(hashes: np.ndarray, n_bands: int = BANDS, depth: int = DEPTH) -> np.ndarray:
    """Keys of the bands of minima of a set of shingle hashes; the number of the band is part of the key."""
    factors = np.random.default_rng(SEED).integers(1 << 63, size=n_bands * depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(n_bands * depth, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 512):
        np.minimum(least, (factors[:, None] * hashes[None, at : at + 512]).min(axis=1), out=least)
    keys = np.arange(1, n_bands + 1, dtype=np.uint64)
    for column in least.reshape(n_bands, depth).T:
        keys = (keys ^ column) * np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(29)
    return keys


def frequent_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Shingles that stand in many texts of a bounded sample, sorted.

    They only come last in the order of shingles, so the sample decides on the work and on no link.
    """
    every = max(docs.count() // SAMPLE, 1)
    texts = docs.select(F.xxhash64("text").alias("key"), "text").where(F.pmod("key", F.lit(every)) == 0)

    def run(batches):
        for batch in parts_of(batches, 1):
            for text in batch.column(1).cast(pa.binary()):
                joined = _joined(text.as_py())
                found = np.unique(_shingles(joined, width)) if joined else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["shingle"])

    counts = texts.dropDuplicates(["key"]).mapInArrow(tidy(run), "shingle long").groupBy("shingle").count()
    often = counts.where(F.col("count") >= OFTEN).orderBy(F.desc("count"), "shingle").limit(MOST)
    return np.sort(np.array([r["shingle"] for r in often.collect()], np.int64).view(np.uint64))


def prefix(hashes: np.ndarray, frequent: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """The first shingles of a sorted set, frequent ones last; sets of that similarity have one of them in common."""
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        often = frequent[at] == hashes
        hashes = np.concatenate([hashes[~often], hashes[often]])
    return hashes[: len(hashes) + 1 - -(-len(hashes) * share[0] // share[1])]


def parities(hashes: np.ndarray) -> np.ndarray:
    """Whether an odd number of the set is in each of the classes, of which there are twice as many as members or more, as 64-bit words."""
    n = 1 << max(PARITY_BITS, (2 * len(hashes)).bit_length())
    classes = (hashes & np.uint64(n - 1)).astype(np.int64)
    return np.packbits((np.bincount(classes, minlength=n) & 1).astype(np.uint8)).view(np.int64)


def folded(words: np.ndarray, n: int) -> np.ndarray:
    """The parities of fewer classes."""
    return np.bitwise_xor.reduce(words.reshape(-1, n), axis=0)


def _banded(
    docs: DataFrame, keep: list[str], width: int, share: tuple[int, int] = NEAR, frequent: np.ndarray | None = None
) -> DataFrame:
    """The columns ``keep``, a digest of the words, and the bands, number, prefix and parities, few and all, of the shingles of every row; none without words."""
    rows = docs.select(*keep, "text")
    n = len(keep)
    frequent = np.zeros(0, np.uint64) if frequent is None else frequent
    lists = ["bands", "prefix", "parities", "fine"]

    def run(batches):
        for batch in parts_of(batches, n):
            nodes, sizes, made = [], [], {c: [] for c in lists}
            for text in batch.column(n).cast(pa.binary()):
                joined = _joined(text.as_py())
                hashes = np.unique(_shingles(joined, width)) if joined else np.zeros(0, np.uint64)
                nodes.append(xxhash.xxh3_64_intdigest(joined, SEED) if joined else 0)
                sizes.append(len(hashes))
                made["bands"].append(bands(hashes).view(np.int64) if joined else [])
                made["prefix"].append(prefix(hashes, frequent, share).view(np.int64) if joined else [])
                made["fine"].append(parities(hashes))
                made["parities"].append(folded(made["fine"][-1], 1 << PARITY_BITS - 6))
            columns = [pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int64())]
            columns += [pa.array(made[c], pa.list_(pa.int64())) for c in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *columns], names=[*keep, "node", "size", *lists])

    more = [StructField("node", LongType()), StructField("size", LongType())]
    more += [StructField(c, ArrayType(LongType())) for c in lists]
    return rows.mapInArrow(tidy(run), StructType([*rows.schema.fields[:n], *more]))


def _alike(pairs: DataFrame, texts: DataFrame, width: int, share: tuple[int, int]) -> DataFrame:
    """The pairs (s, o) of a written table whose texts have that Jaccard similarity at least."""
    one = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
    met = pairs.join(one("o"), "o")
    met = lookup(met, one("s"), ["s"], heavy_keys(pairs, ["s"]), "inner").select("s", "o", "text_s", "text_o")

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        of = lambda blob: np.unique(_shingles(_joined(unpack(blob.as_py())), width))
        last, mine = None, None
        for batch in batches:
            good = []
            for s, a, b in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if s != last:
                    last, mine = s, of(a)
                theirs = of(b)
                both = len(np.intersect1d(mine, theirs, assume_unique=True))
                good.append(both * share[1] >= (len(mine) + len(theirs) - both) * share[0])
            yield batch.select(["s", "o"]).filter(pa.array(good, pa.bool_()))

    return met.mapInArrow(tidy(run), "s long, o long")


def _packed_texts(docs: DataFrame, width: int) -> DataFrame:
    """node, compressed text and wide fingerprint."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in parts_of(batches, 1):
            texts = [t.as_buffer().to_pybytes() for t in batch.column(1)]
            wide = [wide_fingerprint(np.unique(_shingles(_joined(t), width))) for t in texts]
            made = [pa.array(map(press, texts), pa.binary()), pa.array(wide, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["node", "text", "wide"])

    return docs.select("node", F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), "node long, text binary, wide array<long>")


def least_forest(wide: np.ndarray, side: np.ndarray, radius: int = WIDE_RADIUS) -> list[tuple[int, int]]:
    """Links of the least spanning forest of fingerprints by differing bits, up to ``radius``.

    If there are two sides, links run between them only. Fingerprints whose population counts differ by more than the radius are not compared.
    """
    pops = np.bitwise_count(wide).sum(axis=1, dtype=np.int64)
    order = np.argsort(pops, kind="stable")
    wide, pops, side = wide[order], pops[order], side[order]
    both = side.any() and not side.all()
    if both and (pops[side == 0].min() - pops[side == 1].max() > radius or pops[side == 1].min() - pops[side == 0].max() > radius):
        return []
    far = radius + 1
    best, near = np.full(len(wide), far), np.full(len(wide), -1)
    out, found = np.zeros(len(wide), bool), []
    for _ in range(len(wide)):
        i = int(np.where(out, far + 1, best).argmin())
        out[i] = True
        if best[i] <= radius:
            found.append((int(order[i]), int(order[near[i]])))
        lo, hi = np.searchsorted(pops, [pops[i] - radius, pops[i] + far])
        bits = np.bitwise_count(wide[lo:hi] ^ wide[i]).sum(axis=1, dtype=np.int64)
        closer = ~out[lo:hi] & (bits < best[lo:hi])
        if both:
            closer &= side[lo:hi] != side[i]
        at = lo + np.flatnonzero(closer)
        best[at], near[at] = bits[closer], i
    return found


def _wide_units(buckets: DataFrame, tile: int = WIDE_TILE) -> DataFrame:
    """Units of comparison: a tile of a band, or two; lists of (node, side, wide) whose size the tiles bound."""
    counts = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = buckets.join(counts, "band").withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("node", "band"), F.col("tiles")).cast("int"))
    met = dealt.withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    member = F.struct("node", (F.col("mine") > F.col("theirs")).cast("int").alias("side"), "wide")
    return met.groupBy("band", F.least("mine", "theirs").alias("a"), F.greatest("mine", "theirs").alias("b")).agg(
        F.collect_list(member).alias("members")
    )


def candidates(buckets: DataFrame, radius: int = WIDE_RADIUS, tile: int = WIDE_TILE) -> DataFrame:
    """Pairs (s, o) of nodes that connect what lies within the radius in a band, from (node, band, wide)."""

    def run(batches):
        for batch in batches:
            found = []
            for members in batch.column(0):
                rows = members.values
                node = rows.field("node").to_numpy()
                wide = rows.field("wide").flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
                found += [(node[i], node[j]) for i, j in least_forest(wide, rows.field("side").to_numpy(), radius)]
            ends = np.sort(np.array(found, np.int64).reshape(-1, 2), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], names=["s", "o"])

    units = _wide_units(buckets, tile).select("members")
    return units.mapInArrow(tidy(run), "s long, o long").distinct()


def possible_pairs(
    lengths: np.ndarray, side: np.ndarray, wide: np.ndarray, share: tuple[int, int]
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that may have that similarity, in units of so many rows each.

    The words of ``wide`` are parities, root, size of the set, and place of the shared shingle in its order. Pairs of one root are left out, and
    those with too unlike sizes, too few shingles after the shared one, or more differing parities than shingles may differ. If
    the shared shingle is the first that a pair of the similarity shares, none of this refuses it.
    """
    least, whole = share
    words, (root, size, at) = wide[:, :-3], wide[:, -3:].view(np.int64).T
    left = size - at
    ends = np.cumsum(lengths)
    mixed = np.repeat(np.add.reduceat(side, ends - lengths) > 0, lengths)
    follow = np.repeat(ends, lengths) - 1 - np.arange(len(side))
    found = []
    for rows in np.split(np.arange(len(side)), np.flatnonzero(np.diff(np.cumsum(follow) // PAIRS)) + 1):
        n = follow[rows]
        p = np.repeat(rows, n)
        q = p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(n) - n, n)
        fit = (root[p] != root[q]) & ~(mixed[p] & (side[p] == side[q]))
        p, q = p[fit], q[fit]
        both = size[p] + size[q]
        fit = np.minimum(size[p], size[q]) * whole >= np.maximum(size[p], size[q]) * least
        fit &= np.minimum(left[p], left[q]) * (least + whole) >= both * least
        p, q, both = p[fit], q[fit], both[fit]
        apart = np.bitwise_count(words[p] ^ words[q]).sum(axis=1, dtype=np.int64)
        fit = apart * (least + whole) <= both * (whole - least)
        found.append((p[fit], q[fit]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def least_apart(a: np.ndarray, b: np.ndarray) -> int:
    """By how many members two sets differ at least, from their parities."""
    n = min(len(a), len(b))
    # Bit counts of negative numbers are those of their absolute value.
    return int(np.bitwise_count((folded(a, n) ^ folded(b, n)).view(np.uint64)).sum(dtype=np.int64))


def _near(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The pairs (s, o) that differ in no more parities than sets of that similarity may differ in shingles."""
    one = lambda c: sets.select(F.col("node").alias(c), F.struct("size", "fine").alias(f"set_{c}"))
    met = pairs.join(one("s"), "s").join(one("o"), "o").select("s", "o", "set_s", "set_o")
    least, whole = share

    def run(batches):
        for batch in batches:
            good = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                apart = least_apart(*(x["fine"].values.to_numpy() for x in (a, b)))
                good.append(apart * (least + whole) <= (a["size"].as_py() + b["size"].as_py()) * (whole - least))
            yield batch.select(["s", "o"]).filter(pa.array(good, pa.bool_()))

    return met.mapInArrow(tidy(run), "s long, o long")


def unjoined(marked: DataFrame, rooted: DataFrame, share: tuple[int, int], tile: int = WIDE_TILE) -> DataFrame:
    """Pairs (s, o) of nodes of different roots, among them all of that similarity."""
    first = [F.first(c).alias(c) for c in ("size", "prefix", "parities", "fine")]
    sets = materialize(marked.groupBy("node").agg(*first).join(rooted.select("node", "root"), "node"), "sets")
    rows = sets.select("node", "root", "size", F.posexplode("prefix").alias("at", "band"))
    band = Window.partitionBy("band")
    shared = rows.withColumns({"low": F.min("root").over(band), "high": F.max("root").over(band)}).where("low < high")
    met = shared.join(sets.select("node", "parities"), "node")
    words = F.concat("parities", F.array("root", "size", F.col("at").cast("long")))
    buckets = materialize(met.select("node", "band", words.alias("wide")), "shared")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(0).flatten()
            node, side = (rows.field(c).to_numpy() for c in ("node", "side"))
            wide = rows.field("wide").flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
            p, q = possible_pairs(batch.column(0).value_lengths().to_numpy().astype(np.int64), side, wide, share)
            ends = np.unique(np.sort(np.stack([node[p], node[q]], axis=1), axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], names=["s", "o"])

    pairs = _wide_units(buckets, tile).select("members").mapInArrow(tidy(run), "s long, o long").distinct()
    return _near(materialize(pairs, "possible"), sets, share)


def similar(keyed: DataFrame, marked: DataFrame, nodes: DataFrame, held: str, width: int, share: tuple[int, int]) -> DataFrame:
    """``nodes`` with the root of their component: candidates of the bands, then of the prefixes, checked on the texts."""

    def packed(some: DataFrame) -> DataFrame:
        wanted = some.select("node").distinct().join(nodes.select("node", F.col("first.key").alias(held)), "node")
        wanted = maybe_broadcast(materialize(wanted, "wanted"), BROADCAST_ROWS)
        return materialize(_packed_texts(keyed.join(wanted, held).dropDuplicates(["node"]), width), "texts")

    # One row for each text and band; equal texts are one node.
    bands_of = marked.groupBy("node").agg(F.first("bands").alias("bands"))
    buckets = materialize(bands_of.select("node", F.explode("bands").alias("band")), "bands")
    shared = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    left = materialize(buckets.join(shared, "band"), "buckets")
    texts = packed(left)
    pairs = materialize(candidates(left.join(texts.select("node", "wide"), "node")), "pairs")
    alike = materialize(_alike(pairs, texts, width, share), "alike")
    rooted = _rooted(nodes, alike, "node")
    # What the forests missed.
    more = materialize(unjoined(marked, rooted, share), "unjoined")
    if more.isEmpty():
        return rooted
    ends = more.select(F.explode(F.array("s", "o")).alias("node"))
    late = materialize(_alike(more, packed(ends), width, share), "late")
    return rooted if late.isEmpty() else _rooted(nodes, alike.unionByName(late), "node")


def deduplicate(docs: DataFrame, width: int = NEAR_SHINGLE, share: tuple[int, int] = NEAR) -> DataFrame:
    """One document of each component of texts of a Jaccard similarity of ``share`` or more; the columns of ``docs``.

    That with the smallest doc_id stays, null ids last, and of equal ids that with the least digest of its row. Texts
    without words are alike.
    """
    (held,) = fresh(docs.columns, "_key")
    keyed = docs.withColumn(held, _row_key(docs))
    frequent = frequent_shingles(docs, width)
    marked = materialize(_banded(keyed, ["doc_id", held], width, share, frequent), "marked")
    # The least row of each text, then of each component; both by partial aggregates.
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col(held).alias("key"))
    nodes = materialize(marked.groupBy("node").agg(F.min(order).alias("first")), "nodes")
    rooted = similar(keyed, marked, nodes, held, width, share)
    keepers = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.key").alias(held))
    return keyed.join(materialize(keepers, "keepers"), held).dropDuplicates([held]).select(*docs.columns)


def op2_simhash(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
