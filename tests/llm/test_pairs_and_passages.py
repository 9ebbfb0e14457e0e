"""SimHash, substring dedup and decontamination against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quadweld.llm import decontaminate, recompression, simhash

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, component_id string, _spans int, place int"


def frame(spark, rows):
    """Documents with columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(3)


def fingerprint(text):
    words = WORDS.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def mixed_rows(seed):
    rng = random.Random(seed)
    base = [rng.choice(["a", "b", "c", "dd", "É"]) for _ in range(200)]
    rows = []
    for i in range(80):
        kind = i % 5
        if kind == 0:
            words = [rng.choice("xy") for _ in range(rng.randint(0, 60))]
        elif kind == 1:
            words = ["one"] * rng.randint(0, 50)
        elif kind == 2:
            at = rng.randint(0, 150)
            words = base[at : at + rng.randint(10, 50)] + [rng.choice("pqr") for _ in range(4)]
        elif kind == 3:
            words = (["u", "v", "w"] * 30)[: rng.randint(1, 80)]
        else:
            words = rows[-3][1].split()
        rows.append((i, " ".join(words)))
    rows += [(None, " ".join(base[:60])), (5, None), (7, ""), (3, rows[3][1]), (4, " ".join(base[:40])), (9, " \n\t ")]
    rows.append((200, "\n".join(base * 40)))  # very long
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("tile", [2_048, 4])
def test_components_are_those_of_all_pairs(spark, tile):
    rows = mixed_rows(1)
    rng = random.Random(5)
    long = [str(rng.randint(0, 10**6)) for _ in range(400)]
    rows += [(300 + k, " ".join(long[:k] + ["new"] + long[k + 1 :])) for k in range(0, 40, 2)]
    rows += [(400 + k, " ".join(long)) for k in range(30)]
    marks = [(i, fingerprint(t)) for i, t in rows]
    ids = list(range(len(rows)))
    root = ids[:]

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids[:i]:
            if (marks[i][1] ^ marks[j][1]).bit_count() <= 4:
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for i in ids:
        least[find(i)].append(marks[i][0])
    want = sorted(
        (str(marks[i][0]), f"{marks[i][1]:016x}", min((x for x in least[find(i)] if x is not None), default=None)) for i in ids
    )
    marked = simhash.materialize(simhash.fingerprints(frame(spark, rows)), "marked")
    got = simhash.components(marked, tile=tile).collect()
    assert sorted((str(r.doc_id), f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in got) == want


def test_cells_meet_all_pairs_within_the_radius():
    rng = random.Random(2)
    for n in (10**3, 10**8, 10**10, 10**13):
        masks = simhash.cell_masks(n)
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), 4):
                b ^= 1 << bit
            assert any(a & m == b & m for m in masks)


def test_one_document_of_each_component_stays(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "other words than those above"), (8, None), (7, "")]
    kept = simhash.deduplicate(frame(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 7]
    assert kept.columns == SCHEMA.replace(",", "").split()[::2]
    assert simhash.op2_simhash(frame(spark, [])).count() == 0


def test_components_without_ids_or_with_one_id_keep_a_row_each(spark):
    texts = [" ".join(f"{c}{k}" for k in range(40)) for c in "abcde"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (4, texts[2]), (4, texts[3]), (None, texts[2]), (6, texts[3]), (None, texts[4])]
    kept = simhash.deduplicate(frame(spark, rows)).collect()
    assert sorted((r.text, r.doc_id) for r in kept) == [(t, i) for t, i in zip(texts, [None, None, 4, 4, None], strict=True)]


def test_of_texts_of_a_similarity_of_four_fifths_one_stays(spark):
    rng = random.Random(11)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    rows = []
    for size in (12, 30, 60, 150, 400) * 4:
        base = [word() for _ in range(size)]
        for k in range(5):
            # Changed stretches at the end or spread, so that similarities lie on both sides of the limit.
            copy, n = base[:], round(size * 0.06 * k)
            if k % 2:
                copy[size - n :] = [word() for _ in range(n)]
            else:
                for at in rng.sample(range(size), n // 5):
                    copy[at] = word()
            rows.append((len(rows), " ".join(copy)))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    root = list(range(len(rows)))
    for i in root[:]:
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    got = {r.doc_id for r in simhash.deduplicate(frame(spark, rows)).collect()}
    assert got == set(root) and len(got) < len(rows)


def removed_by_brute_force(rows):
    order = lambda i: (i is None, i or 0)
    first, out = {}, defaultdict(list)
    split = [(i, WORDS.findall((t or "").encode())) for i, t in rows]
    for i, w in split:
        for s in range(len(w) - 19):
            k = tuple(w[s : s + 20])
            first[k] = min(first.get(k, (*order(i), s)), (*order(i), s))
    for i, w in split:
        gone = set()
        for s in range(len(w) - 19):
            if first[tuple(w[s : s + 20])] < (*order(i), s):
                gone.update(range(s, s + 20))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[i].append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_words_of_repeated_windows_go(spark, seed):
    rows = mixed_rows(seed)
    got = defaultdict(list)
    for r in recompression.op10_recompression(frame(spark, rows)).collect():
        got[r.doc_id].append((r.n_words, r.n_removed, r.kept_sha256))
    assert {i: sorted(v) for i, v in got.items()} == removed_by_brute_force(rows)


@pytest.mark.parametrize("seed", [3, 4])
def test_rows_of_one_id_meet_their_own_spans_alone(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, 5, i]), t) for i, t in mixed_rows(seed)]
    base = [f"b{k}" for k in range(90)]
    rows += [(None, " ".join(base[k : k + 40] + [f"n{k}"])) for k in range(0, 50, 3)] + [(2, " ".join(base[30:70]))]
    docs = frame(spark, rows)
    got = defaultdict(list)
    for r in recompression.op10_recompression(docs).collect():
        got[r.doc_id].append((r.n_words, r.n_removed, r.kept_sha256))
    assert {i: sorted(v) for i, v in got.items()} == removed_by_brute_force(rows)
    plain = docs.select("doc_id", "text")
    met = recompression._met(plain, recompression.repeats(plain), "inner").collect()
    widths = [len(recompression.zstandard.ZstdDecompressor().decompress(r[1]).split()) for r in met]
    assert met and all(len({s["place"] >> 8 for s in r[2]}) == len({s["place"] for s in r[2]}) <= n for r, n in zip(met, widths, strict=True))


def test_texts_without_repeats_stay_byte_for_byte(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(1, "Head \n " + passage + "\n tail  end "), (2, passage), (3, "before  it " + passage + " after"), (4, None), (5, "")]
    kept = {r.doc_id: r.text for r in recompression.without_repeats(frame(spark, rows)).collect()}
    # All of document 2 stands in 1, so nothing of it is left.
    assert kept == {1: rows[0][1], 3: "before  it  after", 4: None, 5: ""}
    assert recompression.op10_recompression(frame(spark, [])).count() == 0


def hits_by_brute_force(text, items):
    fold = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().translate(decontaminate._FOLD))
    words, hit, names = fold(text), set(), set()
    for name, item in items:
        w = fold(item)
        n = min(10, len(w))
        for a in range(len(w) - n + 1) if n else ():
            for b in range(len(words) - n + 1):
                if words[b : b + n] == w[a : a + n]:
                    hit.update(range(b, b + n))
                    names.add(str(name))
    return len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_words", [100_000, 15])
def test_hits_are_those_of_all_windows(spark, monkeypatch, block_words):
    rng = random.Random(4)
    vocabulary = ["a", "B", "c1", "é", "e-f", "G."]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.randint(8, 30))) for k in range(12)] + [(20, "a b c1"), (21, None), (22, " . "), (2, text(12))]
    docs = [(k, text(rng.randint(0, 60))) for k in range(30)] + [(40, None), (41, ""), (42, "x " + items[3][1] + " x"), (42, "a")]
    docs.append((43, text(20_000)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.match(frame(spark, docs), benchmark, ["doc_id"], block_words=block_words).collect()
    got = sorted(
        (str(r.doc_id), r._n_words, sum(s.last - s.first for s in r._spans), len(r._items),
         hashlib.sha256(",".join(sorted(r._items)).encode()).hexdigest(), bool(r._spans))
        for r in found
    )
    assert got == sorted((str(i), *hits_by_brute_force(t, items)) for i, t in docs)


def test_leaks_are_cut_and_mostly_leaked_documents_go(spark):
    leak = " ".join(f"q{k}" for k in range(12))
    benchmark = spark.createDataFrame([(1, leak + " q99"), (2, None)], "item_id long, text string")
    clean = " ".join(f"z{k}" for k in range(30))
    docs = frame(spark, [(1, f"{clean}, {leak.upper()}; {clean}"), (2, leak), (3, clean), (4, None), (5, "")])
    kept = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, benchmark).collect()}
    assert kept == {1: f"{clean}, ; {clean}", 3: clean, 4: None, 5: ""}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.op3_decontaminate(docs, empty).where("contaminated").count() == 0
    assert decontaminate.op3_decontaminate(frame(spark, []), benchmark).count() == 0


def test_least_forests_join_what_is_near():
    draw = np.random.default_rng(4)
    centres = draw.integers(1 << 63, size=(5, 4), dtype=np.uint64)
    wide = centres[draw.integers(5, size=60)] ^ (np.uint64(1) << draw.integers(64, size=(60, 4)).astype(np.uint64))
    for side in (np.zeros(60, int), draw.integers(2, size=60)):
        apart = np.bitwise_count(wide[:, None] ^ wide[None]).sum(axis=2)
        met = (apart <= 10) & ((side[:, None] != side[None]) if side.any() else True)
        roots, forest = list(range(60)), list(range(60))

        def find(of, x):
            while of[x] != x:
                x = of[x]
            return x

        for i, j in zip(*np.nonzero(met), strict=True):
            roots[find(roots, i)] = find(roots, j)
        found = simhash.least_forest(wide, side, 10)
        for i, j in found:
            assert met[i, j] and find(forest, i) != find(forest, j)
            forest[find(forest, i)] = find(forest, j)
        assert len(found) == 60 - len({find(roots, x) for x in range(60)})


def test_unlike_texts_of_one_template_give_few_candidates(spark):
    draw = random.Random(1)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(1_500):
        words = list(base)
        for at in range(0, 120, 15):
            words[at + draw.randrange(5)] = f"x{draw.randrange(10**9)}"
        rows.append((i, " ".join(words)))
    docs = frame(spark, rows)
    marked = simhash._banded(docs.withColumn("_key", F.col("doc_id").cast("string")), ["doc_id", "_key"], 5)
    wide = [(int(np.int64(i)), simhash.wide_fingerprint(np.unique(simhash._shingles(simhash._joined(t.encode()), 5)))) for i, t in rows]
    fingerprints = spark.createDataFrame(wide, "doc_id long, wide array<long>")
    buckets = marked.select("doc_id", "node", F.explode("bands").alias("band")).join(fingerprints, "doc_id").select("node", "band", "wide")
    n = buckets.groupBy("band").count().where("count > 1").agg(F.sum("count")).first()[0] or 0
    assert simhash.candidates(buckets, tile=100).count() <= 20 * max(n, 1)
    assert len(simhash.deduplicate(docs).collect()) == len(rows)


def test_pairs_that_the_fingerprints_hold_apart_are_linked(spark):
    # Four shingles of five: similarity 0.8, but more differing bits than the radius.
    draw, pairs = random.Random(5), []
    while len(pairs) < 6:
        words = [f"w{draw.randrange(10**6)}" for _ in range(9)]
        texts = [" ".join(words[:8]), " ".join(words)]
        wide = [simhash.wide_fingerprint(np.unique(simhash._shingles(t.encode(), 5))) for t in texts]
        apart = sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in zip(*wide, strict=True))
        if apart > simhash.WIDE_RADIUS:
            pairs.append(texts)
    rows = [(2 * k + j, t) for k, texts in enumerate(pairs) for j, t in enumerate(texts)]
    kept = simhash.deduplicate(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == [0, 2, 4, 6, 8, 10]


def test_prefixes_and_bounds_keep_every_pair_of_the_similarity():
    draw = np.random.default_rng(8)
    pool = draw.integers(1 << 63, size=120, dtype=np.uint64) * np.uint64(2)
    sets = []
    for _ in range(40):
        base = draw.choice(pool, size=draw.integers(1, 60), replace=False)
        sets += [np.unique(np.concatenate([base[draw.random(len(base)) > f], draw.choice(pool, 2)])) for f in (0, 0.05, 0.15)]
    frequent = np.sort(draw.choice(pool, 50, replace=False))
    firsts = [simhash.prefix(x, frequent, (4, 5)).tolist() for x in sets]
    words = [simhash.folded(simhash.parities(x), 8) for x in sets]
    found = set()
    for token in {t for f in firsts for t in f}:
        here = [i for i, f in enumerate(firsts) if token in f]
        wide = np.array([[*words[i], i, len(sets[i]), firsts[i].index(token)] for i in here], np.int64).view(np.uint64)
        # One tile alone, and two tiles with their units.
        cut = len(here) // 2
        order = [*range(len(here)), *range(cut), *range(cut, len(here)), *range(len(here))]
        side = np.array([0] * 2 * len(here) + [0] * cut + [1] * (len(here) - cut))
        lengths = np.array([x for x in (len(here), cut, len(here) - cut, len(here)) if x])
        p, q = simhash.possible_pairs(lengths, side, wide[order], (4, 5))
        at = [here[k] for k in order]
        found |= {(min(at[i], at[j]), max(at[i], at[j])) for i, j in zip(p, q, strict=True)}
    alike = set()
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both * 5 >= (len(sets[i]) + len(sets[j]) - both) * 4:
                alike.add((i, j))
    assert alike and alike <= found and len(found) < len(sets) * (len(sets) - 1) // 2


def test_parities_bound_the_difference_of_sets():
    draw = np.random.default_rng(9)
    for size in (1, 30, 300, 3_000):
        for drop in (0, 1, size // 10, size // 4):
            a = np.unique(draw.integers(1 << 63, size=size, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
            b = np.unique(np.concatenate([a[drop:], draw.integers(1 << 63, size=drop, dtype=np.uint64)]))
            apart = len(np.setxor1d(a, b))
            assert apart / 2 - 1 <= simhash.least_apart(simhash.parities(a), simhash.parities(b)) <= apart
