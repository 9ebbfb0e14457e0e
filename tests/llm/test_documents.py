"""Toxicity, line quality, quality rules, mixing and the pipeline."""

import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quadweld.llm import labelled, line_quality, mixing, quality_rules, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, finish int, label string, d2 string"


def docs(spark, rows):
    """(doc_id, text, lang, source) with columns whose names clash with inner ones."""
    return spark.createDataFrame([(*r, len(r[1] or ""), "s", 1, "l", "d") for r in rows], SCHEMA).repartition(3)


EDGES = [(None, "alpha beta gamma"), (900, None), (901, ""), (902, " \n "), (903, "very long text here. " * 30_000), (904, "x"), (904, "x")]


@pytest.fixture(scope="module")
def corpus(spark):
    """Plain prose, prose with insults (one kind disguised), and junk of two kinds."""
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("aeioulnrst"), int(rng.integers(2, 8))))
    rows, labels = [], []
    for k in range(240):
        lines = [" ".join(word() for _ in range(int(rng.integers(5, 25)))).capitalize() + "." for _ in range(6)]
        if k % 4 == 1:
            lines = [" ".join(w + "!!" for w in x.upper().split()) for x in lines]
        if k % 8 == 2:
            lines = [" ".join(w + "***" for w in x.split()) for x in lines]
        if k % 3 == 0:
            lines[2] += " You are a blockhead" + (" and a d0lt." if k % 2 else " and a dolt.")
        rows.append((k, "\n".join(lines), "en", "s"))
        labels.append((k, int(not (k % 4 == 1 or k % 8 == 2)), int(k % 3 == 0)))
    labels += [(900, 0, 0), (None, 1, 1), (5000, 1, 0), (7, None, None)]
    edges = [(i, t, None, None) for i, t in EDGES]
    return docs(spark, rows + edges).cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(
    ("op", "label", "threshold"), [(toxicity.op4_toxicity, "toxic", 0.3), (line_quality.op6_line_quality, "quality", 0.5)]
)
def test_held_out_documents_are_told_apart(corpus, op, label, threshold):
    rows = op(*corpus).collect()
    assert len(rows) == corpus[0].count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) for r in rows)
    truth = {r.doc_id: r[label] for r in corpus[1].collect() if r[label] is not None and r.doc_id is not None}
    judged = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth and r.doc_id < 900]
    assert len(judged) > 30
    assert np.mean([p == y for p, y in judged]) > 0.95
    same = defaultdict(set)
    for r in rows:
        same[r.doc_id].add(r.score)
    assert len(same[904]) == 1


@pytest.mark.parametrize("op", [toxicity.op4_toxicity, line_quality.op6_line_quality])
def test_without_labels_or_documents(corpus, op):
    assert op(corpus[0].limit(0), corpus[1]).count() == 0
    rows = op(corpus[0].where("doc_id > 890"), corpus[1].limit(0)).collect()
    assert len(rows) == len(EDGES) - 1


def test_labels_of_the_held_out_fold_are_not_read(spark, corpus):
    rows = labelled.training_rows(*corpus, "toxic", 4, 2, 10_000)
    fold = labelled.fold_of(F.col("doc_id"), 4)
    assert rows.count() > 100
    assert rows.where(fold == 2).count() == 0
    assert labelled.training_rows(*corpus, "toxic", 4, 2, 10).count() == 10


@pytest.mark.parametrize(
    ("text", "folded"),
    [
        ("D0LT", "dolt"), ("dоlt", "dolt"), ("ｄｏｌｔ", "dolt"), ("d.o.l.t", "dolt"), ("in 2005 we", "in 2005 we"),
        ("5 $ each", "5 $ each"), ("w0rthle$s", "worthless"), ("été", "été"), ("", ""),
    ],
)
def test_folding(text, folded):
    assert toxicity.fold(text) == folded


def test_exceptions_and_length():
    lexicon = toxicity.Lexicon({"trash$": 2.0, "dolt": 3.0})
    found = lambda t: toxicity.Lexicon.features(lexicon.automaton(), t)[0]
    assert found("trash, dolts") == 5.0
    assert found("the trash can") == 0.0
    assert found("trashy adolt") == 0.0
    assert toxicity.Lexicon.features(lexicon.automaton(), "trash " + "a " * 949)[1] < 0.3
    assert toxicity.Lexicon.features(toxicity.Lexicon({}, ()).automaton(), "trash")[0] == 0.0


def test_of_nested_terms_the_branching_one_is_chosen():
    counted = [("idio", 20, 0), ("idiot", 20, 0), ("idiot$", 20, 0), ("vequ", 20, 0), ("vequa", 9, 0), ("vequb", 9, 0), ("with", 20, 300)]
    assert set(toxicity.chosen_terms(counted, 30, 300)) == {"idiot$", "vequ"}


def test_chain_marginals_are_those_of_all_labelings():
    rng = np.random.default_rng(1)
    chain = line_quality.Chain(3)
    chain.w, chain.t, x = rng.normal(size=3), rng.normal(size=(2, 2)), rng.normal(size=(6, 3))
    starts, sizes = np.array([0, 1, 1]), np.array([1, 0, 5])
    got, _ = chain.marginals(chain.potentials(x), starts, sizes)
    u, want = x @ chain.w, []
    for a, n in zip(starts, sizes, strict=True):
        total, good = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            s = np.exp(sum(u[a + i] * y[i] for i in range(n)) + sum(chain.t[p, q] for p, q in itertools.pairwise(y)))
            total += s
            good += s * np.array(y)
        want += list(good / total)
    assert np.allclose(got, want)


def test_good_documents_keep_their_columns(corpus):
    kept = line_quality.good_documents(*corpus)
    assert kept.columns == corpus[0].columns
    assert 145 <= kept.where("doc_id < 240").count() <= 155


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = re.findall(r"[#*$%&|<>]", text or "")
    return len(words), sum(map(len, words)), len(symbols), len(lines) - len(set(lines)), len(again)


def test_counts_and_verdicts(spark):
    rng = np.random.default_rng(5)
    plain = lambda n: " ".join(rng.choice(["ab", "cde", "fghi", "é𝄞", "jklm", "no", "p", "qrs"], n))
    rows = [(k, plain(150) + "\n" + plain(60) + "\n" + plain(40), "en", "hot" if k % 3 else None) for k in range(150)]
    rows += [(500 + k, " ".join(w + "###" for w in plain(200).split()), "en", "hot") for k in range(8)]
    rows += [(600, "a b c d e f g h i\na b c d e f g h i\n\n \n" + plain(80), "en", "hot"), (601, "x y " * 100, "en", "hot")]
    rows += [(i, t if len(t or "") < 1_000 else plain(20_000), None, None) for i, t in EDGES]
    got = quality_rules.op8_quality_rules(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    found = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert found == sorted((str(i), *slow_counts(t)) for i, t, _, _ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        if r.doc_id is not None and r.doc_id < 150:
            assert r.kept
        if r.doc_id is not None and 500 <= r.doc_id < 600:
            assert not r.kept and not r.base_failed
    assert quality_rules.op8_quality_rules(docs(spark, [])).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_determinants_are_near_the_least_of_all_subsets(spark, seed):
    rng = np.random.default_rng(seed)
    clean = np.round(rng.normal(0, 1, (12, 5)) @ rng.normal(0, 200, (5, 5))).astype(int)
    far = np.round(rng.normal(4_000, 100, (4, 5))).astype(int)
    points = np.vstack([clean, far])
    table = spark.createDataFrame([(g, *map(int, x)) for g in "ab" for x in points[:: 1 if g == "a" else -1]], "group string, x1 long, x2 long, x3 long, x4 long, x5 long")

    def log_det(part):
        return np.linalg.slogdet(np.cov(part.T, bias=True) + np.eye(5) * quality_rules.FLOOR**2)[1]

    best = min(log_det(points[list(c)]) for c in itertools.combinations(range(16), 12))
    found = quality_rules.robust_estimates(table).collect()
    assert len(found) == 2 and found[0].log_det == pytest.approx(found[1].log_det)
    for r in found:
        assert best - 1e-6 <= r.log_det <= best + 0.5
        assert abs(r.m0) < 1_500
    first = quality_rules._first(table, quality_rules.SUPPORT).collect()
    assert {r.start for r in first} == {0, 1, 2} and all(found[0].log_det <= r.log_det + 1e-9 for r in first)


def slow_mix(rows):
    import hashlib

    sizes = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _, s in rows]
    sources = sorted({s for _, s, _ in sizes}, key=lambda s: (s is None, s or ""))
    held = {s: sum(n for _, x, n in sizes if x == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    total, target = sum(held.values()), {}
    left, rest = total * 3 / 2, list(sources)
    while rest:
        level = left / sum(weight[s] for s in rest)
        full = [s for s in rest if 2 * held[s] <= level * weight[s]]
        if not full:
            target |= {s: level * weight[s] for s in rest}
            break
        target |= {s: 2.0 * held[s] for s in full}
        left -= sum(2 * held[s] for s in full)
        rest = [s for s in rest if s not in full]
    copies, upto = [], Counter()
    digest = lambda i: hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()
    for k, (i, s, n) in sorted(enumerate(sizes), key=lambda r: (digest(r[1][0]), r[1][0] is not None, r[1][0] or 0, r[1][2])):
        upto[s] += n
        copies += [((upto[s] + p * held[s]) / target[s] if target[s] else 0.0, digest(i), k, p, n) for p in (0, 1)]
    taken, used = Counter(), 0
    for _, _, k, _, n in sorted(copies):
        used += n
        if used > total * 3 // 2:
            break
        taken[k] += n
    return sizes, held, target, taken


def test_mix_is_that_of_one_queue(spark):
    rng = np.random.default_rng(2)
    rows = [(int(k), "w " * int(rng.integers(0, 30)), None, rng.choice(["a", "b", "b", "b", "B", "é"])) for k in range(120)]
    rows += [(i, t if len(t or "") < 1_000 else "w " * 50, None, None) for i, t in EDGES] + [(7, "w w w", None, "a")]
    sizes, held, target, taken = slow_mix(rows)
    got = mixing.op9_mixing(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    found = sorted((str(r.doc_id), r.size, r.source_size, round(r.target, 6), r.taken) for r in got)
    want = sorted((str(i), n, held[s], round(target[s], 6), taken[k]) for k, (i, s, n) in enumerate(sizes))
    assert found == want
    assert all(r.taken <= 2 * r.size for r in got)


def test_many_rows_of_one_id_are_cut_by_their_texts(spark, monkeypatch):
    rows = [(None, f"w{k % 70} " * (k % 7), None, "ab"[k % 2]) for k in range(300)] + [(k, "x y", None, "a") for k in range(40)]
    table = docs(spark, rows)
    whole = sum(r.taken for r in mixing.op9_mixing(table).collect())
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    monkeypatch.setattr(mixing, "CROWDED", 2)
    sizes = table.select("doc_id", "source", mixing._size_of(F.col("text")).alias("size"), mixing._text_key().alias("text_key"))
    keyed = sizes.withColumns({"source_key": F.col("source"), "bucket": F.lit("0")})
    n, distinct = max((r["n"], r["kinds"]) for r in mixing._uncrowded(keyed).groupBy("source_key", "bucket").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("text_key", "doc_id").alias("kinds")).collect())
    assert n < 60 or distinct == 1
    made = [sorted(map(str, mixing.op9_mixing(t).collect())) for t in (table, table.repartition(7))]
    got = mixing.op9_mixing(table).collect()
    assert made[0] == made[1] and len(got) == len(rows) and all(r.taken <= 2 * r.size for r in got)
    assert abs(sum(r.taken for r in got) - whole) <= 2 * 12
    queued = mixing.mix(table).where("pass = 0")
    # Along the queue of a source every row adds its own words.
    for source in "ab":
        upto, seen = 0, 0
        for r in sorted(queued.where(F.col("source") == source).collect(), key=lambda r: (r.upto, -r.size)):
            upto += r.size
            assert r.upto == upto
            seen += 1
        assert seen == sum(x[3] == source for x in rows)


def test_mixed_documents(spark):
    rows = [(k, "w " * (k + 1), "en", "ab"[k % 2]) for k in range(20)] + [(None, "x y", None, None), (90, None, "en", "a")]
    mixed = mixing.mixed_documents(docs(spark, rows)).collect()
    assert [r.finish for r in mixed] == sorted(r.finish for r in mixed)
    assert all(r.taken == r.copies * len((r.text or "").split()) for r in mixed)
    for empty in (mixing.op9_mixing, mixing.mixed_documents):
        assert empty(docs(spark, [])).count() == 0


def test_rows_of_one_id_source_and_size_keep_their_texts(spark):
    texts = [f"{a} {b}" for a in "abc" for b in "xyz"]
    mixed = mixing.mixed_documents(docs(spark, [(None, t, "en", "a") for t in texts]), budget=(2, 1)).collect()
    assert sorted(r.text for r in mixed) == texts


def test_pipeline_stages_follow_on_each_other(spark, corpus):
    assert [name for name, _ in corpus_pipeline.STAGES][1] == "SimHash near-dedup"
    one, labels = corpus[0].where("doc_id < 240 OR doc_id > 900").drop("size", "finish", "label", "d2"), corpus[1]
    passage = " ".join(f"p{k}" for k in range(60))
    leak = " ".join(f"q{k}" for k in range(15))
    clean = one.where("doc_id = 4").first()["text"]
    more = spark.createDataFrame(
        [(1000, clean + " " + passage, "en", "s", 0), (1001, one.where("doc_id = 8").first()["text"] + " " + passage + " " + leak, "en", "s", 0),
         (1002, clean, "en", "s", 0)],
        one.schema,
    )
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/small"
    one.unionByName(more).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, folder).collect()
    texts = {r.doc_id: r.text for r in rows}
    assert 1002 not in texts and leak not in "".join(map(str, texts.values()))
    assert sum(passage in str(t) for t in texts.values()) <= 1
    assert not [i for i in texts if i < 240 and (i % 4 == 1 or i % 8 == 2)]
