"""Toxicity by a weighted lexicon.

Texts are folded first: look-alike letters of other scripts, full-width letters, accents left
alone, digits and signs inside words to the letters they stand for, single letters that are
spelled out with dots or dashes joined. Terms are beginnings of words or whole words; their weights are the log-odds of
documents that have them, learned from labelled rows. An Aho-Corasick automaton finds all terms of a
text in one pass. Hits inside an exception phrase don't count. The score is a logistic function of the
summed weights and of their sum divided by the length of the text, fitted on the same rows.

A null text or one without words has no hits and gets the score of a clean text. Without labelled rows of
both kinds the lexicon is empty and every score is 0. Whole texts are read. Other
columns are ignored; rows with the same text get the same score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadweld.llm.labelled import fold_of, training_rows
from quadweld.llm.tables import parts_of, tidy

#: Most labelled documents that weights are learned from.
TRAIN_DOCS = 12_000
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
#: Terms: letters of a beginning, least toxic documents, least log-odds.
SHORTEST, LONGEST, LEAST_DOCS, LEAST_ODDS = 4, 12, 4, 2.5
#: A beginning that one longer one matches in this share of documents gives way to it.
ALIKE = 0.9

#: Letters that look alike, and what digits and signs stand for inside words.
LOOK_ALIKE = str.maketrans(
    "аеорсухіјѕһԁԛԝвкмнтАЕОРСУХІЈЅВКМНТαορνικτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijshdqwbkmhtaeopcyxijsbkmhtaopviktuxabezhikmnoptyx",
)
DIGITS = str.maketrans("0134578@$", "oieastbas")
#: Harmless phrases around words that may be insults.
EXCEPTIONS = (
    "trash can",
    "trash bin",
    "trash bag",
    "trash collection",
    "clown fish",
    "clown car",
    "class clown",
    "idiot proof",
    "sore loser",
    "pond scum",
    "soap scum",
)

_WORD = re.compile(r"[^\W_]+")
#: A run of letters, digits and signs with a digit or sign; it is looked for from the start of runs only.
_SIGNED = re.compile(r"(?<![\w@$])[^\W0-9]*+[0-9@$][\w@$]*+")
_SIGN = re.compile(r"[0-9@$]")
_LETTER = re.compile(r"[^\W\d_]")
_SPELLED = re.compile(r"\b[^\W\d_](?:([.\-_*])[^\W\d_](?:\1[^\W\d_])+)\b")


def _written_out(match: re.Match) -> str:
    """The run with letters for digits and signs: those before its last letter, or else those behind it."""
    run, last = match[0], -1
    for last in (m.start() for m in _LETTER.finditer(run)):
        pass
    if last < 0:
        return run
    end = last + 1 if _SIGN.search(run, 0, last) else len(run)
    return run[:end].translate(DIGITS) + run[end:]


def fold(text: str) -> str:
    """Lower case with look-alikes replaced and disguised words written out."""
    text = text.lower()
    if not text.isascii():
        text = text.translate(LOOK_ALIKE)
        # Full-width and mathematical letters have plain compatibility forms.
        if any(c > "⿿" for c in text):
            text = unicodedata.normalize("NFKC", text).lower()
        text = text.replace("​", "").replace("­", "")
    if any(c in text for c in "0134578@$"):
        text = _SIGNED.sub(_written_out, text)
    if _SPELLED.search(text):
        text = _SPELLED.sub(lambda m: re.sub(r"[.\-_*]", "", m[0]), text)
    return text


def candidate_terms(text: str) -> set[str]:
    """Beginnings of words, and whole words with a closing mark."""
    found = set()
    for word in set(_WORD.findall(fold(text))):
        if len(word) >= 3:
            found.add(word + "$")
            found.update(word[:k] for k in range(SHORTEST, min(len(word), LONGEST) + 1))
    return found


def term_counts(rows: DataFrame) -> DataFrame:
    """Per candidate term the toxic and the other documents that have it."""

    def run(batches):
        for batch in batches:
            terms, labels = [], []
            for text, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = candidate_terms(text or "")
                terms += found
                labels += [label] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(labels, pa.int32())], names=["term", "label"])

    return (
        rows.mapInArrow(run, "term string, label int")
        .groupBy("term")
        .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    )


def chosen_terms(counted: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Terms with weights; of nested ones the shortest that isn't as good as one longer."""
    hits = {t: a for t, a, _ in counted}
    weights = {
        t: math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1)) for t, a, b in counted
    }
    best_longer: dict[str, int] = {}
    for term, n in hits.items():
        shorter = term[:-1]
        if shorter in hits:
            best_longer[shorter] = max(best_longer.get(shorter, 0), n)
    chosen: dict[str, float] = {}
    for term in sorted(weights, key=lambda t: (len(t), t)):
        if weights[term] < LEAST_ODDS or any(term[:k] in chosen for k in range(SHORTEST, len(term))):
            continue
        if best_longer.get(term, 0) < ALIKE * hits[term]:
            chosen[term] = weights[term]
    return chosen


class Lexicon:
    """Terms, exceptions and the two coefficients and intercept of the score."""

    def __init__(self, terms: dict[str, float], exceptions=EXCEPTIONS):
        self.terms, self.exceptions = terms, exceptions
        self.coefficients: np.ndarray | None = None

    def automaton(self):
        made = ahocorasick.Automaton()
        for phrase in self.exceptions:
            made.add_word(" " + phrase + " ", (len(phrase) + 2, None, False))
        for term, weight in self.terms.items():
            word = " " + (term[:-1] + " " if term.endswith("$") else term)
            made.add_word(word, (len(word), weight, True))
        if len(made):
            made.make_automaton()
        return made

    @staticmethod
    def features(automaton, text: str | None) -> tuple[float, float, int]:
        """Summed weight, summed weight by hundred words, number of words."""
        if not text:
            return 0.0, 0.0, 0
        words = _WORD.findall(fold(text))
        if not words or not len(automaton):
            return 0.0, 0.0, len(words)
        spared: list[tuple[int, int]] = []
        hits: list[tuple[int, int, float]] = []
        for end, (size, weight, is_term) in automaton.iter(" " + " ".join(words) + " "):
            if is_term:
                hits.append((end - size + 1, end, weight))
            else:
                spared.append((end - size + 1, end))
        # Of the spared spans that begin before a hit, the one that ends last covers it or none does.
        spared.sort()
        starts, ends = [s for s, _ in spared], list(accumulate((e for _, e in spared), max))
        total = 0.0
        for a, b, weight in hits:
            k = bisect_right(starts, a)
            if not k or ends[k - 1] < b:
                total += weight
        return total, 100 * total / (len(words) + 50), len(words)

    def score(self, totals: np.ndarray) -> np.ndarray:
        if self.coefficients is None:
            return np.zeros(len(totals))
        return 1 / (1 + np.exp(-np.clip(_inputs(totals) @ self.coefficients, -30, 30)))


def _inputs(totals: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(totals)), np.log1p(totals)])


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> np.ndarray:
    """Newton's method; the intercept is not penalised."""
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(x.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - ridge @ w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, gradient)
    return w


def learn(docs: DataFrame, labels: DataFrame, at_most: int = TRAIN_DOCS) -> Lexicon:
    """Terms and score from labelled rows outside the held-out fold."""
    rows = training_rows(docs, labels, "toxic", FOLDS, HELD_OUT, at_most)
    sums = rows.agg(F.sum("label"), F.count(F.lit(1))).first()
    toxic, n = sums[0] or 0, sums[1]
    if not 0 < toxic < n:
        return Lexicon({})
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (n - toxic + 1))
    # Words of toxic documents alone come back, of a sample of bounded size.
    counted = term_counts(rows).where((F.col("toxic") >= LEAST_DOCS) & (odds >= LEAST_ODDS))
    lexicon = Lexicon(chosen_terms([tuple(r) for r in counted.collect()], toxic, n - toxic))
    measured = _measured(rows.select("doc_id", "text", "label"), lexicon, ["label"])
    pairs = np.array([tuple(r) for r in measured.select("total", "rate", "label").collect()], float)
    lexicon.coefficients = logistic(_inputs(pairs[:, :2]), pairs[:, 2])
    return lexicon


def _measured(rows: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with summed weight, weight by length and score."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)
    kept = rows.select("text", *keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[1:])

    def run(batches):
        lexicon = shared.value
        automaton = lexicon.automaton()
        for batch in parts_of(batches, 0):
            found = [lexicon.features(automaton, t.as_py()) for t in batch.column(0)]
            totals = np.array([f[:2] for f in found], float).reshape(-1, 2)
            made = [pa.array(totals[:, 0].copy()), pa.array(totals[:, 1].copy()), pa.array(lexicon.score(totals))]
            rest = [batch.column(i) for i in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*rest, *made], names=[*keep, "total", "rate", "score"])

    return kept.mapInArrow(tidy(run), f"{fields}, total double, rate double, score double")


def score(docs: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    return _measured(docs, lexicon, keep)


def op4_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, learn(docs, labels), ["doc_id"])
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
