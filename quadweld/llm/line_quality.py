"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. What speaks for either are features of the line and of the lines before and
after it, and what the neighbouring lines are. Forward and backward passes give each line its
marginal probability of being good; a document's quality is their mean, weighted by line
length. Weights are learned by gradient ascent from a bounded sample of labelled documents, whose lines
take the label of the document.

A null text or one without words has quality 0. Without labelled rows of both kinds every other
document has quality 1. Whole texts are scored, however many lines they have. Other columns pass or are ignored; rows with the
same text get the same quality.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadweld.llm.labelled import fold_of, training_rows
from quadweld.llm.tables import fresh, parts_of, tidy

#: Most labelled documents, and lines of one of them, that weights are learned from.
TRAIN_DOCS, TRAIN_LINES = 3_000, 100
FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.5
STEPS, RATE, PENALTY = 150, 0.15, 1.0

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>~^=+@\\{}[]_"
_SHOUTS = b"!?"
_POINTS = b".,;:"
WIDTH = 13


def line_features(line: bytes, times: int) -> list[float]:
    """About the line by itself; ``times`` is how often the document has it."""
    words = line.split()
    n, size = len(words), sum(map(len, words))
    count = lambda signs: len(line) - len(line.translate(None, signs))
    letters = count(_LETTERS)
    return [
        min(n, 200) ** 0.5 / 5,
        min(size / n, 20) / 6,
        letters / size,
        count(_UPPER) / max(letters, 1),
        min(1.0, 2 * count(_DIGITS) / size),
        min(2.0, 2 * count(_SYMBOLS) / n),
        min(2.0, 2 * count(_SHOUTS) / n),
        min(1.0, 2 * count(_POINTS) / n),
        len(set(words)) / n,
        2 * sum(map(eq, words, words[1:])) / n,
        float(times > 1),
        float(words[-1][-1:] in b".!?:"),
        float(n < 3),
    ]


#: Lines whose features are held at once, and lines of documents that pass through the chain together.
LINES, LINES_TOGETHER = 4_096, 50_000


def document_lines(text: bytes | None, at_most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features (with those of both neighbours) and lengths of the lines that have words, some thousand lines at a time."""
    lines = [x for x in text.split(b"\n") if x.split()] if text else []
    times = Counter(lines)
    end = len(lines) if at_most is None else min(at_most, len(lines))
    for first in range(0, end, LINES):
        last = min(first + LINES, end)
        # One line more on either side, or an empty edge.
        own = np.zeros((last - first + 2, WIDTH))
        for k in range(max(first - 1, 0), min(last + 1, len(lines))):
            own[k - first + 1] = line_features(lines[k], times[lines[k]])
        features = np.hstack([own[1:-1], own[:-2], own[2:], np.ones((last - first, 1))])
        yield features, np.array([len(x) for x in lines[first:last]], float)


def all_lines(text: bytes | None, at_most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The same in one piece, for the first ``at_most`` lines."""
    parts = list(document_lines(text, at_most))
    if not parts:
        return np.empty((0, 3 * WIDTH + 1)), np.empty(0)
    return np.vstack([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


class Chain:
    """Two labels; ``w`` weighs features for good, ``t`` the step from one label to the next."""

    def __init__(self, dims: int):
        self.w, self.t = np.zeros(dims), np.zeros((2, 2))

    def potentials(self, x: np.ndarray) -> np.ndarray:
        """What the features of lines say for good."""
        return np.clip(x @ self.w, -30, 30)

    def marginals(self, u: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """Probability of good for every line, and the expected steps between labels.

        Documents are the potentials ``u[starts[i] : starts[i] + sizes[i]]``; all go forward, then back, together.
        """
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        local = np.stack([1 / (1 + np.exp(u)), 1 / (1 + np.exp(-u))], axis=1)
        step = np.exp(self.t)
        alpha, beta = np.empty_like(local), np.ones_like(local)
        # Documents are sorted by size, so those with a line ``k`` are the first ``active[k]``.
        longest = int(sizes.max(initial=0))
        active = np.searchsorted(-sizes, -np.arange(longest), "left")
        for k in range(longest):
            at = starts[: active[k]] + k
            here = local[at] if k == 0 else local[at] * (alpha[at - 1] @ step)
            alpha[at] = here / here.sum(axis=1, keepdims=True)
        pairs = np.zeros((2, 2))
        for k in range(longest - 2, -1, -1):
            at = starts[: active[k + 1]] + k
            after = local[at + 1] * beta[at + 1]
            back = after @ step.T
            joint = alpha[at][:, :, None] * step * after[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            beta[at] = back / back.sum(axis=1, keepdims=True)
        good = alpha * beta
        return good[:, 1] / good.sum(axis=1), pairs

    def fit(self, x, y, starts, sizes, steps=STEPS, rate=RATE, penalty=PENALTY) -> Chain:
        """Gradient ascent on the mean log-likelihood, with running scales of the gradient."""
        inner = np.ones(len(y), bool)
        inner[starts[sizes > 0]] = False
        at = np.flatnonzero(inner)
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[at - 1], y[at]), 1)
        mean, square = np.zeros(len(self.w) + 4), np.zeros(len(self.w) + 4)
        for k in range(1, steps + 1):
            good, pairs = self.marginals(self.potentials(x), starts, sizes)
            theta = np.concatenate([self.w, self.t.ravel()])
            gradient = np.concatenate([x.T @ (y - good), (seen - pairs).ravel()]) - penalty * theta
            gradient /= len(y)
            mean = 0.9 * mean + 0.1 * gradient
            square = 0.99 * square + 0.01 * gradient**2
            theta = theta + rate * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
            self.w, self.t = theta[:-4], theta[-4:].reshape(2, 2)
        return self


def learn(docs: DataFrame, labels: DataFrame, at_most: int = TRAIN_DOCS) -> Chain | None:
    """A chain from labelled rows outside the held-out fold; features alone come to the driver."""
    rows = training_rows(docs, labels, "quality", FOLDS, HELD_OUT, at_most)

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = [all_lines(t, TRAIN_LINES)[0].astype(np.float32).ravel() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([f.tobytes() for f in found], pa.binary())],
                names=["doc_id", "label", "x"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    sample = rows.mapInArrow(run, f"doc_id {id_type}, label int, x binary").orderBy("doc_id", "x").collect()
    parts = [np.frombuffer(bytes(r["x"]), np.float32).reshape(-1, 3 * WIDTH + 1).astype(float) for r in sample]
    held = [(p, r["label"]) for p, r in zip(parts, sample, strict=True) if len(p)]
    if len({label for _, label in held}) < 2:
        return None
    sizes = np.array([len(p) for p, _ in held])
    y = np.repeat(np.array([label for _, label in held]), sizes)
    return Chain(3 * WIDTH + 1).fit(np.vstack([p for p, _ in held]), y, np.cumsum(sizes) - sizes, sizes)


def qualities(chain: Chain | None, texts: Iterable[bytes | None]) -> Iterator[float]:
    """Quality of each text; the lines of many pass through the chain together, with one potential a line."""
    potentials, lengths, sizes, held = [np.empty(0)], [np.empty(0)], [], 0

    def flush() -> list[float]:
        size = np.array(sizes, np.int64)
        u, length = np.concatenate(potentials), np.concatenate(lengths)
        starts = np.cumsum(size) - size
        good = np.ones(len(u)) if chain is None else chain.marginals(u, starts, size)[0]
        out, some = np.zeros(len(size)), np.flatnonzero(size)
        if len(some):
            out[some] = np.add.reduceat(good * length, starts[some]) / np.add.reduceat(length, starts[some])
        return out.tolist()

    for text in texts:
        n = 0
        for features, length in document_lines(text):
            potentials.append(np.zeros(len(length)) if chain is None else chain.potentials(features))
            lengths.append(length)
            n += len(length)
        sizes.append(n)
        held += n
        if held >= LINES_TOGETHER or len(sizes) >= LINES_TOGETHER:
            yield from flush()
            potentials, lengths, sizes, held = [np.empty(0)], [np.empty(0)], [], 0
    yield from flush()


def score(docs: DataFrame, chain: Chain | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` and the quality of the text, last, as ``_quality`` unless there is such a column."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    quality, text = fresh(docs.columns, "_quality", "_text")
    rows = docs.select(*keep, F.col("text").alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    at = len(keep)

    def run(batches):
        for part in parts_of(batches, at):
            texts = (t.as_buffer().to_pybytes() if t.is_valid else None for t in part.column(at))
            made = pa.array(list(qualities(shared.value, texts)), pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns[:at], made], names=[*keep, quality])

    return rows.mapInArrow(tidy(run), f"{fields}, {quality} double")


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents of at least that quality; the columns of ``docs``."""
    scored = score(docs, learn(docs, labels), docs.columns)
    return scored.where(F.col(scored.columns[-1]) >= threshold).select(*docs.columns)


def op6_line_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, learn(docs, labels), ["doc_id"])
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        F.col("_quality").alias("score"),
        (F.col("_quality") >= THRESHOLD).cast("int").alias("predicted"),
    )
