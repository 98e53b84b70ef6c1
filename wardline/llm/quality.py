"""Document quality from lines: a linear-chain conditional random field labels every line good or bad."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.words import bounded, held_out

#: Learning reads about so many documents of either label at most.
SAMPLE = 1_500
STEPS, RATE, PENALTY = 200, 0.1, 1e-3

#: Classes of bytes whose shares describe a line.
UPPER, LOWER, DIGIT, SPACE, STOP, BANG, BAR, OTHER = range(8)


def _kind(byte: int) -> int:
    char = chr(byte)
    if byte >= 128 or "a" <= char <= "z":
        return LOWER
    if "A" <= char <= "Z":
        return UPPER
    if char.isdigit():
        return DIGIT
    if char.isspace():
        return SPACE
    return {".": STOP, ",": STOP, "!": BANG, "?": BANG, "|": BAR}.get(char, OTHER)


KIND = np.array([_kind(x) for x in range(256)], np.uint8)
#: Features of a line alone; those from the line before and after follow, with two marks for the edges and a constant.
OWN = 14
FEATURES = 3 * OWN + 3


def lines_of(text: str) -> list[str]:
    """Lines with anything but white space; a text has them whole, however long."""
    return [x for x in text.split("\n") if x and not x.isspace()]


def features(docs: list[list[str]]) -> np.ndarray:
    """A row per line of these documents, each between 0 and 1."""
    lines = [line for doc in docs for line in doc]
    if not lines:
        return np.zeros((0, FEATURES))
    encoded = [line.encode() for line in lines]
    size = np.fromiter(map(len, encoded), np.int64, len(encoded))
    starts = np.cumsum(size) - size
    kind = KIND[np.frombuffer(b"".join(encoded), np.uint8)]
    share = np.stack([np.add.reduceat(kind == k, starts, dtype=np.int64) / size for k in range(8)], axis=1)
    own = np.zeros((len(lines), OWN))
    own[:, :8] = share
    letters = share[:, UPPER] + share[:, LOWER]
    own[:, 8] = share[:, UPPER] / np.maximum(letters, 1e-9)
    own[:, 9] = np.minimum(np.log1p(size) / 12, 1)
    at = 0
    for doc in docs:
        seen: set[str] = set()
        for line in doc:
            found = line.split()
            distinct = len(set(found))
            own[at, 10] = distinct / len(found)
            own[at, 11] = min(len(found) / 200, 1)
            own[at, 12] = min(size[at] / len(found) / 40, 1)
            own[at, 13] = line in seen
            seen.add(line)
            at += 1
    first = np.zeros(len(lines), bool)
    counts = np.array([len(doc) for doc in docs if doc])
    first[np.cumsum(counts) - counts] = True
    last = np.roll(first, -1)
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[last] = 0, 0
    return np.column_stack([own, before, after, first, last, np.ones(len(lines))])


def marginals(
    good: np.ndarray, lengths: np.ndarray, steps: np.ndarray, weight: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once, in log space.

    `good` is each line's log potential of being good (bad: 0), chains follow one another with
    `lengths` lines (1 or more), `steps` are the 2 x 2 log potentials of neighbours. Returns P(good)
    by line and the expected number of neighbours by pair of labels, chains weighted by `weight`.
    """
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    long = lengths[order]
    alive = [int(np.searchsorted(-long, -t, "left")) for t in range(int(long[0]) if len(long) else 0)]
    node = np.stack([np.zeros(len(good)), good], axis=1)
    ahead, back = np.zeros_like(node), np.zeros_like(node)
    for t, n in enumerate(alive):
        at = begin[:n] + t
        ahead[at] = node[at]
        if t:
            ahead[at] += np.logaddexp(ahead[at - 1, :1] + steps[0], ahead[at - 1, 1:] + steps[1])
    pairs = np.zeros((2, 2))
    total = np.zeros(len(lengths))
    weight = np.ones(len(lengths)) if weight is None else weight
    end = begin + long - 1
    total[order] = np.logaddexp(ahead[end, 0], ahead[end, 1])
    for t in range(len(alive) - 1, 0, -1):
        at = begin[: alive[t]] + t
        arriving = node[at] + back[at]
        back[at - 1] = np.logaddexp(steps[:, 0] + arriving[:, :1], steps[:, 1] + arriving[:, 1:])
        joint = ahead[at - 1, :, None] + steps + arriving[:, None, :] - total[order[: alive[t]], None, None]
        pairs += np.tensordot(weight[order[: alive[t]]], np.exp(joint), 1)
    both = ahead + back
    return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700))), pairs


@dataclass
class Field:
    weights: np.ndarray
    steps: np.ndarray
    #: Intercept and slope from the length-weighted marginal (as log odds) to log odds of the document.
    scale: np.ndarray

    def document(self, rows: np.ndarray, docs: list[list[str]]) -> np.ndarray:
        """Length-weighted mean of the lines' P(good) by document, 0.5 if it has no lines."""
        counts = np.array([len(doc) for doc in docs], np.int64)
        result = np.full(len(docs), 0.5)
        if counts.any():
            good, _ = marginals(rows @ self.weights, counts[counts > 0], self.steps)
            size = np.fromiter((len(line) for doc in docs for line in doc), np.float64, len(good))
            owner = np.repeat(np.arange(len(docs)), counts)
            total = np.bincount(owner, size, len(docs))
            some = total > 0
            result[some] = np.bincount(owner, size * good, len(docs))[some] / total[some]
        return result

    def score(self, docs: list[list[str]]) -> np.ndarray:
        mean = np.clip(self.document(features(docs), docs), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.scale[0] + self.scale[1] * np.log(mean / (1 - mean)))))


def fit(docs: list[list[str]], labels: np.ndarray) -> Field:
    """Gradient ascent (Adam) on the conditional likelihood, every line bearing its document's label."""
    rows = features(docs)
    counts = np.array([len(doc) for doc in docs], np.int64)
    some = counts > 0
    weights, steps = np.zeros(FEATURES), np.zeros((2, 2))
    if not len(rows) or len(set(labels[some])) < 2:
        return Field(weights, steps, np.array([0.0, 1.0]))
    # a document counts as one, however many lines it has, and both labels count alike
    weight = np.where(labels == 1, 0.5 / max((labels == 1).sum(), 1), 0.5 / max((labels == 0).sum(), 1))
    weight = (weight / np.maximum(counts, 1))[some]
    chains, line_weight = counts[some], np.repeat(weight, counts[some])
    truth = np.repeat(labels, counts).astype(float)
    charted = np.diag([(weight * (chains - 1))[labels[some] == y].sum() for y in (0, 1)])
    first, second = np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)
    for t in range(1, STEPS + 1):
        good, pairs = marginals(rows @ weights, chains, steps, weight)
        slope = rows.T @ (line_weight * (truth - good)) - PENALTY * weights
        slope = np.concatenate([slope, (charted - pairs - PENALTY * steps).ravel()])
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        weights, steps = weights + move[:FEATURES], steps + move[FEATURES:].reshape(2, 2)
    field = Field(weights, steps, np.array([0.0, 1.0]))
    mean = np.clip(field.document(rows, docs), 1e-6, 1 - 1e-6)
    field.scale = logistic(np.log(mean / (1 - mean)), labels)
    return field


def logistic(x: np.ndarray, labels: np.ndarray, steps: int = 50) -> np.ndarray:
    """Intercept and slope of P(label 1) given x, towards slightly softened labels so that both stay finite."""
    positive = (labels == 1).sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (len(labels) - positive + 2))
    design = np.column_stack([np.ones(len(x)), x])
    scale = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ scale, -30, 30)))
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        scale = scale + np.clip(np.linalg.solve(curve, design.T @ (target - p)), -2, 2)
    return scale


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """From `labels.quality` of documents that are not held out; null labels and ids teach nothing."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = bounded(known.select("doc_id", "quality").dropDuplicates(["doc_id"]), "quality", sample)
    taught = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("doc_id", "quality", "text")
    rows = taught.orderBy("doc_id").toArrow()
    texts = [lines_of(x or "") for x in rows.column("text").to_pylist()]
    return fit(texts, rows.column("quality").to_numpy())


def predictor(field: Field, spark: SparkSession) -> Callable[[Column], Column]:
    """A column function: text to the probability that its quality is 1.

    A null or empty text, or one of white space, has no lines: its mean is 0.5.
    """
    parts = (field.weights, field.steps, field.scale)

    @F.pandas_udf("double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Field(*parts)
        for texts in batches:
            scores = []
            for at in range(0, len(texts), 128):
                scores.append(known.score([lines_of(x or "") for x in texts.iloc[at : at + 128]]))
            yield pd.Series(np.concatenate(scores) if scores else np.zeros(0))

    return predicted


def rate(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted.

    Rows with a null or repeated id are scored like any other; without labels of both kinds every
    score is 0.5; an empty table gives no rows; extra columns are not read.
    """
    score = predictor(learn(docs, labels, sample), docs.sparkSession)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
