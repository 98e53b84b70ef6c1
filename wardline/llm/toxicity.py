"""Toxicity: maximum-scoring segments of token log-odds, aggregated by extreme-value calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import astuple, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.quality import logistic
from wardline.llm.shared import drop, store
from wardline.llm.words import Remembered, bounded, held_out, texts, words

#: Learning reads about so many documents of either label at most.
SAMPLE = 4_000
#: Lengths in bytes of the beginnings that lend a word their evidence.
BEGINNINGS = (4, 7)
#: Pseudo-documents of a word's prior, and what is taken off every token's log-odds so that clean text
#: sinks: with more to learn from stronger ones do better. The halves of the sample choose.
CHOICES = ((1.0, 0.5), (1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (5.0, 1.0), (5.0, 2.0))
#: A passage counts as toxic if chance gives so many as good in a document of that length.
SIGNIFICANT = 0.05
BINS = np.linspace(-8, 8, 129)


def keys(word: bytes) -> list[bytes]:
    """From the shortest beginning to the word itself."""
    return [word[:n] + b"*" for n in BEGINNINGS if n < len(word)] + [word]


@dataclass
class Odds:
    """Log-odds of words by the documents that hold them.

    The prior of a word is a Dirichlet centred on the odds of its longest known beginning, whose
    own prior is centred on the next shorter one, and so on to even odds.
    """

    #: Per key: toxic documents, and other documents scaled to as many.
    counts: dict[bytes, tuple[float, float]]
    strength: float
    drift: float

    def score(self, word: bytes) -> float:
        share = 0.5
        for key in keys(word):
            toxic, other = self.counts.get(key, (0.0, 0.0))
            share = (toxic + self.strength * share) / (toxic + other + self.strength)
        return float(np.log(share / (1 - share))) - self.drift


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, in linear time.

    Only positive scores begin or end one. `left` leads each candidate to the nearest one before it
    whose sum up to its start is lower, so none is looked at in vain twice.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[int, int, float, float]] = []
    left: list[int] = []
    for i in np.flatnonzero(scores > 0).tolist():
        start, low, high = i, sums[i], sums[i + 1]
        at = len(found) - 1
        while True:
            while at >= 0 and found[at][2] >= low:
                at = left[at]
            if at < 0 or found[at][3] >= high:
                break
            start, low = found[at][0], found[at][2]
            del found[at:], left[at:]
            at = len(found) - 1
        found.append((start, i + 1, low, high))
        left.append(at)
    return [(start, end, float(high - low)) for start, end, low, high in found]


@dataclass
class Model:
    counts: dict[bytes, tuple[float, float]]
    choice: tuple[float, float] = CHOICES[0]
    #: Of chance segments: P(best score >= s) = 1 - exp(-size * tokens * exp(-decay * s)).
    decay: float = 1.0
    size: float = 1.0
    scale: np.ndarray = field(default_factory=lambda: np.zeros(2))

    def memory(self) -> Remembered:
        return Remembered(Odds(self.counts, *self.choice).score, 1)

    def normal(self, scores: np.ndarray, tokens: int) -> np.ndarray:
        """Scores of segments less what chance gives in a text of so many tokens; exp(-x) are expected to reach x."""
        return self.decay * scores - np.log(self.size * max(tokens, 1))

    def surprise(self, scores: np.ndarray, tokens: int) -> float:
        """Minus the log of the chance of the best segments of a text, for the number of them that makes it least.

        The chance that the r best sum to x (all in normal form) is exp(-x) x^(r-1) / (r! (r-1)!); trying
        several r costs a factor of 2 for each.
        """
        best = np.sort(self.normal(scores, tokens))[::-1]
        if not len(best):
            return float(self.normal(np.zeros(1), tokens)[0])
        total = np.cumsum(best)
        r = np.arange(1, len(best) + 1)
        log_factorial = np.cumsum(np.log(r))
        chance = (r - 1) * np.log(np.maximum(total, 1e-9)) - total - 2 * log_factorial + np.log(r)
        several = np.where((total > 0) & (r > 1), -chance - r * np.log(2), -np.inf)
        return float(np.clip(max(best[0], several.max()), -30, 60))

    def calibrated(self, seen: pd.DataFrame, choice: tuple[float, float]) -> tuple[float, Model]:
        """(log loss, model) with decay, size and scale from documents scored by the half they are not in."""
        model = Model(self.counts, choice)
        clean = seen[seen.toxic == 0]
        chance = np.stack(clean.histogram).sum(axis=0).astype(float)
        model.decay = decay(chance / max(chance.sum(), 1), (BINS[1:] + BINS[:-1]) / 2)
        best = clean.segments.map(lambda x: x.max(initial=0.0))
        model.size = len(clean) / max(sum(np.sort(np.maximum(clean.tokens, 1) * np.exp(-model.decay * best))), 1e-9)
        surprise = np.array([model.surprise(x, n) for x, n in zip(seen.segments, seen.tokens, strict=True)])
        toxic = seen.toxic.to_numpy()
        order = np.lexsort((surprise, toxic))  # the same sums whatever order the rows came in
        surprise, toxic = surprise[order], toxic[order]
        model.scale = logistic(surprise, toxic)
        given = np.clip(np.where(toxic == 1, model.probability(surprise), 1 - model.probability(surprise)), 1e-9, 1)
        return float(-np.log(given).mean()), model

    def probability(self, surprise: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale[0] + self.scale[1] * surprise)))


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, fold, toxic, docs) of one task."""
    found: Counter[tuple[bytes, int, int]] = Counter()
    for some, rows in texts(batches):
        marks = zip(some, rows.column("fold").to_pylist(), rows.column("toxic").to_pylist(), strict=True)
        for text, fold, toxic in marks:
            found.update((key, fold, toxic) for key in {key for word in set(words(text)) for key in keys(word)})
    parts = list(zip(*found, strict=True)) or [(), (), ()]
    kinds = (pa.binary(), pa.int32(), pa.int32())
    columns = [pa.array(x, kind) for x, kind in zip(parts, kinds, strict=True)]
    yield pa.RecordBatch.from_arrays(
        [*columns, pa.array(found.values(), pa.int64())], ["key", "fold", "toxic", "docs"]
    )


def segments_of(memory: Remembered, text: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Tokens of a text, the scores of its segments, and the scores of its tokens."""
    found = words(text)
    scores = memory.of(found)[:, 0]
    return len(found), np.array([score for _, _, score in segments(scores)]), scores


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """From `labels.toxic` of documents that are not held out; null labels and ids teach nothing.

    Token odds of either half of the sample score the other half, which calibrates the model; the
    model itself takes its odds from both.
    """
    spark = docs.sparkSession
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = bounded(known.select("doc_id", "toxic").dropDuplicates(["doc_id"]), "toxic", sample)
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(2)).cast("int").alias("fold")
    taught = store(
        docs.select("doc_id", "text")
        .join(F.broadcast(known), "doc_id")
        .select("text", F.col("toxic").cast("int").alias("toxic"), fold)
        .repartition(spark.sparkContext.defaultParallelism),
        "toxic-sample",
    )
    sizes = np.zeros((2, 2))
    for row in taught.groupBy("fold", "toxic").count().collect():
        sizes[row["fold"], row["toxic"]] = row["count"]

    def of(fold: int, toxic: int) -> Column:
        return F.sum(F.when((F.col("fold") == fold) & (F.col("toxic") == toxic), F.col("docs")).otherwise(0))

    counts = (
        taught.mapInArrow(counted, "key binary, fold int, toxic int, docs long")
        .groupBy("key")
        .agg(*[of(f, t).alias(f"n{f}{t}") for f in (0, 1) for t in (0, 1)])
        .where("n01 + n11 >= 2 or n00 + n10 >= 10")
        .toArrow()
    )
    key = counts.column("key").to_pylist()
    n = np.array([[counts.column(f"n{f}{t}").to_numpy() for t in (0, 1)] for f in (0, 1)], float)

    def odds(folds: list[int]) -> dict[bytes, tuple[float, float]]:
        docs_of = sizes[folds].sum(axis=0)
        toxic, other = n[folds, 1].sum(axis=0), n[folds, 0].sum(axis=0) * docs_of[1] / max(docs_of[0], 1)
        return {k: (x, y) for k, x, y in zip(key, toxic.tolist(), other.tolist(), strict=True) if x or y}

    model = Model(odds([0, 1]))
    if not sizes.sum(axis=0).all():
        return model
    halves = spark.sparkContext.broadcast([odds([1]), odds([0])])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = [[Remembered(Odds(x, *choice).score, 1) for x in halves.value] for choice in CHOICES]
        for some, rows in texts(batches):
            out = []
            marks = zip(some, rows.column("fold").to_pylist(), rows.column("toxic").to_pylist(), strict=True)
            for text, fold, toxic in marks:
                for choice, of_choice in enumerate(memory):
                    tokens, of_segments, scores = segments_of(of_choice[fold], text)
                    histogram = np.histogram(np.clip(scores, -8, 8), BINS)[0]
                    out.append((toxic, choice, tokens, of_segments, histogram))
            names = ["toxic", "choice", "tokens", "segments", "histogram"]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64())]
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names
            )

    schema = "toxic int, choice int, tokens long, segments array<double>, histogram array<long>"
    seen = taught.mapInArrow(scored, schema).toArrow().to_pandas()
    drop(taught)
    tried = [model.calibrated(seen[seen.choice == i], choice) for i, choice in enumerate(CHOICES)]
    return min(tried, key=lambda x: x[0])[1]


def decay(share: np.ndarray, score: np.ndarray) -> float:
    """The positive root of E[exp(decay * score)] = 1 over the tokens of clean text; 1 if there is none."""
    if not (share[score > 0] > 0).any() or share @ score >= 0:
        return 1.0
    share, score = share[share > 0], score[share > 0]
    low, high = 0.0, 1.0
    while share @ np.exp(high * score) < 1:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if share @ np.exp(middle * score) < 1 else (low, middle)
    return max((low + high) / 2, 1e-3)


def predictor(model: Model, spark: SparkSession) -> Callable[[Column], Column]:
    """A column function: text to the probability that it is toxic. Null and empty texts have no tokens."""
    spread = spark.sparkContext.broadcast(astuple(model))

    @F.pandas_udf("double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Model(*spread.value)
        memory = known.memory()
        for some in batches:
            found = [segments_of(memory, text or "") for text in some]
            yield pd.Series(known.probability(np.array([known.surprise(x, tokens) for tokens, x, _ in found])))

    return predicted


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """Every significant toxic passage: doc_id, start, length (in words), words, score, chance.

    `chance` is the expected number of segments as good in clean text of the document's length.
    """
    spread = docs.sparkSession.sparkContext.broadcast(astuple(model))
    kind = docs.schema["doc_id"].dataType

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*spread.value)
        memory = known.memory()
        for some, rows in texts(batches):
            out = []
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), some, strict=True):
                tokens = words(text)
                for start, end, score in segments(memory.of(tokens)[:, 0]):
                    chance = float(np.exp(-known.normal(np.array(score), len(tokens))))
                    if chance <= SIGNIFICANT:
                        passage = b" ".join(tokens[start:end]).decode()
                        out.append((doc_id, start, end - start, passage, score, chance))
            names = ["doc_id", "start", "length", "words", "score", "chance"]
            kinds = [rows.column("doc_id").type, pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64()]
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, of) for x, of in zip(columns, kinds, strict=True)], names
            )

    schema = f"doc_id {kind.simpleString()}, start long, length long, words string, score double, chance double"
    return docs.select("doc_id", "text").mapInArrow(found, schema)


def rate(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted (1 from a score of 0.7).

    Rows with a null or repeated id are scored like any other; without labels of both kinds every
    score is 0.5; an empty table gives no rows; extra columns are not read.
    """
    score = predictor(learn(docs, labels, sample), docs.sparkSession)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
