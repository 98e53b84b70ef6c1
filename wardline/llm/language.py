"""Language identification: whole words first, shorter and shorter character n-grams for unseen ones."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.words import Remembered, bounded, held_out, texts, words

#: Learning reads about so many documents of a language at most.
SAMPLE = 2_000
#: Length of the longest n-grams, in bytes; words have a mark at either end.
LONGEST = 5
#: Added to every count.
SMOOTHING = 0.1
#: Words whose evidence makes a prediction as sure as it can get.
ENOUGH = 20
LETTER = re.compile(r"[^\W\d_]")
UNDETERMINED = "und"


def grams(word: bytes, n: int) -> list[bytes]:
    marked = b"<" + word + b">"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, n, part, count) of one task: words have n = 0, n-grams their length."""
    found: Counter[tuple[str, bytes]] = Counter()
    for some, rows in texts(batches):
        for text, lang in zip(some, rows.column("lang").to_pylist(), strict=True):
            found.update((lang, word) for word in words(text))
    parts: Counter[tuple[str, int, bytes]] = Counter()
    for (lang, word), count in found.items():
        parts[lang, 0, word] += count
        for n in range(1, LONGEST + 1):
            for gram in grams(word, n):
                parts[lang, n, gram] += count
    langs, lengths, keys = zip(*parts, strict=True) if parts else ((), (), ())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(langs, pa.string()),
            pa.array(lengths, pa.int32()),
            pa.array(keys, pa.binary()),
            pa.array(parts.values(), pa.int64()),
        ],
        ["lang", "n", "part", "count"],
    )


@dataclass
class Model:
    langs: list[str]
    #: By length (0: words): log frequency of each part in each language.
    tables: list[dict[bytes, np.ndarray]]

    def score(self, word: bytes) -> np.ndarray:
        """Log frequency of a word by language.

        A word no language knows counts as the n-grams that cover it: from each place the longest
        known one, so that the length falls where it must.
        """
        if word in self.tables[0]:
            return self.tables[0][word]
        total, steps, at = np.zeros(len(self.langs)), 0, 0
        marked = b"<" + word + b">"
        while at < len(marked):
            for n in range(min(LONGEST, len(marked) - at), 0, -1):
                known = self.tables[n].get(marked[at : at + n])
                if known is not None:
                    total += known
                    steps += 1
                    at += n
                    break
            else:
                at += 1
        return total / max(steps, 1)


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """From `text` and non-null `lang` of documents that are not held out.

    All words and n-grams that a language has twice or more in the sample are kept, or all it has, if
    it has none twice; their number is not capped.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = bounded(labelled.select("doc_id", "lang"), "lang", sample).select("doc_id").distinct()
    chosen = labelled.join(F.broadcast(ids), "doc_id").select("lang", "text")
    counts = (
        chosen.mapInArrow(counted, "lang string, n int, part binary, count long")
        .groupBy("lang", "n", "part")
        .agg(F.sum("count").alias("count"))
    )
    found = counts.toArrow()
    langs = sorted(found.column("lang").unique().to_pylist())
    tables: list[dict[bytes, np.ndarray]] = []
    for n in range(LONGEST + 1):
        rows = found.filter(pc.equal(found.column("n"), n)).combine_chunks()
        part = pa.array(rows.column("part").combine_chunks()).dictionary_encode()
        lang = pc.index_in(rows.column("lang"), pa.array(langs, pa.string())).to_numpy()
        counts_of = np.zeros((len(part.dictionary), len(langs)))
        counts_of[part.indices.to_numpy(), lang] = rows.column("count").to_numpy()
        total = counts_of.sum(axis=0)
        # what a language has once says little of it, if there is anything it has more often
        counts_of[(counts_of == 1) & (counts_of.max(axis=0, initial=0) > 1)] = 0
        kept = counts_of.any(axis=1)
        scores = np.log((counts_of[kept] + SMOOTHING) / (total + SMOOTHING * (kept.sum() + 1)))
        tables.append(dict(zip(part.dictionary.filter(pa.array(kept)).to_pylist(), scores, strict=True)))
    return Model(langs, tables)


def predictor(model: Model, spark: SparkSession) -> Callable[[Column], Column]:
    """A column function: text to struct(lang_pred, score).

    Log frequencies of a document's words are added up by language; `score` is the share of the
    best language after softmax, with the evidence of at most ENOUGH words, so it says how clearly
    the words agree rather than how many there are. Null texts and texts without a letter are `und`
    with score 0, as is every text if there was nothing to learn from. Ties go to the language that
    sorts first.
    """
    # one array per table, as very many small ones are slow to send
    packed = [(list(table), np.array([*table.values()])) for table in model.tables]
    spread = spark.sparkContext.broadcast((model.langs, packed))

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        langs, packed = spread.value
        known = Model(langs, [dict(zip(parts, scores, strict=True)) for parts, scores in packed])
        memory = Remembered(known.score, len(known.langs))
        for texts in batches:
            rows = []
            for text in texts:
                found = words(text) if known.langs and text and LETTER.search(text) else []
                if found:
                    evidence = memory.of(found).mean(axis=0) * min(len(found), ENOUGH)
                    best = int(evidence.argmax())
                    rows.append((known.langs[best], float(1 / np.exp(evidence - evidence[best]).sum())))
                else:
                    rows.append((UNDETERMINED, 0.0))
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return predicted


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score.

    Learns from the labelled documents of `docs` itself. Extra columns are not read; rows with a
    null or repeated id are predicted like any other; an empty table gives no rows.
    """
    predict = predictor(learn(docs, sample), docs.sparkSession)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(F.col("text")).alias("_of"))
    return rows.select("doc_id", "held_out", "_of.lang_pred", "_of.score")
