"""Words of a text, remembered per-word scores, and bounded samples of labelled documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.shared import remainder

#: ASCII letters stay (texts are lower-cased before), other ASCII characters part words, as do no others.
PARTS_WORDS = bytes(x if x >= 128 or chr(x).isalpha() else 32 for x in range(256))


def words(text: str) -> list[bytes]:
    """Lower-case runs of letters; characters beyond ASCII count as letters."""
    return text.lower().encode().translate(PARTS_WORDS).split()


class Remembered(dict):
    """Scores of words, each worked out when first met: a matrix with a row per word."""

    def __init__(self, score: Callable[[bytes], np.ndarray], width: int, limit: int = 200_000):
        super().__init__()
        self.score, self.limit = score, limit
        self.rows = np.empty((1024, width))

    def __missing__(self, word: bytes) -> int:
        at = len(self)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[at] = self.score(word)
        self[word] = at
        return at

    def of(self, found: list[bytes]) -> np.ndarray:
        """The scores of a text's words, in their order. Memory is emptied between texts only."""
        if len(self) > self.limit:
            self.clear()
        at = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        return self.rows[at]


def texts(batches: Iterator[pa.RecordBatch], slice_rows: int = 512) -> Iterator[tuple[list[str], pa.RecordBatch]]:
    """Texts of column `text` (null: empty) and their rows, a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, slice_rows):
            some = batch.slice(at, slice_rows)
            yield [x or "" for x in some.column("text").to_pylist()], some


def held_out(doc_id: Column) -> Column:
    """Documents no classifier learns labels from. A null id is not one of them, but has no label to join."""
    return F.coalesce(remainder(doc_id, 3) == 1, F.lit(False))


def bounded(rows: DataFrame, by: str, most: int) -> DataFrame:
    """Of the rows of each value of `by`, about `most`, chosen by the hash of doc_id (all, if fewer).

    Values of `by` are few (classes, languages).
    """
    share = rows.groupBy(by).count().select(by, (F.lit(float(most)) / F.col("count")).alias("_share"))
    point = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return rows.join(F.broadcast(share), by).where(point < F.col("_share")).drop("_share")
