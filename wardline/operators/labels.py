"""Exact-match labelling of charted strings."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Vocabulary = Sequence[tuple[str, "str | None"]]


def label_events(df: DataFrame, value: str, vocabulary: Vocabulary, label: str) -> DataFrame:
    """Keep rows whose ``value`` is in the vocabulary and add its label.

    A value listed with two labels gives two rows, a value listed with a NULL label
    one row with a NULL label. The list of values is also stated as a filter, so that
    it reaches the file scan and prunes row groups there. How the two are joined is left
    to Spark, which knows how long the vocabulary is.
    """
    lookup = df.sparkSession.createDataFrame(
        pa.table(
            {
                value: pa.array([v for v, _ in vocabulary], pa.string()),
                label: pa.array([name for _, name in vocabulary], pa.string()),
            }
        )
    )
    known = sorted({v for v, _ in vocabulary})
    return df.filter(F.col(value).isin(known)).join(lookup, value)
