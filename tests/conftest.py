from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardline.schemas import DERIVED, SOURCES  # noqa: E402
from workbench.check import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(4)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of a source or derived table given by column; missing columns are NULL."""

    def build(name: str, *rows: dict):
        schema = SOURCES.get(name) or DERIVED[name]
        unknown = {c for r in rows for c in r} - set(schema.fieldNames())
        assert not unknown, unknown
        data = [tuple(r.get(c) for c in schema.fieldNames()) for r in rows]
        return spark.createDataFrame(data, schema)

    return build


def values(df, *columns: str) -> list[tuple]:
    """Rows as tuples, sorted with NULLs last."""
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))
