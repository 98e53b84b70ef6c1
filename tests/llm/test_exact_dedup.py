from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rows import documents, hard
from wardline.llm.exact_dedup import drop_copies, mark_copies
from wardline.llm.shared import lower_ascii

UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[hashlib.sha256((text or "").encode().translate(UPPER)).hexdigest()].append(doc_id)
    return {
        (i, max((x for x in ids if x is not None), default=None), len(ids), digest)
        for digest, ids in groups.items()
        for i in ids
    }


@pytest.mark.parametrize("counters", [1, 2, 1024])
def test_marks(spark, counters):
    df = hard(spark).unionByName(documents(spark, *((i, "Hot" if i % 2 else "hOT") for i in range(100, 160))))
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    marks = mark_copies(df, counters=counters).collect()
    assert len(marks) == len(rows)
    assert {(m["doc_id"], m["keep_id"], m["group_size"], m["text_sha256"]) for m in marks} == expected(rows)
    kept = [m["text_sha256"] for m in marks if m["kept"]]
    assert sorted(kept) == sorted({m["text_sha256"] for m in marks})
    assert all(m["doc_id"] == m["keep_id"] for m in marks if m["kept"])


def test_rows_that_stay(spark):
    df = hard(spark)
    stay = drop_copies(df)
    assert stay.columns == df.columns
    rows = stay.collect()
    # equal texts: {1, 2, null id}, {3}, {4, 5}, {6, 6, null id}, and four of their own
    assert sorted(r["doc_id"] for r in rows) == [2, 3, 5, 6, 7, 8, 9]
    assert {r["score"] for r in rows} == {0.25}


def test_empty(spark):
    df = documents(spark)
    assert mark_copies(df).count() == 0
    assert drop_copies(df).count() == 0


def test_only_ascii_letters_are_lowered(spark):
    texts = [None, "", "ABC xyz", "A\x00Z[`{@", "\u212aELVIN K", "İI", "ΣΑΣ A", "Éa É", "ẞ SS", "🙂A", "Ａ A"]
    df = documents(spark, *enumerate(texts))
    lowered = dict(df.select("doc_id", lower_ascii(F.col("text"))).collect())
    assert lowered == {i: x and x.encode().lower().decode() for i, x in enumerate(texts)}


def test_ascii_texts_are_not_taken_apart_by_character(spark):
    """`translate` makes objects for each character, which once filled an executor's heap."""
    lowered = lower_ascii(F.col("text"))
    plan = spark.range(1).select(F.lit("A").alias("text")).repartition(1).select(lowered)
    assert "THEN lower(" in plan._jdf.queryExecution().analyzed().toString()
