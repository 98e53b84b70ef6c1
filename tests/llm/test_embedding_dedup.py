from __future__ import annotations

import tracemalloc
import uuid

import numpy as np
import pytest

from wardline.llm import embedding_dedup
from wardline.llm.embedding_dedup import near_duplicates


def vectors() -> list:
    draw = np.random.default_rng(3)
    rows: list = []
    for _ in range(20):
        base = draw.standard_normal(32)
        for _ in range(draw.integers(1, 15)):
            rows.append((base + draw.standard_normal(32) * draw.choice([0.05, 0.15, 0.2, 0.25])).astype(np.float32).tolist())
    rows += [rows[0]] * 30
    base = draw.standard_normal(32)
    rows += [(base + 0.05 * draw.standard_normal(32)).astype(np.float32).tolist() for _ in range(120)]
    return rows + [None, [], [0.0] * 32, [float("nan")] * 32, [float("inf")] * 32, [1.0] * 16, [2.0] * 16, [None] + [1.0] * 31]


def expected(rows, ids):
    vectors = [
        np.array(x) if x and all(v is not None and np.isfinite(v) for v in x) and any(x) else None for x in rows
    ]
    links = [
        {
            j
            for j, y in enumerate(vectors)
            if i != j and x is not None and y is not None and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95
        }
        for i, x in enumerate(vectors)
    ]
    result = []
    for i in range(len(rows)):
        seen, going = {i}, [i]
        while going:
            new = links[going.pop()] - seen
            seen |= new
            going += new
        component = min(ids[j] for j in seen)
        result.append((ids[i], len(links[i]), component, ids[i] == component))
    return sorted(result)


@pytest.mark.parametrize("block", [1024, 16])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors()
    ids = np.random.default_rng(1).permutation(len(rows)).tolist()
    df = spark.createDataFrame(list(zip(ids, rows, ids, ids, strict=True)), "vec_id long, embedding array<float>, size int, block int")
    assert sorted(map(tuple, near_duplicates(df.repartition(3)).collect())) == expected(rows, ids)


def test_groups_of_a_hot_bucket_are_bounded(spark, monkeypatch, tmp_path):
    """Different vectors that all meet in every table: no call gets many more rows than ROWS."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "ROWS", 256)
    made = embedding_dedup._compared

    def counted(cosine):
        compared = made(cosine)

        def noted(rows):
            (tmp_path / f"{uuid.uuid4().hex}").write_text(str(rows.num_rows))
            return compared(rows)

        return noted

    monkeypatch.setattr(embedding_dedup, "_compared", counted)
    draw = np.random.default_rng(4)
    near = np.ones(32) + 1e-4 * draw.standard_normal((400, 32))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(near)], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, near_duplicates(df).collect())) == [(i, 399, 0, i == 0) for i in range(400)]
    sizes = [int(x.read_text()) for x in tmp_path.iterdir()]
    assert sizes and max(sizes) <= 4 * 256


def test_codes_of_linked_pairs_are_compared_in_slices():
    n, tables = 512, 40
    units, codes = np.zeros((n, 4)), np.zeros((n, tables), np.int64)
    units[:, 0] = 1
    tracemalloc.start()
    ids, root, links = embedding_dedup.linked(
        np.arange(n), np.ones(n, np.int64), units, codes, np.zeros(n, np.int64), 0, (0, 0), 0.95
    )
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids.tolist() == list(range(n)) and not root.any() and (links == n - 1).all()
    assert peak < 40_000_000


def test_null_and_repeated_ids(spark):
    one, other = [1.0, 0.0], [0.0, 1.0]
    df = spark.createDataFrame([(3, one), (3, one), (None, one), (None, other), (5, [2.0, 0.0])], "vec_id long, embedding array<float>")
    rows = sorted(map(tuple, near_duplicates(df).collect()), key=str)
    assert rows == sorted([(3, 3, 3, True), (3, 3, 3, True), (None, 3, 3, None), (None, 0, None, None), (5, 3, 3, False)], key=str)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert near_duplicates(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).first()["component_id"] == 1


def test_recall():
    for n in (10, 10**4, 10**9):
        bits, tables = embedding_dedup.plan(n)
        met = (1 - np.arccos(0.95) / np.pi) ** bits
        assert 1 - (1 - met) ** tables >= embedding_dedup.RECALL
