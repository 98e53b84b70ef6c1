from __future__ import annotations

import random

import numpy as np
import pytest

from rows import documents, hard
from wardline.llm import jaccard_join
from wardline.llm.signature_tree import alike, joins


def expected(rows):
    """component_id by position, from all pairs of documents."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        n = max(len(words) - 4, 1)
        sets.append({tuple(words[i : i + 5]) for i in range(n)} if words else set())
    root = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= 80 * len(x | y) and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    result = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        result.append((doc_id, len(sets[i]), min(ids, default=None)))
    return result


def texts() -> list[str]:
    """Copies of several kinds, pairs on either side of the bound, and a passage that many texts share."""
    draw = random.Random(3)

    def word():
        return "".join(draw.choice("abcdefghij") for _ in range(4))

    passage = [word() for _ in range(60)]
    made = []
    for _ in range(12):
        base = [word() for _ in range(draw.choice([3, 6, 30, 90, 200]))]
        made.append(" ".join(base))
        for _ in range(draw.randrange(6)):
            words = list(base)
            for _ in range(draw.choice([0, 1, 2, 4, 8])):
                words[draw.randrange(len(words))] = word()
            made.append(" ".join(words))
            made.append("  ".join(words).upper())
    for n in (5, 15, 15, 40, 200):
        made.append(" ".join([word() for _ in range(n)] + passage))
    # chains in which neighbours alone are alike
    chain = [word() for _ in range(60)]
    for i in range(0, 24, 6):
        made.append(" ".join(chain[i : i + 60] + [f"tail{j}" for j in range(i)]))
    return made


@pytest.mark.parametrize("together", [64_000, 150])
def test_groups(spark, monkeypatch, together):
    monkeypatch.setattr(jaccard_join, "TOGETHER", together)
    ids = list(range(1_000, 1_000 + len(texts())))
    random.Random(5).shuffle(ids)
    df = hard(spark).unionByName(documents(spark, *zip(ids, texts(), strict=True))).repartition(5)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    found = jaccard_join.near_groups(df).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=key)
    assert got == sorted(expected(rows), key=key)


@pytest.mark.parametrize("together", [64_000, 150])
def test_every_link_counts(spark, monkeypatch, together):
    """Also those between documents that other links have joined already."""
    monkeypatch.setattr(jaccard_join, "TOGETHER", together)
    base = [f"w{i}" for i in range(100)]
    near = [" ".join([*base, f"end{i}"]) for i in range(6)]
    some = [*texts(), *near, near[0].upper()]
    df = hard(spark).unionByName(documents(spark, *enumerate(some, 1_000))).repartition(5)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set())
    wanted = [
        (doc_id, sum(i != j and bool(x) and 100 * len(x & y) >= 80 * len(x | y) for j, y in enumerate(sets)))
        for i, ((doc_id, _), x) in enumerate(zip(rows, sets, strict=True))
    ]
    found = jaccard_join.near_groups(df, count_links=True).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r["doc_id"], r["n_links"]) for r in found), key=key) == sorted(wanted, key=key)
    by_id = {r["doc_id"]: r for r in found}
    first, copy = 1_000 + len(texts()), 1_000 + len(some) - 1
    assert by_id[copy]["class_id"] == first and by_id[first]["n_links"] == by_id[first + 1]["n_links"] == 6


def test_one_of_a_group_stays(spark):
    base = " ".join(f"w{i}" for i in range(100))
    df = documents(spark, (3, base), (2, base + " x"), (9, base.upper()), (5, "other words"), (None, base), (4, None))
    stay = jaccard_join.keep_one(df)
    assert stay.columns == df.columns
    assert sorted(r["doc_id"] or -1 for r in stay.collect()) == [-1, 2, 4, 5]


def test_empty(spark):
    assert jaccard_join.near_groups(documents(spark)).count() == 0
    assert jaccard_join.keep_one(documents(spark, (1, None))).count() == 1


def test_first_ones():
    """The claim the filter rests on, at every size and number of changes."""
    draw = np.random.default_rng(2)
    for n in range(1, 60):
        for beyond in (0, 10, 100):
            x = np.unique(draw.integers(0, 1 << 62, n).astype(np.uint64))
            y = np.unique(np.concatenate([x[draw.random(len(x)) > 0.1], draw.integers(0, 1 << 62, n // 10).astype(np.uint64)]))
            if len(y) and alike(x, y, 80):
                common = np.intersect1d(jaccard_join.first_ones(x, 80, beyond), jaccard_join.first_ones(y, 80, beyond))
                small = min(len(x), len(y))
                least = max(small * beyond // 100, 1) if beyond < 80 else -(-max(len(x), len(y)) * 80 // 100)
                assert len(common) >= least


def test_joins_end_as_all_pairs_would():
    draw = np.random.default_rng(0)
    for _ in range(15):
        sets = []
        for _ in range(draw.integers(1, 12)):
            base = draw.integers(0, 1 << 63, draw.integers(1, 200), dtype=np.uint64)
            for _ in range(draw.integers(1, 15)):
                some = base.copy()
                changed = draw.random(len(some)) < draw.choice([0, 0.05, 0.1, 0.15, 0.2])
                some[changed] = draw.integers(0, 1 << 63, changed.sum(), dtype=np.uint64)
                sets.append(np.unique(some))
        found, wanted = list(range(len(sets))), list(range(len(sets)))
        for i, j in joins(sets, np.arange(len(sets)), 80):
            assert alike(sets[i], sets[j], 80)
            found = [found[j] if x == found[i] else x for x in found]
        for i in range(len(sets)):
            for j in range(i):
                if alike(sets[i], sets[j], 80):
                    wanted = [wanted[j] if x == wanted[i] else x for x in wanted]
        groups = [sorted(tuple(k for k, y in enumerate(x) if y == v) for v in set(x)) for x in (found, wanted)]
        assert groups[0] == groups[1]
