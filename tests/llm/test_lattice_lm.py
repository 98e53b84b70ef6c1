from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from rows import documents, hard
from wardline.llm import lattice_lm
from wardline.llm.lattice_lm import MARK, lattice, score


def small():
    shown = [MARK.encode(), *(MARK.encode() + x for x in (b"a", b"ab")), b"a", b"b", b"ab", b"ba", b"abb"]
    shown += [x for x in (bytes([i]) for i in range(256)) if x not in shown]
    share = np.linspace(3, 1, len(shown))
    return shown, np.log(share / share.sum() * 0.8), math.log(0.2)


def segmentations(word: bytes, shown: list[bytes]):
    if not word:
        yield []
    for i, piece in enumerate(shown):
        if word.startswith(piece):
            yield from ([i, *rest] for rest in segmentations(word[len(piece) :], shown))


def test_marginal_and_expected_counts():
    shown, pieces, end = small()
    model = lattice(shown, pieces, end)
    words = [b"a", b"abba", b"abab", b"xaby", b"b"]
    counts = np.zeros(len(shown))
    for word, found in zip(words, model.log_probability(words), strict=True):
        ways = list(segmentations(MARK.encode() + word, shown))
        chance = np.array([np.exp(pieces[way].sum() + end) for way in ways])
        assert len(ways) > 1
        assert found == pytest.approx(math.log(chance.sum()))
        for way, share in zip(ways, chance / chance.sum(), strict=True):
            np.add.at(counts, way, share)
    assert model.expected(words) == pytest.approx(counts)
    assert model.log_probability([lattice_lm.END])[0] == -np.inf


def brute(rows):
    fold = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [[*(t or "").encode().lower().split(), b""] for _, t in rows]
    c = Counter(x for (i, _), words in zip(rows, tokens, strict=True) if not fold(i) for x in words)
    n, v = sum(c.values()), len(c)
    base = lambda x: math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1)))
    return [
        (i, fold(i), len(words), sum(c[x] > 0 for x in words), n, sum(map(base, words)))
        for (i, _), words in zip(rows, tokens, strict=True)
    ]


@pytest.mark.parametrize("heavy", [1, 20, 500_000])
def test_rows(spark, monkeypatch, heavy):
    """However many words are broadcast, the scores are the same."""
    monkeypatch.setattr(lattice_lm, "HEAVY", heavy)
    df = hard(spark).unionByName(documents(spark, *((i, f"word number w{i} and word x{i % 7}") for i in range(20, 90))))
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    found = score(df).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    got = sorted(([*(r[c] for c in columns), r["base_score"], r["score"]] for r in found), key=key)
    for mine, wanted in zip(got, sorted(brute(rows), key=key), strict=True):
        assert tuple(mine[:5]) == wanted[:5]
        assert mine[5] == pytest.approx(wanted[5])
        assert mine[6] < 0 and math.isfinite(mine[6])
    test_rows.scores = getattr(test_rows, "scores", []) + [[r[6] for r in got]]
    assert test_rows.scores[-1] == pytest.approx(test_rows.scores[0])


def test_nothing_to_learn_from(spark):
    held_out = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    rows = score(documents(spark, *((i, "some words") for i in held_out))).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows] == [(3, 0, 0)] * 3
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert score(documents(spark)).count() == 0
