"""Ranked search against scoring every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rows import documents, hard
from wardline.llm import lexical_index
from wardline.llm.lexical_index import build, rank, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def expected(rows, items, top=10):
    """(item, rank, document, score), documents of equal rank keys in any order."""
    bags = [(doc_id, Counter(terms(text))) for doc_id, text in rows]
    bags = [(doc_id, bag) for doc_id, bag in bags if bag]
    n_all, n_terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, bag in bags for t in bag)
    found = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            m = 10 + (90 * bag.total() * n_all) // n_terms
            score = 0
            for t in set(terms(text)) & set(bag):
                w = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for place, (score, null, doc_id) in enumerate(sorted(scored)[:top], 1):
            found.append((item_id, place, None if null else doc_id, -score))
    return Counter(found)


def benchmark(spark, *items):
    return spark.createDataFrame([(i, t, 5, "m") for i, t in items], "item_id long, text string, score int, part string")


def ranked(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    assert dict(df.dtypes)["rank"] == "int" and dict(df.dtypes)["score"] == "bigint"
    return Counter(tuple(r) for r in df.collect())


def corpus(seed, n=300):
    draw = random.Random(seed)
    words = [f"w{int(draw.paretovariate(0.6)) % 200}" for _ in range(2_000)]
    texts = [" ".join(draw.choices(words, k=draw.choice([1, 3, 20, 20, 60]))) for _ in range(n)]
    texts += [texts[0]] * 40 + [None, "", "...", "É é w1", "W1 w1", "w2_w3"]
    return list(enumerate(texts)), words


@pytest.mark.parametrize("part", [1, 50, 20_000])
@pytest.mark.parametrize("first", [1, 3, 16])
def test_against_scoring_all(spark, part, first):
    rows, words = corpus(part + first)
    draw = random.Random(first)
    items = [(i, " ".join(draw.choices(words, k=draw.choice([1, 2, 8, 30])))) for i in range(12)]
    items += [(90, rows[0][1]), (91, None), (92, "?!"), (93, "unheard"), (94, "é"), (7, items[7][1])]
    df = documents(spark, *rows).repartition(4)
    found = ranked(rank(df, benchmark(spark, *items), part=part, first=first))
    wanted = expected(rows, items)
    assert found == wanted


def test_items_in_blocks(spark):
    rows, words = corpus(5)
    items = [(i, " ".join(random.Random(i).choices(words, k=12))) for i in range(20)]
    index = build(documents(spark, *rows), part=200)
    assert ranked(search(index, benchmark(spark, *items), together=30)) == expected(rows, items)


def test_fewer_and_more_places(spark):
    rows, words = corpus(6)
    items = [(i, " ".join(random.Random(i).choices(words, k=6))) for i in range(8)]
    index = build(documents(spark, *rows))
    for top in (1, 60):
        assert ranked(search(index, benchmark(spark, *items), top=top)) == expected(rows, items, top)


def test_hard_rows(spark):
    df = hard(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    items = [(1, "a B c"), (2, "lorem ipsum"), (3, "ΣΑΣ 漢字"), (4, "12"), (5, "x" * 40_000), (None, "a")]
    assert ranked(rank(df, benchmark(spark, *items))) == expected(rows, items)


def test_empty_tables(spark):
    some = benchmark(spark, (1, "a"))
    assert ranked(rank(documents(spark), some)) == Counter()
    assert ranked(rank(documents(spark, (1, "a b"), (2, "c")), some.limit(0))) == Counter()
    assert ranked(rank(documents(spark, (1, None), (2, "!!")), some)) == Counter()


def test_copies_are_dealt_to_parts(spark):
    """A stratum that holds nearly all documents is no one row."""
    rows = [(i, "the same few words") for i in range(500)] + [(500, "others")]
    index = build(documents(spark, *rows), part=100)
    sizes = [len(r["ids"]) for r in index.strata.collect()]
    assert sum(sizes) == 501 and max(sizes) < 100
    items = [(1, "same words"), (2, "others")]
    assert ranked(search(index, benchmark(spark, *items))) == expected(rows, items)


def test_bounds_hold_and_leave_strata_out(spark, monkeypatch):
    """No score passes its stratum's bound, and far fewer strata are scored than there are."""
    rows, words = corpus(8, 400)
    rare = [(1000 + i, f"needle{i} " + " ".join(random.Random(i).choices(words, k=25))) for i in range(12)]
    index = build(documents(spark, *rows, *rare), part=300)
    batches = [index.strata.toArrow().combine_chunks().to_batches()[0]]
    import pyarrow as pa

    asked_terms = pa.array([f"needle{i}" for i in range(12)] + ["w1", "w2"])
    n = len(asked_terms)
    asked = lexical_index.Asked(
        np.array([0]), asked_terms, np.arange(n), np.zeros(n, np.int64), np.array([9_000] * 12 + [40, 30])
    )
    scored = 0
    for part in lexical_index._parts(iter(batches), asked_terms):
        bound = lexical_index._bounds(asked, part)[0]
        scores = lexical_index._scores(asked, part, np.array([0]))
        assert scores.max() <= bound
        scored += bound >= 9_000 * 100_000
    assert 0 < scored <= 12 < len(batches[0])
