"""Language, quality and toxicity: held-out accuracy, and their parts against brute force."""

from __future__ import annotations

import itertools
import math
import os
import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rows import documents, hard
from wardline.llm import language, quality, toxicity

ROOT = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


def read(spark, name):
    return spark.read.parquet(f"{ROOT}/{name}.parquet")


def labels(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int, score double")


def taught(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 != 1


@needs_tables
def test_language(spark):
    docs = read(spark, "documents")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] != taught(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    held_out = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held_out]) > 0.98


def test_language_of_hard_rows(spark):
    known = [(i, "the cat and the dog " * 3, "en") for i in range(100, 120)]
    known += [(i, "le chat et le chien " * 3, "fr") for i in range(200, 220)]
    df = hard(spark).unionByName(documents(spark, *known, (300, "chiens"), (301, "Cats!"), (302, "Ж")))
    rows = language.identify(df).collect()
    assert len(rows) == df.count()
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert all(found[i] == ("und", 0.0) for i in (1, 2, 3, 8))
    assert found[300][0] == "fr" and found[301][0] == "en"
    assert found[302][0] in ("en", "fr")
    assert all(found[i][0] == "en" for i in range(100, 120))


def test_language_keeps_all_words_met_twice(spark):
    """More words than the 20,000 once kept, and a language with no word twice."""
    many = ["".join(x) for x in itertools.product("abcdefghijklmnopqrstuvwxyz", repeat=4)][:21_000]
    rows = [(i, " ".join([*many, *many]), "en") for i in range(5)]
    rows += [(i, f"zj{chr(97 + i)}q", "xx") for i in range(10, 13)]
    df = documents(spark, *rows)
    ids = {r["doc_id"] for r in df.where(~language.held_out(F.col("doc_id"))).collect()}
    assert ids & set(range(5)) and ids & set(range(10, 13))
    model = language.learn(df)
    assert model.langs == ["en", "xx"]
    learnt = {w for i, text, _ in rows if i in ids for w in language.words(text)}
    assert set(model.tables[0]) == learnt and len(learnt) > 20_000 and len(model.tables[5]) > 10_000
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(df).collect()}
    assert all(found[i] == ("en" if i < 10 else "xx") for i in ids)


def test_language_falls_back_by_length():
    tables = [{}, {b"a": np.log([0.9, 0.1])}, {b"ab": np.log([0.1, 0.9])}, {}, {}, {}]
    model = language.Model(["x", "y"], tables)
    assert model.score(b"ab").argmax() == 1
    assert model.score(b"a").argmax() == 0
    assert model.score(b"zz").tolist() == [0, 0]


@needs_tables
@pytest.mark.parametrize(("operator", "label", "least"), [(quality, "quality", 0.97), (toxicity, "toxic", 0.93)])
def test_labels(spark, operator, label, least):
    docs, of = read(spark, "documents"), read(spark, "labels")
    rows = operator.rate(docs, of).join(of, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] != taught(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    held_out = [r for r in rows if r["held_out"] and r[label] is not None]
    assert np.mean([r[label] == r["predicted"] for r in held_out]) > least
    ones, zeros = ([r["score"] for r in held_out if r[label] == x] for x in (1, 0))
    assert np.mean([a > b for a in ones for b in zeros]) > 0.88


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_hard_rows(spark, operator):
    df = hard(spark)
    none = operator.rate(df, labels(spark)).collect()
    assert {r["score"] for r in none} == {0.5} and len(none) == df.count()
    clean = [(i, f"these are plain words of text {i}\nand another line") for i in range(100, 130)]
    foul = [(i, f"$$$ ### awful {i} awful idiots $$$\n%%% awful") for i in range(200, 230)]
    marks = [(i, 1, 0, 0.0) for i in range(100, 130)] + [(i, 0, 1, 0.0) for i in range(200, 230)]
    marks += [(100, 1, 0, 0.0), (None, 0, 1, 0.0), (1, None, None, 0.0), (2, 7, 7, 0.0)]
    df = df.unionByName(documents(spark, *clean, *foul))
    rows = operator.rate(df, labels(spark, *marks)).collect()
    assert len(rows) == df.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    score = {r["doc_id"]: r["score"] for r in rows}
    high, low = (range(100, 130), range(200, 230)) if operator is quality else (range(200, 230), range(100, 130))
    assert min(score[i] for i in high) > max(score[i] for i in low)
    assert operator.rate(documents(spark), labels(spark, *marks)).count() == 0


def test_marginals():
    draw = np.random.default_rng(0)
    lengths, steps = np.array([1, 4, 2, 5]), draw.standard_normal((2, 2))
    good, weight = draw.standard_normal(lengths.sum()), np.array([1.0, 0.5, 2.0, 1.0])
    wanted, pairs, at = [], np.zeros((2, 2)), 0
    for n, w in zip(lengths, weight, strict=True):
        ways = list(itertools.product((0, 1), repeat=int(n)))
        chance = np.array(
            [
                math.exp(sum(good[at + i] * y for i, y in enumerate(way)) + sum(steps[a, b] for a, b in zip(way, way[1:], strict=False)))
                for way in ways
            ]
        )
        chance /= chance.sum()
        wanted += [sum(p for way, p in zip(ways, chance, strict=True) if way[i]) for i in range(n)]
        for way, p in zip(ways, chance, strict=True):
            for a, b in zip(way, way[1:], strict=False):
                pairs[a, b] += w * p
        at += n
    found, found_pairs = quality.marginals(good, lengths, steps, weight)
    assert found == pytest.approx(wanted)
    assert found_pairs == pytest.approx(pairs)


def maximal(scores: list[float]) -> list[tuple[int, int]]:
    """Ruzzo and Tompa's definition: take the best segment (the shortest of those), then either side of it."""
    spans = [(i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
    spans = [x for x in spans if sum(scores[slice(*x)]) > 0]
    if not spans:
        return []
    i, j = max(spans, key=lambda x: (sum(scores[slice(*x)]), x[0] - x[1]))
    return maximal(scores[:i]) + [(i, j)] + [(a + j, b + j) for a, b in maximal(scores[j:])]


@given(st.lists(st.sampled_from([-7.0, -3.0, -1.0, 2.0, 4.5, 8.25]), max_size=14))
def test_segments(scores):
    found = toxicity.segments(np.array(scores))
    assert [sum(scores[a:b]) for a, b, _ in found] == pytest.approx([s for *_, s in found])
    assert sum(s for *_, s in found) == pytest.approx(sum(sum(scores[a:b]) for a, b in maximal(scores)))
    assert len(found) == len(maximal(scores))


def test_decay():
    share, score = np.array([0.8, 0.2]), np.array([-1.0, 2.0])
    root = toxicity.decay(share, score)
    assert share @ np.exp(root * score) == pytest.approx(1)


@needs_tables
def test_passages(spark):
    docs, of = read(spark, "documents"), read(spark, "labels")
    rows = toxicity.passages(docs, toxicity.learn(docs, of)).collect()
    assert rows and all(r["chance"] <= toxicity.SIGNIFICANT and len(r["words"].split()) == r["length"] for r in rows)
    toxic = {r["doc_id"] for r in of.where("toxic = 1").collect()}
    known = {r["doc_id"] for r in of.collect()}
    marked = [r["doc_id"] in toxic for r in rows if r["doc_id"] in known]
    assert np.mean(marked) > 0.8
