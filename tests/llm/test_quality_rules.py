"""Quality rules against plain counting, and their verdicts on planted texts."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rows import documents, hard
from wardline.llm import quality_rules
from wardline.llm.quality_rules import Rules, keep, measure, rate

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    where = {}
    for i in range(len(words) - 4):
        where.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {k for starts in where.values() if len(starts) > 1 for i in starts for k in range(i, i + 5)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), copies, len(covered), failed


def numbers(rows):
    return Counter(
        (r["doc_id"], (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]))
        for r in rows
    )


def some_texts(seed, n=120):
    draw = random.Random(seed)
    words = ["a", "b", "c", "dé", "#x", "漢字", "$", "e.", "\x00", "F"]
    gaps = [" ", " ", "\n", "\n", "\t", "\r\n", "  ", "\x0b"]
    texts = ["".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randrange(60))) for _ in range(n)]
    return [*texts, *(t * 2 for t in texts[:20]), "a b c d e\n" * 4, "x\nx\nx \nx", " \n \n", None]


def test_base_counts(spark):
    rows = list(enumerate(some_texts(1)))
    found = numbers(rate(documents(spark, *rows).repartition(3)).collect())
    assert found == Counter((i, counted(t)) for i, t in rows)


@pytest.mark.parametrize("seed", range(4))
def test_measure_of_texts_side_by_side(seed):
    texts = [t or "" for t in some_texts(seed, 30)]
    random.Random(seed).shuffle(texts)
    base = measure(texts).base
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert [tuple(base[c][k].item() for c in names) for k in range(len(texts))] == [counted(t) for t in texts]


def test_hard_rows(spark):
    df = hard(spark)
    rows = rate(df).collect()
    assert numbers(rows) == Counter((r["doc_id"], counted(r["text"])) for r in df.collect())
    kept = keep(df)
    assert kept.columns == df.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in rows if r["kept"])


def test_empty_table(spark):
    assert rate(documents(spark)).collect() == [] and keep(documents(spark)).collect() == []
    assert measure([]).base["n_words"].tolist() == []


def language(seed, stems, n):
    """Prose of one language: a few common words, many others."""
    draw = random.Random(seed)
    common, syllables = stems
    texts = []
    for _ in range(n):
        words = [
            draw.choice(common) if draw.random() < 0.5 else "".join(draw.choices(syllables, k=draw.randrange(2, 5)))
            for _ in range(draw.choice([30, 80, 200, 600]))
        ]
        texts.append(" ".join(words).capitalize() + ".")
    return texts


ONE = (["the", "of", "and", "to", "in", "is", "that"], ["an", "er", "on", "re", "st", "th", "ou", "ing"])
TWO = (["der", "die", "und", "von", "zu", "mit", "ü"], ["sch", "ei", "ge", "ver", "ß", "ung", "be", "en"])


def planted(spark):
    clean = [(i, t, "en") for i, t in enumerate(language(1, ONE, 150))]
    clean += [(1000 + i, t, "de") for i, t in enumerate(language(2, TWO, 60))]
    draw = random.Random(3)
    long = lambda seed: [t for t in language(seed, ONE, 30) if 400 < len(t) < 1500][:3]
    table = [(2000 + i, " | ".join("".join(draw.choices(ONE[1], k=3)) for _ in range(150)), "en") for i in range(3)]
    marks = [(3000 + i, " ".join(w + draw.choice(["###", "$$$", "%%%"]) for w in t.split()), "en") for i, t in enumerate(long(4))]
    loud = [(4000 + i, t.upper(), "en") for i, t in enumerate(long(5))]
    swapped = [(5000 + i, t, "de") for i, t in enumerate(long(6))]
    return clean, [*table, *marks, *loud, *swapped]


def test_verdicts(spark):
    clean, odd = planted(spark)
    unknown = [(9000, clean[2][1], None), (9001, clean[3][1], "xx"), (9002, odd[0][1], None), (9003, clean[-1][1], None)]
    rows = rate(documents(spark, *clean, *odd, *unknown)).collect()
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert {i for i, *_ in clean} <= kept
    assert not {i for i, *_ in odd} & kept
    # a text without a reference of its own is held against the nearest
    assert {9000, 9001, 9003} <= kept and 9002 not in kept


def test_short_texts_are_not_judged(spark):
    clean, odd = planted(spark)
    short = [(8000, " ".join(odd[0][1].split()[:40]), "en"), (8001, "Ä ß " * 3 + "ö 漢字 字 字 x y", "en")]
    rows = {r["doc_id"]: r for r in rate(documents(spark, *clean, *short)).collect()}
    assert rows[8000]["kept"] and rows[8001]["kept"] and rows[8000]["word_distance"] > 0.35
    strict = Rules(least_words=20, word_limit=0.2, slack=0.5)
    assert not {r["doc_id"]: r for r in rate(documents(spark, *clean, *short), rules=strict).collect()}[8000]["kept"]


def test_distances_against_their_definition(spark):
    clean, _ = planted(spark)
    df = documents(spark, *clean)
    references = quality_rules.learn(df)
    english = [t for _, t, lang in clean if lang == "en" and not counted(t)[5]]
    words = Counter(w.lower() for t in english for w in t.split())
    common = sorted(words, key=lambda w: (-words[w], w.encode()))[:100]
    assert [w.decode() for w in references["en"].words] == common
    rows = {r["doc_id"]: r for r in rate(df).collect()}

    def distance(p, q):
        p, q = (np.array(x, float) / sum(x) for x in (p, q))
        parts = [x * math.log2(2 * x / (a + b)) for a, b in zip(p, q) for x in (a, b) if x > 0]
        return math.sqrt(max(0.0, sum(parts) / 2))

    def bins(counts):
        known = [counts[w] for w in common]
        return [*known, counts.total() - sum(known)]

    def kinds(text):
        sets = [set(c.decode()) for c in quality_rules.CLASSES]
        inside = [sum(c in s for c in text) for s in sets]
        beyond = sum(ord(c) > 127 for c in text)
        return [*inside, len(text) - beyond - sum(inside), beyond]

    shape = np.sum([kinds(t) for t in english], 0)
    for i, t, lang in clean[:40]:
        assert rows[i]["word_distance"] == pytest.approx(distance(bins(Counter(t.lower().split())), bins(words)), abs=1e-9)
        assert rows[i]["class_distance"] == pytest.approx(distance(kinds(t), shape), abs=1e-9)
