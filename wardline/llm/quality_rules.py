"""Quality rules: counts of a text, and how far its histograms lie from those of its language."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.shared import store
from wardline.llm.words import texts

#: Classes of characters; all others beyond ASCII are one class, all others within it another.
CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" \t",
    b"\n\x0b\x0c\r",
    b".,;:!?",
    b"#*$%&|<>",
    b"'\"()-",
)
OTHER, BEYOND, INSIDE = len(CLASSES), len(CLASSES) + 1, 255
BLANK, ENDS, SYMBOLS = 3, 4, 6
N_CLASSES = len(CLASSES) + 2
#: The class of each UTF-8 byte; bytes inside a character have none.
CLASS_OF = bytes(
    INSIDE if 0x80 <= x < 0xC0 else BEYOND if x >= 0xC0 else next((k for k, c in enumerate(CLASSES) if x in c), OTHER)
    for x in range(256)
)
WINDOW = 5


class Rules(NamedTuple):
    """Parameters of the verdict.

    A sample of n draws lies about 1/sqrt(n) from its own distribution, so a distance may exceed
    its limit by `slack / sqrt(n_words)`; shorter texts are not judged by it.
    """

    common_words: int = 100
    least_words: int = 50
    least_chars: int = 200
    word_limit: float = 0.35
    class_limit: float = 0.2
    slack: float = 1.0
    #: A language is a reference with so many words in texts that pass the base rules, and this share of all of them.
    reference_words: int = 1_000
    reference_share: float = 0.001


def classes(text: bytes) -> list[int]:
    marked = text.translate(CLASS_OF)
    return [marked.count(k) for k in range(N_CLASSES)]


def repeated(ids: np.ndarray, of: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Which words lie in a window of `width` words that the same text holds twice or more.

    `ids` numbers the words, `of` the texts they are in. Windows are named exactly, by naming ever
    longer ones by their two halves; memory stays in proportion to the words.
    """
    covered = np.zeros(len(ids), bool)
    starts = np.flatnonzero(of[: len(of) - width + 1] == of[width - 1 :]) if len(ids) >= width else np.empty(0, np.int64)
    if not len(starts):
        return covered
    name = np.unique(of[starts], return_inverse=True)[1]
    for k in range(width):
        more = ids[starts + k]
        # the first word is named within its text; an id is below len(ids)
        name = np.unique(name * np.int64(len(ids) + 1) + more, return_inverse=True)[1]
    twice = np.bincount(name)[name] > 1
    for k in range(width):
        covered[starts[twice] + k] = True
    return covered


class Measured(NamedTuple):
    """Texts side by side: numbers of each text, and of each word its text and its name."""

    base: dict[str, np.ndarray]
    classes: np.ndarray
    of: np.ndarray
    ids: np.ndarray
    names: list[bytes]


def measure(some: list[str]) -> Measured:
    encoded = [x.encode() for x in some]
    table: dict[bytes, int] = {}
    ids, n_words, dup_lines = [], [], []
    for text in encoded:
        words = text.split()
        n_words.append(len(words))
        ids += [table.setdefault(w, len(table)) for w in words]
        lines = [x for x in text.split(b"\n") if x.strip()] if b"\n" in text else []
        dup_lines.append(len(lines) - len(set(lines)))
    counts = np.array([classes(x) for x in encoded], np.int64).reshape(-1, N_CLASSES)
    numbers = np.array(n_words, np.int64)
    of, at = np.repeat(np.arange(len(some)), numbers), np.array(ids, np.int64)
    base = {
        "n_words": numbers,
        "word_chars": counts.sum(1) - counts[:, BLANK] - counts[:, ENDS],
        "n_symbols": counts[:, SYMBOLS],
        "n_dup_lines": np.array(dup_lines, np.int64),
        "n_repeat_words": np.bincount(of[repeated(at, of)], minlength=len(some)),
    }
    base["base_failed"] = (numbers < 10) | (100 * base["n_repeat_words"] > 20 * numbers)
    return Measured(base, counts, of, at, list(table))


def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts (lang, kind, key, n) of the classes and lower-case words of texts that pass the base rules."""
    for some, rows in texts(batches, 128):
        m = measure(some)
        lower = [w.lower() for w in m.names]
        found: dict[tuple, int] = Counter()
        by_lang: dict[str, list[int]] = {}
        for k, lang in enumerate(rows.column("lang").to_pylist()):
            if lang is not None and not m.base["base_failed"][k]:
                by_lang.setdefault(lang, []).append(k)
        for lang, which in by_lang.items():
            inside = np.zeros(len(some), bool)
            inside[which] = True
            n = np.bincount(m.ids[inside[m.of]], minlength=len(lower))
            for at in np.flatnonzero(n):
                found[lang, "word", lower[at]] += int(n[at])
            for k, count in enumerate(m.classes[which].sum(0)):
                found[lang, "class", str(k).encode()] += int(count)
        if found:
            keys = list(zip(*found))
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array(keys[0], pa.string()),
                    "kind": pa.array(keys[1], pa.string()),
                    "key": pa.array(keys[2], pa.binary()),
                    "n": pa.array(found.values(), pa.int64()),
                }
            )


class Reference(NamedTuple):
    """What a language looks like: its common words, their counts and that of all others, its classes."""

    words: dict[bytes, int]
    word_counts: np.ndarray
    class_counts: np.ndarray


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules()) -> dict[str, Reference]:
    """The references, from all texts of `df` that pass the base rules.

    At most 1 / `reference_share` languages can be one, each with `common_words` words, so what
    reaches the driver is bounded. Words tied for the last place go in byte order.
    """
    counts = (
        df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
        .mapInArrow(histograms, "lang string, kind string, key binary, n long")
        .groupBy("lang", "kind", "key")
        .agg(F.sum("n").alias("n"))
    )
    counts = store(counts, "histograms")
    words = counts.where("kind = 'word'")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    every = totals.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("every"))
    judged = totals.join(F.broadcast(every)).where(
        (F.col("total") >= rules.reference_words) & (F.col("total") >= rules.reference_share * F.col("every"))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "key"))
    top = words.withColumn("rank", rank).where(F.col("rank") <= rules.common_words).drop("rank")
    kept = top.unionByName(counts.where("kind = 'class'")).join(F.broadcast(judged.select("lang", "total")), "lang")
    found: dict[str, dict[str, list]] = {}
    for r in kept.collect():
        found.setdefault(r["lang"], {"word": [], "class": [], "total": r["total"]})[r["kind"]].append((r["n"], bytes(r["key"])))
    references = {}
    for lang, of in sorted(found.items()):
        common = sorted(of["word"], key=lambda x: (-x[0], x[1]))
        tallies = np.array([n for n, _ in common], np.float64)
        shapes = {int(k): n for n, k in of["class"]}
        references[lang] = Reference(
            {w: k for k, (_, w) in enumerate(common)},
            np.append(tallies, of["total"] - tallies.sum()),
            np.array([shapes.get(k, 0) for k in range(N_CLASSES)], np.float64),
        )
    return references


def distances(of_texts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row of counts from the reference; 0 where a row is empty."""
    total = of_texts.sum(1, keepdims=True)
    p = of_texts / np.maximum(total, 1)
    q = reference / max(reference.sum(), 1)

    def entropy(x: np.ndarray) -> np.ndarray:
        return -(x * np.log2(np.where(x > 0, x, 1))).sum(-1)

    apart = entropy((p + q) / 2) - (entropy(p) + entropy(q)) / 2
    return np.where(total[:, 0] > 0, np.sqrt(np.maximum(apart, 0)), 0.0)


def judge(m: Measured, langs: list, references: dict[str, Reference], rules: Rules) -> dict[str, np.ndarray]:
    """Distances of each text from its language's reference, from the nearest one if it has none, and the verdict."""
    n = len(langs)
    words, shapes = np.full(n, np.inf), np.full(n, np.inf)
    lower = [w.lower() for w in m.names]
    unknown = np.array([x not in references for x in langs], bool)
    for lang, ref in references.items():
        mine = unknown | np.array([x == lang for x in langs], bool)
        which = np.flatnonzero(mine)
        if not len(which):
            continue
        bins = len(ref.word_counts)
        place = np.array([ref.words.get(w, bins - 1) for w in lower], np.int64)
        inside = mine[m.of]
        row = np.cumsum(mine) - 1
        flat = np.bincount(row[m.of[inside]] * bins + place[m.ids[inside]], minlength=len(which) * bins)
        words[which] = np.minimum(words[which], distances(flat.reshape(-1, bins), ref.word_counts))
        shapes[which] = np.minimum(shapes[which], distances(m.classes[which], ref.class_counts))
    spare = rules.slack / np.sqrt(np.maximum(m.base["n_words"], 1))
    judged = np.isfinite(words)
    far = judged & (m.base["n_words"] >= rules.least_words) & (words > rules.word_limit + spare)
    odd = judged & (m.base["word_chars"] >= rules.least_chars) & (shapes > rules.class_limit + spare)
    none = np.where(judged, 1.0, np.nan)
    return {"word_distance": words * none, "class_distance": shapes * none, "kept": ~(m.base["base_failed"] | far | odd)}


def rate(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rules: Rules = Rules(),
) -> DataFrame:
    """One row per row of `df`: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    word_distance, class_distance, kept.

    Words are what blanks, tabs and line ends part. A text fails the base rules with fewer than 10
    words, or with over a fifth of them in 5-word windows that it holds twice. Others are compared
    with the reference of their language, learnt from all texts of `df` that pass the base rules:
    the histogram of the commonest lower-case words and all others, and that of the classes of
    characters. Texts too short for a test (`Rules`) are not judged by it. A text whose language is
    null or has no reference is compared with the nearest one; without any reference the distances
    are null and the base rules decide. Null text: no words. Repeated rows and null ids stay as they
    are, an empty table gives no rows, and other columns of `df` are not read.
    """
    references = learn(df, text_col, lang_col, rules)
    rows = df.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    numbers = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, given in texts(batches, 128):
            m = measure(some)
            verdict = judge(m, given.column("lang").to_pylist(), references, rules)
            yield pa.RecordBatch.from_arrays(
                [
                    given.column("id"),
                    *(pa.array(m.base[c], pa.int64()) for c in numbers),
                    pa.array(m.base["base_failed"]),
                    pa.array(verdict["word_distance"], from_pandas=True),
                    pa.array(verdict["class_distance"], from_pandas=True),
                    pa.array(verdict["kept"]),
                ],
                ["id", *numbers, "base_failed", "word_distance", "class_distance", "kept"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in numbers)
    return rows.mapInArrow(
        rated, f"id {kind}, {longs}, base_failed boolean, word_distance double, class_distance double, kept boolean"
    ).withColumnRenamed("id", id_col)


def keep(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules()) -> DataFrame:
    """The rows of `df` that `rate` keeps, with all their columns."""
    references = learn(df, text_col, lang_col, rules)

    @F.pandas_udf("boolean")
    def kept(text, lang):
        import pandas as pd

        verdicts = []
        for at in range(0, len(text), 512):
            some = [x or "" for x in text.iloc[at : at + 512]]
            langs = [x if isinstance(x, str) else None for x in lang.iloc[at : at + 512]]
            verdicts.append(judge(measure(some), langs, references, rules)["kept"])
        return pd.Series(np.concatenate(verdicts) if verdicts else np.zeros(0, bool))

    return df.where(kept(F.col(text_col), F.col(lang_col).cast("string")))
