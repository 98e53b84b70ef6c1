"""Phrase collocations: counts of all phrases by marginalising the longest windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.shared import short_batches, store

LONGEST = 5
#: Bytes of one language's texts that are counted together in a task.
TOGETHER = 1 << 20
#: Where phrases end, and what parts words inside a piece.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
NORMAL = bytes(0x0A if x in ENDS else 0x20 if x in BLANKS else bytes([x]).lower()[0] for x in range(256))
UNDETERMINED = "und"
#: Bits of the sieve for a pair that is frequent, and the most bits it ever has (16 MB).
BITS_A_PAIR, MOST_BITS = 16, 1 << 27


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(language, normalised text) of up to about TOGETHER bytes, cut where phrases end (a longer piece stays whole)."""
    pending: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            lang, left = lang.as_py(), (text.as_py() or "").encode().translate(NORMAL)
            while left:
                cut = len(left)
                if cut > TOGETHER:
                    cut = left.rfind(b"\n", 0, TOGETHER)
                    cut = cut if cut >= 0 else left.find(b"\n")
                    cut = cut if cut >= 0 else len(left)
                part, left = left[:cut], left[cut + 1 :]
                pending.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part) + 1
                if sizes[lang] > TOGETHER:
                    yield lang, b"\n".join(pending.pop(lang))
                    del sizes[lang]
            if sum(sizes.values()) > 4 * TOGETHER:
                for some in list(pending):
                    yield some, b"\n".join(pending.pop(some))
                sizes.clear()
    for lang, parts in pending.items():
        yield lang, b"\n".join(parts)


def numbered_words(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The words of a normalised text as numbers, and their spellings; 0, spelled empty, ends a piece."""
    table = {b"\n": 0}
    found = [table.setdefault(w, len(table)) for w in text.replace(b"\n", b" \n ").split(b" ") if w]
    return np.array([*found, 0], np.int64), [b"", *list(table)[1:]]


def windows(ids: np.ndarray, linked: np.ndarray, order: int) -> np.ndarray:
    """The window of `order` words that begins at each word, a column a place, padded with 0 from the first word on
    that is not linked to the one before it. `linked[i]` tells it of words i and i + 1.
    """
    padded = np.concatenate([ids, np.zeros(order, np.int64)])
    joined = np.concatenate([linked, np.zeros(order, bool)])
    lead = [ids]
    going = np.ones(len(ids), bool)
    for k in range(1, order):
        going &= joined[k - 1 : k - 1 + len(ids)]
        lead.append(np.where(going, padded[k : k + len(ids)], 0))
    return np.stack(lead, 1)


def distinct(rows: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of small numbers, and how often each occurs."""
    if not len(rows):
        return rows, np.zeros(0, np.int64)
    name = rows[:, 0]
    for k in range(1, rows.shape[1]):
        name = name * np.int64(words) + rows[:, k]
        if k + 1 < rows.shape[1]:
            name = np.unique(name, return_inverse=True)[1]
    _, first, n = np.unique(name, return_index=True, return_counts=True)
    return rows[first], n


def prefixes(rows: np.ndarray, n: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The different beginnings of `words` words that `distinct` windows have, and how often: sums over those windows.

    The windows are in order, so those that begin alike stand together; padded beginnings are left out.
    """
    full = rows[:, words - 1] > 0
    rows, n = rows[full, :words], n[full]
    if not len(rows):
        return rows, n
    first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
    return rows[first], np.add.reduceat(n, first)


def _counted(lang: str, rows: np.ndarray, n: np.ndarray, spelled: pa.Array) -> pa.RecordBatch:
    words = [pc.take(spelled, pa.array(rows[:, k])) for k in range(rows.shape[1])]
    phrases = pc.binary_join_element_wise(*words, " ") if words else pa.array([""] * len(n), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(n), pa.string()), phrases, pa.array(n, pa.int64())], ["lang", "phrase", "n"]
    )


def _pair_hashes(first: np.ndarray, second: np.ndarray, lang: str) -> np.ndarray:
    """A 64-bit hash of each pair of word hashes in a language."""
    salt = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
    mixed = (first * np.uint64(0x9E3779B97F4A7C15) + second) ^ salt
    mixed ^= mixed >> np.uint64(29)
    return mixed * np.uint64(0xBF58476D1CE4E5B9)


def _word_hashes(names: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))


def _spots(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bit of each hash; `bits` is a power of two."""
    return (hashes >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)


def sieve(pairs: DataFrame) -> tuple[int, np.ndarray]:
    """A bitmap that tells of any pair (lang, w1, w2) of `pairs` that it is there, and of few others.

    It has BITS_A_PAIR bits for each pair, so its size follows the table's, but MOST_BITS at most: a fuller
    map lets more other pairs through, which costs work further on and changes no count.
    """
    wanted = BITS_A_PAIR * pairs.count()
    bits = min(MOST_BITS, max(1 << 16, 1 << (wanted - 1).bit_length() if wanted else 0))

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [_word_hashes([w.encode() for w in batch.column(c).to_pylist()]) for c in ("w1", "w2")]
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in set(langs):
                mine = np.flatnonzero(langs == lang)
                at = _spots(_pair_hashes(words[0][mine], words[1][mine], lang), bits)
                yield pa.RecordBatch.from_pydict(
                    {"slot": pa.array(at >> 5), "mask": pa.array(np.int64(1) << (at & 31))}
                )

    slots = pairs.mapInArrow(spots, "slot long, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask"))
    map_ = np.zeros(bits >> 5, np.uint32)
    found = slots.toArrow()
    map_[found.column("slot").to_numpy()] = found.column("mask").to_numpy().astype(np.uint32)
    return bits, map_


def _phrases(df: DataFrame, order: int, kept: tuple[int, np.ndarray] | None, shortest: int) -> DataFrame:
    """(lang, phrase, n) of every phrase of `shortest` to `order` words, space-joined: sums over the windows it begins.

    The longest windows are counted, and their beginnings added up, for some bytes of text at a time, so only phrases
    that are there reach the sums over all texts. Without a sieve each word begins a window. With one, a window ends
    where a pair does not pass it, and only windows of two words or more are counted. With 0 the shortest phrase
    is the empty one, which stands for the language itself.
    """
    shared = df.sparkSession.sparkContext.broadcast(kept)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text in chunks(batches):
            ids, names = numbered_words(text)
            linked = (ids[:-1] > 0) & (ids[1:] > 0)
            if shared.value is not None:
                bits, map_ = shared.value
                hashes = _word_hashes(names)
                at = _spots(_pair_hashes(hashes[ids[:-1]], hashes[ids[1:]], lang), bits)
                linked &= (map_[at >> 5] >> (at & 31).astype(np.uint32) & np.uint32(1)) > 0
                starts = np.append(linked, False)
            else:
                starts = ids > 0
            rows, n = distinct(windows(ids, linked, order)[starts], len(names))
            spelled = pa.array(names, pa.binary()).cast(pa.string())
            if not shortest and len(n):
                yield _counted(lang, np.zeros((1, 0), np.int64), n.sum(keepdims=True), spelled)
            for length in range(max(shortest, 1), order + 1):
                some, times = prefixes(rows, n, length)
                for k in range(0, len(times), 100_000):
                    yield _counted(lang, some[k : k + 100_000], times[k : k + 100_000], spelled)

    rows = df.mapInArrow(counted, "lang string, phrase string, n long")
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _split(phrases: DataFrame) -> DataFrame:
    """(lang, words, n): no word holds a space."""
    words = F.when(F.col("phrase") != "", F.split("phrase", " ")).otherwise(F.array().cast("array<string>"))
    return phrases.select("lang", words.alias("words"), "n")


def phrase_counts(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = 100
) -> tuple[DataFrame, DataFrame]:
    """(lang, n) of all words of each language, and (lang, words, n) of every phrase that occurs `least` times or more.

    Each word begins one window, so the sum over windows with a prefix is the number of times the prefix occurs; one
    pass gives the counts of all its lengths. It is done twice. Windows of two words give the totals, words
    and pairs. A longer phrase is no more frequent than the pairs in it, so the windows of `longest` words are then
    padded from the first pair on that is too rare; they are few enough to be shuffled.
    """
    texts = df.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDETERMINED)).alias("lang"), F.col(text_col).alias("text")
    )
    size = F.size("words")
    short = _phrases(texts, 2, None, 0).where((F.col("phrase") == "") | (F.col("n") >= least))
    with short_batches(df.sparkSession):
        short = store(_split(short), "words-and-pairs")
    totals = short.where(size == 0).select("lang", "n")
    pairs = short.where(size == 2).select("lang", F.col("words")[0].alias("w1"), F.col("words")[1].alias("w2"))
    if longest == 2:
        return totals, short.where(size > 0)
    with short_batches(df.sparkSession):
        long = _phrases(texts, longest, sieve(pairs), 2).where(F.col("n") >= least)
        long = store(_split(long), "phrases")
    return totals, short.where(size == 1).unionByName(long)


def mine(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    least: int = 100,
    covered_percent: int = 100,
    top: int = 2000,
) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Pieces end at `.,;:!?` and line ends, words at blanks and tabs; A-Z are lower-cased; a null lang is `und`, a
    null text empty. Candidates are phrases of 2 to `longest` words that occur `least` times or more (a). A cut into
    two parts that occur l and r times scores floor(1000 * a * n / (l * r)), n being all words of the
    language; the lowest-scoring cut counts, the earliest of equal ones. A candidate inside a longer one that occurs
    `covered_percent` of its times or more is dropped. Ranks go by score and a, highest first, then by the phrase's bytes.
    Repeated rows count as often as they are there; ids and other columns are not read; a table without phrases
    that frequent gives no rows. Arithmetic is in decimals of 38 digits, which hold 1000 * a * n up to 10^17 words.
    """
    totals, counts = phrase_counts(df, text_col, lang_col, longest, least)
    spelled = counts.select("lang", F.array_join("words", " ").alias("part"), F.col("n").alias("times"))
    candidates = counts.where(F.size("words") >= 2).select("lang", "words", F.col("n").alias("a"))
    # a longer candidate that covers one has an equal or shorter one within it that is longer by one word and does too
    parts = F.array(F.expr("slice(words, 1, size(words) - 1)"), F.expr("slice(words, 2, size(words) - 1)"))
    covers = (
        candidates.where(F.size("words") >= 3)
        .select("lang", F.explode(parts).alias("words"), F.col("a").alias("times"))
        .groupBy("lang", "words")
        .agg(F.max("times").alias("_covers"))
    )
    cuts = candidates.select(
        "lang",
        "words",
        "a",
        F.explode(F.expr("sequence(1, size(words) - 1)")).alias("cut"),
    ).select(
        "*",
        F.expr("array_join(slice(words, 1, cut), ' ')").alias("_left"),
        F.expr("array_join(slice(words, cut + 1, size(words) - cut), ' ')").alias("_right"),
    )
    scored = (
        cuts.join(spelled.select("lang", F.col("part").alias("_left"), F.col("times").alias("l")), ["lang", "_left"])
        .join(spelled.select("lang", F.col("part").alias("_right"), F.col("times").alias("r")), ["lang", "_right"])
        .join(totals, "lang")
        .withColumn("score", F.expr("(cast(1000 as decimal(38, 0)) * a * n) div (cast(l as decimal(38, 0)) * r)"))
        .groupBy("lang", "words")
        .agg(
            F.min(F.struct("score", "cut", "l", "r")).alias("best"),
            F.first("a").alias("a"),
            F.first("n").alias("n"),
        )
    )
    kept = (
        scored.join(covers, ["lang", "words"], "left")
        .where(F.col("_covers").isNull() | (100 * F.col("_covers") < covered_percent * F.col("a")))
        .select("lang", F.array_join("words", " ").alias("phrase"), "a", "best.l", "best.r", "n", "best.score")
    )
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # first within parts of a language, so that no task orders all of it
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = kept.withColumn("_part", part).withColumn(
        "_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
    )
    last = first.where(F.col("_place") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return last.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
