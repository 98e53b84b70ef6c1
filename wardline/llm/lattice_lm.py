"""Language-model scoring: the probability of a text summed over all segmentations into pieces."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.shared import remainder, store
from wardline.llm.trie import DoubleArray, batches
from wardline.llm.unigram import MARK, Pieces

#: Rounds of re-estimation of the pieces' probabilities, and what is added to a piece's expected count.
ROUNDS, FLOOR = 3, 0.01
#: Taken off the count of every known word, for the lattice of pieces to share out.
DISCOUNT = 0.5
#: Words with 1/HEAVY of all tokens or more, so HEAVY at most, are broadcast; all others are joined.
HEAVY = 500_000
#: A task adds up so many different words before it passes their counts on.
MEMORY = 400_000
#: The token that ends every text; no word is empty.
END = b""


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, and the end."""
    return [*text.encode().lower().split(), END]


@dataclass
class Lattice:
    """Pieces, each with the log of its probability, and the log probability that a word ends."""

    trie: DoubleArray
    pieces: np.ndarray
    end: float

    def forward(self, letters: np.ndarray, arcs: list) -> np.ndarray:
        """Log of the summed probability of all paths from the start to each place."""
        reached = np.full((len(letters), letters.shape[1] + 1), -np.inf)
        reached[:, 0] = 0
        for start, end, rows, ids in arcs:
            reached[rows, end] = np.logaddexp(reached[rows, end], reached[rows, start] + self.pieces[ids])
        return reached

    def log_probability(self, words: list[bytes]) -> np.ndarray:
        """Natural log of the marginal probability of each word over all its segmentations; -inf for END."""
        result = np.full(len(words), -np.inf)
        for places, letters, size in batches([MARK.encode() + x for x in words]):
            reached = self.forward(letters, list(self.trie.walk(letters, size)))
            result[places] = reached[np.arange(len(places)), size] + self.end
        result[np.fromiter((x == END for x in words), bool, len(words))] = -np.inf
        return result

    def expected(self, words: list[bytes]) -> np.ndarray:
        """How often each piece is expected in these words, by forward and backward sums."""
        counts = np.zeros(len(self.pieces))
        for _, letters, size in batches([MARK.encode() + x for x in words]):
            arcs = list(self.trie.walk(letters, size))
            reached = self.forward(letters, arcs)
            rest = np.full_like(reached, -np.inf)
            rest[np.arange(len(size)), size] = 0
            for start, end, rows, ids in reversed(arcs):
                rest[rows, start] = np.logaddexp(rest[rows, start], self.pieces[ids] + rest[rows, end])
            total = rest[:, 0]
            share = [np.exp(reached[r, s] + self.pieces[i] + rest[r, e] - total[r]) for s, e, r, i in arcs]
            counts += np.bincount(np.concatenate([i for *_, i in arcs]), np.concatenate(share), len(counts))
        return counts


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """The file's ordinary pieces and all single bytes, best first by the file's scores, with log probabilities.

    The scores are ranks; Zipf's law makes probabilities of them, from which re-estimation starts.
    Bytes that are no piece come last, so that every text has a segmentation.
    """
    pieces = Pieces.read(path)
    order = sorted(pieces.ordinary, key=lambda i: (-pieces.scores[i], i))
    shown = list(dict.fromkeys(pieces.shown[i] for i in order))
    known = set(shown)
    shown += [x for x in (bytes([i]) for i in range(256)) if x not in known]
    share = 1 / (np.arange(len(shown)) + 10.0)
    return shown, np.log(share / share.sum())


def counted(batches_of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, trained, all_docs): counts of one task in training documents and in all."""

    def passed(found: list[Counter[bytes]]) -> pa.RecordBatch:
        words = list(found[0].keys() | found[1].keys())
        trained = [found[0][x] for x in words]
        both = [n + found[1][x] for n, x in zip(trained, words, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array(trained, pa.int64()), pa.array(both, pa.int64())],
            ["word", "trained", "all_docs"],
        )

    found = [Counter(), Counter()]
    for batch in batches_of:
        for text, held_out in zip(batch.column("text").to_pylist(), batch.column("held_out").to_pylist(), strict=True):
            found[held_out].update(tokens(text or ""))
            if len(found[0]) + len(found[1]) > MEMORY:
                yield passed(found)
                found = [Counter(), Counter()]
    yield passed(found)


def estimate(words: DataFrame, path: str, rounds: int = ROUNDS) -> tuple[list[bytes], np.ndarray, float]:
    """(pieces, log probabilities, log probability of a word's end) by expectation-maximisation.

    `words` are the different words of the training documents. Each counts once, whatever its
    number of tokens, as the lattice is for words not known well. Expected counts, one per piece,
    are all that reaches the driver.
    """
    shown, pieces = vocabulary(path)
    end = float(np.log(0.25))
    context = words.sparkSession.sparkContext
    for _ in range(rounds):
        spread = context.broadcast((shown, pieces, end))

        def expected(batches_of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = lattice(*spread.value)  # noqa: B023
            counts, seen = np.zeros(len(model.pieces) + 1), 0
            for batch in batches_of:
                found = batch.column(0).to_pylist()
                counts[:-1] += model.expected(found)
                seen += len(found)
            counts[-1] = seen
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["piece", "n"])

        sums = words.mapInArrow(expected, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        n = np.zeros(len(shown) + 1)
        n[sums.column("piece").to_numpy()] = sums.column("n").to_numpy()
        n[: len(shown)] += FLOOR
        n[-1] += FLOOR
        pieces, end = np.log(n[:-1] / n.sum()), float(np.log(n[-1] / n.sum()))
        spread.destroy()
    return shown, pieces, end


def lattice(shown: list[bytes], pieces: np.ndarray, end: float) -> Lattice:
    return Lattice(DoubleArray.build(shown, range(len(shown))), pieces, end)


def score(docs: DataFrame, held_out: Column | None = None, path: str | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents that are not held out (by default, crc32 of the id modulo 5 is 1).
    `base_score` adds up log10((c + 0.5) / (N + 0.5 (V + 1))). `score` is the log10 probability of
    the text: a word has (c - DISCOUNT) / N as one whole piece and, for what the discounts of all V
    words leave, the marginal probability of its lattice of pieces; both are summed. The end of a
    text has c / N.

    A null text is empty and has the end alone; a row with a null id is not held out; repeated rows
    are learnt from and scored each; without training documents the lattice alone scores; an empty
    table gives no rows; other columns are not read.
    """
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    fold = F.coalesce(held_out if held_out is not None else remainder(F.col("doc_id"), 5) == 1, F.lit(False))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", fold.alias("held_out"))
    counts = store(
        rows.select("text", "held_out")
        .mapInArrow(counted, "word binary, trained long, all_docs long")
        .groupBy("word")
        .agg(F.sum("trained").alias("trained"), F.sum("all_docs").alias("all_docs")),
        "word-counts",
    )
    known = F.col("trained") > 0
    sums = counts.agg(F.sum("trained"), F.sum(known.cast("long")), F.sum("all_docs")).first()
    n, v, everything = (x or 0 for x in sums)
    trained = counts.where(known & (F.length("word") > 0)).select("word")
    spread = docs.sparkSession.sparkContext.broadcast(estimate(trained, path))

    def scored(batches_of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = lattice(*spread.value)
        for batch in batches_of:
            words = batch.column("word")
            c = batch.column("trained").to_numpy().astype(float)
            base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
            found = words.to_pylist()
            spelled = np.exp(model.log_probability(found)) * (DISCOUNT * v / n if n else 1.0)
            ends = np.fromiter((x == END for x in found), bool, len(found))
            whole = np.where(ends, c, np.maximum(c - DISCOUNT, 0)) / max(n, 1)
            both = whole + spelled
            # 0 only for an end never learnt, or a word too long for a double: then its log alone
            tiny = both == 0
            result = np.log10(np.where(tiny, 1, both))
            if tiny.any():
                some = [x for x, t in zip(found, tiny, strict=True) if t]
                of_some = model.log_probability(some) / np.log(10) + np.log10(DISCOUNT * v / n if n else 1.0)
                result[tiny] = np.where(np.isfinite(of_some), of_some, base[tiny])
            yield pa.RecordBatch.from_arrays(
                [words, batch.column("trained"), pa.array(base), pa.array(result)], ["word", "trained", "base", "score"]
            )

    def with_scores(some: DataFrame) -> DataFrame:
        return some.select("word", "trained").mapInArrow(scored, "word binary, trained long, base double, score double")

    is_heavy = F.col("all_docs") * HEAVY >= everything
    frequent = with_scores(counts.where(is_heavy)).toArrow()
    columns = [frequent.column(x).to_pylist() for x in ("word", "trained", "base", "score")]
    heavy = docs.sparkSession.sparkContext.broadcast(dict(zip(columns[0], zip(*columns[1:], strict=True), strict=True)))

    def looked_up(batches_of: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per document with the sums over its frequent words, and a row per other word of it."""
        get = heavy.value.get
        for batch in batches_of:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                sums, of, words, times = [], [], [], []
                for i, text in enumerate(some.column("text").to_pylist()):
                    found = tokens(text or "")
                    n_known, base, total = 0, 0.0, 0.0
                    for word, k in Counter(found).items():
                        hit = get(word)
                        if hit is None:
                            of.append(i)
                            words.append(word)
                            times.append(k)
                        else:
                            n_known += k if hit[0] else 0
                            base += k * hit[1]
                            total += k * hit[2]
                    sums.append((len(found), n_known, base, total))
                n_tokens, n_known, base, total = zip(*sums, strict=True)
                table = pa.table(
                    {
                        "row": some.column("row"),
                        "doc_id": some.column("doc_id"),
                        "held_out": some.column("held_out"),
                        "word": pa.nulls(len(sums), pa.binary()),
                        "n": pa.array(n_tokens, pa.int64()),
                        "n_known": pa.array(n_known, pa.int64()),
                        "base": pa.array(base, pa.float64()),
                        "score": pa.array(total, pa.float64()),
                    }
                )
                rest = pa.table(
                    {
                        "row": some.column("row").take(pa.array(of, pa.int64())),
                        "doc_id": pa.nulls(len(of), some.column("doc_id").type),
                        "held_out": pa.nulls(len(of), pa.bool_()),
                        "word": pa.array(words, pa.binary()),
                        "n": pa.array(times, pa.int64()),
                        "n_known": pa.nulls(len(of), pa.int64()),
                        "base": pa.nulls(len(of), pa.float64()),
                        "score": pa.nulls(len(of), pa.float64()),
                    }
                )
                yield from table.to_batches()
                yield from rest.to_batches()

    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = store(
        rows.mapInArrow(
            looked_up,
            f"row long, doc_id {kind}, held_out boolean, word binary, n long, n_known long, base double, score double",
        ),
        "word-uses",
    )
    rare = with_scores(counts.where(~is_heavy))
    uses = parts.where(F.col("word").isNotNull()).select("row", "word", "n").join(rare, "word")
    times = F.col("n")
    sums_of_rare = uses.groupBy("row").agg(
        F.sum(F.when(F.col("trained") > 0, times).otherwise(0)).alias("rare_known"),
        F.sum(times * F.col("base")).alias("rare_base"),
        F.sum(times * F.col("score")).alias("rare_score"),
    )

    def plus(a: str, b: str) -> Column:
        return F.col(a) + F.coalesce(F.col(b), F.lit(0))

    return (
        parts.where(F.col("word").isNull())
        .join(sums_of_rare, "row", "left")
        .select(
            "doc_id",
            "held_out",
            F.col("n").alias("n_tokens"),
            plus("n_known", "rare_known").alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"),
            plus("base", "rare_base").alias("base_score"),
            plus("score", "rare_score").alias("score"),
        )
    )
