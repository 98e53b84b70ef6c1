"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.trie import DoubleArray, batches

MARK = "▁"
#: What an unknown character scores below the lowest piece.
UNKNOWN = 10.0
#: Parts of texts a task remembers the ids of; beyond it the memory is emptied.
MEMORY = 300_000
PARTS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


@dataclass
class Pieces:
    """A vocabulary: the bytes each id stands for, scores of ordinary pieces, ids of the 256 byte pieces."""

    shown: list[bytes]
    ordinary: list[int]
    scores: np.ndarray
    bytes_at: list[int]

    @classmethod
    def read(cls, path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        shown, ordinary, bytes_at = [], [], [0] * 256
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                bytes_at[int(piece[3:5], 16)] = i
                shown.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                shown.append(b"")
            else:
                ordinary.append(i)
                shown.append(piece.encode())
        scores = np.array([model.get_score(i) for i in range(model.vocab_size())])
        return cls(shown, ordinary, scores, bytes_at)


class Codec:
    """Encodes texts to ids and back. Blanks become marks, and one mark goes before a text.

    No piece has a mark after another character, so the best path of a text is those of its parts,
    each a run of marks and what follows up to the next; parts met before are remembered.
    """

    def __init__(self, pieces: Pieces, trie: DoubleArray):
        self.pieces, self.trie = pieces, trie
        self.unknown = float(pieces.scores[pieces.ordinary].min()) - UNKNOWN
        self.known: dict[str, int] = {}
        self.ids: list[bytes] = []
        self.scores: list[float] = []
        self.size = np.fromiter(map(len, pieces.shown), np.int64, len(pieces.shown))
        self.begin = np.cumsum(self.size) - self.size
        self.letters = np.frombuffer(b"".join(pieces.shown), np.uint8)

    @classmethod
    def build(cls, pieces: Pieces) -> Codec:
        inner = re.compile(f"[^{MARK}]{MARK}".encode())
        if any(inner.search(pieces.shown[i]) for i in pieces.ordinary):
            raise ValueError("a piece has a mark after another character, so texts have no parts of their own")
        return cls(pieces, DoubleArray.build([pieces.shown[i] for i in pieces.ordinary], pieces.ordinary))

    def viterbi(self, parts: list[bytes]) -> tuple[list[bytes], list[float]]:
        """Ids (little-endian 32-bit integers) and score of the best path of each part.

        A character that no piece of its own covers may be passed as unknown; it then becomes its
        byte pieces. Of paths that score alike the one whose last piece is longest wins.
        """
        ids: list[bytes] = [b""] * len(parts)
        scores = [0.0] * len(parts)
        for places, letters, size in batches(parts):
            n, width = letters.shape
            best = np.full((n, width + 1), -np.inf)
            best[:, 0] = 0
            origin, by = np.zeros((n, width + 1), np.int32), np.full((n, width + 1), -1, np.int32)
            # bytes of the character that begins here; 0 inside one
            char = np.select([letters < 0x80, letters < 0xC0, letters < 0xE0, letters < 0xF0], [1, 0, 2, 3], 4)

            def unknown(start: int, covered: np.ndarray) -> None:
                rows = np.flatnonzero((size > start) & (char[:, start] > 0) & ~covered)
                end = start + char[rows, start]
                total = best[rows, start] + self.unknown
                better = total > best[rows, end]
                rows, end = rows[better], end[better]
                best[rows, end], origin[rows, end], by[rows, end] = total[better], start, -1

            at, covered = 0, np.zeros(n, bool)
            for start, end, rows, found in self.trie.walk(letters, size):
                while at < start:
                    unknown(at, covered)
                    at, covered = at + 1, np.zeros(n, bool)
                total = best[rows, start] + self.pieces.scores[found]
                better = total > best[rows, end]
                rows_better = rows[better]
                best[rows_better, end] = total[better]
                origin[rows_better, end], by[rows_better, end] = start, found[better]
                covered[rows[char[rows, start] == end - start]] = True
            while at < width:
                unknown(at, covered)
                at, covered = at + 1, np.zeros(n, bool)
            for row, (place, end) in enumerate(zip(places.tolist(), size.tolist(), strict=True)):
                path: list[int] = []
                back, taken = origin[row], by[row]
                while end:
                    start, piece = int(back[end]), int(taken[end])
                    if piece >= 0:
                        path.append(piece)
                    else:
                        path.extend(self.pieces.bytes_at[x] for x in letters[row, start:end][::-1].tolist())
                    end = start
                ids[place] = np.array(path[::-1], "<u4").tobytes()
                scores[place] = float(best[row, size[row]])
        return ids, scores

    def encode(self, texts: list[str]) -> list[tuple[bytes, float]]:
        """(ids as little-endian 32-bit integers, score) of each text; an empty text has no ids."""
        cut = []
        for text in texts:
            if not text:
                cut.append([])
            elif "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
                cut.append(PARTS.findall(MARK + text.replace(" ", MARK)))
            else:
                cut.append([MARK + x for x in text.split(" ")])
        if len(self.known) > MEMORY:
            self.known, self.ids, self.scores = {}, [], []
        missing = list(dict.fromkeys(x for parts in cut for x in parts if x not in self.known))
        ids, scores = self.viterbi([x.encode() for x in missing])
        self.known.update(zip(missing, range(len(self.ids), len(self.ids) + len(missing)), strict=True))
        self.ids += ids
        self.scores += scores
        result = []
        for parts in cut:
            at = [self.known[x] for x in parts]
            result.append((b"".join([self.ids[i] for i in at]), float(sum([self.scores[i] for i in at]))))
        return result

    def decode(self, ids: np.ndarray) -> str:
        """The text of these ids: marks become blanks, byte pieces their bytes, the first mark goes."""
        size = self.size[ids]
        first = np.cumsum(size) - size
        at = np.repeat(self.begin[ids] - first, size) + np.arange(int(size.sum()))
        shown = self.letters[at].tobytes().replace(MARK.encode(), b" ")
        return shown.removeprefix(b" ").decode(errors="replace")


def _parts(codec: Codec) -> tuple:
    pieces, trie = codec.pieces, codec.trie
    return (pieces.shown, pieces.ordinary, pieces.scores, pieces.bytes_at), (trie.base, trie.check, trie.value)


def _codec(parts: tuple) -> Codec:
    return Codec(Pieces(*parts[0]), DoubleArray(*parts[1]))


def codec(path: str | None = None) -> Codec:
    return Codec.build(Pieces.read(path or public_tokenizers.path("piece_bpe_32k.model")))


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """All columns of `docs` and, under `pieces`, (ids, score, byte_ids) of the text.

    A null or empty text has no ids and score 0; `byte_ids` counts ids of byte pieces. A column of
    `docs` named `pieces` is replaced; an empty table stays empty.
    """
    spread = docs.sparkSession.sparkContext.broadcast(_parts(codec(path)))

    @F.pandas_udf("ids array<int>, score double, byte_ids int")
    def encoded(batches_of: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _codec(spread.value)
        is_byte = np.zeros(len(model.size), bool)
        is_byte[model.pieces.bytes_at] = True
        for some in batches_of:
            rows = []
            for at in range(0, len(some), 256):
                for ids, score in model.encode([x or "" for x in some.iloc[at : at + 256]]):
                    found = np.frombuffer(ids, "<u4").astype(np.int32)
                    rows.append((found, score, int(is_byte[found].sum())))
            yield pd.DataFrame(rows, columns=["ids", "score", "byte_ids"])

    return docs.withColumn("pieces", encoded(F.col(text_col)))


def decode(rows: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """All columns of `rows` and the text of the ids under `decoded`; null ids have a null text."""
    spread = rows.sparkSession.sparkContext.broadcast(_parts(codec(path)))

    @F.pandas_udf("string")
    def decoded(batches_of: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _codec(spread.value)
        for some in batches_of:
            yield some.map(lambda ids: None if ids is None else model.decode(np.asarray(ids, np.int64)))

    return rows.withColumn("decoded", decoded(F.col(ids_col)))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per row: doc_id, n_ids, byte_ids, score, ids_crc32, decoded_crc32, round_trip.

    Encodes and decodes each text where it lies. `round_trip` says whether the decoded text is the
    text (a null counts as empty); it is not where a text has marks of its own, which decode to blanks.
    """
    spread = docs.sparkSession.sparkContext.broadcast(_parts(codec(path)))

    @F.pandas_udf("n_ids long, byte_ids long, score double, ids_crc32 long, decoded_crc32 long, round_trip boolean")
    def digested(batches_of: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _codec(spread.value)
        is_byte = np.zeros(len(model.size), bool)
        is_byte[model.pieces.bytes_at] = True
        for some in batches_of:
            rows = []
            for at in range(0, len(some), 256):
                texts = [x or "" for x in some.iloc[at : at + 256]]
                for text, (ids, score) in zip(texts, model.encode(texts), strict=True):
                    found = np.frombuffer(ids, "<u4")
                    back = model.decode(found)
                    rows.append(
                        (len(found), int(is_byte[found].sum()), score, zlib.crc32(ids), zlib.crc32(back.encode()), back == text)
                    )
            yield pd.DataFrame(
                rows, columns=["n_ids", "byte_ids", "score", "ids_crc32", "decoded_crc32", "round_trip"]
            )

    return docs.select("doc_id", digested(F.col("text")).alias("_of")).select("doc_id", "_of.*")
