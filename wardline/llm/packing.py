"""Packing token sequences: shortest-pack-first over the length histogram."""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.shared import numbered, store

#: Tokens of a sequence, and the id that ends a document.
LENGTH = 1024
END = 0
#: The special token of the vocabulary, as its JSON file has it.
SPECIAL = {"<|endoftext|>": 50256}
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(name: str = "byte_bpe_50k") -> tiktoken.Encoding:
    """The byte-level BPE of `<name>.json`, from its ranks: the same ids, several times as fast.

    One per Python worker. `encode_ordinary` takes the string of the special token as ordinary text.
    """
    if name not in _encodings:
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encodings[name] = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
        )
    return _encodings[name]


def encoder(name: str, special: bool) -> Callable[[str], list[int]]:
    """Ids of a text, without END. If `special`, the string of the special token is that one token, wherever it stands.

    Where a run of blanks or line ends is too long for the pattern of the fast form, the JSON file's tokenizer takes the text.
    """
    fast = partial(encoding(name).encode, allowed_special=set(SPECIAL) if special else set(), disallowed_special=())

    def encode(text: str) -> list[int]:
        try:
            return fast(text)
        except ValueError:
            return tokenizer(name, special).encode(text, add_special_tokens=False).ids

    return encode


_tokenizers: dict = {}


def tokenizer(name: str, special: bool):
    """The tokenizer of `<name>.json`, one per Python worker; it and its library are loaded when first needed."""
    from tokenizers import Tokenizer

    if (name, special) not in _tokenizers:
        _tokenizers[name, special] = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        _tokenizers[name, special].encode_special_tokens = not special
    return _tokenizers[name, special]


def cut(ids: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(start, ids) of each piece of a document: full sequences, then what remains."""
    for start in range(0, len(ids), length):
        yield start, ids[start : start + length]


def pieces(
    docs: DataFrame, id_col: str, text_col: str, name: str, length: int, keep_ids: bool = False, special: bool = False
) -> DataFrame:
    """The pieces of all documents, with their ids if `keep_ids`; null text counts as empty."""

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(name, special)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                some = batch.slice(at, 256)
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    ids = np.array([*encode(text or ""), END], "<u4")
                    for start, part in cut(ids, length):
                        rows.append((doc_id, start, len(part), zlib.crc32(part), len(ids), *([part] * keep_ids)))
                columns = zip(*rows, strict=True)
                kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * keep_ids
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(x), kind) for x, kind in zip(columns, kinds, strict=True)], names[: len(kinds)]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tokenized, PIECES + ", ids array<long>" * keep_ids)


def patterns(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """Shortest-pack-first: (lengths of a pack, number of such packs), from counts of lengths alone.

    Lengths go longest first, each into the shortest pack (the one with most room) that has room
    for it, else into a new one. All packs of one pattern are handled at once, so the work depends
    on the number of lengths and patterns, not on the number of pieces.
    """
    room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        for most in range(length, size - 1, -1):
            while left and room[most]:
                pack, n = room[most].pop()
                used = min(n, left)
                if used < n:
                    room[most].append((pack, n - used))
                room[most - size].append(((*pack, size), used))
                left -= used
        # a new pack is the shortest one until it is full of this length
        most = length // size
        for copies, n in ((most, left // most), (left % most, 1)):
            if copies and n:
                room[length - copies * size].append(((size,) * copies, n))
    return [x for packs in room.values() for x in packs]


class Layout:
    """Where the piece of a given length and rank goes: ranges of ranks, by length."""

    def __init__(self, packs: list[tuple[tuple[int, ...], int]]):
        ranges: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        taken: dict[int, int] = defaultdict(int)
        first_sequence = 0
        for pack, n in packs:
            offset = 0
            for size in pack:
                ranges[size].append((taken[size], first_sequence, offset))
                taken[size] += n
                offset += size
            first_sequence += n
        self.ranges = {size: np.array(x, np.int64).T for size, x in ranges.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence_id, offset) of each piece."""
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for size in np.unique(length):
            here = length == size
            start, first_sequence, within = self.ranges[size]
            at = np.searchsorted(start, rank[here], "right") - 1
            sequence[here] = first_sequence[at] + rank[here] - start[at]
            offset[here] = within[at]
        return sequence, offset


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    name: str = "byte_bpe_50k",
    length: int = LENGTH,
    keep_ids: bool = False,
    special: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, (ids,) sequence_id, offset.

    A document is the ids of its text and the id END; a null text counts as empty, so every row has
    at least one piece. Documents longer than a sequence are cut into full sequences and a rest.
    Sequences are gapless from offset 0, at most `length` long, and padded at their end to
    `length`. Rows with a null or repeated id are packed like any other; an empty table gives no
    rows; other columns are not read. With `special`, `<|endoftext|>` in a text is the id 50256, as
    the JSON file's tokenizer has it when loaded; without, it is spelled out.

    Only the histogram of lengths, at most `length` rows, reaches the driver. A piece finds its
    place by its rank among the pieces of its length.
    """
    cut_up = store(pieces(docs, id_col, text_col, name, length, keep_ids, special), "pieces")
    histogram = {row["length"]: row["count"] for row in cut_up.groupBy("length").count().collect()}
    layout = Layout(patterns(histogram, length))

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = layout.place(lengths.to_numpy(np.int64), ranks.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    ranked = numbered(cut_up, ["length"], ["doc_id", "start", "ids_crc32"], "_rank")
    placed = ranked.withColumn("_at", place("length", "_rank"))
    return placed.select(
        F.col("doc_id").alias(id_col),
        *[x for x in cut_up.columns if x != "doc_id"],
        "_at.sequence_id",
        "_at.offset",
    )


def sequences(packed: DataFrame, length: int = LENGTH, padding: int = END) -> DataFrame:
    """(sequence_id, ids): padded sequences, from what `pack(..., keep_ids=True)` returns."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = F.flatten(F.transform("parts", lambda part: part["ids"]))
    return parts.select("sequence_id", _padded(ids, length, padding).alias("ids"))


def _padded(ids: Column, length: int, padding: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(padding).cast("long"), (F.lit(length) - F.size(ids)).cast("int")))
