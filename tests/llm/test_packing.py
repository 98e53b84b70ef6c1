from __future__ import annotations

import zlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from rows import documents, hard
from wardline.llm.packing import Layout, encoder, encoding, pack, patterns, sequences
from wardline.llm.queries import QUERIES


def one_by_one(sizes: list[int], length: int) -> list[int]:
    """Fills of the packs: longest first, each into the shortest pack with room."""
    packs: list[int] = []
    for size in sorted(sizes, reverse=True):
        room = [i for i, x in enumerate(packs) if x + size <= length]
        if room:
            packs[min(room, key=packs.__getitem__)] += size
        else:
            packs.append(size)
    return packs


@given(st.lists(st.integers(1, 40), max_size=80))
def test_patterns(sizes):
    packs = patterns(Counter(sizes), 40)
    assert Counter(x for pack, n in packs for x in pack for _ in range(n)) == Counter(sizes)
    assert all(sum(pack) <= 40 and n > 0 for pack, n in packs)
    assert sum(n for _, n in packs) == len(one_by_one(sizes, 40))
    layout = Layout(packs)
    ranks, length = Counter(), []
    for size in sizes:
        length.append((size, ranks[size]))
        ranks[size] += 1
    if sizes:
        sequence, offset = layout.place(*np.array(length).T)
        taken = sorted(zip(sequence.tolist(), offset.tolist(), sizes, strict=True))
        at = dict.fromkeys(sequence.tolist(), 0)
        for s, o, size in taken:
            assert at[s] == o
            at[s] += size
        assert sorted(at) == list(range(len(at)))


def test_counts_may_be_large():
    packs = patterns({1000: 10**12, 24: 10**12, 500: 10**12}, 1024)
    assert sum(n for _, n in packs) == 10**12 + 10**12 // 2


def plain(text: str | None) -> list[int]:
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_of_every_character():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    encode = encoding().encode_ordinary
    for low in range(0, 0x110000, 0x4000):
        characters = [chr(x) for x in range(low, low + 0x4000) if not 0xD800 <= x < 0xE000]
        texts = [f"a{c}b {c}{c} 1 {c}1 \n{c}  " for c in characters]
        wanted = tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        assert [encode(x) for x in texts] == [x.ids for x in wanted]


RUNS = [" ", "\n", "\r\n", " \n", "\t", "a", "é", "🙂", "1", "!", "<|endoftext|>"]


@pytest.mark.parametrize("special", [True, False])
@pytest.mark.parametrize("run", RUNS)
def test_very_long_runs(run, special):
    """A million characters of one kind, alone and inside a text, have the JSON file's ids."""
    loaded = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    loaded.encode_special_tokens = not special
    n = 1_000_000 if run.isspace() else 30_000
    for text in (run * (n // len(run)), f"one {run * (n // len(run))} two"):
        assert encoder("byte_bpe_50k", special)(text) == loaded.encode(text, add_special_tokens=False).ids


def test_query_with_a_very_long_run(spark):
    rows = pack(documents(spark, (1, "a" + " " * 1_000_000 + "b"), (2, "\n" * 1_000_000), (3, "c")), special=True)
    found = {r["doc_id"]: r["n"] for r in rows.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert found == {i: len(plain(t)) for i, t in ((1, "a" + " " * 1_000_000 + "b"), (2, "\n" * 1_000_000), (3, "c"))}


def test_pieces(spark):
    df = hard(spark)
    rows = pack(df, keep_ids=True)
    wanted = sorted((r["doc_id"] is None, r["doc_id"] or 0, plain(r["text"])) for r in df.collect())
    found: dict = {}
    got = rows.collect()
    for r in sorted(got, key=lambda r: (r["doc_id"] or 0, r["start"])):
        ids = np.array(r["ids"], "<u4")
        assert zlib.crc32(ids) == r["ids_crc32"] and len(ids) == r["length"]
        found.setdefault((r["doc_id"] is None, r["doc_id"] or 0), []).extend(ids.tolist())
    both: dict = {}
    for null, doc_id, ids in wanted:
        both.setdefault((null, doc_id), []).extend(ids)
    assert {k: Counter(v) for k, v in found.items()} == {k: Counter(v) for k, v in both.items()}
    assert found[False, 4] == plain(next(r["text"] for r in df.collect() if r["doc_id"] == 4))
    made = sequences(rows).collect()
    assert {len(r["ids"]) for r in made} == {1024}
    assert len(made) == max(r["sequence_id"] for r in got) + 1 == len(one_by_one([r["length"] for r in got], 1024))
    by_sequence: dict = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["ids"]))
    for r in made:
        parts = sorted(by_sequence[r["sequence_id"]])
        joined = [i for _, ids in parts for i in ids]
        assert [o for o, _ in parts] == [sum(len(x) for _, x in parts[:i]) for i in range(len(parts))]
        assert r["ids"] == joined + [0] * (1024 - len(joined))


@cache
def as_loaded() -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(deadline=None)  # the first example loads the vocabulary
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", "a", " ", "\n", "  b", "'s", "1é"]), max_size=12))
def test_special_token_as_the_tokenizer_is_loaded(parts):
    text = "".join(parts)
    assert encoder("byte_bpe_50k", True)(text) == as_loaded().encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("run", [QUERIES["op6_packing"], lambda spark, at: corpus_pipeline.packed(spark, spark.read.parquet(f"{at}/documents.parquet"), at)])
def test_queries_emit_the_special_token(spark, tmp_path, run):
    text = "a <|endoftext|> b"
    documents(spark, (1, text)).write.parquet(f"{tmp_path}/documents.parquet")
    ids = np.array([*as_loaded().encode(text, add_special_tokens=False).ids, 0], "<u4")
    assert ids.tolist() == [64, 220, 50256, 275, 0]
    rows = [(r["doc_tokens"], r["ids_crc32"]) for r in run(spark, str(tmp_path)).collect()]
    assert rows == [(5, zlib.crc32(ids))]


def test_empty(spark):
    assert pack(documents(spark)).count() == 0
