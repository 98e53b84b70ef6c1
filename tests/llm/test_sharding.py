from __future__ import annotations

import zlib

import numpy as np

from rows import documents, hard
from wardline.llm.sharding import jump, shard, write_shards


def one_by_one(key: int, shards: int) -> int:
    state, at, to = key % (1 << 64), -1, 0
    while to < shards:
        at = to
        state = (state * 2862933555777941757 + 1) % (1 << 64)
        to = int((at + 1) * ((1 << 31) / ((state >> 33) + 1)))
    return at


def test_jump():
    keys = np.array([0, 1, 2, -1, 7**20, -(2**63), 2**63 - 1, *range(100, 2_000)], np.int64)
    for shards in (1, 2, 16, 17, 1_000):
        assert jump(keys, shards).tolist() == [one_by_one(int(k), shards) for k in keys]


def test_growth_moves_rows_into_the_new_shard_only():
    keys = np.arange(50_000)
    before, after = jump(keys, 16), jump(keys, 17)
    moved = before != after
    assert set(after[moved]) == {16}
    assert abs(moved.mean() - 1 / 17) < 0.005
    assert np.bincount(before).min() > 0.9 * len(keys) / 16


def test_rows(spark):
    df = hard(spark).unionByName(documents(spark, *((i, f"t{i}") for i in range(1_000, 3_000))))
    rows = shard(df).collect()
    texts = {r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] is not None}
    assert len(rows) == df.count()
    slots: dict[int, list[int]] = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 16)
        assert r["shard"] == one_by_one(r["doc_id"] or 0, 16)
        if r["doc_id"] is not None:
            encoded = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(encoded) + 1, zlib.crc32(encoded))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_empty(spark):
    assert shard(documents(spark)).count() == 0


def test_files(spark, tmp_path):
    df = hard(spark)
    write_shards(df, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == df.count()
    assert {(r["doc_id"], r["_shard"]) for r in back.collect()} == {
        (r["doc_id"], one_by_one(r["doc_id"] or 0, 4)) for r in df.collect()
    }
