"""Near-duplicate embeddings: random-hyperplane hashing, exact cosines, connected components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.components import components, roots
from wardline.llm.shared import store

COSINE = 0.95
#: A pair at the bound itself is missed by all tables with a chance of 1 - RECALL; closer pairs with less.
RECALL = 0.999
#: Different vectors expected in a bucket, and the most that are compared in one go.
BUCKET, BLOCK = 16, 1024
#: Rows that are compared in one call, about, and pairs whose codes are compared at once.
ROWS, PAIRS = 4096, 1 << 14
SEED = 7


def plan(vectors: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables): bits so that unrelated vectors fill buckets evenly, tables for the recall."""
    bits = min(max(math.ceil(math.log2(max(vectors, 2) / BUCKET)), 6), 30)
    met = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - met))


def _readable(vector: np.ndarray | None) -> bool:
    """Whether a vector has a direction: numbers, all finite, not all zero."""
    return vector is not None and len(vector) > 0 and bool(np.isfinite(vector).all()) and bool(vector.any())


def _vectors(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Each row's values in double precision; None for null, and for a null among the values."""
    for value in column:
        values = value.values if value.is_valid else None
        yield None if values is None or values.null_count else values.to_numpy(zero_copy_only=False).astype(float)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            hashlib.blake2b((x + 0.0).tobytes(), digest_size=16).digest() if _readable(x) else None
            for x in _vectors(batch.column("vector"))
        ]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], ["id", "digest"])


def _hashed(bits: int, tables: int):
    """Rows (table, code) per class, with its vector at length 1 and the codes of all tables."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weight = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            vectors = list(_vectors(batch.column("vector")))
            units = [x / np.abs(x).max() for x in vectors]
            units = [x / np.linalg.norm(x) for x in units]
            codes = []
            for x in units:
                if len(x) not in planes:
                    planes[len(x)] = np.random.default_rng([SEED, len(x)]).standard_normal((len(x), bits * tables))
                side = (x @ planes[len(x)] > 0).reshape(tables, bits)
                # vectors of other lengths never meet
                codes.append(side @ weight + (len(x) << 32))
            for at in range(0, len(units), 2048):
                some = slice(at, at + 2048)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("class")[some],
                        batch.column("size")[some],
                        pa.array(units[some], pa.list_(pa.float64())),
                        pa.array(codes[some], pa.list_(pa.int64())),
                    ],
                    ["class", "size", "unit", "codes"],
                )

    return hashed


def linked(
    classes: np.ndarray, sizes: np.ndarray, units: np.ndarray, codes: np.ndarray, block: np.ndarray, table: int,
    pair: tuple[int, int], cosine: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, smallest class it is joined to, vectors it links with) within one bucket, or two blocks of one.

    A pair that meets in several tables counts in the first of them.
    """
    left, right = np.flatnonzero(block == pair[0]), np.flatnonzero(block == pair[1])
    close = units[left] @ units[right].T >= cosine
    a, b = np.nonzero(close)
    a, b = left[a], right[b]
    if pair[0] == pair[1]:
        a, b = a[a < b], b[a < b]
    if not len(a):
        return (np.zeros(0, np.int64),) * 3
    first = np.empty(len(a), bool)
    for at in range(0, len(a), PAIRS):
        some = slice(at, at + PAIRS)
        first[some] = np.argmax(codes[a[some]] == codes[b[some]], axis=1) == table
    links = np.bincount(a[first], sizes[b[first]], len(classes)) + np.bincount(b[first], sizes[a[first]], len(classes))
    order = np.argsort(classes)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    root = roots(classes[order], np.stack([place[a], place[b]]))
    met = np.unique(np.concatenate([a, b]))
    return classes[met], classes[order][root[place[met]]], links[met].astype(np.int64)


def _compared(cosine: float):
    """The buckets (or pairs of blocks) of one bin, one after the other."""
    keys = ("table", "code", "i", "j")

    def compared(rows: pa.Table) -> pa.Table:
        key = np.stack([rows.column(x).to_numpy() for x in keys])
        order = np.lexsort(key)
        rows, key = rows.take(pa.array(order)).combine_chunks(), key[:, order]
        begin = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)])
        classes, sizes, block = (rows.column(x).to_numpy() for x in ("class", "size", "block"))
        units, codes = (rows.column(x).chunk(0) for x in ("unit", "codes"))
        found = [(np.zeros(0, np.int64),) * 3]
        for low, high in zip(begin.tolist(), [*begin[1:].tolist(), len(order)], strict=True):
            if high - low > 1:
                part = slice(low, high)
                unit, code = (x.slice(low, high - low).flatten().to_numpy().reshape(high - low, -1) for x in (units, codes))
                table, _, *pair = key[:, low].tolist()
                found.append(linked(classes[part], sizes[part], unit, code, block[part], table, (pair[0], pair[1]), cosine))
        return pa.table(dict(zip(("a", "b", "links"), map(np.concatenate, zip(*found, strict=True)), strict=True)))

    return compared


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, recall: float = RECALL
) -> DataFrame:
    """One row per row of `df`: id, n_links, component_id, kept.

    Vectors link when their cosine, in double precision, is `cosine` or more. Null and zero vectors
    and those with a null or non-finite value link with nothing, nor do vectors of unlike length.
    n_links counts the other rows linked directly, copies among them; component_id is the smallest
    id reached by links. Rows with a null id have links, but name a component only if no other row
    of it has an id; rows that repeat an id are rows of their own. An empty table gives no rows;
    other columns are not read.

    Equal vectors are one class first, so copies are never compared. Classes meet in the buckets of
    several tables of hyperplane hashes, and every pair that meets is checked exactly. A bucket with
    more than BLOCK classes is split into blocks that are compared two by two in tasks of their own.
    What leaves a comparison is a number of links and one edge per class, not the pairs.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    kind = df.schema[id_col].dataType.simpleString()
    marked = store(rows.mapInArrow(_digest, f"id {kind}, digest binary"), "vectors")
    groups = marked.where(F.col("digest").isNotNull()).groupBy("digest")
    classes = store(
        groups.agg(F.min("id").alias("first"), F.count("*").alias("size")).withColumn(
            "class", F.monotonically_increasing_id()
        ),
        "classes",
    )
    n_classes = classes.count()
    bits, tables = plan(n_classes, cosine, recall)
    whole = rows.mapInArrow(_with_digest, f"id {kind}, digest binary, vector array<double>")
    one = whole.join(classes, (whole.digest == classes.digest) & whole.id.eqNullSafe(classes["first"]))
    one = one.select("class", "size", "vector").dropDuplicates(["class"])
    signed = store(
        one.mapInArrow(_hashed(bits, tables), "class long, size long, unit array<double>, codes array<long>"), "signed"
    )
    met = signed.select("class", F.posexplode("codes").alias("table", "code"))
    buckets = met.groupBy("table", "code").count().where("count > 1")
    of = F.col("count") / F.lit(float(BLOCK))
    buckets = store(buckets.select("table", "code", "count", F.ceil(of).cast("int").alias("blocks")), "buckets")
    blocks = met.join(buckets, ["table", "code"])
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    pairs = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "class", "table", "code", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    key = ["table", "code", "i", "j"]
    # small buckets are gone through many at a time; a class of a large one is written out once for each of its blocks
    written = buckets.agg(F.sum(F.col("count") * F.col("blocks"))).first()[0] or 0
    bins = max(written // ROWS, 1)
    dealt = pairs.join(signed, "class").withColumn("bin", F.pmod(F.xxhash64(*key), F.lit(bins)))
    links = store(dealt.groupBy("bin").applyInArrow(_compared(cosine), "a long, b long, links long"), "links")
    of_class = (
        classes.select("class", "digest", "first", "size")
        .join(links.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links")), "class", "left")
        .join(components(links.select("a", "b")).withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    of_class = store(of_class, "linked")
    smallest = of_class.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = of_class.join(smallest, "component").select(
        "digest", "component_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")
    )
    return marked.join(of_class, "digest", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        (F.col("id") == F.coalesce("component_id", "id")).alias("kept"),
    )


def _with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [x if _readable(x) else None for x in _vectors(batch.column("vector"))]
        digest = [None if x is None else hashlib.blake2b((x + 0.0).tobytes(), digest_size=16).digest() for x in vectors]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(digest, pa.binary()), pa.array(vectors, pa.list_(pa.float64()))],
            ["id", "digest", "vector"],
        )
