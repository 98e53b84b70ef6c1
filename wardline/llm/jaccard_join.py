"""N-gram Jaccard join with signature trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.components import components
from wardline.llm.shared import drop, store
from wardline.llm.signature_tree import counted, joins

WORDS, PERCENT = 5, 80
#: In % of a set, the shared first shingles that a document must have to be looked at more closely.
BEYOND = 10
#: Shingles of the documents that one task compares at once, and documents of a block every task of it sees.
TOGETHER, PIVOTS = 64_000, 8
#: Shingles a task looks through at once for those it has twice.
CHUNK = 2_000_000
#: Bits of the sieve that spares most documents from being shuffled, and bits set per set.
SIEVE, PROBES = 1 << 26, 4


def _powers(n: int, base: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)])


class WordHashes:
    """64-bit hashes of the words of many bytes at once, for words between ASCII white space.

    A word's hash is the polynomial of its bytes modulo 2^64: the difference of two running sums,
    brought to one place by the inverse of the base's power, then mixed with the word's length.
    """

    BASE = 0x9E3779B97F4A7C15
    SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
    #: Bytes gone through together; only a longer word takes more.
    BLOCK = 1 << 20

    def __init__(self) -> None:
        self.power = self.inverse = np.zeros(0, np.uint64)

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, places) of all words, in their order."""
        hashes, places, begin = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        while begin < len(data):
            end = min(begin + self.BLOCK, len(data))
            while end < len(data) and not self.SPACE[data[end]]:
                end += 1
            some, at = self._block(np.frombuffer(data, np.uint8, end - begin, begin))
            hashes.append(some)
            places.append(at + begin)
            begin = end
        return np.concatenate(hashes), np.concatenate(places)

    def _block(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(letters) >= len(self.power):
            self.power = _powers(len(letters), self.BASE)
            self.inverse = _powers(len(letters), pow(self.BASE, -1, 1 << 64))
        inside = np.r_[False, ~self.SPACE[letters], False]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        begin, end = edges[::2], edges[1::2]
        sums = np.r_[np.uint64(0), np.cumsum((letters + np.uint64(1)) * self.power[: len(letters)])]
        return mixed((sums[end] - sums[begin]) * self.inverse[begin] + (end - begin).astype(np.uint64)), begin


def mixed(x: np.ndarray) -> np.ndarray:
    """Each bit of a 64-bit number made to depend on all of them."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def shingle_sets(texts: list[str | None], words: int, hashes: WordHashes) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its runs of `words` words; of all its words, if
    there are fewer; or none. A-Z are lower-cased."""
    encoded = [(x or "").encode().lower() for x in texts]
    size = np.fromiter(map(len, encoded), np.int64, len(encoded)) + 1
    found, places = hashes.of(b"\n".join(encoded))
    at = np.searchsorted(places, np.r_[0, np.cumsum(size)]).tolist()
    weight = _powers(words, WordHashes.BASE)
    runs = np.zeros(max(len(found) - words + 1, 0), np.uint64)
    for i in range(words):
        runs += found[i : i + len(runs)] * weight[i]
    runs = mixed(runs)
    sets = []
    for begin, end in zip(at, at[1:], strict=False):
        n = end - begin
        if 0 < n < words:
            sets.append(mixed((found[begin:end] * weight[:n]).sum(keepdims=True) + np.uint64(n)))
        else:
            sets.append(distinct(runs[begin : begin + max(n - words + 1, 0)]))
    return sets


def _sets_of(column: pa.Array, words: int, hashes: WordHashes) -> Iterator[np.ndarray]:
    """The sets of a column of texts, a few at a time."""
    for at in range(0, len(column), 256):
        yield from shingle_sets(column.slice(at, 256).to_pylist(), words, hashes)


def key_of(tokens: np.ndarray, salt: int) -> int:
    """A 64-bit name of a set; `sets_of` sees that no two sets share one."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8, salt=bytes([salt])).digest(), "big", signed=True)


def first_ones(tokens: np.ndarray, percent: int, beyond: int) -> np.ndarray:
    """The first shingles of a set, in the order of their hashes.

    Alike sets share at least `percent` % of the larger. Of two such sets, all but the last
    ceil(percent % n) - b of each therefore hold b common ones. `beyond` gives b in % of n (at least 1,
    at most all that must be shared: then these are all shingles).
    """
    n = len(tokens)
    shared = -(-n * percent // 100)
    return tokens[: n - shared + min(max(n * beyond // 100, 1), shared)]


def _named(words: int, salt: int):
    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            keys, checks, sizes = [], [], []
            for tokens in _sets_of(batch.column("text"), words, hashes):
                sizes.append(len(tokens))
                keys.append(key_of(tokens, salt) if len(tokens) else None)
                checks.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None)
            columns = [batch.column("id"), pa.array(keys, pa.int64()), pa.array(checks, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64())], ["id", "key", "check", "size"])

    return named


def _first_shingles(sets: Iterator[tuple[int, np.ndarray]], percent: int, beyond: int) -> Iterator[pa.RecordBatch]:
    """(kind, h, key, n) of one task.

    Kind 0: a shingle and the first set that has it here, with n = 1, or 0 if other sets have it
    here too. Kind 1 (h = key): how many of a set's first shingles other sets have here.
    """

    def passed(keys: list[int], tokens: list[np.ndarray]) -> pa.RecordBatch:
        owner = np.repeat(np.array(keys, np.int64), [len(x) for x in tokens])
        h = np.concatenate(tokens).view(np.int64)
        order = np.argsort(h, kind="stable")
        h, owner = h[order], owner[order]
        begin = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        size = np.diff(np.r_[begin, len(h)])
        several = np.repeat(size, size) > 1
        known, n = np.unique(owner[several], return_counts=True)
        # set by set again, as rows that repeat a key take less room in a shuffle
        begin, size = begin[by := np.argsort(owner[begin], kind="stable")], size[by]
        columns = [
            np.r_[np.zeros(len(begin), np.int32), np.ones(len(known), np.int32)],
            np.r_[h[begin], known],
            np.r_[owner[begin], known],
            np.r_[(size == 1).astype(np.int64), n],
        ]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["kind", "h", "key", "n"])

    held: dict[int, np.ndarray] = {}
    total = 0
    for key, tokens in sets:
        if key not in held:
            held[key] = first_ones(tokens, percent, beyond)
            total += len(held[key])
        if total > CHUNK:
            yield passed(list(held), list(held.values()))
            held, total = {}, 0
    if held:
        yield passed(list(held), list(held.values()))


def _of_texts(words: int, percent: int, salt: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets() -> Iterator[tuple[int, np.ndarray]]:
            hashes = WordHashes()
            for batch in batches:
                for tokens in _sets_of(batch.column("text"), words, hashes):
                    if len(tokens):
                        yield key_of(tokens, salt), tokens

        yield from _first_shingles(sets(), percent, BEYOND)

    return found


def _of_sets(percent: int, beyond: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sets() -> Iterator[tuple[int, np.ndarray]]:
            for batch in batches:
                yield from zip(batch.column("key").to_pylist(), _tokens(batch.column("tokens")), strict=True)

        yield from _first_shingles(sets(), percent, beyond)

    return found


FIRST = "kind int, h long, key long, n long"


def _tokens(column: pa.Array) -> Iterator[np.ndarray]:
    for value in column:
        yield value.values.to_numpy().view(np.uint64)


def _met(first: DataFrame, sizes: DataFrame, percent: int, beyond: int) -> DataFrame:
    """Keys of the sets that share enough first shingles with others to be alike to any."""
    same = Window.partitionBy("kind", "h")
    shared = first.withColumn("several", F.min("key").over(same) != F.max("key").over(same))
    counts = shared.where("kind = 1 or several").groupBy("key").agg(F.sum("n").alias("n")).where("n > 0")
    # the number that first_ones is made for, for the smallest set that can be alike to this one
    smallest = F.ceil(F.col("size") * percent / 100)
    needed = F.least(F.floor(smallest * beyond / 100), F.ceil(smallest * percent / 100))
    needed = F.when(F.lit(beyond) >= percent, smallest).otherwise(F.greatest(needed, F.lit(1)))
    return counts.join(sizes.select("key", "size"), "key").where(F.col("n") >= needed).select("key")


def _edges(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): sets with a common first shingle, each joined to the smallest key that has it.

    Here the order is by the number of sets that have a shingle, so that what very many share, such
    as a passage, only counts for sets with hardly anything else. All but the last
    ceil(percent % n) - 1 shingles of alike sets hold a common one.
    """
    rows = sets.select("key", F.size("tokens").alias("size"), F.explode("tokens").alias("h"))
    rows = rows.join(rows.groupBy("h").agg(F.count("*").alias("n")), "h")
    place = F.row_number().over(Window.partitionBy("key").orderBy("n", "h"))
    first = rows.withColumn("place", place).where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * percent / 100) + 1)
    first = first.where("n > 1").select("key", "h")
    least = first.groupBy("h").agg(F.min("key").alias("b"))
    return first.join(least, "h").select(F.col("key").alias("a"), "b").where("a <> b").distinct()


def _places(keys: np.ndarray) -> np.ndarray:
    """The bits of a sieve that stand for each key; keys are hashes already."""
    low, step = keys.view(np.uint64) & np.uint64(0xFFFFFFFF), keys.view(np.uint64) >> np.uint64(32)
    return ((low[:, None] + np.arange(PROBES, dtype=np.uint64) * (step | np.uint64(1))[:, None]) % np.uint64(SIEVE)).astype(np.int64)


def _sieve(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over the keys; if they are too many for it, more others pass, and no key is lost."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = np.zeros(SIEVE, bool)
        for batch in batches:
            sieve[_places(batch.column("key").to_numpy())] = True
        packed = np.packbits(sieve).view(np.int64)
        word = np.flatnonzero(packed)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(packed[word])], ["word", "bits"])

    found = keys.mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    packed = np.zeros(SIEVE // 64, np.int64)
    packed[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return packed.view(np.uint8)


def _with_tokens(docs: DataFrame, kept: DataFrame, words: int, salt: int) -> DataFrame:
    """(key, tokens) of the sets named by `kept` (key). All texts are gone through again, but only what passes
    the sieve is shuffled."""
    spread = docs.sparkSession.sparkContext.broadcast(_sieve(kept))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, met, hashes = spread.value, set(), WordHashes()
        for batch in batches:
            keys, tokens = [], []
            for found in _sets_of(batch.column("text"), words, hashes):
                key = key_of(found, salt) if len(found) else None
                if key is None or key in met:
                    continue
                at = _places(np.array([key]))
                if (sieve[at >> 3] >> (7 - (at & 7)) & 1).all():
                    met.add(key)
                    keys.append(key)
                    tokens.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))], ["key", "tokens"]
            )

    rows = docs.select("text").mapInArrow(made, "key long, tokens array<long>")
    return rows.join(kept, "key").dropDuplicates(["key"])


def _compare(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) of links that join sets of unlike `label` among the rows (group, key, label, tokens) of each group."""

    def compared(group: pa.Table) -> pa.Table:
        keys = group.column("key").to_numpy()
        labels = np.unique(group.column("label").to_numpy(), return_inverse=True)[1]
        tokens = [x for chunk in group.column("tokens").chunks for x in _tokens(chunk)]
        found = np.array(joins(tokens, labels, percent), np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(keys[found[:, 0]]), "b": pa.array(keys[found[:, 1]])})

    return rows.groupBy("group").applyInArrow(compared, "a long, b long")


def near_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    count_links: bool = False,
) -> DataFrame:
    """One row per row of `df`: id, n_shingles, class_id, component_id.

    A document's set are its distinct shingles; two documents link when their sets' intersection has
    at least `percent` % of their union. component_id is the smallest id reached by links, class_id
    the smallest one with the same set. Null, empty and blank texts have no set and link with
    nothing. Rows with a null id link, but name a component only if no other row of it has an id;
    rows that repeat an id are rows of their own. An empty table gives no rows; other columns are
    not read.

    1. Equal sets are one class. 2. A set goes on if enough of its first shingles, by hash, are also
    among the first of other sets; others cannot be alike to any. Of the sets that go on, those stay
    that have `percent` % of all their shingles in common with others. 3. Sets that share one of their rarest shingles, at first or
    second hand, are a block; alike sets always are in one. 4. Every block is compared by
    signature trees. A block of more than TOGETHER shingles is cut by size and hash into parts of
    about that many: first each part with a few pivots, sets that all parts of a block see, then
    all pairs of parts with sets that are not in the block's largest component yet. No step looks
    at, or emits, all pairs of a block, as pairs that links have joined are not looked at again.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    salt = 0
    while True:
        named = store(docs.mapInArrow(_named(words, salt), f"id {kind}, key long, check binary, size long"), "named")
        groups = named.where("size > 0").groupBy("key")
        classes = groups.agg(
            F.min("id").alias("first"),
            F.min("size").alias("size"),
            (F.min("check") != F.max("check")).alias("clash"),
        )
        classes = store(classes, "classes")
        if classes.where("clash").isEmpty():
            break
        salt += 1
    first = docs.select("text").mapInArrow(_of_texts(words, percent, salt), FIRST)
    met = store(_met(first, classes, percent, BEYOND), "met")
    met_sets = store(_with_tokens(docs, met, words, salt), "sets")
    met = _met(met_sets.mapInArrow(_of_sets(percent, 100), FIRST), classes, percent, 100)
    near_sets = store(met_sets.join(met, "key"), "sets")
    drop(met_sets)
    blocks = components(_edges(near_sets, percent))
    sets = store(
        near_sets.join(blocks.withColumnRenamed("node", "key").withColumnRenamed("component", "block"), "key").select(
            "key", "block", F.size("tokens").alias("size"), "tokens"
        ),
        "blocks",
    )
    drop(near_sets)
    links = store(_links(sets, percent), "links")
    joined = components(links).withColumnRenamed("node", "key")
    of_class = classes.join(joined, "key", "left").withColumn("component", F.coalesce("component", "key"))
    of_class = store(of_class.select("key", "first", "component"), "joined")
    smallest = of_class.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = of_class.join(smallest, "component").select("key", F.col("first").alias("class_id"), "component_id")
    n_links = []
    if count_links:
        copies = store(groups.agg(F.count("*").alias("copies")), "copies")
        found = store(_n_links(sets.join(copies, "key"), percent), "n-links")
        of_class = of_class.join(copies, "key").join(found, "key", "left")
        n_links = [(F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links")]
    return named.join(of_class, "key", "left").select(
        F.col("id").alias(id_col),
        F.col("size").alias("n_shingles"),
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("component_id", "id").alias("component_id"),
        *n_links,
    )


def _parts(sets: DataFrame, percent: int) -> DataFrame:
    """The sets of large blocks with their step, by size, the number of parts of the step, and their part of it."""
    # sizes of alike sets differ by less than the ratio of two steps
    step = F.floor(F.log(F.col("size")) / F.log(F.lit(100 / percent))).cast("int")
    rows = sets.withColumn("step", step)
    of_step = rows.groupBy("block", "step").agg(F.ceil(F.sum("size") / TOGETHER).alias("parts"))
    spread = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    return store(rows.join(of_step, ["block", "step"]).withColumn("part", spread), "parts")


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join each component of the sets (key, block, size, tokens) of every block."""
    of_block = sets.groupBy("block").agg(F.sum("size").alias("shingles"))
    small = of_block.where(F.col("shingles") <= TOGETHER).select("block")
    large = of_block.where(F.col("shingles") > TOGETHER).select("block")
    one_part = sets.join(small, "block").select(F.col("block").alias("group"), "key", F.col("key").alias("label"), "tokens")
    if large.isEmpty():
        return _compare(one_part, percent)
    rows = _parts(sets.join(large, "block"), percent)
    place = F.row_number().over(Window.partitionBy("block", "step").orderBy(F.xxhash64("key"), "key"))
    pivots = rows.select("block", "step", "parts", "key").withColumn("place", place).where(F.col("place") <= PIVOTS)
    pivots = pivots.join(rows.select("key", "tokens", F.col("part").alias("own")), "key")
    pivots = pivots.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1))).where("part <> own")
    part = F.xxhash64("block", "step", "part").alias("group")
    seen = rows.select(part, "key", F.col("key").alias("label"), "tokens").unionByName(
        pivots.select(part, "key", F.col("key").alias("label"), "tokens")
    )
    links = store(_compare(one_part, percent).unionByName(_compare(seen, percent)), "links")
    labels = components(links).withColumnRenamed("node", "key").withColumnRenamed("component", "label")
    rows = rows.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    rows = store(rows.select("key", "block", "step", "part", "label", "tokens"), "labelled")
    n = rows.groupBy("block", "label").count()
    largest = n.groupBy("block").agg(F.max_by("label", F.struct("count", "label")).alias("largest"))
    rest = rows.join(largest, "block").where("label <> largest").drop("largest")
    parts = rows.select("block", "step", "part").distinct()
    a = rest.select("block", "step", "part").distinct()
    b = parts.select("block", F.col("step").alias("other_step"), F.col("part").alias("other_part"))
    near = F.abs(F.col("step") - F.col("other_step")) <= 1
    unlike = (F.col("step") != F.col("other_step")) | (F.col("part") != F.col("other_part"))
    pairs = a.join(b, "block").where(near & unlike).withColumn("group", F.xxhash64(*a.columns, "other_step", "other_part"))
    visiting = rest.join(pairs, ["block", "step", "part"]).select("group", "key", "label", "tokens")
    resident = rows.join(
        pairs.select("group", "block", F.col("other_step").alias("step"), F.col("other_part").alias("part")),
        ["block", "step", "part"],
    ).select("group", "key", "label", "tokens")
    return links.unionByName(_compare(visiting.unionByName(resident), percent))


def _n_links(sets: DataFrame, percent: int) -> DataFrame:
    """(key, links): for each of the sets (key, block, size, tokens, copies), the copies of all other sets alike to it.

    A large block is gone through part by part, then by all pairs of parts whose sizes allow a link,
    each pair once. Numbers leave a comparison, not pairs.
    """
    of_block = sets.groupBy("block").agg(F.sum("size").alias("shingles"))
    small = of_block.where(F.col("shingles") <= TOGETHER).select("block")
    large = of_block.where(F.col("shingles") > TOGETHER).select("block")
    given = ["key", "copies", "tokens"]
    groups = sets.join(small, "block").select(F.struct("block").cast("string").alias("group"), *given, F.lit(0).alias("side"))
    if not large.isEmpty():
        rows = _parts(sets.join(large, "block"), percent)
        place = ["block", "step", "part"]
        parts = rows.select(*place).distinct()
        other = parts.select("block", F.col("step").alias("other_step"), F.col("part").alias("other_part"))
        later = F.struct("step", "part") < F.struct("other_step", "other_part")
        near = F.col("other_step") - F.col("step") <= 1
        pair = F.struct(*place, "other_step", "other_part").cast("string").alias("group")
        pairs = parts.join(other, "block").where(later & near).select(*place, "other_step", "other_part", pair)
        of_other = pairs.select("group", "block", F.col("other_step").alias("step"), F.col("other_part").alias("part"))
        groups = (
            groups.unionByName(rows.select(F.struct(*place).cast("string").alias("group"), *given, F.lit(0).alias("side")))
            .unionByName(rows.join(pairs, place).select("group", *given, F.lit(1).alias("side")))
            .unionByName(rows.join(of_other, place).select("group", *given, F.lit(2).alias("side")))
        )

    def compared(group: pa.Table) -> pa.Table:
        tokens = [x for chunk in group.column("tokens").chunks for x in _tokens(chunk)]
        links = counted(tokens, group.column("copies").to_numpy(), group.column("side").to_numpy(), percent)
        return pa.table({"key": group.column("key"), "links": pa.array(links)})

    found = groups.groupBy("group").applyInArrow(compared, "key long, links long")
    return found.groupBy("key").agg(F.sum("links").alias("links"))


def keep_one(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of `df` whose id is the smallest of their group, with all their columns.

    Rows without an id stay, as nothing tells them apart; rows that repeat an id stay or go together.
    """
    groups = near_groups(df, id_col, text_col, words, percent)
    gone = groups.where(~F.col(id_col).eqNullSafe(F.col("component_id")) & F.col(id_col).isNotNull())
    gone = store(gone.select(F.col(id_col).alias("_gone")).distinct(), "gone")
    return df.join(gone, df[id_col] == gone["_gone"], "left_anti")
