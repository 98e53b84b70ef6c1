"""Ranked lexical search over an index whose strata are documents of equal length normaliser."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.shared import drop, store

#: Letters and digits of ASCII (A-Z lower-cased) and all other characters are in terms, the rest of ASCII parts them.
TERMS = bytes(x if x >= 128 else bytes([x]).lower()[0] if chr(x).isalnum() else 0x20 for x in range(256))
#: A stratum of more postings (or so) than this is kept in parts.
PART = 20_000
#: Strata of an item that are visited before there is a threshold.
FIRST = 16
#: Terms of items, each with its weight, that are sent to the tasks at once.
TOGETHER = 500_000
#: Rows up to which the table of lengths is broadcast.
BROADCAST_ROWS = 300_000
#: Items whose scores in a stratum are worked out at once.
SOME = 256


class Index(NamedTuple):
    """`strata`: a row for each part of a stratum, whose lists are its postings; the number of documents with a term.

    Documents of a part are numbered by id. Term i of `terms`, which blanks part, occurs as often as `tfs[j]` says for j from
    `levels[i]` to `levels[i + 1]`, in the documents `docs[k]` for k from `ends[j]` to `ends[j + 1]`. What a document gains by
    a number of occurrences that is one of `values` is in its place of `impacts`.
    """

    strata: DataFrame
    n_documents: int


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different terms of each text and how often they occur; texts without a term are left out."""
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            some = batch.slice(at, 128)
            bags = [Counter((x or "").encode().translate(TERMS).split()) for x in some.column("text").to_pylist()]
            kept = np.array([k for k, bag in enumerate(bags) if bag], np.int64)
            if not len(kept):
                continue
            bags = [bags[k] for k in kept]
            offsets = np.concatenate([[0], np.cumsum([len(b) for b in bags])]).astype(np.int32)
            tfs = pa.array([n for b in bags for n in b.values()], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    some.column("row").take(pa.array(kept)),
                    some.column("id").take(pa.array(kept)),
                    pa.array([b.total() for b in bags], pa.int64()),
                    pa.array([b" ".join(b) for b in bags], pa.binary()).cast(pa.string()),
                    pa.ListArray.from_arrays(offsets, tfs),
                ],
                ["row", "id", "n", "terms", "tfs"],
            )


def bags(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, n, terms, tfs) of the rows of `df` with a term; blanks part the terms, which takes little room."""
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_bags, f"row long, id {kind}, n long, terms string, tfs array<int>")


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def invert(key: tuple, table: pa.Table) -> pa.Table:
    """The postings of a part of a stratum, by term and tf; impacts are worked out once for each tf."""
    m, part = (x.as_py() for x in key)
    order = pc.sort_indices(table, [("id", "ascending"), ("row", "ascending")], null_placement="at_end")
    table = table.take(order).combine_chunks()
    lists = pc.split_pattern(table.column("terms"), " ")
    terms = _one(pc.list_flatten(lists)).dictionary_encode()
    tf = pc.list_flatten(table.column("tfs")).to_numpy()
    docs = np.repeat(np.arange(table.num_rows, dtype=np.int32), pc.list_value_length(lists).to_numpy())
    code = terms.indices.to_numpy()
    order = np.lexsort((docs, tf, code))
    code, tf, docs = code[order], tf[order], docs[order]
    new_term = np.concatenate([[True], code[1:] != code[:-1]])
    starts = np.flatnonzero(new_term | np.concatenate([[True], tf[1:] != tf[:-1]]))
    values = np.unique(tf[starts])
    row = {
        "ids": _one(table.column("id")),
        "levels": pa.array(np.append(np.flatnonzero(new_term[starts]), len(starts)), pa.int32()),
        "tfs": pa.array(tf[starts], pa.int32()),
        "values": pa.array(values, pa.int32()),
        "impacts": pa.array(impact(values.astype(np.int64), m), pa.int64()),
        "ends": pa.array(np.append(starts, len(docs)), pa.int32()),
        "docs": pa.array(docs, pa.int32()),
    }
    lists = {name: pa.ListArray.from_arrays([0, len(of)], of) for name, of in row.items()}
    spelled = pa.array([" ".join(terms.dictionary.to_pylist())], pa.string())
    return pa.table({"m": pa.array([m], pa.int64()), "part": pa.array([part], pa.int64()), "terms": spelled, **lists})


def _one(array: pa.Array | pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(array.chunks) if isinstance(array, pa.ChunkedArray) else array


def build(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", part: int = PART) -> Index:
    """An index of all rows of `df`.

    A document with n terms, of N documents with L terms in all, has m = 10 + (90 * n * N) div L, and
    those of equal m are a stratum. Large strata are kept in parts, dealt by row, so that neither a common length
    nor thousands of copies come together in one task. Texts that are null or hold no term are not in the index.
    """
    found = store(bags(df, id_col, text_col), "bags")
    total = found.agg(F.count("*"), F.sum("n")).first()
    n_documents, n_terms = total[0], total[1] or 1
    sized = found.withColumn("m", F.expr(f"10 + (90 * n * {n_documents}L) div {n_terms}L"))
    parts = store(sized.groupBy("m").agg(F.ceil(F.sum(F.size("tfs")) / F.lit(part)).alias("parts")), "parts")
    # a row for each length: few, but if they are not, both sides are shuffled
    dealt = sized.join(F.broadcast(parts) if parts.count() <= BROADCAST_ROWS else parts, "m").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    kind = found.schema["id"].dataType.simpleString()
    strata = dealt.select("m", "part", "row", "id", "terms", "tfs").groupBy("m", "part").applyInArrow(
        invert,
        f"m long, part long, terms string, ids array<{kind}>, levels array<int>, tfs array<int>, values array<int>, "
        "impacts array<long>, ends array<int>, docs array<int>",
    )
    strata = store(strata, "strata")
    drop(found)
    drop(parts)
    return Index(strata, n_documents)


class Asked(NamedTuple):
    """Items of one search: their row ids, their different terms, and (term, item) pairs with weights, by term."""

    items: np.ndarray
    terms: pa.Array
    pair_term: np.ndarray
    pair_item: np.ndarray
    weight: np.ndarray


class Part(NamedTuple):
    """A part of a stratum as far as items ask for it: for each of their terms the largest impact (0: none)."""

    m: int
    part: int
    ids: pa.Array
    found: np.ndarray
    at: np.ndarray
    best: np.ndarray
    levels: np.ndarray
    impacts: np.ndarray
    ends: np.ndarray
    docs: np.ndarray


def _parts(batches: Iterator[pa.RecordBatch], terms: pa.Array) -> Iterator[Part]:
    for batch in batches:
        for k in range(batch.num_rows):
            lists = {c: batch.column(c)[k].values for c in ("ids", "levels", "tfs", "values", "impacts", "ends", "docs")}
            own = pc.split_pattern(batch.column("terms").slice(k, 1), " ").values
            places = pc.index_in(terms, value_set=own)
            found = np.flatnonzero(places.is_valid().to_numpy(zero_copy_only=False))
            at = places.drop_null().to_numpy().astype(np.int64)
            levels = lists["levels"].to_numpy()
            level = np.searchsorted(lists["values"].to_numpy(), lists["tfs"].to_numpy())
            impacts = lists["impacts"].to_numpy()[level]
            best = np.zeros(len(terms), np.int64)
            best[found] = impacts[levels[at + 1] - 1]  # the last level has the largest tf
            yield Part(
                batch.column("m")[k].as_py(),
                batch.column("part")[k].as_py(),
                lists["ids"],
                found,
                at,
                best,
                levels,
                impacts,
                lists["ends"].to_numpy(),
                lists["docs"].to_numpy(),
            )


def _bounds(asked: Asked, part: Part) -> np.ndarray:
    """The most that any document of the part can score for each item; sums stay below 2^53, so doubles are exact."""
    gains = asked.weight * part.best[asked.pair_term]
    return np.bincount(asked.pair_item, gains, len(asked.items)).astype(np.int64)


def _scores(asked: Asked, part: Part, which: np.ndarray) -> np.ndarray:
    """Scores of all documents of the part (columns) for some items (rows): weights times impacts."""
    place = np.full(len(asked.terms), -1)
    place[part.found] = np.arange(len(part.found))
    impacts = np.zeros((len(part.found), len(part.ids)))
    for k, at in enumerate(part.at):
        first, last = part.levels[at], part.levels[at + 1]
        starts = part.ends[first : last + 1]
        impacts[k, part.docs[starts[0] : starts[-1]]] = np.repeat(part.impacts[first:last], np.diff(starts))
    row = np.full(len(asked.items), -1)
    row[which] = np.arange(len(which))
    mine = (row[asked.pair_item] >= 0) & (place[asked.pair_term] >= 0)
    weights = np.zeros((len(which), len(part.found)))
    weights[row[asked.pair_item[mine]], place[asked.pair_term[mine]]] = asked.weight[mine]
    return (weights @ impacts).astype(np.int64)


def _holders(strata: DataFrame, terms: pa.Array) -> np.ndarray:
    """How many documents hold each of the terms."""
    shared = strata.sparkSession.sparkContext.broadcast(terms)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(shared.value), np.int64)
        for part in _parts(batches, shared.value):
            held[part.found] += part.ends[part.levels[part.at + 1]] - part.ends[part.levels[part.at]]
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"term": pa.array(some), "n": pa.array(held[some])})

    found = strata.mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(terms), np.int64)
    df[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return df


def _leading(strata: DataFrame, asked: Asked, first: int) -> DataFrame:
    """(item, m, part) of the `first` parts with the highest bounds of each item."""
    shared = strata.sparkSession.sparkContext.broadcast(asked)

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, kept = [], None
        def best(rows: list) -> np.ndarray:
            """Of rows (item, bound, m, part), the `first` of each item."""
            rows = np.concatenate(rows)
            rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
            place = np.arange(len(rows)) - np.searchsorted(rows[:, 0], rows[:, 0])
            return rows[place < first]

        for part in _parts(batches, shared.value.terms):
            bound = _bounds(shared.value, part)
            some = np.flatnonzero(bound)
            seen.append(np.stack([some, bound[some], np.full(len(some), part.m), np.full(len(some), part.part)], 1))
            if len(seen) > 1_000:
                seen = [best(seen)]
        if seen:
            kept = best(seen)
            yield pa.RecordBatch.from_arrays([pa.array(kept[:, k]) for k in range(4)], ["item", "bound", "m", "part"])

    rows = strata.mapInArrow(bounded, "item long, bound long, m long, part long")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "m", "part")
    return rows.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= first).select("item", "m", "part")


def _visited(strata: DataFrame, asked: Asked, least: np.ndarray, top: int, only: dict | None = None) -> DataFrame:
    """(item, id, score) of the `top` documents in each part for each item whose bound reaches its `least` score.

    `only` tells which items to visit a part for.
    """
    kind = strata.schema["ids"].dataType.elementType.simpleString()
    shared = strata.sparkSession.sparkContext.broadcast((asked, least, only))

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, least, only = shared.value
        for part in _parts(batches, asked.terms):
            open_ = _bounds(asked, part) >= least
            if only is not None:
                mine = np.zeros(len(open_), bool)
                mine[only.get((part.m, part.part), [])] = True
                open_ &= mine
            items = np.flatnonzero(open_)
            for at in range(0, len(items), SOME):
                which = items[at : at + SOME]
                scores = _scores(asked, part, which)
                row, doc = np.nonzero(scores >= least[which, None])
                value = scores[row, doc]
                order = np.lexsort((doc, -value, row))
                row, doc, value = row[order], doc[order], value[order]
                kept = np.arange(len(row)) - np.searchsorted(row, row) < top
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which[row[kept]]), part.ids.take(pa.array(doc[kept])), pa.array(value[kept])],
                    ["item", "id", "score"],
                )

    return strata.mapInArrow(visited, f"item long, id {kind}, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _some_items(index: Index, pairs: pa.Table, top: int, first: int) -> tuple[DataFrame, np.ndarray]:
    """(item, rank, id, score) of the items of some (item, term) pairs; `item` is a place in the second result."""
    terms = pc.unique(pairs.column("term"))
    items, pair_item = np.unique(pairs.column("item").to_numpy(), return_inverse=True)
    pair_term = pc.index_in(pairs.column("term"), value_set=terms).to_numpy().astype(np.int64)
    df = _holders(index.strata, terms)
    weight = np.floor(1000 * np.log((2 * index.n_documents + 2) / (2 * df + 1))).astype(np.int64)
    asked = Asked(items, terms, pair_term, pair_item, weight[pair_term])
    only: dict[tuple, list] = {}
    for r in _leading(index.strata, asked, first).collect():
        only.setdefault((r["m"], r["part"]), []).append(r["item"])
    least = np.ones(len(items), np.int64)
    early = _ranked(_visited(index.strata, asked, least, top, only), top).where(F.col("rank") == top)
    for r in early.select("item", "score").collect():
        least[r["item"]] = r["score"]
    return _ranked(_visited(index.strata, asked, least, top), top), items


def search(
    index: Index,
    items: DataFrame,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    top: int = 10,
    first: int = FIRST,
    together: int = TOGETHER,
) -> DataFrame:
    """The `top` documents with a score above 0 for each row of `items`: item, rank, document, score.

    A term that df of N documents hold weighs w = floor(1000 * ln((2N + 2) / (2 df + 1))); a document's
    score is the sum of w * ((10^9 tf) div (1000 tf + 8 m)) over the item's different terms. Equal scores go by id, a null id
    last, rows with the same id in any order. Items without a term, or null, have no rows; repeated items have rows each.

    No document of a stratum scores more than the sum over terms of w times the impact of the largest tf there. The
    strata with the highest bounds are visited first and give a threshold, the score that the last place already has. Of the
    others only those whose bound reaches it are visited. So the result is exact. Items are taken in blocks of about
    `together` terms, which are sent to the tasks; the index itself is never shuffled.
    """
    asked = store(bags(items, item_col, text_col).withColumnRenamed("row", "item"), "items")
    pairs = asked.select("item", F.explode(F.split("terms", " ")).alias("term"))
    blocks = max(1, -(-pairs.count() // together))
    found = []
    for block in range(blocks):
        some = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow().combine_chunks()
        if some.num_rows:
            ranked, rows = _some_items(index, some, top, first)
            found.append(_named(ranked, rows))
    if not found:
        kind = index.strata.schema["ids"].dataType.elementType.simpleString()
        found = [items.sparkSession.createDataFrame([], f"item long, rank int, id {kind}, score long")]
    best = reduce(DataFrame.unionByName, found)
    return best.join(asked.select("item", F.col("id").alias("_item_id")), "item").select(
        F.col("_item_id").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"
    )


def _named(ranked: DataFrame, rows: np.ndarray) -> DataFrame:
    """`item` as the row id that the place stands for."""
    names = ranked.sparkSession.createDataFrame(
        pa.table({"item": pa.array(np.arange(len(rows))), "_row": pa.array(rows)})
    )
    return ranked.join(names, "item").select(F.col("_row").alias("item"), "rank", "id", "score")


def rank(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    top: int = 10,
    part: int = PART,
    first: int = FIRST,
) -> DataFrame:
    """`search` over a new index of `df`. An empty table of documents or items gives no rows."""
    return search(build(df, id_col, text_col, part), items, id_col, item_col, text_col, top, first)
