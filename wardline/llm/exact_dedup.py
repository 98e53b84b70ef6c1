"""Exact deduplication with a heavy-hitter split."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.shared import lower_ascii, store

#: Counters of a Misra-Gries summary: no more than this many digests are ever broadcast.
COUNTERS = 1024


def misra_gries(batches: Iterator[pa.RecordBatch], counters: int = COUNTERS) -> Iterator[pa.RecordBatch]:
    """Summary of one task's digests: (digest, n) with at most `counters` rows.

    n is at most the true count and short of it by at most the task's rows / (counters + 1).
    """
    kept: dict[bytes, int] = {}
    for batch in batches:
        for pair in pc.value_counts(batch.column(0)).to_pylist():
            kept[pair["values"]] = kept.get(pair["values"], 0) + pair["counts"]
        if len(kept) > counters:
            cut = sorted(kept.values(), reverse=True)[counters]
            kept = {digest: n - cut for digest, n in kept.items() if n > cut}
    yield pa.RecordBatch.from_pydict(
        {"digest": pa.array(kept.keys(), pa.binary()), "n": pa.array(kept.values(), pa.int64())}
    )


def mark_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per row of `df`: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with the
    largest id of a group stays; a null id loses to any other, and of rows tied on the largest id
    one stays. An empty table gives no rows. Other columns of `df` are not read.

    Frequent digests are found by Misra-Gries summaries of the tasks, merged by adding: a digest of
    at least 2/counters of all rows is sure to reach a sum of 1/counters, which at most `counters`
    digests can. Their rows are counted exactly with map-side combining, and the winners, at most
    `counters`, are broadcast to take these rows out without a shuffle. All other groups hold fewer
    than 2/counters of the rows and are shuffled by digest.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    digests = store(
        df.select(
            F.col(id_col).alias("id"),
            F.unhex(F.sha2(lower_ascii(text).cast("binary"), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    total = digests.count()
    candidates = (
        digests.select("digest")
        .mapInArrow(lambda batches: misra_gries(batches, counters), "digest binary, n long")
        .groupBy("digest")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") * counters >= total)
        .select("digest")
    )
    winner = F.max(F.struct("id", "row"))
    winners = (
        digests.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(winner.alias("winner"), F.count("*").alias("group_size"))
    )
    winners = store(winners, "winners")
    marked = digests.join(F.broadcast(winners), "digest", "left")
    same = Window.partitionBy("digest")
    rest = (
        marked.where(F.col("winner").isNull())
        .withColumn("winner", winner.over(same))
        .withColumn("group_size", F.count("*").over(same))
    )
    return (
        marked.where(F.col("winner").isNotNull())
        .unionByName(rest)
        .select(
            F.col("id").alias(id_col),
            F.col("winner.id").alias("keep_id"),
            "group_size",
            (F.col("row") == F.col("winner.row")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of `df` that stay, with all their columns; ids, texts and ties as in `mark_copies`.

    Rows are found again by (id, digest), which tells all rows apart but those that repeat both;
    of these one stays, whichever values the other columns have.
    """
    marks = store(mark_copies(df, id_col, text_col, counters), "marks")
    stays = F.col(id_col).eqNullSafe(F.col("keep_id"))
    kept = marks.where("kept").select(F.col(id_col).alias("_kept_id"), F.unhex("text_sha256").alias("_kept_digest"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.withColumn("_digest", F.unhex(F.sha2(lower_ascii(text).cast("binary"), 256)))
    found = rows.join(kept, rows[id_col].eqNullSafe(kept._kept_id) & (rows._digest == kept._kept_digest), "left_semi")
    tied = marks.where(stays & ~F.col("kept")).select(F.unhex("text_sha256").alias("_digest")).distinct()
    if not tied.isEmpty():
        found = found.join(tied, "_digest", "left_anti").unionByName(
            found.join(tied, "_digest", "left_semi").dropDuplicates([id_col, "_digest"])
        )
    return found.select(*df.columns)
