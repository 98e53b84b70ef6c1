"""Helpers the operators share: stored tables, text normalisation, gapless numbering."""

from __future__ import annotations

import string
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Numbering deals the rows of a group to this many windows.
BUCKETS = 256
#: Bytes of rows that go to Python together. Spark's 64 MB are met only after 10,000 rows of common texts, and then an
#: executor and its Python workers hold each of them several times.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`; one of our own only in local mode without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = tempfile.mkdtemp(prefix="wardline-llm-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def store(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: computed once, and safe when an executor is lost."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def drop(df: DataFrame) -> None:
    """Remove a table made by `store` that nothing will read again."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """What is stored within goes to Python in batches of BATCH_BYTES, unless the session has a limit of its own."""
    ours = spark.conf.get(BATCH, None) is None
    if ours:
        spark.conf.set(BATCH, BATCH_BYTES)
    try:
        yield
    finally:
        if ours:
            spark.conf.unset(BATCH)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; null stays null.

    `translate` makes an object for each character, `lower` none for texts of ASCII, for which both are the same.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`: the fold of a document."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def numbered(df: DataFrame, group: Sequence[str], key: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, however large a group is.

    Rows are ordered by (crc32 of the first key as text modulo BUCKETS, key); rows equal in it are
    numbered in any order. So a group is dealt to BUCKETS windows, whose offsets come from their
    counts. `df` is computed twice, so give a stored table, or one whose `group` and `key` are cheap.
    """
    on = [*group, "_bucket"]
    dealt = df.withColumn("_bucket", F.coalesce(remainder(F.col(key[0]), BUCKETS), F.lit(0)).cast("int"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(*on)
        .agg(F.count("*").alias("_n"))
        .select(*on, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    ranked = dealt.withColumn("_place", F.row_number().over(Window.partitionBy(*on).orderBy(*key)) - 1)
    return (
        ranked.join(offsets, on)
        .withColumn(name, (F.col("_place") + F.col("_before")).cast("long"))
        .drop("_bucket", "_place", "_before")
    )
