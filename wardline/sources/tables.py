"""Reading source tables and writing derived ones as Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.schemas import OPTIONAL, SOURCES


def conform(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a source table, in their declared types and lower case.

    Other columns are dropped, so they are not read. A column that has its type already
    is left as it is and filters on it still reach the scan, and so is a decimal where a
    double is declared: its digits are kept. Any other value that does not survive its
    type is an error when the column is read: text that is no number, an offset with a
    fraction or beyond the type's range. A missing unit admission offset is read as NULL.
    """
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    return df.select(
        *(
            _conformed(f.name, kinds.get(f.name), f.dataType).alias(f.name)
            if f.name in kinds or f.name not in OPTIONAL
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in SOURCES[name]
        )
    )


def _conformed(column: str, kind: T.DataType | None, wanted: T.DataType) -> Column:
    value, lost = _read(column, kind, wanted)
    if lost is None:
        return value
    message = F.concat(F.lit(f"{column} cannot be read as {wanted.simpleString()}: "), F.col(column).cast("string"))
    return F.when(lost, F.raise_error(message)).otherwise(value)


def _read(column: str, kind: T.DataType | None, wanted: T.DataType) -> tuple[Column, Column | None]:
    """A column in its declared type, and whether a value does not survive it (None: all do)."""
    value = F.col(column)
    if kind == wanted or isinstance(wanted, T.StringType):
        return value.cast(wanted), None
    if isinstance(kind, T.DecimalType) and isinstance(wanted, T.DoubleType):
        return value, None
    cast = value.try_cast(wanted)
    lost = value.isNotNull() & cast.isNull()
    if isinstance(wanted, T.LongType) and not isinstance(kind, T.IntegralType):
        # a cast to a whole number cuts fractions off
        lost = lost | (value.try_cast("decimal(38,18)") != cast)
    return cast, F.coalesce(lost, F.lit(False))


class Sifted(NamedTuple):
    """Rows of a source whose values all survive their types, the others, and how many there are."""

    accepted: DataFrame
    rejected: DataFrame
    counts: Observation


#: Names the columns of a rejected row whose values do not survive their type.
REJECTED = "rejected_columns"


def sift(df: DataFrame, name: str) -> Sifted:
    """A source table as `conform` makes it, without the rows that it would fail on.

    ``rejected`` holds those rows whole, their declared columns as text, and says which columns are at fault.
    ``counts`` gives the number of ``rows``, of ``rejected`` ones, and of values lost in each declared column; it is
    filled by the first action that reads all of ``accepted``, in the same pass.
    """
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    declared = [f for f in SOURCES[name] if f.name in kinds or f.name not in OPTIONAL]
    missing = [f for f in SOURCES[name] if f not in declared]
    read = {f.name: _read(f.name, kinds.get(f.name), f.dataType) for f in declared}
    lost = {c: F.lit(False) if of is None else of for c, (_, of) in read.items()}
    faults = F.array_compact(F.array(*(F.when(of, F.lit(c)) for c, of in lost.items())))
    marked = df.withColumn(REJECTED, faults)
    bad = F.size(REJECTED) > 0
    counts = Observation()
    observed = marked.observe(
        counts,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(bad).alias("rejected"),
        *(F.count_if(F.array_contains(REJECTED, c)).alias(c) for c in read),
    )
    values = [v.alias(c) for c, (v, _) in read.items()]
    accepted = observed.filter(~bad).select(*values, *(F.lit(None).cast(f.dataType).alias(f.name) for f in missing))
    rejected = marked.filter(bad).select(*(F.col(c).cast("string").alias(c) for c in read), REJECTED)
    return Sifted(accepted.select(*SOURCES[name].fieldNames()), rejected, counts)


def raw_source(spark: SparkSession, root: str | None, name: str) -> DataFrame:
    return spark.table(name) if root is None else spark.read.parquet(f"{root}/{name}.parquet")


def read_source(spark: SparkSession, root: str | None, name: str) -> DataFrame:
    """A source table from ``<root>/<name>.parquet``, or without a root from the catalogue."""
    return conform(raw_source(spark, root, name), name)


def read_sources(
    spark: SparkSession, root: str | None, names: Iterable[str] = tuple(SOURCES)
) -> dict[str, DataFrame]:
    """Source tables by name; without a root they are tables of the current catalogue and schema."""
    return {name: read_source(spark, root, name) for name in names}


def sift_sources(
    spark: SparkSession, root: str | None, rejects_root: str, names: Iterable[str] = tuple(SOURCES)
) -> dict[str, DataFrame]:
    """Source tables without the rows that do not survive their types, which are written to ``<rejects_root>/<name>.parquet``."""
    tables = {}
    for name in names:
        sifted = sift(raw_source(spark, root, name), name)
        write_table(sifted.rejected, f"{rejects_root.rstrip('/')}/{name}.parquet")
        tables[name] = sifted.accepted
    return tables


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write a derived table and hand back a DataFrame that reads it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_in(folder: str) -> Callable[[DataFrame, str], DataFrame]:
    """A way for `derive` to store the tables that several steps read: as Parquet under ``folder``.

    The later steps then start from files: they are computed once and plans stay small. The
    folder must be one that driver and executors share; its owner removes it.
    """
    return lambda df, name: write_table(df, f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}")
