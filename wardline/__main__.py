"""Derive tables from Parquet to Parquet.

    python -m wardline SOURCE_ROOT TARGET_ROOT [TABLE ...] [--normalize-labels] [--ordered] [--repeats error|rows]
                       [--store FOLDER] [--rejects FOLDER]

Sources are read from ``SOURCE_ROOT/<name>.parquet``, or from the catalogue if SOURCE_ROOT is
``-``; each table is written to ``TARGET_ROOT/<name>.parquet`` and read from there by the tables
made from it. Tables that are not asked for but read more than once on the way are kept in the ``--store`` folder.
With ``--rejects`` source rows that do not survive their declared types are written there instead of ending the job.
"""

from __future__ import annotations

import argparse
from inspect import signature

from pyspark.sql import SparkSession

from wardline.plans.derive import PLANS, derive, source_names
from wardline.sources.tables import read_sources, sift_sources, store_in, write_table


def run(
    spark: SparkSession,
    source_root: str | None,
    target_root: str,
    *names: str,
    normalize_labels: bool = False,
    ordered: bool = False,
    repeats: str = "error",
    store_root: str | None = None,
    rejects_root: str | None = None,
) -> None:
    names = names or tuple(PLANS)
    if unknown := sorted(set(names) - set(PLANS)):
        raise ValueError(f"no table {', '.join(unknown)}; there are {', '.join(PLANS)}")
    needed = sorted(set().union(*(source_names(n) for n in names)))
    if rejects_root is None:
        tables = read_sources(spark, source_root, needed)
    else:
        tables = sift_sources(spark, source_root, rejects_root, needed)
    store = None if store_root is None else store_in(store_root)
    for name in PLANS:  # in the order of their dependencies
        if name in names:
            taken = signature(PLANS[name][0]).parameters
            given = {"normalize_labels": normalize_labels, "ordered": ordered}
            given = {k: v for k, v in given.items() if k in taken}
            df = derive(name, tables, store=store, repeats=repeats, **given)
            tables[name] = write_table(df, f"{target_root}/{name}.parquet")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m wardline", description="Derive tables from Parquet to Parquet.")
    parser.add_argument("source_root")
    parser.add_argument("target_root")
    parser.add_argument("tables", nargs="*", metavar="TABLE", help=f"of {', '.join(PLANS)}; all by default")
    parser.add_argument("--normalize-labels", action="store_true", help="read blanks in dialysis types as underscores")
    parser.add_argument("--ordered", action="store_true", help="sort rows by stay and time")
    parser.add_argument(
        "--repeats", choices=("error", "rows"), default="error", help="what repeated stays, offsets and overlapping weights give"
    )
    parser.add_argument("--store", metavar="FOLDER", help="keep tables read more than once here; a folder all machines share")
    parser.add_argument("--rejects", metavar="FOLDER", help="write source rows that cannot be read as declared here")
    given = parser.parse_args(arguments)
    if unknown := sorted(set(given.tables) - set(PLANS)):
        parser.error(f"no table {', '.join(unknown)}; there are {', '.join(PLANS)}")
    run(
        SparkSession.builder.appName("wardline").getOrCreate(),
        None if given.source_root == "-" else given.source_root,
        given.target_root,
        *given.tables,
        normalize_labels=given.normalize_labels,
        ordered=given.ordered,
        repeats=given.repeats,
        store_root=given.store,
        rejects_root=given.rejects,
    )


if __name__ == "__main__":
    main()
