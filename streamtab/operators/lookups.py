"""Queries over materialized results (Q1-Q8), as DataFrame reads.

The reference serves these over HTTP from local stores and fans out to peers;
here a result table is already global, so each query is a filter/aggregate
that Spark pushes down to the result's files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path
from .store import TableStore, hash_buckets


def materialize(df: DataFrame, name: str, sort_by: list[str] | None = None,
                path: str | None = None) -> DataFrame:
    """Write a result once as a named store (parquet below the shared
    checkpoint folder unless ``path`` is given) and return a reader of it.
    Rows are sorted within files by ``sort_by`` so the parquet min/max
    statistics let point and range lookups skip row groups; the lookups below
    are then scans with pushed filters instead of recomputations."""
    out = path or scratch_path(df.sparkSession, f"store-{name}")
    w = df.sortWithinPartitions(*sort_by) if sort_by else df
    w.write.mode("overwrite").parquet(out)
    return df.sparkSession.read.schema(df.schema).parquet(out)


def named_store(spark: SparkSession, name: str, of: str, part: Column | None = None,
                keys: list[str] | None = None) -> TableStore:
    """The store ``name`` over the inputs that the text ``of`` identifies."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return TableStore(spark, f"{base}/stores/{name}-{of}", hash_buckets(keys) if part is None else part)


def opened(spark: SparkSession, name: str, of: str, build: Callable[[], DataFrame], part: Column | None = None,
           keys: list[str] | None = None) -> DataFrame:
    """The content of a named store.  Only the first call for these inputs runs
    ``build``; every later one reads the newest version and starts no other job."""
    store = named_store(spark, name, of, part, keys)
    if store.version() is None:
        store.commit(0, build())
    return store.read()


def store_all(store: DataFrame) -> DataFrame:  # Q1
    return store


def store_get(store: DataFrame, key_col: str, key) -> DataFrame:  # Q2: absent -> no row
    return store.where(F.col(key_col) == F.lit(key))


def store_count(store: DataFrame, out: str = "n") -> DataFrame:  # Q3 exact count
    return store.agg(F.count(F.lit(1)).alias(out))


def window_range(store: DataFrame, start_from, start_to, start_col: str = "window_start") -> DataFrame:
    """Q4/Q5: windows whose *start* lies in [from, to], both inclusive."""
    return store.where(F.col(start_col).between(F.lit(start_from), F.lit(start_to)))


def window_key_range(store: DataFrame, key_col: str, key, start_from, start_to,
                     start_col: str = "window_start") -> DataFrame:  # Q6
    return window_range(store, start_from, start_to, start_col).where(F.col(key_col) == F.lit(key))


def pull(store: DataFrame, key_col: str, key, window_start=None,
         start_col: str = "window_start") -> DataFrame:  # Q7/Q8
    out = store.where(F.col(key_col) == F.lit(key))
    if window_start is not None:
        out = out.where(F.col(start_col) == F.lit(window_start))
    return out


def describe(df: DataFrame) -> list[tuple[str, str]]:  # Q12
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def described(df: DataFrame) -> DataFrame:
    """Q12 as a frame: position, name and type of every column."""
    rows = [(i, n, t) for i, (n, t) in enumerate(describe(df), 1)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")
