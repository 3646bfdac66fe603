"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtab.session import ensure_checkpoint_dir, scratch_path, ship_package

#: Rows per Arrow batch: texts may be long, so batches stay small.
ARROW_ROWS = 400


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on, set on the running session."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str | Column, k: int) -> Column:
    """crc32(key as text) mod k; -1 for a null key (never held out)."""
    c = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(c.cast("string")) % k, F.lit(-1))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back:
    cuts the lineage, and later jobs read instead of recomputing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, limit: int, *keys: str) -> DataFrame:
    """Rows chosen by the hash of ``keys`` so that about ``limit`` remain, at
    most.  Only model fitting uses it; the choice depends on the keys alone."""
    n = df.count()
    if n <= limit:
        return df
    span = 1 << 40
    part = int(span * 0.98 * limit / n)
    return df.where(F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(span)) < part)


def map_text(df: DataFrame, text: str, make: Callable[[], Callable[[list], list]],
             out: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """Add columns computed from one text column, row by row, in Arrow batches.

    ``make()`` runs once per task and returns ``f(bodies) -> columns``: bodies
    are UTF-8 ``bytes`` (or ``None``), columns are sequences in the order of
    ``out``.  All input columns (or ``keep``) are carried along; a computed
    column replaces an input column of the same name.
    """
    names = list(dict.fromkeys(df.columns if keep is None else keep))
    cols = list(dict.fromkeys([*names, text]))
    src = df.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"))
    schema = T.StructType([src.schema["row"], *out.fields])
    at = cols.index(text)

    def run(batches):
        f = make()
        target = None
        for b in batches:
            if not b.num_rows:
                continue
            row = b.column(0)
            bodies = row.field(at)
            if not pa.types.is_binary(bodies.type):
                bodies = bodies.cast(pa.binary() if pa.types.is_string(bodies.type) else pa.large_binary())
            if target is None:
                from pyspark.sql.pandas.types import to_arrow_schema
                target = [x.type for x in to_arrow_schema(out)]
            got = [c if isinstance(c, pa.Array) else pa.array(c, type=t) for c, t in zip(f(bodies.to_pylist()), target)]
            yield pa.RecordBatch.from_arrays([row, *got], names=["row", *out.names])

    done = src.mapInArrow(run, schema)
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in names if c not in out.names],
                       *[F.col(f"`{c}`") for c in out.names])


__all__ = ["prepare", "table", "remainder", "materialize", "bounded_sample", "map_text", "scratch_path"]
