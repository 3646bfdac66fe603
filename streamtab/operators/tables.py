"""Tables as upsert changelogs (S3, S4, D2, T6), the exact as-of join (J2) and
table-table joins (J5).

A table is the latest value per key in arrival order; a tombstone (null value,
or a caller-supplied delete predicate) removes the key.  ``latest`` is a hash
aggregate with map-side partial aggregation (``max_by``), so a hot key costs one
partial row per map task, never a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scan import Agg, ScanConfig, running


def _order_struct(order: list[str]) -> Column:
    return F.struct(*[F.col(o) for o in order])


def latest(df: DataFrame, key: list[str] | str, order: list[str] | str, values: list[str],
           tombstone: Column | str | None = None, keep_order: bool = True) -> DataFrame:
    """Latest row per key by arrival ``order``; tombstoned keys are dropped.

    ``tombstone`` marks delete records; by default a record whose ``values`` are
    all null is a tombstone.  The record that wins is the latest one *including*
    deletes, so a delete after an update removes the key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    if tombstone is None:
        dead = F.lit(True)
        for v in values:
            dead = dead & F.col(v).isNull()
    else:
        dead = F.expr(tombstone) if isinstance(tombstone, str) else tombstone
    dead = F.coalesce(dead, F.lit(False))
    fixed = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType,
             T.DateType, T.TimestampType, T.TimestampNTZType)
    if len(order) == 1 and all(isinstance(df.schema[v].dataType, fixed) for v in values):
        # fixed-width buffers: one max_by per column is a hash aggregate
        o = F.col(order[0])
        out = (df.withColumn("__dead", dead).groupBy(*keys)
                 .agg(F.max(o).alias(order[0]), *[F.max_by(v, o).alias(v) for v in values],
                      F.max_by("__dead", o).alias("__dead"))
                 .where(~F.col("__dead")))
        return out.select(*keys, *((order if keep_order else []) + values))
    rec = F.struct(*[F.col(o) for o in order], *[F.col(v) for v in values], dead.alias("__dead"))
    out = (df.groupBy(*keys).agg(F.max_by(rec, _order_struct(order)).alias("__r"))
             .where(~F.col("__r.__dead"))
             .select(*keys, *[F.col(f"__r.{c}").alias(c) for c in (order if keep_order else []) + values]))
    return out


def latest_non_null(col: str, order: list[str] | str) -> Column:
    """``LATEST_BY_OFFSET(col)``: value of the latest row where ``col`` is not null."""
    order = [order] if isinstance(order, str) else list(order)
    return F.max_by(F.col(col), F.when(F.col(col).isNotNull(), _order_struct(order)))


def asof_lookup(stream: DataFrame, changelog: DataFrame, key: str, order: list[str],
                values: list[str], tombstone: Column | str | None = None, how: str = "inner",
                prefix: str = "t_", cfg: ScanConfig | None = None) -> DataFrame:
    """Every stream row sees the table *as of its arrival* (latest changelog
    record with an earlier position in ``order``).  ``how="inner"`` drops rows
    with no live table value, like the reference's stream-table join.

    Both inputs are unioned and a skew-safe running last-value scan replays the
    table per key; there is no range join and no per-key collection.
    """
    if tombstone is None:
        dead = F.lit(True)
        for v in values:
            dead = dead & F.col(v).isNull()
    else:
        dead = F.expr(tombstone) if isinstance(tombstone, str) else tombstone
    tab = changelog.select(
        F.col(key).alias("__k"), *[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)],
        F.struct(F.coalesce(dead, F.lit(False)).alias("__dead"),
                 *[F.col(o).alias(f"{prefix}{o}") for o in order],
                 *[F.col(v).alias(f"{prefix}{v}") for v in values]).alias("__tv"),
        F.lit(None).cast(stream.select(F.struct(*stream.columns).alias("s")).schema["s"].dataType).alias("__s"),
    )
    srow = stream.select(
        F.col(key).alias("__k"), *[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)],
        F.lit(None).cast(tab.schema["__tv"].dataType).alias("__tv"),
        F.struct(*stream.columns).alias("__s"),
    )
    # at one position the stream row comes first: it sees earlier records only
    both = tab.withColumn("__side", F.lit(1)).unionByName(srow.withColumn("__side", F.lit(0)))
    ocols = [f"__o{i}" for i in range(len(order))] + ["__side"]
    scanned = running(both, ["__k"], ocols, {"__seen": Agg("last", "__tv")}, cfg)
    out = scanned.where(F.col("__s").isNotNull())
    live = F.col("__seen").isNotNull() & ~F.col("__seen.__dead")
    if how == "inner":
        out = out.where(live)
    seen_fields = [f"{prefix}{o}" for o in order] + [f"{prefix}{v}" for v in values]
    return out.select("__s.*", *[F.when(live, F.col(f"__seen.{f}")).alias(f) for f in seen_fields])


def table_join(left: DataFrame, right: DataFrame, on: list[str] | str, how: str = "inner") -> DataFrame:
    """Symmetric join of two tables (both already reduced with ``latest``)."""
    return left.join(right, on, how)
