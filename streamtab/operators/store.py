"""Versioned result tables (D6) on shared storage.

A store is a folder of immutable data folders and manifests:

* ``data/v=<version>/p=<partition>``: rows of one partition as that version wrote it;
* ``manifest/v=<version>``: for every live partition the version that holds it.

``commit`` merges a batch of changes: only the partitions it touches are read and
written anew, all others are carried over by the manifest, expired ones leave it.
The manifest is written last, so a version exists whole or not at all; a reader
takes the newest one and keeps it, whatever is committed meanwhile.  Versions are
numbers the caller gives (a micro-batch id): committing one again, after a failure,
starts from the version before it and replaces it, which makes merges exactly once.

Partitions are days, hash buckets or any text computed from the keys.  The driver
sees one row a live partition; rows are merged by Spark jobs alone.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = T.StructType([T.StructField("part", T.StringType()), T.StructField("at", T.LongType()),
                         T.StructField("schema", T.StringType())])


def hash_buckets(keys: list[str], n: int = 8) -> Column:
    """Partition value of a key-value store: one of ``n`` buckets by key."""
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("string")


def day_of(ts: str) -> Column:
    """Partition value of a window store: the day of a timestamp (days sort as text)."""
    return F.date_format(ts, "yyyy-MM-dd")


class TableStore:
    """A keyed table in versions below ``path``; ``part`` computes a row's partition."""

    def __init__(self, spark: SparkSession, path: str, part: Column):
        self.spark, self.path, self.part = spark, path.rstrip("/"), F.coalesce(part, F.lit("none"))

    # ---- files ----
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _numbers(self, kind: str, complete: bool) -> list[int]:
        fs, p = self._fs(f"{self.path}/{kind}")
        if not fs.exists(p):
            return []
        found = [s.getPath() for s in fs.listStatus(p) if s.isDirectory()]
        found = [f for f in found if not complete or fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
        return sorted(int(f.getName().split("=")[1]) for f in found)

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def versions(self) -> list[int]:
        return self._numbers("manifest", complete=True)

    def version(self, before: int | None = None) -> int | None:
        """The newest version (older than ``before``)."""
        old = [v for v in self.versions() if before is None or v < before]
        return old[-1] if old else None

    def _manifest(self, version: int | None) -> tuple[dict[str, int], T.StructType | None]:
        if version is None:
            return {}, None
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/v={version}").collect()
        return {r.part: r.at for r in rows if r.part is not None}, T.StructType.fromJson(json.loads(rows[0].schema))

    def _load(self, live: dict[str, int], schema: T.StructType) -> DataFrame:
        if not live:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/data/v={at}/p={p}" for p, at in sorted(live.items())]
        return self.spark.read.schema(schema).parquet(*folders).select(*schema.names)

    # ---- reading ----
    def read(self, before: int | None = None, parts: list[str] | None = None) -> DataFrame | None:
        """One consistent version (the newest, or the newest older than ``before``), of
        all or some partitions; None before the first commit."""
        live, schema = self._manifest(self.version(before))
        if schema is None:
            return None
        return self._load({p: at for p, at in live.items() if parts is None or p in parts}, schema)

    # ---- writing ----
    def commit(self, version: int, changes: DataFrame, merge: Callable[[DataFrame], DataFrame] | None = None,
               expire_before: str | None = None, keep: int = 2) -> int:
        """Make ``version``: the one before it with ``changes`` (rows of the store's schema)
        put through ``merge`` together with the present rows of the partitions they
        touch (default: changes replace those partitions).  Partitions below
        ``expire_before`` are dropped, late changes to them too.  The ``keep`` newest
        versions stay readable; what only older ones use is deleted."""
        live, schema = self._manifest(self.version(version))
        schema = schema or T.StructType([T.StructField(f.name, f.dataType) for f in changes.schema])
        staged = f"{self.path}/changes/v={version}"
        rows = changes.select(*schema.names).withColumn("p", self.part)
        if expire_before is not None:
            rows = rows.where(F.col("p") >= expire_before)
            live = {p: at for p, at in live.items() if p >= expire_before}
        rows.write.mode("overwrite").parquet(staged)
        rows = self.spark.read.schema(rows.schema).parquet(staged)
        touched = [r.p for r in rows.select("p").distinct().collect()]
        if touched:
            new = rows.drop("p")
            if merge is not None:
                old = self._load({p: live[p] for p in touched if p in live}, schema)
                new = merge(old.unionByName(new)).select(*schema.names)
            data = f"{self.path}/data/v={version}"
            (new.withColumn("p", self.part).hint("rebalance", "p")
                .write.mode("overwrite").partitionBy("p").parquet(data))
            fs, p = self._fs(data)
            written = {s.getPath().getName().split("=", 1)[1] for s in fs.listStatus(p) if s.isDirectory()}
            live = {**{p: at for p, at in live.items() if p not in touched}, **{p: version for p in written}}
        manifest = [(None, None, schema.json()), *[(p, at, schema.json()) for p, at in sorted(live.items())]]
        (self.spark.createDataFrame(manifest, MANIFEST).coalesce(1)
             .write.mode("overwrite").parquet(f"{self.path}/manifest/v={version}"))
        self._delete(staged)
        self._clean(max(keep, 2))                        # the one before stays for a replay
        return version

    def _clean(self, keep: int) -> None:
        newest = self.versions()[-keep:]
        used = {at for v in newest for at in self._manifest(v)[0].values()}
        for v in self.versions():
            if v not in newest:
                self._delete(f"{self.path}/manifest/v={v}")
        for v in self._numbers("data", complete=False):
            if v not in used and v <= newest[-1]:
                self._delete(f"{self.path}/data/v={v}")


def merge_sums(keys: list[str], **aggs: Column) -> Callable[[DataFrame], DataFrame]:
    """Merge by one aggregate over present and changed rows of a key."""
    return lambda rows: rows.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def merge_latest(keys: list[str], order: list[str], values: list[str], keep: Column | None = None) -> Callable[[DataFrame], DataFrame]:
    """Merge by the latest row of a key; of those only rows that ``keep`` holds for stay."""
    from .tables import latest

    def merge(rows: DataFrame) -> DataFrame:
        out = latest(rows, keys, order, values, tombstone=F.lit(False))
        return out if keep is None else out.where(keep)
    return merge


__all__ = ["TableStore", "hash_buckets", "day_of", "merge_sums", "merge_latest"]
