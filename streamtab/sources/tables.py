"""Loading the driver's parquet tables (column pruning and filters reach the scan)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; ``spark.read.parquet`` keeps the plan lazy so Catalyst
    prunes columns and pushes predicates into the parquet reader."""
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fingerprint(spark: SparkSession, sf_dir: str, *names: str) -> str:
    """Text that changes when a file of these tables does (paths, lengths, times)."""
    seen = hashlib.sha256()
    for name in names:
        root = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        files = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
        found = []
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
        seen.update("\n".join(sorted(found)).encode())
    return seen.hexdigest()[:16]


class Tables:
    """Attribute access to the tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return load(self.spark, self.sf_dir, name)
        raise AttributeError(name)
