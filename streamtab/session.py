"""Session helpers: one place for the Spark configuration the operators assume."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every plan in this package relies on.  AQE re-plans joins at runtime
# (broadcasts a side only once its materialised size is known to be small) and
# splits skewed shuffle partitions of sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, partitions: int | None = None,
                app: str = "streamtab", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` and ``partitions`` are only applied when given: on a cluster the
    launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``streamtab`` importable in Python workers (stateful processors and
    pandas functions are pickled by reference): zip the package once and
    ``addPyFile`` it, which distributes it to every executor."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    tmp = tempfile.mkdtemp(prefix="streamtab-pkg-")
    archive = shutil.make_archive(os.path.join(tmp, "streamtab"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="streamtab")
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to shared storage and we only read it.
    Only on a local master do we create a private folder where it is unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder shared by all executors (master {master})")
        d = tempfile.mkdtemp(prefix="streamtab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["get_session", "ensure_checkpoint_dir", "scratch_path", "ship_package", "DEFAULT_CONF"]
