"""Session and table helpers.

The library never decides cluster sizing: on a real cluster the session comes
configured (shuffle partitions, checkpoint dir, memory). ``local_session`` is for
tests, benches and the smoke entry only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Settings every session of ours wants; applied only where the session has no
# value yet, so a cluster's own configuration always wins.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pitchlake") -> SparkSession:
    """A local session for tests and benches (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PITCHLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Apply our defaults where the session leaves them unset, and make sure a
    checkpoint directory exists (shared folder on a cluster, scratch in tests)."""
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


_LOCAL_SCRATCH: dict[int, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and staged writes.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset (a test
    or local run) a fresh scratch folder is created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a local SparkContext (e.g. remote)
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not d and sc is not None and not getattr(sc, "master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        # Unset (a test or local run): a scratch folder, registered on the
        # context (the conf key itself cannot be changed at runtime).
        d = _LOCAL_SCRATCH.setdefault(id(spark), tempfile.mkdtemp(prefix="pitchlake-ckpt-"))
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def path_missing(error: Exception) -> bool:
    """True if ``error`` says that nothing was written at a path yet (and nothing else)."""
    condition = getattr(error, "getCondition", lambda: None)() or ""
    return condition.startswith(("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"))


def delete_path(spark: SparkSession, path: str, encoded: bool = False) -> None:
    """Delete a folder or file of our own, wherever Spark's file systems reach
    (``encoded``: the path is as ``inputFiles`` gives it)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path) if encoded else path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (Parquet)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy accessor: ``t = Tables(spark, dir); t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return table(self._spark, self._dir, name)
