"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: adaptive execution (runtime broadcast
# decisions from measured sizes, partition coalescing, skew-join splitting)
# and UTC so DATE arithmetic never shifts.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "revtrace",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Only a local master
    (unit tests, a bare local session) may leave it unset: a private folder
    is then created. On a cluster an unset folder is an error, since
    executors would write where nobody else can read.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="revtrace-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_run_folders: dict[str, str] = {}


def run_dir(spark: SparkSession) -> str:
    """This application's folder in the shared checkpoint area, removed when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _run_folders:
        _run_folders[app] = f"{ensure_checkpoint_dir(spark).rstrip('/')}/revtrace-{app}"
        atexit.register(_remove_at_exit, spark, app)
    return _run_folders[app]


def _remove_at_exit(spark: SparkSession, app: str) -> None:
    try:
        remove(spark, _run_folders.pop(app))
    except Exception:  # noqa: BLE001  the session is gone: nothing can be removed through it
        pass


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of :func:`run_dir` for intermediate data.

    Stream checkpoints, staged reloads, feed files: anything that must
    survive the loss of an executor lives in shared storage, never on a
    machine-local disk.
    """
    return f"{run_dir(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, if it is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder of the shared storage is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


#: What holds while intermediate rows are written: no file of a query's own shuffles outlives it, and written files are packed closely.
LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


@contextmanager
def lean_writes(spark: SparkSession) -> Iterator[None]:
    """Queries run here leave on disk what they write and nothing else: their shuffles go as each ends, not when the driver collects garbage."""
    old = {k: spark.conf.get(k) for k in LEAN}
    for k, v in LEAN.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to a fresh shared folder and return it read back.

    Cuts the lineage (a lost executor re-reads the written files instead of
    recomputing the plan) and, unlike an eager ``checkpoint()``, runs the
    plan a single time. The folder lives under the cluster's shared
    checkpoint directory, never on a machine-local disk. It goes with
    :func:`discard`, or at the end of the application.
    """
    path = shared_dir(df.sparkSession, purpose)
    with lean_writes(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._revtrace_path = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Remove the folders of materialized frames that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_revtrace_path", None)
        if path:
            remove(df.sparkSession, path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python code can inspect local test output."""
    return path[5:] if path.startswith("file:") else path
