"""Session helpers: a local session for tests/bench and the shared scratch area.

Scratch output (fixture dumps, published releases, registry versions) always goes
under the shared folder the cluster names in ``spark.checkpoint.dir``.  Only when
that setting is absent on a local master (tests) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "releasekit") -> SparkSession:
    """Session used by tests and bench; the driver brings its own session."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        d = spark.sparkContext.getCheckpointDir()
        if d:
            return d
    except Exception:  # Spark Connect has no SparkContext
        pass
    try:
        return spark.conf.get("spark.checkpoint.dir", None) or None
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when unset."""
    d = _configured_checkpoint_dir(spark)
    if d:
        try:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(d)
        except Exception:
            pass
        return d
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="releasekit-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def _is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (``local``, ``local[n]``, not ``local-cluster``)."""
    try:
        master = spark.sparkContext.master
    except Exception:  # Spark Connect: no SparkContext on the client, so a remote cluster
        return False
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique directory under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/releasekit-scratch/{label}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def clear_scratch(spark: SparkSession) -> None:
    """Remove all scratch output of finished queries (their results can no longer be read)."""
    fs, path = _file_system(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/releasekit-scratch")
    fs.delete(path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (possibly remote) file system.  Only a real "not found"
    is False: an unreachable or forbidden location raises."""
    fs, hpath = _file_system(spark, path)
    return bool(fs.exists(hpath))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a directory; none if it does not exist."""
    fs, hpath = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []


def remove_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _file_system(spark, path)
    fs.delete(hpath, True)


def move_into_place(spark: SparkSession, staged: str, target: str) -> None:
    """Replace ``target`` by the finished ``staged`` directory.  The old one is set aside first and
    removed last, so a crash in between loses neither; readers may find no ``target`` for the
    moment between the two renames (``writers.publish_release`` has no such moment)."""
    fs, old = _file_system(spark, target)
    _, new = _file_system(spark, staged)
    _, aside = _file_system(spark, f"{target.rstrip('/')}.replaced-{uuid.uuid4().hex[:12]}")
    had = fs.exists(old)
    if had and not fs.rename(old, aside):
        raise OSError(f"could not set {target} aside")
    if not fs.rename(new, old):
        if had:
            fs.rename(aside, old)
        raise OSError(f"could not move {staged} to {target}")
    if had:
        fs.delete(aside, True)
