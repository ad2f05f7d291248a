"""Session helpers: a local session for tests / bench and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, app: str = "ridgeline", memory: str = "8g",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local session used by tests and the bench.  On a cluster the caller owns the session.

    AQE stays on: it coalesces small shuffle partitions, turns a sort-merge join into a
    broadcast join only when the *measured* build side is under the threshold, and splits
    skewed join partitions (a hot key holding a large share of the rows).
    """
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  A private folder is created and registered only where it is unset
    and the master is local (tests); on a cluster an unset folder is an error, because each
    executor would write to its own disk.
    """
    sc = spark.sparkContext
    conf = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not conf:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="ridgeline-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(conf)
    return conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused, never cleared)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str) -> tuple:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, in whatever store the path names."""
    store, where = _file_system(spark, path)
    return store.exists(where)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a path that :func:`scratch_path` gave out, once nothing reads it any more."""
    store, where = _file_system(spark, path)
    store.delete(where, True)
