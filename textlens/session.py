"""Session helpers: local sessions for tests and the shared folder for everything written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Paths given out, by application.
_WRITTEN: dict[str, list[str]] = {}


def local_session(cpus: int | str = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark. Clusters bring their own session."""
    settings = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("textlens")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's ``spark.checkpoint.dir``.

    A machine-local folder is used only on a local master, where driver and executors are one
    process. On a cluster without the setting this raises instead of writing where a lost
    executor would take the data with it.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="textlens-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder. ``remove_written`` knows it."""
    path = f"{shared_dir(spark)}/textlens/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_written(spark: SparkSession) -> int:
    """Remove what this application has written to paths of its own below the shared folder; the number of folders removed.

    Tables that are still to be read, models and run logs without a path of their own among them, are gone afterwards.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(p) for p in _WRITTEN.pop(spark.sparkContext.applicationId, [])]
    return sum(bool(path.getFileSystem(conf).delete(path, True)) for path in paths)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder unless the session already has one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
