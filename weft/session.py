"""SparkSession construction and the shared checkpoint folder.

On a cluster the session is built by the platform; ``get_spark`` only fills in
settings that are absent from the submitted configuration (``--conf``,
``spark-defaults.conf``), so cluster-provided values always win. Memory and JVM
options are given to a local master only.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Defaults applied only where the submitted configuration has no value.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}
# Of a JVM that this process starts itself, with a local master.
# Wide projections (29 parsed fields) compile to methods above HotSpot's
# 8 KB JIT limit; without the flag they run in the bytecode interpreter.
_LOCAL_LAUNCH = {
    "spark.driver.memory": "8g",
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}
_LAUNCH_FLAGS = {"spark.driver.memory": "--driver-memory",
                 "spark.driver.extraJavaOptions": "--driver-java-options"}


def is_local(master: str | None) -> bool:
    return master is None or master == "local" or master.startswith("local[")


def launch_defaults(master: str | None, submit_args: str) -> dict[str, str]:
    """JVM settings for a local master, without those the submit arguments name."""
    if not is_local(master):
        return {}
    return {k: v for k, v in _LOCAL_LAUNCH.items() if k not in submit_args and _LAUNCH_FLAGS[k] not in submit_args}


def missing_defaults(conf: SparkConf) -> dict[str, str]:
    """The defaults that ``conf`` has no value for."""
    return {k: v for k, v in _DEFAULTS.items() if not conf.contains(k)}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "weft") -> SparkSession:
    """Return the active session, or build one; submitted settings are kept."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    if "PYSPARK_GATEWAY_PORT" not in os.environ:  # else spark-submit has started the JVM
        launch = SparkConf(loadDefaults=False)
        for k, v in launch_defaults(master, os.environ.get("PYSPARK_SUBMIT_ARGS", "")).items():
            launch.set(k, v)
        SparkContext._ensure_initialized(conf=launch)
    else:
        SparkContext._ensure_initialized()
    submitted = SparkConf()
    builder = SparkSession.builder
    if not submitted.contains("spark.app.name"):
        builder = builder.appName(app_name)
    if master and not submitted.contains("spark.master"):
        builder = builder.master(master)
    for k, v in missing_defaults(submitted).items():
        builder = builder.config(k, v)
    if shuffle_partitions and not submitted.contains("spark.sql.shuffle.partitions"):
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if is_local(spark.sparkContext.master):
        checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Where the setting is absent, a local master gets a
    fresh private folder (removed when the process ends); on any other master
    that is an error, because executors do not share a local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # unset
            configured = None
    if not configured:
        if sc is None or not is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="weft-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/weft-{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Remove what this process wrote under its scratch paths; call it when no
    result that reads them is needed any more. Returns how many there were."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
