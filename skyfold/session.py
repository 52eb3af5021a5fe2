"""Session construction and the shared working folder.

All timestamps are interpreted in UTC: the session zone is pinned so that
``TIMESTAMP`` <-> ``TIMESTAMP_NTZ`` casts are wall-clock preserving.

Sinks write below the shared folder that the cluster names in
``spark.checkpoint.dir``; only a local session without one gets a folder of
its own.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "skyfold", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session configured the way the engine expects it.

    AQE is on (runtime coalescing of shuffle partitions, skew-join splitting,
    runtime broadcast of small sides); the UI server stays off.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC (idempotent)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Where it is unset, a local session (one process on one
    machine, as in tests) gets a folder of its own; on a cluster that would be
    a different disk on every machine, so it is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception as e:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from e
        return root.rstrip("/")
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return os.path.dirname(current.rstrip("/"))
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="skyfold-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_workspaces: list[str] = []


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder for one run of ``name``.

    It holds what a result reads from, so it outlives the call; it is removed by
    :func:`release_workspaces`, at the latest when the process ends.
    """
    path = f"{shared_dir(spark)}/skyfold/{name}-{uuid.uuid4().hex[:12]}"
    _workspaces.append(path)
    return path


def release_workspaces(spark: SparkSession | None = None) -> int:
    """Delete the folders :func:`workspace` has given out so far, once their results
    have been read; returns how many existed."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return 0
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _workspaces:
        p = jvm.org.apache.hadoop.fs.Path(_workspaces.pop())
        gone += bool(p.getFileSystem(conf).delete(p, True))
    return gone


@atexit.register
def _at_exit() -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        release_workspaces()
