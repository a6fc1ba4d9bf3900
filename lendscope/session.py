"""Session helpers for tests and the benchmark, and shared-storage paths.

Library code never builds its own session; callers pass one in. Intermediate
tables go under the folder the cluster names in ``spark.checkpoint.dir``
(read from the session); a default is set only when it is unset, as in tests.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

_LOCAL_FALLBACK_DIR = "/tmp/lendscope-checkpoints"


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app_name: str = "lendscope") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UTC, UI off)."""
    parts = shuffle_partitions or int(cores) * 2
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _master(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.master
    except Exception:  # noqa: BLE001 - Spark Connect
        return spark.conf.get("spark.master", "") or ""


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a ``local[...]`` session (tests, a laptop) gets a fallback folder when
    the setting is unset; on a cluster an unset folder is an error, since a
    machine-local temp folder is not shared between executors.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not _master(spark).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
        path = _LOCAL_FALLBACK_DIR
        spark.conf.set("spark.checkpoint.dir", path)
    try:  # classic sessions only; Spark Connect has no SparkContext
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001
        pass
    return path


def app_id(spark: SparkSession) -> str:
    """The Spark application id (scopes per-session outputs)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect
        return spark.conf.get("spark.app.id", None) or "app"


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "lendscope", *[p.strip("/") for p in parts]])


def sf_tag(sf_dir: str) -> str:
    """Short name for a data directory, used to keep outputs of scales apart."""
    return os.path.basename(os.path.normpath(sf_dir)) or "data"


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new folder under the shared one for every call, deleted when the application ends."""
    path = shared_path(spark, *parts, uuid.uuid4().hex[:12])
    delete_on_exit(spark, path)
    return f"{path}/data"


def input_fingerprint(spark: SparkSession, paths: list[str]) -> tuple | None:
    """Name, length and modification time of every file below ``paths``: equal
    only while the inputs are. None where files can't be listed."""
    try:
        jvm, conf, found = spark._jvm, spark._jsc.hadoopConfiguration(), []
        for p in paths:
            hpath = jvm.org.apache.hadoop.fs.Path(p)
            fs = hpath.getFileSystem(conf)
            todo = list(fs.listStatus(hpath))
            while todo:
                s = todo.pop()
                if s.isDirectory():
                    todo += list(fs.listStatus(s.getPath()))
                else:
                    found.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
        return tuple(sorted(found))
    except Exception:  # noqa: BLE001 - Spark Connect, or a path without a listing
        return None


def delete_on_exit(spark: SparkSession, path: str) -> bool:
    """Have the JVM's Hadoop file system delete ``path`` when the application
    shuts down (for per-application scratch data). Returns False where this is
    not available (Spark Connect); the data then stays until the checkpoint
    folder is cleared."""
    try:
        jvm = spark._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(hpath)  # only what exists can be marked
        return bool(fs.deleteOnExit(hpath))
    except Exception:  # noqa: BLE001
        return False
