"""Session construction and shared-folder helpers.

Scratch output (round-trip tables, exported CSVs, checkpoints) always lives under
the folder the cluster names in ``spark.checkpoint.dir``.  Only when that setting
is absent (a laptop or a unit test) do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on.  Session time zone is pinned so that the few
# zone-aware expressions (current_date for the "previous month" default) are
# reproducible; all trip timestamps are TIMESTAMP_NTZ and never shift.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Concurrent jobs (the mart lanes) share executors fairly, one pool per lane.
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "velomart",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings of ``BASE_CONF``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    ``spark.checkpoint.dir`` is a core setting that cannot be changed on a
    running session, so the local fallback (tests, a laptop) goes through
    ``setCheckpointDir``; Spark then reports ``<root>/<application uuid>``.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        context = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        context = None
    current = context.getCheckpointDir() if context is not None else None
    if configured:
        if context is not None and not current:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        return current.rstrip("/").rsplit("/", 1)[0]
    master = (context.master if context is not None else spark.conf.get("spark.master", "")) or ""
    if master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir is not set: executors need a folder that all of them share")
    local_root = tempfile.mkdtemp(prefix="velomart-ckpt-")
    if context is not None:
        context.setCheckpointDir(local_root)
    return local_root


# Scratch folders handed out by this process, so that clear_scratch removes
# only its own and never another application's under the shared folder.
_ISSUED: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    path = os.path.join(root, "velomart", f"{name}-{uuid.uuid4().hex[:12]}")
    _ISSUED.append(path)
    return path


def clear_scratch(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete scratch folders this process was given (all, or those of ``paths``
    among them); returns how many existed.

    Call it once the results that read them (round-trip queries, exports) have
    been collected.  A path not issued by :func:`scratch_path` here is never
    touched.  Deletion goes through the Hadoop file system of each path, so it
    works on shared storage; a Spark Connect session has no handle to it and
    deletes nothing.
    """
    try:
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:
        return 0
    chosen = [p for p in _ISSUED if paths is None or p in paths]
    removed = 0
    for issued in chosen:
        _ISSUED.remove(issued)
        path = jvm.org.apache.hadoop.fs.Path(issued)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            fs.delete(path, True)
            removed += 1
    return removed


_PACKAGE = Path(__file__).resolve().parent
_SHIPPED: set[str] = set()  # applications whose workers have the package


def ship_package(spark: SparkSession) -> None:
    """Gives the Python workers this package, once an application: its functions are
    sent by name, and an executor need not have it installed.  The archive of code is
    made on the driver, which serves it to the executors."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    path = Path(tempfile.mkdtemp(prefix="velomart-code-")) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(_PACKAGE.rglob("*.py")):
            archive.write(file, file.relative_to(_PACKAGE.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)
