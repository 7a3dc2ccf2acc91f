"""Session helpers: a local session for tests and the bench, and the shared
checkpoint folder every lineage cut goes to."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "wingspan") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Taken from the session (an already set checkpoint dir, or
    ``spark.checkpoint.dir``). Only a local session without one gets a
    private folder; a cluster session without one is an error, because a
    machine-local folder is not visible to other executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext handle
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir()
        return configured
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if master.startswith("local"):
        local = tempfile.mkdtemp(prefix="wingspan-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(local)
            return sc.getCheckpointDir()
        spark.conf.set("spark.checkpoint.dir", local)
        return local
    raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder shared by the cluster")


#: The scratch folders of the scope that this thread works for, if any.
_SCRATCH: ContextVar[list[str] | None] = ContextVar("wingspan_scratch", default=None)
#: Folders made outside of any scope, whose frames may still be read: their owner removes them (``drop_paths``).
_SCRATCH_MADE: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (recorded so that the
    ``scratch_scope`` around it can remove it once the load is published)."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    made = _SCRATCH.get()
    (_SCRATCH_MADE if made is None else made).append(path)
    return path


def drop_paths(spark: SparkSession, paths: list[str]) -> int:
    """Delete folders through the session's Hadoop file system (works for any
    shared store the cluster mounts). Returns how many were removed."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()  # noqa: SLF001 - classic session handles
    except Exception:  # remote session: leave clean-up to the folder's retention
        return 0
    removed = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).delete(path, True):
            removed += 1
    return removed


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove every scratch folder created inside the block when it ends
    (published or failed). Each scope has its own list, which threads started by
    ``plans.load.together`` share, so loads side by side keep their folders apart.
    Frames that still read those folders must not be used afterwards; published
    tables are read from the store instead."""
    made: list[str] = []
    token = _SCRATCH.set(made)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        drop_paths(spark, made)
