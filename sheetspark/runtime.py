"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, as named by ``spark.checkpoint.dir``.

    A session without the setting gets a folder of its own only in local mode,
    where driver and executors share one machine.
    """
    global _local_dir
    configured = spark.conf.get("spark.checkpoint.dir", "") or ""
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="sheets-")
    return _local_dir


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a folder that is already set."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(spark))
