"""Session helpers: where checkpoints and scratch tables go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Scratch tables of the runs that are going on, the innermost last.
_runs: list[list[str]] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder, because there the driver and the tasks see the same disk.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        configured = tempfile.mkdtemp(prefix="samekin-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table, inside the shared checkpoint folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}/{name}"
    if _runs:
        _runs[-1].append(path)
    return path


def release(spark: SparkSession, path: str) -> None:
    """Delete a scratch table with the folder made for it, in whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are deleted at the end. DataFrames that read them are lazy, so results
    have to be written, or collected, before that."""
    _runs.append([])
    try:
        yield
    finally:
        for path in _runs.pop():
            release(spark, path)
