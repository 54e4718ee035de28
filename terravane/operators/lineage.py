"""Cutting lineage in iterative operators, on storage that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class NoSharedFolder(RuntimeError):
    """A cluster whose executors have no common folder."""


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see, under ``spark.checkpoint.dir``; where that is unset a folder of this machine serves a local master, and a cluster is refused. It goes when the application ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors see")
        base = f"file://{tempfile.gettempdir()}"
    path = f"{base.rstrip('/')}/terravane-{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(folder)  # only a folder that exists can be marked
    store.deleteOnExit(folder)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` to ``spark.checkpoint.dir``; where that is unset a folder of this machine serves a local master, and a cluster is refused."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        base = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not base:
            if context.master.split("[")[0] != "local":
                raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors see")
            base = f"file://{tempfile.gettempdir()}/terravane-checkpoints"
        context.setCheckpointDir(base)
    return df.checkpoint(eager=True)
