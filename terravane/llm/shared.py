"""Helpers that several operators share: cutting lineage on shared storage and table access."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class NoSharedFolder(RuntimeError):
    """A cluster whose executors have no common folder."""


def shared_dir(spark: SparkSession) -> str:
    """The application's folder that every executor sees, under ``spark.checkpoint.dir``; it goes when the application ends.

    Where that is unset a folder of this machine serves, but only if the executors run on it (a local master); a cluster without the setting is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors see")
        base = f"file://{tempfile.gettempdir()}"
    app = f"{base.rstrip('/')}/terravane-{spark.sparkContext.applicationId}"
    if app not in _TO_REMOVE:
        _TO_REMOVE.add(app)
        folder = spark._jvm.org.apache.hadoop.fs.Path(app)
        store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(folder)  # only a folder that exists can be marked
        store.deleteOnExit(folder)
    return app


_TO_REMOVE: set[str] = set()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends there, and a lost executor costs nothing behind it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``folds``; 0 is the held-out fold."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))
