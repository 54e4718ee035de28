"""Ingest of growing folders of files: each run takes what is new, whatever was interrupted before.

A run is a file stream with ``availableNow``: it reads the files that its checkpoint has not seen and ends. Each micro-batch writes its own folder of the target
and replaces it if the batch is repeated, so a batch that was written but not noted leaves no row twice. Rows of a key that came again are told apart when the table is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest_new_files(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, kind: str = "parquet", files_per_batch: int = 1000, by: list[str] | None = None) -> None:
    """Adds the files of ``source`` that no earlier run with this ``checkpoint`` took to ``target``, partitioned by batch and ``by``.

    ``target`` and ``checkpoint`` lie on storage that all executors see. Files are taken once by name; a changed file under an old name is not taken again.
    """

    def put(rows: DataFrame, batch: int) -> None:
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(f"{target}/batch={batch}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(kind).load(source).withColumn("source_input_file", F.col("_metadata.file_path"))
    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest(spark: SparkSession, target: str, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key over all batches, by ``order`` and then by batch; ties within a batch by all columns. One pre-aggregated maximum a key."""
    rows = spark.read.option("basePath", target).parquet(f"{target}/batch=*")
    rest = [c for c in rows.columns if c not in {*keys, *order, "batch"}]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*order, "batch", *rest)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in [*order, *rest]])
