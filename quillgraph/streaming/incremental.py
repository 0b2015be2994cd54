"""Resumable indexing of a folder that grows: each run takes only the files it has not seen."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.operators.entities import index_raw


def index_new_files(spark: SparkSession, source: str, raw_table: str, checkpoint: str, source_type: str = "transcript", recognize=None) -> None:
    """Indexes the new text files of `source` into the raw table and stops; the checkpoint remembers what was taken.

    Every batch has a folder of its own, named by checkpoint and number, which a repeated batch overwrites: a batch that failed after it had
    written is in the table once.
    """
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:8]
    files = spark.readStream.option("wholetext", True).format("text").load(source)
    docs = files.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("source_file"), F.lit(source_type).alias("source_type"), F.col("value").alias("text"))

    def write(batch: DataFrame, number: int) -> None:
        (index_raw(batch, recognize) if recognize else index_raw(batch)).write.mode("overwrite").parquet(f"{raw_table}/batch={run}-{number}")

    docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
