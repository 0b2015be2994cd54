"""What the operators share: reading tables, cutting lineage and Arrow batches as Python rows."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its literal name, even if that holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the folder that all executors share and drop the lineage.

    The folder is spark.checkpoint.dir of the session; only where that is unset in local mode a temporary folder takes its
    place. On a cluster an unset one is an error.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Has the driver drop what nothing refers to, upon which Spark deletes its shuffle files.

    Without it an iteration's rounds fill the disks until the driver happens to collect its garbage. Checkpoints go too only where the
    session sets spark.cleaner.referenceTracking.cleanCheckpoints; else they stay in the shared folder until that is cleared.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions_for(spark: SparkSession, rows: int, per_task: int = 1_000_000) -> int:
    """Shuffle partitions for so many narrow rows: the session's number, or more where tasks would grow."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def map_rows(df: DataFrame, rows: Callable[[Iterator[tuple]], Iterator[tuple]], schema: pa.Schema, ddl: str, batch: int = 2000, batch_bytes: int = 32 << 20) -> DataFrame:
    """mapInArrow over a generator of row tuples; at most `batch` rows or `batch_bytes` of binary output at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def incoming():
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

        held: list[tuple] = []
        size = 0
        for row in rows(incoming()):
            held.append(row)
            size += sum(len(v) for v in row if isinstance(v, bytes))
            if len(held) >= batch or size >= batch_bytes:
                yield _batch(held, schema)
                held, size = [], 0
        if held:
            yield _batch(held, schema)

    return df.mapInArrow(run, ddl)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
