"""CSV, XML and text sources; staging tables; rewrites in place that survive a stop at any step."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

CANDIDATE_CONCEPTS = "id int, episode_id string, proposed_label string, proposed_def string, source_note string, status string, reviewer_notes string, created_at timestamp"
CANDIDATE_LINKS = "id int, subject_label string, predicate string, object_label string, rationale string, status string, reviewer_notes string, created_at timestamp"
ENTITIES = "id int, entity_text string, entity_type string, source_file string, source_type string, occurrence_count long"
MANIFEST = "episode_url string, type string, title string, transcript_url string, local_filename string"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on one machine a temporary one where that is unset."""
    context = spark.sparkContext
    at = context._jsc.sc().getCheckpointDir()
    if not at.isEmpty():
        return at.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="shared-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder, without its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, rows: int, *keys: str, rows_a_part: int = 500_000) -> DataFrame:
    """df, which has about so many rows, dealt by keys into parts of at most rows_a_part on average: a task's share doesn't grow with the table."""
    return df.repartition(_parts(df.sparkSession, rows, rows_a_part), *keys)


def _parts(spark: SparkSession, rows: int, rows_a_part: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_a_part))


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, and a maker of its paths."""
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    return jvm(path).getFileSystem(spark._jsc.hadoopConfiguration()), jvm


def recover(spark: SparkSession, path: str) -> None:
    """Ends or undoes a rewrite that stopped midway: the table at path is then the old one or the new one, whole. Safe to repeat."""
    fs, at = _file_system(spark, path)
    there = {k: fs.exists(at(path + k)) for k in ("", ".new", ".old")}
    if not there[""] and there[".new"] and fs.exists(at(f"{path}.new/_SUCCESS")):
        _move(fs, at, f"{path}.new", path)
    elif not there[""] and there[".old"]:
        _move(fs, at, f"{path}.old", path)
    for k in (".new", ".old"):
        if there[k]:
            fs.delete(at(path + k), True)


def _move(fs, at, source: str, target: str) -> None:
    if not fs.rename(at(source), at(target)):
        raise OSError(f"could not move {source} to {target}")


def ensure_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at path, recovered where a rewrite had stopped; an empty one is made where there is none. Safe to repeat."""
    recover(spark, path)
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def rewrite_steps(df: DataFrame, path: str) -> list:
    """What rewrite does, one after the other; after each of them recover finds the old table or the new one."""
    spark = df.sparkSession
    fs, at = _file_system(spark, path)
    return [
        lambda: recover(spark, path),
        lambda: df.write.mode("overwrite").parquet(f"{path}.new"),
        lambda: fs.exists(at(path)) and _move(fs, at, path, f"{path}.old"),
        lambda: _move(fs, at, f"{path}.new", path),
        lambda: fs.delete(at(f"{path}.old"), True),
        lambda: spark.catalog.refreshByPath(path),
    ]


def rewrite(df: DataFrame, path: str) -> None:
    """Overwrites path with df, which may read from path. One writer at a time; a stop at any point loses no table."""
    for step in rewrite_steps(df, path):
        step()


BUCKETS = 64


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def append_by_key(df: DataFrame, path: str, key: str) -> None:
    """Adds rows to a table kept in folders by a hash of `key`, so that one key's rows can be replaced without the rest."""
    df.withColumn("bucket", _bucket(F.col(key))).write.mode("append").partitionBy("bucket").parquet(path)


def replace_by_key(df: DataFrame, path: str, key: str, keys: DataFrame) -> None:
    """The rows of the keys in keys(key) become those of df; only their folders are read and written. A stopped run is repeated."""
    spark = df.sparkSession
    touched = sorted(r[0] for r in keys.select(_bucket(F.col(key))).distinct().collect())  # at most BUCKETS numbers
    old = spark.read.schema(StructType([*df.schema.fields, StructField("bucket", IntegerType())])).parquet(path).filter(F.col("bucket").isin(touched))
    kept = old.join(keys.select(key).distinct(), key, "left_anti").drop("bucket")
    both = cut(kept.select(*df.columns).unionByName(df).withColumn("bucket", _bucket(F.col(key))))  # whole before a folder is replaced
    emptied = [b for b in touched if b not in {r[0] for r in both.select("bucket").distinct().collect()}]
    both.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    fs, at = _file_system(spark, path)
    for b in emptied:
        fs.delete(at(f"{path}/bucket={b}"), True)
    spark.catalog.refreshByPath(path)


def read_manifest(spark: SparkSession, path: str, schema: str = MANIFEST) -> DataFrame:
    """CSV rows by episode_url; of a URL's rows the last wins, by file name and then by place in the file; empty where there is no file.

    A file with quoted line ends is read by one task, so places within it are in order; write_manifest bounds the files. Which row of a URL
    is the last is found by partial aggregates.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    last = rows.withColumn("_order", place).groupBy("episode_url").agg(F.max_by(F.struct(*rows.columns), "_order").alias("_last"))
    return last.select("_last.*")


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for small reports."""
    kept = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.coalesce(1).write.mode("overwrite").options(**kept).csv(path)


def write_manifest(df: DataFrame, path: str, order: list[str], rows_a_part: int = 20_000, rows_a_file: int = 2_000) -> None:
    """CSV files with headers for read_manifest: df in its order by `order`, whose columns aren't written, over the files by name and within them.

    A task writes one range of about rows_a_part rows, as files of at most rows_a_file. Rows equal in `order` are in no order and in one task.
    """
    kept = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    ranges = df.repartitionByRange(_parts(df.sparkSession, df.count(), rows_a_part), *order).sortWithinPartitions(*order)
    ranges.drop(*order).write.mode("overwrite").options(**kept).option("maxRecordsPerFile", rows_a_file).csv(path)


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """(url) of each <url><loc>."""
    return spark.read.format("xml").option("rowTag", "url").schema("loc string").load(path).select(F.trim("loc").alias("url"))


def read_texts(spark: SparkSession, path: str, source_type: str, glob: str = "*.txt") -> DataFrame:
    """(source_file, source_type, text), a row a file."""
    files = spark.read.option("wholetext", True).option("pathGlobFilter", glob).text(path)
    return files.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("source_file"), F.lit(source_type).alias("source_type"), F.col("value").alias("text"))


def read_binaries(spark: SparkSession, path: str, source_type: str, extract, glob: str = "*.pdf") -> DataFrame:
    """(source_file, source_type, text), a row a file. extract: bytes -> texts of the pages; empty pages are left out.

    A file that `extract` raises ValueError for has an empty text.
    """

    def text_of(content: bytes) -> str:
        try:
            return "\n\n".join(p for p in extract(content) if p)
        except ValueError:
            return ""

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    text = F.pandas_udf(lambda contents: contents.map(text_of), "string")
    return files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), F.lit(source_type).alias("source_type"), text("content").alias("text"))


def read_through(paths: DataFrame, cache: DataFrame, extract) -> tuple[DataFrame, DataFrame]:
    """Texts of paths(path): those in cache(path, text), and `extract` (DataFrame -> DataFrame(path, text)) for the others.

    Returns all texts, and the new ones, to be added to the cache. A failed extraction is an empty text and cached.
    """
    fresh = extract(paths.join(cache, "path", "left_anti")).select("path", F.coalesce("text", F.lit("")).alias("text"))
    return cache.join(paths, "path", "left_semi").select("path", "text").unionByName(fresh), fresh
