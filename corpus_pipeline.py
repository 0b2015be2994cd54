"""Documents to packed training sequences: toxicity, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir); all but the last return rows with the columns of `documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quillgraph.llm import mixing, packing, simhash, toxicity
from quillgraph.llm._common import cut, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled among them, doesn't call toxic.

    Null and empty texts are clean; rows with null ids are judged by their text; other columns don't matter.
    """
    return toxicity.drop_toxic(docs, toxicity.fit_toxicity(docs, read(spark, sf_dir, "labels"), "doc_id", "text"), "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id; texts are near from five-word Jaccard similarity 0.8 on, or by their fingerprints.

    Null, empty and blank texts are one group; rows with null ids all stay; of rows that repeat an id one stays.
    """
    return simhash.keep_first(docs, words=5, cell_cap=8192, share=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their rates; the total grows until no domain shrinks, so that every document stays.

    Null and empty texts, and rows with null ids, stay once.
    """
    rates = mixing.mix(docs, read(spark, sf_dir, "labels"), mixing.TARGETS, total="grow", floor=1.0)
    return mixing.copies(docs, rates, floor=1)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row, null and empty texts as the one id 0, and their places in sequences."""
    return packing.pack_documents(docs, *packing.public_files())


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("mixing", mix_sources), ("packing", pack)]

#: Trained models and iterations have no SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written as Parquet in the shared folder and read again by the next.

    A stage's folder goes once the next one is written; the last, which the result reads, stays.
    """
    docs = read(spark, sf_dir, "documents")
    cut(spark.range(1))  # sets the shared folder where the session names none
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4()}"
    last = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if last:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{last}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        last = name
    return docs
