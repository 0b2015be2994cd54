"""Graphs as DataFrames: Turtle scans, the triple store, derived overlays and Turtle sinks.

A triple table has s, s_kind, p, o, o_kind, o_dt, o_lang, src_file. `terms` gives the query view (s, p, o): each
term one string as N-Triples writes it, without escapes, so that equality and join keys are those of RDF terms.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import turtle
from .tables import cut, exists

TRIPLES = "s string, s_kind string, p string, o string, o_kind string, o_dt string, o_lang string, src_file string"
KEY = ["s", "s_kind", "p", "o", "o_kind", "o_dt", "o_lang"]


def _parsed(paths: list[str] | str, spark: SparkSession, recursive: bool) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ttl").option("recursiveFileLookup", str(recursive).lower()).load(paths)

    def run(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in TRIPLES.split(", ")] + ["error"]
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    rows = [(s[0], s[1], p, o[0], o[1], o[2], o[3], path, None) for s, p, o in turtle.parse(content.decode("utf-8"), hashlib.md5(path.encode()).hexdigest()[:12])]
                except (ValueError, RecursionError) as e:
                    rows = [(None,) * 7 + (path, str(e))]
                for i in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows[i : i + 10_000], strict=True)], names=names)

    return files.select("path", "content").mapInArrow(run, TRIPLES + ", error string")


def read_turtle(spark: SparkSession, paths: list[str] | str, recursive: bool = True) -> DataFrame:
    """Triples of all *.ttl files as one set with provenance: a triple of two files is there once a file."""
    return _parsed(paths, spark, recursive).filter("error IS NULL").drop("error").dropDuplicates([*KEY, "src_file"])


def parse_errors(spark: SparkSession, paths: list[str] | str, recursive: bool = True) -> DataFrame:
    """(src_file, error) of the files that don't parse; the others load all the same."""
    return _parsed(paths, spark, recursive).filter("error IS NOT NULL").select("src_file", "error")


def union(*tables: DataFrame) -> DataFrame:
    """One graph: a set, without provenance."""
    out = tables[0].select(*KEY)
    for t in tables[1:]:
        out = out.unionByName(t.select(*KEY))
    return out.dropDuplicates()


def terms(triples: DataFrame) -> DataFrame:
    """(s, p, o) as N-Triples strings, as a set; a column p_local, which p determines, is kept."""
    tagged = F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), "o_lang")).when(F.col("o_dt") == turtle.XSD + "string", "").otherwise(F.coalesce(F.concat(F.lit("^^<"), "o_dt", F.lit(">")), F.lit("")))
    node = lambda c, k: F.when(F.col(k) == "iri", F.concat(F.lit("<"), c, F.lit(">"))).otherwise(F.concat(F.lit("_:"), c))
    o = F.when(F.col("o_kind") == "lit", F.concat(F.lit('"'), "o", F.lit('"'), tagged)).otherwise(node("o", "o_kind"))
    folder = ["p_local"] if "p_local" in triples.columns else []
    return triples.select(node("s", "s_kind").alias("s"), F.concat(F.lit("<"), "p", F.lit(">")).alias("p"), o.alias("o"), *folder).distinct()


def from_terms(graph: DataFrame, src_file: str = "") -> DataFrame:
    """A triple table of graph(s, p, o), the inverse of terms."""
    none, o = F.lit(None).cast("string"), F.col("o")
    kind = lambda c: F.when(c.startswith("<"), "iri").when(c.startswith('"'), "lit").otherwise("bnode")
    tail = lambda pattern: F.nullif(F.regexp_extract(o, pattern, 1), F.lit(""))
    literal = o.startswith('"')
    datatype = F.when(literal & o.rlike('(?s)"$'), turtle.XSD + "string").when(literal, F.coalesce(tail(r'(?s)"\^\^<([^<>"]*)>$'), F.lit(turtle.RDF + "langString")))
    return graph.select(
        lexical(F.col("s")).alias("s"), kind(F.col("s")).alias("s_kind"), lexical(F.col("p")).alias("p"), lexical(o).alias("o"), kind(o).alias("o_kind"),
        F.coalesce(datatype, none).alias("o_dt"), F.when(literal, tail(r'(?s)"@([\w-]+)$')).alias("o_lang"), F.lit(src_file).alias("src_file"),
    )


def insert(triples: DataFrame, path: str) -> int:
    """Adds to the store the triples that it doesn't hold yet, whatever file they came from, and returns their number.

    Only the folders of the predicates that come are read. Repeating an insert adds nothing.
    """
    spark = triples.sparkSession
    new = cut(triples.dropDuplicates(KEY))
    if exists(spark, path):
        folders = [r[0] for r in new.select(_folder(F.col("p"))).distinct().collect()]  # a vocabulary's predicates
        held = spark.read.schema(TRIPLES + ", p_local string").parquet(path).filter(F.col("p_local").isin(folders)).select(*KEY).distinct()
        new = cut(new.join(held, [new[c].eqNullSafe(held[c]) for c in KEY], "left_anti"))
    write_store(new, path)
    return new.count()


def iri(value: str) -> str:
    return f"<{value}>"


def lexical(term: Column) -> Column:
    """Value of a term: the IRI, the blank node's name or the literal's text."""
    return F.when(term.startswith('"'), F.regexp_extract(term, r'(?s)^"(.*)"', 1)).when(term.startswith("<"), F.regexp_extract(term, r"(?s)^<(.*)>$", 1)).otherwise(F.substring(term, 3, 1 << 30))


def local_name(iri_: Column) -> Column:
    return F.substring_index(iri_, "#", -1)


def _folder(p: Column) -> Column:
    """Never empty, and of letters, so that no value reads back as null or as a number."""
    return F.concat(F.lit("p_"), F.regexp_replace(F.regexp_extract(p, r"([^#/]*)$", 1), r"[^\w.-]", "_"))


def with_predicate(graph: DataFrame, *iris: str) -> DataFrame:
    """Rows of graph(s, p, o) with one of these predicates (as <...>); of a store's view only their folders are read."""
    if "p_local" in graph.columns:
        graph = graph.filter(F.col("p_local").isin(*(_folder(F.lit(i[1:-1])) for i in iris)))
    return graph.filter(F.col("p").isin(*iris))


def write_store(triples: DataFrame, path: str, mode: str = "append") -> None:
    """Parquet by predicate, for partition pruning; append adds without clearing, overwrite is the safe reload."""
    # One file a predicate and task: the common predicates are spread over as many tasks as they need.
    out = triples.withColumn("p_local", _folder(F.col("p")))
    out.write.mode(mode).partitionBy("p_local").parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("p_local").dropDuplicates([*KEY, "src_file"])


def store_view(spark: SparkSession, path: str) -> DataFrame:
    """The store as (s, p, o, p_local) for queries; a pattern with a bound predicate reads that predicate's folder alone."""
    return terms(spark.read.parquet(path))


def add(triples: DataFrame, more: DataFrame) -> DataFrame:
    return triples.unionByName(more).dropDuplicates([*KEY, "src_file"])


def remove(triples: DataFrame, gone: DataFrame) -> DataFrame:
    same = [triples[c].eqNullSafe(gone[c]) for c in KEY]
    return triples.join(gone.select(*KEY).distinct(), same, "left_anti")


def replace_values(triples: DataFrame, predicate: str, fresh: DataFrame) -> DataFrame:
    """Stale values of the predicate go for the subjects in fresh(s, o IRI); the new ones land in the files of those subjects."""
    homes = triples.select("s", "s_kind", "src_file").distinct().join(fresh, "s")
    new = homes.select("s", "s_kind", F.lit(predicate).alias("p"), "o", F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_dt"), F.lit(None).cast("string").alias("o_lang"), "src_file")
    stale = (F.col("p") == predicate) & F.col("_fresh").isNotNull()
    kept = triples.join(fresh.select("s", F.lit(1).alias("_fresh")), "s", "left").filter(~F.coalesce(stale, F.lit(False))).drop("_fresh")
    return kept.unionByName(new).dropDuplicates([*KEY, "src_file"])


def write_turtle(triples: DataFrame, path: str, rows_a_block: int = 20_000, blocks_a_file: int = 50) -> None:
    """Turtle files (*.ttl) that read_turtle reads; a subject's triples stay together. Meant for derived overlays, never for curated files.

    A task holds one block of subjects at a time, and a file has a bounded number of blocks.
    """

    def run(batches):
        import pyarrow as pa

        block = lambda rows: pa.RecordBatch.from_arrays([pa.array([turtle.serialize([((r[0], r[1], None, None), r[2], (r[3], r[4], r[5], r[6])) for r in rows])])], names=["value"])
        held: list[tuple] = []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if len(held) >= rows_a_block and r[0] != held[-1][0]:
                    yield block(held)
                    held = []
                held.append(r)
        if held:
            yield block(held)

    spark = triples.sparkSession
    out = triples.select(*KEY).repartition("s").sortWithinPartitions("s").mapInArrow(run, "value string")
    out.write.mode("overwrite").option("maxRecordsPerFile", blocks_a_file).text(path)
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(jvm(path)):
        name = f.getPath().getName()
        if name.endswith(".txt") and not fs.rename(f.getPath(), jvm(path, name[:-4] + ".ttl")):
            raise OSError(f"could not name {name} in {path}")
