"""Entity index: an expensive raw layer, a cheap rule layer over it, and reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.sources.tables import cut

#: Kept types and corrections.
KEEP = ["PERSON", "ORG", "GPE", "NORP", "WORK_OF_ART", "DATE", "EVENT", "PRODUCT"]
RECLASSIFY = {"Bitcoin": "PRODUCT", "COVID": "EVENT", "Holocene": "DATE", "Anthropocene": "DATE", "Hormuz": "GPE", "Jekyll": "WORK_OF_ART", "Hyde": "WORK_OF_ART", "Uncomfortable Questions": "WORK_OF_ART"}
TIMESTAMP = r"^\d{1,2}:\d{2}(:\d{2})?$"
CAPITALISED = r"\b[A-Z][a-z]{2,}(?: [A-Z][a-z]{2,})*"


def recognize_capitalised(docs: DataFrame) -> DataFrame:
    """(source_file, source_type, entity_text, entity_type): runs of capitalised ASCII words, all of type PERSON."""
    return docs.select("source_file", "source_type", F.explode(F.regexp_extract_all("text", F.lit(CAPITALISED), 0)).alias("entity_text"), F.lit("PERSON").alias("entity_type"))


def new_documents(docs: DataFrame, done: DataFrame, key: str = "source_file", limit: int | None = None, force: bool = False) -> DataFrame:
    """Documents not indexed so far, in order of type and name; a limit counts only those. force: all."""
    left = docs if force else docs.join(done.select(key).distinct(), key, "left_anti")
    return left.orderBy("source_type", key).limit(limit) if limit is not None else left


def index_raw(docs: DataFrame, recognize: Callable[[DataFrame], DataFrame] = recognize_capitalised) -> DataFrame:
    """Mentions counted by document; blank documents have none, names of one character don't count."""
    found = recognize(docs.filter(F.trim("text") != ""))
    text = F.trim(F.regexp_replace("entity_text", r"(?U)\s+", " "))
    return found.withColumn("entity_text", text).filter(F.length("entity_text") > 1).groupBy("entity_text", "entity_type", "source_file", "source_type").agg(F.count("*").alias("occurrence_count"))


def _lookup(values: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.create_map(*pairs)[key] if pairs else F.lit(None).cast("string")


def refilter(raw: DataFrame, cleanup: dict[str, tuple[str, str]] | None = None, reclassify: dict[str, str] = RECLASSIFY, keep: list[str] = KEEP) -> DataFrame:
    """The rule layer: rewritten texts (any type), then corrected PERSON types, then PERSON timestamps out; then kept types only.

    Look-ups treat a curly apostrophe as a straight one. Counts are summed after the corrections.
    """
    cleanup = cleanup or {}
    key = F.translate("entity_text", "’", "'")
    person = F.col("entity_type") == "PERSON"
    to_text, to_type = _lookup({k: v[0] for k, v in cleanup.items()}, key), _lookup({k: v[1] for k, v in cleanup.items()}, key)
    right = F.when(person, _lookup(reclassify, key))
    out = raw.withColumns({"_text": to_text, "_type": to_type, "_right": right})
    out = out.filter(~(F.col("_text").isNull() & F.col("_right").isNull() & person & F.col("entity_text").rlike(TIMESTAMP)))
    out = out.withColumns({"entity_text": F.coalesce("_text", "entity_text"), "entity_type": F.coalesce("_type", "_right", "entity_type")}).filter(F.col("entity_type").isin(*keep))
    return out.groupBy("entity_text", "entity_type", "source_file", "source_type").agg(F.sum("occurrence_count").alias("occurrence_count"))


def kept_and_total(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """One row (kept, total): mentions in the rule layer and in the raw one, counted together."""
    both = kept.select(F.col("occurrence_count").alias("kept"), F.lit(0).alias("total")).unionAll(raw.select(F.lit(0), "occurrence_count"))
    return both.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("kept", "total")))


def numbered(rows: DataFrame, *order: str, after: int = 0) -> DataFrame:
    """rows with a column id of consecutive numbers from after + 1, in the order of these columns; rows equal in all of them in any order.

    Ranges of the order go to tasks and are sorted there; the counts of the ranges before it, one a task, give each range its first
    number. No task sorts more than a range, be it of one huge value of the first column or of a million small ones.
    """
    ranges = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("_at", F.monotonically_increasing_id())
    nth, place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)), F.shiftright("_at", 33)
    total, starts = after, []
    for r in ranges.groupBy(place.alias("place")).agg(F.count("*").alias("n")).orderBy("place").collect():
        starts.append((r.place, total))
        total += r.n
    first = F.broadcast(rows.sparkSession.createDataFrame(starts, "_place long, _before long"))
    return ranges.join(first, place == F.col("_place")).withColumn("id", nth + 1 + F.col("_before")).drop("_at", "_place", "_before")


def top_entities(entities: DataFrame, n: int = 20, entity_type: str = "PERSON") -> DataFrame:
    """(entity_text, total, docs), most mentions first, ties by name."""
    totals = entities.filter(F.col("entity_type") == entity_type).groupBy("entity_text").agg(F.sum("occurrence_count").alias("total"), F.count_distinct("source_file").alias("docs"))
    return totals.orderBy(F.desc("total"), "entity_text").limit(n)


def report(top: DataFrame) -> DataFrame:
    return top.select(F.format_string("%8d  %4d  %s", "total", "docs", "entity_text").alias("line"))
