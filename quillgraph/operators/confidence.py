"""Verdicts on links from their evidence: one aggregate over joined evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.plans.vocabulary import PROV, Vocabulary
from quillgraph.sources.graph import with_predicate
from quillgraph.sources.turtle import RDF

GOOD = ("Reputable", "Authoritative")


def derive(notes: DataFrame, evidence: DataFrame, unverified_reaches_curated: bool = False) -> DataFrame:
    """(note, verdict) for each row of notes(note).

    evidence(note, curated boolean, superseded boolean, source, tier, polarity): tier of a sourced one is its source's,
    null counts as Reputable. Only curated evidence that isn't superseded nor from an Unreliable source counts. A Contests of a good
    tier makes Disputed, over all else; independent good Supports (each source once, all unsourced together once)
    make Corroborated from two on, Curated at one; otherwise Candidate.
    """
    tier = F.coalesce("tier", F.lit("Reputable"))
    good = tier.isin(*GOOD)
    supports = F.col("polarity") == "Supports"
    counted = evidence.filter(F.coalesce("curated", F.lit(False)) & ~F.coalesce("superseded", F.lit(False)) & (tier != "Unreliable"))
    per_note = counted.groupBy("note").agg(
        F.max((F.col("polarity") == "Contests") & good).alias("disputed"),
        (F.count_distinct(F.when(supports & good, F.col("source"))) + F.coalesce(F.max((supports & good & F.col("source").isNull()).cast("int")), F.lit(0))).alias("independent"),
        F.max(supports & (tier == "Unverified")).alias("weak"),
    )
    one = (F.col("independent") == 1) | (F.col("weak") if unverified_reaches_curated else F.lit(False))
    verdict = F.when(F.col("disputed"), "Disputed").when(F.col("independent") >= 2, "Corroborated").when(one, "Curated").otherwise("Candidate")
    return notes.select("note").distinct().join(per_note, "note", "left").select("note", verdict.alias("verdict"))


def from_graph(graph: DataFrame, vocabulary: Vocabulary | None = None, **options) -> DataFrame:
    """(note, verdict) for each LinkNote of graph(s, p, o); of several values of a functional property the least counts."""
    v = vocabulary or Vocabulary()
    at = lambda p, s, o: with_predicate(graph, f"<{p}>").select(F.col("s").alias(s), F.col("o").alias(o))
    one = lambda p, s, o: at(p, s, o).groupBy(s).agg(F.min(o).alias(o))
    name = lambda c, family: F.when(F.col(c).rlike("^<" + v.schema.replace(".", r"\.") + f"(?:{'|'.join(family)})" + r"\.\w+>$"), F.regexp_extract(c, r"\.(\w+)>$", 1)).otherwise(F.coalesce(F.col(c), F.lit(None)))
    notes = with_predicate(graph, f"<{RDF}type>").filter(F.col("o") == f"<{v.schema}LinkNote>").select(F.col("s").alias("note"))
    superseded = at(PROV + "wasRevisionOf", "_by", "ev").select("ev").distinct().withColumn("superseded", F.lit(True))
    evidence = (
        at(v.schema + "hasEvidence", "note", "ev")
        .join(notes, "note", "left_semi")
        .join(one(v.schema + "confidence", "ev", "conf"), "ev", "left")
        .join(superseded, "ev", "left")
        .join(one(v.schema + "aboutSource", "ev", "source"), "ev", "left")
        .join(one(v.schema + "reliabilityTier", "source", "tier"), "source", "left")
        .join(one(v.schema + "evidencePolarity", "ev", "polarity"), "ev", "left")
        .select("note", (name("conf", v.confidence) == "Curated").alias("curated"), "superseded", "source", name("tier", v.tier).alias("tier"), name("polarity", v.polarity).alias("polarity"))
    )
    return derive(notes, evidence, **options)
