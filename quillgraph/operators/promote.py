"""Promotion of approved candidates to triples, and the review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.functions.text import slugify
from quillgraph.operators.entities import numbered
from quillgraph.plans.vocabulary import DCT, OWL, SKOS, Vocabulary
from quillgraph.sources.graph import lexical
from quillgraph.sources.turtle import RDF

#: Link predicates that may be promoted.
PREDICATES = ["echoesIdeaOf", "influencedBy", "contrastsWith", "appliesTo"]


def _iri(v: str, *parts: Column | str) -> Column:
    return F.concat(F.lit(f"<{v}"), *(F.lit(p) if isinstance(p, str) else p for p in parts), F.lit(">"))


def _text(c: Column, tail: str = "") -> Column:
    return F.concat(F.lit('"'), c, F.lit('"' + tail))


def _emit(df: DataFrame, rows: list[tuple]) -> DataFrame:
    as_col = lambda x: F.lit(x) if isinstance(x, str) else x
    made = F.array(*(F.struct(as_col(s).alias("s"), as_col(p).alias("p"), as_col(o).alias("o")) for s, p, o in rows))
    return df.select(F.explode(made).alias("t")).select("t.s", "t.p", "t.o").filter("o IS NOT NULL").distinct()


def promote_concepts(candidates: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """(s, p, o) of the approved candidate_concepts: two types, label, definition, and a description if there is a source note."""
    v = vocabulary or Vocabulary()
    c = _iri(v.instances, "Concept.", slugify(F.col("proposed_label")))
    note = F.when(F.length("source_note") > 0, _text(F.concat(F.lit("Source note: "), "source_note")))
    return _emit(
        candidates.filter("status = 'approved'"),
        [(c, f"<{RDF}type>", f"<{v.schema}Concept>"), (c, f"<{RDF}type>", f"<{OWL}NamedIndividual>"), (c, f"<{SKOS}prefLabel>", _text(F.col("proposed_label"), "@en")), (c, f"<{SKOS}definition>", _text(F.col("proposed_def"), "@en")), (c, f"<{DCT}description>", note)],
    )


def label_index(graph: DataFrame, order: tuple[str, ...] = ("Concept", "Persona", "SchoolOfThought", "Organization", "AcademicInstitution"), last: str = "Human") -> DataFrame:
    """(label, uri): of several entities with a label, by kind in the given order, others, then `last`; then the least IRI."""
    kind = F.regexp_extract("s", r"[#/](\w+)\.[^#/]*>$", 1)
    rank = F.when(kind == last, len(order) + 1).otherwise(len(order))
    for i, name in reversed(list(enumerate(order))):
        rank = F.when(kind == name, i).otherwise(rank)
    named = graph.filter(F.col("p") == f"<{SKOS}prefLabel>")
    return named.groupBy(lexical(F.col("o")).alias("label")).agg(F.min_by("s", F.struct(rank, "s")).alias("uri"))


def resolve_links(candidates: DataFrame, labels: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """Approved candidate_links with subject, object, note and evidence IRIs; unknown_subject and unknown_object tell where a fallback was made.

    skipped tells predicates that may not be promoted.
    """
    v = vocabulary or Vocabulary()
    out = candidates.filter("status = 'approved'").withColumn("skipped", ~F.col("predicate").isin(*PREDICATES))
    for side in ("subject", "object"):
        found = labels.select(F.col("label").alias(f"{side}_label"), F.col("uri").alias(f"_{side}"))
        out = out.join(found, f"{side}_label", "left")
        out = out.withColumns({f"unknown_{side}": F.col(f"_{side}").isNull(), side: F.coalesce(f"_{side}", _iri(v.instances, "Concept.", slugify(F.col(f"{side}_label"))))}).drop(f"_{side}")
    both = F.concat(slugify(F.col("subject_label")), slugify(F.col("object_label")))
    return out.withColumns({"note": _iri(v.instances, "LinkNote.", both), "evidence": _iri(v.instances, "Evidence.", both)})


def promote_links(resolved: DataFrame, confidence: str = "curated", vocabulary: Vocabulary | None = None) -> DataFrame:
    """(s, p, o), eleven triples a link: the edge, five on its note, five on its evidence. The verdict itself is never written here."""
    v = vocabulary or Vocabulary()
    note, ev = F.col("note"), F.col("evidence")
    kinds = lambda x, c: [(x, f"<{RDF}type>", f"<{v.schema}{c}>"), (x, f"<{RDF}type>", f"<{OWL}NamedIndividual>")]
    return _emit(
        resolved.filter(~F.col("skipped")),
        [
            (F.col("subject"), _iri(v.schema, F.col("predicate")), F.col("object")),
            *kinds(note, "LinkNote"),
            (note, f"<{v.schema}aboutSubject>", F.col("subject")),
            (note, f"<{v.schema}aboutObject>", F.col("object")),
            (note, f"<{v.schema}hasEvidence>", ev),
            *kinds(ev, "Evidence"),
            (ev, f"<{v.schema}confidence>", v.member(v.confidence, confidence.capitalize())),
            (ev, f"<{v.schema}evidencePolarity>", v.member(v.polarity, "Supports")),
            (ev, f"<{DCT}description>", _text(F.col("rationale"), "@en")),
        ],
    )


def mark_promoted(candidates: DataFrame, emitted: DataFrame | None = None) -> DataFrame:
    """Approved rows become promoted: only those whose id is in emitted(id), or all without it."""
    done = F.col("status") == "approved"
    if emitted is None:
        return candidates.withColumn("status", F.when(done, "promoted").otherwise(F.col("status")))
    marked = candidates.join(emitted.select("id").distinct().withColumn("_out", F.lit(True)), "id", "left")
    return marked.withColumn("status", F.when(done & F.col("_out"), "promoted").otherwise(F.col("status"))).drop("_out")


def review(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Pending rows take status and notes from decisions(id, status, reviewer_notes) with approved or rejected."""
    d = decisions.filter(F.col("status").isin("approved", "rejected")).select("id", F.col("status").alias("_s"), F.col("reviewer_notes").alias("_n"))
    out, now = candidates.join(d, "id", "left"), F.col("status") == "pending"
    return out.withColumns({"reviewer_notes": F.when(now, F.coalesce("_n", "reviewer_notes")).otherwise(F.col("reviewer_notes")), "status": F.when(now, F.coalesce("_s", "status")).otherwise(F.col("status"))}).select(*candidates.columns)


def ingest_proposals(raw: DataFrame, json_col: str = "response") -> tuple[DataFrame, DataFrame]:
    """Pending concepts and links from a column of supplied JSON; malformed documents give none."""
    schema = "concepts array<struct<label:string,definition:string,source_note:string>>, links array<struct<subject:string,predicate:string,object:string,rationale:string>>"
    parsed = raw.withColumn("_j", F.from_json(json_col, schema))
    concepts = parsed.select("episode_id", F.inline("_j.concepts")).select("episode_id", F.col("label").alias("proposed_label"), F.col("definition").alias("proposed_def"), "source_note", F.lit("pending").alias("status"))
    links = parsed.select(F.inline("_j.links")).select(F.col("subject").alias("subject_label"), "predicate", F.col("object").alias("object_label"), "rationale", F.lit("pending").alias("status"))
    return concepts.filter("proposed_label IS NOT NULL AND proposed_def IS NOT NULL"), links.dropna()


def as_candidates(proposals: DataFrame, schema: str, after: int = 0) -> DataFrame:
    """Ingested proposals as rows of a staging table (CANDIDATE_CONCEPTS or CANDIDATE_LINKS): numbered from after + 1 in the order of
    their columns, with the time of ingestion and nulls for what they lack."""
    fields = [f.split() for f in schema.split(", ")]
    rows = numbered(proposals, *sorted(proposals.columns), after=after).withColumn("created_at", F.current_timestamp())
    return rows.select(*((F.col(n) if n in rows.columns else F.lit(None)).cast(k).alias(n) for n, k in fields))
