"""python -m quillgraph.cli COMMAND: load, query, confidence, check-confidence, purity, constraints, index, top, match, promote, init, discover."""

from __future__ import annotations

import argparse
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.operators import confidence, discovery, entities, integrity, linkage, promote
from quillgraph.plans.sparql import sparql
from quillgraph.plans.vocabulary import Vocabulary
from quillgraph.sources import graph, tables


def _session() -> SparkSession:
    return SparkSession.builder.appName("quillgraph").getOrCreate()


def _print(df: DataFrame) -> None:
    """Every row, a partition at a time."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def load(a) -> int:
    graph.write_store(graph.read_turtle(_session(), a.roots), a.store, "overwrite" if a.reload else "append")
    return 0


def query(a) -> int:
    text = sys.stdin.read() if a.file == "-" else "\n".join(r.value for r in _session().read.text(a.file, wholetext=True).collect())
    found = sparql(graph.store_view(_session(), a.store), text)
    _print(found if a.rows is None else found.limit(a.rows))
    return 0


def run_confidence(a) -> int:
    v, triples = Vocabulary(a.instances, a.schema), graph.read_turtle(_session(), a.roots)
    verdicts = confidence.from_graph(graph.terms(triples), v)
    _print(verdicts.orderBy("note"))
    if not a.dry_run:
        fresh = verdicts.select(graph.lexical(F.col("note")).alias("s"), F.concat(F.lit(f"{v.schema}{v.confidence[0]}."), "verdict").alias("o"))
        overlay = graph.replace_values(triples, v.schema + "calculatedConfidence", fresh).filter(F.col("p") == v.schema + "calculatedConfidence")
        graph.write_turtle(overlay, a.out)
    return 0


def purity(a) -> int:
    spark, v = _session(), Vocabulary(a.instances, a.schema)
    triples, errors = graph.read_turtle(spark, a.seed_dir, recursive=False), graph.parse_errors(spark, a.seed_dir, recursive=False)
    found = [integrity.class_purity(triples, v), errors] + ([integrity.scratch_left(triples)] if a.check_scratch_empty else [])
    bad = 0
    for df in found:
        if n := df.count():
            bad += n
            _print(df)
    print(f"{bad} violation(s)")
    return int(bad > 0)


def check_confidence(a) -> int:
    v = Vocabulary(a.instances, a.schema)
    bad = integrity.bad_confidence(graph.terms(graph.read_turtle(_session(), a.roots)), v)
    n = bad.count()
    _print(bad)
    print(f"{n} violation(s)")
    return int(n > 0)


def constraints(a) -> int:
    spark = _session()
    bad = tables.cut(integrity.constraint_violations(graph.terms(graph.read_turtle(spark, a.roots)), graph.terms(graph.read_turtle(spark, a.ontology)), expand=a.expand))
    n = bad.count()
    _print(bad)
    print(f"{n} violation(s)")
    return int(n > 0)


def index(a) -> int:
    spark = _session()
    docs = tables.read_texts(spark, a.texts, a.source_type)
    if not tables.exists(spark, a.raw):
        tables.append_by_key(spark.createDataFrame([], tables.ENTITIES).drop("id"), a.raw, "source_file")
    raw = lambda: spark.read.schema(tables.ENTITIES + ", bucket int").parquet(a.raw).drop("id", "bucket")
    if not a.refilter:
        fresh = entities.index_raw(entities.new_documents(docs, raw(), limit=a.limit, force=a.force))
        if a.force:
            tables.replace_by_key(fresh, a.raw, "source_file", docs.select("source_file"))
        else:
            tables.append_by_key(fresh, a.raw, "source_file")
    raw = raw()
    entities.numbered(entities.refilter(raw), "source_file", "entity_text", "entity_type", "source_type").write.mode("overwrite").parquet(a.entities)
    _print(entities.kept_and_total(raw, spark.read.parquet(a.entities)))
    if a.export_csv:
        tables.write_csv(spark.read.parquet(a.entities), a.export_csv)
    return 0


def top(a) -> int:
    entities.report(entities.top_entities(_session().read.parquet(a.entities), a.limit)).show(a.limit, False)
    return 0


def match(a) -> int:
    spark = _session()
    files = tables.read_texts(spark, a.texts, "summary").select(F.col("source_file").alias("filename"), "text")
    csv = lambda path: spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    manifest = csv(a.candidates)
    dead = csv(a.without_transcript) if a.without_transcript else manifest.limit(0)
    linkage_out = linkage.link(files, linkage.candidate_union(manifest, dead), a.text_number, a.url_number, a.threshold, a.byline)
    tables.write_csv(linkage_out, a.out)
    out = csv(a.out)
    _print(linkage.counts_by_method(out))
    _print(linkage.unmatched(out))
    return 0


def run_promote(a) -> int:
    spark, v = _session(), Vocabulary(a.instances, a.schema)
    concepts, links = tables.ensure_table(spark, a.concepts, tables.CANDIDATE_CONCEPTS), tables.ensure_table(spark, a.links, tables.CANDIDATE_LINKS)
    resolved = promote.resolve_links(links, promote.label_index(graph.terms(graph.read_turtle(spark, a.roots))), v)
    _print(resolved.filter("skipped OR unknown_subject OR unknown_object"))
    new = promote.promote_concepts(concepts, v).unionAll(promote.promote_links(resolved, a.confidence, v)).distinct()
    if a.dry_run:
        _print(new)
        return 0
    triples = graph.from_terms(new, "promoted.ttl")
    if a.store:
        print(f"{graph.insert(triples, a.store)} triple(s) new in the store")
    if a.turtle:
        graph.write_turtle(triples, f"{a.turtle}/{uuid.uuid4()}")
    if a.out:
        held = spark.read.parquet(a.out) if tables.exists(spark, a.out) else new.limit(0)
        tables.cut(new.join(held, ["s", "p", "o"], "left_anti")).write.mode("append").parquet(a.out)
    emitted = links.join(resolved.filter("NOT skipped").select("id"), "id", "left_semi")
    tables.rewrite(promote.mark_promoted(links, emitted), a.links)
    tables.rewrite(promote.mark_promoted(concepts), a.concepts)
    return 0


def init(a) -> int:
    tables.ensure_table(_session(), a.concepts, tables.CANDIDATE_CONCEPTS)
    tables.ensure_table(_session(), a.links, tables.CANDIDATE_LINKS)
    return 0


def run_discover(a) -> int:
    spark = _session()
    pages = spark.read.parquet(a.pages)
    discovery.refuse_blocked(pages, a.blocked or [])
    # What earlier runs wrote to --out counts too, and is kept and extended.
    manifest, dead = (tables.cut(tables.read_manifest(spark, p or f"{a.out}/{name}", schema)) for p, name, schema in ((a.manifest, "manifest", tables.MANIFEST), (a.dead, "without_transcript", "episode_url string, title string")))
    skipped = pages.select(F.col("url").alias("episode_url")).distinct().join(dead, "episode_url", "left_semi").count()
    good, gone = discovery.transcripts(discovery.to_fetch(pages, manifest, dead, force=a.force))
    good, gone = tables.cut(good), tables.cut(gone)
    dead = dead.join(good.select("episode_url"), "episode_url", "left_anti")
    tables.write_csv(discovery.upsert(manifest, good), f"{a.out}/manifest")
    tables.write_csv(discovery.upsert(dead, gone), f"{a.out}/without_transcript")
    print(f"{good.count()} new, {gone.count()} without a transcript, {0 if a.force else skipped} skipped as known to have none")
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    sub = p.add_subparsers(required=True)

    def command(name, f, *arguments):
        c = sub.add_parser(name)
        c.set_defaults(run=f)
        for flags, options in arguments:
            c.add_argument(*flags, **options)

    spaces = [(("--instances",), {"default": Vocabulary.instances}), (("--schema",), {"default": Vocabulary.schema})]
    yes = {"action": "store_true"}
    roots = (("roots",), {"nargs": "+"})
    command("load", load, roots, (("--store",), {"required": True}), (("--reload",), yes))
    command("query", query, (("file",), {}), (("--store",), {"required": True}), (("--rows",), {"type": int}))
    command("confidence", run_confidence, roots, *spaces, (("--dry-run",), yes), (("--out",), {"default": "derived"}))
    command("purity", purity, *spaces, (("--seed-dir",), {"default": "data/seed"}), (("--check-scratch-empty",), yes))
    command("check-confidence", check_confidence, roots, *spaces)
    command("constraints", constraints, roots, (("--ontology",), {"nargs": "+", "required": True}), (("--expand",), yes))
    command("index", index, (("texts",), {}), (("--raw",), {"required": True}), (("--entities",), {"required": True}), (("--source-type",), {"default": "transcript"}), (("--limit",), {"type": int}), (("--export-csv",), {}), (("--force",), yes), (("--refilter",), yes))
    command("top", top, (("entities",), {}), (("--limit",), {"type": int, "default": 40}))
    command("match", match, (("texts",), {}), (("candidates",), {}), (("--out",), {"required": True}), (("--threshold",), {"type": float, "default": 0.5}), (("--text-number",), {"default": r"#(\d+)"}), (("--url-number",), {"default": r"/(\d+)-"}), (("--byline",), {}), (("--without-transcript",), {}))
    command("promote", run_promote, roots, *spaces, (("--concepts",), {"required": True}), (("--links",), {"required": True}), (("--out",), {}), (("--store",), {}), (("--turtle",), {}), (("--confidence",), {"choices": ["curated", "candidate"], "default": "curated"}), (("--dry-run",), yes))
    command("init", init, (("--concepts",), {"required": True}), (("--links",), {"required": True}))
    command("discover", run_discover, (("pages",), {}), (("--out",), {"required": True}), (("--manifest",), {}), (("--dead",), {}), (("--blocked",), {"nargs": "*"}), (("--force",), yes))
    a = p.parse_args(argv)
    return a.run(a)


if __name__ == "__main__":
    sys.exit(main())
