"""Registered queries for sources, sinks, edits, staging and the named questions: written to the shared folder and read back, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillgraph.functions.tables import register
from quillgraph.operators import discovery, entities, integrity, promote
from quillgraph.plans.algebra import sort_key
from quillgraph.plans.named_queries import TEXTS, ask_named, episode_types
from quillgraph.plans.sparql import sparql
from quillgraph.plans.vocabulary import DCT, OWL, RDFS, SKOS
from quillgraph.queries import _FIRST, KG, ORACLE_SQL, SC, _concepts, _corpus, promote_concepts, promote_links, query, top_entities
from quillgraph.rdf_view import LABEL, TYPE, Branch, V, View, constant, ent, entity, literal, made, pred, table, text, typed
from quillgraph.sources import graph, tables
from quillgraph.sources.turtle import RDF, XSD

def _folder(spark, name: str) -> str:
    """One folder for each query and application, so that repeats don't pile up."""
    return f"{tables.shared_folder(spark)}/{spark.sparkContext.applicationId}-{name}"

# ---- graphs written and read ----

def _rows(df: DataFrame, kind: str, key, predicate: str, o, o_kind: str = "lit", lang: str | None = None, file: str = "a.ttl") -> DataFrame:
    """A triple for each row of df, as the triple tables have them."""
    none = F.lit(None).cast("string")
    s = F.concat(F.lit(f"{KG}{kind}."), key.cast("string"))
    return df.select(s.alias("s"), F.lit("iri").alias("s_kind"), F.lit(predicate).alias("p"), o.alias("o"), F.lit(o_kind).alias("o_kind"), none.alias("o_dt"), (F.lit(lang) if lang else none).alias("o_lang"), F.lit(f"/{file}").alias("src_file"))

def _turns(spark, d):
    c = table(spark, d, "conversations").filter("text IS NOT NULL")
    return _rows(c, "Turn", F.concat_ws(".", "conv_id", "turn"), f"{SC}says", F.col("text"), lang="en", file="turns.ttl")

def _nations(spark, d):
    n, key = table(spark, d, "nation"), F.col("n_nationkey")
    region = F.concat(F.lit(f"{KG}Region."), F.col("n_regionkey").cast("string"))
    return _rows(n, "Nation", key, f"{SKOS}prefLabel", F.col("n_name"), file="nations.ttl").unionAll(_rows(n, "Nation", key, f"{SC}inRegion", region, "iri", file="nations.ttl"))

_TURNS = f"SELECT DISTINCT '<{KG}Turn.' || conv_id || '.' || turn || '>' AS s, '<{SC}says>' AS p, '\"' || text || '\"@en' AS o FROM conversations WHERE text IS NOT NULL"
_LABELS = f"SELECT '<{KG}Nation.' || n_nationkey || '>' AS s, '<{SKOS}prefLabel>' AS p, '\"' || n_name || '\"' AS o FROM nation"
_REGIONS = f"SELECT '<{KG}Nation.' || n_nationkey || '>' AS s, '<{SC}inRegion>' AS p, '<{KG}Region.' || n_regionkey || '>' AS o FROM nation"

@query(f"{_TURNS} UNION ALL {_LABELS} UNION ALL {_REGIONS}")
def turtle_round_trip(spark, d):
    """Whole texts, with whatever they hold of quotes and line ends, through Turtle files."""
    path = _folder(spark, "turtle")
    graph.write_turtle(graph.union(_turns(spark, d), _nations(spark, d)), path)
    return graph.terms(graph.read_turtle(spark, path))

@query(f"{_TURNS} UNION ALL {_LABELS} UNION ALL {_REGIONS}")
def store_append(spark, d):
    """Loads add to the store; what is loaded twice is there once."""
    path = _folder(spark, "append")
    graph.write_store(_nations(spark, d), path, "overwrite")
    for more in (_turns, _nations):
        graph.write_store(more(spark, d), path)
    return graph.terms(graph.read_store(spark, path))

@query(f"{_LABELS} UNION ALL {_REGIONS}")
def store_reload(spark, d):
    path = _folder(spark, "reload")
    graph.write_store(_turns(spark, d), path, "overwrite")
    graph.write_store(_nations(spark, d), path, "overwrite")
    return graph.store_view(spark, path).select("s", "p", "o")

@query(f"SELECT '<{KG}Nation.' || n_nationkey || '>' AS s, '<{SKOS}prefLabel>' AS p, '\"' || n_name || '\"' AS o FROM nation WHERE n_regionkey <> 1 UNION ALL {_TURNS}")
def graph_add_remove(spark, d):
    """The turns come in; every region and the labels of region 1 go."""
    n = table(spark, d, "nation").filter("n_regionkey = 1")
    out = graph.remove(graph.add(_nations(spark, d), _turns(spark, d)), _rows(n, "Nation", F.col("n_nationkey"), f"{SKOS}prefLabel", F.col("n_name")))
    return graph.terms(graph.remove(out, _nations(spark, d).filter(F.col("p") == f"{SC}inRegion")))

@query(f"SELECT DISTINCT '<{KG}Turn.' || conv_id || '.' || turn || '>' AS s FROM conversations WHERE text IS NOT NULL UNION ALL SELECT '<{KG}Nation.' || n_nationkey || '>' FROM nation")
def distinct_subjects(spark, d):
    return graph.terms(graph.union(_turns(spark, d), _nations(spark, d))).select("s").distinct()

@query("SELECT '/turns.ttl' AS src_file, count(*)::BIGINT AS triples FROM (SELECT DISTINCT conv_id, turn, text FROM conversations WHERE text IS NOT NULL) HAVING triples > 60")
def scratch_left(spark, d):
    return integrity.scratch_left(graph.add(_turns(spark, d), _nations(spark, d)), "turns.ttl", 60)

@query("SELECT 1::BIGINT AS broken, count(*)::BIGINT AS loaded FROM region")
def parse_errors(spark, d):
    """A folder of regions as Turtle with one broken file among them: it is reported, the others load."""
    path, r = _folder(spark, "broken"), table(spark, d, "region")
    graph.write_turtle(_rows(r, "Region", F.col("r_regionkey"), f"{SKOS}prefLabel", F.col("r_name")), path)
    spark.sql("SELECT '<a> <b> [ .' AS value").coalesce(1).write.mode("overwrite").text(f"{path}-bad")
    broken = spark.read.format("binaryFile").load(f"{path}-bad").first().path
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    jvm(path).getFileSystem(spark._jsc.hadoopConfiguration()).rename(jvm(broken), jvm(path, "broken.ttl"))
    bad = graph.parse_errors(spark, path).agg(F.count("*").alias("broken"))
    return bad.crossJoin(F.broadcast(graph.read_turtle(spark, path).agg(F.count("*").alias("loaded"))))

@query(f"SELECT '<{KG}Supplier.' || s_suppkey || '>' AS s, '<{SC}verdict>' AS p, '<{SC}Level.' || CASE WHEN s_acctbal > 3000 THEN 'High' ELSE 'Old' END || '>' AS o, '/' || s_nationkey || '.ttl' AS src_file FROM supplier")
def verdict_write_back(spark, d):
    """Stale verdicts of rich suppliers go, the new ones land in the files that hold those suppliers."""
    s, level = table(spark, d, "supplier"), lambda x: F.lit(f"{SC}Level.{x}")
    old = _rows(s, "Supplier", F.col("s_suppkey"), f"{SC}verdict", level("Old"), "iri").drop("src_file")
    homes = s.select(F.concat(F.lit(f"{KG}Supplier."), F.col("s_suppkey").cast("string")).alias("s"), F.concat(F.lit("/"), "s_nationkey", F.lit(".ttl")).alias("src_file"), "s_acctbal")
    fresh = homes.filter("s_acctbal > 3000").select("s", level("High").alias("o"))
    out = graph.replace_values(old.join(homes.drop("s_acctbal"), "s").select(*graph.KEY, "src_file"), f"{SC}verdict", fresh)
    iri = lambda c: F.concat(F.lit("<"), c, F.lit(">")).alias(c)
    return out.select(iri("s"), iri("p"), iri("o"), "src_file")

@query(
    f"""SELECT '<{KG}Supplier.' || s_suppkey || '>' AS note, 'no valid evidence' AS problem FROM supplier WHERE s_nationkey < 8 UNION ALL
    SELECT '<{KG}Supplier.' || s_suppkey || '>', 'no calculated confidence' FROM supplier WHERE s_acctbal <= 0 UNION ALL
    SELECT '<{KG}Supplier.' || s_suppkey || '>', 'confidence out of range' FROM supplier WHERE s_acctbal > 5000"""
)
def bad_confidence(spark, d):
    """Suppliers stand for notes, their nations for evidence, of which the first eight aren't typed."""
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    level = F.when(F.col("s_acctbal") > 5000, f"<{SC}Sure>").otherwise(V.member(V.confidence, "Curated"))
    note, ev = ent("Supplier", "s_suppkey"), ent("Nation", "s_nationkey")
    return integrity.bad_confidence(
        _graph([
            (s, note, TYPE, F.lit(pred("LinkNote"))),
            (s, note, pred("hasEvidence"), ev),
            (s.filter("s_acctbal > 0"), note, pred("calculatedConfidence"), level),
            (n.filter("n_nationkey >= 8"), ent("Nation", "n_nationkey"), TYPE, F.lit(pred("Evidence"))),
        ])
    )

def _graph(branches: list[tuple]) -> DataFrame:
    """(s, p, o) of (rows, s, p, o) branches; each has a constant predicate, by which Catalyst drops branches."""
    return reduce(DataFrame.unionAll, [df.select(s.alias("s"), F.lit(p).alias("p"), o.alias("o")) for df, s, p, o in branches])

# ---- tables and files written and read ----

def _staged(spark, d):
    rows = _concepts(spark, d).withColumns({"episode_id": F.lit(""), "reviewer_notes": F.lit(""), "created_at": F.current_timestamp()})
    return rows.selectExpr(*(c.split()[0] for c in tables.CANDIDATE_CONCEPTS.split(", ")))

@query("SELECT 2 * k AS stopped_after, p_partkey::INTEGER AS id, CASE WHEN k > 0 AND p_size > 20 THEN 'promoted' WHEN p_size > 20 THEN 'approved' ELSE 'pending' END AS status FROM part, range(3) r(k)")
def staging_recovered(spark, d):
    """A rewrite that stops before its table is written, between its two moves, and before the old table goes: the old or the new one is found, whole."""
    found = []
    for stop in (0, 2, 4):
        path = f"{_folder(spark, 'stopped')}-{stop}"
        tables.rewrite(_staged(spark, d), path)
        steps = tables.rewrite_steps(promote.mark_promoted(tables.ensure_table(spark, path, tables.CANDIDATE_CONCEPTS)), path)
        for step in steps[: stop + (stop > 0)]:
            step()
        found.append(tables.ensure_table(spark, path, tables.CANDIDATE_CONCEPTS).select(F.lit(stop).cast("long").alias("stopped_after"), "id", "status"))
    return reduce(DataFrame.unionAll, found)

@query("SELECT doc_id::VARCHAR AS source_file, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'again' ELSE 'first' END AS entity_text, 1::BIGINT AS n FROM documents")
def forced_reindex(spark, d):
    """Labelled documents are indexed once more: their rows are replaced, the others' folders are left alone."""
    path = _folder(spark, "reindex")
    names = _corpus(spark, d).select("source_file", F.lit("first").alias("entity_text"))
    names.limit(0).write.mode("overwrite").parquet(path)
    tables.append_by_key(names, path, "source_file")
    again = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("source_file")).distinct().join(names.select("source_file"), "source_file", "left_semi")
    tables.replace_by_key(again.withColumn("entity_text", F.lit("again")), path, "source_file", again)
    return spark.read.parquet(path).groupBy("source_file", "entity_text").agg(F.count("*").alias("n"))

@query(f"SELECT DISTINCT s, p, o FROM ({ORACLE_SQL['promote_concepts']} UNION ALL {ORACLE_SQL['promote_links'].replace('WITH k AS', 'SELECT * FROM (WITH k AS')}))")
def promote_twice(spark, d):
    """Concepts and links promoted into a store that already holds the nations, twice: the second run adds nothing, queries see all."""
    path = _folder(spark, "promoted")
    graph.write_store(_nations(spark, d).limit(0), path, "overwrite")
    triples = graph.from_terms(promote_concepts(spark, d).unionByName(promote_links(spark, d)), "promoted.ttl")
    graph.insert(triples, path)
    if graph.insert(triples, path):
        raise AssertionError("the second insert added triples")
    return graph.store_view(spark, path).select("s", "p", "o")

@query("SELECT p_partkey::INTEGER AS id, p_name AS proposed_label, CASE WHEN p_size > 20 THEN 'promoted' ELSE 'pending' END AS status FROM part")
def staging_rewrite(spark, d):
    """Made if absent, cleared, filled, and rewritten in place from itself."""
    path = _folder(spark, "staging")
    empty = tables.ensure_table(spark, path, tables.CANDIDATE_CONCEPTS).limit(0)
    tables.rewrite(_staged(spark, d).select(*empty.columns), path)
    tables.rewrite(promote.mark_promoted(tables.ensure_table(spark, path, tables.CANDIDATE_CONCEPTS)), path)
    return tables.ensure_table(spark, path, tables.CANDIDATE_CONCEPTS).select("id", "proposed_label", "status")

@query("SELECT url AS episode_url, 'page' AS type, replace(html, chr(13), '') AS title FROM (SELECT url, arg_max(html, page_id) AS html FROM pages WHERE url <> '' GROUP BY url)")
def manifest_csv(spark, d):
    """A manifest with whole pages, line ends and quotes and all, as its titles through CSV; of rows that repeat a URL the last counts."""
    path = _folder(spark, "manifest")
    title = F.replace("html", F.lit("\r"), F.lit(""))
    rows = table(spark, d, "pages").filter("url <> ''").select("page_id", F.col("url").alias("episode_url"), F.lit("page").alias("type"), title.alias("title"), F.lit("t").alias("transcript_url"), F.lit("f").alias("local_filename"))
    both = rows.withColumn("fresh", F.lit(1)).unionByName(rows.withColumns({"type": F.lit("stale"), "fresh": F.lit(0)}))
    tables.write_manifest(both, path, ["fresh", "page_id"])
    return tables.read_manifest(spark, path).select("episode_url", "type", "title")

@query("SELECT trim(url) AS url FROM pages WHERE trim(url) <> ''")
def sitemap_xml(spark, d):
    path = _folder(spark, "sitemap")
    urls = table(spark, d, "pages").filter("trim(url) <> ''").select(F.col("url").alias("loc"))
    urls.write.format("xml").mode("overwrite").option("rootTag", "urlset").option("rowTag", "url").save(path)
    return tables.read_sitemap(spark, path)

@query("SELECT doc_id::VARCHAR AS path, length(coalesce(text, ''))::INTEGER AS n FROM documents")
def read_through(spark, d):
    """Labelled documents are in the cache, the others are read."""
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), "text")
    known = docs.join(table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("path")).distinct(), "path", "left_semi")
    every, _ = tables.read_through(docs.select("path"), known.select("path", F.coalesce("text", F.lit("")).alias("text")), lambda missing: docs.join(missing, "path", "left_semi"))
    return every.select("path", F.length("text").alias("n"))

@query("SELECT doc_id::VARCHAR AS source_file, source AS source_type FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY source, doc_id::VARCHAR LIMIT 10")
def incremental_limit(spark, d):
    """The limit on new documents is the feature."""
    done = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("source_file"))
    return entities.new_documents(_corpus(spark, d), done, limit=10).select("source_file", "source_type")

@query(f"SELECT printf('%8d  %4d  %s', total, docs, entity_text) AS line FROM ({ORACLE_SQL['top_entities']})")
def top_report(spark, d):
    return entities.report(top_entities(spark, d))

@query(f"SELECT DISTINCT url AS episode_url FROM pages WHERE nullif({_FIRST}, '') IS NULL")
def dead_pages(spark, d):
    """Pages without a link whose label has "th"."""
    pages = table(spark, d, "pages").select("url", F.lit("page").alias("kind"), "html")
    return discovery.transcripts(pages, "th")[1].select("episode_url")

@query("SELECT p_partkey::INTEGER AS id, CASE WHEN p_size > 20 OR p_size > 10 AND p_retailprice > 1200 THEN 'approved' WHEN p_size > 10 THEN 'rejected' ELSE 'pending' END AS status, CASE WHEN p_size > 10 AND p_size <= 20 THEN p_type ELSE '' END AS reviewer_notes FROM part")
def review_queue(spark, d):
    """Parts above size 10 are decided by price; those already approved stay as they are."""
    rows = _concepts(spark, d).withColumn("reviewer_notes", F.lit(""))
    verdict = F.when(F.col("p_retailprice") > 1200, "approved").otherwise("rejected")
    decided = table(spark, d, "part").filter("p_size > 10").select(F.col("p_partkey").cast("int").alias("id"), verdict.alias("status"), F.col("p_type").alias("reviewer_notes"))
    return promote.review(rows, decided).select("id", "status", "reviewer_notes")

@query("SELECT 'part' || p_partkey AS episode_id, p_name AS proposed_label, p_type AS proposed_def, p_brand AS source_note, 'pending' AS status FROM part WHERE p_size > 5")
def proposals(spark, d):
    """Proposals as JSON texts, a part each; those of small parts are cut off and give nothing."""
    concept = F.struct(F.col("p_name").alias("label"), F.col("p_type").alias("definition"), F.col("p_brand").alias("source_note"))
    whole = F.to_json(F.struct(F.array(concept).alias("concepts")))
    raw = table(spark, d, "part").select(F.concat(F.lit("part"), "p_partkey").alias("episode_id"), F.when(F.col("p_size") > 5, whole).otherwise(F.substring(whole, 1, 20)).alias("response"))
    return promote.ingest_proposals(raw)[0]

# ---- the named questions, on a curated graph made of the tables ----

_LEVELS = {"Candidate": "p_size <= 10", "Curated": "p_size > 10 AND p_size <= 20", "Corroborated": "p_size > 20 AND p_size <= 30", "Disputed": "p_size > 30"}

def curated_view(spark, d) -> View:
    """Parts as concepts, suppliers as personas, customers as humans, nations as organizations, orders as episodes.

    A part of size 1 to 40 is influenced by the supplier of that key, with a note and its evidence. Topics are the sizes, each
    below its half; a concept builds on the one of a third of its key.
    """
    part, supp, cust, nation, orders, items = (table(spark, d, t) for t in "part supplier customer nation orders lineitem".split())
    linked, size = part.filter("p_size <= 40"), part.select("p_size").distinct().filter("p_size > 1")
    concept, persona, human, org = entity("Concept", "p_partkey"), entity("Persona", "s_suppkey"), entity("Human", "c_custkey"), entity("Organization", "n_nationkey")
    note, ev, rel, walk, episode = entity("LinkNote", "p_partkey"), entity("Evidence", "p_partkey"), entity("Relationship", "s_suppkey"), entity("CrosswalkNote", "s_suppkey"), entity("Episode", "o_orderkey")
    of_supplier, of_item, series = entity("Relationship", "l_suppkey"), entity("Episode", "l_orderkey"), entity("Series", "o_custkey")
    page = lambda key: made(F.concat(F.lit("<http://pages.example/"), F.col(key).cast("string"), F.lit(">")), "<http://pages.example/")
    meeting = made(ent("Meeting", F.concat_ws(".", "l_orderkey", "l_linenumber")), f"<{KG}Meeting.")
    kind_of = lambda c: made(ent("EpisodeType", F.substring(c, 1, 1)), f"<{KG}EpisodeType.")
    schema, label, member = lambda n: constant(pred(n)), LABEL, lambda n: constant(V.member(V.confidence, n))
    is_a = lambda df, s, kind: (df, s, TYPE, schema(kind))
    one = spark.range(1)
    rich, third, shipped = supp.filter("s_acctbal > 0"), supp.filter("s_nationkey = 3"), items.select("l_suppkey", "l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag").distinct()
    talks = items.filter("l_returnflag = 'R' AND l_linenumber = 1 AND l_quantity < 10").select("l_orderkey", "l_partkey").distinct()
    guests = items.filter("l_returnflag = 'A'").select("l_orderkey", "l_suppkey").distinct()
    day = lambda c: typed(c.cast("date"), "date")
    out = F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 7).cast("int") - 3)
    rows = [
        is_a(part, concept, "Concept"), (part, concept, label, literal("p_name")), (part, concept, f"<{SKOS}definition>", literal("p_type")),
        (part, concept, f"<{DCT}subject>", entity("Subject", "p_size")), (size, entity("Subject", "p_size"), f"<{SKOS}broader>", made(ent("Subject", F.expr("p_size div 2")), f"<{KG}Subject.")),
        (part.filter("p_partkey >= 3"), concept, pred("buildsOn"), made(ent("Concept", F.expr("p_partkey div 3")), f"<{KG}Concept.")),
        (part, concept, pred("convergesWith"), entity("Concept", "p_size")),
        (linked, concept, pred("influencedBy"), entity("Persona", "p_size")), is_a(linked, note, "LinkNote"), (linked, note, pred("aboutSubject"), concept),
        (linked, note, pred("aboutObject"), entity("Persona", "p_size")), *((linked.filter(where), note, pred("calculatedConfidence"), member(n)) for n, where in _LEVELS.items()), (linked, note, pred("hasEvidence"), ev),
        is_a(linked, ev, "Evidence"), (linked, ev, f"<{DCT}description>", literal("p_brand")), (linked, ev, pred("confidence"), member("Curated")),
        *((one, member(n), label, constant(f'"{n}"')) for n in _LEVELS),
        is_a(supp, persona, "Persona"), (supp, persona, label, literal("s_name")), (supp, persona, pred("actsThrough"), entity("Human", "s_suppkey")),
        is_a(rich, walk, "CrosswalkNote"), (rich, walk, pred("aboutEntity"), persona), (rich, walk, pred("aboutExternalURI"), page("s_suppkey")),
        (supp.filter("s_nationkey % 2 = 0"), persona, f"<{OWL}sameAs>", page("s_suppkey")), (cust.filter("c_nationkey % 3 = 0"), human, f"<{OWL}sameAs>", page("c_custkey")),
        is_a(supp, rel, "Relationship"), (supp, rel, pred("hasSubject"), persona), (third, rel, pred("hasSubject"), entity("Human", "s_suppkey")), (supp, rel, pred("hasObject"), entity("Organization", "s_nationkey")),
        (shipped.select("l_suppkey", "l_orderkey", "l_linenumber").distinct(), of_supplier, pred("hasInteraction"), meeting),
        (shipped.select("l_orderkey", "l_linenumber", "l_linestatus").distinct(), meeting, pred("subjectRole"), made(ent("Role", "l_linestatus"), f"<{KG}Role.")),
        (shipped.select("l_suppkey", "l_returnflag").distinct(), of_supplier, pred("hasRelationshipType"), made(ent("Kind", "l_returnflag"), f"<{KG}Kind.")),
        is_a(cust, human, "Human"), (cust, human, label, literal("c_name")), (cust, human, pred("memberOf"), entity("Organization", "c_nationkey")),
        (cust.filter("c_acctbal < 0"), human, pred("memberOfStartDate"), literal("c_mktsegment")), is_a(nation, org, "Organization"), (nation, org, label, literal("n_name")),
        is_a(orders, episode, "Episode"), (talks, of_item, pred("discusses"), entity("Concept", "l_partkey")), (guests, of_item, pred("hasGuest"), entity("Persona", "l_suppkey")),
        (orders, episode, pred("isPartOf"), series), (orders.filter("o_orderstatus = 'F'"), series, pred("hasPart"), episode), (orders, episode, pred("seriesPosition"), made(typed(F.col("o_orderkey"), "integer"), '"')),
        (orders, episode, f"<{DCT}created>", made(day(F.col("o_orderdate")), '"')), (orders, episode, f"<{DCT}issued>", made(day(out), '"')),
        *(x for df in [orders.select("o_orderpriority").distinct()] for x in (is_a(df, kind_of("o_orderpriority"), "EpisodeType"), (df, kind_of("o_orderpriority"), f"<{SKOS}altLabel>", literal("o_orderpriority")))),
    ]
    return View([Branch(df, s, p, o) for df, s, p, o in rows])

_CASE = "CASE WHEN p_size <= 10 THEN 'Candidate' WHEN p_size <= 20 THEN 'Curated' WHEN p_size <= 30 THEN 'Corroborated' ELSE 'Disputed' END"
_KNOWN = f"(SELECT *, {_CASE} AS level FROM part JOIN supplier ON s_suppkey = p_size WHERE p_size <= 40)"
_TALKED = "(SELECT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1 AND l_quantity < 10)"
_MEETINGS = "(SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber, l_linestatus, l_returnflag FROM lineitem)"
_UP = "WITH RECURSIVE e AS (SELECT DISTINCT p_size AS a, p_size // 2 AS b FROM part WHERE p_size > 1), up AS (SELECT a, b FROM e UNION SELECT up.a, e.b FROM up JOIN e ON up.b = e.a)"
_ISSUED = "(SELECT *, o_orderdate::DATE + (o_custkey % 7 - 3)::INTEGER AS issued FROM orders)"

#: Name of the question -> (values of its places, its SQL).
_ASKED = {
    "concepts": ({}, f"SELECT '{KG}Concept.' || p_partkey AS idea, p_name AS name, p_type AS meaning FROM part"),
    "explain_links": ({"subject": "?subject", "person": "Persona"}, f"SELECT s_name AS who, '{SC}influencedBy' AS how, p_brand AS why, 'Curated' AS strength, level AS verdict FROM {_KNOWN}"),
    "trusted_links": ({}, f"SELECT p_name AS \"from\", '{SC}influencedBy' AS how, s_name AS \"to\", level AS verdict FROM {_KNOWN} WHERE level IN ('Curated', 'Corroborated')"),
    "links_at": ({"level": "Candidate"}, f"SELECT p_name AS \"from\", s_name AS \"to\" FROM {_KNOWN} WHERE level = 'Candidate'"),
    "links_disputed": ({"level": "Disputed"}, f"SELECT p_name AS \"from\", s_name AS \"to\" FROM {_KNOWN} WHERE level = 'Disputed'"),
    "unlinked_concepts": ({}, "SELECT p_name AS name FROM part WHERE p_size > 40"),
    "appearances": ({}, f"SELECT n_name AS partner, count(*)::BIGINT AS times FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber FROM {_MEETINGS}) JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1"),
    "undiscussed_concepts": ({}, f"SELECT p_name AS name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM {_TALKED} JOIN orders ON l_orderkey = o_orderkey)"),
    "undated_members": ({}, "SELECT c_name AS person, n_name AS body FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0"),
    "relations_not_from": ({"subject": "kg:Persona.1"}, "SELECT (SELECT count(*) FROM supplier WHERE s_suppkey <> 1) + (SELECT count(*) FROM supplier WHERE s_nationkey = 3) AS ties"),
    "episodes_without_concept": ({}, f"SELECT '{KG}Episode.' || o_orderkey AS show FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM {_TALKED})"),
    "personas_without_crosswalk": ({}, f"SELECT '{KG}Persona.' || s_suppkey AS figure FROM supplier WHERE s_acctbal <= 0"),
    "members_without_relation": ({}, f"SELECT '{KG}Human.' || c_custkey AS member, '{KG}Organization.' || c_nationkey AS club FROM customer JOIN supplier ON c_custkey = s_suppkey WHERE c_nationkey <> s_nationkey"),
    "human_leaks": ({}, f"SELECT '{KG}Relationship.' || s_suppkey AS tie, '{KG}Human.' || s_suppkey AS human FROM supplier JOIN customer ON s_suppkey = c_custkey WHERE s_nationkey = 3"),
    "multi_guest_episodes": ({}, f"SELECT '{KG}Episode.' || l_orderkey AS show, count(DISTINCT l_suppkey)::BIGINT AS guests FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_orderkey HAVING guests > 1"),
    "series_members": ({}, f"SELECT '{KG}Series.' || o_custkey AS series, '{KG}Episode.' || o_orderkey AS show, o_orderkey::VARCHAR AS place FROM orders"),
    "subject_rollup": ({}, f"SELECT '{KG}Subject.' || (p_size // 2) AS top, count(*)::BIGINT AS ideas FROM part WHERE p_size > 1 GROUP BY 1"),
    "subject_tree": ({}, f"{_UP} SELECT '{KG}Subject.' || b AS top, count(*)::BIGINT AS ideas FROM part JOIN (SELECT a, b FROM up UNION SELECT p_size, p_size FROM part) ON a = p_size GROUP BY 1"),
    "role_reversals": ({}, f"SELECT '{KG}Relationship.' || m.l_suppkey AS tie, count(DISTINCT r.l_linestatus)::BIGINT AS parts FROM {_MEETINGS} m JOIN {_MEETINGS} r USING (l_orderkey, l_linenumber) GROUP BY m.l_suppkey HAVING parts > 1"),
    "relation_types": ({}, f"SELECT n_name AS partner, string_agg(DISTINCT '{KG}Kind.' || l_returnflag, ',' ORDER BY '{KG}Kind.' || l_returnflag) AS kinds FROM {_MEETINGS} JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1"),
    "episode_type_labels": ({}, f"SELECT DISTINCT '{KG}EpisodeType.' || o_orderpriority[1] AS kind, o_orderpriority AS word FROM orders"),
    "one_way_parts": ({}, f"SELECT '{KG}Series.' || o_custkey AS series, '{KG}Episode.' || o_orderkey AS show FROM orders WHERE o_orderstatus <> 'F'"),
    "one_way_symmetric": ({}, f"SELECT '{KG}Concept.' || a.p_partkey AS one, '{KG}Concept.' || a.p_size AS other FROM part a WHERE NOT EXISTS (SELECT 1 FROM part b WHERE b.p_partkey = a.p_size AND b.p_size = a.p_partkey)"),
    "crosswalk_without_same_as": ({}, f"SELECT '{KG}Persona.' || s_suppkey AS entity, 'http://pages.example/' || s_suppkey AS page FROM supplier LEFT JOIN customer ON c_custkey = s_suppkey WHERE s_acctbal > 0 AND s_nationkey % 2 <> 0 AND coalesce(c_nationkey, 1) % 3 <> 0"),
    "same_as_without_crosswalk": ({}, f"SELECT '{KG}Persona.' || s_suppkey AS entity, 'http://pages.example/' || s_suppkey AS page FROM supplier WHERE s_nationkey % 2 = 0 AND s_acctbal <= 0 UNION ALL SELECT '{KG}Human.' || c_custkey, 'http://pages.example/' || c_custkey FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey WHERE c_nationkey % 3 = 0 AND coalesce(s_acctbal, 0) <= 0"),
    "created_after_issued": ({}, f"SELECT '{KG}Episode.' || o_orderkey AS show FROM {_ISSUED} WHERE o_orderdate::DATE > issued"),
}

def _register(name: str, values: dict[str, str], sql: str) -> None:
    def asked(spark, d):
        return ask_named(curated_view(spark, d), "links_at" if name == "links_disputed" else name, V, **values)

    asked.__name__ = f"named_{name}"
    query(sql)(asked)

for _name, (_values, _sql) in _ASKED.items():
    _register(_name, _values, _sql)

@query(f"SELECT '{KG}Series.' || o_custkey AS series, '{KG}Episode.' || o_orderkey AS show, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::INTEGER AS nth FROM orders")
def series_order(spark, d):
    """Each series' members with their rank by position, a typed number."""
    found = sparql(curated_view(spark, d), V.prefixes() + TEXTS["series_members"].partition("ORDER BY")[0], lex=False)
    nth = F.row_number().over(W.partitionBy("series").orderBy(sort_key(F.col("place"))))
    return found.select(graph.lexical(F.col("series")).alias("series"), graph.lexical(F.col("show")).alias("show"), nth.alias("nth"))

@query(f"SELECT o_orderkey, '{KG}EpisodeType.' || o_orderpriority[1] AS episode_type FROM orders")
def manifest_episode_types(spark, d):
    """Orders as manifest rows, their priority as the type that altLabels name."""
    return episode_types(table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("type")), curated_view(spark, d), V).drop("type")

@query(f"WITH RECURSIVE e AS (SELECT p_partkey AS a, p_partkey // 3 AS b FROM part WHERE p_partkey >= 3), up AS (SELECT a, b FROM e UNION SELECT up.a, e.b FROM up JOIN e ON up.b = e.a) SELECT '{KG}Concept.' || a AS idea, '{KG}Concept.' || b AS ground FROM up")
def builds_on_closure(spark, d):
    """What every concept builds on, in any number of steps."""
    return sparql(curated_view(spark, d), V.prefixes() + "SELECT ?idea ?ground WHERE { ?idea v:buildsOn+ ?ground }")

@query(f"{_UP} SELECT '{KG}Concept.' || p_partkey AS idea FROM part JOIN (SELECT a FROM up WHERE b = 3 UNION SELECT 3) ON a = p_size")
def concepts_under_topic(spark, d):
    """The concepts of a topic and all topics below it: the closure starts from the bound end."""
    return sparql(curated_view(spark, d), V.prefixes() + "SELECT ?idea WHERE { ?topic skos:broader* kg:Subject.3 . ?idea dct:subject ?topic }")

_CHANGED = "SELECT count(*)::BIGINT AS n FROM supplier WHERE s_nationkey = 3"

@query(f"SELECT change, p, n FROM (VALUES ('gained'), ('lost')) a(change), (VALUES ('<{SC}inNation>'), ('<{SKOS}prefLabel>')) b(p), ({_CHANGED}) WHERE n > 0")
def blank_migration(spark, d):
    """Suppliers, customers and orders as blank nodes, under other labels after a move that also renames the suppliers of one nation."""
    supp, cust, orders = (table(spark, d, t) for t in "supplier customer orders".split())

    def version(node, name):
        return _graph([
            (supp, node("a", "s_suppkey"), pred("inNation"), ent("Nation", "s_nationkey")), (supp, node("a", "s_suppkey"), LABEL, name),
            (cust, node("c", "c_custkey"), pred("inNation"), ent("Nation", "c_nationkey")), (cust, node("c", "c_custkey"), pred("segment"), text("c_mktsegment")),
            (orders, node("o", "o_orderkey"), pred("placedBy"), node("c", "o_custkey")), (orders, node("o", "o_orderkey"), pred("priority"), text("o_orderpriority")),
        ])

    before = version(lambda k, key: F.concat(F.lit(f"_:{k}"), F.col(key).cast("string")), text("s_name"))
    after = version(lambda k, key: F.concat(F.lit("_:z"), F.md5(F.concat(F.lit(k), F.col(key).cast("string")).cast("binary"))), F.when(F.col("s_nationkey") == 3, text(F.concat(F.lit("New "), "s_name"))).otherwise(text("s_name")))
    return integrity.difference(integrity.canonical(before), integrity.canonical(after)).groupBy("change", "p").agg(F.count("*").alias("n"))

def _ontology(spark) -> DataFrame:
    """Declarations for the curated graph, some of which it breaks."""
    kind = f"<{SC}Level>"
    levels = [V.member(V.confidence, n) for n in ("Candidate", "Curated", "Corroborated")]
    cells = [f"_:l{i}" for i in range(len(levels))]
    rows = [(pred(p), f"<{RDFS}{what}>", pred(c)) for p, what, c in (("memberOf", "domain", "Human"), ("memberOf", "range", "Organization"), ("hasSubject", "domain", "Relationship"), ("hasSubject", "range", "Persona"), ("influencedBy", "range", "Persona"))]
    rows += [(pred("calculatedConfidence"), f"<{RDFS}range>", kind), (kind, f"<{OWL}equivalentClass>", "_:e"), ("_:e", f"<{OWL}oneOf>", cells[0])]
    rows += [(c, f"<{RDF}first>", m) for c, m in zip(cells, levels, strict=True)] + [(c, f"<{RDF}rest>", n) for c, n in zip(cells, [*cells[1:], f"<{RDF}nil>"], strict=True)]
    rows += [(pred("hasSubject"), f"<{RDF}type>", f"<{OWL}FunctionalProperty>"), ("_:m", f"<{OWL}onProperty>", pred("hasGuest")), ("_:m", f"<{OWL}maxCardinality>", f'"2"^^<{XSD}integer>')]
    return spark.createDataFrame(rows, "s string, p string, o string")

@query(
    f"""SELECT '<{KG}Relationship.' || s_suppkey || '>' AS s, '<{SC}hasSubject>' AS p, 2::BIGINT AS n_objects, 'range,cardinality' AS problems FROM supplier WHERE s_nationkey = 3
    UNION ALL SELECT '<{KG}Concept.' || p_partkey || '>', '<{SC}influencedBy>', 1, 'range' FROM part WHERE p_size <= 40 AND p_size NOT IN (SELECT s_suppkey FROM supplier)
    UNION ALL SELECT '<{KG}LinkNote.' || p_partkey || '>', '<{SC}calculatedConfidence>', 1, 'enumeration' FROM part WHERE p_size > 30 AND p_size <= 40
    UNION ALL SELECT '<{KG}Episode.' || l_orderkey || '>', '<{SC}hasGuest>', count(DISTINCT l_suppkey)::BIGINT, 'cardinality' FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) > 2"""
)
def ontology_violations(spark, d):
    return integrity.constraint_violations(curated_view(spark, d), _ontology(spark))

@query(f"SELECT entity_text, entity_type, source_file, source_type, occurrence_count FROM ({ORACLE_SQL['entity_raw']})")
def mentions_lateral(spark, d):
    """The recogniser as a table function in SQL."""
    register(spark)
    found = spark.sql("SELECT m.entity_text, m.entity_type, source_file, source_type FROM {docs}, LATERAL mentions(text) m", docs=_corpus(spark, d).filter(F.trim("text") != ""))
    return found.groupBy("entity_text", "entity_type", "source_file", "source_type").agg(F.count("*").alias("occurrence_count"))

@query("SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\">', 1)) AS href, unnest(range(len(regexp_extract_all(html, '<a href=\"([^\"]*)\">')))::INTEGER[]) AS pos FROM pages")
def anchors_lateral(spark, d):
    """Every link of every page, by a table function in SQL."""
    register(spark)
    return spark.sql("SELECT page_id, a.href, a.pos FROM {pages}, LATERAL anchors('', html) a", pages=table(spark, d, "pages"))

@query(f"SELECT row_number() OVER (ORDER BY episode_id, proposed_def, proposed_label, source_note)::INTEGER AS id, * FROM ({ORACLE_SQL['proposals']})")
def proposal_rows(spark, d):
    """Ingested proposals as rows of the staging table, numbered and dated."""
    rows = promote.as_candidates(proposals(spark, d), tables.CANDIDATE_CONCEPTS)
    return rows.filter("created_at IS NOT NULL AND reviewer_notes IS NULL").drop("created_at", "reviewer_notes")
