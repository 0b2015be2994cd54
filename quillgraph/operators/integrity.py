"""Integrity checks as violation tables: no row means no violation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.plans.algebra import Pattern, Var, closure
from quillgraph.plans.vocabulary import OWL, RDFS, Vocabulary
from quillgraph.sources.graph import KEY, lexical, with_predicate
from quillgraph.sources.tables import cut, spread
from quillgraph.sources.turtle import RDF, XSD


def triple_counts(triples: DataFrame) -> DataFrame:
    """(src_file, triples); the graph's own size is that of the set without provenance."""
    return triples.groupBy("src_file").agg(F.count_distinct(*(F.coalesce(c, F.lit("\0")) for c in KEY)).alias("triples"))


def mixed_prefixes(subjects: DataFrame, file: str, local: Column) -> DataFrame:
    """(file, prefixes, n_prefixes, sample) of the files whose subjects' local names have more than one prefix before the first dot."""
    rows = subjects.select(F.col(file).alias("file"), local.alias("local")).filter(F.contains("local", F.lit("."))).distinct().withColumn("prefix", F.substring_index("local", ".", 1))
    out = rows.groupBy("file").agg(F.array_join(F.sort_array(F.collect_set("prefix")), ",").alias("prefixes"), F.count_distinct("prefix").alias("n_prefixes"), F.min("local").alias("sample"))
    return out.filter("n_prefixes > 1")


def class_purity(triples: DataFrame, vocabulary: Vocabulary | None = None, skip: str = "scratch.ttl") -> DataFrame:
    v = vocabulary or Vocabulary()
    named = triples.filter((F.col("s_kind") == "iri") & F.col("s").startswith(v.instances) & ~F.col("src_file").endswith("/" + skip))
    return mixed_prefixes(named, "src_file", F.substring("s", len(v.instances) + 1, 1 << 30))


def scratch_left(triples: DataFrame, name: str = "scratch.ttl", allowed: int = 3) -> DataFrame:
    return triple_counts(triples.filter(F.col("src_file").endswith("/" + name))).filter(F.col("triples") > allowed)


def dangling(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of child whose non-null key no row of parent has."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def dangling_objects(graph: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """(s, p, o) whose object is an instance IRI that is never a subject."""
    v = vocabulary or Vocabulary()
    return dangling(graph.filter(F.col("o").startswith(f"<{v.instances}")), "o", graph.select("s").distinct(), "s").select("s", "p", "o")


def bad_confidence(graph: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """(note, problem): LinkNotes without evidence, without a calculated confidence or with one outside the enumeration."""
    v = vocabulary or Vocabulary()
    notes = graph.filter((F.col("p") == f"<{RDF}type>") & (F.col("o") == f"<{v.schema}LinkNote>")).select(F.col("s").alias("note"))
    has = lambda p: graph.filter(F.col("p") == f"<{v.schema}{p}>").select(F.col("s").alias("note"), "o")
    evidence = graph.filter((F.col("p") == f"<{RDF}type>") & (F.col("o") == f"<{v.schema}Evidence>")).select(F.col("s").alias("o"))
    levels = v.members(v.confidence, "Candidate", "Curated", "Corroborated", "Disputed")
    return (
        notes.join(has("hasEvidence").join(evidence, "o", "left_semi"), "note", "left_anti").select("note", F.lit("no valid evidence").alias("problem"))
        .unionAll(notes.join(has("calculatedConfidence"), "note", "left_anti").select("note", F.lit("no calculated confidence")))
        .unionAll(notes.join(has("calculatedConfidence").filter(~F.col("o").isin(*levels)), "note", "left_semi").select("note", F.lit("confidence out of range")))
    )


def one_way(pairs: DataFrame, rows: int) -> DataFrame:
    """Different pairs(a, b), of about so many rows, whose reverse (b, a) isn't there. A null is equal to nothing, so pairs with one stay."""
    a, b = pairs.columns
    back = F.coalesce(F.col(a) > F.col(b), F.lit(False))
    ends = pairs.select(F.when(back, F.col(b)).otherwise(F.col(a)).alias("_lo"), F.when(back, F.col(a)).otherwise(F.col(b)).alias("_hi"), back.alias("_back"))
    ways = spread(ends, rows, "_lo", "_hi").groupBy("_lo", "_hi").agg(F.max("_back").alias("_back"), F.max(~F.col("_back")).alias("_on"))
    alone = ways.filter(~(F.col("_back") & F.col("_on")) & ~F.coalesce(F.col("_lo") == F.col("_hi"), F.lit(False)))
    return alone.select(F.when(F.col("_back"), F.col("_hi")).otherwise(F.col("_lo")).alias(a), F.when(F.col("_back"), F.col("_lo")).otherwise(F.col("_hi")).alias(b))


def over_cardinality(graph: DataFrame, predicate: str, most: int = 1) -> DataFrame:
    return graph.filter(F.col("p") == f"<{predicate}>").groupBy("s").agg(F.count("*").alias("n")).filter(F.col("n") > most)


def difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows gained and lost between two graphs (s, p, o), as bags: (change, s, p, o). Both meet in one grouping."""
    both = after.withColumn("_n", F.lit(1)).unionAll(before.withColumn("_n", F.lit(-1)))
    left = both.groupBy(*after.columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    return left.select(F.when(F.col("_n") > 0, "gained").otherwise("lost").alias("change"), *after.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_n"))).alias("_i")).drop("_i")


def domain_range(graph: DataFrame, predicate: str, domain: str | None = None, range_: str | None = None) -> DataFrame:
    """Opt-in: (s, o, problem) where subject or object lacks the declared class."""
    edges = graph.filter(F.col("p") == f"<{predicate}>").select("s", "o")
    typed = lambda c, name: graph.filter((F.col("p") == f"<{RDF}type>") & (F.col("o") == f"<{c}>")).select(F.col("s").alias(name))
    parts = [edges.join(typed(c, name), name, "left_anti").select("s", "o", F.lit(problem).alias("problem")) for c, name, problem in ((domain, "s", "domain"), (range_, "o", "range")) if c]
    return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])


def _ids(node: Column, name: str) -> list[Column]:
    """A node as two numbers: 16 bytes, whatever its label."""
    return [F.xxhash64(F.lit(seed), node).alias(f"{name}{seed}") for seed in (1, 2)]


def _mark_sums(*told: Column) -> list[Column]:
    """Sums, as _m0 to _m3, of the halves of two hashes of what a row tells: longs, for fewer than 2^31 rows. Rows that tell null count nothing."""
    hashes = [F.when(told[0].isNotNull(), F.xxhash64(F.lit(seed), *told)) for seed in (1, 2)]
    halves = [x for h in hashes for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    return [F.coalesce(F.sum(h), F.lit(0)).alias(f"_m{i}") for i, h in enumerate(halves)]


def _mixed(*columns: str, to: str = "_c") -> list[Column]:
    return [F.xxhash64(F.lit(seed), *columns).alias(f"{to}{seed}") for seed in (1, 2)]


def canonical(graph: DataFrame, most_rounds: int = 100) -> DataFrame:
    """graph(s, p, o) with blank nodes named by what they are in: two loads of one graph come out equal, whatever labels they gave.

    Colour refinement: a node's colour is a hash of its triples with the colours of the blank nodes at their other ends, taken again until
    no more nodes are told apart. Sums of hashes make a colour, so a node with any number of triples needs no list of them.
    Nodes that refinement can't tell apart share a name, and their triples stay as often as they are there: compare as bags. Nulls stay null.

    Nodes and colours are two numbers each. One grouping finds what a node is in by its other triples. A node with a single blank neighbour tells that
    one what it is in and takes its own colour from the neighbour's at the end, so rounds run only over triples between the others.
    """
    blank = lambda c: F.coalesce(F.col(c).startswith("_:"), F.lit(False))
    graph = graph.select("s", "p", "o")
    ends = []
    for me, other, way in (("s", "o", "out"), ("o", "s", "in")):
        near = [F.when(blank(other), x).alias(f"_o{i}") for i, x in enumerate(_ids(F.col(other), "_"), 1)]
        far = [F.when(~blank(other), F.xxhash64(F.lit(seed), F.coalesce(other, F.lit("")), F.col(other).isNull())).alias(f"_far{seed}") for seed in (1, 2)]
        ends.append(graph.filter(blank(me)).select(*_ids(F.col(me), "_n"), F.xxhash64(F.lit(way), "p").alias("_edge"), *near, *far, F.lit(me == "s").alias("_is_s")))
    node, near = ["_n1", "_n2"], ["_o1", "_o2"]
    found = ends[0].unionAll(ends[1]).groupBy(*node).agg(
        *_mark_sums(F.col("_far1"), F.col("_far2"), F.col("_edge")), F.count("_far1").alias("_fars"), F.count("_o1").alias("_degree"),
        *(F.max(c).alias(c) for c in near), F.max(F.when(F.col("_o1").isNotNull(), F.col("_edge"))).alias("_edge"), F.max("_is_s").alias("_is_s"), F.max(~F.col("_is_s")).alias("_is_o"),
    )
    marks = [f"_m{i}" for i in range(4)]
    single = lambda c: F.when(F.col("_degree") == 1, F.col(c)).alias(c)
    nodes = cut(found.select(*node, *_mixed(*marks, "_fars", "_degree"), "_degree", *map(single, (*near, "_edge")), "_is_s", "_is_o"))
    told = nodes.filter("_degree = 1").groupBy(*(F.col(c).alias(n) for c, n in zip(near, node, strict=True))).agg(*_mark_sums(F.col("_edge"), F.col("_c1"), F.col("_c2")), F.count("*").alias("_leaves"))
    core = nodes.filter("_degree <> 1").join(told, node, "left").na.fill(0, [*marks, "_leaves"])
    core = cut(core.select(*node, *_mixed("_c1", "_c2", *marks, "_leaves"), (F.col("_degree") - F.col("_leaves")).alias("_open"), "_is_s", "_is_o"))
    inner = core.filter("_open > 0").select(*node, "_c1", "_c2")
    if not inner.isEmpty():
        refined = _refined(graph.filter(blank("s") & blank("o")).select(*_ids(F.col("s"), "_s"), F.xxhash64("p").alias("_edge"), *_ids(F.col("o"), "_o")), inner, most_rounds)
        core = core.filter("_open = 0").select(*node, "_c1", "_c2", "_is_s", "_is_o").unionAll(core.select(*node, "_is_s", "_is_o").join(refined, node).select(*node, "_c1", "_c2", "_is_s", "_is_o"))
    parents = core.select(*(F.col(n).alias(c) for c, n in zip(near, node, strict=True)), F.col("_c1").alias("_p1"), F.col("_c2").alias("_p2"))
    pairs = cut(told.select(*node).join(core.select(*node), node, "left_anti"))  # two nodes with no neighbour but each other
    if not pairs.isEmpty():
        parents = parents.unionAll(nodes.join(pairs, node, "left_semi").select(*node, "_c1", "_c2"))
    leaves = nodes.filter("_degree = 1").join(parents, near).select(*node, *_mixed("_c1", "_c2", "_edge", "_p1", "_p2"), "_is_s", "_is_o")
    names = cut(core.select(*node, "_c1", "_c2", "_is_s", "_is_o").unionAll(leaves))
    kept = lambda c: F.when(~blank(c), F.col(c)).alias(c)
    both = lambda c: [F.when(blank(c), x).alias(f"_{c}{i}") for i, x in enumerate(_ids(F.col(c), "_"), 1)]
    out = graph.select(kept("s"), "p", kept("o"), *both("s"), *both("o"))  # no label goes through a join
    for place in ("s", "o"):
        named = out.filter(f"_{place}1 IS NOT NULL").withColumnsRenamed({f"_{place}{i}": f"_n{i}" for i in (1, 2)}).join(names.filter(f"_is_{place}").select(*node, "_c1", "_c2"), node)
        out = out.filter(f"_{place}1 IS NULL").unionByName(named.withColumnsRenamed({f"_c{i}": f"_{place}{i}" for i in (1, 2)}).drop(*node))
    digits = lambda c: F.lpad(F.hex(c), 16, "0")
    name = lambda c: F.concat(F.lit("_:b"), F.translate(F.base64(F.unhex(F.concat(digits(f"_{c}1"), digits(f"_{c}2")))), "+/=", "-_"))
    return out.select(F.coalesce("s", name("s")).alias("s"), "p", F.coalesce("o", name("o")).alias("o"))


def _refined(edges: DataFrame, nodes: DataFrame, most_rounds: int) -> DataFrame:
    """nodes(_n1, _n2, _c1, _c2) with the colours that rounds over edges(_s1, _s2, _edge, _o1, _o2) between them come to."""
    node = ["_n1", "_n2"]
    end = lambda name: [F.col(f"_n{i}").alias(f"_{name}{i}") for i in (1, 2)]
    among = edges.join(nodes.select(*end("s")), ["_s1", "_s2"], "left_semi").join(nodes.select(*end("o")), ["_o1", "_o2"], "left_semi")
    ways = [among.select(*(F.col(f"_{me}{i}").alias(f"_n{i}") for i in (1, 2)), F.xxhash64(F.lit(way), "_edge").alias("_edge"), *(F.col(f"_{other}{i}").alias(f"_t{i}") for i in (1, 2))) for me, other, way in (("s", "o", "out"), ("o", "s", "in"))]
    edges = cut(ways[0].unionAll(ways[1]))
    marks = [f"_m{i}" for i in range(4)]
    colours, known = nodes, nodes.select("_c1", "_c2").distinct().count()
    for _ in range(most_rounds):
        told = edges.join(colours.select(*end("t"), F.col("_c1").alias("_p1"), F.col("_c2").alias("_p2")), ["_t1", "_t2"])
        told = told.groupBy(*node).agg(*_mark_sums(F.col("_edge"), F.col("_p1"), F.col("_p2")))
        colours = cut(colours.join(told, node).select(*node, *_mixed("_c1", "_c2", *marks)))
        now = colours.select("_c1", "_c2").distinct().count()
        if now <= known:
            return colours
        known = now
    raise RuntimeError(f"blank nodes were still being told apart after {most_rounds} rounds")


def constraint_violations(graph: DataFrame, ontology: DataFrame, expand: bool = False) -> DataFrame:
    """(s, p, n_objects, problems) of the subjects and predicates in graph(s, p, o), or a view of one, that break what ontology(s, p, o) declares.

    Read from it: rdfs:domain, rdfs:range, owl:FunctionalProperty, owl:maxCardinality of restrictions by owl:onProperty, and classes that are an
    enumeration (owl:oneOf, itself or by owl:equivalentClass). problems, in order: domain, range, enumeration, cardinality. All
    are found in one grouped pass over the triples of declared predicates. expand: a subclass's members are its superclasses' too. A
    range that is an enumeration asks for membership alone, a datatype (xsd) for nothing. Repeated triples count once.
    """
    names = {"type": f"<{RDF}type>", "first": f"<{RDF}first>", "rest": f"<{RDF}rest>", "nil": f"<{RDF}nil>"}
    of = lambda p, a="s", b="o": ontology.filter(F.col("p") == p).select(F.col("s").alias(a), F.col("o").alias(b))
    of_graph = lambda *p: graph.triples(Pattern(Var("s"), p, Var("o"))) if hasattr(graph, "triples") else with_predicate(graph, *p).select("s", "p", "o")
    whole = of(f"<{OWL}oneOf>", "class", "list").unionAll(of(f"<{OWL}equivalentClass>", "class", "_e").join(of(f"<{OWL}oneOf>", "_e", "list"), "_e").select("class", "list"))
    cells = closure(of(names["rest"])).select(F.col("s").alias("list"), F.col("o").alias("cell"))
    cells = cells.unionAll(whole.select("list", F.col("list").alias("cell")))
    allowed = cut(whole.join(cells, "list").join(of(names["first"], "cell", "o"), "cell").select(F.col("class").alias("range"), "o").distinct().withColumn("_listed", F.lit(True)))
    most = of(f"<{OWL}onProperty>", "_r", "p").join(of(f"<{OWL}maxCardinality>", "_r", "n").select("_r", lexical(F.col("n")).cast("int").alias("most")), "_r").select("p", "most")
    functional = ontology.filter((F.col("p") == names["type"]) & (F.col("o") == f"<{OWL}FunctionalProperty>")).select(F.col("s").alias("p"), F.lit(1).alias("most"))
    limits = most.unionAll(functional).groupBy("p").agg(F.min("most").alias("most"))
    domains, ranges = of(f"<{RDFS}domain>", "p", "domain").distinct(), of(f"<{RDFS}range>", "p", "range").filter(~F.col("o").startswith(f"<{XSD}")).distinct()
    classes = domains.select(F.col("domain").alias("class")).unionAll(ranges.select("range")).distinct()
    types = of_graph(names["type"]).select(F.col("s").alias("node"), F.col("o").alias("class"))
    types = (types if expand else types.join(classes, "class", "left_semi")).distinct()
    if expand:
        up = closure(of(f"<{RDFS}subClassOf>")).select(F.col("s").alias("class"), F.col("o").alias("_up"))
        types = types.unionAll(types.join(up, "class").select("node", F.col("_up").alias("class"))).distinct()
    typed = lambda node, kind, flag: types.select(F.col("node").alias(node), F.col("class").alias(kind), F.lit(True).alias(flag))
    declared = [r.p for r in limits.select("p").unionAll(domains.select("p")).unionAll(ranges.select("p")).distinct().collect()]  # a vocabulary's predicates
    if not declared:
        declared = [names["nil"]]
    rows = of_graph(*declared).distinct()
    rows = rows.join(domains, "p", "left").join(ranges, "p", "left").join(typed("s", "domain", "_d"), ["s", "domain"], "left").join(typed("o", "range", "_r"), ["o", "range"], "left")
    rows = rows.join(allowed, ["range", "o"], "left").join(allowed.select("range").distinct().withColumn("_enum", F.lit(True)), "range", "left")
    broken = lambda c: F.max(F.coalesce(c, F.lit(False)))
    found = rows.groupBy("s", "p").agg(
        F.count_distinct("o").alias("n_objects"),
        broken(F.col("domain").isNotNull() & F.col("_d").isNull()).alias("domain"),
        broken(F.col("range").isNotNull() & F.col("_enum").isNull() & F.col("_r").isNull()).alias("range"),
        broken(F.col("_enum").isNotNull() & F.col("_listed").isNull()).alias("enumeration"),
    )
    found = found.join(limits, "p", "left").withColumn("cardinality", F.coalesce(F.col("n_objects") > F.col("most"), F.lit(False)))
    kinds = ["domain", "range", "enumeration", "cardinality"]
    problems = F.array_compact(F.array(*(F.when(F.col(k), k) for k in kinds)))
    return found.select("s", "p", "n_objects", F.array_join(problems, ",").alias("problems")).filter("problems <> ''")
