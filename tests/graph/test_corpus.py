import difflib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillgraph.functions import text as fn
from quillgraph.operators import discovery, entities, linkage, promote
from quillgraph.plans.vocabulary import Vocabulary
from quillgraph.sources import tables
from quillgraph.streaming.incremental import index_new_files

V = Vocabulary()


def rows(df):
    return [tuple(r) for r in df.collect()]


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_scalar_functions(spark):
    assert column(spark, ["The Great Thing", "EROI (Energy)", "Émile Durkheim", ""], fn.slugify) == ["TheGreatThing", "EroiEnergy", "MileDurkheim", ""]
    urls = ["/series/147-x", "/series/part-02-x", "/series/special-x"]
    assert column(spark, urls, lambda c: fn.number_after(c, r"/series/(?:part-)?(\d+)-")) == [147, 2, None]
    assert column(spark, ["Big Part 3", "apart 4", None], fn.part_number) == [3, None, None]
    assert column(spark, ["[Update] A  É-b!.PDF", "x - by some one", "[update] y"], lambda c: fn.normalize_title(c, "by Some One")) == ["a éb", "x", "update y"]
    assert column(spark, [" a b\n c", ""], fn.word_count) == [3, 0]
    assert column(spark, ["http://h/a/b.pdf?x#y", "/c/d.txt"], fn.file_name) == ["b.pdf", "d.txt"]


def scored(a, part_a, b, part_b):
    """The score of two normalised titles, as the rule says it."""
    if not a or not b or part_a is not None and part_b is not None and part_a != part_b:
        return 0.0
    if min(len(a), len(b)) >= 5 and (a in b or b in a):
        return 0.95
    return difflib.SequenceMatcher(None, a, b).ratio()


TITLES = st.text("abc part12", max_size=20)
PARTS = st.one_of(st.none(), st.integers(1, 3))


@settings(max_examples=200, deadline=None)
@given(TITLES, PARTS, st.lists(st.tuples(TITLES.filter(bool), PARTS), min_size=1, max_size=8))
def test_closest_of_all(title, part, others):
    got = linkage.Titles([t for t, _ in others], [p for _, p in others], list(range(len(others)))).closest(title, part)
    score, last = max((scored(title, part, t, p), -i) for i, (t, p) in enumerate(others))
    assert got == (score, -last if score else None)


def test_link(spark):
    files = spark.createDataFrame([("one", "Issue #7\nx y"), ("two", "Issue #9"), ("the long title part 2.pdf", "no number"), ("zzz", "")], "filename string, text string")
    cands = spark.createDataFrame([(0, "a", "/n/7-x", "t"), (1, "b", "/n/7-y", "u"), (2, "The long title, Part 1", "/q", "t"), (3, "The long title, Part 2", "/r", "t"), (4, "The long title, Part 2", "/s", "t")], "idx long, title string, url string, type string")
    out = {r.filename: (r.url, r.method, r.rendered) for r in linkage.link(files, cands, r"Issue\s*#(\d+)", r"/n/(\d+)-").collect()}
    assert out == {"one": ("/n/7-y", "exact_number", "1.00"), "two": (None, "none", "number_9_not_found"), "the long title part 2.pdf": ("/r", "fuzzy_title", "0.95"), "zzz": (None, "none", "0.00")}
    blocks = linkage.best_titles(files.withColumn("title", F.col("filename")), cands, titles_at_once=1, candidates_at_once=2)
    assert {r.filename: r.cand_idx for r in blocks.collect()}["the long title part 2.pdf"] == 3


def test_entities(spark):
    raw = [("’s Show", "ORG", "f", "t", 2), ("Show", "WORK_OF_ART", "f", "t", 3), ("00:02:43", "PERSON", "f", "t", 1), ("00:02:43", "ORG", "f", "t", 1), ("Bitcoin", "PERSON", "f", "t", 1), ("Bitcoin", "ORG", "g", "t", 1), ("5", "CARDINAL", "f", "t", 9)]
    df = spark.createDataFrame(raw, "entity_text string, entity_type string, source_file string, source_type string, occurrence_count int")
    out = sorted(rows(entities.refilter(df, {"'s Show": ("Show", "WORK_OF_ART")})))
    assert out == [("00:02:43", "ORG", "f", "t", 1), ("Bitcoin", "ORG", "g", "t", 1), ("Bitcoin", "PRODUCT", "f", "t", 1), ("Show", "WORK_OF_ART", "f", "t", 5)]
    docs = spark.createDataFrame([("a", "t", "Ann Lee met Bob. Ann Lee left"), ("b", "t", "  "), ("c", "s", "Bob")], "source_file string, source_type string, text string")
    index = entities.index_raw(docs)
    assert sorted(rows(index.select("entity_text", "source_file", "occurrence_count"))) == [("Ann Lee", "a", 2), ("Bob", "a", 1), ("Bob", "c", 1)]
    assert rows(entities.top_entities(index, 1)) == [("Ann Lee", 2, 1)]
    assert rows(entities.report(entities.top_entities(index, 1))) == [("       2     1  Ann Lee",)]
    assert [r.source_file for r in entities.new_documents(docs, docs.filter("source_file = 'c'"), limit=1).collect()] == ["a"]
    assert entities.new_documents(docs, docs, force=True).count() == 3


def test_incremental_stream(spark, tmp_path):
    src, raw, cp = (str(tmp_path / x) for x in ("src", "raw", "cp"))
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.txt").write_text("Ann Lee spoke")
    index_new_files(spark, src, raw, cp)
    (tmp_path / "src" / "b.txt").write_text("Bob Ray spoke")
    index_new_files(spark, src, raw, cp)
    assert sorted(r.entity_text for r in spark.read.parquet(raw).collect()) == ["Ann Lee", "Bob Ray"]


def test_a_repeated_batch_is_in_the_table_once(spark, tmp_path):
    src, raw, cp = (str(tmp_path / x) for x in ("src", "raw", "cp"))
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.txt").write_text("Ann Lee spoke")
    index_new_files(spark, src, raw, cp)
    for f in (tmp_path / "cp" / "commits").iterdir():  # as if it had stopped after writing and before its commit
        f.unlink()
    index_new_files(spark, src, raw, cp)
    assert [r.entity_text for r in spark.read.parquet(raw).collect()] == ["Ann Lee"]


def test_a_rewrite_that_stops_anywhere_loses_nothing(spark, tmp_path):
    old, new = ([(i, t, "P", "f", "t", 1) for i in range(3)] for t in ("old", "new"))
    seen = set()
    for stop in range(7):
        path = str(tmp_path / str(stop))
        tables.rewrite(spark.createDataFrame(old, tables.ENTITIES), path)
        steps = tables.rewrite_steps(spark.createDataFrame(new, tables.ENTITIES), path)
        for step in steps[:stop]:
            step()
        found = {r.entity_text for r in tables.ensure_table(spark, path, tables.ENTITIES).collect()}
        seen |= found
        assert len(found) == 1 and tables.ensure_table(spark, path, tables.ENTITIES).count() == 3
        assert found == ({"old"} if stop < 3 else {"new"})
        tables.rewrite(spark.createDataFrame(new, tables.ENTITIES), path)
        assert {p.name for p in tmp_path.iterdir() if p.name.startswith(f"{stop}.")} == set()
    assert seen == {"old", "new"}


def test_rows_of_some_keys_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_ = spark.createDataFrame([(f"k{i}", "a") for i in range(200)], "k string, v string")
    tables.append_by_key(rows_, path, "k")
    before = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "t").iterdir() if p.is_dir()}
    gone = rows_.filter("k IN ('k1', 'k2')")
    tables.replace_by_key(spark.createDataFrame([("k1", "b"), ("k1", "c")], "k string, v string"), path, "k", gone)
    got = sorted((r.k, r.v) for r in spark.read.parquet(path).collect() if r.v != "a")
    assert got == [("k1", "b"), ("k1", "c")] and spark.read.parquet(path).count() == 200
    after = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "t").iterdir() if p.is_dir()}
    assert sum(before[b] != after.get(b) for b in before) <= 2


def test_numbers_without_one_task(spark):
    data = [("big", f"{i % 500:03}") for i in range(5000)] + [(f"s{i:05}", "x") for i in range(3000)]
    out = entities.numbered(spark.createDataFrame(data, "f string, t string").repartition(5), "f", "t").collect()
    assert [(r.f, r.t) for r in sorted(out, key=lambda r: r.id)] == sorted(data) and sorted(r.id for r in out) == list(range(1, 8001))
    assert entities.numbered(spark.createDataFrame([], "f string, t string"), "f", "t").count() == 0


def test_discovery(spark):
    rules = [("round", "/episode/round-"), ("talk", "/episode/"), ("mono", "/mono/")]
    html = '<h1> My &amp; Title </h1><a href="/episode/round-3">r</a><a href="/episode/12-x">Download <b>Transcript</b></a><a href="http://else/episode/1">o</a><a href="/mono/1">m</a><a href="/mono/1">again</a><a>none</a>'
    pages = spark.createDataFrame([("http://h/list", "talk", html), ("http://h/dead", "talk", None)], "url string, kind string, html string")
    listing = discovery.listing_links(pages, rules)
    assert sorted(rows(listing)) == [("http://h/episode/12-x", "talk", 1), ("http://h/episode/round-3", "round", 0), ("http://h/mono/1", "mono", 3)]
    sitemap = spark.createDataFrame([("http://h/episode/12-x", "talk", 0), ("http://h/episode/9", "talk", 1)], "url string, kind string, pos int")
    assert sorted(rows(discovery.discover(sitemap, listing, 1))) == [("http://h/episode/12-x", "talk", 1), ("http://h/episode/round-3", "round", 1), ("http://h/mono/1", "mono", 1)]
    assert discovery.discover(None, listing).count() == 3
    good, dead = discovery.transcripts(pages)
    assert rows(good) == [("http://h/list", "talk", "My & Title", "http://h/episode/12-x", "12-x")] and [r[0] for r in rows(dead)] == ["http://h/dead"]
    assert discovery.to_fetch(listing, good.withColumn("episode_url", F.lit("http://h/mono/1")), dead).count() == 2
    discovery.refuse_blocked(listing, ["/private"])
    try:
        discovery.refuse_blocked(listing, ["/mono"])
        raise AssertionError("not refused")
    except PermissionError:
        pass


def test_promotion(spark):
    c = spark.createDataFrame([(1, "e", "Sea Level", "def", "", "approved", None), (2, "e", "Sea Level", "def", "src", "approved", None), (3, "e", "No", "d", None, "pending", None)], "id int, episode_id string, proposed_label string, proposed_def string, source_note string, status string, reviewer_notes string")
    assert promote.promote_concepts(c, V).count() == 5
    lk = spark.createDataFrame([(1, "Ada", "influencedBy", "Tide", "r1", "approved"), (2, "Ada", "influencedBy", "Tide", "r2", "approved"), (3, "Ada", "likes", "Tide", "r", "approved"), (4, "Ada", "appliesTo", "Typo", "r", "pending")], "id int, subject_label string, predicate string, object_label string, rationale string, status string")
    graph = spark.createDataFrame([(f"<{V.instances}{k}.Ada>", "<http://www.w3.org/2004/02/skos/core#prefLabel>", '"Ada"@en') for k in ("Human", "Persona")], "s string, p string, o string")
    resolved = promote.resolve_links(lk, promote.label_index(graph), V)
    assert {(r.id, r.subject.split("#")[1], r.unknown_object, r.skipped) for r in resolved.collect()} == {(1, "Persona.Ada>", True, False), (2, "Persona.Ada>", True, False), (3, "Persona.Ada>", True, True)}
    out = promote.promote_links(resolved, "candidate", V)
    assert out.count() == 12 and not [r for r in rows(out) if "calculatedConfidence" in r[1]]
    marked = {r.id: r.status for r in promote.mark_promoted(lk, resolved.filter("not skipped")).collect()}
    assert marked == {1: "promoted", 2: "promoted", 3: "approved", 4: "pending"}
    assert {r.status for r in promote.mark_promoted(lk).collect()} == {"promoted", "pending"}
    decided = promote.review(c, spark.createDataFrame([(3, "approved", "ok"), (1, "rejected", "no")], "id int, status string, reviewer_notes string"))
    assert {(r.id, r.status, r.reviewer_notes) for r in decided.collect()} == {(1, "approved", None), (2, "approved", None), (3, "approved", "ok")}
    raw = spark.createDataFrame([("e", '{"concepts":[{"label":"A","definition":"d"}],"links":[{"subject":"A","predicate":"p","object":"B","rationale":"r"}]}'), ("f", "junk")], "episode_id string, response string")
    concepts, links = promote.ingest_proposals(raw)
    assert concepts.count() == links.count() == 1


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.ensure_table(spark, path, tables.ENTITIES).count() == 0
    tables.rewrite(spark.createDataFrame([(1, "a", "P", "f", "t", 1)], tables.ENTITIES), path)
    again = tables.ensure_table(spark, path, tables.ENTITIES)
    tables.rewrite(again.unionAll(again), path)
    assert tables.ensure_table(spark, path, tables.ENTITIES).count() == 2
    (tmp_path / "m.csv").write_text('episode_url,type,title,transcript_url,local_filename\r\nu,a,"x, ""y""",t,f\r\nu,b,z,t,f\r\n')
    assert [r.title for r in tables.read_manifest(spark, str(tmp_path / "m.csv")).collect()] == ["z"]
    assert tables.read_manifest(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "s.xml").write_text('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> http://a/b </loc></url><url><loc>http://c</loc></url></urlset>')
    assert sorted(rows(tables.read_sitemap(spark, str(tmp_path / "s.xml")))) == [("http://a/b",), ("http://c",)]
    paths = spark.createDataFrame([("p",), ("q",)], "path string")
    cache = spark.createDataFrame([("p", "old"), ("z", "other")], "path string, text string")
    full, fresh = tables.read_through(paths, cache, lambda df: df.withColumn("text", F.lit(None).cast("string")))
    assert sorted(rows(full)) == [("p", "old"), ("q", "")] and rows(fresh) == [("q", "")]
    tables.write_csv(full, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2


def test_best_titles_agrees_with_all_pairs(spark):
    names = ["The tide part 1", "tide Part 2.pdf", "wave", "a wave of salt", None, "", "salty waves and tides", "tides", "wave"]
    left = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, title string")
    cands = spark.createDataFrame([(i, n) for i, n in enumerate(["Tide, part 2", "waves", "salt", "wave", "The Tide (Part 1)", "", "tidal", "wave", None])], "idx long, title string")
    plain = lambda df, key: {r[0]: (r.t, r.p) for r in df.select(key, fn.normalize_title(F.col("title")).alias("t"), fn.part_number(F.col("title")).alias("p")).collect()}
    mine, pool = plain(left, "i"), plain(cands, "idx")
    out = linkage.best_titles(left, cands, titles_at_once=3, candidates_at_once=3).collect()
    assert len(out) == len(names)
    for r in out:
        score, last = max((scored(*mine[r.i], *x), -k) for k, x in pool.items())
        assert (r.score, r.cand_idx) == (score, -last if score else None)
    assert linkage.best_titles(left, cands.limit(0)).filter("cand_idx IS NULL AND score = 0").count() == len(names)


def test_ids_counts_and_binaries(spark, tmp_path):
    df = spark.createDataFrame([("b", "x"), ("a", "z"), ("a", "y")], "f string, t string")
    assert sorted((r.id, r.f, r.t) for r in entities.numbered(df, "f", "t", after=5).collect()) == [(6, "a", "y"), (7, "a", "z"), (8, "b", "x")]
    (tmp_path / "a.pdf").write_bytes(b"one|two||")
    (tmp_path / "b.pdf").write_bytes(b"!")

    def pages(content):
        if content == b"!":
            raise ValueError("no PDF")
        return content.decode().split("|")

    assert sorted(rows(tables.read_binaries(spark, str(tmp_path), "transcript", pages))) == [("a.pdf", "transcript", "one\n\ntwo"), ("b.pdf", "transcript", "")]


def test_title_and_link_keep_references_as_sql_does(spark, tmp_path):
    import duckdb

    from quillgraph.queries import ORACLE_SQL, QUERIES

    heads = ["A &amp; b &lt; c &quot;d&#39; &amp", "cut &quot", "&amp;lt; &copy; &eacute &#x41;", ""]
    pages = [(i, f'<h1>{h}</h1><a href="/x?a=1&amp;b={i}">the &quot;one&quot;</a><a href="/y">no</a>') for i, h in enumerate(heads)]
    spark.createDataFrame(pages, "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    want = duckdb.connect().execute(ORACLE_SQL["page_title_link"].replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'")).fetchall()
    assert sorted(rows(QUERIES["page_title_link"](spark, str(tmp_path)))) == sorted(want)
    assert discovery.page_links("http://h/", pages[0][1])[0] == "A & b < c \"d' &"


def test_manifest_files_are_bounded_and_the_last_row_wins(spark, tmp_path):
    whole = [(i, f"http://h/{i % 40}", "page", f'line "{i}"\n, two\\', "t", "f") for i in range(400)]
    df = spark.createDataFrame(whole, "pos int, episode_url string, type string, title string, transcript_url string, local_filename string")
    path = str(tmp_path / "m")
    tables.write_manifest(df.repartition(5), path, ["pos"], rows_a_part=100, rows_a_file=30)
    files = sorted((tmp_path / "m").glob("*.csv"))
    assert len(files) >= 14  # before: one file, written and read by one task
    assert rows(spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(files[0])).limit(1).select("episode_url")) == [("http://h/0",)]
    found = tables.read_manifest(spark, path)
    assert sorted(rows(found)) == sorted(r[1:] for r in whole[360:])


def test_shared_grams_group_numbers_not_texts(spark):
    left = spark.createDataFrame([("a long title of one",), ("zzz",), ("a long title of one",)], "title string")
    cands = spark.createDataFrame([(1, "long titles"), (2, "a title of one"), (3, "a title of one")], "idx long, title string")
    out = linkage.shared_grams(left, cands)
    grams = lambda t: {t[i : i + 3] for i in range(len(t) - 2)}
    assert rows(out) == [("a long title of one", len(grams("a long title of one") & grams("a title of one")), 2)]
    import re

    assert not any("title" in keys for keys in re.findall(r"keys=\[([^\]]*idx[^\]]*)\]", out._jdf.queryExecution().toString()))


def test_ratios_of_many_titles_are_difflibs(monkeypatch):
    import random

    import numpy as np

    rnd, calls = random.Random(3), []
    word = lambda most: "".join(rnd.choice("abcd eé") for _ in range(rnd.randint(1, most)))
    for most in (5, 64, 65, 130, 260):  # one to four words of bits, and titles that go through difflib itself
        others = [word(most) for _ in range(40)]
        asked = [word(260) for _ in range(4)] + [word(40) + others[0] + word(40), others[1][:50]]
        pool = linkage.Titles(others, [None] * 40, list(range(40)))
        for title in asked:
            assert pool.ratios(title, np.arange(40), 0.0).tolist() == [difflib.SequenceMatcher(None, title, t).ratio() for t in others]
    found = difflib.SequenceMatcher.find_longest_match
    monkeypatch.setattr(difflib.SequenceMatcher, "find_longest_match", lambda *a, **k: calls.append(1) or found(*a, **k))
    others = [word(150) for _ in range(40)]
    got = linkage.Titles(others, [None] * 40, list(range(40))).closest(asked[0], None)
    assert got[0] > 0 and not calls  # before: difflib for one pair after the other
