from quillgraph import cli

from . import mini


def test_graph_commands(spark, tmp_path, capsys):
    seed, store = mini.write(tmp_path / "seed"), str(tmp_path / "store")
    assert cli.main(["load", seed, "--store", store]) == 0 == cli.main(["load", seed, "--store", store, "--reload"])
    (tmp_path / "q.rq").write_text("PREFIX v: <http://example.org/kg-schema#> SELECT ?c WHERE { ?c a v:Concept }")
    assert cli.main(["query", str(tmp_path / "q.rq"), "--store", store]) == 0 and "Concept.Salt" in capsys.readouterr().out
    assert cli.main(["confidence", seed, "--out", str(tmp_path / "derived")]) == 0
    derived = "".join(r.value for r in spark.read.text(str(tmp_path / "derived")).collect())
    assert "ConfidenceType.Corroborated" in derived and "TideAda" in derived
    assert cli.main(["purity", "--seed-dir", seed, "--check-scratch-empty"]) == 1


def test_corpus_commands(spark, tmp_path):
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts" / "a.txt").write_text("Ann Lee met Ann Lee. Issue #7")
    raw, ent = str(tmp_path / "raw"), str(tmp_path / "ent")
    assert cli.main(["index", str(tmp_path / "texts"), "--raw", raw, "--entities", ent]) == 0
    (tmp_path / "texts" / "b.txt").write_text("Ann Lee alone")
    assert cli.main(["index", str(tmp_path / "texts"), "--raw", raw, "--entities", ent, "--export-csv", str(tmp_path / "csv")]) == 0
    assert cli.main(["index", str(tmp_path / "texts"), "--raw", raw, "--entities", ent, "--refilter"]) == 0
    assert {r.source_file: r.occurrence_count for r in spark.read.parquet(ent).filter("entity_text = 'Ann Lee'").collect()} == {"a.txt": 2, "b.txt": 1}
    assert cli.main(["top", ent, "--limit", "3"]) == 0
    (tmp_path / "c.csv").write_text("episode_url,title,type\n/n/7-x,T,t\n")
    assert cli.main(["match", str(tmp_path / "texts"), str(tmp_path / "c.csv"), "--out", str(tmp_path / "m")]) == 0
    assert {r.filename: r.method for r in spark.read.option("header", True).csv(str(tmp_path / "m")).collect()} == {"a.txt": "exact_number", "b.txt": "none"}


def test_promote_command(spark, tmp_path):
    seed, c, k, out = mini.write(tmp_path / "seed"), str(tmp_path / "c"), str(tmp_path / "k"), str(tmp_path / "out")
    assert cli.main(["init", "--concepts", c, "--links", k]) == 0
    spark.sql("SELECT 1 AS id, 'e' AS episode_id, 'Foam' AS proposed_label, 'd' AS proposed_def, '' AS source_note, 'approved' AS status, '' AS reviewer_notes, now() AS created_at").write.mode("append").parquet(c)
    spark.sql("SELECT 1 AS id, 'Foam' AS subject_label, 'influencedBy' AS predicate, 'Ada' AS object_label, 'r' AS rationale, 'approved' AS status, '' AS reviewer_notes, now() AS created_at").write.mode("append").parquet(k)
    args = ["promote", seed, "--concepts", c, "--links", k, "--out", out]
    assert cli.main([*args, "--dry-run"]) == 0 and spark.read.parquet(k).first().status == "approved"
    assert cli.main(args) == 0
    assert spark.read.parquet(out).count() == 15 and spark.read.parquet(k).first().status == spark.read.parquet(c).first().status == "promoted"
    spark.sql("SELECT 2 AS id, 'Foam' AS subject_label, 'influencedBy' AS predicate, 'Ada' AS object_label, 'r' AS rationale, 'approved' AS status, '' AS reviewer_notes, now() AS created_at").write.mode("append").parquet(k)
    store = str(tmp_path / "store")
    assert cli.main([*args, "--store", store, "--turtle", str(tmp_path / "ttl")]) == 0
    assert spark.read.parquet(out).count() == 15  # the same link again
    assert cli.main(["load", str(tmp_path / "ttl"), "--store", store]) == 0
    from quillgraph.sources import graph

    assert graph.store_view(spark, store).count() == 11 and graph.insert(graph.read_turtle(spark, str(tmp_path / "ttl")), store) == 0


def test_constraints_and_discover_commands(spark, tmp_path, capsys):
    seed = mini.write(tmp_path / "seed")
    (tmp_path / "o").mkdir()
    (tmp_path / "o" / "o.ttl").write_text(mini.HEAD + "@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> . v:memberOf rdfs:range v:Organization ; rdfs:domain v:Human . v:hasGuest a owl:FunctionalProperty .")
    assert cli.main(["constraints", seed, "--ontology", str(tmp_path / "o")]) == 1
    out = capsys.readouterr().out
    assert "1 violation(s)" in out and "Episode.One" in out and "cardinality" in out
    link = '<h1>T</h1><a href="/t/1.pdf">Download transcript</a>'
    spark.createDataFrame([("http://h/1", "k", link), ("http://h/2", "k", "<p>none</p>")], "url string, kind string, html string").write.parquet(str(tmp_path / "p1"))
    spark.createDataFrame([("http://h/2", "k", link), ("http://h/3", "k", link)], "url string, kind string, html string").write.parquet(str(tmp_path / "p2"))
    to = str(tmp_path / "out")
    assert cli.main(["discover", str(tmp_path / "p1"), "--out", to]) == 0 == cli.main(["discover", str(tmp_path / "p2"), "--out", to])
    said = capsys.readouterr().out
    assert "1 new, 1 without a transcript, 0 skipped" in said and "1 new, 0 without a transcript, 1 skipped" in said
    read = lambda name: {r.episode_url for r in spark.read.option("header", True).csv(f"{to}/{name}").collect()}
    assert read("manifest") == {"http://h/1", "http://h/3"} and read("without_transcript") == {"http://h/2"}
    assert cli.main(["discover", str(tmp_path / "p2"), "--out", to, "--force"]) == 0
    assert read("manifest") == {"http://h/1", "http://h/2", "http://h/3"} and read("without_transcript") == set()
