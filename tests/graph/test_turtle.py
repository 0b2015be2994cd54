import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillgraph.sources.turtle import RDF, XSD, TurtleError, parse, serialize

P = "@prefix a: <http://x/> . @prefix : <http://y#> . "


def objects(text):
    return [o for _, _, o in parse(P + text)]


def test_names_dots_and_punctuation():
    rows = parse(P + "a:Concept.Over.Shoot a :c ; :p :q, : ; . :s <http://z/(x)#é> a:v.w.# note . ;\n")
    assert [r[0][0] for r in rows] == ["http://x/Concept.Over.Shoot"] * 3 + ["http://y#s"]
    assert [r[2][0] for r in rows] == ["http://y#c", "http://y#q", "http://y#", "http://x/v.w"]
    assert rows[0][1] == RDF + "type" and rows[3][1] == "http://z/(x)#é"


def test_literals():
    got = objects(r''':s :p "a\"b\nçé"@EN, "2020"^^<http://www.w3.org/2001/XMLSchema#gYear>, 5, -1.5, 2e3, true, """x "q" y""", 'k' .''')
    assert got == [('a"b\nçé', "lit", RDF + "langString", "en"), ("2020", "lit", XSD + "gYear", None), ("5", "lit", XSD + "integer", None), ("-1.5", "lit", XSD + "decimal", None), ("2e3", "lit", XSD + "double", None), ("true", "lit", XSD + "boolean", None), ('x "q" y', "lit", XSD + "string", None), ("k", "lit", XSD + "string", None)]


def test_nesting_and_collections():
    rows = parse(P + ":s :p [ :q [ :r 1 ], () ] ; :l ( :a :b ) . _:x :p _:x . [ :p :o ] .")
    assert len(rows) == 11 and sum(p == RDF + "first" for _, p, _ in rows) == 2
    assert {r[0][0] for r in parse(P + "_:x :p 1 .", "f1")} != {r[0][0] for r in parse(P + "_:x :p 1 .", "f2")}


@pytest.mark.parametrize("bad", [":s :p [ .", ":s :p", '"x" :p :o .', "b:s :p :o .", ":s :p :o ; ] .", ":s :p <a b> ."])
def test_errors(bad):
    with pytest.raises(TurtleError):
        parse(P + bad)


TERM = st.one_of(
    st.builds(lambda s: (f"http://x/{s}", "iri", None, None), st.from_regex(r"[A-Za-z0-9.é#/-]{0,8}", fullmatch=True)),
    st.builds(lambda s: (s, "lit", XSD + "string", None), st.text(st.characters(exclude_categories=("Cs",)), max_size=12)),
    st.builds(lambda s: (s, "lit", RDF + "langString", "en-gb"), st.text(st.characters(exclude_categories=("Cs",)), max_size=12)),
    st.builds(lambda n: (str(n), "lit", XSD + "integer", None), st.integers()),
)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("pq"), TERM), max_size=8))
def test_round_trip(rows):
    full = {((f"http://s/{s}", "iri", None, None), f"http://p/{p}", o) for s, p, o in rows}
    assert set(parse(serialize(full))) == full
