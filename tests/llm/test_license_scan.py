import random

from hypothesis import given, settings
from hypothesis import strategies as st

from quillgraph.llm.license_scan import TEMPLATES, TemplateIndex, align, scan_licenses, words
from quillgraph.llm.license_texts import WHOLE

from .helpers import docs, rows


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y and x else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=8), st.lists(st.integers(0, 4), max_size=8))
def test_wide_band_gives_the_longest_common_subsequence(a, b):
    n, first, last = align(a, b, 0, 16)
    assert n == lcs(a, b) == lcs(a, b[first : last + 1] if n else [])


def test_finds_each_template_whole_edited_and_repeated(spark):
    mit, gpl = TEMPLATES["MIT"], TEMPLATES["GPL-notice"]
    edited = gpl.replace("redistribute it", "give it away").replace("published", "PUBLISHED")
    texts = [f"Foo bar. {mit} End", f"{edited}", "All rights reserved. All rights reserved.", None, "", "plain text of licensed words", "x " * 50_000 + mit]
    got = rows(scan_licenses(docs(spark, texts, extra=True), "doc_id", "text"))
    by = {}
    for d, name, n, of, cov, a, b in got:
        by.setdefault(d, []).append((name, texts[d][a:b], cov))
    assert by[0] == [("MIT", mit[:-1], 1.0)]
    assert by[1][0][0] == "GPL-notice" and 0.8 <= by[1][0][2] < 1
    assert [x[1] for x in by[2]] == ["All rights reserved"] * 2
    assert by[6] == [("MIT", mit[:-1], 1.0)] and set(by) == {0, 1, 2, 6}
    assert rows(scan_licenses(docs(spark, []), "doc_id", "text")) == []


def test_every_template_is_found_in_noise():
    index = TemplateIndex(TEMPLATES, 3, 4)
    for name, text in TEMPLATES.items():
        found = {m[0]: m for m in index.matches(f"lorem ipsum {text} dolor", 8, 0.8)}
        assert found[name][1] == len(words(text))


def test_changed_short_notices_and_neighbours():
    index = TemplateIndex(TEMPLATES, 3, 4)
    assert [m[0] for m in index.matches("licensed under CC BY 3.0", 8, 0.8)] == ["CC-BY-4.0"]
    whole = TEMPLATES["BSD-notice"]
    cut = " ".join(whole.split()[3:])
    assert [m[0] for m in index.matches(f"{whole} {cut}", 8, 0.8)].count("BSD-notice") == 2


def plainly(text, band, coverage):
    """Names of the templates that some shift aligns with, tried at every shift without an index."""
    index = TemplateIndex(TEMPLATES, 3, 4)
    ids = [index.vocabulary.get(w, 0) for w in words(text)]
    out = set()
    for name, seq in zip(index.names, index.sequences, strict=True):
        for shift in range(-len(seq), len(ids) + 1):
            lo, hi = max(0, shift - band), max(0, shift + len(seq) + band)
            if len(set(ids[lo:hi]) & set(seq)) * 2 > len(set(seq)) and align(seq, ids[lo:hi], shift - lo, band)[0] >= coverage * len(seq):
                out.add(name)
                break
    return out


def test_names_are_those_of_trying_every_shift():
    index = TemplateIndex(TEMPLATES, 3, 4)
    rng = random.Random(4)
    for name, text in sorted(TEMPLATES.items()):
        sequence = text.split()
        if len(sequence) > 60:
            continue
        for at in rng.sample(range(len(sequence)), len(sequence) // 10):
            sequence[at] = "changed"
        edited = f"some words before {' '.join(sequence)} and some after"
        assert {m[0] for m in index.matches(edited, 8, 0.8)} == plainly(edited, 8, 0.8), name


def test_whole_licences_with_changes_ties_and_repeated_rows(spark):
    bsd = WHOLE["BSD-3-Clause-text"].replace("the copyright holder nor", "Some University nor").replace("documentation and/or other", "manuals and other")
    mit = "Copyright (c) 2020 Somebody\n" + WHOLE["MIT-text"].replace("copies of the Software, and to permit", "copies, and to permit")
    far = " ".join(reversed(WHOLE["MIT-text"].split()))
    df = docs(spark, [bsd, mit, far, bsd])
    got = rows(scan_licenses(df.union(df), "doc_id", "text"))
    by = {}
    for d, name, *_ in got:
        by.setdefault(d, []).append(name)
    # Each row is scanned by itself. The clause that only one licence has is longer than the band, so the other isn't found.
    assert sorted(by[0]) == sorted(by[3]) and by[0].count("BSD-3-Clause-text") == 2 and "BSD-2-Clause-text" not in by[0]
    assert by[1].count("MIT-text") == 2 and "ISC-text" not in by[1]
    assert 2 not in by
