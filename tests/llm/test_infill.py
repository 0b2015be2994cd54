import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from quillgraph.llm import infill

from .helpers import docs, rows

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab\né€😀<PSM> \r"), max_size=60), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_cuts_agree_with_the_pattern(text, h1, h2):
    units = UNIT.findall(text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    data = text.encode()
    n, at, to = infill.cut_units(data, h1, h2)
    assert n == len(units) and data[:at].decode() == "".join(units[:a]) and data[:to].decode() == "".join(units[:b])


@given(st.integers(0, 2**70), st.integers(0, 80))
def test_select_finds_the_ranked_bit(bits, rank):
    width = 71
    places = [i for i in range(width) if bits >> (width - 1 - i) & 1]
    assert infill.select(bits, width, rank) == (places[rank] if rank < len(places) else width)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("<>PSM\nx"), max_size=30), st.integers(0, 500))
def test_texts_come_back_from_their_outputs(text, doc_id):
    n, form, prefix, middle, output = infill.Infill().apply(doc_id, text)
    assert infill.restore(form, output) == text
    assert (form == "plain") == (not text or bool(re.search("<[PSM]>", text)))


def brute(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    units = UNIT.findall(text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    return (len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 50 else (len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_whole_table_against_brute_force(spark, tmp_path):
    draw = random.Random(5)
    texts = ["".join(draw.choice("ab é€😀\n\n.") for _ in range(draw.randint(0, 200))) for _ in range(120)]
    texts += [None, "", "\n", "\n\n\n", "one line", "has <P> in it", "same\ntext\n", "same\ntext\n", "very long\n" * 300_000, "x" * 1_000_000]
    df = docs(spark, texts, extra=True)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r[0]: r[1:] for r in rows(infill.fill_in_middle(df.unionAll(df), "doc_id", "text"))}
    for i, t in enumerate(texts):
        assert got[i] == brute(i, t)
    for r in infill.op12_fill_in_middle(spark, str(tmp_path)).collect():
        n, form, prefix, middle, output = brute(r.doc_id, texts[r.doc_id])
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert tuple(r)[1:] == (n, form, prefix, middle, sha(output), sha(texts[r.doc_id] or ""))


def test_rate_nulls_and_empty_tables(spark):
    df = docs(spark, [f"a\nb\nc {i}" for i in range(400)])
    forms = [r[2] for r in rows(infill.fill_in_middle(df, "doc_id", "text", infill.Infill(rate=25, spm=0)))]
    assert 60 < forms.count("psm") < 140 and forms.count("spm") == 0
    assert rows(infill.fill_in_middle(df.limit(0), "doc_id", "text")) == []
    (one,) = rows(infill.fill_in_middle(df.limit(1).selectExpr("cast(null as long) as doc_id", "text"), "doc_id", "text"))
    assert one[0] is None and infill.restore(one[2], one[5]) == df.first().text
