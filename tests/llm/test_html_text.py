import pyarrow.parquet as pq
from pyspark.sql import functions as F

from quillgraph.llm.html_text import INLINE, Densities, Page, extract, extract_pages

from .helpers import rows

WORDS = "These are several plain words of an article, enough of them to make a paragraph. "


def test_article_without_the_rest():
    page = f"""<!doctype html><html><head><title>No</title><style>p{{}}</style><script>if (a<b) "</p>"</script></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a><li><a href=y>Other</a></ul></nav><div class="cookie-notice">We use {WORDS * 3}</div>
    <div class="ad">Buy {WORDS}</div><main><article><header><h1>The &amp; head&shy;line</h1></header><p>{WORDS}\n  <b>bold</b>&nbsp;text<br>next<p>Second <a href=z>link</a> one.
    <form><p>Sign up</p><input value=x></form><ul><li>item one<li>item two</ul><aside>Related</aside><footer>By me</footer></article>
    <section id="comments"><p>{WORDS * 20}</p></section></main><div class=sidebar><p>{WORDS * 2}</p></div><footer>&copy; x</footer></body></html>"""
    assert extract(page) == f"The & head\u00adline\n{WORDS.strip()} bold text next\nSecond link one.\nitem one\nitem two"


def test_plain_divisions_by_density():
    links = "".join(f'<li><a href="/{i}">link number {i}</a></li>' for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><h2>Head</h2><p>{WORDS * 3}</p><p>{WORDS * 2}</p></div><div><a href=a>one</a> <a href=b>two</a></div></body>"
    assert extract(page) == f"Head\n{(WORDS * 3).strip()}\n{(WORDS * 2).strip()}"


def test_odd_pages():
    assert extract(None) == extract("") == extract("<html></html>") == extract("<script>x") == extract("<!-- x") == ""
    assert extract("just text & more") == "just text & more"
    assert extract("a < b <p>c") == "a < b\nc"
    assert extract("<p>x" * 3) == "x\nx\nx"
    assert extract("<div>" * 5000 + "deep") == "deep"
    assert len(extract("<p>" + "word " * 200_000)) == 999_999
    assert extract("<article><p><b>One.<br><p>Two.</p></article>") == "One.\nTwo."


def test_costs_grow_with_the_page_alone():
    """Deep nesting, open tags and quotes without end, in sizes that a quadratic walk would take minutes for."""
    n = 60_000
    assert extract("<b>x" * n) == "x" * n
    assert extract("<div>x" * n) == "\n".join("x" * n)
    assert extract("<b>" * n + "<p>y" * n) == "\n".join("y" * n)
    assert extract("<p>t</p>" + "<a '" * n).startswith("t")
    assert extract("<p>t</p>" + "<!" * n).startswith("t")
    assert extract("İ<script>x</SCRIPT >" * n) == "İ" * n
    assert extract("<p>t</p>" + "</div>" * n) == "t" and extract("<p>t <!-- x") == "t"


def test_table(spark):
    df = spark.createDataFrame([(1, "u", "<p>é"), (2, None, None), (1, "u", "<p>é")], "page_id long, url string, html string").withColumn("text", F.lit(1))
    assert sorted(rows(extract_pages(df, "page_id", "url", "html"))) == [(1, "u", "é", 1), (1, "u", "é", 1), (2, None, "", 0)]
    assert rows(extract_pages(df.limit(0), "page_id", "url", "html")) == []


def test_pages_of_the_test_data():
    """Each page's article by a plain cut through its one article element."""
    import html
    import re

    for source in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist():
        inner = re.search(r"<article>(.*?)</article>", source, re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert extract(source) == "\n".join(b for b in blocks if b)


def test_density_decides_between_unnamed_blocks(monkeypatch):
    """Without an article element or class names only density tells the text from a list of teasers."""
    teasers = "".join(f"<div><a href=/{i}>Teaser number {i}</a> <span>{i} min</span></div>" for i in range(25))
    page = f"<body><div><div>{teasers}</div></div><div><div><h2>Head</h2><p>{WORDS * 4}</p><p>{WORDS * 3}</p></div></div></body>"
    want = f"Head\n{(WORDS * 4).strip()}\n{(WORDS * 3).strip()}"
    assert extract(page) == want
    plain = Densities.density
    monkeypatch.setattr(Densities, "density", lambda self, i: 1.0 if self.chars[i] else 0.0)
    assert extract(page) != want
    monkeypatch.setattr(Densities, "density", lambda self, i: 1 / (1 + plain(self, i)))
    assert "Teaser" in extract(page)


def test_densities_agree_with_a_plain_walk():
    """Characters, tags and links of each subtree counted anew from the node list, and the sums over children."""
    import html
    import math

    page = Page(f"<body><div><ul><li><a href=x>Menu <b>one</b></a><li><a href=y>two</a></ul></div><div id=t><p>{WORDS} <a href=z>link</a></p><p>&amp; <i>{WORDS}</i></p></div><nav>gone</nav></body>")
    d = Densities(page)
    n = len(page.tags)
    above = lambda i: [i, *above(page.parent[i])] if i >= 0 else []
    inside = [[j for j in range(n) if i in above(j) and not any(page.out[k] for k in above(j))] for i in range(n)]
    texts = [(node, len("".join(html.unescape(t).split()))) for node, t in page.flow if t]
    whole = next(i for i, t in enumerate(page.tags) if t == "body")
    size = lambda i, only=False: sum(c for node, c in texts if node in inside[i] and (not only or any(page.tags[k] == "a" for k in above(node))))
    ratio = size(whole, True) / size(whole)
    for i in range(n):
        c, lc = size(i), size(i, True)
        t, lt = max(len([j for j in inside[i] if j != i]), 1), max(sum(page.tags[j] == "a" for j in inside[i] if j != i), 1)
        want = 0.0
        if c:
            want = c / t * max(math.log(c / max(lc, 1) * t / lt), 0) / math.log(math.log(c / max(c - lc, 1) * lc + ratio * c + math.e))
        assert abs(d.dense[i] - want) < 1e-9
    body = [i for i in range(n) if page.parent[i] == whole and page.tags[i] not in INLINE]
    assert abs(d.total[whole] - sum(d.dense[i] for i in body)) < 1e-9


def test_parts_of_the_article_that_sound_like_boilerplate_stay():
    inner = f'<h1>Headline</h1><p>Short.</p><div><p>{WORDS * 4}</p><p>{WORDS * 3}</p></div><div class="legal"><p>A law is quoted.</p></div><p>x <math><mi>y</mi><mo>=</mo><mn>2</mn></math> z</p>'
    page = f"<body><article>{inner}</article><div class='legal'>All rights</div></body>"
    assert extract(page) == f"Headline\nShort.\n{(WORDS * 4).strip()}\n{(WORDS * 3).strip()}\nA law is quoted.\nx y=2 z"
    assert extract(f'<body><div class="discussion"><p>{WORDS}</p></div></body>') == WORDS.strip()
    assert extract(f'<body><div class="widget"><p>{WORDS * 2}</p></div><p>(c) us</p></body>').startswith(WORDS.strip())


def test_class_words_lower_densities_and_remove_nothing_by_themselves():
    body = "<h1>T</h1><p>Long text here and more of it all the time, on and on it goes.</p>"
    page = f'<body><article>{body}<section id="related-work"><p>Keep me here.</p></section><p class="ad-hoc">And me.</p><div id="share-price">Me too.</div></article></body>'
    assert extract(page).split("\n")[2:] == ["Keep me here.", "And me.", "Me too."]
    for name in ("ad", "ads banner", "site-footer", "comment-list", "sidebar_left", "share-buttons"):
        marked = f'<div class="{name}"><p>Something else that is short.</p></div>'
        assert extract(page.replace("</article>", marked + "</article>")) == extract(page) == extract(page.replace("<article>", marked + "<article>")), name


def test_density_decides_on_pages_without_article(monkeypatch):
    import random

    from quillgraph.llm import html_text

    pages = []
    for seed in range(20):
        draw = random.Random(seed)
        text = lambda n: " ".join(draw.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(n))
        main = "".join(f"<p>{text(draw.randint(30, 60))}.</p>" for _ in range(4))
        links = "".join(f'<li><a href="/{i}">{text(2)}</a></li>' for i in range(12))
        pages.append((f"<body><div><ul>{links}</ul></div><div>{main}</div><div><ul>{links}</ul></div></body>", main))
    want = ["\n".join(p[3:-4] for p in main.replace("</p>", "</p>\0").split("\0")[:-1]) for _, main in pages]
    assert [extract(p) for p, _ in pages] == want
    draw = random.Random(1)
    monkeypatch.setattr(html_text.Densities, "density", lambda self, i: draw.random())
    assert sum(extract(p) != w for (p, _), w in zip(pages, want)) > 10
