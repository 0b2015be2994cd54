"""Main text of web pages by composite text density.

For every DOM node: characters per tag of its subtree, adjusted by how much of both is links. A node's density sum
adds its children's densities; the node with the greatest sum is the article's core. The least density on the path
from the body to it is the threshold: other nodes at or above it keep their own greatest-sum subtree. The article or main element
around the core, else the body, is the scope. In an article or main, blocks beside the core stay (headlines and short paragraphs have
little density), unless over half of their text is links and they are below the threshold. Elements and roles that are never
text (menus, scripts, forms) take no part. Class names and ids that stand for boilerplate only lower the density of what they
mark, so that density decides there too; weaker ones do so outside of articles and beside more text alone.
"""

from __future__ import annotations

import html
import re
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import col, map_rows, read

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[a-z]+")

#: Elements by kind, and the words in class or id that mark what is not the article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
DROPPED = set("script style noscript iframe template head title nav footer aside form button select textarea svg canvas object embed audio video dialog menu map".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
CLOSES_P = BLOCK - set("html head body dd dt li legend optgroup option tbody td tfoot th thead title tr".split()) | {"li", "dd", "dt"}
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mrow mi mn mo ms mtext msub msup mfrac msqrt mover munder semantics annotation".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
BOILERPLATE = set("nav navbar navigation menu masthead topbar header footer sidebar aside ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations breadcrumb breadcrumbs pagination pager comment comments commentlist disqus".split())
#: These words mark articles' own parts too: they count only outside of article and main, and not where they hold most of the text.
HINTS = set("toolbar widget widgets notice notices respond replies reply discussion copyright legal disclaimer search skip".split())
#: Words that may stand beside those in one class name, which then still marks boilerplate: "site-footer", but not "related-work".
BESIDE = set("site page main top bottom left right inner outer wrap wrapper container box block list item items area bar section module row col column link links button buttons icon icons menu text title content body primary secondary global post article entry widget js".split())
#: What the density of a part so marked is multiplied by.
LOWERED = 0.02
#: Which open elements a start tag ends, and which ones stop the search for them.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
HEADINGS = {"h1", "h2"}


class Page:
    """Nodes in page order: tag, parent, whether the node itself is out; and text or block ends in between."""

    def __init__(self, source: str):
        self.tags, self.parent, self.out, self.by_name, self.hinted = ["#root"], [-1], [False], [False], [False]
        self.flow: list[tuple[int, str | None]] = []  # (node, text), or (node, None) where a block begins or ends
        # Open nodes, and at which of their places each tag, and any block, is open: so a tag costs the same at any depth.
        self._open = [0]
        self._places: dict[str, list[int]] = {}
        self._blocks: list[int] = []
        at, n, last_end = 0, len(source), source.rfind(">")
        while at < n:
            m = _TAG.search(source, at) if at <= last_end else None
            if not m:
                comment = source.find("<!--", at)
                self._text(source[at : comment if comment >= 0 else n])
                break
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            if m[1] or m[4]:
                self._end(name)
                continue
            self._start(name, m[3] or m[6] or "")
            if name in RAW:
                close = re.compile(f"</{name}", re.IGNORECASE | re.ASCII).search(source, at)
                self._text(source[at : close.start() if close else n])
                at = close.start() if close else n

    def _text(self, s: str) -> None:
        self.flow.append((self._open[-1], s))

    def _pop_to(self, i: int) -> None:
        for node in reversed(self._open[i:]):
            tag = self.tags[node]
            self._places[tag].pop()
            if tag in BLOCK:
                self._blocks.pop()
                self.flow.append((node, None))
        del self._open[i:]

    def _innermost(self, names: set[str]) -> int:
        """Place of the innermost open element of these names, or -1."""
        return max((p[-1] for n in names if (p := self._places.get(n))), default=-1)

    def _start(self, name: str, attributes: str) -> None:
        tags = self.tags
        if name in CLOSES_P:
            self._end_open({"p"}, {"table", "td", "th", "button", "object"})
        if name in ENDS:
            self._end_open(*ENDS[name])
        at = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)} if attributes.strip(" /") else {}
        node = len(tags)
        tags.append(name)
        self.parent.append(self._open[-1])
        inside = self._innermost({"article", "main"}) > 0
        gone = name in DROPPED or name == "header" and not inside or at.get("role") in ROLES or "hidden" in at or "display:none" in at.get("style", "").replace(" ", "") or at.get("aria-hidden") == "true"
        names = [set(_NAME.findall(n)) for n in f"{at.get('class', '')} {at.get('id', '')}".split()]
        self.out.append(gone)
        named = not gone and name not in ("html", "body", "article", "main")
        self.by_name.append(named and any(n & BOILERPLATE and n <= BOILERPLATE | HINTS | BESIDE for n in names))
        self.hinted.append(named and not inside and any(n & HINTS and n <= HINTS | BESIDE for n in names))
        if name in BLOCK:
            self.flow.append((node, None))
        elif name == "br":
            self.flow.append((node, " "))
        if name not in VOID:
            self._places.setdefault(name, []).append(len(self._open))
            if name in BLOCK:
                self._blocks.append(len(self._open))
            self._open.append(node)

    def _end_open(self, names: set[str], stops: set[str]) -> None:
        at = self._innermost(names)
        if at > self._innermost(stops):
            self._pop_to(at)

    def _end(self, name: str) -> None:
        at = self._innermost({name})
        # An inline end tag doesn't close blocks.
        if at > 0 and (name in BLOCK or not self._blocks or self._blocks[-1] < at):
            self._pop_to(at)


class Densities:
    """chars, link_chars, tags and links of each node's subtree without what is out, its density, and its density sum."""

    def __init__(self, page: Page):
        self.page, tags, parent, n = page, page.tags, page.parent, len(page.tags)
        # A node whose class or id sounds like boilerplate keeps its density if it holds the article or a main heading.
        holds = [t in ("article", "main") or t in HEADINGS for t in tags]
        for i in range(n - 1, 0, -1):
            holds[parent[i]] |= holds[i] and not page.out[i]
        self.out = list(page.out)
        self.low = [page.by_name[i] and not holds[i] for i in range(n)]  # marked by name, itself
        self.link = [t == "a" for t in tags]
        for i in range(1, n):
            self.out[i] |= self.out[parent[i]]
            self.link[i] |= self.link[parent[i]]
        own = [0] * n
        for node, text in page.flow:
            if text and not self.out[node]:
                own[node] += len("".join(html.unescape(text).split()))
        if any(page.hinted):
            held = list(own)
            for i in range(n - 1, 0, -1):
                held[parent[i]] += held[i]
            for i in range(1, n):
                self.low[i] |= page.hinted[i] and not holds[i] and 2 * held[i] <= held[0]
        self.weight = [1.0] * n
        for i in range(1, n):
            self.weight[i] = LOWERED if self.low[i] else self.weight[parent[i]]
        self.chars = [0 if o else c for o, c in zip(self.out, own, strict=True)]
        self.link_chars = [c * k for c, k in zip(self.chars, self.link, strict=True)]
        self.count, self.links = [0] * n, [0] * n
        kids: list[list[int]] = [[] for _ in range(n)]
        holder = [0] * n  # the nearest node above that is no formatting element
        for i in range(1, n):
            holder[i] = holder[parent[i]] if tags[parent[i]] in INLINE else parent[i]
        for i in range(n - 1, 0, -1):
            if not self.out[i]:
                p = parent[i]
                self.chars[p] += self.chars[i]
                self.link_chars[p] += self.link_chars[i]
                self.count[p] += self.count[i] + 1
                self.links[p] += self.links[i] + (tags[i] == "a")
                if tags[i] not in INLINE:
                    kids[holder[i]].append(i)
        body = next((i for i, t in enumerate(tags) if t == "body" and not self.out[i]), 0)
        self.body = body if self.chars[body] else 0
        self.all_links = self.link_chars[self.body] / max(self.chars[self.body], 1)
        self.dense = [0.0 if self.out[i] else self.weight[i] * self.density(i) for i in range(n)]
        # Formatting elements are no containers: their own containers stand for them.
        self.total = [-1.0 if tags[i] in INLINE else sum(self.dense[k] for k in kids[i]) if kids[i] else self.dense[i] for i in range(n)]

    def density(self, i: int) -> float:
        c, t, lc, lt = self.chars[i], max(self.count[i], 1), self.link_chars[i], self.links[i]
        if not c:
            return 0.0
        base = log(log(c / max(c - lc, 1) * lc + self.all_links * c + e))
        if base < 1e-9:  # no link on the page
            return c / t
        return c / t * max(log(c / max(lc, 1) * t / max(lt, 1)), 0.0) / base


def extract(source: str | None) -> str:
    """The article's blocks, one a line; empty for null, empty and text-less pages."""
    if not source:
        return ""
    page = Page(source)
    tags, parent, n = page.tags, page.parent, len(page.tags)
    d = Densities(page)
    out, dense, body = d.out, d.dense, d.body
    if not d.chars[0]:
        return ""
    last = list(range(n))  # last node of each subtree
    for i in range(n - 1, 0, -1):
        last[parent[i]] = max(last[parent[i]], last[i])

    def greatest(i: int) -> int:
        return max(range(i, last[i] + 1), key=lambda x: (not out[x], d.total[x], -x))

    core = greatest(body)
    threshold, scope, x = dense[core], body, core
    while x != body and x > 0:
        if tags[x] in ("article", "main") and scope == body:
            scope = x
        x = parent[x]
        threshold = min(threshold, dense[x])
    marks, i = {core}, scope
    while i <= last[scope]:
        if out[i] or i in marks or d.low[i] and dense[i] < threshold:
            i = last[i] + 1
        elif i <= core <= last[i] or tags[i] in INLINE:
            i += 1
        elif dense[i] >= threshold or scope != body and 2 * d.link_chars[i] <= d.chars[i]:
            marks.add(i if scope != body else greatest(i))
            i = last[i] + 1
        else:
            i += 1
    kept = [False] * n
    # Text straight in an ancestor of the core, within the scope, belongs to the article too, with its formatting elements.
    x, above = core, set()
    while x != scope and x > 0:
        x = parent[x]
        above.add(x)
    for i in range(n):
        up = parent[i]
        kept[i] = not out[i] and not (d.low[i] and dense[i] < threshold) and (i in marks or i in above or i > 0 and kept[up] and (up not in above or tags[i] in INLINE))
    blocks, held = [], []
    for node, text in page.flow:
        if text is None:
            if held:
                blocks.append(" ".join("".join(held).split()))
                held = []
        elif kept[node]:
            held.append(html.unescape(text))
    blocks.append(" ".join("".join(held).split()))
    return "\n".join(b for b in blocks if b)


def extract_pages(df: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(page_id, url, text, n_chars) for each row; n_chars counts code points.

    Null, empty and malformed pages give what text they have, at least an empty one. Repeated rows stay repeated; other
    columns are ignored. Of nodes with equal sums the first on the page wins.
    """

    def rows(incoming):
        for key, url, source in incoming:
            text = extract(source)
            yield key, url, text, len(text)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
    return map_rows(df.select(col(id_col).cast("long"), col(url_col).cast("string"), col(html_col).cast("string")), rows, schema, "page_id long, url string, text string, n_chars long", batch=500)


def op10_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_pages(read(spark, sf_dir, "pages"), "page_id", "url", "html")
