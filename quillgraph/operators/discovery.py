"""Discovery of pages and their transcript links."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillgraph.functions.text import file_name, url_host, url_path


def classify(url: Column, rules: list[tuple[str, str]]) -> Column:
    """The name of the first rule (name, text of the path) that fits; null if none does."""
    out = F.lit(None).cast("string")
    for name, part in reversed(rules):
        out = F.when(F.contains(url_path(url), F.lit(part)), name).otherwise(out)
    return out


class _Anchors(HTMLParser):
    def __init__(self, decode: bool = True):
        super().__init__(convert_charrefs=True)
        self.decode = decode
        self.links, self.title, self._a, self._h1 = [], None, None, None

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self._a = [dict(attrs).get("href"), ""]
        elif tag == "h1" and self.title is None and self._h1 is None:
            self._h1 = ""

    def handle_data(self, data):
        if not self.decode and self.cdata_elem is not None:  # nothing is decoded in scripts and styles
            data = data.replace("&amp;", "&")
        if self._a is not None:
            self._a[1] += data
        if self._h1 is not None:
            self._h1 += data

    def handle_endtag(self, tag):
        if tag == "a" and self._a is not None:
            if self._a[0] is not None:
                self.links.append(tuple(self._a))
            self._a = None
        elif tag == "h1" and self._h1 is not None:
            self.title, self._h1 = self._h1.strip(), None


def page_links(url: str | None, html: str | None, decode: bool = True) -> tuple[str, list[tuple[str, str]]]:
    """Title of a page's first h1, and (href made absolute, label) of its links in page order. decode: character references become
    characters, as in HTML; otherwise they stay as they are written."""
    p = _Anchors(decode)
    p.feed((html or "") if decode else (html or "").replace("&", "&amp;"))
    p.close()
    return (p.title if p.title is not None else (p._h1 or "").strip()) or "", [(urljoin(url or "", h), t.strip()) for h, t in p.links]


def page_parts(url: Column | str, html: Column | str, decode: bool = True) -> Column:
    """struct(title: of the first h1, links: array of (href made absolute, label) in page order). decode: as for page_links."""

    def parts(urls: pd.Series, pages: pd.Series) -> pd.DataFrame:
        found = [page_links(url, page, decode) for url, page in zip(urls, pages, strict=True)]
        return pd.DataFrame({"title": [t for t, _ in found], "links": [[{"href": h, "label": x} for h, x in links] for _, links in found]})

    return F.pandas_udf(parts, "struct<title:string,links:array<struct<href:string,label:string>>>")(url, html)


def listing_links(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(url, kind, pos): same-site links of pages(url, html) that a rule fits, each URL once, at its first place."""
    at = pages.withColumn("_p", page_parts("url", "html")).select(F.col("url").alias("_page"), F.posexplode("_p.links").alias("pos", "_l"))
    found = at.select(F.col("_l.href").alias("url"), "_page", "pos").filter(url_host(F.col("url")) == url_host(F.col("_page")))
    return found.withColumn("kind", classify(F.col("url"), rules)).filter("kind IS NOT NULL").groupBy("url", "kind").agg(F.min("pos").alias("pos"))


def discover(sitemap: DataFrame | None, listing: DataFrame, per_kind: int | None = None) -> DataFrame:
    """(url, kind, ord): the sitemap's URLs, then those of the listing that it lacks; without a sitemap the listing alone."""
    out = listing.select("url", "kind", F.lit(1).alias("_src"), "pos")
    if sitemap is not None:
        out = sitemap.select("url", "kind", F.lit(0).alias("_src"), "pos").unionAll(out.join(sitemap, "url", "left_anti"))
    out = out.withColumn("ord", F.row_number().over(W.partitionBy("kind").orderBy("_src", "pos", "url"))).drop("_src", "pos")
    return out.filter(F.col("ord") <= per_kind) if per_kind is not None else out


def to_fetch(found: DataFrame, manifest: DataFrame, dead: DataFrame, force: bool = False) -> DataFrame:
    """URLs neither fetched nor known dead; force: all."""
    if force:
        return found
    return found.join(manifest.select(F.col("episode_url").alias("url")), "url", "left_anti").join(dead.select(F.col("episode_url").alias("url")), "url", "left_anti")


def upsert(manifest: DataFrame, fresh: DataFrame, key: str = "episode_url") -> DataFrame:
    """The manifest with the rows of fresh in place of those that have their keys, and the new ones; columns as in the manifest."""
    return manifest.join(fresh.select(key), key, "left_anti").select(*manifest.columns).unionByName(fresh.select(*manifest.columns))


def transcripts(pages: DataFrame, label: str = "download transcript") -> tuple[DataFrame, DataFrame]:
    """Manifest rows of pages(url, kind, html) with a link whose text has the label, the first counts; and the dead ones, once a URL."""
    p = pages.withColumn("_p", page_parts("url", "html"))
    first = F.filter("_p.links", lambda x: F.contains(F.lower(x["label"]), F.lit(label)))
    p = p.select(F.col("url").alias("episode_url"), F.col("kind").alias("type"), F.col("_p.title").alias("title"), F.try_element_at(first, F.lit(1))["href"].alias("transcript_url"))
    good = p.filter("transcript_url IS NOT NULL").withColumn("local_filename", file_name(F.col("transcript_url")))
    return good.dropDuplicates(["episode_url"]), p.filter("transcript_url IS NULL").select("episode_url", "title").dropDuplicates(["episode_url"])


def refuse_blocked(urls: DataFrame, prefixes: list[str]) -> None:
    """Raises if a robots prefix blocks any URL's path."""
    blocked = urls.filter(F.exists(F.array(*map(F.lit, prefixes)).cast("array<string>"), lambda p: F.startswith(url_path(F.col("url")), p)))
    if (row := blocked.first()) is not None:
        raise PermissionError(f"robots rules block {row.url}")
