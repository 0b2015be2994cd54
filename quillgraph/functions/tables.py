"""Table functions for SQL users: register(spark), then `FROM documents, LATERAL mentions(text)` or `FROM pages, LATERAL anchors(url, html)`.

A call's rows come from one row's text; Spark sends rows to the Python workers and back in Arrow batches. Null and empty texts give no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from quillgraph.operators.discovery import page_links
from quillgraph.operators.entities import CAPITALISED


@udtf(returnType="entity_text string, entity_type string, pos int", useArrow=True)
class Mentions:
    """Runs of capitalised ASCII words in their order, as recognize_capitalised finds them."""

    def __init__(self):
        self.pattern = re.compile(CAPITALISED, re.ASCII)

    def eval(self, text: str) -> Iterator[tuple]:
        for pos, m in enumerate(self.pattern.finditer(text or "")):
            yield m[0], "PERSON", pos


@udtf(returnType="href string, label string, pos int", useArrow=True)
class Anchors:
    """Links of a page in their order, made absolute."""

    def eval(self, url: str, html: str) -> Iterator[tuple]:
        for pos, (href, label) in enumerate(page_links(url, html)[1]):
            yield href, label, pos


def register(spark: SparkSession) -> None:
    spark.udtf.register("mentions", Mentions)
    spark.udtf.register("anchors", Anchors)
