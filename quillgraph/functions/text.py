"""Scalar functions over columns, all within the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slugify(label: Column) -> Column:
    """Runs of ASCII letters and digits, each capitalised and the rest of it lower-cased, joined."""
    return F.array_join(F.transform(F.regexp_extract_all(label, F.lit("[A-Za-z0-9]+"), 0), F.initcap), "")


def number_after(text: Column, pattern: str) -> Column:
    """The first group of the first match as an int; null without a match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("int")


def part_number(title: Column) -> Column:
    return number_after(F.lower(title), r"\bpart\s+(\d+)\b")


def normalize_title(title: Column, byline: str | None = None) -> Column:
    """Without .pdf, a leading [Update], the byline at the end and marks; single spaces; lower case. In this order."""
    # These patterns.
    out = F.regexp_replace(title, r"(?i)\.pdf$", "")
    out = F.regexp_replace(out, r"^\[Update\]\s*", "")
    if byline:
        out = F.regexp_replace(out, rf"(?i)\s*-\s*{byline}\s*$", "")
    out = F.regexp_replace(out, r"(?U)[^\w\s]", "")
    return F.lower(F.trim(F.regexp_replace(out, r"(?U)\s+", " ")))


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"\S+"), 0))


def file_name(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_extract(url, r"^(?:[^:/?#]+://[^/?#]*)?([^?#]*)", 1), "/"), -1)


def url_host(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def url_path(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
