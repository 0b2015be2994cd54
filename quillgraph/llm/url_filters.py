"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression over "host#path" (neither holds a #) with the literal tokens that every
match must contain as whole runs of [a-z0-9]. The index files a rule under that token of its own which
the fewest rules hold. A URL's tokens fetch candidate rules; only those run their expression. Rules
without a usable token are candidates for every URL.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import col, map_rows

_TOKEN = re.compile(r"[a-z0-9]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """verdict: allow or block. weight: the heaviest fitting rule wins; ties go to the smaller name."""

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    weight: int = 0
    listed: bool = True


def host_path_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits `host` and its subdomains where the path starts with `path`; weighs its length.

    The last token of the path counts as literal only if the path goes on after it.
    """
    inner = _TOKEN.findall(path.translate(_LOWER))
    if inner and _TOKEN.fullmatch(path[-1:].translate(_LOWER)):
        inner = inner[:-1]
    return Rule(host + path, rf"(?:^|\.){re.escape(host)}#{re.escape(path)}", (*_TOKEN.findall(host), *inner), verdict, len(host + path))


def word_rule(word: str, verdict: str = "block") -> Rule:
    """Fits a host that has `word` (letters, digits, dashes) between its dots."""
    return Rule(word, rf"(?:^|\.){re.escape(word)}[.#]", tuple(_TOKEN.findall(word)), verdict, 0, listed=False)


class RuleIndex:
    def __init__(self, rules: list[Rule]):
        held = Counter(t for r in rules for t in set(r.tokens))
        self.by_token: dict[str, list[tuple[re.Pattern, Rule]]] = defaultdict(list)
        self.always: list[tuple[re.Pattern, Rule]] = []
        for r in rules:
            where = self.by_token[min(r.tokens, key=lambda t: (held[t], -len(t), t))] if r.tokens else self.always
            where.append((re.compile(r.pattern, re.DOTALL), r))

    def best(self, host: str, path: str) -> Rule | None:
        text = f"{host}#{path}"
        found = [r for p, r in self.always if p.search(text)]
        for token in set(_TOKEN.findall(text.translate(_LOWER))) & self.by_token.keys():
            found += [r for p, r in self.by_token[token] if p.search(text)]
        return min(found, key=lambda r: (not r.listed, -r.weight, r.name)) if found else None


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or without "://"."""
    at = url.find("://") if url else -1
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(_LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def filter_urls(df: DataFrame, rules: list[Rule], id_col: str, url_col: str, default: str = "allow") -> DataFrame:
    """One row (id, host, path, rule, verdict) for each row of df.

    Listed (host, path) rules go before the others, and give `rule`; other rules give only the verdict.
    Null, empty and scheme-less URLs have an empty host and path and so the default verdict. Long URLs are read whole. Repeated rows
    stay repeated; other columns of df are ignored, whatever their names; an empty table gives no row. The rule list goes to each task with the code: it is a
    configuration, not data.
    """

    def rows(incoming):
        index = RuleIndex(rules)
        for key, url in incoming:
            host, path = split_url(url)
            r = index.best(host, path)
            yield key, host, path, r.name if r and r.listed else None, r.verdict if r else default

    schema = pa.schema([("page_id", pa.int64()), *((c, pa.string()) for c in ("host", "path", "rule", "verdict"))])
    return map_rows(df.select(col(id_col).cast("long"), col(url_col).cast("string")), rows, schema, "page_id long, host string, path string, rule string, verdict string", batch=10_000)


#: Fixed values: (host, path, verdict) and host words of spam sites.
LISTED = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
SPAM_WORDS = ["spam-farm", "cheap-pills", "casino-bonus", "free-prizes"]
RULES = [*(host_path_rule(*r) for r in LISTED), *map(word_rule, SPAM_WORDS)]


def op1_url_filters(spark, sf_dir: str) -> DataFrame:
    from ._common import read

    return filter_urls(read(spark, sf_dir, "pages"), RULES, "page_id", "url")


ORACLE = f"""
WITH r(rhost, rpath, rverdict) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in LISTED)}),
cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut),
fits AS (
  SELECT page_id, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS listed
  FROM parts LEFT JOIN r ON ends_with('.' || host, '.' || rhost) AND starts_with(path, rpath)
  GROUP BY ALL)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
  coalesce(listed, CASE WHEN regexp_matches(host, '(^|\\.)({"|".join(SPAM_WORDS)})(\\.|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM fits
"""
