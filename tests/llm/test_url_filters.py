import random
import re

from .helpers import rows
from quillgraph.llm.url_filters import LISTED, RULES, RuleIndex, filter_urls, host_path_rule, split_url


def brute(url):
    host, path = split_url(url)
    fits = [(len(h + p), h + p, v) for h, p, v in LISTED if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    bad = any(re.search(r.pattern, f"{host}#{path}") for r in RULES if not r.listed)
    return host, path, None, "block" if bad else "allow"


def test_matches_trying_every_rule(spark):
    rng = random.Random(1)
    hosts = ["example.com", "www.example.com", "m.EXAMPLE.com", "notexample.com", "a.net", "net", "x.org", "spam-farm.org", "xspam-farm.org", "com", "a.com:80", "", "a example.com", "b.example.com "]
    tails = ["", "/", "/en/", "/en", "/EN/", "/es/1", "/fr/?x=http://b.com/en/", "?q", "#f", "/es", "/en/a\nb", "/.example.com /en/", "/x.net /es/", "/spam-farm "]
    urls = [f"http://{h}{t}" for h in hosts for t in tails] + [None, "", "no scheme", "://", "a://b://c/en/"]
    rng.shuffle(urls)
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("host", __import__("pyspark").sql.functions.lit(1))
    got = {r[0]: r[1:] for r in rows(filter_urls(df, RULES, "page_id", "url"))}
    assert got == {i: brute(u) for i, u in enumerate(urls)}
    assert rows(filter_urls(df.limit(0), RULES, "page_id", "url")) == []


def test_index_uses_the_rarest_token_and_open_ended_paths():
    index = RuleIndex([host_path_rule("a.com", "/x/", "block"), host_path_rule("b.com", "/x/", "block"), host_path_rule("com", "/y", "block")])
    assert "com" in index.by_token and len(index.by_token["com"]) == 1 and {"a", "b"} <= index.by_token.keys()
    assert index.best("q.com", "/yes").name == "com/y"


def test_repeated_rows_long_urls_extra_columns_and_empty_tables(spark):
    long = "http://a.example.com/en/" + "x/" * 200_000 + "?q=/es/"
    df = spark.createDataFrame([(1, long), (1, long), (2, "http://b.net/fr/" + "y" * 300_000), (3, None)], "page_id long, url string").selectExpr("*", "'clash' as host", "0 as verdict", "1 as id")
    got = [tuple(r) for r in filter_urls(df, RULES, "page_id", "url").collect()]
    assert len(got) == 4 and got[0] == got[1] == (1, "a.example.com", long[len("http://a.example.com") : long.index("?")], "example.com/en/", "block")
    assert got[2][3:] == ("net/fr/", "block") and got[3] == (3, "", "", None, "allow")
    assert filter_urls(df.limit(0), RULES, "page_id", "url").count() == 0
